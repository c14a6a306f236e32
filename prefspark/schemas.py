"""Explicit schemas of every table that is read or written."""

from pyspark.sql import types as T

from prefspark.functions.wrapping import EARLIER, packed_schema, packed_struct_schema

TEXTS = T.ArrayType(T.StringType())
SCORES = T.ArrayType(T.DoubleType())
FLAGS = T.ArrayType(T.BooleanType())
RUBRIC = T.MapType(
    T.StringType(),
    T.StructType(
        [T.StructField("score", T.IntegerType()), T.StructField("note", T.StringType())]
    ),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


INSTRUCTION = _struct(record_id=T.StringType(), instruction=T.StringType())

PAIRS = T.StructType(INSTRUCTION.fields + [T.StructField("responses", TEXTS)])

LINEAGE = _struct(original_instruction=T.StringType(), original_responses=TEXTS)

# `seq` is the place in the input, null where it has none.
SEQ = _struct(seq=T.LongType())

NEXT_ROUND = T.StructType(PAIRS.fields + LINEAGE.fields + SEQ.fields)

# What the refinement cache contributes to a row that hits it.
CACHE_HIT = _struct(
    responses=TEXTS,
    feedback=T.StringType(),
    original_instruction=T.StringType(),
    original_responses=TEXTS,
    refined_instruction=T.StringType(),
    refined_responses=TEXTS,
)

# The same as it is sent and stored, told by the row's instruction.
PACKED_HIT = packed_struct_schema(CACHE_HIT)

# A cache reduced to one row per instruction.
FIRST_LOGGED = _struct(_key=T.BinaryType(), hit=PACKED_HIT)

# One row per record and round; `round` and `route` are partition columns.
ROUTED = T.StructType(
    NEXT_ROUND.fields
    + _struct(
        scores=SCORES,
        score_over_budget=FLAGS,
        hit=CACHE_HIT,
        round=T.IntegerType(),
        route=T.StringType(),
    ).fields
)

# One row per refined or cached record; `round` is the partition column.
REFINE_LOG = T.StructType(
    _struct(
        record_id=T.StringType(),
        instruction=T.StringType(),
        responses=TEXTS,
        feedback=T.StringType(),
        original_instruction=T.StringType(),
        original_responses=TEXTS,
        refined_instruction=T.StringType(),
        refined_responses=TEXTS,
        error=T.StringType(),
        over_budget=T.BooleanType(),
        from_cache=T.BooleanType(),
        seq=T.LongType(),
        round=T.IntegerType(),
    ).fields
)

# The rows of the log that a row has left behind it, one for each round from 0 on.
LOGGED = T.StructType([f for f in REFINE_LOG.fields if f.name not in ("record_id", "seq", "round")])
_EARLIER_ROWS = [T.StructField(EARLIER, T.ArrayType(LOGGED))]

# A routed row as it is stored.
STORED_ROUTED = T.StructType(
    [
        T.StructField("hit", PACKED_HIT) if field.name == "hit" else field
        for field in packed_schema(T.StructType(ROUTED.fields + _EARLIER_ROWS)).fields
    ]
)

# A row of the log as it is stored.
STORED_LOG = packed_schema(T.StructType(REFINE_LOG.fields + _EARLIER_ROWS))

# A refinement log as it is exchanged between runs.
CACHE = T.StructType(
    [
        f
        for f in REFINE_LOG.fields
        if f.name not in ("error", "over_budget", "from_cache", "seq")
    ]
)

FINAL = T.StructType(
    PAIRS.fields + SEQ.fields + _struct(side=T.StringType(), status=T.StringType()).fields
)

ATTEMPTS = _struct(
    record_id=T.StringType(),
    attempt=T.IntegerType(),
    feedback=T.StringType(),
    error=T.StringType(),
)
