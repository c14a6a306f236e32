"""Texts told by another text of their row.

Rows of a run hold texts several times over: an original that is still the current one, a response that repeats
its prompt, a rewrite that adds to it. Where a text begins or ends with another one of its row, only what is
left of it is sent through shuffles and stored. Bytes are compared and cut, so any text comes back as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# `how`: 0 for the text itself; for its k-th base from 0 on 2k+1 where it begins with that, 2k+2 where it ends so;
# -1 where it has its first `n` bytes in common with the first base.
WRAPPED = T.StructType(
    [T.StructField("how", T.ByteType()), T.StructField("n", T.IntegerType()), T.StructField("rest", T.BinaryType())]
)
WRAPPED_LIST = T.ArrayType(WRAPPED)

# The texts a column is told by, nearest first. A column comes after those it is told by.
BASES = {
    "instruction": ("original_instruction",),
    "responses": ("instruction", "original_instruction"),
    "original_responses": ("original_instruction", "instruction"),
    "refined_instruction": ("instruction", "original_instruction"),
    "refined_responses": ("refined_instruction", "instruction"),
}

# The rows of the log that a row has left behind it, first round first: structs whose texts are told by the row's.
EARLIER = "earlier"
_EARLIER_TEXTS = ("instruction", "original_instruction")
_EARLIER_LISTS = ("responses", "original_responses")
_EARLIER_TOLD = (*BASES, "original_instruction")
# What a row of the log was made into is most often what the next one begins with, so it is told by that first.
_MADE = {"refined_instruction": "instruction", "refined_responses": "responses"}

# Texts with so many characters in common are told by what they begin with.
_COMMON = 32

# Expressions are SQL, as those of the earlier rows are long and would be put together call by call otherwise.
_One = Callable[..., str]


def _common(a: str, b: str) -> str:
    """How many bytes two texts have in common before they differ, by halves."""
    step, within = "shiftright(1073741824, p)", f"least(octet_length({a}), octet_length({b}))"
    piece = lambda text: f"substring(cast({text} as binary), l + 1, {step})"
    longer = f"l + {step} <= {within} and {piece(a)} = {piece(b)}"
    return f"aggregate(sequence(0, 30), 0, (l, p) -> case when {longer} then l + {step} else l end)"


def _wrap(text: str, *bases: str) -> str:
    """The text by the first of these texts that it begins or ends with, else by what it and the first of them
    begin with, else as it is; null for a null text."""
    told = lambda how, rest, n="cast(null as int)": f"named_struct('how', {how}Y, 'n', {n}, 'rest', {rest})"
    raw = f"cast({text} as binary)"
    cases = [f"when {text} is null then null"]
    for k, base in enumerate(bases):
        after = f"substring({raw}, octet_length({base}) + 1, octet_length({text}))"
        before = f"substring({raw}, 1, octet_length({text}) - octet_length({base}))"
        cases.append(f"when startswith({text}, {base}) then {told(2 * k + 1, after)}")
        cases.append(f"when endswith({text}, {base}) then {told(2 * k + 2, before)}")
    common = told(-1, f"substring({raw}, n + 1, octet_length({text}))", "n")
    cases.append(
        f"when startswith({text}, left({bases[0]}, {_COMMON}))"
        f" then get(transform(array({_common(text, bases[0])}), n -> {common}), 0)"
    )
    return f"case {' '.join(cases)} else {told(0, raw)} end"


def _unwrap(wrapped: str, *bases: str) -> str:
    cases = []
    for k, base in enumerate(bases):
        cases.append(f"when {2 * k + 1} then concat(cast({base} as binary), {wrapped}.rest)")
        cases.append(f"when {2 * k + 2} then concat({wrapped}.rest, cast({base} as binary))")
    cases.append(f"when -1 then concat(substring(cast({bases[0]} as binary), 1, {wrapped}.n), {wrapped}.rest)")
    return f"cast(case {wrapped}.how {' '.join(cases)} else {wrapped}.rest end as string)"


def _each(kind: T.DataType, column: str, one: _One, bases: list[str]) -> str:
    return f"transform({column}, t -> {one('t', *bases)})" if isinstance(kind, T.ArrayType) else one(column, *bases)


def _bases(names: list[str], name: str) -> list[str]:
    return [base for base in BASES[name] if base in names]


def packed(df: DataFrame) -> DataFrame:
    """The rows with the columns of BASES, where they are texts or lists of texts, told by others of the row."""
    names = df.columns
    for name in reversed(BASES):
        if name in names and _bases(names, name):
            df = df.withColumn(name, F.expr(_each(df.schema[name].dataType, name, _wrap, _bases(names, name))))
    return df


def unpacked(df: DataFrame) -> DataFrame:
    names = df.columns
    for name in BASES:
        if name in names and _bases(names, name):
            df = df.withColumn(name, F.expr(_each(df.schema[name].dataType, name, _unwrap, _bases(names, name))))
    return df


def _map_earlier(df: DataFrame, one: _One, ahead: Callable[..., str]) -> Column:
    """Wraps or unwraps the texts of the earlier rows. `ahead` gives a text of the row after one, which is told by
    the same bases, as it is."""
    texts, lists = ([name for name in names if name in df.columns] for names in (_EARLIER_TEXTS, _EARLIER_LISTS))
    of_list = [f"get({name}, i)" for name in lists] + texts
    after = f"get({EARLIER}, k + 1)"

    def mapped(field: T.StructField) -> str:
        name, made = field.name, _MADE.get(field.name)
        if name not in _EARLIER_TOLD:
            return f"e.{name}"
        if isinstance(field.dataType, T.ArrayType):
            first = [ahead(f"get({after}.{made}, i)", *of_list)] if made else []
            return f"transform(e.{name}, (t, i) -> {one('t', *first, *of_list)})"
        first = [ahead(f"{after}.{made}", *texts)] if made else []
        return one(f"e.{name}", *first, *texts)

    fields = df.schema[EARLIER].dataType.elementType.fields
    row = ", ".join(f"'{field.name}', {mapped(field)}" for field in fields)
    return F.expr(f"transform({EARLIER}, (e, k) -> named_struct({row}))")


def packed_earlier(df: DataFrame) -> DataFrame:
    """The rows, whose texts are as they are, with their earlier rows told by them. These stay so as long as the
    instruction and responses do, and the original ones where there are some."""
    return df.withColumn(EARLIER, _map_earlier(df, _wrap, lambda text, *_: text))


def unpacked_earlier(df: DataFrame) -> Column:
    """The earlier rows as they were, of rows whose texts are as they are."""
    return _map_earlier(df, _unwrap, _unwrap)


def _wrapped_type(kind: T.DataType) -> T.DataType:
    return WRAPPED_LIST if isinstance(kind, T.ArrayType) else WRAPPED


def packed_schema(schema: T.StructType) -> T.StructType:
    """The schema of `packed` rows."""
    names = schema.fieldNames()

    def kind(field: T.StructField) -> T.DataType:
        if field.name == EARLIER:
            row = field.dataType.elementType.fields
            told = [T.StructField(f.name, _wrapped_type(f.dataType)) if f.name in _EARLIER_TOLD else f for f in row]
            return T.ArrayType(T.StructType(told))
        if not any(base in names for base in BASES.get(field.name, ())):
            return field.dataType
        return _wrapped_type(field.dataType)

    return T.StructType([T.StructField(field.name, kind(field)) for field in schema.fields])


def pack_struct(kinds: T.StructType, base: str) -> Column:
    """A struct of columns that are texts and lists of texts, each told by the same text."""
    return F.struct(*[F.expr(_each(f.dataType, f.name, _wrap, [base])).alias(f.name) for f in kinds.fields])


def unpack_struct(struct: str, kinds: T.StructType, base: str) -> Column:
    texts = [F.expr(_each(f.dataType, f"{struct}.{f.name}", _unwrap, [base])).alias(f.name) for f in kinds.fields]
    return F.when(F.col(struct).isNotNull(), F.struct(*texts))


def packed_struct_schema(kinds: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, _wrapped_type(f.dataType)) for f in kinds.fields])
