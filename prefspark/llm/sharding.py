"""Sharding by extendible hashing, with DataFrame functions alone.

A document's place is a 60-bit hash of its id and text. The directory is indexed by leading bits of
the hash; a bucket above the byte limit is split on one more bit, and only such a bucket, until every
shard fits. Sums are taken for `STEP` bits at a time: the sums of a bucket's halves are sums of its
descendants, so one grouping settles `STEP` splits of all open buckets, and rows of settled buckets
take no part in the next one.

Defined results
* A null text has 0 bytes, as an empty one. An empty table has no shards.
* Rows that share a hash (repeated rows) cannot be told apart by more bits. If together they are above
  the limit, their bucket gets pages, numbered from 0, each within the limit.
* A single document above the limit is a shard of its own; `shard_bytes` shows it.
* Output columns replace input columns of the same name; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import content_hash, without, written

BITS = 60
STEP = 12
BYTE_LIMIT = 64 << 20
SEED = 42


def _place(id_col: str, text_col: str, seed: int) -> Column:
    digits = F.substring(content_hash(F.col(id_col), F.col(text_col), seed), 1, BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def _head(place: Column, bits) -> Column:
    """The leading bits of a place; `bits` is a number or a column."""
    bits = F.lit(bits) if isinstance(bits, int) else bits
    return F.call_function("shiftright", place, (F.lit(BITS) - bits).cast("int"))


def directory(places: DataFrame, byte_limit: int) -> list[DataFrame]:
    """Directory levels for rows of (place, bytes).

    Level k has one row for each slot of STEP x (k + 1) bits that holds rows of a bucket that was still
    open: `slot`, and the shard it points to (`head`, `depth`, `shard_bytes`, `pages`, `rows_a_page`),
    with a null `depth` while the bucket is open. Several slots point to one shard, as in any
    extendible directory. All levels but the first cover open buckets alone.
    """
    levels: list[DataFrame] = []
    open_slots = None
    for bits in range(STEP, BITS + 1, STEP):
        rows = places
        if open_slots is not None:
            rows = rows.withColumn("above", _head(F.col("place"), bits - STEP)).join(
                open_slots.select(F.col("slot").alias("above")), "above", "left_semi"
            )
        slots = rows.groupBy(_head(F.col("place"), bits).alias("slot")).agg(
            F.sum("bytes").alias("slot_bytes"), F.count(F.lit(1)).alias("slot_rows"),
            F.min("place").alias("low"), F.max("place").alias("high"),
        )
        slots = written(slots, "shard-slots")
        first = 0 if bits == STEP else bits - STEP + 1
        depths = slots.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(bits))))
        heads = depths.withColumn("head", F.call_function("shiftright", F.col("slot"), F.lit(bits) - F.col("depth")))
        sums = heads.groupBy("depth", "head").agg(
            F.sum("slot_bytes").alias("shard_bytes"), F.sum("slot_rows").alias("shard_rows"),
            F.min("low").alias("low"), F.max("high").alias("high"),
        )
        fits = sums.where((F.col("shard_bytes") <= byte_limit) | (F.col("low") == F.col("high")))
        pointed = heads.select("slot", "depth", "head").join(fits.drop("low", "high"), ["depth", "head"])
        chosen = pointed.groupBy("slot").agg(
            F.min_by(F.struct("depth", "head", "shard_bytes", "shard_rows"), "depth").alias("shard")
        )
        level = slots.select("slot").join(chosen, "slot", "left").select(
            "slot", "shard.depth", "shard.head", "shard.shard_bytes", "shard.shard_rows"
        )
        level = written(level, "shard-level")
        levels.append(level)
        open_slots = level.where("depth is null")
        if open_slots.isEmpty():
            break
    return levels


def assign(docs: DataFrame, *, byte_limit=BYTE_LIMIT, seed=SEED, id_col="doc_id", text_col="text") -> DataFrame:
    """The documents with their shard.

    `shard` (the hash bits of its bucket, with `.page` if it has pages), `shard_depth` (bits),
    `shard_bytes` (all its text bytes) and `bytes` (of this document).
    """
    out = ["shard", "shard_depth", "shard_bytes", "bytes"]
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    keyed = docs.select(
        F.struct("*").alias("doc"), _place(id_col, text_col, seed).alias("place"), size.alias("bytes")
    )
    # Id, text, sizes: two passes over the texts, or one and a narrow table; this is the latter.
    levels = directory(written(keyed.select("place", "bytes"), "shard-places"), byte_limit)
    placed = keyed
    for k, level in enumerate(levels):
        entry = level.select(F.col("slot").alias(f"slot{k}"), F.struct("depth", "head", "shard_bytes", "shard_rows").alias(f"level{k}"))
        placed = placed.withColumn(f"slot{k}", _head(F.col("place"), STEP * (k + 1))).join(entry, f"slot{k}", "left")
    known = [F.when(F.col(f"level{k}.depth").isNotNull(), F.col(f"level{k}")) for k in range(len(levels))]
    placed = placed.select("doc", "place", "bytes", F.coalesce(*known).alias("at"))
    full = (F.col("at.shard_bytes") > byte_limit) & (F.col("at.shard_rows") > 1)
    bits = F.lpad(F.conv(F.col("at.head").cast("string"), 10, 2), F.col("at.depth"), F.lit("0"))
    bits = F.when(F.col("at.depth") == 0, F.lit("")).otherwise(bits)
    single = placed.where(~full).select(
        "doc", bits.alias("shard"), F.col("at.depth").alias("shard_depth"), F.col("at.shard_bytes").alias("shard_bytes"), "bytes"
    )
    crowded = any(not level.where((F.col("shard_bytes") > byte_limit) & (F.col("shard_rows") > 1)).isEmpty() for level in levels)
    result = single.unionByName(_pages(placed.where(full), bits, byte_limit)) if crowded else single
    return result.select("doc.*", *out) if not _clash(docs, out) else result.select(
        *[f"doc.{name}" for name in without(docs, *out)], *out
    )


def _clash(docs: DataFrame, names: list[str]) -> bool:
    return bool({c.lower() for c in docs.columns} & set(names))


def _pages(rows: DataFrame, bits: Column, byte_limit: int) -> DataFrame:
    """Pages for rows that share a hash and together exceed the limit.

    Equal rows are counted, which a task does with its own rows before any shuffle, so that a hot row
    moves as few counts; then pages are dealt out, and each page writes its rows.
    """
    counted = rows.groupBy("doc", "place", "bytes", "at").agg(F.count(F.lit(1)).alias("n"))
    # Rows of one hash may still differ in further columns: their pages are numbered one after another.
    a_page = F.greatest(F.lit(1), F.floor(F.lit(byte_limit) / F.greatest("bytes", F.lit(1)))).cast("long")
    counted = counted.withColumn("a_page", a_page).withColumn("key", F.md5(F.to_json("doc")))
    paged = counted.withColumn(
        "page", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.col("a_page"))))
    ).repartition("key", "page")
    here = F.least("a_page", F.col("n") - F.col("page") * F.col("a_page"))
    each = paged.withColumn("in_page", here).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), here)))
    return each.select(
        "doc", F.concat_ws(".", bits, F.substring("key", 1, 8), F.col("page").cast("string")).alias("shard"),
        F.col("at.depth").alias("shard_depth"), (F.col("in_page") * F.col("bytes")).alias("shard_bytes"), "bytes",
    )
