"""Joins against earlier work: skipping what is done and looking up what is cached.

Keys are digests of the instruction. The right side is always reduced to one row per key before it
meets the left side, so a popular instruction is heavy on the left side only. Adaptive execution
splits such a left partition if both join inputs come straight from a shuffle. The right side is
therefore reduced by the digest in one form and joined by it in another, which costs a shuffle of
the reduced rows. Small right sides are broadcast by measured size, never by hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.functions.keys import digest_key, text_digest, text_key
from prefspark.functions.wrapping import pack_struct, packed, unpack_struct, unpacked
from prefspark.schemas import CACHE_HIT

_KEY = "_key"
_DIGEST = "_digest"


def _keys(df: DataFrame, column: str) -> DataFrame:
    """The key of every distinct text."""
    digests = df.filter(F.col(column).isNotNull()).select(
        text_digest(F.col(column)).alias(_DIGEST)
    )
    return digests.distinct().select(digest_key(F.col(_DIGEST)).alias(_KEY))


def drop_empty(df: DataFrame, column: str = "instruction") -> DataFrame:
    """Rows with a text; one of blanks alone counts as text."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def finished(done: DataFrame) -> DataFrame:
    """Of an earlier output what need not be done again: rows with responses and without an error."""
    if "error" in done.columns:
        done = done.filter(F.col("error").isNull())
    if "responses" in done.columns:
        done = done.filter(F.col("responses").isNotNull())
    return done


def skip_done(
    df: DataFrame, done: DataFrame, *, column: str = "instruction", dedupe: bool = False
) -> DataFrame:
    """Non-empty rows whose instruction is not among the done ones.

    Rows of `done` that failed are not done. Repeated instructions within `df` are all kept unless `dedupe` is set.
    """
    todo = drop_empty(df, column).withColumn(_KEY, text_key(F.col(column)))
    if dedupe:
        todo = todo.dropDuplicates([_KEY])
    return todo.join(_keys(finished(done), column), _KEY, "left_anti").drop(_KEY)


def first_logged(cache: DataFrame) -> DataFrame:
    """The first log row of each instruction as (key, hit): by `position` in the log where it was read with
    one, else by round and then record id. The hit's texts are told by the instruction, for `lookup`."""
    order = F.col("position") if "position" in cache.columns else F.struct("round", "record_id")
    hit = pack_struct(CACHE_HIT, "instruction")
    return (
        cache.filter(F.col("instruction").isNotNull())
        .select(text_digest(F.col("instruction")).alias(_DIGEST), hit.alias("_hit"), order.alias("_order"))
        .groupBy(_DIGEST)
        .agg(F.min_by("_hit", "_order").alias("hit"))
        .select(digest_key(F.col(_DIGEST)).alias(_KEY), "hit")
    )


def met(first: DataFrame, df: DataFrame) -> DataFrame:
    """Of a reduced cache the rows that these rows meet. Only keys are sent."""
    return first.join(_keys(df, "instruction"), _KEY, "left_semi")


def lookup(df: DataFrame, first: DataFrame, *, packed_hit: bool = False) -> DataFrame:
    """Adds `hit` from a cache that `first_logged` has reduced, null where it holds nothing.

    Rows meet the cache with their texts told by one another. `packed_hit` leaves the hit as it is stored.
    """
    keyed = packed(df.withColumn(_KEY, text_key(F.col("instruction"))))
    found = unpacked(keyed.join(first, _KEY, "left").drop(_KEY))
    if packed_hit:
        return found
    return found.withColumn("hit", unpack_struct("hit", CACHE_HIT, "instruction"))


def cache_lookup(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Adds `hit`, what the cache holds for the instruction, null when it holds nothing."""
    return lookup(df, first_logged(cache))


def cache_hits(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Rows whose instruction is in the cache."""
    keyed = df.withColumn(_KEY, text_key(F.col("instruction")))
    return keyed.join(_keys(cache, "instruction"), _KEY, "left_semi").drop(_KEY)


def align_outputs(inputs: DataFrame, outputs: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Model outputs next to their inputs, matched by id whatever order they came back in.

    Of repeated outputs the one with the smallest values counts, so that no input is multiplied.
    """
    rest = [c for c in outputs.columns if c != id_col]
    one = outputs.groupBy(id_col).agg(F.min(F.struct(*rest)).alias("_output"))
    return inputs.join(one, id_col, "left").select("*", "_output.*").drop("_output")
