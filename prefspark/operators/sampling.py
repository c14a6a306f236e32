"""Exact-size samples without a global sort.

Records are ordered by a seeded hash of their id, rows with one id (or without any) by a hash of their
content, and a sample of size k is the first k of that order. So it depends on ids, contents and seed only and
not on partitioning. The k-th record is found from the hashes alone: histograms over ever longer
prefixes narrow the search until one record has it. The rows are then filtered by comparing with
that record, which takes no shuffle. The driver sees one row per pass.

Where the sample ends among rows that are equal in everything, those rows alone are stored, counted per file,
and taken file by file up to the number that is due, so that no task sees them all.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prefspark.constants import SAMPLE_FRACTION, SEED
from prefspark.functions.keys import hash_order, row_content
from prefspark.operators.ordinals import numbered
from prefspark.session import new_workdir
from prefspark.sources.tables import write_table

# A histogram has 16 ** DIGITS bars, so each task sends few and their running sum is small.
DIGITS = 3
HASH_LENGTH = 32


def _bar_holding(keys: DataFrame, prefix_length: int, size: Column) -> Row | None:
    """The histogram bar with the record in place `size`, an expression over the row count `n`."""
    bars = keys.groupBy(F.left("h", F.lit(prefix_length)).alias("prefix")).agg(
        F.count("*").alias("bar")
    )
    return (
        bars.select(
            "prefix",
            "bar",
            F.sum("bar").over(Window.orderBy("prefix")).alias("through"),
            F.sum("bar").over(Window.partitionBy()).alias("n"),
        )
        .withColumn("place", size)
        .filter(F.col("through") >= F.col("place"))
        .orderBy("prefix")
        .select(
            "prefix", "bar", (F.col("place") - F.col("through") + F.col("bar")).alias("place")
        )
        .first()
    )


def _narrowed(keys: DataFrame, bar: Row, prefix_length: int, digits: int) -> tuple[Row, int]:
    """The bar around the record in its place, made narrower until it has one record or one hash."""
    while bar.bar > 1 and prefix_length < HASH_LENGTH:
        pool = keys.filter(F.startswith("h", F.lit(bar.prefix)))
        prefix_length = min(prefix_length + digits, HASH_LENGTH)
        bar = _bar_holding(pool, prefix_length, F.lit(bar.place))
    return bar, prefix_length


def _some_of(equal: DataFrame, size: int) -> DataFrame:
    """`size` of rows that are all equal."""
    spark, path = equal.sparkSession, new_workdir(equal.sparkSession, "equal-rows")
    write_table(equal, path)
    stored = spark.read.schema(equal.schema).parquet(path)
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    counts = sorted(tuple(r) for r in stored.groupBy(file.alias("file")).count().collect())
    before = itertools.accumulate((n for _, n in counts), initial=0)
    # Files that are taken whole, and the one that is taken in part.
    split = next((name, size - start) for (name, n), start in zip(counts, before) if start + n >= size)
    return stored.filter((file < split[0]) | ((file == split[0]) & (row < split[1]))).select(*equal.columns)


def _id_hash(id_col: str, seed: int) -> Column:
    return hash_order(F.coalesce(F.col(id_col).cast("string"), F.lit("")), seed)


def _first_in_hash_order(
    df: DataFrame, size: Column, id_col: str, seed: int, digits: int
) -> DataFrame | None:
    """The rows up to place `size`; None when there is no such place."""
    place_of = _id_hash(id_col, seed)
    keys = df.select(place_of.alias("h"))
    bar = _bar_holding(keys, digits, size)
    if bar is None:
        return None
    if bar.place < 1:
        return df.filter(F.lit(False))
    bar, length = _narrowed(keys, bar, digits, digits)
    head = F.left(place_of, F.lit(length))
    if bar.place == bar.bar:
        return df.filter(head <= bar.prefix)
    # The sample ends among the rows with one id; they go by content.
    tied, content = df.filter(place_of == bar.prefix), row_content(df)
    contents = tied.select(content.alias("h"))
    last = _bar_holding(contents, digits, F.lit(bar.place))
    last, length = _narrowed(contents, last, digits, digits)
    head = F.left(content, F.lit(length))
    if last.place == last.bar:
        return df.filter((place_of < bar.prefix) | ((place_of == bar.prefix) & (head <= last.prefix)))
    below = df.filter((place_of < bar.prefix) | ((place_of == bar.prefix) & (head < last.prefix)))
    return below.unionByName(_some_of(tied.filter(content == last.prefix), last.place))


def sample_fraction(
    df: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    *,
    id_col: str = "record_id",
    seed: int = SEED,
    digits: int = DIGITS,
) -> DataFrame:
    """Exactly `int(n * fraction)` rows, the product taken in binary floating point."""
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must lie in [0, 1], got {fraction}")
    size = F.floor(F.col("n").cast("double") * F.lit(float(fraction)))
    sample = _first_in_hash_order(df, size, id_col, seed, digits)
    return df.filter(F.lit(False)) if sample is None else sample


def sample_size(
    df: DataFrame,
    size: int,
    *,
    id_col: str = "record_id",
    seed: int = SEED,
    digits: int = DIGITS,
) -> DataFrame:
    """Exactly `size` rows; asking for more than there are is an error."""
    if size < 0:
        raise ValueError(f"size must not be negative, got {size}")
    sample = _first_in_hash_order(df, F.lit(size), id_col, seed, digits)
    if sample is None:
        if size > 0:
            raise ValueError(f"cannot sample {size} rows, there are fewer")
        return df.filter(F.lit(False))
    return sample


def shuffled(
    df: DataFrame,
    *,
    id_col: str = "record_id",
    seed: int = SEED,
    name: str = "place",
    path: str | None = None,
) -> DataFrame:
    """Adds `name`, the row's place from 0 on in the seeded order that samples are taken in.

    The rows are sorted by ranges of the order, many tasks each its own, and stored under `path`.
    """
    order = {"_id_hash": _id_hash(id_col, seed), "_content": row_content(df)}
    placed = numbered(
        df.withColumns(order),
        [F.col(key) for key in order],
        path or new_workdir(df.sparkSession, "shuffled"),
        name=name,
    )
    return placed.drop(*order)
