"""Dense numbers for rows, in two passes and without a task that sees them all.

Rows are stored with their place, which names the task that wrote them and their row in it. They are then
counted per task, and a row's number is the count of the tasks before its own plus its row. Only
these counts, one per task (and group), are ever brought together.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prefspark.sources.tables import with_position, write_table

# monotonically_increasing_id: the partition above these bits, the row below them.
ROW_BITS = 33
_PLACE, _PART, _FILE, _START = "_place", "_part", "_file", "_start"


def _part() -> Column:
    return F.shiftright(F.col(_PLACE), ROW_BITS)


def _stored(rows: DataFrame, path: str) -> DataFrame:
    write_table(rows.withColumn(_PLACE, F.monotonically_increasing_id()), path)
    return rows.sparkSession.read.parquet(path)


def _before_parts(counts: DataFrame) -> DataFrame:
    """(_part, n) -> (_part, _before). There is a row per task, so the driver may add them up."""
    rows = sorted(tuple(r) for r in counts.collect())
    before = itertools.accumulate((n for _, n in rows), initial=0)
    told = [(part, start) for (part, _), start in zip(rows, before)]
    return counts.sparkSession.createDataFrame(told, f"{_PART} long, _before long")


def numbered(
    df: DataFrame,
    order: list[Column],
    path: str,
    *,
    within: str | None = None,
    parts: int | None = None,
    name: str = "seq",
) -> DataFrame:
    """Adds `name`, the row's place from 0 on in this order, over all rows or `within` each group.

    With `within`, that column leads the order and is not null. Rows that are equal in `order` are numbered
    in the order they were stored in. `path` is the folder of the sorted rows, which the result reads.
    """
    order = ([F.col(within).asc()] if within else []) + order
    sorted_rows = (
        df.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    )
    rows = _stored(sorted_rows, path).withColumn(_PART, _part())
    keys = [_PART] + ([within] if within else [])
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(_PLACE).alias("_first"))
    if within:
        earlier = Window.partitionBy(within).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    else:
        starts = counts.drop("n").join(_before_parts(counts.select(_PART, "n")), _PART)
    joined = rows.join(starts, keys)
    number = F.col("_before") + F.col(_PLACE) - F.col("_first")
    return joined.select(*[F.col(c) for c in df.columns], number.alias(name))


def running_sum(df: DataFrame, order: list[Column], weight: str, path: str, name: str) -> DataFrame:
    """Adds `name`, the sum of `weight` over all rows before this one in an order without ties."""
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = _stored(sorted_rows, path).withColumn(_PART, _part())
    totals = rows.groupBy(_PART).agg(F.sum(weight).cast("long").alias("n"))
    earlier = Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    joined = rows.withColumn("_inside", inside).join(_before_parts(totals), _PART)
    return joined.select(*[F.col(c) for c in df.columns], (F.col("_before") + F.col("_inside")).alias(name))


def in_input_order(lines: DataFrame, path: str, name: str = "seq") -> DataFrame:
    """Adds `name`, the row's place in the input from 0 on: by file name, then by row within the file.

    A file is read in splits, in no particular order. Rows are counted per split, and the splits' counts are
    summed up in file order. `path` is a folder for the stored rows, which the result reads.
    """
    rows = with_position(lines).select("*", "position.file", "position.start").drop("position")
    kept = lines.columns
    stored = _stored(rows.withColumnsRenamed({"file": _FILE, "start": _START}), f"{path}/rows")
    # A split is read by one task in one go; rows of several tasks share one only outside of files.
    splits = stored.withColumn("_task", F.when(F.col(_FILE) == "", _part()).otherwise(F.lit(0)))
    keys = [_FILE, _START, "_task"]
    counts = splits.groupBy(*keys).agg(F.count("*").alias("n"), F.min(_PLACE).alias("_first"))
    starts = running_sum(counts, [F.col(k) for k in keys], "n", f"{path}/splits", "_before").drop("n")
    # Stored, so that their size is known: there are few of them, and the rows need not be sent to meet them.
    write_table(starts, f"{path}/starts")
    joined = splits.join(lines.sparkSession.read.parquet(f"{path}/starts"), keys)
    number = F.col("_before") + F.col(_PLACE) - F.col("_first")
    return joined.select(*[F.col(c) for c in kept], number.alias(name))
