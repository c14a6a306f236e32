"""Writing the products of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prefspark.functions.wrapping import packed, unpacked
from prefspark.operators.lineage import both_sides
from prefspark.plans.rounds import Run
from prefspark.schemas import FINAL


def finalize(
    spark: SparkSession,
    workdir: str,
    rounds_done: int,
    path: str,
    fmt: str = "parquet",
    *,
    in_order: bool = False,
    compression: str | None = None,
) -> DataFrame:
    """Writes the four final datasets under `path`, one folder per side and status, and reads them.

    It takes the folder of a run and the number of completed rounds, so it can be a job of its own. With
    `in_order` the files of a folder, in name order, hold its rows in the order of the input (`seq`).
    `compression` is one that Spark knows for the format, which has its own default.
    """
    run = Run(spark, workdir, rounds_done)
    if in_order:
        # A row is sent once for both sides, and sorted, with its texts told by one another. Ranges of status
        # and place hold a piece of each folder, in the order of the files.
        rows = unpacked(packed(run.final_rows).repartitionByRange("status", "seq"))
        products = unpacked(packed(both_sides(rows)).sortWithinPartitions("side", "status", "seq"))
    else:
        products = run.final_products
    options = {} if compression is None else {"compression": compression}
    products.write.mode("overwrite").partitionBy("side", "status").format(fmt).options(**options).save(path)
    return spark.read.schema(FINAL).format(fmt).load(path)
