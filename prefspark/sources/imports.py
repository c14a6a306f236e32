"""Bringing rows in with numbers that stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.operators.ordinals import in_input_order
from prefspark.sources.tables import drop_table, write_table


def import_instructions(spark: SparkSession, lines: DataFrame, path: str) -> DataFrame:
    """Stores rows without an id, with `seq`, their place in the input from 0 on, and it as `record_id`.

    Rows read from files are in the order of the files' names and of the lines within each. They keep
    `seq` through all rounds, so that final datasets can be written in the order of the input.
    """
    stored = f"{path.rstrip('/')}-order"
    kept = lines.drop("seq", "record_id")
    numbered = in_input_order(kept, stored)
    write_table(numbered.withColumn("record_id", F.col("seq").cast("string")), path)
    drop_table(spark, stored)
    return spark.read.parquet(path)
