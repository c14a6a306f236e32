"""JSON lines at the edges, Parquet between stages."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.text import BLANKS
from prefspark.schemas import CACHE, INSTRUCTION


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every non-blank line under one schema, absent keys as null; a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Removes a table that is about to be written anew, its completion mark included."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def drop_tables(spark: SparkSession, pattern: str) -> None:
    """Removes the folders that a pattern with wildcards names."""
    fs, hadoop_pattern = _file_system(spark, pattern)
    for found in fs.globStatus(hadoop_pattern) or []:
        fs.delete(found.getPath(), True)


def read_done(spark: SparkSession, path: str, schema: T.StructType = INSTRUCTION) -> DataFrame:
    """What an earlier run left: malformed lines are skipped, no file means no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A dataset with whatever columns it has."""
    return spark.read.format(fmt).load(path)


def with_position(lines: DataFrame) -> DataFrame:
    """Adds `position`, a struct that grows along the input: file, start of the split, row.

    Rows that do not come straight from files are in the order of their partitions.
    """
    row = F.monotonically_increasing_id().alias("row")
    if _from_files(lines):
        place = F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), row
        )
    else:
        place = F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("start"), row)
    return lines.withColumn("position", place)


def _from_files(lines: DataFrame) -> bool:
    if "_metadata" in lines.columns or not lines.inputFiles():
        return False
    try:
        # The fields of `_metadata` are there only while rows are still those of a file scan.
        return bool(lines.select("_metadata.file_block_start").columns)
    except AnalysisException:
        return False


def read_cache(
    spark: SparkSession, path: str, fmt: str = "json", *, positions: bool = False
) -> DataFrame:
    """A refinement log of an earlier run; an absent or unreadable one counts as empty.

    With `positions` each row has its `position` in the log, by which its first row for an instruction is
    found.
    """
    empty = spark.createDataFrame([], CACHE)
    empty = with_position(empty) if positions else empty
    if not exists(spark, path):
        return empty
    try:
        if fmt == "json":
            # A log is read whole or not at all, so a bad line anywhere voids it.
            line = F.btrim("value", F.lit(BLANKS))
            bad = spark.read.text(path).filter((line != "") & F.try_parse_json(line).isNull())
            if not bad.isEmpty():
                return empty
        elif not _readable(spark, path, fmt):
            return empty
        log = spark.read.schema(CACHE).format(fmt).load(path)
        return with_position(log) if positions else log
    except AnalysisException:
        return empty


def _readable(spark: SparkSession, path: str, fmt: str) -> bool:
    """Whether every file can be read whole. Tasks read one each; a job that fails for another reason fails."""
    log = spark.read.schema(CACHE).option("ignoreCorruptFiles", "false").format(fmt).load(path)
    try:
        # A digest of all columns makes every page of every file be decoded.
        log.agg(F.max(F.xxhash64(*CACHE.fieldNames()))).first()
        return True
    except Py4JJavaError as failure:
        if "FAILED_READ_FILE" in str(failure):
            return False
        raise


def write_jsonl(
    df: DataFrame, path: str, *, order_by: str | Column | None = None, compression: str | None = None
) -> None:
    """Replaces the JSON lines at `path`; non-ASCII text stays as it is.

    With `order_by` the files in name order hold the rows in that order.
    """
    (df if order_by is None else df.orderBy(order_by)).write.mode("overwrite").json(path, compression=compression)


def is_complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_SUCCESS")


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replaces a table that a later stage reads. Texts compress well, and every one is read again."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def _round_path(root: str, number: int, part: int) -> str:
    return f"{root}/round={number}/part={part}"


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small text file; it appears whole or not at all."""
    fs, target = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    fs.delete(target, False)
    fs.rename(draft, target)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, source = _file_system(spark, path)
    if not fs.exists(source):
        return None
    stream = fs.open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_round(
    df: DataFrame, root: str, number: int, partition_by: str | None = None, *, part: int = 0
) -> None:
    """Replaces one part of one round of a round-partitioned table, so that writing it again changes nothing."""
    write_table(df, _round_path(root, number, part), partition_by)


def read_rounds(
    spark: SparkSession, root: str, schema: T.StructType, rounds: int | None = None
) -> DataFrame:
    """All rounds of such a table, or the first so many. Rounds never written are skipped."""
    if not exists(spark, root):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(root).select(*schema.fieldNames())
    return table if rounds is None else table.filter(F.col("round") < rounds)


def read_round(
    spark: SparkSession, root: str, schema: T.StructType, number: int, *, part: int | None = None
) -> DataFrame:
    path = f"{root}/round={number}" if part is None else _round_path(root, number, part)
    table = spark.read.schema(schema).option("basePath", root).parquet(path)
    return table.select(*schema.fieldNames())


def round_is_complete(spark: SparkSession, root: str, number: int, *, part: int = 0) -> bool:
    return is_complete(spark, _round_path(root, number, part))
