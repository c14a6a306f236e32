"""What the operators share: written tables, words, row identity and per-process caches."""

from __future__ import annotations

import contextlib
import sys
import types
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.session import new_workdir
from prefspark.sources.tables import drop_table

#: A word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = b" \t\n\x0b\x0c\r"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: The folders made within the blocks of `tables_dropped`, the innermost last.
_MADE: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """Within this block the shuffle files of a query go as soon as its result is written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` from a table in the shared folder.

    This cuts the lineage: work above it is done once, and a lost executor costs only its own tasks.
    """
    spark = df.sparkSession
    folder = new_workdir(spark, label)
    for made in _MADE[-1:]:
        made.append(folder)
    with shuffle_files_dropped(spark):
        df.write.option("compression", "zstd").parquet(f"{folder}/table")
    return spark.read.schema(df.schema).parquet(f"{folder}/table")


@contextlib.contextmanager
def tables_dropped(spark: SparkSession) -> Iterator[list[str]]:
    """Drops the tables that `written` makes within this block, at its end.

    Their folders are in the list it gives; those that are taken out of it stay.
    """
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE.remove(made)
        for folder in made:
            drop_table(spark, folder)


def drop_written(df: DataFrame) -> None:
    """Deletes a table of `written` that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def word_count(text: Column) -> Column:
    """Words of a text as a long, zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def content_hash(record_id: Column, text: Column, seed: int) -> Column:
    """A uniform hex string that depends on the id, the text and the seed alone.

    The text takes part so that rows that lack an id, or repeat one, do not all share one value.
    """
    return F.md5(
        F.concat_ws(
            ":",
            F.lit(str(seed)),
            F.coalesce(record_id.cast("string"), F.lit("")),
            F.md5(F.coalesce(text, F.lit(""))),
        )
    )


def fold(record_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(record_id.cast("string"), F.lit("")).cast("binary")) % n


def process_cache(name: str, make: Callable[[], object]) -> object:
    """One value per Python worker process, kept between its tasks.

    Worker functions may travel with the job, and then their modules' globals are new in every task;
    an entry of sys.modules is not.
    """
    holder = sys.modules.setdefault("_prefspark_process_cache", types.ModuleType("cache"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def without(df: DataFrame, *names: str) -> list[str]:
    """Columns of `df` other than these; names count in any case, as Spark resolves them."""
    gone = {name.lower() for name in names}
    return [f"`{column}`" for column in df.columns if column.lower() not in gone]
