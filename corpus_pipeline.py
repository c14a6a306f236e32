"""The corpus pipeline: five stages over `documents`, each written and read again before the next.

Defined results of the stages, beyond those of their operators
* Null and empty texts are scored and compared like others; a document that is kept keeps all its columns.
* Rows that repeat an id and a text are one document from the second stage on; rows that repeat an id alone
  are documents of their own, and rows without an id stay, if their texts do.
* Without documents every stage gives none. Further columns, whatever their names, are carried as they are,
  but for the columns that the last stage adds, which replace those of their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prefspark.llm import decontamination, mixing, quality, sharding, simhash
from prefspark.llm.common import table, tables_dropped, written
from prefspark.sources.tables import drop_table

#: Near copies share five-word shingles to a Jaccard similarity of at least 0.8, which is confirmed by the
#: shingles; fingerprints within 7 bits are candidates beside those of the MinHash bands.
NEAR_SHINGLE, NEAR_BITS, NEAR_SIMILARITY = 5, 7, 0.8


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, accepts."""
    return quality.fit(docs, table(spark, sf_dir, "labels")).accepted(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.near_dedup(docs, shingle=NEAR_SHINGLE, max_bits=NEAR_BITS, similarity=NEAR_SIMILARITY)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def sharding_by_size(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.assign(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding_by_size),
]

#: Fits and fingerprints are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's documents. A stage's own tables go when it is written, and its input with them."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with tables_dropped(spark) as made:
            after = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            result = made.pop()  # the folder made last
        if before is not None:
            drop_table(spark, before)
        docs, before = after, result
    return docs
