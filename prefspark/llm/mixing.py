"""Mixing sources to target weights.

The words of every source are summed, targets follow from the weights, and a source's repetition rate
is its target over its size. Each document is emitted floor(rate) times, and once more with a
probability equal to the fraction, decided by a hash of its id and text.

Defined results
* A null or empty text has size 0. A source whose size is 0 has target 0 and gives nothing.
* A null source is a source of its own, last in the order. Repeated rows are documents of their own;
  rows that are equal in id and text share the outcome of the draw.
* An empty table gives an empty mix. Further columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import content_hash, word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
SEED = 42


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT) -> DataFrame:
    """(source, source_size) -> the same with `target` and `rate`.

    Weights are dealt to the sources in code-point order. A source's target is its part of
    share x all sizes, but at most limit x its size; what is cut goes to the others by weight until
    none is above. That ends where targets are min(limit x size, weight x level): in the order of
    limit x size / weight the sources that are cut come first, so one running sum finds the level.
    The table has one row per source, so that its windows need no partition.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rank = F.row_number().over(named) - 1
    dealt = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighted = sizes.select(
        "source", "source_size", dealt.alias("weight"), (F.col("source_size") * limit).alias("most")
    )
    order = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    cut = weighted.withColumn(
        "cut", F.col("most") * F.sum("weight").over(onward) <= left * F.col("weight")
    )
    level = (
        share * F.sum("source_size").over(everything)
        - F.coalesce(F.sum(F.when(F.col("cut"), F.col("most"))).over(everything), F.lit(0.0))
    ) / F.sum(F.when(~F.col("cut"), F.col("weight"))).over(everything)
    target = F.when(F.col("cut"), F.col("most")).otherwise(F.least("most", F.col("weight") * level))
    return cut.select("source", "source_size", target.alias("target")).withColumn(
        "rate",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
    )


def _draw(record_id: Column, text: Column, seed: int) -> Column:
    """A uniform number in [0, 1) of 52 bits."""
    bits = F.conv(F.substring(content_hash(record_id, text, seed), 1, 13), 16, 10)
    return bits.cast("double") / float(16**13)


def with_copies(
    docs: DataFrame, *, weights=WEIGHTS, share=SHARE, limit=LIMIT, seed=SEED,
    id_col="doc_id", text_col="text", source_col="source",
) -> DataFrame:
    """One row per document: `doc` (all its columns), `mix` (size, source_size, target, copies).

    The table of sources is written, so Spark knows its size and broadcasts it if it is small; if it
    is not, the join is one that adaptive execution splits at hot sources.
    """
    sized = docs.select(
        F.struct("*").alias("doc"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(written(sizes, "mix-sizes"), weights, share, limit), "mix-targets")
    targets = targets.withColumnRenamed("source", "of_source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
    whole = F.floor("rate")
    draw = _draw(F.col(f"doc.{id_col}"), F.col(f"doc.{text_col}"), seed)
    copies = whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0)
    return joined.select(
        "doc", F.struct("size", "source_size", "target", copies.cast("long").alias("copies")).alias("mix")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: the columns of `docs`, each row as often as the mix takes it."""
    taken = with_copies(docs, **options).where("mix.copies > 0")
    each = F.explode(F.sequence(F.lit(1), F.col("mix.copies"))).alias("copy")
    return taken.select("doc", each).select("doc.*")
