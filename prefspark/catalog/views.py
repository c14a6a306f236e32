"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.backends.standin import StandIn, with_digest
from prefspark.constants import CRITERIA, MAX_RETRIES, N_RESPONSES
from prefspark.functions.prompts import critique_prompt
from prefspark.operators.selection import first_n
from prefspark.sources.tables import read_dataset

# Turns of one conversation that meet its instruction in the same task.
TURNS_PER_CHUNK = 4096
# Turn numbers whose answers make one list of responses.
TURNS_PER_LIST = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_dataset(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as instructions, with their other columns."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("record_id"),
        F.col("text").alias("instruction"),
        "lang",
        "source",
        "n_chars",
    )


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("record_id", "instruction")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("record_id"), "quality", "toxic"
    )


def pairs(spark: SparkSession, sf_dir: str, keep: int = N_RESPONSES) -> DataFrame:
    """Per conversation its first user turn and its first `keep` assistant turns."""
    first = first_n(table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn", keep)
    asked = F.when((F.col("role") == "user") & (F.col("rank") == 1), F.col("text"))
    answer = F.when(F.col("role") == "assistant", F.struct("rank", "text"))
    return (
        first.groupBy("conv_id")
        .agg(F.max(asked).alias("instruction"), F.collect_list(answer).alias("answers"))
        .select(
            F.col("conv_id").cast("string").alias("record_id"),
            "instruction",
            F.array_sort("answers")["text"].alias("responses"),
        )
    )


def response_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per assistant turn, next to the instruction of its conversation.

    A conversation without assistant turns gives a row without a response. Long conversations are
    joined in chunks of turns, so that no task gets one whole.
    """
    turns = table(spark, sf_dir, "conversations")
    chunk = F.floor(F.col("turn") / TURNS_PER_CHUNK)
    chunks = turns.select("conv_id", chunk.alias("chunk")).distinct()
    asked = (
        turns.groupBy("conv_id")
        .agg(
            F.min_by(
                F.when(F.col("role") == "user", F.col("text")),
                F.when(F.col("role") == "user", F.col("turn")),
            ).alias("instruction"),
        )
        .join(chunks, "conv_id")
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", chunk.alias("chunk"), "turn", F.col("text").alias("response")
    )
    return asked.join(answered, ["conv_id", "chunk"], "left").select(
        F.col("conv_id").cast("string").alias("record_id"), "turn", "instruction", "response"
    )


def response_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All assistant turns as lists of responses, in lists of bounded length: a conversation has one
    row for each TURNS_PER_LIST turn numbers among which it has an answer, and one at least."""
    turns = response_turns(spark, sf_dir)
    answer = F.when(F.col("response").isNotNull(), F.struct("turn", "response"))
    part = F.floor(F.coalesce("turn", F.lit(0)) / TURNS_PER_LIST).alias("part")
    return (
        turns.groupBy("record_id", part)
        .agg(F.min("instruction").alias("instruction"), F.array_sort(F.collect_list(answer)).alias("a"))
        .select("record_id", "part", "instruction", F.col("a.response").alias("responses"))
    )


def _gaps(docs: DataFrame, gap: Column) -> DataFrame:
    """A further row, with an id of its own, for each document of these languages."""
    return docs.filter(F.col("lang").isin("fr", "es", "de") | (F.col("source") == "src0")).select(
        F.concat(F.lit("gap "), F.col("record_id")).alias("record_id"), gap
    )


def with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instructions, and further ones that are null, empty or blank."""
    docs = documents(spark, sf_dir)
    text = (
        F.when(F.col("lang") == "fr", F.lit(None).cast("string"))
        .when(F.col("lang") == "es", F.lit(""))
        .otherwise(F.lit("  "))
    )
    return docs.select("record_id", "instruction").unionByName(_gaps(docs, text.alias("instruction")))


def with_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instructions, of which those in English have no id and the others share a few; and as many rows as
    the first source has that are equal to each other."""
    docs = documents(spark, sf_dir)
    shared = F.when(F.col("lang") != "en", (F.col("record_id").cast("long") % 10).cast("string"))
    equal = docs.filter(F.col("source") == "src0").select(
        F.lit(None).cast("string").alias("record_id"), F.lit("equal").alias("instruction")
    )
    return docs.select(shared.alias("record_id"), "instruction").unionByName(equal)


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON line per document, and further ones without a text or cut short."""
    docs = documents(spark, sf_dir)
    record, text = F.col("record_id"), F.col("instruction")
    gap_id = F.concat(F.lit("gap "), record).alias("record_id")
    line = (
        F.when(F.col("source") == "src0", F.lit('{"instruction": "'))
        .when(F.col("lang") == "fr", F.to_json(F.struct(gap_id, F.col("n_chars").alias("instruction"))))
        .when(F.col("lang") == "es", F.to_json(F.struct(gap_id)))
        .otherwise(F.to_json(F.struct(gap_id, F.array("n_chars").alias("instruction"))))
    )
    whole = docs.select("record_id", F.to_json(F.struct(record, text)).alias("value"))
    return whole.unionByName(_gaps(docs, line.alias("value")))


def done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instructions already answered: those labelled as good."""
    good = labels(spark, sf_dir).filter(F.col("quality") == 1).select("record_id")
    return instructions(spark, sf_dir).join(good, "record_id", "left_semi")


def earlier_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output of an earlier run over the labelled documents; calls for toxic ones failed."""
    failed = F.col("toxic") == 1
    return (
        instructions(spark, sf_dir)
        .join(labels(spark, sf_dir), "record_id")
        .select(
            "record_id",
            "instruction",
            F.when(~failed, F.array("instruction")).alias("responses"),
            F.when(failed, F.lit("TimeoutError: no reply")).alias("error"),
        )
    )


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refinement log of an earlier run, over all labelled documents."""
    text = F.col("instruction")
    responses = F.array(with_digest(text, "a:"), with_digest(text, "b:"))
    labelled = instructions(spark, sf_dir).join(
        labels(spark, sf_dir).select("record_id"), "record_id", "left_semi"
    )
    return labelled.select(
        "record_id",
        "instruction",
        responses.alias("responses"),
        StandIn().critique(text, text)["text"].alias("feedback"),
        text.alias("original_instruction"),
        responses.alias("original_responses"),
        F.concat(F.lit("["), F.col("record_id"), F.lit("] "), text).alias("refined_instruction"),
        F.array(with_digest(text, "c:"), with_digest(text, "d:")).alias("refined_responses"),
        F.lit(0).alias("round"),
    )


def partly_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of which those labelled as bad carry an original."""
    text = F.col("instruction")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False))
    return (
        instructions(spark, sf_dir)
        .join(labels(spark, sf_dir), "record_id", "left")
        .select(
            "record_id",
            F.when(bad, with_digest(text)).otherwise(text).alias("instruction"),
            F.array(with_digest(text, "a:")).alias("responses"),
            F.when(bad, text).alias("original_instruction"),
            F.when(bad, F.array(with_digest(text, "b:"))).alias("original_responses"),
        )
    )


def rubric_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rubric block per document, deformed in one of eighteen ways by two digits of its digest."""
    text = F.col("instruction")
    block = F.col("block")
    lines = F.split(block, "\n")
    turned = F.concat(
        F.lit("Evaluation:\n"),
        F.array_join(F.reverse(F.slice(lines, 2, len(CRITERIA))), "\n"),
    )
    variants = [
        block,
        F.replace(block, F.lit("Evaluation:"), F.lit("evaluation:")),
        F.concat(F.lit("Here it is.\n"), block, F.lit("\nThat is all.")),
        F.replace(block, F.lit("Safety:"), F.lit("Safety :")),
        F.concat(block, F.lit("\n* Clarity: 9/5 - more")),
        F.concat(block, F.lit("\n* Tone: 3/5 - more")),
        F.concat(block, F.lit("\n* Clarity: 1/5 - more")),
        F.replace(block, F.lit("* Safety"), F.lit("- Safety")),
        F.regexp_replace(block, "Clarity: [1-5]/5", "Clarity: 6/5"),
        F.lit(""),
        F.replace(block, F.lit("\n"), F.lit("\r\n")),
        F.replace(block, F.lit("note on Safety"), F.lit("")),
        turned,
        F.replace(block, F.lit("* "), F.lit("*  ")),
        F.replace(block, F.lit("\n"), F.lit("\n   ")),
        F.concat(block, F.lit("\nEvaluation:")),
        F.concat(block, F.lit("\n* Qualité: 3/5 - more")),
        F.replace(block, F.lit("\n"), F.lit("\r")),
    ]
    number = F.conv(F.substring(F.md5(text), 31, 2), 16, 10).cast("int") % len(variants)
    chosen = F.lit(None)
    for place, variant in enumerate(variants):
        chosen = F.when(F.col("number") == place, variant).otherwise(chosen)
    return (
        instructions(spark, sf_dir)
        .withColumns({"block": StandIn().critique(text, text)["text"], "number": number})
        .select("record_id", chosen.alias("feedback"))
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged critique attempts, of which some are unreadable and some raised."""
    text = F.col("instruction")
    backend = StandIn(flaky=True)
    replies = [
        F.struct(
            F.lit(k).alias("attempt"),
            backend.critique(text, critique_prompt(text), k).alias("reply"),
        )
        for k in range(1, MAX_RETRIES + 1)
    ]
    return (
        instructions(spark, sf_dir)
        .select("record_id", F.inline(F.array(*replies)))
        .select(
            "record_id",
            "attempt",
            F.col("reply.text").alias("feedback"),
            F.col("reply.error").alias("error"),
        )
    )
