"""Quality reports: rubric scores of instructions and reward scores of responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.backends.base import Backend
from prefspark.constants import EXCEPTION_PREFIX, MAX_RETRIES, N_RESPONSES, PARSE_FAILURE
from prefspark.functions.prompts import critique_prompt
from prefspark.functions.rubric import parse_rubric, rubric_mean
from prefspark.functions.scores import mean_or_zero, total
from prefspark.operators.inference import score_responses, spread
from prefspark.schemas import RUBRIC


def text_field(lines: DataFrame, field: str, column: str = "value") -> DataFrame:
    """JSON lines with the field's text under its name, null where it is absent or not a string.

    A typed read would turn a number into a string, so the type is taken from the raw line.
    """
    value = F.variant_get(F.try_parse_json(F.col(column)), f"$.{field}", "variant")
    is_text = F.schema_of_variant(F.col("_value")) == "STRING"
    text = F.when(is_text, F.try_variant_get("_value", "$", "string"))
    return lines.withColumn("_value", value).withColumn(field, text).drop("_value")


def first_valid_attempt(attempts: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Per record the first of its first `max_retries` attempts that can be read, or its failure.

    An attempt that raised ends its record unless a readable one came before it.
    """
    parsed = F.when(F.col("error").isNull(), parse_rubric(F.col("feedback")))
    # An attempt that settles nothing has no place in the order. Filtering such attempts out instead
    # would move the filter below the projection and read every rubric twice.
    settles = F.col("feedback_json").isNotNull() | F.col("error").isNotNull()
    place = F.when(settles, F.col("attempt"))
    return (
        attempts.filter(F.col("attempt") <= max_retries)
        .withColumn("feedback_json", parsed)
        .groupBy("record_id")
        # An unreadable text is not sent along, as it cannot be the outcome.
        .agg(F.min_by(F.when(settles, F.struct("feedback", "feedback_json", "error")), place).alias("outcome"))
        .filter(F.col("outcome").isNotNull())
        .select("record_id", "outcome.*")
    )


def _failure(parsed: Column, error: Column) -> Column:
    return F.when(error.isNotNull(), F.concat(F.lit(EXCEPTION_PREFIX), error)).when(
        parsed.isNull(), F.lit(PARSE_FAILURE)
    )


def _judged(records: DataFrame) -> DataFrame:
    """Turns `feedback_json` and `_error` into the report columns."""
    return records.withColumns(
        {
            "failure_reason": _failure(F.col("feedback_json"), F.col("_error")),
            "feedback_avg_score": rubric_mean(F.col("feedback_json")),
        }
    ).drop("_error")


def _filter_here(df: DataFrame, condition: Column) -> DataFrame:
    """`df.filter(condition)` that stays where it is.

    A filter moves below the projections its columns come from, and these are then computed twice.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*df.columns)))))


def rubric_report(
    records: DataFrame,
    attempts: DataFrame,
    *,
    max_retries: int = MAX_RETRIES,
    keep_failed: bool = False,
) -> DataFrame:
    """Records with `feedback`, `feedback_json` and `feedback_avg_score` from logged attempts.

    Failed records are dropped, or kept with a `failure_reason`.
    """
    settled = first_valid_attempt(attempts, max_retries)
    outcome = settled.select("record_id", F.struct("feedback", "feedback_json", "error").alias("_outcome"))
    missing = F.col("instruction").isNull()
    # A failed record has no feedback columns, whatever its attempts said. Report columns that the
    # records bring along are replaced; an `error` of theirs is not the report's and stays.
    fine = F.col("_outcome.error").isNull() & ~missing
    joined = records.join(outcome, "record_id", "left").withColumns(
        {
            "feedback": F.when(fine, F.col("_outcome.feedback")),
            "feedback_json": F.when(fine, F.col("_outcome.feedback_json")),
            "_error": F.when(~missing, F.col("_outcome.error")),
        }
    ).drop("_outcome")
    report = _judged(joined)
    if keep_failed:
        return report
    return report.filter(F.col("failure_reason").isNull()).drop("failure_reason")


def rubric_report_live(
    records: DataFrame,
    backend: Backend,
    *,
    max_retries: int = MAX_RETRIES,
    keep_failed: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """As `rubric_report`, with the backend asked again only for records not yet settled.

    All attempts run in one pass over the records: a settled record passes a null prompt on, and a backend
    that can ask again by itself does so where the model is.
    """
    prompt = critique_prompt(F.col("instruction"))
    report = spread(records, partitions).withColumns(
        {
            "feedback": F.lit(None).cast("string"),
            "feedback_json": F.lit(None).cast(RUBRIC),
            "_error": F.lit(None).cast("string"),
        }
    )
    if hasattr(backend, "critique_until"):
        reply = backend.critique_until(F.col("instruction"), prompt, max_retries)
        text, error = F.col("_reply.text"), F.col("_reply.error")
        report = (
            report.withColumn("_reply", reply)
            .withColumn("feedback_json", F.when(error.isNull(), parse_rubric(text)))
            .withColumns(
                {"feedback": F.when(F.col("feedback_json").isNotNull(), text), "_error": error}
            )
            .drop("_reply")
        )
        return _settled_report(report, keep_failed)
    for attempt in range(1, max_retries + 1):
        is_open = F.col("feedback_json").isNull() & F.col("_error").isNull()
        asked = F.when(is_open, prompt)
        report = (
            report.withColumn("_reply", backend.critique(F.col("instruction"), asked, attempt))
            .withColumn("_parsed", F.when(is_open, parse_rubric(F.col("_reply.text"))))
            .withColumns(
                {
                    "feedback": F.when(F.col("_parsed").isNotNull(), F.col("_reply.text")).otherwise(
                        F.col("feedback")
                    ),
                    "feedback_json": F.coalesce("feedback_json", "_parsed"),
                    "_error": F.coalesce("_error", "_reply.error"),
                }
            )
            .drop("_reply", "_parsed")
        )
    return _settled_report(report, keep_failed)


def _settled_report(report: DataFrame, keep_failed: bool) -> DataFrame:
    report = _judged(report)
    if keep_failed:
        return report
    return _filter_here(report, F.col("failure_reason").isNull()).drop("failure_reason")


def reward_report(
    records: DataFrame,
    backend: Backend,
    *,
    max_units: int | None = None,
    measure: str = "units",
    partitions: int | None = None,
) -> DataFrame:
    """Adds `scores` and their mean `avg_score`, 0 for a record without responses.

    With `max_units` conversations are cut as in `score_responses`, and `over_budget` is added.
    """
    scored = score_responses(
        records, backend, max_units=max_units, measure=measure, partitions=partitions
    )
    return scored.withColumn("avg_score", mean_or_zero(F.col("scores")))


def reward_mean(report: DataFrame, n_responses: int = N_RESPONSES) -> DataFrame:
    """One row `avg_score`: all scores over `n_responses` per record, 0 for no records."""
    return _dataset_mean(
        report.select(total(F.col("scores")).alias("total")), n_responses
    )


def reward_mean_per_record(report: DataFrame) -> DataFrame:
    """(record_id, avg_score) for a report whose records may have several rows, each with a list."""
    lists = report.select("record_id", total(F.col("scores")).alias("total"), F.size("scores").alias("n"))
    summed = lists.groupBy("record_id").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    mean = F.try_divide(F.col("total"), F.col("n"))
    return summed.select("record_id", F.coalesce(mean, F.lit(0.0)).alias("avg_score"))


def reward_mean_of_lists(report: DataFrame, n_responses: int = N_RESPONSES) -> DataFrame:
    """`reward_mean` for a report whose records may have several rows, each with a list."""
    lists = report.select("record_id", total(F.col("scores")).alias("total"))
    return _dataset_mean(lists.groupBy("record_id").agg(F.sum("total").alias("total")), n_responses)


def _dataset_mean(totals: DataFrame, n_responses: int) -> DataFrame:
    summed = totals.agg(F.sum("total").alias("total"), F.count("*").alias("n"))
    mean = F.try_divide(F.col("total"), F.col("n") * n_responses)
    return summed.select(F.coalesce(mean, F.lit(0.0)).alias("avg_score"))


def reward_per_record(scored: DataFrame) -> DataFrame:
    """`reward_report` for rows of one response each: (record_id, n_responses, total, avg_score).

    Sums are combined before the shuffle, so a record with very many responses is no heavier than
    any other. A record without responses comes as a row without a score.
    """
    return (
        scored.groupBy("record_id")
        .agg(F.count("score").alias("n_responses"), F.sum("score").alias("total"))
        .select(
            "record_id",
            "n_responses",
            F.coalesce("total", F.lit(0.0)).alias("total"),
            F.coalesce(F.try_divide("total", "n_responses"), F.lit(0.0)).alias("avg_score"),
        )
    )


def reward_mean_per_response(scored: DataFrame, n_responses: int = N_RESPONSES) -> DataFrame:
    """`reward_mean` for rows of one response each."""
    return _dataset_mean(reward_per_record(scored).select("total"), n_responses)
