"""A quality classifier learned from trusted positives and unlabelled text.

The model is logistic over measures of the whole text. It minimises the non-negative risk estimate of
positive-unlabelled learning

    J(w) = prior R_p(+) + max(0, R_u(-) - prior R_p(-)) + l2 |w|^2 / 2

where R_p is over texts labelled as good and R_u over all texts of the training fold, whatever their
label. When the bracket is negative the step goes the other way, as it then shows overfitting. Labels of
texts that are not good are never read.

The class prior is estimated from the same two sets. A first model is learned with PRIOR for the prior. Above
any bound on its scores lies some share of the unlabelled texts and some share of the good ones, and as the
latter are among the former, their ratio is at least the prior; where only good texts are left above the
bound, it is the prior. The estimate is the least ratio, each taken with the error that its numbers of
texts allow for, over rows that the first model did not learn from. The final model is learned with it.

Every step is one Spark job over all training rows; each task sends its sums (a number per weight and pair of
weights) as one row, and these are added up in two steps.

Defined results
* A null or empty text has all measures zero and gets the score of those.
* A document counts as trusted if all its labels are 1; labels that are null are ignored.
* Without labels, or without texts to learn from, every score is 0.5.
* Repeated rows get equal rows. An empty table gives an empty result.
* Output columns replace input columns of the same name; other columns are carried and never read.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import without, written

STEPS = 12
L2 = 1e-3
#: The prior of the first model, and of a model without labels.
PRIOR = 0.5
#: The chance of an error beyond what the estimate of the prior allows for, and its bound.
ERROR, LEAST_PRIOR = 0.1, 0.01
_UPPER, _LOWER = range(65, 91), range(97, 123)
_CLASSES = {
    "digits": range(48, 58), "stops": b".", "commas": b",", "shouts": b"!?", "bars": b"|",
    "signs": b"#*$%&<>", "marks": b"\"'();:-_/\\[]{}=+@^`~",
}


def measures(text: str | None) -> np.ndarray:
    """Ratios of a text; most are between 0 and 1."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return np.zeros(15)
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    upper, letters = seen[_UPPER].sum(), seen[_UPPER].sum() + seen[_LOWER].sum()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    size = sum(map(len, words))
    values = [
        np.log1p(n) / 12, min(size / n / 12, 3.0), len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n, (len(lines) - len(set(lines))) / len(lines),
        len(lines) / n, upper / max(letters, 1), seen[128:].sum() / len(raw),
    ]
    for chars in _CLASSES.values():
        values.append(seen[list(chars)].sum() / n)
    return np.array(values)


def features(text: str | None) -> np.ndarray:
    """The measures, and each of them at three finer scales, so that a linear model can bend."""
    x = np.minimum(measures(text), 4.0)
    return np.concatenate(([1.0], x, np.sqrt(x), np.minimum(1, 5 * x), np.minimum(1, 40 * x))).astype(np.float32)


WIDTH = len(features(None))


def _logistic(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -z)


def _sums(rows: np.ndarray, trusted: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What one step needs of these rows, as one vector."""
    x = rows.astype(np.float64)
    g = x @ weights
    p = _logistic(g)
    good = x[trusted]
    curve = (x * (p * (1 - p))[:, None]).T @ x
    return np.concatenate((
        [len(x), len(good), _loss(-g).sum(), _loss(g[trusted]).sum(), _loss(-g[trusted]).sum()],
        p @ x, (p[trusted] - 1) @ good, p[trusted] @ good, curve.ravel(),
    ))


@dataclass(frozen=True)
class QualityModel:
    weights: tuple[float, ...]
    prior: float

    def _scores(self, text: Column) -> Column:
        weights = np.array(self.weights)

        def of(texts: pd.Series) -> pd.Series:
            g = np.array([features(t) @ weights for t in texts], dtype=float)
            return pd.Series(_logistic(g))

        return F.pandas_udf(of, "double")(text)

    def score(self, docs: DataFrame, *, text_col="text", name="score") -> DataFrame:
        """The documents with their score: the probability of being good."""
        return docs.select(*without(docs, name), self._scores(F.col(text_col)).alias(name))

    def accepted(self, docs: DataFrame, *, text_col="text", least=0.5) -> DataFrame:
        """The documents whose score is at least `least`, with their own columns alone."""
        scored = docs.select(F.struct("*").alias("doc"), self._scores(F.col(text_col)).alias("score"))
        return scored.where(F.col("score") >= least).select("doc.*")


def fit(
    docs: DataFrame, labels: DataFrame, *, train: Column | None = None, prior: float | None = None, steps=STEPS, l2=L2,
    id_col="doc_id", text_col="text", label_col="quality",
) -> QualityModel:
    """Learns from the rows of `docs` for which `train` holds (all if not given); estimates `prior` if it is
    not given."""
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.min(F.col(label_col).cast("int")).alias("__good")
    ).where("__good = 1")
    rows = docs if train is None else docs.where(train)
    rows = rows.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], ["__id", "x"])

    kind = dict(rows.dtypes)["__id"]
    # Measures are taken first, so that the join moves them and not the texts.
    measured = written(rows.mapInArrow(extract, f"__id {kind}, x binary"), "quality-features")
    data = written(measured.join(marks, "__id", "left").select("x", "__good"), "quality-rows")
    if not data.where("__good = 1").limit(1).count():
        return QualityModel((0.0,) * WIDTH, PRIOR)
    if prior is None:
        # Equal rows fall into the same half, so that none is both learned from and counted.
        half = F.pmod(F.xxhash64("x"), F.lit(2))
        learned, counted = data.where(half == 0), data.where(half == 1)
        if not learned.where("__good = 1").limit(1).count():
            learned = counted = data
        prior = estimate_prior(counted, _minimise(learned, PRIOR, steps, l2))
    return QualityModel(tuple(_minimise(data, prior, steps, l2).tolist()), prior)


def _minimise(data: DataFrame, prior: float, steps: int, l2: float) -> np.ndarray:
    """The weights with the least risk that the steps came to."""
    weights, best = np.zeros(WIDTH), (np.inf, np.zeros(WIDTH))
    for _ in range(steps):
        total = _added(data.mapInArrow(_step_sums(weights), _SUMS), 5 + 3 * WIDTH + WIDTH * WIDTH)
        n, n_good, u_minus, p_plus, p_minus = total[:5]
        u_grad, plus_grad, minus_grad = (total[5 + k * WIDTH : 5 + (k + 1) * WIDTH] for k in range(3))
        curve = total[5 + 3 * WIDTH :].reshape(WIDTH, WIDTH) / n
        rest = u_minus / n - prior * p_minus / n_good
        risk = prior * p_plus / n_good + max(0.0, rest) + l2 / 2 * weights @ weights
        if risk < best[0]:
            best = risk, weights.copy()
        rest_grad = u_grad / n - prior * minus_grad / n_good
        if rest >= 0:
            gradient = prior * plus_grad / n_good + rest_grad + l2 * weights
        else:
            gradient = -rest_grad
        # The curvature of the unlabelled part scales the step, as in Newton's method.
        move = np.linalg.solve(curve + (l2 + 1e-6) * np.eye(WIDTH), gradient)
        weights = weights - move * min(1.0, 8.0 / max(np.abs(move).max(), 1e-9))
    return best[1]


def estimate_prior(data: DataFrame, weights: np.ndarray, bins: int = 1000) -> float:
    """The share of good ones among all rows, by the scores of a model that need not be calibrated."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * bins)
        for batch in batches:
            x, good = _rows(batch)
            place = np.minimum(_logistic(x.astype(float) @ weights) * bins, bins - 1).astype(np.int64)
            total[:bins] += np.bincount(place, minlength=bins)
            total[bins:] += np.bincount(place[good], minlength=bins)
        yield _sum_row(total)

    total = _added(data.mapInArrow(count, _SUMS), 2 * bins)
    everything, good = (np.cumsum(part[::-1]) for part in (total[:bins], total[bins:]))
    return prior_bound(everything, good)


def prior_bound(everything: np.ndarray, good: np.ndarray) -> float:
    """From how many of all rows and of the good ones lie above each bound (the last one: all of them)."""
    n, n_good = everything[-1], good[-1]
    if not n or not n_good:
        return PRIOR
    share, of_good = everything / n, good / n_good
    error = np.sqrt(np.log(4 / ERROR) / 2) * (1 / np.sqrt(n) + 1 / np.sqrt(n_good))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(of_good > 0, share / of_good, np.inf)
        # Few good ones above the bound make its ratio uncertain.
        most = np.where(of_good > 0, (share + error) / of_good, np.inf)
    return float(np.clip(ratio[np.argmin(most)], LEAST_PRIOR, 1 - LEAST_PRIOR))


#: A task's sums: one row.
_SUMS = "task long, sums binary"
COMBINED = 64


def _sum_row(total: np.ndarray) -> pa.RecordBatch:
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["task", "sums"])


def _added(parts: DataFrame, width: int) -> np.ndarray:
    """The tasks' sums added up, by groups of tasks and then over the groups."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return group.iloc[:1].assign(sums=sum(np.frombuffer(s) for s in group["sums"]).tobytes())

    few = parts.withColumn("task", F.floor(F.col("task") / COMBINED)).groupBy("task").applyInPandas(add, _SUMS)
    rows = few.collect()  # one row for COMBINED tasks
    return sum((np.frombuffer(r.sums) for r in sorted(rows, key=lambda r: r.task)), np.zeros(width))


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.float32).reshape(-1, WIDTH)
    return x, batch.column(1).fill_null(0).to_numpy(zero_copy_only=False) == 1


def _step_sums(weights: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(5 + 3 * WIDTH + WIDTH * WIDTH)
        for batch in batches:
            total += _sums(*_rows(batch), weights)
        yield _sum_row(total)

    return add


def classify(docs: DataFrame, labels: DataFrame, *, held_out: Column | None = None, **options) -> DataFrame:
    """The documents with `score` and `predicted` (1 if the score is 0.5 or more)."""
    model = fit(docs, labels, train=None if held_out is None else ~held_out, **options)
    scored = model.score(docs, text_col=options.get("text_col", "text"))
    return scored.select(*without(scored, "predicted"), (F.col("score") >= 0.5).cast("int").alias("predicted"))
