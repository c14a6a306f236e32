"""Whitening of embeddings by a weighted covariance of distinct vectors.

Entries become whole numbers x, and equal x vectors are grouped: a distinct vector carries its count (or
one) as fit weight. Spark sums the weighted vectors, then, centred by the exact mean, their weighted
products: each task multiplies its matrix of vectors once and sends one row per dimension, combined in two
steps. The driver holds a matrix of dimension x dimension and finds its eigenvectors. Each distinct vector
is whitened once, and rows meet the result of their vector in a join.

Rows are joined by a digest of their vector. A vector that HOT of the rows or more share has its result
broadcast, for there are at most 1 / HOT such vectors; all others meet in a join by hash.

Defined results
* A row whose vector is null or empty, or holds a null, a NaN, an infinity or an entry that a whole number
  of 53 bits can't hold, is left out of the fit and of the result; so is one whose length is not the
  commonest (of equally common ones the greatest).
* A repeated row, or a row without an id, is a row of its own, in the fit and in the result.
* A component whose variance is nil (at most 1e-12 of the total) is not returned, so equal vectors alone,
  and a single row, have no components and no rows. No rows give no rows.
* `deviation` is exact, and null where it is above the largest long.
* Further columns are ignored; those asked for by `keep` are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: A vector with this share of the rows or more is hot.
HOT = 0.001
#: Tasks whose sums are combined by one task in the first of two steps.
COMBINED = 64
_NIL = 1e-12
_LARGEST = 2**63 - 1


def whole_numbers(embedding: Column, scale=SCALE, shift=SHIFT) -> Column:
    """x for each entry, as array<long>; null for a vector that is left out."""
    fine = F.forall(embedding, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < (2.0**53 - shift) / scale))
    numbers = F.transform(embedding, lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long"))
    # A NaN counts as greater than any number.
    return F.when(fine & (F.size(embedding) > 0), numbers)


def _bytes(x: Column) -> Column:
    """An array<long> as its bytes, so that vectors are grouped and sent as one short value."""

    @F.arrow_udf("binary")
    def pack(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<i8", copy=False)
        ends = lists.offsets.to_numpy()
        gone = lists.is_null().to_pylist()
        raw = memoryview(np.ascontiguousarray(flat)).cast("B") if len(flat) else b""
        base = int(ends[0]) if len(ends) else 0
        return pa.array(
            [None if gone[k] else bytes(raw[8 * (int(ends[k]) - base) : 8 * (int(ends[k + 1]) - base)]) for k in range(len(lists))],
            pa.binary(),
        )

    return pack(x)


def _matrix(batch: pd.DataFrame, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch["x"]), dtype="<i8").reshape(-1, dim)


def _combined(parts: DataFrame, columns: str, add: Callable[[pd.DataFrame], pd.DataFrame]) -> list:
    """Rows (task, place, ...) added up by place, in two steps so that no group grows with the tasks."""
    few = parts.withColumn("task", F.floor(F.col("task") / COMBINED)).groupBy("task", "place").applyInPandas(add, columns)
    return few.groupBy("place").applyInPandas(add, columns).collect()


@dataclass(frozen=True)
class Whitening:
    """A fit. Components are the columns of `axes`, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - S)^2, null where no long holds them."""
        sums = np.array(self.sums, dtype=object)
        reach = max((self.n * max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0), *map(abs, self.sums))
        if reach < 2**61 and x.size:
            gaps = self.n * x - np.array(self.sums, dtype=np.int64)
            rough = (gaps.astype(float) ** 2).sum(axis=1)
            if rough.max() < 0.9 * _LARGEST:
                return (gaps**2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - sums) ** 2).sum(axis=1)
        return [int(d) if d <= _LARGEST else None for d in exact]

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.axes / np.sqrt(self.eigenvalues)


def distinct_vectors(rows: DataFrame, *, multiplicity=True) -> DataFrame:
    """The written table of distinct vectors: x, weight (how many rows have it, or one), rows."""
    counted = rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows"))
    weight = F.col("rows") if multiplicity else F.lit(1).cast("long")
    return written(counted.select("x", weight.alias("weight"), "rows", F.md5("x").alias("digest")), "distinct-vectors")


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors by their weights; None where there is no variance."""
    first = distinct.select(F.octet_length("x").alias("size")).first()
    if first is None:
        return None
    dim = first["size"] // 8

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        totals, n = [0] * dim, 0
        for batch in batches:
            # Python's whole numbers can't overflow; a batch's sums are taken exactly in two halves.
            x, w = _matrix(batch, dim), batch["weight"].to_numpy(np.int64)
            high, low = w @ (x >> 26), w @ (x & (2**26 - 1))
            totals = [t + (int(h) << 26) + int(s) for t, h, s in zip(totals, high, low, strict=True)]
            n += int(w.sum())
        task = TaskContext.get().partitionId()
        yield pd.DataFrame([(task, k, str(t)) for k, t in enumerate([*totals, n])], columns=["task", "place", "total"])

    def add_totals(group: pd.DataFrame) -> pd.DataFrame:
        return group.iloc[:1].assign(total=str(sum(map(int, group["total"]))))

    columns = "task long, place int, total string"
    told = {r.place: int(r.total) for r in _combined(distinct.select("x", "weight").mapInPandas(sum_up, columns), columns, add_totals)}
    n, sums = told.pop(dim), tuple(told[k] for k in range(dim))
    mean = np.array([total / n for total in sums])

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = np.zeros((dim, dim))
        for batch in batches:
            centred = _matrix(batch, dim) - mean
            total += centred.T @ (centred * batch["weight"].to_numpy(float)[:, None])
        task = TaskContext.get().partitionId()
        yield pd.DataFrame([(task, k, total[k].tobytes()) for k in range(dim)], columns=["task", "place", "products"])

    def add_products(group: pd.DataFrame) -> pd.DataFrame:
        return group.iloc[:1].assign(products=sum(np.frombuffer(p) for p in group["products"]).tobytes())

    columns = "task long, place int, products binary"
    told = _combined(distinct.select("x", "weight").mapInPandas(multiply, columns), columns, add_products)
    covariance = np.stack([np.frombuffer(r.products) for r in sorted(told, key=lambda r: r.place)]) / n
    trace = float(np.trace(covariance))
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    order = [k for k in np.argsort(values)[::-1][:components] if values[k] > _NIL * trace]
    if not order:
        return None
    return Whitening(n, sums, axes[:, order], values[order], trace)


def _whitened(distinct: DataFrame, model: Whitening) -> DataFrame:
    """The written table of distinct vectors' results: digest, rows, weight, deviation, whitened."""
    dim = len(model.sums)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch, dim)
            yield pd.DataFrame(
                {
                    "digest": batch["digest"], "rows": batch["rows"], "weight": batch["weight"],
                    "deviation": pd.array(model.deviations(x), dtype="Int64"), "whitened": list(model.project(x)),
                }
            )

    schema = "digest string, rows long, weight long, deviation long, whitened array<double>"
    return written(distinct.mapInPandas(run, schema), "whitened")


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity."""
    y, w = [F.col("whitened")[k] for k in range(components)], F.col("weight")
    means = whitened.agg(*[(F.sum(w * v) / n).alias(f"m{k}") for k, v in enumerate(y)]).first()
    centred = [v - F.lit(m) for v, m in zip(y, means, strict=True)]
    places = [(a, b) for a in range(components) for b in range(a, components)]
    products = whitened.agg(*[(F.sum(w * centred[a] * centred[b]) / n).alias(f"v{a}_{b}") for a, b in places]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(products, places, strict=True))


def whiten(
    vectors: DataFrame, *, components: int = COMPONENTS, multiplicity=True, scale=SCALE, shift=SHIFT,
    embedding_col="embedding", keep: list[str] | None = None,
) -> DataFrame:
    """One row per remaining row of `vectors`: `row` (the columns `keep`, or all) and `result` (n, deviation,
    whitened, explained, identity_error); the latter's arrays have an entry per component.

    `multiplicity` tells whether a vector weighs as often as it occurs in the fit, or once.
    """
    columns = vectors.columns if keep is None else keep
    x = whole_numbers(F.col(embedding_col), scale, shift)
    taken = vectors.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), x.alias("x")).where("x is not null")
    lengths = taken.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    dim = (lengths.agg(F.max(F.struct("n", "dim")).alias("most")).first()["most"] or {"dim": 0})["dim"]
    packed = taken.where(F.size("x") == dim).select("row", _bytes(F.col("x")).alias("x"))
    distinct = distinct_vectors(packed.select("x"), multiplicity=multiplicity)
    model = fit(distinct, components)
    result = "struct<n: long, deviation: long, whitened: array<double>, explained: array<double>, identity_error: double>"
    if model is None:
        return vectors.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.lit(None).cast(result).alias("result")).where(F.lit(False))
    found = _whitened(distinct, model)
    error = identity_error(found, model.n, len(model.eigenvalues))
    n_rows = found.agg(F.sum("rows")).first()[0]
    each = F.struct(
        F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(float(e)) for e in model.explained]).alias("explained"), F.lit(error).alias("identity_error"),
    )
    told = found.select("digest", "rows", each.alias("result"))
    rows = written(packed.select("row", F.md5("x").alias("digest")), "vector-digests")
    # At most 1 / HOT vectors can be hot, so what is broadcast has a bound.
    is_hot = F.col("rows") >= HOT * n_rows
    hot = told.where(is_hot).select("digest", F.col("result").alias("hot"))
    met = rows.join(F.broadcast(hot), "digest", "left")
    rest = met.where("hot is null").select("row", "digest").join(told.where(~is_hot), "digest")
    return met.where("hot is not null").select("row", F.col("hot").alias("result")).unionByName(rest.select("row", "result"))
