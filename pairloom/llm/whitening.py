"""Whitening of embeddings by polarisation.

Entries become whole numbers, x = floor(scale * entry). The covariance of two
dimensions is found from variances alone: 2 cov(a, b) = var(a + b) - var(a) -
var(b). So tasks square and sum every dimension and every sum of two dimensions,
centred by the rounded mean; what is left of the mean, at most one half, is taken
off in whole numbers afterwards. All sums are exact. One number per pair of
dimensions reaches the driver, where `eigh` finds the components.

Only distinct x vectors are fitted, each once, so a vector that a third of the
rows repeat weighs as one; repeats are combined before the shuffle.

Rows whose vector is null, or holds a null or an entry that isn't finite, are left
out. A shorter vector counts as one with zeros at its end. Repeated rows and ids
stay rows of their own, a null id too. Components without variance (fewer than
two distinct vectors, dependent dimensions) are not returned, and neither is any
row then if none is left. An empty table gives an empty result. Columns that
aren't asked for are ignored, whatever their names. An entry of 2**36 or more in
size, or 2**63 in `deviation` where the caller wants a long, is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import checkpointed

#: Entries below this, times a scale of 256, keep every product within what `_squares` splits.
_LARGEST = 2.0**36
_HALF = 24
_LONG = 2**62


def _whole(entry: Column, scale: int) -> Column:
    fits = F.abs(entry) < _LARGEST
    return F.when(fits, F.floor(entry * scale)).otherwise(F.raise_error(F.lit("vector entry out of range")).cast("bigint"))


def scaled_vectors(vectors: DataFrame, column: str = "embedding", keep: tuple[str, ...] = ("vec_id",), scale: int = 256) -> DataFrame:
    """`keep + __x` of the rows whose vector is whole and finite; all `__x` are of one length."""
    entries = F.col(column).cast("array<double>")
    # Neither null, NaN nor infinite.
    sound = F.forall(entries, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    rows = vectors.where(F.coalesce(sound, F.lit(False))).select(
        *keep, F.transform(entries, lambda c: _whole(c, scale)).alias("__x")
    )
    least, most = rows.agg(F.min(F.size("__x")), F.max(F.size("__x"))).head()
    if least == most:
        return rows
    zeros = F.array_repeat(F.lit(0).cast("bigint"), most - F.size("__x"))
    return rows.withColumn("__x", F.concat("__x", zeros))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("__x")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def _squares(w: np.ndarray) -> list[int]:
    """The exact sum of squares of each column; a batch has at most 2**14 rows."""
    sums = lambda a, b: np.einsum("ij,ij->j", a, b).tolist()
    if np.abs(w).max(initial=0) < 1 << _HALF:
        return sums(w, w)
    high, low = w >> _HALF, w & ((1 << _HALF) - 1)
    return [
        (a << 2 * _HALF) + (b << _HALF + 1) + c for a, b, c in zip(sums(high, high), sums(high, low), sums(low, low))
    ]


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


@dataclass(frozen=True)
class Whitening:
    """The fit: `n` vectors with sums `sums`, components as columns, their eigenvalues, and the trace."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def covariance(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """`(n, sums per dimension, covariance)` of the `__x` of `fit`, correctly rounded from exact sums."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, own = 0, None
        for batch in _blocks(batches):
            x = _matrix(batch)
            n += len(x)
            found = x.sum(axis=0).tolist()
            own = found if own is None else [a + b for a, b in zip(own, found)]
        if own is not None:
            yield pa.record_batch(
                [pa.array(range(len(own)), pa.int32()), pa.array([n] * len(own), pa.int64()), _decimals(own)], names=["i", "n", "total"]
            )

    found = (
        fit.select("__x")
        .mapInArrow(totals, "i int, n bigint, total decimal(38,0)")
        .groupBy("i")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .collect()
    )
    if not found:
        return 0, [], np.zeros((0, 0))
    n, width = int(found[0]["n"]), len(found)
    sums = [0] * width
    for r in found:
        sums[r["i"]] = int(r["total"])
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [[0] * (width - lag) for lag in range(width)]
        seen = False
        for batch in _blocks(batches):
            seen = True
            y = _matrix(batch) - middle
            for lag in range(width):
                w = y[:, : width - lag] + y[:, lag:] if lag else y
                own[lag] = [a + b for a, b in zip(own[lag], _squares(w))]
        if seen:
            for lag, line in enumerate(own):
                at = np.arange(width - lag, dtype=np.int32)
                yield pa.record_batch([pa.array(at), pa.array(at + np.int32(lag)), _decimals(line)], names=["i", "j", "squares"])

    lines = (
        fit.select("__x")
        .mapInArrow(squares, "i int, j int, squares decimal(38,0)")
        .groupBy("i", "j")
        .agg(F.sum("squares").alias("squares"))
        .collect()
    )
    rest = [s - n * int(m) for s, m in zip(sums, middle)]
    # n squared times the variance of a dimension, or of the sum of two.
    spread = {
        (r["i"], r["j"]): n * int(r["squares"]) - (rest[r["i"]] + (rest[r["j"]] if r["i"] != r["j"] else 0)) ** 2 for r in lines
    }
    found = np.zeros((width, width))
    for (i, j), both in spread.items():
        shared = both if i == j else (both - spread[i, i] - spread[j, j]) // 2
        found[i, j] = found[j, i] = shared / (n * n)
    return n, sums, found


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def fit_whitening(fit: DataFrame, components: int = 4) -> Whitening:
    """Components of the distinct `__x` vectors in `fit`, by falling eigenvalue."""
    n, sums, shared = covariance(fit)
    if not n or not len(sums):
        return Whitening(n, tuple(sums), np.zeros((0, 0)), np.zeros(0), 0.0)
    values, vectors = np.linalg.eigh(shared)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > max(values[0], 0.0) * len(sums) * np.finfo(float).eps
    wanted = np.flatnonzero(real)[:components]
    own = vectors[:, wanted]
    # Either sign will do: the largest entry is positive.
    own = own * np.sign(own[np.abs(own).argmax(axis=0), np.arange(own.shape[1])]) if len(wanted) else own
    return Whitening(n, tuple(sums), own, values[wanted], float(np.trace(shared)))


def project(rows: DataFrame, fit: Whitening) -> DataFrame:
    """Replace `__x` by `deviation decimal(38,0)` and `white array<double>`."""
    n, whole = fit.n, np.array(fit.sums, dtype=object)
    weights = fit.components / np.sqrt(fit.eigenvalues)
    others = [f for f in rows.schema.fields if f.name != "__x"]
    largest = max((abs(s) for s in fit.sums), default=0)

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            x = _matrix(batch)
            small = n * int(np.abs(x).max(initial=0)) + largest < _LONG
            apart = n * x - whole.astype(np.int64) if small else n * x.astype(object) - whole
            if small and (int(np.abs(apart).max(initial=0)) ** 2) * max(1, x.shape[1]) < _LONG:
                deviation = pa.array(np.einsum("ij,ij->i", apart, apart)).cast(pa.decimal128(38, 0))
            else:
                deviation = _decimals([sum(int(v) ** 2 for v in line) for line in apart])
            white = (apart.astype(np.float64) / n) @ weights
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * weights.shape[1], pa.int32()), pa.array(white.ravel())
            )
            yield pa.record_batch(
                [*(batch.column(f.name) for f in others), deviation, lists],
                names=[*(f.name for f in others), "deviation", "white"],
            )

    listed = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    return rows.mapInArrow(pass_, f"{listed}deviation decimal(38,0), white array<double>")


def whiten(
    vectors: DataFrame,
    column: str = "embedding",
    keep: tuple[str, ...] = ("vec_id",),
    scale: int = 256,
    components: int = 4,
) -> DataFrame:
    """`keep + (component, n, deviation, whitened, explained, identity_error)`, a row per vector and component.

    `deviation` is the sum over dimensions of (n * x - sum)**2, exact. `identity_error`
    is the largest entry of the whitened fit's covariance less the identity.
    """
    rows = checkpointed(scaled_vectors(vectors, column, keep, scale))
    distinct = checkpointed(rows.select("__x").distinct())
    fit = fit_whitening(distinct, components)
    count = len(fit.eigenvalues)
    error = 0.0
    if count:
        white = project(distinct, fit)
        pairs = [(i, j) for i in range(count) for j in range(i, count)]
        found = white.agg(*(F.covar_pop(F.get("white", F.lit(i)), F.get("white", F.lit(j))) for i, j in pairs)).head()
        error = max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))
    else:
        rows = rows.where(F.lit(False))
    trace = fit.trace or 1.0
    explained = F.element_at(F.array(*(F.lit(float(e) / trace) for e in fit.eigenvalues), F.lit(0.0)), F.col("component"))
    spread = project(rows, fit).select(*keep, "deviation", F.posexplode("white").alias("__at", "whitened"))
    return spread.withColumn("component", F.col("__at") + 1).select(
        *keep,
        "component",
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
