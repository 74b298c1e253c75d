"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

An entry c becomes the whole number x = floor(1024 c) + 100000, so that counts, sums and squared deviations are exact.
The leading eigenvectors of the covariance V of x are found without ever forming V: every step is a pass that sends a
narrow block Q to the tasks and sums Xc'(Xc Q) over them, Xc being the centred vectors. A short Lanczos run bounds the
spectrum from below; then a Chebyshev polynomial of V, applied by its three-term recurrence (a pass a degree), damps
what lies between that bound and the smallest Ritz value of the block, and QR and Rayleigh-Ritz renew the block. It is
certified when V q - e q of every wanted pair is as small as rounding allows, relative to the largest eigenvalue.

What reaches the driver is a few sums of dimension x block numbers; with many tasks these are summed in two levels.

Defined results: a null vector, a null or non-finite entry drops the row, as does a length other than the commonest
one (of equally common ones the longest). Entries beyond 2^52 / 1024 count as that. Null ids, repeated rows and ties
are rows like others. Of equal eigenvalues any orthonormal basis is returned, each vector with its largest entry
positive. Directions without variance (of fewer rows than dimensions, equal rows, one row) have no component; an empty
table, or one without any variance, gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import Batches
from voltframe.session import written

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
# Columns of the block beyond the wanted ones: the wider, the steeper the filter and the dearer a pass.
GUARD = 16
DEGREE, CYCLES = 14, 60
LANCZOS_STEPS = 10
# Wanted residual over the largest eigenvalue; where rounding stops short of it, the second is the least that will do.
CERTIFIED, ACCEPTED = 1e-14, 1e-11
# How much a filter may raise the largest eigenvalue it sees.
MOST_GAIN = 1e10
# A direction with less than this share of the variance is rounding.
LEAST_SHARE = 1e-13
LARGEST = float(2**52)
# Partial sums that the driver takes at once; more are summed by tasks first.
DRIVER_PARTS = 64


@dataclass
class Fit:
    """Rows, exact sums, the wanted eigenvalues and eigenvectors (columns), and the trace of the covariance."""

    table: DataFrame
    n: int
    sums: list[int]
    largest: int
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int


def whole(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """`row` (the other columns) and `x` (whole numbers) of every row that counts, written once."""
    rest = [name for name in df.columns if name != vector] or [vector]
    unfit = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    sound = df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(unfit, F.lit(True)))
    scaled = F.transform(
        vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + OFFSET
    )
    table = written(sound.select(F.struct(*[f"`{name}`" for name in rest]).alias("row"), scaled.alias("x")), "whole")
    sizes = table.groupBy(F.size("x").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return table.filter(F.size("x") == (common["size"] if common else 0))


def matrix(part: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    column = part.column(name)
    return np.asarray(column.flatten(), kind).reshape(part.num_rows, -1)


def summed(table: DataFrame, column: str, kind: type, function: Callable[[np.ndarray], np.ndarray], parts: int) -> np.ndarray | None:
    """The sum of `function` (a flat array of a batch's matrix) over all batches; None of no rows."""

    def partial(batches: Batches) -> Batches:
        total = None
        for part in batches:
            if part.num_rows:
                mine = function(matrix(part, column, kind))
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def together(batches: Batches) -> Batches:
        found = [np.frombuffer(each, kind) for part in batches for each in part.column("part").to_pylist()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(found, axis=0).tobytes()], pa.binary())], ["part"])

    rows = table.select(column).mapInArrow(partial, "part binary")
    if parts > DRIVER_PARTS:
        rows = rows.repartition(math.isqrt(parts)).mapInArrow(together, "part binary")
    # Sorted, so that a second run adds in the same order.
    found = sorted(bytes(row["part"]) for row in rows.collect())
    return np.sum([np.frombuffer(each, kind) for each in found], axis=0) if found else None


def centred(x: np.ndarray, n: int, sums: list[int], largest: int) -> tuple[np.ndarray, np.ndarray]:
    """n x - S exactly, as whole numbers, and x - S / n rounded once."""
    exact = n * largest >= 2**61
    by_n = (x.astype(object) if exact else x) * n - np.array(sums, object if exact else np.int64)
    return by_n, (by_n / n).astype(np.float64)


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """None where no row counts."""
    table = whole(df, vector)
    parts = table.rdd.getNumPartitions()

    def totals(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], x.sum(axis=0)])

    found = summed(table, "x", np.int64, totals, parts)
    if found is None:
        return None
    n, sums, dims = int(found[0]), [int(s) for s in found[1:]], len(found) - 1
    largest = int(table.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0])
    share = table.sparkSession.sparkContext.broadcast
    passes = 0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        sent = share(q)

        def mine(x: np.ndarray) -> np.ndarray:
            own = centred(x, n, sums, largest)[1]
            return (own.T @ (own @ sent.value)).ravel()

        out = summed(table, "x", np.float64, mine, parts).reshape(q.shape) / n
        sent.unpersist()
        return out

    trace = float(summed(table, "x", np.float64, lambda x: np.array([(centred(x, n, sums, largest)[1] ** 2).sum()]), parts)[0]) / n
    if trace <= 0:
        return Fit(table, n, sums, largest, 0.0, np.empty(0), np.empty((dims, 0)), 0.0, passes)
    values, vectors, residual = subspace(product, dims, trace, components)
    sure = values > LEAST_SHARE * trace
    return Fit(table, n, sums, largest, trace, values[sure], vectors[:, sure], residual, passes)


def least(product: Callable[[np.ndarray], np.ndarray], dims: int, rng: np.random.Generator) -> float:
    """A lower bound of the spectrum: the smallest Ritz value of a Lanczos run less its last coupling, 0 at least."""
    q = rng.standard_normal(dims)
    basis, diagonal, beside = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS_STEPS, dims)):
        w = product(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * max(diagonal):
            break
        basis.append(w / beside[-1])
    inner = beside[:-1]
    return max(0.0, float(np.linalg.eigvalsh(np.diag(diagonal) + np.diag(inner, 1) + np.diag(inner, -1))[0]) - beside[-1])


def subspace(product: Callable[[np.ndarray], np.ndarray], dims: int, trace: float, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The leading eigenvalues, falling, and eigenvectors of a symmetric positive operator given by its products."""
    rng = np.random.default_rng(13)
    wanted = min(wanted, dims)
    width = min(dims, wanted + GUARD)
    block = np.linalg.qr(rng.standard_normal((dims, width)))[0]
    low = least(product, dims, rng) if width < dims else 0.0
    best, stalled = math.inf, 0
    for _ in range(CYCLES):
        times = product(block)
        inner = block.T @ times
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, times = block @ turn, times @ turn
        left = np.linalg.norm(times[:, :wanted] - block[:, :wanted] * values[:wanted], axis=0) / max(values[0], LEAST_SHARE * trace)
        residual = float(left.max())
        # An improvement by less than half is rounding at work.
        stalled = stalled + 1 if residual > best / 2 else 0
        if residual < best:
            best, kept = residual, (values[:wanted].copy(), block[:, :wanted].copy())
        if best <= CERTIFIED or (best <= ACCEPTED and stalled >= 2):
            break
        # Leading pairs that are certified are locked: the others are filtered in what is orthogonal to them, so that a
        # far larger eigenvalue does not drown them in its rounding errors.
        locked = int(np.argmax(left > CERTIFIED))
        fixed, free = block[:, :locked], block[:, locked:]
        if width < dims:
            free = filtered(product, fixed, free, times[:, locked:], low, float(values[-1]), float(values[locked]))
        block = np.linalg.qr(np.hstack([fixed, free]))[0]
    if best > ACCEPTED:
        raise ArithmeticError(f"residual {best:.1e} after {CYCLES} cycles")
    values, vectors = kept
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(wanted)] < 0, -1.0, 1.0), best


def filtered(
    product: Callable, fixed: np.ndarray, free: np.ndarray, times: np.ndarray, low: float, cut: float, top: float
) -> np.ndarray:
    """The Chebyshev polynomial that stays within 1 on [low, cut], times `free`; scaled so that `top` stays near 1.

    `times` is the operator times `free`, known from the Rayleigh-Ritz step: it saves the first pass. The degree is
    such that `top` is raised by at most `MOST_GAIN`: beyond it rounding would bury what is close to the cut.
    """

    def apart(q: np.ndarray) -> np.ndarray:
        return q - fixed @ (fixed.T @ q)

    low = min(low, cut - 1e-9 * top)
    centre, half = (cut + low) / 2, (cut - low) / 2
    reach = max(1.0, (top - centre) / half)
    growth = reach + math.sqrt(reach**2 - 1)
    degree = DEGREE if growth**DEGREE < MOST_GAIN else max(2, int(math.log(MOST_GAIN) / math.log(growth)))
    first = scale = 1 / reach
    before, now = free, apart(times - centre * free) * (scale / half)
    for _ in range(2, degree + 1):
        after = 1 / (2 / first - scale)
        before, now = now, apart(product(now) - centre * now) * (2 * after / half) - before * (scale * after)
        scale = after
    return now


def whitened(fitted: Fit) -> tuple[DataFrame, float]:
    """`row`, `whitened` (an entry a component) and `deviation` (decimal) of every row of the fit, and identity_error.

    identity_error is the largest entry of the whitened vectors' covariance less the identity, over all rows.
    """
    table, n, sums, largest = fitted.table, fitted.n, fitted.sums, fitted.largest
    sent = table.sparkSession.sparkContext.broadcast(fitted.vectors / np.sqrt(fitted.values))
    out = T.StructType([table.schema["row"], *T._parse_datatype_string("whitened array<double>, deviation decimal(38,0)").fields])

    def project(batches: Batches) -> Batches:
        for part in batches:
            if not part.num_rows:
                continue
            by_n, own = centred(matrix(part, "x", np.int64), n, sums, largest)
            narrow = by_n.dtype != object and int(np.abs(by_n).max()) ** 2 * by_n.shape[1] < 2**62
            wide = by_n if narrow else by_n.astype(object)
            away = [int(d) for d in (wide * wide).sum(axis=1)]
            # More than 38 digits have no decimal.
            away = pa.array([str(d) if d < 10**38 else None for d in away], pa.string()).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(list(own @ sent.value), pa.list_(pa.float64())), away], out.names)

    done = written(table.mapInArrow(project, out), "whitened")
    if not len(fitted.values):
        return done, 0.0
    parts = table.rdd.getNumPartitions()
    middle = summed(done, "whitened", np.float64, lambda w: w.sum(axis=0), parts) / n

    def spread(w: np.ndarray) -> np.ndarray:
        own = w - middle
        return (own.T @ own).ravel()

    size = len(fitted.values)
    spread_of_all = summed(done, "whitened", np.float64, spread, parts).reshape(size, size) / n
    return done, float(np.abs(spread_of_all - np.eye(size)).max())


def components(df: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Per row and component: `row`, component (from 1), n, deviation (decimal), whitened, explained, identity_error."""
    fitted = fit(df, vector, count)
    spark = df.sparkSession
    if fitted is None:
        rest = [name for name in df.columns if name != vector] or [vector]
        empty = df.limit(0).select(F.struct(*[f"`{name}`" for name in rest]).alias("row"))
        fields = T._parse_datatype_string("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
        return spark.createDataFrame([], T.StructType([empty.schema["row"], *fields.fields]))
    rows, error = whitened(fitted)
    shares = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values]).cast("array<double>")
    each = rows.select("row", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "row",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
