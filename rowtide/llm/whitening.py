"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, x = floor(256 c). The fit list, each distinct x once, is cut
into blocks of rows and stored; all statistics are of this list, with divisor n, centred
before multiplying.

The bidiagonalisation takes a right vector v, multiplies the centred rows with it (X v),
makes the result orthogonal to all earlier left vectors u, multiplies back (Xᵀ u), and makes
that orthogonal to all earlier v. Both products happen in one pass: a task gives the inner
products of its share of p = X v - β u with itself, with the earlier u, and with its rows, and
the driver, which only ever holds numbers of the vectors' dimension, forms v, α and β from
their sums. Left vectors, as long as the list, are never stored or sent: each is a
combination of earlier products, u = X g with g of the dimension of v, and a task makes its
share of them anew from its own rows. So a lost executor costs only its tasks.

The singular value decomposition of the small bidiagonal matrix gives the components and
their deviations. Steps end when all wanted components have converged (residual within
``CLOSE`` of the largest singular value) and the variance not yet seen is less than the least
of them, so that none can have been missed, or when the space is used up. Where a direction
ends early (β = 0) a new one is drawn orthogonal to all so far.

Defined cases: vectors that are null, empty, or hold null or non-finite entries take no part,
nor do those of another length than most (the shorter, where lengths tie), as no covariance
is defined for them; entries beyond a long become the nearest long; equal vectors count once
in the fit and each get their rows; a null vec_id gets rows like any other; directions without
variance (less than ``FLAT`` of the whole) are no components, so fewer than asked for may come
out, and none for a list of one vector or an empty table; a deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import settle

SCALE = 256
COMPONENTS = 4
CLOSE = 1e-14
FLAT = 1e-12
#: Bytes of rows in a block.
BLOCK_BYTES = 1 << 19
#: Bytes of rows that one task reads in a pass.
PART_BYTES = 1 << 26
#: Up to this many tasks, the driver adds up what they give.
FEW = 64
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x of the rows that take part, but for their length."""
    e = F.col(f"`{embedding}`")
    entry = lambda c: c.cast("double")
    bad = lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) == float("inf"))
    # An entry beyond a long is cut to one before it is rounded.
    x = F.transform(e, lambda c: F.floor(F.greatest(F.lit(-(2.0**63)), F.least(F.lit(2.0**63 - 1024), SCALE * entry(c)))))
    kept = rows.filter(e.isNotNull() & (F.size(e) > 0) & ~F.exists(e, bad))
    return kept.select(F.col(f"`{vec_id}`").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column, all lists of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            rows = _matrix(batch.column(0))
            step = max(1, BLOCK_BYTES // (8 * rows.shape[1]))
            cut = [rows[at : at + step].tobytes() for at in range(0, len(rows), step)]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary())], ["rows"])


def blocks(vectors: DataFrame) -> DataFrame:
    """The fit list: each distinct x once, many rows in a binary value, in parts worth a task each."""
    stored = settle(vectors.select("x").distinct().mapInArrow(_packed, "rows binary"))
    size = stored.agg(F.sum(F.octet_length("rows").cast("long"))).first()[0] or 0
    return stored.coalesce(max(stored.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES)))


def _rows(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    for block in batch.column(0):
        yield np.frombuffer(block.as_buffer(), np.int64).reshape(-1, d)


def _summed(stored: DataFrame, d: int, size: int, share) -> np.ndarray:
    """The sum over all rows of ``share(rows)``, an array of ``size`` numbers.

    A task gives one array; they are added up in a tree, so that the driver adds few.
    """

    def run(found: Iterator) -> Iterator[np.ndarray]:
        total = np.zeros(size)
        for row in found:
            total += share(np.frombuffer(row[0], np.int64).reshape(-1, d))
        yield total

    parts = stored.rdd.mapPartitions(run)
    return parts.treeReduce(np.add, depth=1 if parts.getNumPartitions() <= FEW else 3)


def _sums(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    n, total = 0, np.zeros(d, object)
    for batch in batches:
        for rows in _rows(batch, d):
            n += len(rows)
            # In two halves, so that no sum of a block leaves a long.
            total += (rows >> 32).sum(0).astype(object) * (1 << 32) + (rows & 0xFFFFFFFF).sum(0).astype(object)
    values = pa.array([str(v) for v in [n, *total]])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), values], ["i", "v"])


def sums(stored: DataFrame, d: int) -> tuple[int, list[int]]:
    """n and the exact sum of each dimension."""
    parts = stored.mapInArrow(partial(_sums, d=d), "i long, v string")
    found = dict(map(tuple, parts.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)"))).collect()))
    return int(found[0]), [int(found[i + 1]) for i in range(d)]


@dataclass
class Fit:
    n: int
    sums: list[int]
    mean: np.ndarray
    components: np.ndarray  # dimension x components, of unit length
    values: np.ndarray  # their eigenvalues, falling
    trace: float
    error: float = 0.0
    steps: int = 0


def _share(rows: np.ndarray, mean: np.ndarray, v: np.ndarray, g: np.ndarray, beta: float) -> np.ndarray:
    """Of these rows: p with itself, with every earlier u, and the rows times p."""
    x = rows - mean
    u = x @ g
    p = x @ v
    if beta:
        p = p - beta * u[:, -1]
    return np.concatenate([[p @ p], u.T @ p, x.T @ p])


def _orthogonal(w: np.ndarray, base: np.ndarray) -> np.ndarray:
    for _ in range(2):
        w = w - base @ (base.T @ w)
    return w


def bidiagonalise(stored: DataFrame, d: int, n: int, mean: np.ndarray, variance: float, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Right singular vectors and singular values, ``wanted`` at most, of the centred rows; the steps it took.

    ``variance`` is the sum of all squares, n times the trace.
    """
    drawn = np.random.default_rng(5)
    right, g, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    alphas, betas = [], []
    v, beta, linked = drawn.standard_normal(d), 0.0, 0.0
    v /= np.linalg.norm(v)
    small = np.sqrt(variance) * 1e-15
    while True:
        k = len(alphas)
        got = _summed(stored, d, 1 + k + d, partial(_share, mean=mean, v=v, g=g, beta=beta))
        # p is orthogonal to the earlier u but for rounding; c is what is left to take off.
        c, product = got[1 : k + 1], got[k + 1 :]
        alpha = np.sqrt(max(0.0, got[0] - c @ c))
        taken = c + (np.eye(k)[:, -1] * beta if k else 0.0)
        if alpha > small:
            left = (v - g @ taken) / alpha
            w = (product - back @ c) / alpha
        else:  # v has no variance of its own
            alpha, left, w = 0.0, np.zeros(d), np.zeros(d)
        right, g, back = np.column_stack([right, v]), np.column_stack([g, left]), np.column_stack([back, w])
        alphas.append(alpha)
        w = _orthogonal(w, right)
        beta = float(np.linalg.norm(w))
        linked = beta if beta > small else 0.0
        b = np.diag(alphas) + (np.diag(betas, 1) if betas else 0.0)
        p, sigma, q = np.linalg.svd(b)
        best = min(wanted, len(sigma))
        unseen = max(0.0, variance - (sigma**2).sum() - linked**2)
        converged = (linked * np.abs(p[-1, :best]) <= CLOSE * sigma[0]).all()
        enough = best == wanted and unseen + linked**2 < sigma[best - 1] ** 2
        if len(alphas) == d or (converged and enough) or (unseen + linked**2 <= variance * 1e-15):
            return right @ q[:best].T, sigma[:best], len(alphas)
        betas.append(linked)
        beta = linked
        if linked:
            v = w / linked
        else:  # this direction has ended
            v = _orthogonal(drawn.standard_normal(d), right)
            v /= np.linalg.norm(v)


def _squares(rows: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return np.array([((rows - mean) ** 2).sum()])


def _moments(rows: np.ndarray, mean: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = (rows - mean) @ weights
    return np.concatenate([z.sum(0), (z.T @ z).ravel()])


def _dimension(vectors: DataFrame) -> int | None:
    row = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return row and row.d


def fit(vectors: DataFrame, d: int, wanted: int = COMPONENTS) -> Fit:
    """The components of the distinct ones of ``vectors``, all of dimension ``d``."""
    stored = blocks(vectors)
    n, total = sums(stored, d)
    mean = np.array([s / n for s in total])
    variance = float(_summed(stored, d, 1, partial(_squares, mean=mean))[0])
    empty = Fit(n, total, mean, np.zeros((d, 0)), np.zeros(0), 0.0)
    if n < 2 or not variance:
        return empty
    axes, sigma, steps = bidiagonalise(stored, d, n, mean, variance, wanted)
    keep = sigma**2 > FLAT * variance
    axes, values = axes[:, keep], sigma[keep] ** 2 / n
    axes /= np.linalg.norm(axes, axis=0)
    axes *= np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)  # the largest entry is positive
    k = len(values)
    m = _summed(stored, d, k + k * k, partial(_moments, mean=mean, weights=axes / np.sqrt(values)))
    centre = m[:k] / n
    error = float(np.abs(m[k:].reshape(k, k) / n - np.outer(centre, centre) - np.eye(k)).max()) if k else 0.0
    return Fit(n, total, mean, axes, values, variance / n, error, steps)


def deviations(rows: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Of each row the exact sum of (n x - S)^2; null if it is no long."""
    far = max(n * max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0)))), max(map(abs, total))) * 2
    if far * far * rows.shape[1] < 1 << 62:
        return ((n * rows - np.array(total, np.int64)) ** 2).sum(1).tolist()
    exact = ((n * rows.astype(object) - np.array(total, object)) ** 2).sum(1)
    return [v if v < 1 << 63 else None for v in exact]


def _whitened(batches: Iterator[pa.RecordBatch], model: Fit) -> Iterator[pa.RecordBatch]:
    k = len(model.values)
    weights, explained = model.components / np.sqrt(model.values), model.values / model.trace
    for batch in batches:
        m = batch.num_rows
        if not m:
            continue
        rows = _matrix(batch.column(1))
        each = np.repeat(np.arange(m), k)
        columns = [
            batch.column(0).take(pa.array(each)),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
            pa.array(np.full(m * k, model.n)),
            pa.array(deviations(rows, model.n, model.sums), pa.int64()).take(pa.array(each)),
            pa.array(((rows - model.mean) @ weights).ravel()),
            pa.array(np.tile(explained, m)),
            pa.array(np.full(m * k, model.error)),
        ]
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        yield pa.RecordBatch.from_arrays(columns, names)


def whiten(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """For each vector and component the whitened coordinate, with n, the vector's deviation and what the component explains."""
    vectors = whole_vectors(rows, vec_id, embedding)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    d = _dimension(vectors)
    model = fit(vectors.filter(F.size("x") == d), d, wanted) if d else None
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, {RESULT}")
    return vectors.filter(F.size("x") == d).mapInArrow(partial(_whitened, model=model), f"vec_id {kind}, {RESULT}")
