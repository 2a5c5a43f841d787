"""Whitening of vectors on their leading principal components, by mixed-precision refinement.

Entries become integers, so sums and the covariance are exact whatever the order of the
additions: tasks multiply integers that are centred by the rounded mean, in blocks small
enough for float64 to hold every product sum exactly, and what rounding left of the mean is
taken off in integers.  The covariance has one row for each dimension; it alone reaches
the driver.  There, float32 eigenvectors are corrected by the matrix products of Ogita and
Aishima in extended precision, which doubles the right digits each time.  Eigenvalues too near
for that step to part are solved again on the space that their vectors span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.staging import stage

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
LIMIT = 1 << 40  # entries beyond are taken as this
LIMB = 20  # bits; products of two limbs summed over a block stay below 2 ** 53
ROUNDS = 60
TURN = 0.01  # radians that a step may turn a vector towards another
WIDE = np.longdouble

OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def integers(column: pa.Array, length: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of usable vectors (of ``length``), their lengths, and all their entries as integers.

    Unusable are nulls, and vectors with null or non-finite entries.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.array(column.value_lengths().fill_null(0), np.int64)
    values = column.flatten()
    entries = np.asarray(values.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    good = np.isfinite(entries)  # null entries read as NaN
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~good)])
    usable = np.asarray(column.is_valid()) & (bad[ends] == bad[ends - sizes])
    if length is not None:
        usable &= sizes == length
    entries = entries[np.repeat(usable, sizes)]
    x = np.clip(np.floor(entries * SCALE), -LIMIT, LIMIT).astype(np.int64) + OFFSET
    return np.flatnonzero(usable), sizes[usable], x


@dataclass
class Fit:
    """``n`` vectors with sums ``total``, eigenvectors as columns, and the eigenvalues over n * n."""

    n: int
    total: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @property
    def centre(self) -> np.ndarray:
        return np.array([round_div(s, self.n) for s in self.total], np.int64)

    @property
    def left(self) -> list[int]:
        """n times what the mean is above ``centre``."""
        return [s - self.n * int(c) for s, c in zip(self.total, self.centre, strict=True)]

    def matrix(self) -> np.ndarray:
        """Projections divided by the root of the eigenvalue; null ones are not finite."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.vectors / np.sqrt(self.values)


def round_div(a: int, b: int) -> int:
    return (2 * a + b) // (2 * b)


def sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number and exact sums of the usable vectors of the most frequent length (ties: the smallest)."""
    kind = pa.decimal128(38, 0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list] = {}
        for batch in batches:
            _, sizes, x = integers(batch.column(0))
            each = np.repeat(sizes, sizes)
            for d in np.unique(sizes[sizes > 0]).tolist():
                part = x[each == d].reshape(-1, d)
                have = known.setdefault(d, [0, np.zeros(d, object)])
                have[0] += len(part)
                have[1] += part.sum(0)  # a batch's entries add up to less than 2 ** 63
        for d, (n, total) in known.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d]), pa.array([n]), pa.array([[Decimal(int(t)) for t in total]], pa.list_(kind))],
                names=["length", "n", "total"],
            )

    parts = stage(vectors.mapInArrow(add, "length long, n long, total array<decimal(38,0)>"), "sums")
    top = parts.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "length").first()
    if top is None:
        return 0, []
    rows = parts.where(F.col("length") == top.length).select(F.posexplode("total").alias("i", "t"))
    total = rows.groupBy("i").agg(F.sum("t").alias("t")).collect()  # a row for each dimension
    return top.n, [int(r.t) for r in sorted(total, key=lambda r: r.i)]


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of integers as Python integers."""
    out = np.zeros((y.shape[1], y.shape[1]), object)
    half = 1 << (LIMB - 1)
    for a in range(0, len(y), 1 << 10):
        rest, parts = y[a : a + (1 << 10)], []
        while rest.any():
            low = (rest + half) % (1 << LIMB) - half
            parts.append(low.astype(np.float64))
            rest = (rest - low) >> LIMB
        for i, left in enumerate(parts):
            for j, right in enumerate(parts):
                out += (left.T @ right).astype(np.int64).astype(object) << (LIMB * (i + j))
    return out


def scatter(vectors: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Exact sums of products of the entries less ``centre``, over all usable vectors."""
    d = len(centre)
    upper = np.triu_indices(d)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            _, _, x = integers(batch.column(0), d)
            total += exact_products(x.reshape(-1, d) - centre)
        values = pa.array([Decimal(int(t)) for t in total[upper]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(upper[0]), pa.array(upper[1]), values], names=["i", "j", "v"])

    made = vectors.mapInArrow(multiply, "i long, j long, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d), object)
    for r in made.collect():  # a row for each pair of dimensions
        out[r.i, r.j] = out[r.j, r.i] = int(r.v)
    return out


def clusters(linked: np.ndarray) -> list[np.ndarray]:
    """Groups of places that are linked, directly or over others."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1))
        if (low == label).all():
            return [np.flatnonzero(label == x) for x in np.unique(label[linked.any(1)])]
        label = low


def orthonormal(x: np.ndarray) -> np.ndarray:
    """The nearest orthonormal vectors to nearly orthonormal ones."""
    for _ in range(3):
        x = x + x @ (np.eye(x.shape[1], dtype=WIDE) - x.T @ x) / 2
    return x


def refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of the symmetric ``a``, from approximate vectors ``x``.

    A step corrects a pair of vectors where that turns them little against the gap between
    their values; elsewhere it only makes them orthogonal.  Vectors of values too near for that
    are solved on the space they span: the matrix there, less its middle value and scaled to
    its own width, goes to an ordinary solver, and the refinement goes on.  Values that agree
    within the rounding of the wide numbers keep some basis of their space.
    """
    d = len(a)
    one = np.eye(d, dtype=WIDE)
    eps = 4 * d * np.finfo(WIDE).eps
    noise = eps * np.sqrt((a * a).sum())
    before = WIDE(np.inf)
    for _ in range(ROUNDS):
        r = one - x.T @ x
        s = x.T @ a @ x
        s = (s + s.T) / 2  # else rounding over a small gap would bend the vectors towards each other
        values = np.diag(s) / (1 - np.diag(r))
        gap = values[None, :] - values[:, None]
        wrong = s + values[None, :] * r
        open_ = np.maximum(np.abs(wrong), np.abs(wrong.T)) > noise
        np.fill_diagonal(open_, False)
        apart = open_ & (np.abs(wrong) <= TURN * np.abs(gap)) & (np.abs(wrong.T) <= TURN * np.abs(gap))
        step = np.where(apart, wrong / np.where(apart, gap, 1), r / 2)
        x = x + x @ step
        near = open_ & ~apart
        moved = np.abs(step).max()
        if near.any() and moved < TURN:
            for g in clusters(near):
                own = orthonormal(x[:, g])
                inner = own.T @ a @ own
                inner = (inner + inner.T) / 2 - np.diag(inner).mean() * (own.T @ own)
                _, turn = np.linalg.eigh((inner / np.abs(inner).max()).astype(np.float64))
                x[:, g] = own @ turn.astype(WIDE)
            before = WIDE(np.inf)
        elif moved <= eps or not open_.any() and moved >= before / 2:
            break
        else:
            before = moved
    x = orthonormal(x)
    return np.diag(x.T @ a @ x).copy(), x


def eigen(scatter_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix of Python integers."""
    d = len(scatter_n)
    top = max((abs(int(v)) for v in scatter_n.flat), default=0)
    if not top:
        return np.zeros(d), np.eye(d)
    scale = WIDE(str(top))
    a = np.array([[WIDE(str(int(v))) / scale for v in row] for row in scatter_n], WIDE)
    _, start = np.linalg.eigh(a.astype(np.float32))
    values, x = refined(a, start.astype(WIDE))
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    x = x * np.where(np.take_along_axis(x, np.abs(x).argmax(0)[None], 0)[0] < 0, -1, 1)
    values[values <= values.sum() * d * WIDE(1e-17)] = 0  # of a space that no vector leaves its mean in
    return (values * scale), x.astype(np.float64)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Mean and leading components of the usable rows of the one column of ``vectors``."""
    n, total = sums(vectors)
    if not n:
        return None
    found = Fit(n, total, np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    left = np.array(found.left, object)
    values, x = eigen(n * scatter(vectors, found.centre) - left[:, None] * left[None, :])
    whole = values.sum()
    found.vectors = x[:, :components]
    found.explained = (values / whole if whole > 0 else values * np.nan)[:components].astype(np.float64)
    found.values = (values / WIDE(n) / WIDE(n))[:components].astype(np.float64)
    found.identity_error = identity_error(vectors, found)
    return found


def projected(x: np.ndarray, found: Fit) -> np.ndarray:
    centred = (x - found.centre).astype(np.float64) - np.array([float(t) / found.n for t in found.left])
    return centred @ found.matrix()


def identity_error(vectors: DataFrame, found: Fit) -> float | None:
    """Largest entry of the covariance of the whitened values less the identity, over all vectors.

    Components without spread are left out; None where none has any.
    """
    d, used = len(found.total), np.flatnonzero(found.values > 0)
    k = len(used)
    if not k:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            _, _, x = integers(batch.column(0), d)
            w = projected(x.reshape(-1, d), found)[:, used]
            total += np.vstack([w.sum(0), w.T @ w])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["i", "v"])

    rows = vectors.mapInArrow(add, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k + 1) * k)
    total[[r.i for r in rows]] = [r.v for r in rows]
    total = total.reshape(k + 1, k) / found.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def deviations(x: np.ndarray, found: Fit) -> pa.Array:
    """Exact sums of squares of n times the entry less the entries' sum; null beyond 64 bits."""
    y, left = x - found.centre, found.left
    largest = found.n * int(np.abs(y).max(initial=0)) + max(map(abs, left))
    if largest * largest * max(1, len(left)) < 1 << 63:
        return pa.array(((found.n * y - np.array(left, np.int64)) ** 2).sum(1))
    exact = ((found.n * y.astype(object) - np.array(left, object)) ** 2).sum(1)
    return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, found: Fit | None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row.

    Left out are vectors that are null, empty, hold null or non-finite entries, or have
    another length than most vectors.  Entries beyond 2 ** 40 / 1024 count as that.  A vector of fewer
    dimensions has as many components.  A component without spread (one vector only, equal
    vectors, fewer vectors than components) has a null ``whitened``; without any spread
    ``explained`` and ``identity_error`` are null too.  ``deviation`` is null where it passes 64
    bits.  A null vec_id stays null; repeated rows count and are returned each; other columns
    are ignored; an empty table gives no rows.
    """
    wanted = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    if found is None:
        wanted = wanted.limit(0)
    d = len(found.total) if found else 0
    k = len(found.values) if found else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _, x = integers(batch.column(1), d)
            if not len(at) or found is None:
                continue
            x = x.reshape(-1, d)
            rows = pa.array(np.repeat(np.arange(len(at)), k))
            whitened = projected(x, found).ravel()
            spread = np.tile(found.values > 0, len(at))
            explained = np.tile(found.explained, len(at))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, found.n)),
                    deviations(x, found).take(rows),
                    pa.array(whitened, mask=~spread),
                    pa.array(explained, mask=np.isnan(explained)),
                ],
                names=[c.split()[0] for c in OUT.split(", ")],
            )

    error = F.lit(found.identity_error if found else None).cast("double").alias("identity_error")
    return wanted.mapInArrow(run, OUT).select("*", error)


def whitened_vectors(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fit on all vectors and whiten them: see ``whiten``."""
    return whiten(vectors, fit(vectors.select("embedding"), components))
