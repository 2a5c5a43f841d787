"""Linear SVMs of all folds and penalties of one feature map, fitted side by side.

A fit of its own for each fold and penalty takes a job for every step of every model.  Here
all models take their steps together: one pass over the rows maps them once for each fold and
returns a block of sums for each task, which has the losses and slopes of all models that are not
done yet.  Rows are mapped some at a time and never kept.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Mapping, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.typing import column

BLOCK = 1024  # rows that are mapped at once
MEMORY = 10  # steps that shape a direction
PATIENCE = 10  # steps without gain before a fit ends
TRIALS = 20  # lengths tried for a step
SINGLE = 4096  # rows from which on maps and slopes are made in single precision
WIDE = 64  # blocks of sums that the driver adds up itself

Point = tuple[float, np.ndarray]
Rows = Callable[..., np.ndarray]  # of raw rows and, where not double, the kind of numbers to work with


class Shared(Protocol):
    """One map of raw rows of which the features of every fold are linear functions."""

    def map(self, x: np.ndarray, kind: type) -> np.ndarray: ...

    def lifted(self, fold: int, weights: np.ndarray) -> np.ndarray: ...

    def lowered(self, fold: int, sums: np.ndarray) -> np.ndarray: ...


def _direction(slope: np.ndarray, steps: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    d, kept = -slope, []
    for s, y in zip(reversed(steps), reversed(turns), strict=True):
        kept.append((s @ d) / (s @ y))
        d = d - kept[-1] * y
    if steps:
        d = d * (steps[-1] @ turns[-1]) / (turns[-1] @ turns[-1])
    for s, y, a in zip(steps, turns, reversed(kept), strict=True):
        d = d + (a - (y @ d) / (s @ y)) * s
    return d


def minimise(x: np.ndarray, limit: int, tolerance: float) -> Generator[np.ndarray, Point, np.ndarray]:
    """L-BFGS that yields points, is sent the value and slope there, and returns the lowest point.

    Step lengths are bisected until they fall far enough and turn the slope, which also serves values with kinks.
    It ends after ``limit`` steps, or when ``PATIENCE`` steps gain less than ``tolerance`` of the first value.
    """
    value, slope = yield x
    past, steps, turns = [value], [], []
    for _ in range(limit):
        size = np.linalg.norm(slope)
        if size <= max(tolerance * abs(value) * 1e-3, 1e-8):
            break
        d = _direction(slope, steps, turns)
        if slope @ d >= 0:
            d, steps, turns = -slope, [], []
        down, low, high = slope @ d, 0.0, np.inf
        t = 1.0 if steps else min(1.0, 1.0 / size)
        for _ in range(TRIALS):
            at, (value_t, slope_t) = t, (yield x + t * d)
            if value_t > value + 1e-4 * t * down:
                high = t
            elif slope_t @ d < 0.9 * down:
                low = t
            else:
                break
            t = (low + high) / 2 if np.isfinite(high) else 2 * low
        if value_t >= value:
            if not steps:
                break
            steps, turns = [], []  # once more, straight down
            continue
        step, turn = at * d, slope_t - slope
        if step @ turn > 1e-12 * (turn @ turn):
            steps, turns = [*steps, step][-MEMORY:], [*turns, turn][-MEMORY:]
        x, value, slope = x + step, value_t, slope_t
        past.append(value)
        if len(past) > PATIENCE and past[-1 - PATIENCE] - value <= tolerance * past[0]:
            break
    return x


def _sums(
    rows: DataFrame, parts: int, work: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], size: int
) -> np.ndarray:
    """The sum of ``work(values, signs, folds)`` over blocks of rows; each task returns one block."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in batch.column(0).to_pylist():
                block = np.frombuffer(block)
                total = block if total is None else total + block
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                values = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                labels, folds = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                block = work(values, 2.0 * labels - 1, folds)
                total = block if total is None else total + block
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    blocks = rows.mapInArrow(run, "sums binary")
    if parts > WIDE:
        blocks = blocks.repartition(WIDE // 8).mapInArrow(add, "sums binary")
    return sum(np.frombuffer(r["sums"]) for r in blocks.collect())


def _rows(data: DataFrame, label: str) -> DataFrame:
    """Label, fold and values of the rows that have a fold."""
    values = F.col("features") if data.schema["features"].dataType.typeName() == "array" else vector_to_array("features")
    return data.filter(F.col("fold").isNotNull()).select(column(label).cast("double"), "fold", values)


def fits(
    data: DataFrame, maps: Mapping[int, Rows], penalties: Sequence[float], label: str, tolerance: float, limit: int = 100,
    size: int = BLOCK, shared: Shared | None = None,
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each key of ``maps`` the weights (mapped features x penalties) and intercepts fitted without that fold.

    ``maps[f]`` turns raw feature rows into those of the models that leave out fold ``f``; a key that is no
    fold leaves out nothing.  Loss: mean hinge loss plus half the penalty times the squared weights, the intercept
    free, as in Spark's ``LinearSVC``; steps are taken on centred columns of spread 1.  From ``SINGLE`` rows on
    rows are mapped ``size`` at a time in single precision, whose cosine and products are many times as fast; with fewer, rounding could
    move an accuracy by a row that shows.  ``shared`` stands for the maps of all folds in the steps.  Rows are scaled and blocks added up in double precision either way.
    """
    rows = _rows(data, label)
    parts, kind = rows.rdd.getNumPartitions(), np.float64 if rows.count() < SINGLE else np.float32

    def moments(values, signs, fold):
        found = []
        for f in maps:
            z = maps[f](values[fold != f], kind).astype(float)
            found += [[len(z)], z.sum(0), np.einsum("ij,ij->j", z, z)]
        return np.concatenate(found)

    features = len(data.select("features").head()[0])
    widths = {f: maps[f](np.zeros((1, features))).shape[1] for f in maps}
    flat, at, n, mean, inverse = _sums(rows, parts, moments, size), 0, {}, {}, {}
    for f, width in widths.items():
        n[f] = flat[at]
        mean[f] = flat[at + 1 : at + 1 + width] / n[f]
        square = flat[at + 1 + width : at + 1 + 2 * width] / n[f]
        spread = square - mean[f] ** 2
        varies = spread > 1e-12 * square
        inverse[f] = np.where(varies, 1 / np.sqrt(np.where(varies, spread, 1)), 0)
        at += 1 + 2 * width

    def plain(f, x):
        """Weights and intercept on the mapped columns of a point on the centred ones."""
        weights = x[:-1] * inverse[f]
        return weights, x[-1] - mean[f] @ weights

    def stacked(points):
        found = {}
        for f in maps:
            mine = [plain(f, x) for (g, _), x in points.items() if g == f]
            if mine:
                found[f] = np.stack([w for w, _ in mine], axis=1), np.array([b for _, b in mine])
        return found

    def apart(models):
        """Losses, pulls and slopes of the models of each fold, on the fold's own map."""
        models = {f: (weights.astype(kind), shift) for f, (weights, shift) in models.items()}

        def slopes(values, signs, fold):
            found = []
            for f, (weights, shift) in models.items():
                z, y = maps[f](values[fold != f], kind), signs[fold != f, None]
                short = 1 - y * (z @ weights + shift)
                pull = np.where(short > 0, -y, 0.0)
                found += [np.maximum(short, 0).sum(0), pull.sum(0), (z.T @ pull.astype(kind)).T.ravel()]
            return np.concatenate(found)

        flat, at, found = _sums(rows, parts, slopes, size), 0, {}
        for f, (_, shift) in models.items():
            k, width = len(shift), widths[f]
            found[f] = flat[at : at + k], flat[at + k : at + 2 * k], flat[at + 2 * k : at + 2 * k + k * width].reshape(k, width)
            at += 2 * k + k * width
        return found

    def together(models):
        """The same of all folds on one map."""
        owners = np.array([f for f, (_, shift) in models.items() for _ in shift])
        weights = np.stack([shared.lifted(f, w) for f, (some, _) in models.items() for w in some.T], axis=1).astype(kind)
        shifts, mapped = np.concatenate([shift for _, shift in models.values()]), shared.map

        def slopes(values, signs, fold):
            z, y = mapped(values, kind), signs[:, None]
            short = np.where(fold[:, None] == owners, 0.0, 1 - y * (z @ weights + shifts))
            pull = np.where(short > 0, -y, 0.0)
            return np.concatenate([np.maximum(short, 0).sum(0), pull.sum(0), (z.T @ pull.astype(kind)).T.ravel()])

        losses, pulls, sums = np.split(_sums(rows, parts, slopes, size), [len(owners), 2 * len(owners)])
        sums = sums.reshape(len(owners), -1)
        mine = {f: np.flatnonzero(owners == f) for f in models}
        return {f: (losses[at], pulls[at], [shared.lowered(f, sums[i]) for i in at]) for f, at in mine.items()}

    def evaluated(points):
        found = {}
        for f, sums in (together if shared is not None else apart)(stacked(points)).items():
            for key, loss, pull, slope in zip([key for key in points if key[0] == f], *sums, strict=True):
                x, (weights, _) = points[key], plain(f, points[key])
                loss, pull = loss / n[f], pull / n[f]
                slope = (slope / n[f] - mean[f] * pull + penalties[key[1]] * weights) * inverse[f]
                found[key] = loss + penalties[key[1]] / 2 * (weights @ weights), np.append(slope, pull)
        return found

    steps = {(f, c): minimise(np.zeros(widths[f] + 1), limit, tolerance) for f in maps for c in range(len(penalties))}
    points, final = {key: next(fit) for key, fit in steps.items()}, {}
    while points:
        for key, got in evaluated(points).items():
            try:
                points[key] = steps[key].send(got)
            except StopIteration as done:
                final[key] = done.value
                del points[key]
    return stacked({key: final[key] for key in steps})


def accuracies(
    data: DataFrame, maps: Sequence[Rows], penalties: Sequence[float], label: str, tolerance: float, limit: int = 100,
    size: int = BLOCK, shared: Shared | None = None,
) -> np.ndarray:
    """Accuracy on each fold (rows) of the model fitted on the others (``fits``) for each penalty (columns)."""
    models = fits(data, dict(enumerate(maps)), penalties, label, tolerance, limit, size, shared)

    def hits(values, signs, fold):
        found = []
        for f, (weights, shift) in models.items():
            y = signs[fold == f, None]
            called = np.where(maps[f](values[fold == f]) @ weights + shift > 0, 1, -1)
            found += [[len(y)], (called == y).sum(0)]
        return np.concatenate(found).astype(float)

    rows = _rows(data, label)
    counts = _sums(rows, rows.rdd.getNumPartitions(), hits, size).reshape(len(maps), -1)
    return counts[:, 1:] / counts[:, :1]


def called(values: Column, mapped: Rows, weights: np.ndarray, shift: float) -> Column:
    """1 for raw feature rows on the upper side of a fitted model, else 0."""

    @F.pandas_udf("int")
    def side(rows: pd.Series) -> pd.Series:
        blocks = [np.stack(rows.to_numpy()[a : a + BLOCK]) for a in range(0, len(rows), BLOCK)]
        return pd.Series(np.concatenate([mapped(x) @ weights + shift > 0 for x in blocks]).astype(np.int32))

    return side(values)
