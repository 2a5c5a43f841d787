"""Text quality by a generalised additive model with pairwise interactions.

Every feature has a table of one value for each of its bins, and some pairs of features
have a table of bins by bins.  The tables are learned by cyclic boosting: in turn each
feature gets a shallow tree on the logistic loss, added to its table at a small rate.
Pairs are then chosen by how much a tree of one cut on either feature would still gain.
A score is the sum of table lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.labelled import class_counts, fold, labelled_sample
from ledgerline.llm.spans import NOT_SPACE, pieces, running, span_hashes, text_bytes, word_ranges

PER_CLASS = 6000  # labelled rows of either class that are fitted at most
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 120, 60, 8, 0.15
LEAVES, LEAST_WEIGHT, PULL = 4, 8.0, 2.0

FEATURES = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "stops", "exclaims", "bars", "markup",
    "other_alphabets", "log_lines", "line_words", "repeated_lines", "repeated_words", "plain_words", "mixed_words",
    "symbol_ends", "capital_words", "shout_words", "lines_closed", "controls", "brackets", "longest_word",
)


def _class(*ranges: tuple[int, int] | str) -> np.ndarray:
    found = np.zeros(256, bool)
    for x in ranges:
        if isinstance(x, str):
            found[list(x.encode())] = True
        else:
            found[x[0] : x[1]] = True
    return found


UPPER, LOWER_CASE, DIGIT = _class((0x41, 0x5B)), _class((0x61, 0x7B)), _class((0x30, 0x3A))
HIGH = _class((0x80, 0x100))
LETTER = UPPER | LOWER_CASE | HIGH
CLASSES = {
    "upper": UPPER, "digits": DIGIT, "symbols": _class("#$%&*+=@^_~\\"), "stops": _class(".,;:?"),
    "exclaims": _class("!"), "bars": _class("|"), "markup": _class("<>"), "other_alphabets": HIGH,
    "controls": _class((0, 9), (14, 32), (127, 128)), "brackets": _class("()[]{}"),
}
NOT_FEED = ~_class("\n\r")


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def _repeated(hashes: np.ndarray, owner: np.ndarray, n: int, least: np.ndarray | None = None) -> np.ndarray:
    """Share of items that an earlier item of the same document equals."""
    counts = np.bincount(owner, minlength=n)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (o[1:] == o[:-1])])
    return np.bincount(o, weights=same, minlength=n) / np.maximum(counts, 1)


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    size = np.diff(offsets)
    a, b = offsets[:-1], offsets[1:]
    starts, ends, first = word_ranges(data, offsets, NOT_SPACE)
    words = np.diff(first)
    owner = np.repeat(np.arange(n), words)
    per_word = lambda x: np.bincount(owner, weights=x, minlength=n) / np.maximum(words, 1)
    sums = running(data)
    out = np.zeros((n, len(FEATURES)), np.float32)
    put = lambda name, x: out.__setitem__((slice(None), FEATURES.index(name)), x)
    put("log_bytes", np.log1p(size))
    put("log_words", np.log1p(words))
    put("word_length", per_word(ends - starts))
    for name, which in CLASSES.items():
        put(name, _sums(which[data], a, b) / np.maximum(size, 1))
    letters = _sums(LETTER[data], starts, ends)
    upper = _sums(UPPER[data], starts, ends)
    length = ends - starts
    put("plain_words", per_word(letters == length))
    put("mixed_words", per_word((letters > 0) & (letters < length - 1)))
    put("shout_words", per_word((upper >= 2) & (upper == letters)))
    if len(starts):
        put("capital_words", per_word(UPPER[data[starts]]))
        put("symbol_ends", per_word(~(LETTER | DIGIT | CLASSES["stops"])[data[ends - 1]]))
        longest = np.zeros(n)
        np.maximum.at(longest, owner, length)
        put("longest_word", np.log1p(longest))
    put("repeated_words", _repeated(span_hashes(sums, starts, ends), owner, n))
    l_starts, l_ends, l_first = word_ranges(data, offsets, NOT_FEED)
    lines = np.diff(l_first)
    l_owner = np.repeat(np.arange(n), lines)
    put("log_lines", np.log1p(lines))
    put("line_words", np.log1p(words / np.maximum(lines, 1)))
    put("repeated_lines", _repeated(span_hashes(sums, l_starts, l_ends), l_owner, n))
    if len(l_starts):
        closed = _class(".?!")[data[l_ends - 1]]
        put("lines_closed", np.bincount(l_owner, weights=closed, minlength=n) / np.maximum(lines, 1))
    return out


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each whole text; null reads as empty."""
    data, offsets = text_bytes(column)
    made = [_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in pieces(offsets)]
    return np.concatenate([np.zeros((0, len(FEATURES)), np.float32), *made])


@dataclass
class Additive:
    """Intercept, bin edges, one table for each feature, and tables of pairs."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # bin -> bin of the pair tables
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)], axis=1)

    def logits(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.full(len(x), 1 / (1 + np.exp(-self.intercept)))
        return 1 / (1 + np.exp(-np.clip(self.logits(self.bins(x)), -40, 40)))


def _gain(g, h):
    return g * g / (h + PULL)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree of at most ``LEAVES`` leaves over ordered bins with sums ``g`` and ``h``."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        best = (1e-9, None, None)
        for a, b in leaves:
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gr, hr = g[a:b].sum() - gl, h[a:b].sum() - hl
            gain = np.where((hl * 4 >= LEAST_WEIGHT) & (hr * 4 >= LEAST_WEIGHT), _gain(gl, hl) + _gain(gr, hr) - _gain(gl + gr, hl + hr), 0)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], (a, b), a + at + 1)
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + PULL)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a table on both of its features, its gain and its values."""
    quads = []
    for x in (g, h):
        c = x.cumsum(0).cumsum(1)
        ll = c[:-1, :-1]
        lr, rl = c[:-1, -1:] - ll, c[-1:, :-1] - ll
        quads.append((ll, lr, rl, c[-1, -1] - ll - lr - rl))
    gains = sum(_gain(a, b) for a, b in zip(*quads, strict=True)) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(np.argmax(gains), gains.shape)
    v = [float(a[i, j] / (b[i, j] + PULL)) for a, b in zip(*quads, strict=True)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gains[i, j]), out


def train(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fit the tables to rows of features and labels of 0 and 1."""
    model = Additive()
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model.intercept = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return model
    model.edges = [np.unique(np.quantile(x[:, i], np.arange(1, BINS) / BINS)).astype(np.float32) for i in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [np.arange(len(e) + 1) * min(PAIR_BINS, len(e) + 1) // (len(e) + 1) for e in model.edges]
    bins = model.bins(x)
    logit = np.full(len(y), model.intercept)

    def sums(at, size):
        p = 1 / (1 + np.exp(-logit))
        return np.bincount(at, weights=y - p, minlength=size), np.bincount(at, weights=p * (1 - p), minlength=size)

    for _ in range(ROUNDS):
        for i, table in enumerate(model.tables):
            if len(table) > 1:
                step = RATE * _tree(*sums(bins[:, i], len(table)))
                table += step
                logit += step[bins[:, i]]

    cells = {}
    gains = []
    for i in range(len(model.edges)):
        for j in range(i):
            shape = (model.coarse[j][-1] + 1, model.coarse[i][-1] + 1)
            if min(shape) > 1:
                at = model.coarse[j][bins[:, j]] * shape[1] + model.coarse[i][bins[:, i]]
                g, h = (z.reshape(shape) for z in sums(at, shape[0] * shape[1]))
                gains.append((_cross(g, h)[0], j, i))
                cells[j, i] = (at, shape)
    for _, j, i in sorted(gains, reverse=True)[:PAIRS]:
        model.pairs.append((j, i))
        model.pair_tables.append(np.zeros(cells[j, i][1]))
    for _ in range(PAIR_ROUNDS):
        for pair, table in zip(model.pairs, model.pair_tables, strict=True):
            at, shape = cells[pair]
            step = RATE * _cross(*(z.reshape(shape) for z in sums(at, shape[0] * shape[1])))[1]
            table += step
            logit += step.reshape(-1)[at]
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Additive:
    """A model from at most ``2 * per_class`` labelled rows outside fold 0.

    Executors compute the features; the driver gets one small row for each sampled text.
    The intercept is set back to the classes' shares among all labels outside fold 0.
    Without labelled rows every text gets 0.5.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([r.tobytes() for r in features(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), rows], names=["doc_id", "label", "x"])

    sample = labelled_sample(docs, labels, label, per_class).select("doc_id", "text", "label")
    got = sample.mapInArrow(made, "doc_id long, label int, x binary").collect()
    got.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    if not got:
        return Additive()
    y = np.array([r.label for r in got], float)
    model = train(np.stack([np.frombuffer(bytes(r.x), np.float32) for r in got]), y)
    n = [count + 0.5 for count in class_counts(labels, label)]
    if 0 < y.sum() < len(y):
        model.intercept += float(np.log(n[1] / n[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return model


def score(docs: DataFrame, model: Additive, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null and empty texts are scored as a text of length zero; a null doc_id is scored and
    not held out; other columns are ignored; repeated rows get equal scores; an empty table
    gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(features(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = wanted.mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
