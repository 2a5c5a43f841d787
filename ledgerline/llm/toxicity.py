"""A convolutional text classifier for toxicity, trained on all labelled rows and applied in numpy.

Words are hashed into one table of embeddings.  A word's vector is the sum of four rows:
two by hashes of the whole word, so two words share both only by two coincidences, and two
by its first four and five bytes, for words that are derived from one stem.  Filters of several
widths run over the word vectors of the whole text, each keeps its largest value, and a
linear layer gives the score.  The table starts at zero: words never seen in training
have no voice.  Labelled rows lie in blocks; in a round each task steps a network through the rows
of its blocks, and the changes are averaged in Spark.  Scores are calibrated on the scores that all
labelled rows get from networks which did not learn them, and so is each language's threshold; the
language is no input of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.blocks import binary_column
from ledgerline.llm.labelled import fold, learnable, perhaps_among, usable_labels
from ledgerline.llm.spans import LOWER, NOT_SPACE, U64, give_back, giving_back, pieces, running, span_hashes, text_bytes, word_ranges
from ledgerline.operators.ordering import running_totals
from ledgerline.sources.staging import stage

ROWS = 1 << 17  # of the embedding table
WIDTH = 8
STEMS = (4, 5)  # leading bytes of a word that are hashed too
SPANS = (1, 2, 3)  # filter widths in words
FILTERS = 8  # of each width
BLOCK = 2500  # labelled rows, about, that a network is stepped through between two averages
PARTS = 2  # of the labelled rows; each is scored for calibration by a network of the others
EPOCHS, LEAST_STEPS, BATCH, RATE, LEAK = 6, 400, 32, 0.01, 0.1
LEAST_DOCS = 4  # labelled ones that have a word, for it to be learned
CHUNK = 4096  # rows of parameters that are averaged together
UNIT = 2.0**20  # of fixed-point sums of changes, which are the same in any order
WEIGHT_UNIT = 2.0**24  # of those of a calibration step
LEAST_ROWS = 20  # of a language in each class, for a threshold of its own

# letters, digits and all other alphabets; the rest separates words
LETTERS = NOT_SPACE.copy()
LETTERS[:0x80] = False
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    LETTERS[_a:_b] = True


def word_blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The four table rows of every word, and each document's number of words, some documents at a time."""
    data, offsets = text_bytes(column)
    for a, b in pieces(offsets):
        low = offsets[a]
        bytes_ = LOWER[data[low : offsets[b]]]
        starts, ends, first = word_ranges(bytes_, offsets[a : b + 1] - low, LETTERS)
        sums = running(bytes_)
        keys = span_hashes(sums, starts, ends)
        stems = [span_hashes(sums, starts, np.minimum(ends, starts + n)) >> U64(n) for n in STEMS]
        rows = np.empty((len(keys), 4), np.int32)
        for c, x in enumerate((keys, keys >> U64(32), *stems)):
            rows[:, c] = x % U64(ROWS)
        yield rows, np.diff(first)


def word_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``word_blocks`` of a whole column at once."""
    blocks = [(np.zeros((0, 4), np.int32), np.zeros(0, np.int64)), *word_blocks(column)]
    rows, counts = zip(*blocks, strict=True)
    return np.concatenate(rows), np.concatenate(counts)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of some words' table rows, in ascending order, and which of them each word has."""
    one, two = (rows[:, c].astype(np.int64) * ROWS + rows[:, c + 1] for c in (0, 2))
    # two values below 2 ** 17 and a place below 2 ** 30
    one = one.astype(U64) << U64(30) | np.unique(two, return_inverse=True)[1].astype(U64)
    _, first, words = np.unique(one, return_index=True, return_inverse=True)
    return rows[first], words


def distinct_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_distinct`` of a whole column's words, some documents at a time, and each document's number of words."""
    kinds, words, counts, n = [np.zeros((0, 4), np.int32)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
    for rows, some in word_blocks(column):
        own, at = _distinct(rows)
        kinds.append(own)
        words.append((at + n).astype(np.uint32))
        counts.append(some)
        n += len(own)
    found, at = _distinct(np.concatenate(kinds))
    at = at.astype(np.uint16 if len(found) <= 1 << 16 else np.uint32)
    return found, at[np.concatenate(words)], np.concatenate(counts)


def word_vectors(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    found = table.take(rows[:, 0], 0, mode="clip")
    one = np.empty_like(found)
    for c in range(1, rows.shape[1]):
        found += table.take(rows[:, c], 0, out=one, mode="clip")
    return found


@dataclass
class Network:
    table: np.ndarray
    filters: list[np.ndarray]  # one (width * WIDTH, FILTERS) matrix for each span
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def pooled(self, vectors: np.ndarray, counts: np.ndarray):
        """Largest filter values of each document, after a ramp, and where they were found.

        Documents are padded with one span of zero vectors on the right, so a text with
        fewer words than a filter, or none, still has a value.
        """
        pad = max(SPANS)
        sizes = counts + pad
        at = np.arange(len(vectors)) + np.repeat(np.arange(len(counts)) * pad, counts)
        padded = np.zeros((int(sizes.sum()) + pad, WIDTH), np.float32)
        padded[at] = vectors
        begin = np.cumsum(sizes) - sizes
        values, places = [], []
        for span, weights, shift in zip(SPANS, self.filters, self.shifts, strict=True):
            n = len(padded) - pad
            raw = padded[:n] @ weights[:WIDTH]
            for i in range(1, span):
                raw += padded[i : i + n] @ weights[i * WIDTH : (i + 1) * WIDTH]
            best = np.maximum.reduceat(raw, begin, axis=0)
            values.append(np.maximum(best + shift, LEAK * (best + shift)))
            places.append((raw, best))
        return padded, sizes, begin, values, places

    def logits(self, vectors: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(counts):
            return np.zeros(0, np.float32)
        *_, values, _ = self.pooled(vectors, counts)
        return np.concatenate(values, axis=1) @ self.out + self.bias

    def raw_scores(self, rows: np.ndarray, counts: np.ndarray, words: int = 1 << 16) -> np.ndarray:
        """The linear layer's values, some documents at a time."""
        found = [np.zeros(0, np.float64)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        for a, b in pieces(ends + np.arange(len(ends)), words):
            vectors = word_vectors(self.table, rows[ends[a] : ends[b]])
            found.append(self.logits(vectors, counts[a:b]).astype(np.float64))
        return np.concatenate(found)

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -40, 40)))

    def scores(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return self.calibrated(self.raw_scores(rows, counts))


def new_network(seed: int = 7) -> Network:
    r = np.random.default_rng(seed)
    return Network(
        np.zeros((ROWS, WIDTH), np.float32),
        [r.normal(0, 0.5 / np.sqrt(s), (s * WIDTH, FILTERS)).astype(np.float32) for s in SPANS],
        [np.full(FILTERS, 0.1, np.float32) for _ in SPANS],
        r.normal(0, 0.3, len(SPANS) * FILTERS).astype(np.float32),
        0.0,
    )


def slopes(net: Network, params: list, mine: np.ndarray, counts: np.ndarray, labels: np.ndarray, weight: np.ndarray):
    """Slopes of the weighted logistic loss: the words that have one, theirs by word vector, and those of all parameters but the table."""
    k = len(SPANS)
    net.filters, net.shifts, net.out, net.bias = params[1 : 1 + k], params[1 + k : 1 + 2 * k], params[-2], params[-1][0]
    padded, sizes, begin, values, places = net.pooled(word_vectors(params[0], mine), counts)
    hidden = np.concatenate(values, axis=1)
    error = (1 / (1 + np.exp(-np.clip(hidden @ net.out + net.bias, -30, 30))) - labels) * weight
    error = error.astype(np.float32)
    grads = [*[np.zeros_like(p) for p in net.filters], *[None] * k, hidden.T @ error, error.sum(keepdims=True)]
    back = error[:, None] * net.out * np.where(hidden > 0, 1, LEAK).astype(np.float32)
    d_padded = np.zeros_like(padded)
    met = []
    for j, (span, (raw, best)) in enumerate(zip(SPANS, places, strict=True)):
        d = back[:, j * FILTERS : (j + 1) * FILTERS]
        grads[k + j] = d.sum(0)
        # the first place of each document that has the largest value
        at, column = np.divmod(np.flatnonzero(raw == np.repeat(best, sizes, axis=0)), FILTERS)
        own = (np.searchsorted(begin, at, "right") - 1) * FILTERS + column
        place = np.full(best.size, len(raw))
        place[own[::-1]] = at[::-1]
        place = place.reshape(best.shape)
        for o in range(span):
            own = slice(o * WIDTH, (o + 1) * WIDTH)
            grads[j][own] = np.einsum("dfw,df->wf", padded[place + o], d)
            np.add.at(d_padded, place + o, d[:, :, None] * params[1 + j][own].T[None])
            met.append((place + o).ravel())
    met = np.unique(np.concatenate(met))
    doc = np.searchsorted(begin, met, "right") - 1
    met, doc = (x[(met - begin[doc] < counts[doc]) & d_padded[met].any(1)] for x in (met, doc))
    return met - doc * max(SPANS), d_padded[met], grads


def gradients(net: Network, params: list, mine: np.ndarray, counts: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Slopes of the weighted logistic loss by table, filters, shifts, output weights and bias."""
    touched, d_words, grads = slopes(net, params, mine, counts, labels, weight)
    table = np.zeros_like(params[0])
    for c in range(mine.shape[1]):
        np.add.at(table, mine[touched, c], d_words)
    return [table, *grads]


def packed(params: list[np.ndarray]) -> np.ndarray:
    """All parameters as rows of ``WIDTH`` values, those of the table first."""
    dense = np.concatenate([p.ravel() for p in params[1:]])
    return np.vstack([params[0], np.pad(dense, (0, -len(dense) % WIDTH)).reshape(-1, WIDTH)])


def unpacked(rows: np.ndarray, size: int) -> list[np.ndarray]:
    """Copies of the parameters in ``rows``, of which the first ``size`` are the table's."""
    k = len(SPANS)
    shapes = [*[(span * WIDTH, FILTERS) for span in SPANS], *[(FILTERS,)] * k, (k * FILTERS,), (1,)]
    cuts = np.cumsum([np.prod(shape) for shape in shapes])
    dense = np.split(rows[size:].ravel(), cuts)[: len(shapes)]
    return [rows[:size].copy(), *[p.reshape(shape).copy() for p, shape in zip(dense, shapes, strict=True)]]


def network(rows: np.ndarray, used: np.ndarray) -> Network:
    """The network of packed parameters whose first rows are the ``used`` ones of the table."""
    params, k = unpacked(rows, len(used)), len(SPANS)
    net = Network(np.zeros((ROWS, WIDTH), np.float32), params[1 : 1 + k], params[1 + k : 1 + 2 * k], params[-2], float(params[-1][0]))
    net.table[used] = params[0]
    return net


def whole(rows: np.ndarray) -> np.ndarray:
    """The rows of a contiguous matrix as one item each, in the same memory."""
    return rows.view(f"V{rows.itemsize * rows.shape[1]}")[:, 0]


def take_steps(params: list[np.ndarray], local: np.ndarray, counts: np.ndarray, labels: np.ndarray, weight: np.ndarray, passes: int, seed) -> None:
    """Change ``params`` by passes of Adam steps on the logistic loss over some documents.

    ``local`` has the four places of every word among the table rows; the last row stays zero.  A table row that has had no
    slope yet has no moments and does not change, so only the others take part, in the order of their first slope.
    """
    net, r = new_network(), np.random.default_rng(seed)
    table = params[0]
    last, n = len(table) - 1, 0
    slot, met = np.full(len(table), -1), np.empty(last, np.int64)  # place in that order of each table row, and the other way
    every = np.zeros((4, *table.shape), table.dtype)  # of rows met: values, both moments and the step
    others = [(p, np.zeros_like(p), np.zeros_like(p), np.zeros_like(p)) for p in params[1:]]
    ends = np.concatenate([[0], np.cumsum(counts)])
    step = 0
    for _ in range(passes):
        order = r.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            docs = order[i : i + BATCH]
            mine = np.concatenate([local[ends[d] : ends[d + 1]] for d in docs]).astype(np.intp)
            touched, d_words, grads = slopes(net, params, mine, counts[docs], labels[docs], weight[docs] / len(docs))
            rows = mine[touched]
            new = np.unique(rows[slot[rows] < 0])
            new = new[new != last]
            slot[new] = np.arange(n, n + len(new))
            met[n : n + len(new)] = new
            every[0, n : n + len(new)] = table[new]
            n += len(new)
            grad = np.zeros((n, WIDTH), table.dtype)
            for c in range(rows.shape[1]):
                known = rows[:, c] != last
                np.add.at(grad, slot[rows[known, c]], d_words[known])
            step += 1
            # in place: m += 0.1 * (grad - m), v += 0.001 * (grad * grad - v), and a step of RATE by m over the root of v
            for (p, m, v, x), grad in zip([every[:, :n], *others], [grad, *grads], strict=True):
                np.subtract(grad, m, out=x)
                m += np.multiply(x, 0.1, out=x)
                np.multiply(grad, grad, out=x)
                x -= v
                v += np.multiply(x, 0.001, out=x)
                np.sqrt(np.divide(v, 1 - 0.999**step, out=x), out=x)
                x += 1e-8
                np.divide(m, x, out=x)
                p -= np.multiply(x, RATE / (1 - 0.9**step), out=x)
            # a row is one item here, as numpy sets items faster than rows
            whole(table)[met[:n]] = whole(every[0, :n])


def known_places(rows: np.ndarray, counts: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every word's places among the ``used`` rows, and each document's number of words left.

    Other rows have the place after the last.  Words that have no used row are zero vectors;
    of a longer stretch of them as many stay as the widest filter spans, which leaves the
    same values to pool.
    """
    at = np.searchsorted(used, rows).astype(np.int32)
    at[at == len(used)] = 0
    known = used[at] == rows if len(used) else np.zeros(rows.shape, bool)
    at[~known] = len(used)
    keep, left = shortened(~known.any(1), counts)
    return at[keep], left


def shortened(blank: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words stay when stretches of ``blank`` ones are shortened, and each document's number of them."""
    first = np.concatenate([[0], np.cumsum(counts)])
    starts = np.zeros(len(blank) + 1, bool)
    starts[first] = True
    place = np.arange(len(blank))
    # the place of the last word that ends a stretch: one that is known, or a document's first
    last = np.maximum.accumulate(np.where(~blank, place, np.where(starts[:-1], place - 1, -1))) if len(blank) else place
    keep = ~blank | (place - last <= max(SPANS))
    return keep, np.diff(np.concatenate([[0], np.cumsum(keep)])[first])


BLOCKS = "block long, rows binary, words binary, counts binary, labels binary, parts binary, langs array<string>"


def _block(table: pa.Table) -> pa.Table:
    """One row for the documents of a block: different words' table rows, and which of them each word is."""
    table = table.sort_by([("doc_id", "ascending"), ("mark", "ascending")]).combine_chunks()
    rows, words, counts = distinct_rows(table["text"].combine_chunks())
    numbers = [table[c].to_numpy().astype(np.int8) for c in ("label", "part")]
    give_back()
    return pa.table({
        "block": table["block"][:1],
        **{k: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for k, x in
           zip(("rows", "words", "counts", "labels", "parts"), (rows, words, counts.astype(np.int64), *numbers), strict=True)},
        "langs": pa.array([table["lang"].to_pylist()], pa.list_(pa.string())),
    })


def _labelled_block(texts: pa.Table, labelled: pa.Table) -> pa.Table:
    """``_block`` of the texts whose ids are among the block's labelled ones, which may repeat."""
    ids, first = np.unique(labelled["doc_id"].to_numpy(), return_index=True)
    if not len(ids):  # the filter before let other ids pass
        kinds = [pa.int64(), *[pa.binary()] * 5, pa.list_(pa.string())]
        return pa.schema([(x.split()[0], kind) for x, kind in zip(BLOCKS.split(", "), kinds, strict=True)]).empty_table()
    own = texts["doc_id"].to_numpy()
    at = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
    found = np.flatnonzero(ids[at] == own)
    texts = texts.take(found)
    for name in ("label", "part"):
        texts = texts.append_column(name, pa.array(labelled[name].to_numpy()[first[at[found]]]))
    return _block(texts)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Number, different words' rows, words, documents' numbers of words, labels, parts and languages of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            block, rows, words, counts, labels, parts, langs = (batch.column(c)[i].as_py() for c in range(batch.num_columns))
            counts = np.frombuffer(counts, np.int64)
            width = len(words) // max(1, counts.sum())
            yield (
                block, np.frombuffer(rows, np.int32).reshape(-1, 4), np.frombuffer(words, np.uint16 if width == 2 else np.uint32),
                counts, np.frombuffer(labels, np.int8), np.frombuffer(parts, np.int8), langs,
            )


@contextmanager
def block_by_block(spark: SparkSession) -> Iterator[None]:
    """Jobs inside hand each block to Python on its own, so that a task's memory does not grow with its number of blocks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _in_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents each table row occurs."""
    total = np.zeros(ROWS, np.int64)
    for _, rows, words, counts, *_ in _opened(batches):
        ends = np.cumsum(counts)
        for a, b in zip(ends - counts, ends, strict=True):
            total[np.unique(rows[words[a:b]])] += 1
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["row", "n"])


def _mean(table: pa.Table) -> pa.Table:
    """The mean change of some rows of a network's parameters, each over the blocks that have it."""
    total = sum(np.frombuffer(x, np.int64) for x in table["sums"].to_pylist()).reshape(-1, WIDTH + 1)
    mean = (total[:, :-1] / UNIT / np.maximum(total[:, -1:], 1)).astype(np.float32)
    return pa.table({"net": table["net"][:1], "start": table["start"][:1], "change": pa.array([mean.tobytes()], pa.binary())})


def train(blocks: DataFrame, used: np.ndarray, sizes: np.ndarray, each: int, seed: int = 7) -> list[np.ndarray]:
    """Packed parameters of the networks that leave out one part, and of the one of all rows, by Adam on
    the logistic loss, both classes weighing the same.

    ``sizes`` counts rows by part and label; ``each`` is a block's usual number.  All networks take a round in one job: each block is
    stepped through from the same parameters, and a parameter's changes are averaged over the blocks that have its word.
    Sums are of whole numbers, so that no order of tasks shows.
    """
    net, size = new_network(seed), len(used)
    first = packed([np.zeros((size, WIDTH), np.float32), *net.filters, *net.shifts, net.out, np.zeros(1, np.float32)])
    nets = [first.copy() for _ in range(PARTS + 1)]
    left = np.array([sizes.sum(0) - (sizes[m] if m < PARTS else 0) for m in range(PARTS + 1)])
    share = np.clip(left / np.maximum(left.sum(1, keepdims=True), 1), 1e-6, 1)
    rounds = EPOCHS if sizes.sum() > each else 1
    passes = -(-max(EPOCHS, -(-LEAST_STEPS // -(-int(min(each, sizes.sum())) // BATCH))) // rounds)
    context = blocks.sparkSession.sparkContext
    for turn in range(rounds):
        shared = context.broadcast((nets, used))

        def changes(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            nets, used = shared.value
            total = np.zeros((len(nets), len(nets[0]), WIDTH + 1), np.int64)
            for block, rows, words, counts, labels, parts, _ in _opened(batches):
                at = np.searchsorted(used, rows)
                at[at == size] = 0
                known = used[at] == rows if size else np.zeros(rows.shape, bool)
                own = np.unique(at[known])  # this block's rows of the table
                places = np.where(known, np.searchsorted(own, at), len(own)).astype(np.int32)
                keep, counts = shortened(~known.any(1)[words], counts)
                local = places[words[keep]]
                for m, start in enumerate(nets):
                    docs = parts != m
                    if not docs.any():
                        continue
                    mine = local if docs.all() else local[np.repeat(docs, counts)]
                    picked = np.concatenate([own, np.arange(size, len(start))])
                    before = start[picked]
                    params = unpacked(before, len(own))
                    params[0] = np.vstack([params[0], np.zeros((1, WIDTH), np.float32)])
                    y = labels[docs].astype(np.int64)
                    take_steps(params, mine, counts[docs], y, (0.5 / share[m][y]).astype(np.float32), passes, [seed, turn, block, m])
                    params[0] = params[0][:-1]
                    total[m, picked, :-1] += np.rint((packed(params).astype(np.float64) - before) * UNIT).astype(np.int64)
                    has = np.zeros(len(own) + 1, bool)
                    has[mine] = True
                    total[m, own[has[:-1]], -1] += 1
                    total[m, size:, -1] += 1
            for m in range(len(nets)):
                for a in range(0, len(nets[0]), CHUNK):
                    part = total[m, a : a + CHUNK]
                    if part[:, -1].any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([m], pa.int32()), pa.array([a], pa.int64()), pa.array([part.tobytes()], pa.binary())],
                            names=["net", "start", "sums"],
                        )

        # a task for each core, as every task sends as much as a network has
        sums = blocks.coalesce(context.defaultParallelism).mapInArrow(giving_back(changes), "net int, start long, sums binary")
        with block_by_block(blocks.sparkSession):
            means = sums.groupBy("net", "start").applyInArrow(_mean, "net int, start long, change binary").collect()
        for r in means:
            change = np.frombuffer(r.change, np.float32).reshape(-1, WIDTH)
            nets[r.net][r.start : r.start + len(change)] += change
        shared.unpersist()
    return nets


def best_thresholds(curve: DataFrame, net: Network) -> dict[str | None, float]:
    """By language, and for all rows under null, the middle of the gap between scores that gives the
    largest F1, nearest to 0.5 if tied.

    ``curve`` has, for each language and different logit, how many rows and rows of class 1 are not below it (``cum_n, cum_one``),
    the logit below it (``next_logit``) and the language's rows of class 1 (``ones``).
    """

    def probability(x: str) -> Column:
        limited = F.least(F.greatest(net.scale * F.col(x) + net.shift, F.lit(-40.0)), F.lit(40.0))
        return 1 / (1 + F.exp(-limited))

    score = probability("logit")
    after = F.when(F.col("next_logit").isNull(), 0.0).otherwise(probability("next_logit"))
    points = curve.select(
        "every", "lang", score.alias("score"), after.alias("after"), (2 * F.col("cum_one") / (F.col("cum_n") + F.col("ones"))).alias("f1")
    )
    # logits apart may still have one score
    middle = (F.col("score") + F.col("after")) / 2
    best = points.where("score != after").groupBy("every", "lang").agg(
        F.max(F.struct("f1", -F.abs(middle - 0.5), middle.alias("middle"))).alias("best")
    )
    return {None if r.every else r.lang: r.best.middle for r in best.collect()}


def calibrate(net: Network, found: DataFrame) -> None:
    """Set scale and shift by a logistic fit, then the thresholds of all and of each language.

    ``found`` has ``lang, label, logit`` of every labelled row.  The shift is moved so that a score of 0.5 is the
    common threshold of the best F1.
    """
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps with a weak pull towards (1, 0)

        def slopes(batches: Iterator[pa.RecordBatch], a=a, b=b) -> Iterator[pa.RecordBatch]:
            total = np.zeros(5, np.int64)
            for batch in batches:
                x = np.clip(batch.column(0).to_numpy(), -15, 15)
                p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
                w, error = p * (1 - p), p - batch.column(1).to_numpy()
                total += np.rint(np.stack([error * x, error, w * x * x, w * x, w]) * WEIGHT_UNIT).astype(np.int64).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array([t]) for t in total], names=list("abcde"))

        rows = found.select("logit", "label").mapInArrow(slopes, "a long, b long, c long, d long, e long").collect()
        ga, gb, haa, hab, hbb = np.array(rows, np.int64).sum(0) / WEIGHT_UNIT
        step = np.linalg.solve([[haa + 1, hab], [hab, hbb + 0.01]], [ga + (a - 1), gb + 0.01 * b])
        a, b = (float(v) for v in np.array([a, b]) - step / max(1.0, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    net.scale, net.shift = float(np.clip(a, 0.05, 5)), float(b)

    # every row counts among all, and in its language
    among = F.explode(F.array(
        F.struct(F.lit(True).alias("every"), F.lit("").alias("lang")), F.struct(F.lit(False).alias("every"), F.col("lang"))
    ))
    slots = found.select("logit", "label", among.alias("slot")).select("slot.*", "logit", "label").where("lang IS NOT NULL")
    points = stage(slots.groupBy("every", "lang", "logit").agg(F.sum("label").alias("one"), F.count(F.lit(1)).alias("n")), "logits")
    ones = points.groupBy("every", "lang").agg(F.sum("one").alias("ones"), F.sum("n").alias("rows"))
    enough = F.col("every") | (F.least("ones", F.col("rows") - F.col("ones")) >= LEAST_ROWS)
    totals = running_totals(points, "logit", ["one", "n"], ["every", "lang"], descending=True, carry=["logit"])
    curve = stage(totals.join(ones.where(enough), ["every", "lang"]), "curve")
    common = best_thresholds(curve.where("every"), net)[None]
    net.shift -= float(np.log(common / (1 - common)))
    net.threshold = 0.5
    net.thresholds = dict(sorted(best_thresholds(curve.where("NOT every"), net).items()))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", each: int = BLOCK) -> Network:
    """A calibrated network from all labelled rows outside fold 0.

    Executors hash the words of blocks of about ``each`` rows and write them once, count in how many documents each table row
    occurs, step networks through the blocks and score every row by a network that did not learn its part.  The driver gets
    counts, the table rows that ``LEAST_DOCS`` documents have (at most those of the table), and of each round the averaged changes.
    Words of fewer documents would only let the network learn those documents by heart.  Copies of one document under one id
    share a block.  Without labelled rows of both classes the network is untrained and scores every text alike.
    """
    spark = docs.sparkSession
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).cast("int").alias("part")
    usable, texts = usable_labels(labels, label), learnable(docs)
    # ids meet labels first, so that each labelled text is moved once, to its block, and of the others few are
    named = texts.select("doc_id", F.xxhash64("text").alias("mark")).join(usable, "doc_id")
    rows = stage(named.select("doc_id", "mark", "label", part), "labelled_ids")
    sizes = np.zeros((PARTS, 2), np.int64)
    for r in rows.groupBy("part", "label").count().collect():
        sizes[r.part, r.label] = r["count"]
    if not sizes.sum(0).all():
        return new_network()
    number = -(-int(sizes.sum()) // each)
    block = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(number).cast("long"))
    marked = perhaps_among(texts, usable).withColumn("mark", F.xxhash64("text")).withColumn("block", block)
    sides = [x.repartition(number, "block").groupBy("block") for x in (marked, rows.withColumn("block", block))]
    blocks = stage(sides[0].cogroup(sides[1]).applyInArrow(_labelled_block, BLOCKS), "labelled")

    common = blocks.mapInArrow(giving_back(_in_documents), "row long, n long").groupBy("row").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
    used = np.sort(common.select("row").toArrow()["row"].to_numpy()).astype(np.int32)
    nets = [network(x, used) for x in train(blocks, used, sizes, each)]
    trained = spark.sparkContext.broadcast(nets[:PARTS])

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, words, counts, labels, parts, langs in _opened(batches):
            for m, net in enumerate(trained.value):
                docs = parts == m
                values = net.raw_scores(rows[words[np.repeat(docs, counts)]], counts[docs])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, d in zip(langs, docs, strict=True) if d], pa.string()), pa.array(labels[docs], pa.int32()), pa.array(values)],
                    names=["lang", "label", "logit"],
                )

    with block_by_block(spark):
        found = stage(blocks.mapInArrow(giving_back(logits), "lang string, label int, logit double"), "scored")
    calibrate(nets[PARTS], found)
    return nets[PARTS]


def with_scores(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with ``score``, and ``threshold``, that of the row's language."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        found = [shared.value.scores(*block) for block in word_blocks(texts)]
        give_back()
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    limit = F.lit(net.threshold)
    for lang, value in net.thresholds.items():
        limit = F.when(F.col("lang").cast("string") == lang, value).otherwise(limit)
    return docs.withColumns({"score": scores(F.col("text").cast("string")), "threshold": limit})


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, held_out, score, predicted, threshold, rejected`` for every row of ``docs``.

    ``predicted`` is 1 from a score of 0.5; ``rejected`` holds from the threshold of the
    row's language, or the common one where the language is null or was too rare.  Null
    and empty texts, and rows with a null id, are scored like any other text; other columns
    are ignored; repeated rows get equal scores; an empty table gives no rows.
    """
    scored = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), net)
    return scored.select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", (F.col("score") >= F.col("threshold")).alias("rejected"),
    )


def without_toxic(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    wanted = {"text": f"c{names.index('text')}", "lang": f"c{names.index('lang')}"}
    scored = with_scores(plain.withColumns({k: F.col(v) for k, v in wanted.items()}), net)
    return scored.where(F.col("score") < F.col("threshold")).select(*plain.columns).toDF(*names)
