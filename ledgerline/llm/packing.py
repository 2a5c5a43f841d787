"""Packing of documents into training sequences, online, by sums of squares.

Every task packs the documents of its own input split as they come: no shuffle, no sort,
and a lost task packs the same split again.  A level array counts the open sequences by
fill.  A document's whole sequences are cut off first; the rest goes where the sum of the
squared counts of partially filled sequences becomes least, which keeps fills of all
levels at hand and so leaves few sequences open.  What is open at the end of the split is
closed by one more cut: the open remainders are laid end to end, so that a task pads at
most one sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import binary_column
from ledgerline.llm.spans import giving_back
from ledgerline.llm.tokens import encoder

CAPACITY = 2048
OPEN_MOST = 2048  # open sequences of a task before the fullest half is closed; bounds memory
TASK_SHIFT = 33  # sequences of one task below this power of two

OUT = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class LevelArray:
    """Open sequences by fill, and the choice among them."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0

    def place(self, size: int) -> tuple[int, int | None]:
        """The fill to put ``size`` tokens on and the sequence taken there; None: a new one."""
        n = self.counts
        last = self.capacity - size
        # change of the sum of squares when a sequence of fill h becomes one of h + size;
        # fills of zero and of the whole capacity don't count
        change = 2 * n[size : last + size + 1] - 2 * n[: last + 1] + 2
        change[0] = 2 * n[size] + 1
        change[last] = -2 * n[last] + 1
        if last == 0:
            return 0, None
        change[1:][n[1 : last + 1] == 0] = np.iinfo(np.int64).max
        level = int(np.argmin(change))
        if level == 0:
            return 0, None
        return level, self.take(level)

    def take(self, level: int) -> int:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def put(self, level: int, sequence: int) -> None:
        if level < self.capacity:
            self.counts[level] += 1
            self.n_open += 1
            self.open[level].append(sequence)


class Packer:
    """Pieces of one task: (doc, start, ids, document's tokens, sequence, offset)."""

    def __init__(self, capacity: int, first_sequence: int) -> None:
        self.levels = LevelArray(capacity)
        self.capacity, self.next = capacity, first_sequence
        self.held: dict[int, list[tuple]] = {}

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        n, at = len(ids), 0
        while n - at >= self.capacity:
            yield doc, at, ids[at : at + self.capacity], n, self._new(), 0
            at += self.capacity
        if at == n:
            return
        size = n - at
        fill, sequence = self.levels.place(size)
        sequence = self._new() if sequence is None else sequence
        pieces = self.held.setdefault(sequence, [])
        pieces.append((doc, at, ids[at:].copy(), n, sequence, fill))
        self.levels.put(fill + size, sequence)
        if fill + size == self.capacity:
            yield from self.held.pop(sequence)
        if self.levels.n_open > OPEN_MOST:
            yield from self._close(self.levels.n_open // 2)

    def _close(self, how_many: int) -> Iterator[tuple]:
        """Lay the fullest open sequences end to end and cut them at the capacity."""
        pieces: list[tuple] = []
        level = self.capacity - 1
        while how_many and level:
            while how_many and self.levels.counts[level]:
                pieces += self.held.pop(self.levels.take(level))
                how_many -= 1
            level -= 1
        sequence, fill = self._new(), 0
        for doc, start, ids, n, _, _ in pieces:
            while len(ids):
                part = ids[: self.capacity - fill]
                yield doc, start, part, n, sequence, fill
                start, ids, fill = start + len(part), ids[len(part) :], fill + len(part)
                if fill == self.capacity:
                    sequence, fill = self._new(), 0

    def finish(self) -> Iterator[tuple]:
        yield from self._close(self.levels.n_open)


def _table(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    docs, starts, ids, totals, sequences, fills = zip(*rows, strict=True)
    lengths = np.array([len(x) for x in ids], np.int64)
    data = np.concatenate(ids).astype("<u4").view(np.uint8)
    columns = [
        pa.array(docs, kind),
        pa.array(starts, pa.int64()),
        pa.array(lengths),
        pa.array(totals, pa.int64()),
        pa.array(sequences, pa.int64()),
        pa.array(fills, pa.int64()),
        binary_column(data, lengths * 4),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in OUT.split(", ")])


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document and their places in sequences of at most ``capacity`` tokens.

    A document is its ids under the vocabulary file and then ``end_id``, so null and empty
    texts are one token.  A row for each piece: ``doc_id, start, length, doc_tokens,
    sequence_id, offset`` and the piece's ``ids``, little-endian and 32 bits each.
    Sequences belong to one task; only its last one can be short.  A null doc_id stays
    null; equal rows are packed each on its own; other columns are ignored; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(vocabulary), Packer(capacity, TaskContext.get().partitionId() << TASK_SHIFT)
        rows: list[tuple] = []
        for batch in batches:
            ids, counts = encode.ids_of(batch.column(1))
            at = 0
            for doc, n in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
                own = np.append(ids[at : at + n], np.uint32(end_id))
                at += n
                rows += packer.add(doc, own)
            if rows:
                yield _table(rows, pa.int64())
                rows = []
        rows += packer.finish()
        if rows:
            yield _table(rows, pa.int64())

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(giving_back(run), OUT)
