"""Removal of repeated byte strings with a logarithmic family of sorted fingerprint sets.

The levels stand in for suffix arrays: they hold 64-bit fingerprints of strings of the texts in
ascending order and are searched for equal ones; no suffixes are ordered and no match lengths
computed.  Strings are sampled by content: every window of ``width`` bytes is anchored at the
least hash among its ``gram``-byte strings.  Consecutive windows with the same anchor value form
a unit, so a passage that two documents share is cut into the same units in both, save
those that reach beyond its ends.

1. Every block of documents sends its distinct units, ordered by anchor.  A key range takes
   the blocks in ascending order as batches: each batch's set is looked up in the levels built
   so far, then becomes a level, and levels of like size are merged.  A unit found in a level
   is removed whole.
2. Units that are new but share their anchor with a different unit can share part of their
   bytes.  Only their windows are sent, and looked up the same way, window by window.

Results are exact up to equal fingerprints of different strings.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import BlockTexts, answers, binary_column, blocked, covered, per_block, per_part, runs
from ledgerline.llm.blocks import rows_table, spread, with_answers
from ledgerline.llm.spans import U64, mix, pieces, ragged, running, span_hashes, window_hashes

GRAM = 24
ALONE, EARLIER, PARTIAL = 0, 1, 2

UNITS = "block int, part int, keys binary, anchors binary"
UNITS_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("anchors", pa.binary())])
WINDOWS = "block int, part int, keys binary"
WINDOWS_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("keys", pa.binary())])
OUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long, end:long>>, kept binary"


class LevelFamily:
    """Sorted arrays of distinct keys, each at least twice as large as the next."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def scan(self, keys: np.ndarray) -> np.ndarray:
        """Which of the ascending ``keys`` are in some level."""
        found = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.searchsorted(level, keys)
            at[at == len(level)] = 0
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        """A new level of ascending keys that no level has; like sizes merge."""
        while self.levels and len(self.levels[-1]) < 2 * len(keys):
            keys = np.concatenate([self.levels.pop(), keys])
            keys.sort(kind="stable")  # two ascending runs: a merge
        if len(keys):
            self.levels.append(keys)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, by doubling."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _units(texts: BlockTexts, width: int, gram: int):
    """Byte starts, numbers of windows, anchors and fingerprints of a block's units, and their documents."""
    found: list[tuple[np.ndarray, ...]] = []
    for a, b in pieces(texts.offsets):
        low = texts.offsets[a]
        data, bounds = texts.data[low : texts.offsets[b]], texts.offsets[a : b + 1] - low
        windows = np.maximum(0, np.diff(bounds) - width + 1)
        at = ragged(bounds[:-1], windows)
        if not len(at):
            continue
        sums = running(data)
        least = _least(window_hashes(sums, gram), width - gram + 1)[at]
        cut = np.ones(len(at), bool)
        cut[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
        # documents without a gap between their windows are cut by their first window
        starts_of_docs = np.cumsum(windows) - windows
        cut[starts_of_docs[windows > 0]] = True
        first = np.flatnonzero(cut)
        n = np.diff(np.append(first, len(at)))
        docs = np.repeat(np.arange(a, b), windows)[first]
        begin = at[first]
        # least hashes are small; mixing spreads them evenly over the key ranges
        found.append((begin + low, n, mix(least[first]), span_hashes(sums, begin, begin + n + width - 1), docs))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, U64), np.zeros(0, U64), empty
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _distinct(keys: np.ndarray, anchors: np.ndarray):
    """Distinct units in order of anchors: their first places, and each unit's place among them."""
    _, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
    order = np.argsort(anchors[index], kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return index[order], back[inverse]


def _scan_units(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    family, batches = LevelFamily(), []
    for block, keys, anchors in zip(*(table.column(c).to_pylist() for c in ("block", "keys", "anchors")), strict=True):
        keys, anchors = np.frombuffer(keys, U64), np.frombuffer(anchors, np.uint32)
        order = np.argsort(keys)
        seen = np.empty(len(keys), bool)
        seen[order] = family.scan(keys[order])
        family.add(keys[order][~seen[order]])
        batches.append((block, seen, anchors))
    new = np.concatenate([anchors[~seen] for _, seen, anchors in batches])
    values, counts = np.unique(new, return_counts=True)
    several = values[counts > 1]
    for block, seen, anchors in batches:
        at = np.searchsorted(several, anchors)
        at[at == len(several)] = 0
        shared = several[at] == anchors if len(several) else np.zeros(len(anchors), bool)
        yield block, np.where(seen, EARLIER, np.where(shared, PARTIAL, ALONE))


def _scan_windows(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    family = LevelFamily()
    for block, keys in zip(table.column("block").to_pylist(), table.column("keys").to_pylist(), strict=True):
        keys = np.frombuffer(keys, U64)
        seen = family.scan(keys)
        family.add(keys[~seen])
        yield block, seen


def _partial_windows(texts: BlockTexts, flags: np.ndarray, width: int, gram: int):
    """Of a block: units to remove whole; starts, ranks and keys of the windows of partial units."""
    begin, n, anchors, keys, docs = _units(texts, width, gram)
    index, place = _distinct(keys, anchors)
    if len(flags) != len(index):  # rows without an id: nothing was sent
        flags = np.zeros(len(index), np.uint8)
    rank = texts.rank[docs]
    whole = (flags[place] == EARLIER) | (rank > rank[index][place])
    part = (flags[place] == PARTIAL) & ~whole
    at, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    hashes = [np.zeros(0, U64)]
    for a, b in pieces(texts.offsets):
        low, high = texts.offsets[a], texts.offsets[b]
        lo, hi = np.searchsorted(begin, [low, high])
        chosen = np.flatnonzero(part[lo:hi]) + lo
        if not len(chosen):
            continue
        windows = ragged(begin[chosen], n[chosen])
        at.append(windows)
        rows.append(np.repeat(rank[chosen], n[chosen]))
        hashes.append(span_hashes(running(texts.data[low:high]), windows - low, windows - low + width))
    return (begin, n, whole), np.concatenate(at), np.concatenate(rows), np.concatenate(hashes)


def kept_text(kept: pa.Array, changed: np.ndarray) -> pa.Array:
    """Kept bytes of changed rows as text, null for others; parts of characters that a cut has split are dropped."""
    # a lead byte without all of its trailing bytes, or trailing bytes without a lead
    return pa.array([kept[i].as_py().decode("utf-8", "ignore") if c else None for i, c in enumerate(changed)], pa.string())


def _remove(texts: BlockTexts, units: np.ndarray, windows: np.ndarray, width: int, gram: int, as_text: bool) -> pa.Table:
    (begin, n, whole), at, rank, keys = _partial_windows(texts, units, width, gram)
    _, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
    seen = (windows[inverse] > 0) | (rank > rank[index][inverse]) if len(keys) else np.zeros(0, bool)
    size = len(texts.data)
    gone = np.zeros(size, bool)
    if whole.any():
        gone |= covered(size, begin[whole], n[whole] + width - 1)
    if seen.any():
        gone |= covered(size, at[seen], width)
    if texts.ids.null_count:
        gone[:] = False
    a, b = runs(gone, texts.offsets[1:-1])
    lengths = np.diff(texts.offsets)
    doc = np.searchsorted(texts.offsets, a, "right") - 1
    spans = pa.StructArray.from_arrays(
        [pa.array(a - texts.offsets[doc]), pa.array(b - texts.offsets[doc])],
        fields=[pa.field("start", pa.int64()), pa.field("end", pa.int64())],
    )
    per_doc = np.bincount(doc, minlength=len(lengths)) if len(lengths) else np.zeros(0, np.int64)
    removed_before = np.zeros(size + 1, np.int32)
    np.cumsum(gone, out=removed_before[1:])
    removed = np.diff(removed_before[texts.offsets]).astype(np.int64)
    columns = {
        "doc_id": texts.ids,
        "n_bytes": pa.array(lengths),
        "n_removed": pa.array(removed),
        "spans": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32()), spans),
        "kept": binary_column(texts.data[~gone], lengths - removed),
    }
    if as_text:
        columns["kept_text"] = kept_text(columns["kept"], removed > 0)
    return pa.table(columns if texts.rest is None else columns | {"rest": texts.rest})


def remove_repeated_bytes(
    docs: DataFrame, width: int = 50, gram: int = GRAM, carry: Sequence[str] = (), as_text: bool = False
) -> DataFrame:
    """Cut every byte covered by a ``width``-byte string that also starts in a smaller doc_id.

    One row for each row of ``docs``: ``doc_id, n_bytes, n_removed``, the removed ``spans``
    (byte offsets) and the ``kept`` bytes.  Texts are UTF-8; null and shorter texts keep all;
    strings never cross documents and are judged on the input.  Rows with equal doc_id
    don't count as earlier than each other; a null doc_id takes no part and keeps all its
    bytes; columns of ``carry`` come back as the fields of ``rest``, others are ignored; an
    empty table gives no rows.  ``as_text`` adds ``kept_text``: of rows that lost bytes, the
    kept ones as text, made where they are cut, as a function of its own over the rows would
    hold a second Python worker for each core.
    """
    if not 0 < gram <= width:
        raise ValueError("the anchor string must fit into the window")
    made = blocked(docs, carry=carry)
    parts = made.parts

    def send_units(block: int, texts: BlockTexts) -> Iterator[dict]:
        _, _, anchors, keys, _ = _units(texts, width, gram)
        index, _ = _distinct(keys, anchors)
        low = (anchors[index] & U64(0xFFFFFFFF)).astype(np.uint32)
        for row in spread(block, anchors[index], parts, {"units": keys[index], "anchors": low}):
            yield {"block": row["block"], "part": row["part"], "keys": row["units"], "anchors": row["anchors"]}

    units = per_part(per_block(made, send_units, UNITS, UNITS_ARROW), _scan_units)

    def send_windows(block: int, texts: BlockTexts, back: pa.Table) -> pa.Table:
        rows = []
        if block >= 0:
            *_, keys = _partial_windows(texts, answers(back), width, gram)
            rows = list(spread(block, np.unique(keys), parts))
        return rows_table(rows, WINDOWS_ARROW)

    windows = per_part(with_answers(made, units, send_windows, WINDOWS), _scan_windows)
    both = units.withColumn("kind", F.lit(0)).unionByName(windows.withColumn("kind", F.lit(1)))

    def remove(block: int, texts: BlockTexts, back: pa.Table) -> pa.Table:
        kind = back.column("kind").to_numpy()
        first, second = (answers(back.filter(pa.array(kind == x))) for x in (0, 1))
        return _remove(texts, first, second, width, gram, as_text)

    kind = ", kept_text string" if as_text else ""
    kind += f", rest {made.docs.schema['rest'].dataType.simpleString()}" if carry else ""
    return with_answers(made, both, remove, OUT + kind)
