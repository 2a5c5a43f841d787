"""Periodic runs of words, found on a grammar of the texts.

A run is a stretch of consecutive words that repeats with a smallest period, at least
``LEAST_TIMES`` times and at least ``LEAST_WORDS`` words long, and that no neighbouring word
extends.  The word ids of a block of documents are compressed by Re-Pair: pairs of symbols
that occur often become symbols of their own, again and again.  Every round replaces, all over
the block, the pairs that are more frequent than the pairs they overlap; pairs that occur
once stay.  What is left of a document is halved again and again into a balanced tree of
symbols that occur once.

The runs that cross the boundary between a symbol's two halves are computed once for each
symbol, on its first place in the text.  The lowest symbol whose expansion holds a run of the
text has that run across its boundary, so all are found.  They are translated to every
place where the symbol is derived; stretches that a longer stretch of the same period covers
are no maximal ones and go, as do periods that are multiples of a smaller one.

Words are compared by ids that are exact.  Extents are found by hashes of ranges and then
checked word by word; where a check fails, the block is done again without hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.spans import BASE, INVERSE, U64, mix, pieces, powers, ragged, text_bytes

LEAST_WORDS = 24
LEAST_TIMES = 3
GRAM = 8  # words compared first; words that match one period on are at least twice as many
BLOCK_BYTES = 4 << 20  # of text that share a grammar; a longer document has its own
CHUNK = 1 << 20  # pairs of a boundary and a period looked at together

OUT = "doc_id long, n_words long, starts array<long>, lengths array<long>, periods array<long>, kept_text string"


@dataclass
class Grammar:
    """Symbols ``first, first + 1, ..`` and their halves; ``rounds`` are ranges of symbols."""

    first: int
    left: np.ndarray
    right: np.ndarray
    place: np.ndarray  # where in the text the symbol is met first
    length: np.ndarray  # of its expansion, for words (1) too
    rounds: list[tuple[int, int]]
    rest: np.ndarray  # the symbols that are left of the text
    at: np.ndarray  # and their places


def grammar(words: np.ndarray, n_words: int) -> Grammar:
    """Compress ``words``, whose ids are below ``n_words``, until no pair is left twice."""
    rest, at = words.astype(np.int64), np.arange(len(words), dtype=np.int64)
    length = [np.ones(n_words, np.int64)]
    left, right, place, rounds, size = [], [], [], [], n_words
    none = np.zeros(0, np.int64)
    while len(rest) > 1:
        codes, uniques = pd.factorize(rest[:-1] * size + rest[1:])
        # a symbol that follows itself makes equal pairs that overlap: every second one counts
        begin = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        size_of = np.diff(np.append(begin, len(codes)))
        even = np.ones(len(codes), bool)
        long = size_of > 1
        even[ragged(begin[long], size_of[long])] = ragged(np.zeros(int(long.sum()), np.int64), size_of[long]) % 2 == 0
        counts = np.bincount(codes[even], minlength=len(uniques))
        # most frequent first; ties in scattered order, so that long equal passages shrink everywhere at once
        tie = (np.arange(len(uniques), dtype=U64) * U64(0x9E3779B97F4A7C55)) & U64((1 << 36) - 1)
        weight = ((counts.astype(U64) << U64(36)) | tie)[codes[begin]]
        around = np.concatenate([np.zeros(1, U64), weight, np.zeros(1, U64)])
        best = (weight > around[:-2]) & (weight > around[2:]) & (counts[codes[begin]] > 1)
        chosen = np.flatnonzero(np.repeat(best, size_of) & even)
        often = np.bincount(codes[chosen], minlength=len(uniques)) > 1
        chosen = chosen[often[codes[chosen]]]
        if not len(chosen):
            break
        new = np.flatnonzero(often)
        symbol = np.zeros(len(uniques), np.int64)
        symbol[new] = size + np.arange(len(new))
        lengths = np.concatenate(length)
        met = np.zeros(len(uniques), np.int64)
        met[codes[chosen][::-1]] = at[chosen][::-1]
        a, b = uniques[new] // size, uniques[new] % size
        left.append(a)
        right.append(b)
        place.append(met[new])
        length = [lengths, lengths[a] + lengths[b]]
        rounds.append((size, size + len(new)))
        rest = rest.copy()
        rest[chosen] = symbol[codes[chosen]]
        keep = np.ones(len(rest), bool)
        keep[chosen + 1] = False
        rest, at, size = rest[keep], at[keep], size + len(new)
    join = lambda x: np.concatenate(x) if x else none
    return Grammar(n_words, join(left), join(right), join(place), np.concatenate(length), rounds, rest, at)


def halves(at: np.ndarray, first: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, boundary and end of the symbols of the balanced trees over what is left.

    Document ``d`` has the rest symbols ``first[d] .. first[d + 1] - 1`` and ends at ``ends[d]``.
    """
    found = [(np.zeros(0, np.int64),) * 3]
    n, width = np.diff(first), 1
    at = np.append(at, 0)
    while len(n) and width < n.max():
        many = (n + width - 1) // (2 * width)
        doc = np.repeat(np.arange(len(n)), many)
        i = ragged(np.zeros(len(n), np.int64), many) * 2 * width
        stop = np.where(i + 2 * width < n[doc], at[np.minimum(first[doc] + i + 2 * width, len(at) - 1)], ends[doc])
        found.append((at[first[doc] + i], at[first[doc] + i + width], stop))
        width *= 2
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Text:
    """Word ids with range hashes."""

    def __init__(self, words: np.ndarray, exact: bool = False) -> None:
        self.words, self.exact = words, exact
        n = len(words)
        values = mix(words.astype(U64) + U64(1))
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(values * powers(BASE, n), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)
        grams = np.zeros(n, U64)
        grams[: n - GRAM + 1] = self.hashes(np.arange(n - GRAM + 1), GRAM)
        self.grams = grams

    def hashes(self, starts: np.ndarray, length) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.back[starts]

    def ahead(self, i: np.ndarray, p: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on are those ``p`` further, up to ``most``."""
        if self.exact:
            w = self.words
            return np.array([_first_false(w[a : a + m] == w[a + q : a + q + m]) for a, q, m in zip(i, p, most, strict=True)], np.int64)
        low, high = np.zeros(len(i), np.int64), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.hashes(i, middle) == self.hashes(i + p, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def behind(self, i: np.ndarray, p: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``i`` are those ``p`` further, up to ``most``."""
        if self.exact:
            w = self.words
            return np.array([_first_false((w[a - m : a] == w[a + q - m : a + q])[::-1]) for a, q, m in zip(i, p, most, strict=True)], np.int64)
        low, high = np.zeros(len(i), np.int64), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.hashes(i - middle, middle) == self.hashes(i + p - middle, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low


def _first_false(x: np.ndarray) -> int:
    return len(x) if x.all() else int(np.argmin(x))


def crossing(text: Text, begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """``symbol, start, end, period`` of the runs across the boundary of each expansion.

    Stretches are cut at the ends of their expansion.  Of the periods of a stretch the
    smallest is given.
    """
    most = (end - begin) // LEAST_TIMES
    most[end - begin < LEAST_WORDS] = 0
    found = [(np.zeros(0, np.int64),) * 4]
    used = np.flatnonzero(most)
    for a, b in pieces(np.concatenate([[0], np.cumsum(most[used])]), CHUNK):
        which = used[a:b]
        symbol = np.repeat(which, most[which])
        p = ragged(np.ones(len(which), np.int64), most[which])
        x = middle[symbol]
        g, last = text.grams, len(text.words) - 1
        # a run has the word before the boundary's period, or the one after it, in the middle of
        # words that match one period on; eight of these lie on one side of it
        back = (g[x - p] == g[x]) | (g[x - p - GRAM + 1] == g[x - GRAM + 1])
        on = (g[x] == g[np.minimum(x + p, last)]) | (g[x - GRAM + 1] == g[np.minimum(x + p, last) - GRAM + 1])
        for hit, shift in ((back & (x - p >= begin[symbol]), 1), (on & (x + p < end[symbol]), 0)):
            s, q = symbol[hit], p[hit]
            i = middle[s] - shift * q
            right = text.ahead(i, q, end[s] - i - q)
            some = right > 0
            s, q, i, right = s[some], q[some], i[some], right[some]
            start, stop = i - text.behind(i, q, i - begin[s]), i + q + right
            good = (stop - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * q)) & (start < middle[s])
            found.append((s[good], start[good], stop[good], q[good]))
    s, start, stop, q = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((q, stop, start, s))
    s, start, stop, q = s[order], start[order], stop[order], q[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return s[new], start[new], stop[new], q[new]


def derived(g: Grammar, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and place of every derivation of the ``wanted`` symbols (numbered from 0)."""
    inside = wanted.copy()
    for a, b in g.rounds:
        own = slice(a - g.first, b - g.first)
        for half in (g.left[own], g.right[own]):
            deeper = half >= g.first
            inside[own][deeper] |= inside[half[deeper] - g.first]
    known = g.rest >= g.first
    symbol, place = g.rest[known] - g.first, g.at[known]
    symbol, place = symbol[inside[symbol]], place[inside[symbol]]
    found = [(np.zeros(0, np.int64),) * 2]
    for a, b in reversed(g.rounds):
        now = symbol >= a - g.first
        s, at = symbol[now], place[now]
        found.append((s[wanted[s]], at[wanted[s]]))
        symbols, places = [symbol[~now]], [place[~now]]
        for half, to in ((g.left[s], at), (g.right[s], at + g.length[g.left[s]])):
            deeper = half >= g.first
            child, to = half[deeper] - g.first, to[deeper]
            symbols.append(child[inside[child]])
            places.append(to[inside[child]])
        symbol, place = np.concatenate(symbols), np.concatenate(places)
    symbol, place = (np.concatenate(x) for x in zip(*found, strict=True))
    return symbol, place


def maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches that no other of their period covers, each with its smallest period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        group = np.cumsum(np.append(0, period[1:] != period[:-1]))
        reach = np.maximum.accumulate(group * (end.max() + 1) + end)
        keep = np.append(True, reach[1:] > reach[:-1])
        start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def find_runs(words: np.ndarray, first: np.ndarray, n_words: int) -> tuple[np.ndarray, ...]:
    """``start, end, period`` of all runs, by start and then period.

    Document ``d`` has the words ``first[d] .. first[d + 1] - 1``; ids are below ``n_words``.
    """
    n_docs, pad = len(first) - 1, 2 * GRAM
    # every document ends with a word of its own, so that nothing reaches across
    padded = np.zeros(len(words) + n_docs + 2 * pad, np.int64)
    n_padded = len(padded) - len(words)
    alone = np.ones(len(padded), bool)
    alone[np.arange(len(words)) + pad + np.repeat(np.arange(n_docs), np.diff(first))] = False
    padded[~alone] = words
    padded[alone] = n_words + np.arange(n_padded)
    begin = first[:-1] + pad + np.arange(n_docs)
    ends = first[1:] + pad + np.arange(n_docs)
    g = grammar(padded, n_words + n_padded)
    inner = np.searchsorted(g.at, np.append(begin, ends[-1:] + 1 if n_docs else pad))
    own = np.ones(len(g.at), bool)
    own[np.searchsorted(g.at, ends)] = False
    own[: inner[0]] = own[inner[-1] :] = False
    tree = halves(g.at[own], np.cumsum(np.append(0, np.diff(inner) - 1)), ends)
    half = g.place + g.length[g.left] if len(g.left) else g.place
    for exact in (False, True):
        text = Text(padded, exact)
        s, a, b, p = crossing(text, g.place, half, g.place + g.length[g.first :])
        wanted = np.zeros(len(g.left), bool)
        wanted[s] = True
        symbol, place = derived(g, wanted)
        many = np.searchsorted(s, symbol, "right") - np.searchsorted(s, symbol)
        each = ragged(np.searchsorted(s, symbol), many)
        shift = np.repeat(place - g.place[symbol], many)
        _, c, d, q = crossing(text, *tree)
        start, end, period = maximal(
            np.concatenate([a[each] + shift, c]), np.concatenate([b[each] + shift, d]), np.concatenate([p[each], q])
        )
        if exact or all((padded[x : y - z] == padded[x + z : y]).all() for x, y, z in zip(start, end, period, strict=True)):
            break
    doc = np.searchsorted(begin, start, "right") - 1
    order = np.lexsort((period, start))
    return (start - pad - doc)[order], (end - pad - doc)[order], period[order]


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, kept_text`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  ``runs`` lists ``start, length, period`` of every run,
    numbered in words from 0, by start and then period.  ``kept_text`` joins by one space the
    words that no run holds after its first period.  Null and empty texts have no words, no
    runs and an empty text; a null doc_id stays null; equal rows are worked on each on its
    own; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets, BLOCK_BYTES):
                raw = data[offsets[a] : offsets[b]].tobytes()
                cuts = (offsets[a : b + 1] - offsets[a]).tolist()
                texts = [raw[x:y].split() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield _block(batch.column(0).slice(a, b - a), texts)

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = wanted.mapInArrow(run, OUT)
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return found.select("doc_id", "n_words", runs.alias("runs"), "kept_text")


def _block(doc_ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
    known: dict[bytes, int] = {}
    words = np.array([known.setdefault(w, len(known)) for t in texts for w in t], np.int64)
    n = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(n)])
    start, end, period = find_runs(words, first, len(known))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change)[:-1] == 0
    whole = np.logical_and.reduceat(np.append(kept, True), first[:-1]) | (n == 0) if len(texts) else []
    made = [b" ".join(t if w else compress(t, kept[a : a + len(t)])) for t, w, a in zip(texts, whole, first, strict=False)]
    doc = np.searchsorted(first, start, "right") - 1
    edges = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(edges, pa.array(x)) for x in (start - first[doc], end - start, period)]
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(n), *lists, pa.array(made, pa.binary()).cast(pa.string())], names=[x.split()[0] for x in OUT.split(", ")]
    )
