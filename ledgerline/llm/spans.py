"""Words and hashes of whole Arrow text columns in numpy, without a loop over rows.

A text column arrives as one byte buffer with offsets.  Words, shingles and byte
windows are index ranges of that buffer; their 64-bit hashes come from running sums
of ``(byte + 1) * BASE ** position`` modulo 2 ** 64, divided by ``BASE ** start``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2 ** 64
INVERSE = pow(BASE, -1, 2**64)
PIECE = 1 << 20  # bytes worked on at a time; a longer document is a piece of its own

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~ASCII_SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_libc = ctypes.CDLL(None)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64, kept for the life of the worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE + 1)
        have = np.full(size, base, U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 8 * PIECE:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def running(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` takes differences."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each byte range; ranges of different lengths differ too."""
    raw = (sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts]
    return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """The hash of every range of ``width`` bytes, by its start."""
    n = max(0, len(sums) - width)
    raw = (sums[width:] - sums[:n]) * powers(INVERSE, len(sums))[:n]
    return mix(raw + U64(width * 0xD6E8FEB86659FD93 % 2**64))


def give_back() -> None:
    """Return freed memory to the system, which workers that live on would keep for themselves."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc, "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on a task's batches, whose scratch memory an idle worker does not keep."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets; null reads as empty."""
    give_back()  # of the batch or block before
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of documents with about ``size`` bytes together."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def word_ranges(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, and each document's first word.

    ``inside`` tells for each of the 256 byte values whether it belongs to words;
    words end where their document does.
    """
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = inside[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins = word[1:-1] & ~word[:-2]
    stops = word[1:-1] & ~word[2:]
    begins[edge] = word[edge + 1]
    stops[edge - 1] = word[edge]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def joined_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of every ``width`` consecutive word hashes, by the first one's place."""
    n = max(0, len(words) - width + 1)
    total = np.zeros(n, U64)
    for i in range(width):
        total *= U64(BASE)
        total += words[i : i + n]
    return mix(total)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each range, one after the other."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    total = np.cumsum(lengths)
    out = np.arange(int(total[-1]), dtype=np.int64)
    return out + np.repeat(starts - (total - lengths), lengths)


def starts_within(first: np.ndarray, width: int) -> np.ndarray:
    """Places of the windows of ``width`` items that lie in one document."""
    return ragged(first[:-1], np.maximum(0, np.diff(first) - width + 1))
