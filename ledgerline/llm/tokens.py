"""Token ids of whole texts from public vocabulary files, one tokenizer call for each new word.

Texts are cut where every pre-tokenizer cuts: before a space or around a line feed that
stands between characters that are not white space, and between a Latin letter and a
punctuation mark after it.  No vocabulary merges across such a place, so the ids of a text
are those of its pieces in turn.  Each task asks the tokenizer once for every distinct piece
and looks the rest up by a hash of 64 bits, without comparing bytes.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from ledgerline.llm.spans import PIECE, U64, pieces, ragged, running, span_hashes, text_bytes

KEPT_PIECES = 600_000  # known pieces of a task before it drops those met once, which bounds memory
LONGEST = 64  # bytes of a piece that is looked up; longer ones are rare and always encoded

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, U64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.again = np.zeros(0, bool)  # met in a later block than the one they came from

    def thin(self) -> None:
        """Keep the pieces that were met again; if these are most of them, start anew."""
        keep = np.flatnonzero(self.again)
        if 2 * len(keep) > KEPT_PIECES:
            return self.forget()
        self.keys, lengths = self.keys[keep], self.lengths[keep]
        self.ids = self.ids[ragged(self.starts[keep], lengths)]
        self.starts, self.lengths = np.cumsum(lengths) - lengths, lengths
        self.again = np.zeros(len(keep), bool)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, made), np.int64, len(made))
        return np.fromiter(chain.from_iterable(made), np.uint32, int(lengths.sum())), lengths

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Where each distinct piece is among the known ones, asking for the new ones."""
        if len(self.keys) > KEPT_PIECES:
            self.thin()
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        self.again[at[known]] = True
        if not known.all():
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            ids, lengths = self._encode([raw[a:b].decode() for a, b in zip(starts[new], ends[new], strict=True)])
            # both are in ascending order of keys
            into = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, into, keys[new])
            self.starts = np.insert(self.starts, into, len(self.ids) + np.cumsum(lengths) - lengths)
            self.lengths = np.insert(self.lengths, into, lengths)
            self.again = np.insert(self.again, into, False)
            self.ids = np.concatenate([self.ids, ids])
            at = np.searchsorted(self.keys, keys)
        return at

    def ids_of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column as one array, and each text's number of ids."""
        data, offsets = text_bytes(column)
        all_ids, all_counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a, b in pieces(offsets, PIECE):
            low = offsets[a]
            ids, counts = self._ids(data[low : offsets[b]], offsets[a : b + 1] - low)
            all_ids.append(ids)
            all_counts.append(counts)
        return np.concatenate(all_ids), np.concatenate(all_counts)

    def _ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = cut_places(data, offsets)
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, offsets)
        keys = span_hashes(running(data), starts, ends)
        long = np.flatnonzero(ends - starts > LONGEST)
        keys[long] = np.arange(len(long), dtype=U64)  # a place of their own, below
        unique, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
        is_long = (ends - starts)[index] > LONGEST
        begin, lengths = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        short = np.flatnonzero(~is_long)
        at = self._places(data, starts[index[short]], ends[index[short]], unique[short])
        begin[short], lengths[short] = self.starts[at], self.lengths[at]
        pool = self.ids
        if is_long.any():
            raw, where = data.tobytes(), index[is_long]
            ids, counts = self._encode([raw[a:b].decode() for a, b in zip(starts[where], ends[where], strict=True)])
            begin[is_long], lengths[is_long] = len(pool) + np.cumsum(counts) - counts, counts
            pool = np.concatenate([pool, ids])
        each = lengths[inverse]
        total = np.concatenate([[0], np.cumsum(each)])[first]
        return pool[ragged(begin[inverse], each)], np.diff(total)


# a mark that may follow a letter; the bar stays, as it is part of special tokens
MARK = np.zeros(256, bool)
for _a, _b in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    MARK[_a:_b] = True
MARK[0x7C] = False
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
# second bytes of the letters from A with grave accent to y with diaeresis, after C3
ACCENTED = np.zeros(256, bool)
ACCENTED[0x80:0xC0] = True
ACCENTED[[0x97, 0xB7]] = False


def cut_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pieces: document starts and the safe places between them."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    white = data <= 0x20
    # other characters that may be white space start with C2, E1, E2 or E3
    lead = (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))
    opens = ~white & ~lead  # a sure non-white character starts or continues here
    closes = np.ones(n, bool)  # a sure non-white character ends here
    closes[white] = False
    inner = (data >= 0x80) & (data < 0xC0)
    closes[1:] &= ~(inner[1:] & (data[:-1] == 0xC2))
    closes[2:] &= ~(inner[2:] & lead[:-2] & (data[:-2] != 0xC2))
    gap = np.zeros(n, bool)  # a lone space or line feed between sure characters
    gap[1:-1] = ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) & closes[:-2] & opens[2:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    gap[edge] = False
    gap[edge - 1] = False
    cut = gap.copy()
    feeds = np.flatnonzero(gap & (data == 0x0A))
    cut[feeds + 1] = True
    letter = LETTER[data]
    letter[1:] |= ACCENTED[data[1:]] & (data[:-1] == 0xC3)
    cut[1:] |= MARK[data[1:]] & letter[:-1]
    cut[edge] = True
    cut[0] = True
    return np.flatnonzero(cut)
