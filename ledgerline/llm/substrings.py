"""Removal of repeated word spans by compaction of a de Bruijn graph.

Every window of ``k`` words is an edge between two nodes of ``k - 1`` words, known by its
64-bit hash; nodes have 64-bit hashes of their own.

1. Every block of documents sends its distinct edges, once each, to their key range.
2. A key range joins the blocks' edge lists: edges of an earlier block and edges of
   several blocks.
3. Every block sends the nodes that its repeated edges leave, with the number of those
   edges that no earlier block has.  Each repeated edge is counted once that way, so the
   sums of a key range tell the nodes that are left in more than one direction.
4. The answers are joined to the blocks.  Consecutive repeated edges of a document, cut
   at branching nodes, are compacted to paths, kept with their coordinates.
5. ``compacted_paths`` joins equal paths of all documents to one row with its source.

Decisions are exact up to equal 64-bit hashes of different windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import BlockTexts, answers, binary_column, block_words, blocked, covered, per_block, per_part
from ledgerline.llm.blocks import rows_table, runs, spread, with_answers
from ledgerline.llm.spans import NOT_SPACE, U64, joined_hashes, ragged, starts_within

EARLIER, REPEATED = 1, 2
BRANCHING = 1  # of nodes

SENT = "block int, part int, keys binary"
SENT_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("keys", pa.binary())])
NODES = f"{SENT}, counts binary"
NODES_ARROW = SENT_ARROW.append(pa.field("counts", pa.binary()))
PATH = pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("head", pa.int64()), ("tail", pa.int64())])
OUT = (
    "doc_id long, n_words long, n_removed long, kept_text string, "
    "paths array<struct<start:long, n_words:long, head:long, tail:long>>"
)


@dataclass
class Edges:
    """Word ranges of a block, and the places, windows and nodes of its edges."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    at: np.ndarray
    windows: np.ndarray
    words: np.ndarray

    def nodes(self, k: int) -> np.ndarray:
        return joined_hashes(self.words, k - 1)[self.at] if k > 1 else np.zeros(len(self.at), U64)


def _edges(texts: BlockTexts, k: int) -> Edges:
    starts, ends, first, words = block_words(texts, NOT_SPACE)
    at = starts_within(first, k)
    return Edges(starts, ends, first, at, joined_hashes(words, k)[at], words)


def _join_edges(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Flags of each block's edges, from one stable sort of all blocks' keys."""
    lists = [np.frombuffer(x, U64) for x in table.column("keys").to_pylist()]
    keys = np.concatenate(lists)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(new) - 1
    repeated = np.bincount(group) > 1
    flags = np.empty(len(keys), np.uint8)
    flags[order] = ~new * EARLIER + (repeated * REPEATED)[group]
    at = 0
    for block, each in zip(table.column("block").to_pylist(), lists, strict=True):
        yield block, flags[at : at + len(each)]
        at += len(each)


def _join_nodes(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Whether each block's nodes are left by more than one repeated edge of any block."""
    lists = [np.frombuffer(x, U64) for x in table.column("keys").to_pylist()]
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8)
    _, group = np.unique(np.concatenate(lists), return_inverse=True)
    flags = (np.bincount(group, weights=counts) > 1)[group] * np.uint8(BRANCHING)
    at = 0
    for block, each in zip(table.column("block").to_pylist(), lists, strict=True):
        yield block, flags[at : at + len(each)]
        at += len(each)


def _repeats(texts: BlockTexts, edges: Edges, flags: np.ndarray):
    """Which edges are repeated, which an earlier document has, and which are their window's
    first in the block while no earlier block has it."""
    unique, index, inverse = np.unique(edges.windows, return_index=True, return_inverse=True)
    doc_of_word = np.repeat(np.arange(len(edges.first) - 1), np.diff(edges.first))
    rank = texts.rank[doc_of_word[edges.at]] if len(edges.at) else np.zeros(0, np.int64)
    if len(flags) != len(unique):  # rows without an id: nothing was sent
        flags = np.zeros(len(unique), np.uint8)
    copied = rank > rank[index][inverse]  # an earlier document of the same block has it
    several = flags & REPEATED > 0
    several[inverse[copied]] = True
    repeated = several[inverse]
    earlier = (flags & EARLIER > 0)[inverse]
    leading = np.zeros(len(inverse), bool)
    leading[index] = True
    if texts.ids.null_count:
        repeated[:] = copied[:] = False
    return repeated, earlier | copied, leading & ~earlier, doc_of_word


def _send_nodes(block: int, texts: BlockTexts, back: pa.Table, k: int, parts: int) -> pa.Table:
    if block < 0:
        return rows_table([], NODES_ARROW)
    edges = _edges(texts, k)
    repeated, _, leading, _ = _repeats(texts, edges, answers(back))
    nodes, inverse = np.unique(edges.nodes(k)[repeated], return_inverse=True)
    own = np.bincount(inverse, weights=leading[repeated], minlength=len(nodes))
    counts = np.minimum(own, 2).astype(np.uint8)  # two are as good as more
    return rows_table(list(spread(block, nodes, parts, {"counts": counts})), NODES_ARROW)


def _remove(texts: BlockTexts, back: pa.Table, k: int) -> pa.Table:
    edges = _edges(texts, k)
    starts, ends, first, at = edges.starts, edges.ends, edges.first, edges.at
    of_nodes = back.column("of_nodes")
    repeated, earlier, _, doc_of_word = _repeats(texts, edges, answers(back.filter(pc.invert(of_nodes))))
    gone = covered(len(starts), at[earlier], k)
    branching = np.zeros(len(at), bool)
    _, inverse = np.unique(edges.nodes(k)[repeated], return_inverse=True)
    branching[repeated] = answers(back.filter(of_nodes))[inverse] & BRANCHING > 0

    # paths: runs of repeated edges at consecutive places of one document
    breaks = np.flatnonzero((np.diff(at, prepend=-2) != 1) | branching)
    a, b = runs(repeated, breaks)
    doc_first = first[:-1]
    path_doc = doc_of_word[at[a]] if len(a) else np.zeros(0, np.int64)
    per_doc = np.bincount(path_doc, minlength=len(first) - 1) if len(first) > 1 else np.zeros(0, np.int64)
    path = pa.StructArray.from_arrays(
        [
            pa.array(at[a] - doc_first[path_doc]),
            pa.array(b - a + k - 1),
            pa.array(edges.windows[a].view(np.int64)),
            pa.array(edges.windows[b - 1].view(np.int64)),
        ],
        fields=list(PATH),
    )
    paths = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32()), path)

    kept = ~gone
    sizes = (ends - starts)[kept]
    words_per_doc = np.diff(first)
    kept_before = np.concatenate([[0], np.cumsum(kept)])[first]
    kept_per_doc = np.diff(kept_before)
    spaced = sizes + 1
    last = kept_before[1:][kept_per_doc > 0] - 1
    spaced[last] -= 1
    to = np.cumsum(spaced) - spaced
    out = np.full(int(spaced.sum()), 0x20, np.uint8)
    out[ragged(to, sizes)] = texts.data[ragged(starts[kept], sizes)]
    total = np.concatenate([[0], np.cumsum(spaced)])
    return pa.table(
        {
            "doc_id": texts.ids,
            "n_words": pa.array(words_per_doc),
            "n_removed": pa.array(words_per_doc - kept_per_doc),
            "kept_text": binary_column(out, np.diff(total[kept_before]), text=True),
            "paths": paths,
        }
    )


def remove_repeated_words(docs: DataFrame, k: int = 13) -> DataFrame:
    """Cut every word covered by a window of ``k`` words that a smaller doc_id also has.

    One row for each row of ``docs``: ``doc_id, n_words, n_removed, kept_text`` and the
    repeated ``paths`` of the document (first word, words, hashes of the first and last
    edge).  Words are runs of bytes other than ASCII white space, kept unchanged and
    joined by one space.  Null and empty texts have no words and give an empty text; rows
    with equal doc_id don't count as earlier than each other; a null doc_id takes no part
    and keeps all its words; other columns are ignored; an empty table gives no rows.
    """
    made = blocked(docs)
    parts = made.parts

    def send(block: int, texts: BlockTexts) -> Iterator[dict]:
        yield from spread(block, np.unique(_edges(texts, k).windows), parts)

    flags = per_part(per_block(made, send, SENT, SENT_ARROW), _join_edges)
    nodes = with_answers(made, flags, lambda block, texts, back: _send_nodes(block, texts, back, k, parts), NODES)
    both = flags.withColumn("of_nodes", F.lit(False)).unionByName(
        per_part(nodes, _join_nodes).withColumn("of_nodes", F.lit(True))
    )
    return with_answers(made, both, lambda _, texts, back: _remove(texts, back, k), OUT)


def compacted_paths(removed: DataFrame) -> DataFrame:
    """One row for each distinct repeated path, with its first source and its documents.

    ``head, tail, n_words, source_doc, source_start, n_docs`` from the ``paths`` of
    ``remove_repeated_words``; partial sums go before the shuffle, so a path that many
    documents share is no hot key.
    """
    each = removed.select("doc_id", F.explode("paths").alias("p")).select("doc_id", "p.*")
    once = each.groupBy("head", "tail", "n_words", "doc_id").agg(F.min("start").alias("start"))
    paths = once.groupBy("head", "tail", "n_words").agg(
        F.min(F.struct("doc_id", "start")).alias("source"), F.count("*").alias("n_docs")
    )
    source = [F.col("source.doc_id").alias("source_doc"), F.col("source.start").alias("source_start")]
    return paths.select("head", "tail", "n_words", *source, "n_docs")
