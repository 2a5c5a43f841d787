"""Documents in blocks of ascending ids, and the exchange of key sets between blocks.

A block is a range of document ids with a few megabytes of text, worked on as one
Arrow table.  What blocks tell each other are sorted sets of 64-bit keys, one row for
each block and key range: a key that a third of all documents share is sent once per
block, never once per document.  The answers come back as one byte for each key, in
the same order, so no key travels twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.spans import U64, give_back, pieces, running, span_hashes, text_bytes, word_ranges
from ledgerline.operators.ordering import running_totals
from ledgerline.sources.staging import stage

BLOCK_BYTES = 4 << 20
ROW_BYTES = 16  # that a row counts for beside its text
PART_BYTES = 16 << 20  # of text for each key range


@dataclass(frozen=True)
class Blocked:
    """``docs`` has block, doc_id and text, dealt by block; ``parts`` is the number of key ranges."""

    docs: DataFrame
    parts: int


def blocked(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES, carry: Sequence[str] = ()
) -> Blocked:
    """Deal documents into ranges of ids with about equal numbers of bytes.

    A block begins where the running total of bytes in order of ids passes a multiple of
    ``block_bytes``, so a stretch of long documents is cut into as many blocks as it needs.
    Equal ids share a block.  Rows without an id take part in no comparison and are spread
    over blocks with negative numbers.  Columns of ``carry`` go along as the fields of ``rest``.
    """
    rest = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest")] if carry else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *rest)
    length = F.coalesce(F.octet_length("text"), F.lit(0))
    sizes = docs.groupBy("doc_id").agg(F.sum(length).alias("text_bytes"), F.sum(length + ROW_BYTES).alias("bytes"))
    sizes = stage(sizes, "sizes")
    nameless = F.when(F.col("doc_id").isNull(), F.col("bytes"))
    whole = sizes.agg(F.sum("text_bytes").alias("text"), F.sum("bytes").alias("all"), F.sum(nameless).alias("null")).first()
    parts = max(1, -(-(whole["text"] or 0) // part_bytes))
    null_blocks = max(1, -(-(whole["null"] or 0) // block_bytes))
    cuts: list[float] = []
    if (whole["all"] or 0) - (whole["null"] or 0) > block_bytes:
        placed = running_totals(sizes.where("doc_id IS NOT NULL"), "doc_id", ["bytes"])
        number = F.expr(f"(cum_bytes - bytes) div {block_bytes}")
        firsts = placed.groupBy(number.alias("number")).agg(F.min("doc_id").alias("first")).collect()
        cuts = sorted({float(row["first"]) for row in firsts})[1:]  # one number for each block
    # which of its blocks a row without an id gets has no bearing on any result
    spare = (-1 - F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(null_blocks))).cast("int")
    if cuts:
        # a monotone map of ids to ranges, by binary search
        splits = [float("-inf"), *cuts, float("inf")]
        dealt = Bucketizer(splits=splits, inputCol="at", outputCol="range", handleInvalid="keep").transform(
            docs.withColumn("at", F.col("doc_id").cast("double"))
        )
        block = F.when(F.col("doc_id").isNull(), spare).otherwise(F.col("range").cast("int"))
    else:
        dealt, block = docs, F.when(F.col("doc_id").isNull(), spare).otherwise(0)
    dealt = dealt.select(block.alias("block"), "doc_id", "text", *["rest"] * bool(carry))
    tasks = max(len(cuts) + null_blocks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return Blocked(dealt.repartition(tasks, "block"), parts)


@dataclass
class BlockTexts:
    """A block in ascending order of ids; ``rank`` grows with the id and is equal for equal ids."""

    ids: pa.Array
    data: np.ndarray
    offsets: np.ndarray
    rank: np.ndarray
    rest: pa.Array | None = None


def block_texts(table: pa.Table) -> BlockTexts:
    table = table.drop_columns(["block"]).sort_by("doc_id").combine_chunks()
    ids = table.column("doc_id").combine_chunks() if table.num_rows else pa.array([], pa.int64())
    data, offsets = text_bytes(table.column("text"))
    if ids.null_count:  # a block below 0: documents without an id have no order
        rank = np.zeros(len(ids), np.int64)
    else:
        plain = ids.to_numpy()
        rank = np.zeros(len(plain), np.int64)
        rank[1:] = np.cumsum(plain[1:] != plain[:-1])
    rest = table.column("rest").combine_chunks() if "rest" in table.column_names else None
    return BlockTexts(ids, data, offsets, rank, rest)


def block_words(texts: BlockTexts, inside: np.ndarray, fold: np.ndarray | None = None):
    """Starts, ends, first word of each document, and word hashes of a whole block."""
    starts, ends, first, hashes = [], [], [np.zeros(1, np.int64)], []
    seen = 0
    for a, b in pieces(texts.offsets):
        low = texts.offsets[a]
        data = texts.data[low : texts.offsets[b]]
        data = fold[data] if fold is not None else data
        s, e, f = word_ranges(data, texts.offsets[a : b + 1] - low, inside)
        hashes.append(span_hashes(running(data), s, e))
        starts.append(s + low)
        ends.append(e + low)
        first.append(f[1:] + seen)
        seen += len(s)
    empty = np.zeros(0, np.int64)
    return (
        np.concatenate([empty, *starts]),
        np.concatenate([empty, *ends]),
        np.concatenate(first),
        np.concatenate([np.zeros(0, U64), *hashes]),
    )


def part_bounds(parts: int) -> np.ndarray:
    """The least key of each key range."""
    return np.array([(-(-(p << 32) // parts)) << 32 for p in range(parts)], U64)


def spread(block: int, keys: np.ndarray, parts: int, extra: dict[str, np.ndarray] | None = None) -> Iterator[dict]:
    """One row for each key range of a block's ascending keys, with slices of ``extra``."""
    edges = [*np.searchsorted(keys, part_bounds(parts)).tolist(), len(keys)]
    for part, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if b > a:
            yield {"block": block, "part": part, "keys": keys[a:b].tobytes()} | {
                k: v[a:b].tobytes() for k, v in (extra or {}).items()
            }


def rows_table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def answers(table: pa.Table) -> np.ndarray:
    """The bytes that came back for a block's ascending keys."""
    if not table.num_rows:
        return np.zeros(0, np.uint8)
    table = table.sort_by("part")
    return np.frombuffer(b"".join(table.column("flags").to_pylist()), np.uint8)


FLAGS = "block int, part int, flags binary"
FLAGS_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("flags", pa.binary())])


def per_block(made: Blocked, work: Callable[[int, BlockTexts], Iterator[dict]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Rows that ``work`` makes of each block that has ids."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        rows = [] if block < 0 else list(work(block, block_texts(table)))
        return rows_table(rows, arrow)

    return made.docs.groupBy("block").applyInArrow(lambda table: _trimmed(run, table), schema)


def _trimmed(work: Callable[..., pa.Table], *tables: pa.Table) -> pa.Table:
    """What ``work`` makes of a group, whose scratch memory is given back before the next."""
    made = work(*tables)
    give_back()
    return made


def per_part(sent: DataFrame, work: Callable[[pa.Table], Iterator[tuple[int, np.ndarray]]]) -> DataFrame:
    """Answers of each key range; ``work`` gets its rows in ascending order of blocks."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = [
            {"block": block, "part": part, "flags": flags.astype(np.uint8).tobytes()}
            for block, flags in work(table.sort_by("block"))
        ]
        return rows_table(rows, FLAGS_ARROW)

    return sent.groupBy("part").applyInArrow(lambda table: _trimmed(run, table), FLAGS)


def with_answers(made: Blocked, flags: DataFrame, work: Callable[[int, BlockTexts, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each block together with its answers."""

    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        block = docs.column("block")[0].as_py() if docs.num_rows else -1
        return work(block, block_texts(docs), back)

    return made.docs.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(
        lambda docs, back: _trimmed(run, docs, back), schema
    )


def covered(n: int, starts: np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in a range that begins at one of ``starts``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, np.int32(1))
    np.subtract.at(step, starts + width, np.int32(1))
    np.cumsum(step, out=step)
    return step[:n] > 0


def runs(flags: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true places; ``breaks`` also begin a new run."""
    cut = np.zeros(len(flags) + 1, bool)
    if breaks is not None:
        cut[breaks] = True
    held = np.concatenate([[False], flags, [False]])
    begins = held[1:-1] & (~held[:-2] | cut[:-1])
    stops = held[1:-1] & (~held[2:] | cut[1:])
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def binary_column(data: np.ndarray, lengths: np.ndarray, text: bool = False) -> pa.Array:
    """An Arrow column of consecutive slices of ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    kind = pa.large_string() if text else pa.large_binary()
    made = pa.Array.from_buffers(
        kind, len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return made.cast(pa.string() if text else pa.binary())
