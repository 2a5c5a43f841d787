"""Token files: frequency-ranked ids in a byte-aligned variable-length coding.

An id is stored as its rank by frequency, most frequent first, in 1 to 4 bytes.  A
separate stream of control bytes holds two bits of length for each id, four ids to a
byte.  Decoding looks each control byte up in tables of 256 entries and gathers the data
bytes in numpy, without a loop over ids.

A file set is one folder in the shared store, written by Spark's own committer:
``ranks`` (token_id, rank) and ``blocks``, whose rows hold a run of documents in
ascending order: ``shard, block, doc_ids, counts`` (little-endian 64 bits), ``n_ids,
control, data``.  Shards are ranges of doc_id and are numbered in ascending order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.blocks import binary_column
from ledgerline.llm.spans import giving_back
from ledgerline.llm.tokens import encoder
from ledgerline.sources.staging import new_path, stage

BLOCK_IDS = 1 << 18  # ids of a block, unless one document has more
SHARD_IDS = 1 << 23  # ids of a shard, about
PREFIX = 16  # bytes of its ids that part the rows of one doc_id among shards

# lengths of the four ids of each control byte
LENGTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2)) % 4 + 1
BLOCKS = "shard int, block int, doc_ids binary, counts binary, n_ids long, control binary, data binary"


def encode_ids(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of an array of ranks below 2 ** 32."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks back, by table lookup of control bytes."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(sizes) - sizes
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)])
    out = raw[at].astype(np.uint32)
    for i in range(1, 4):
        wide = np.flatnonzero(sizes > i)
        out[wide] |= raw[at[wide] + i].astype(np.uint32) << np.uint32(8 * i)
    return out


def tokenized(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian 16 bits where the vocabulary allows, else 32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        kind = id_type(max(encode.tokenizer.get_vocab_size(), end_id + 1))
        for batch in batches:
            ids, counts = encode.ids_of(batch.column(1))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype(kind)
            column = binary_column(ids.view(np.uint8), (counts + 1) * ids.itemsize)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts + 1), column], names=["doc_id", "n_tokens", "ids"]
            )

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(giving_back(run), "doc_id long, n_tokens long, ids binary")


def id_type(vocabulary_size: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary_size <= 1 << 16 else "<u4")


def _width(vocabulary: str, end_id: int) -> np.dtype:
    from tokenizers import Tokenizer

    return id_type(max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1))


def frequency_ranks(ids: DataFrame, kind: np.dtype) -> DataFrame:
    """``token_id, rank``: rank 0 is the most frequent id; ties go to the smaller id.

    Tasks count their own ids, so a count row is sent for each id and task at most.  The
    table has a row for each id of the vocabulary that occurs, whatever the input's size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            raw = b"".join(batch.column(0).to_pylist())
            some = np.bincount(np.frombuffer(raw, kind), minlength=len(total))
            some[: len(total)] += total
            total = some
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token_id", "n"])

    counted = ids.select("ids").mapInArrow(count, "token_id long, n long").groupBy("token_id").agg(F.sum("n").alias("n"))
    # one task orders the vocabulary: at most one row for each id it has
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token_id")) - 1
    return counted.select("token_id", rank.cast("long").alias("rank"))


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int, path: str, shards: int | None = None) -> None:
    """Write the token files of all documents under ``path``, in ascending order of doc_id.

    Null and empty texts are ``end_id`` alone; a null doc_id comes first; rows with equal
    doc_id stand side by side, ordered by their ids, and may spread over shards; other
    columns are ignored; an empty table gives a file set without blocks.  The number of
    shards follows from the number of ids unless it is given.
    """
    spark = docs.sparkSession
    kind = _width(vocabulary, end_id)
    ids = stage(tokenized(docs, vocabulary, end_id), "ids")
    shards = shards or 1 + (ids.agg(F.sum("n_tokens")).first()[0] or 0) // SHARD_IDS
    stage_path = f"{path}/ranks"
    frequency_ranks(ids, kind).write.parquet(stage_path)
    # bounded by the vocabulary: one small integer for each id
    table = spark.read.parquet(stage_path).collect()
    size = max((r.token_id for r in table), default=0) + 1
    rank_of = np.zeros(size, np.uint32)
    rank_of[[r.token_id for r in table]] = [r["rank"] for r in table]
    ranks = spark.sparkContext.broadcast(rank_of)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        n_held = 0

        def made() -> pa.RecordBatch:
            doc_ids = np.array([-1 if d is None else d for d, _ in held], "<i8")
            present = np.array([d is not None for d, _ in held], np.uint8)
            every = np.frombuffer(b"".join(x for _, x in held), kind)
            counts = np.array([len(x) // kind.itemsize for _, x in held], "<i8")
            control, data = encode_ids(ranks.value[every])
            row = {
                "shard": shard, "block": block, "doc_ids": doc_ids.tobytes() + present.tobytes(),
                "counts": counts.tobytes(), "n_ids": len(every), "control": control, "data": data,
            }
            return pa.RecordBatch.from_pylist([row], schema=BLOCKS_ARROW)

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((doc, raw))
                n_held += len(raw) // kind.itemsize
                if n_held >= BLOCK_IDS:
                    yield made()
                    held, n_held, block = [], 0, block + 1
        if held:
            yield made()

    front = F.substring("ids", 1, PREFIX)  # grows with the ids, so ranges keep their order
    ordered = ids.select("doc_id", "ids").repartitionByRange(shards, "doc_id", front).sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks")


BLOCKS_ARROW = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.binary()), ("counts", pa.binary()),
     ("n_ids", pa.int64()), ("control", pa.binary()), ("data", pa.binary())]
)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``shard, block, before, doc_id, n_tokens, ids`` of every document of a file set.

    ``ids`` are the token ids, little-endian and 32 bits each; ``before`` counts those of the
    documents before it in its block.
    """
    table = spark.read.parquet(f"{path}/ranks").collect()  # bounded by the vocabulary
    by_rank = np.zeros(len(table), np.uint32)
    by_rank[[r["rank"] for r in table]] = [r.token_id for r in table]
    back = spark.sparkContext.broadcast(by_rank)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<i8")
                n = len(counts)
                doc_ids = np.frombuffer(row["doc_ids"][: 8 * n], "<i8")
                present = np.frombuffer(row["doc_ids"][8 * n :], np.uint8) > 0
                ids = back.value[decode_ids(row["control"], row["data"], row["n_ids"])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["shard"], np.int32)),
                        pa.array(np.full(n, row["block"], np.int32)),
                        pa.array(np.cumsum(counts) - counts),
                        pa.array(doc_ids, mask=~present),
                        pa.array(counts),
                        binary_column(ids.astype("<u4").view(np.uint8), counts * 4),
                    ],
                    names=["shard", "block", "before", "doc_id", "n_tokens", "ids"],
                )

    return spark.read.parquet(f"{path}/blocks").mapInArrow(
        decode, "shard int, block int, before long, doc_id long, n_tokens long, ids binary"
    )


def positions(read: DataFrame, path: str) -> DataFrame:
    """Rows of ``read_tokens`` with ``start``: the ids of all documents before each one.

    The blocks' sizes are columns of the files, so that nothing is decoded for them.  Totals
    are carried over at two levels: no task orders more than one shard's blocks, or the list
    of shards.
    """
    blocks = read.sparkSession.read.parquet(f"{path}/blocks").select("shard", "block", "n_ids")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    running = lambda what, w: F.coalesce(F.sum(what).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shard_start = shards.select("shard", running("n", Window.orderBy("shard")).alias("of_shard"))
    block_start = blocks.select("shard", "block", running("n_ids", Window.partitionBy("shard").orderBy("block")).alias("of_block"))
    joined = read.join(block_start.join(shard_start, "shard"), ["shard", "block"])
    return joined.withColumn("start", F.col("of_shard") + F.col("of_block") + F.col("before"))


def new_file_set(spark: SparkSession) -> str:
    return new_path(spark, "tokens")
