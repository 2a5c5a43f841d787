"""MinHash fingerprints of documents, and near copies by bands of them.

A document's set has every five consecutive words (A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``); with
fewer words, the whole sequence; without words it is empty.  Every shingle has 32 bits of hash.
``PERMUTATIONS`` universal functions ``(a * x + b mod 2 ** 64) >> 32`` stand for random orders of
the shingles, and the signature keeps each one's smallest value.  The share of places where
two signatures agree estimates the Jaccard similarity of the sets, within 0.045 (one standard
deviation at most).  A fingerprint is the low 16 bits of each value, in hexadecimal.

Near copies: equal sets count once.  Signatures are cut into bands; sets that agree in a band
share a bucket.  In each bucket all are compared with its smallest document, and only what
this leaves open among themselves, in blocks.  Jaccard is computed from the sets for every
pair that becomes a link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import binary_column
from ledgerline.llm.graph import components
from ledgerline.llm.spans import LOWER, NOT_SPACE, U64, joined_hashes, mix, pieces, ragged, running, span_hashes, text_bytes, word_ranges
from ledgerline.sources.staging import stage

WIDTH = 5  # words of a shingle
PERMUTATIONS = 128
BANDS, BAND = 25, 5  # similarity 0.8 shares no band once in 20,000 times
LEAST = 0.8
MARGIN = 0.2  # below the threshold, that an estimate may be for its pair to be computed
EMPTY = np.uint32(0xFFFFFFFF)
CHUNK = 1 << 15  # shingles worked on at a time, which fit into a core's cache
BLOCK_ROWS = 256
SALTS = 32

_random = np.random.default_rng(20)
FACTORS = _random.integers(0, 1 << 64, PERMUTATIONS, dtype=U64) | U64(1)
TERMS = _random.integers(0, 1 << 64, PERMUTATIONS, dtype=U64)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of every document, one after the other, and where each begins."""
    lowered = LOWER[data]
    starts, ends, first = word_ranges(lowered, offsets, NOT_SPACE)
    words = span_hashes(running(lowered), starts, ends)
    n = np.diff(first)
    whole = np.minimum(n, width)
    # short documents: their words and then as many fillers as are missing
    short = np.flatnonzero((n > 0) & (n < width))
    filled = np.zeros((len(short), width), U64)
    at = ragged(first[short], n[short])
    rows = np.repeat(np.arange(len(short)), n[short])
    filled[rows, at - first[short][rows]] = words[at]
    many = np.where(n > 0, n - whole + 1, 0)
    begin = np.concatenate([[0], np.cumsum(many)])
    out = np.zeros(int(begin[-1]), U64)
    long = np.flatnonzero(n >= width)
    out[ragged(begin[long], many[long])] = joined_hashes(words, width)[ragged(first[long], many[long])]
    if len(short):
        out[begin[short]] = joined_hashes(filled.ravel(), width)[::width]
    return out, begin


def minhash(column: pa.Array) -> np.ndarray:
    """Signatures of a text column, one row each; ``EMPTY`` all over for an empty set."""
    data, offsets = text_bytes(column)
    out = np.full((len(offsets) - 1, PERMUTATIONS), EMPTY, np.uint32)
    for a, b in pieces(offsets):
        low = offsets[a]
        found, begin = shingles(data[low : offsets[b]], offsets[a : b + 1] - low)
        found >>= U64(32)
        for c, d in pieces(begin, CHUNK):
            x, starts = found[begin[c] : begin[d]], begin[c:d] - begin[c]
            used = np.flatnonzero(np.diff(begin[c : d + 1]))
            if not len(used):
                continue
            mine, starts = np.empty((PERMUTATIONS, len(used)), np.uint32), starts[used]
            values = np.empty(len(x), U64)
            for i in range(PERMUTATIONS):
                np.multiply(x, FACTORS[i], out=values)
                values += TERMS[i]
                mine[i] = np.minimum.reduceat(values, starts) >> U64(32)
            out[a + c + used] = mine.T
    return out


def printed(signatures: np.ndarray) -> pa.Array:
    """Fingerprints as bytes, two for each place."""
    small = np.ascontiguousarray(signatures.astype("<u2"))
    return binary_column(small.view(np.uint8).ravel(), np.full(len(small), 2 * PERMUTATIONS))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of places in which two fingerprints agree, row by row."""
    return (a.astype(np.uint16) == b.astype(np.uint16)).mean(1)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (hexadecimal) of every row of ``docs``.

    Null texts are empty ones, whose fingerprint is all ``f``; a null doc_id stays null; equal
    texts have equal fingerprints; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), printed(minhash(batch.column(1)))], names=["doc_id", "print"])

    found = _texts(docs).mapInArrow(run, "doc_id long, print binary")
    return found.select("doc_id", _hex("print").alias("fingerprint"))


def _hex(name: str) -> Column:
    return F.lower(F.hex(name))


def edited(own: str, following: str) -> str:
    """``own`` with its last half replaced by as many characters from the front of ``following``, or all."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


RESULT = ["doc_id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next"]
ENDS = "doc_id long, n_chars long, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double, part int, text string"


def _compared(doc_ids: list, own: list[str], following: list[str], prints: np.ndarray, next_prints: np.ndarray) -> list:
    changed = [edited(a, b) for a, b in zip(own, following, strict=True)]
    other = minhash(pa.array(changed, pa.large_string()))
    return [
        pa.array(doc_ids, pa.int64()),
        pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        printed(prints),
        printed(other),
        pa.array(likeness(prints, other)),
        pa.array(likeness(prints, next_prints)),
    ]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` and of its text edited with the next row's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The next row is that with the next larger doc_id, after the last the first; null ids come
    first, and rows of one id stand in the order of a hash of their text.  A single row is its
    own next one.  Null texts are empty; two empty sets are alike; other columns are ignored;
    an empty table gives no rows.

    Rows are dealt out in ranges of that order, so that tasks meet neighbours one after the
    other.  A task cannot see the row after its last: its first and last rows are written with
    their texts, and the last ones finished with one row from each other task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: tuple | None = None

        def ends(doc, text: str, mark: np.ndarray, first: bool) -> pa.RecordBatch:
            row = [[doc], [len(text)], [None], printed(mark), [None], [0.0 if first else None], [None], [part], [text]]
            kinds = [pa.int64(), pa.int64(), pa.string(), None, pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.string()]
            arrays = [x if k is None else pa.array(x, k) for x, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in ENDS.split(", ")])

        for batch in batches:
            if not len(batch):
                continue
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            marks = minhash(batch.column(1))
            if held is None:
                yield ends(doc_ids[0], texts[0], marks[:1], True)
            else:
                doc_ids, texts, marks = [held[0], *doc_ids], [held[1], *texts], np.vstack([held[2], marks])
            held = doc_ids[-1], texts[-1], marks[-1:]
            if len(texts) > 1:
                n = len(texts) - 1
                made = _compared(doc_ids[:-1], texts[:-1], texts[1:], marks[:-1], marks[1:])
                rest = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([*made, *rest], names=[x.split()[0] for x in ENDS.split(", ")])
        if held is not None:
            yield ends(*held, False)

    # the row's number parts equal rows, so that a range can end between them
    order = ["doc_id", "hash", "row"]
    keyed = _texts(docs).withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    made = stage(dealt.mapInArrow(run, ENDS), "prints")
    open_ends = made.where(F.col("part").isNotNull())
    first = open_ends.where(F.col("near_edited").isNotNull()).select("part", F.col("text").alias("next_text"), F.col("print").alias("next_print"))
    parts = sorted(r.part for r in first.select("part").collect())  # a number for each task
    following = made.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, following int")
    last = open_ends.where(F.col("near_edited").isNull()).select("doc_id", "part", "text", "print").join(following, "part")
    pairs = last.join(first.withColumnRenamed("part", "following"), "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, own, after, mark, after_mark = (c.to_pylist() for c in batch.columns)
            read = lambda marks: np.frombuffer(b"".join(marks), "<u2").reshape(-1, PERMUTATIONS)
            yield pa.RecordBatch.from_arrays(_compared(doc_ids, own, after, read(mark), read(after_mark)), names=RESULT)

    kinds = ", ".join(x for x in ENDS.split(", ") if x.split()[0] in RESULT)
    finished = pairs.select("doc_id", "text", "next_text", "print", "next_print").mapInArrow(finish, kinds)
    every = made.where(F.col("part").isNull()).select(*RESULT).unionByName(finished)
    return every.select(
        "doc_id", "n_chars", "edited_sha256", _hex("print").alias("fingerprint"), _hex("edited_print").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def _sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n, set_key, shingles`` (sorted distinct 64-bit hashes) of documents with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                found, begin = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sets = [np.unique(found[x:y]) for x, y in zip(begin[:-1], begin[1:], strict=True)]
                keys = np.array([mix(s).sum(dtype=U64) for s in sets], U64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "n", "set_key", "shingles"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, set_key long, shingles array<long>")


def bands(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    cut = signatures[:, : BANDS * BAND].astype(U64).reshape(-1, BANDS, BAND)
    keys = np.repeat(np.arange(BANDS, dtype=U64)[None], len(cut), axis=0)
    for i in range(BAND):
        keys = mix(keys * U64(0x9E3779B97F4A7C55) + cut[:, :, i])
    return keys.view(np.int64)


def near_copies(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id, class_id`` for every row: the smallest doc_id reachable over pairs whose Jaccard is at least ``least``.

    Documents without words, and rows without an id, are alone (class_id is their own id).  Rows of
    one id are one node.  A pair may be missed where no band agrees: once in 20,000 times at 0.8,
    more seldom above.  Other columns are ignored; an empty table gives no rows.
    """
    texts = _texts(docs)
    sets = stage(_sets(texts.where(F.col("doc_id").isNotNull())).where("n > 0"), "sets")
    members = sets.select("doc_id", "n", "set_key")
    copies = members.groupBy("n", "set_key").agg(F.min("doc_id").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = minhash(batch.column(1))
            keys = bands(marks)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(keys), pa.list_(pa.int64())), binary_column(marks.view(np.uint8).ravel(), np.full(len(marks), 4 * PERMUTATIONS))],
                names=["id", "bands", "signature"],
            )

    marked = stage(texts.mapInArrow(run, "id long, bands array<long>, signature binary"), "marked")
    single = stage(copies, "copies").select("id")
    marked = marked.join(single, "id", "left_semi").dropDuplicates(["id", "bands"])
    placed = marked.select("id", F.explode("bands").alias("band"))
    leaders = placed.groupBy("band").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    led = stage(_salted(placed, leaders.select("band", "leader"), "band").where("id <> leader"), "led")
    compared = stage(jaccard(led.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), sets), "compared")
    links = compared.where(F.col("similarity") >= least).select("a", "b")
    # Of one bucket, x links with the leader and y doesn't.  Distances 1 - Jaccard obey the triangle
    # inequality, so x and y can only link where x lies no nearer to the leader than y less 1 - least
    far = led.join(compared.select(F.col("a").alias("leader"), F.col("b").alias("id"), "similarity"), ["leader", "id"])
    apart = F.max(F.when(F.col("similarity") < least, F.col("similarity")))
    open_ = far.groupBy("band").agg(apart.alias("best")).where(F.col("best").isNotNull())
    left = _salted(far, open_, "band").where(F.col("similarity") <= F.col("best") + (1 - least) + 1e-9).select("band", "id")
    more = _compare_rest(left, marked.select("id", "signature"), least)
    found = jaccard(more, sets).where(F.col("similarity") >= least).select("a", "b")
    links = stage(links.unionByName(found), "links")
    same = members.join(copies, ["n", "set_key"]).select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    roots = components(links.unionByName(same))
    classes = texts.select("doc_id").join(roots, F.col("doc_id") == F.col("node"), "left")
    return classes.select("doc_id", F.coalesce("root", "doc_id").alias("class_id"))


def _salted(rows: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """Join ``few`` rows, one for each key, so that a frequent key is spread over many tasks."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    each = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(each, [key, "salt"]).drop("salt")


def jaccard(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, similarity`` of pairs (a, b) of doc_ids, from the whole sets."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")).dropDuplicates(["a"])
    other = sets.select(F.col("doc_id").alias("id"), F.col("shingles").alias("y")).dropDuplicates(["id"])
    needed = one.join(pairs.select("a").distinct(), "a", "left_semi")
    both = _salted(pairs.withColumnRenamed("b", "id").join(other, "id"), needed, "a")
    shared = F.size(F.array_intersect("x", "y"))
    return both.select("a", F.col("id").alias("b"), (shared / (F.size("x") + F.size("y") - shared)).alias("similarity"))


def _compare_rest(left: DataFrame, signatures: DataFrame, least: float) -> DataFrame:
    """Distinct pairs of one bucket whose signatures agree well, blocks against blocks."""
    sizes = left.groupBy("band").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = stage(left.join(signatures, "id"), "open")
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = rows.join(sizes, "band").withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).select(
        "band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "id", "signature"
    )

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, PERMUTATIONS)
        block = table.column("mine").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in one:
            near = two[(marks[two] == marks[k]).mean(1) >= least - MARGIN]
            near = near[ids[near] != ids[k]]
            a.append(np.minimum(ids[near], ids[k]))
            b.append(np.maximum(ids[near], ids[k]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return rows.groupBy("band", "i", "j").applyInArrow(compare, "a long, b long").distinct()
