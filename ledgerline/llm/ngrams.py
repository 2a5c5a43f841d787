"""Documents that share most of their word n-grams, as a blocked sparse matrix product.

Rows of the matrix are documents, columns are n-grams.  Overlap counts of two rows are
wanted only where they can reach the bound that the rows' sizes set, and most columns and
pairs fall away before any count:

1. Blocks of documents send their distinct n-grams, once each, to key ranges, which
   return how rare each one is.  A document whose repeated n-grams are fewer than its size
   asks for has no partner.  Equal rows are collapsed to one.
2. Columns are ordered from rare to frequent.  Two similar rows must meet in the first
   ``size - least overlap + 1`` columns of both, so only these are joined.
3. In each column one row, the centre, is multiplied with the others whose bound it can
   reach; overlap counts are summed over blocks of rows.  Linked rows merge, and later
   rounds take new centres for the rows of other components only.  At last all that is
   left is counted, so no link between different components is lost: the rows of frequent
   columns as products of two blocks each, the others pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import (
    BlockTexts,
    answers,
    binary_column,
    block_words,
    blocked,
    part_bounds,
    per_block,
    per_part,
    spread,
    with_answers,
)
from ledgerline.llm.graph import components
from ledgerline.llm.spans import LOWER, NOT_SPACE, U64, joined_hashes, mix
from ledgerline.sources.staging import stage

SENT = "block int, part int, keys binary, counts binary"
SENT_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
ROWS = "doc_id long, n long, k1 long, k2 long, columns array<long>, places array<int>, grams binary"
PRODUCT_ROWS = 256  # rows multiplied with a centre in one task
FEW_PAIRS = 4  # open pairs for each entry, from which all are counted
MOST_ROUNDS = 3
SLICE_KEYS = 1 << 20  # n-grams of a key range that are counted at a time
HOT_ROWS = 64  # of a column, from which its open pairs are counted block by block
OWN_BLOCKS = 32  # rows of a component that gets blocks of its own


def least_overlap(n, percent: int):
    """The fewest shared n-grams that a row of ``n`` needs with any partner."""
    return (percent * n + 99) // 100


def _sets(texts: BlockTexts, width: int) -> list[np.ndarray]:
    """The ascending distinct n-gram hashes of each document of a block."""
    _, _, first, words = block_words(texts, NOT_SPACE, LOWER)
    grams = joined_hashes(words, width)
    found = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            found.append(np.unique(grams[a : b - width + 1]))
        elif b > a:  # fewer words: the whole sequence, told apart by its length
            found.append(mix(joined_hashes(words[a:b], b - a) + U64(b - a)))
        else:
            found.append(np.zeros(0, U64))
    return found


def _rarity(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """0 for n-grams of one document, else a class that grows with the logarithm of their number.

    The ascending keys of all blocks are counted a slice of their range at a time.
    """
    table = table.combine_chunks()
    read = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in table.column(name).chunk(0)]
    lists, counts = read("keys", np.uint32), read("counts", np.uint16)
    classes = [np.zeros(len(x), np.uint8) for x in lists]
    longest = max(lists, key=len)
    # the block with the most keys cuts the range into slices of like size
    many = -(-sum(map(len, lists)) // SLICE_KEYS)
    cuts = np.unique(longest[np.arange(1, many) * len(longest) // many])
    edges = [[0, *np.searchsorted(x, cuts).tolist(), len(x)] for x in lists]
    for s in range(len(cuts) + 1):
        slices = [slice(e[s], e[s + 1]) for e in edges]
        _, inverse = np.unique(np.concatenate([x[r] for x, r in zip(lists, slices, strict=True)]), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([x[r] for x, r in zip(counts, slices, strict=True)]))
        found = np.where(total > 1, np.minimum(255, 1 + 4 * np.log2(np.maximum(total, 1))), 0).astype(np.uint8)[inverse]
        at = 0
        for out, r in zip(classes, slices, strict=True):
            out[r] = found[at : at + r.stop - r.start]
            at += r.stop - r.start
    yield from zip(table.column("block").to_pylist(), classes, strict=True)


def _matrix_rows(texts: BlockTexts, flags: np.ndarray, width: int, percent: int) -> pa.Table:
    sets = _sets(texts, width)
    every = np.concatenate([np.zeros(0, U64), *sets])
    keys, inverse = np.unique(every, return_inverse=True)
    known = len(flags) == len(keys) and not texts.ids.null_count
    rarity = flags[inverse] if known else np.zeros(len(every), np.uint8)
    seen: set[tuple[int, int]] = set()
    k1, k2, columns, places, sizes, grams = [], [], [], [], [], []
    at = 0
    for own in sets:
        n = len(own)
        rare = rarity[at : at + n]
        at += n
        name = (int(mix(own).sum(dtype=U64).view(np.int64)), int(mix(own ^ U64(n + 1)).sum(dtype=U64).view(np.int64)))
        k1.append(name[0])
        k2.append(name[1])
        least = least_overlap(n, percent)
        if n and np.count_nonzero(rare) >= least and name not in seen:
            seen.add(name)
            order = np.lexsort((own, rare))[: n - least + 1]
            place = np.flatnonzero(rare[order] > 0)
            columns.append(own[order[place]].view(np.int64))
            places.append(place.astype(np.int32))
            grams.append(own)
            sizes.append(n)
        else:
            columns.append(None)
            places.append(None)
            sizes.append(-1)
    held = np.array(sizes, np.int64)
    data = np.concatenate([np.zeros(0, U64), *grams]).view(np.uint8)
    packed = binary_column(data, np.maximum(held, 0) * 8)
    return pa.table(
        {
            "doc_id": texts.ids,
            "n": pa.array([len(x) for x in sets], pa.int64()),
            "k1": pa.array(k1, pa.int64()),
            "k2": pa.array(k2, pa.int64()),
            "columns": pa.array(columns, pa.list_(pa.int64())),
            "places": pa.array(places, pa.list_(pa.int32())),
            "grams": pa.array([x if s >= 0 else None for x, s in zip(packed.to_pylist(), held.tolist(), strict=True)], pa.binary()),
        }
    )


def _overlaps(centres: pa.Table, others: pa.Table, percent: int) -> pa.Table:
    """Product of one centre with a block of rows: links that reach the bound."""
    a, row = centres.column("id")[0].as_py(), np.frombuffer(centres.column("grams")[0].as_py(), U64)
    grams = [np.frombuffer(x, U64) for x in others.column("row").to_pylist()]
    sizes = np.array([len(x) for x in grams])
    every = np.concatenate(grams)
    at = np.searchsorted(row, every)
    at[at == len(row)] = 0
    overlap = np.add.reduceat((row[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    linked = 100 * overlap >= percent * (sizes + len(row) - overlap)
    b = others.column("b").to_numpy()[linked]
    return pa.table({"a": pa.array(np.full(len(b), a), pa.int64()), "b": pa.array(b, pa.int64())})


def _links(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Of distinct pairs ``a, b``, those that link."""
    pairs = stage(pairs, "pairs")
    split = pairs.groupBy("a").agg(F.ceil(F.count("*") / PRODUCT_ROWS).cast("int").alias("splits"))
    sets = rows.select("id", "grams")
    centres = sets.join(split, sets["id"] == split["a"]).select(
        "id", "grams", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split")
    )
    dealt = pairs.join(split, "a").select("a", "b", F.pmod(F.xxhash64("b"), "splits").cast("int").alias("split"))
    other = rows.select(F.col("id").alias("b"), F.col("grams").alias("row")).join(dealt, "b").select("a", "split", "b", "row")

    def product(one: pa.Table, many: pa.Table) -> pa.Table:
        if not one.num_rows or not many.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        return _overlaps(one, many, percent)

    blocks = centres.groupBy("id", "split").cogroup(other.groupBy("a", "split"))
    return stage(blocks.applyInArrow(product, "a long, b long"), "found")


def _block_products(one: pa.Table, many: pa.Table, percent: int) -> pa.Table:
    """Links between the rows of two blocks that are in different components."""
    sides = []
    for t in (one, many):
        ids, roots = (t.column(c).to_numpy() for c in ("id", "root"))
        grams = [np.frombuffer(x, U64) for x in t.column("grams").to_pylist()]
        sides.append((ids, roots, grams, np.array([len(x) for x in grams], np.int64)))
    (ids, roots, grams, sizes), (m_ids, m_roots, m_grams, m_sizes) = sides
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(m_ids):
        every, begin = np.concatenate(m_grams), np.cumsum(m_sizes) - m_sizes
        for i, root, row, n in zip(ids.tolist(), roots.tolist(), grams, sizes.tolist(), strict=True):
            can = (m_roots != root) & (100 * np.minimum(n, m_sizes) >= percent * np.maximum(n, m_sizes))
            if not can.any():
                continue
            at = np.searchsorted(row, every)
            at[at == n] = 0
            overlap = np.add.reduceat((row[at] == every).astype(np.int64), begin)
            found = m_ids[can & (100 * overlap >= percent * (n + m_sizes - overlap))]
            a.append(np.full(len(found), i, np.int64))
            b.append(found)
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def _block_links(at: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links between components among the rows of frequent columns, by products of blocks.

    Large components are split into blocks of rows; rows of small ones are put together
    by the largest component that they share a column with.  Two blocks are multiplied
    if they meet in a column, unless both are of one component.
    """
    docs = at.select("id", "root").distinct()
    size = docs.groupBy("root").agg(F.count("*").alias("size"))
    sized = stage(at.select("column", "id", "root").join(size, "root"), "sized")
    top = sized.groupBy("column").agg(F.max(F.struct("size", "root")).alias("top"))
    each = sized.join(top, "column").groupBy("id", "root", "size").agg(F.max("top").alias("top"))
    own = F.col("size") >= OWN_BLOCKS
    each = each.select("id", "root", own.alias("own"), F.when(own, F.col("root")).otherwise(F.col("top.root")).alias("family"))
    many = each.groupBy("own", "family").agg(F.ceil(F.count("*") / PRODUCT_ROWS).cast("int").alias("blocks"))
    bucket = F.pmod(F.xxhash64("id"), "blocks")
    each = each.join(many, ["own", "family"]).withColumn("block", F.xxhash64("own", "family", bucket))
    each = stage(each.select("id", "root", "own", "family", "block"), "each")
    met = sized.select("column", "id").join(each, "id").select("column", "own", "family", "block").distinct()
    x, y = (met.select("column", *[F.col(c).alias(f"{c}_{k}") for c in ("own", "family", "block")]) for k in "xy")
    apart = ~(F.col("own_x") & F.col("own_y") & (F.col("family_x") == F.col("family_y")))
    pairs = x.join(y, "column").where((F.col("block_x") <= F.col("block_y")) & apart)
    pairs = stage(pairs.select(F.col("block_x").alias("p"), F.col("block_y").alias("q")).distinct(), "block_pairs")
    sets = stage(each.select("id", "root", "block").join(rows.select("id", "grams"), "id"), "block_rows")
    one = pairs.join(sets, pairs["p"] == sets["block"]).select("p", "q", "id", "root", "grams")
    two = pairs.join(sets, pairs["q"] == sets["block"]).select("p", "q", "id", "root", "grams")
    two = two.toDF("p2", "q2", "id", "root", "grams")

    def product(a: pa.Table, b: pa.Table) -> pa.Table:
        return _block_products(a, b, percent)

    return stage(one.groupBy("p", "q").cogroup(two.groupBy("p2", "q2")).applyInArrow(product, "a long, b long"), "found")


def _bounded(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct ordered pairs whose sizes and places still allow the overlap they need.

    Rows that meet in a column at places i and j share at most min(i, j) columns before it
    and the shorter rest behind it.
    """
    most = F.least("i", "j") + 1 + F.least(F.col("n") - F.col("i") - 1, F.col("m") - F.col("j") - 1)
    # 100 o >= p (n + m - o) for the largest possible overlap o
    can = (100 + percent) * most >= percent * (F.col("n") + F.col("m"))
    return pairs.where(can & (F.col("x") != F.col("y"))).select("x", "y").distinct()


def _components(entries: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of all linked rows."""
    spark = entries.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    for turn in range(MOST_ROUNDS):
        at = entries.join(roots, entries["id"] == roots["node"], "left")
        at = stage(at.select("column", "id", "n", "place", "share", F.coalesce("root", "id").alias("root")), "at")
        # pairs of rows that share a column and not a component
        per_root = at.groupBy("column", "root").agg(F.count("*").alias("c"))
        per_column = per_root.groupBy("column").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("cc"))
        sums = per_column.agg(F.sum((F.col("c") * F.col("c") - F.col("cc")) / 2), F.sum("c")).first()
        open_pairs, n_entries = sums[0] or 0, sums[1] or 0
        if not open_pairs:
            break
        last = turn > 0 and (open_pairs <= FEW_PAIRS * n_entries or turn == MOST_ROUNDS - 1)
        if last:
            hot = per_column.where(F.col("c") > HOT_ROWS).select(F.col("column").alias("hot"))
            links = links.unionByName(_block_links(at.join(hot, at["column"] == hot["hot"], "left_semi"), rows, percent))
            at = at.join(hot, at["column"] == hot["hot"], "left_anti")
            left = at
        else:
            # first the rows with the most shared columns, which edited copies have fewer of
            order = -F.col("share") if not turn else F.xxhash64("id", F.lit(turn)).cast("double")
            pick = F.struct(order.alias("order"), "id", "n", "place", "root")
            left = at.groupBy("column").agg(F.min(pick).alias("p")).select("column", "p.id", "p.n", "p.place", "p.root")
        x = left.select("column", F.col("id").alias("x"), F.col("n"), F.col("place").alias("i"), F.col("root").alias("rx"))
        y = at.select("column", F.col("id").alias("y"), F.col("n").alias("m"), F.col("place").alias("j"), F.col("root").alias("ry"))
        met = x.join(y, "column").where(F.col("rx") != F.col("ry"))
        met = met.where(F.col("x") < F.col("y")) if last else met
        pairs = _bounded(met, percent).select(F.col("x").alias("a"), F.col("y").alias("b"))
        if not last:  # a pair may have either row as its centre
            pairs = pairs.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.min("a").alias("a"))
            pairs = pairs.select("a", F.when(F.col("a") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("b"))
        links = links.unionByName(_links(pairs, rows, percent))
        roots = components(links)
        if last:
            break
    return roots


def similar_documents(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are runs other than ASCII white space with A-Z lowered; a row's set holds its
    distinct runs of ``width`` words, or all of its words if there are fewer.  Rows link if
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest doc_id
    reachable.  Null, empty and wordless texts have no n-grams and link with nothing, nor
    do rows with a null doc_id, whose component is null; rows with equal doc_id
    are told apart by their sets; other columns are ignored; an empty table gives no rows.

    Sets are exact up to equal 64-bit hashes of different n-grams.
    """
    made = blocked(docs)
    parts = made.parts

    def send(block: int, texts: BlockTexts) -> Iterator[dict]:
        every = np.concatenate([np.zeros(0, U64), *_sets(texts, width)])
        keys, counts = np.unique(every, return_counts=True)
        # 32 bits of each key that keep the order inside its key range
        bounds = part_bounds(parts)
        base = bounds[np.searchsorted(bounds, keys, "right") - 1]
        low = ((keys - base) >> U64(33 - parts.bit_length())).astype(np.uint32)
        extra = {"low": low, "counts": np.minimum(counts, 0xFFFF).astype(np.uint16)}
        for row in spread(block, keys, parts, extra):
            yield {"block": row["block"], "part": row["part"], "keys": row["low"], "counts": row["counts"]}

    flags = per_part(per_block(made, send, SENT, SENT_ARROW), _rarity)
    work = lambda _, texts, back: _matrix_rows(texts, answers(back), width, percent)
    matrix = stage(with_answers(made, flags, work, ROWS), "matrix")

    known = matrix.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stage(known.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = known.where(F.col("grams").isNotNull()).join(classes, ["k1", "k2"]).where(F.col("doc_id") == F.col("rep"))
    # rows of one document id that differ are told apart by their set's name
    rows = stage(reps.select(F.col("k1").alias("id"), "n", "columns", "places", "grams"), "rows")
    entries = rows.select("id", "n", F.explode(F.arrays_zip("columns", "places")).alias("e"))
    entries = entries.select(F.col("e.columns").alias("column"), "id", F.col("n").cast("int").alias("n"), F.col("e.places").alias("place"))
    shared = entries.groupBy("column").agg(F.count("*").alias("c")).where("c > 1").select("column")
    entries = stage(entries.join(shared, "column"), "shared")
    share = entries.groupBy("id").agg((F.count("*") / F.first("n")).alias("share"))
    entries = stage(entries.join(share, "id"), "entries")
    roots = _components(entries, rows, percent)

    named = classes.join(roots, classes["k1"] == roots["node"], "left").select(
        "k1", "k2", "rep", F.coalesce("root", "k1").alias("root")
    )
    named = stage(named, "named")
    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    named = named.join(least, "root").select("k1", "k2", "component")
    return matrix.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, or null, with all columns.

    Rows that repeat a doc_id count as one document.
    """
    found = similar_documents(docs, width, percent)
    gone = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    gone = stage(gone.where("component_id < doc_id").select(F.col("doc_id").alias("gone_id")), "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
