"""Near-duplicate vectors by randomly rotated binary codes with correction factors.

A unit vector is rotated at random and kept as the signs of its coordinates.  The stored
factor, the inner product of the vector and its code, makes the code an unbiased
estimator of inner products, with an error that falls with the root of the dimension.
Pairs whose confidence bound stays below the threshold are dropped; the rest are
recomputed in double precision from the vectors.

The leading signs also name a cell; there are as many as a label's vectors ask for.  A
vector lives in one cell and looks into every cell that differs only in signs whose
coordinate is small, since only those can differ between near vectors.  Cells are split
into blocks of rows, and a task compares two blocks.  It returns each vector's number of
links and one link to the block's smallest connected vector, never the pairs.

What can be missed: a pair that differs, in the same leading coordinate, by over
``MARGIN`` times its usual difference, or whose estimate is off by over ``BOUND``
deviations.  Recall is measured against brute force in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.graph import components
from ledgerline.sources.staging import stage

CELL_ROWS = 1024  # usual vectors of a cell
BLOCK_ROWS = 2048
MARGIN = 3.0
BOUND = 3.0
MOST_BITS = 30

CODED = "id long, label string, weight long, dim int, vector binary, home long, mask long, cells array<bigint>"
FOUND = "id long, n long, root long"
FOUND_ARROW = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])

_rotations: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    if dim not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
        _rotations[dim] = q * np.sign(np.diag(r))
    return _rotations[dim]


def cell_codes(rotated: np.ndarray, bits: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each rotated unit vector, and the mask of its uncertain bits."""
    lead = rotated[:, :bits]
    place = np.int64(1) << np.arange(lead.shape[1], dtype=np.int64)
    # a pair at the threshold is sqrt(2 - 2 t) apart, evenly over the coordinates
    margin = MARGIN * np.sqrt(max(0.0, 2 - 2 * threshold) / rotated.shape[1])
    return (lead > 0) @ place, (np.abs(lead) <= margin) @ place


def _looked_into(home: int, mask: int) -> list[int]:
    """All cells that differ from ``home`` in bits of ``mask`` only."""
    cells, sub = [home], mask
    while sub:
        cells.append(home ^ sub)
        sub = (sub - 1) & mask
    return cells


def estimate_bounds(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Upper confidence bounds of all inner products of rotated unit vectors.

    Of ``vectors`` only the signs and the correction factors are used.
    """
    dim = vectors.shape[1]
    signs = np.where(vectors > 0, np.float32(1), np.float32(-1)) / np.float32(np.sqrt(dim))
    factor = np.abs(vectors).sum(1) / np.sqrt(dim)
    estimate = queries.astype(np.float32) @ signs.T / factor.astype(np.float32)
    error = BOUND * np.sqrt(np.maximum(0, 1 - factor**2) / factor**2 / max(1, dim - 1))
    return estimate + error.astype(np.float32)


def _compare(home: pa.Table, query: pa.Table, threshold: float) -> list[dict]:
    if not home.num_rows or not query.num_rows:
        return []
    parts = []
    for t in (home, query):
        ids, weights, homes, masks = (t.column(c).to_numpy() for c in ("id", "weight", "home", "mask"))
        raw = np.frombuffer(b"".join(t.column("vector").to_pylist()), np.float64).reshape(len(ids), -1)
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        parts.append((ids, weights, homes, masks, unit, unit @ rotation(raw.shape[1])))
    (h_id, h_weight, h_home, h_mask, h_unit, h_turned), (q_id, q_weight, q_home, _, q_unit, q_turned) = parts
    maybe = estimate_bounds(q_turned, h_turned) >= threshold
    maybe &= q_id[:, None] != h_id[None]
    rows, cols = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    if not len(rows):
        return []
    if maybe.sum() * 8 < len(rows) * len(cols):
        i, j = np.nonzero(maybe)
        near = np.einsum("ij,ij->i", q_unit[i], h_unit[j]) >= threshold
    else:
        exact = q_unit[rows] @ h_unit[cols].T
        i, j = np.nonzero((exact >= threshold) & maybe[np.ix_(rows, cols)])
        i, j = rows[i], cols[j]
        near = np.ones(len(i), bool)
    i, j = i[near], j[near]
    if not len(i):
        return []
    n_query = np.bincount(i, weights=h_weight[j], minlength=len(q_id))
    # the other side finds the pair itself if it looks into this one's home
    alone = (q_home[i] ^ h_home[j]) & ~h_mask[j] != 0
    n_home = np.bincount(j[alone], weights=q_weight[i[alone]], minlength=len(h_id))
    a, b = q_id.copy(), h_id.copy()
    while True:  # smallest id reachable inside the two blocks
        low = np.minimum(a[i], b[j])
        before = a.sum() + b.sum()
        np.minimum.at(a, i, low)
        np.minimum.at(b, j, low)
        if a.sum() + b.sum() == before:
            break
    found = []
    for ids, counts, roots, at in ((q_id, n_query, a, np.unique(i)), (h_id, n_home, b, np.unique(j))):
        found += [{"id": int(ids[k]), "n": int(counts[k]), "root": int(roots[k])} for k in at]
    return found


def _usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(embeddings: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``.

    Rows link when their labels are equal and not null and their cosine reaches the
    threshold; ``kept`` marks the smallest vec_id of each component.  Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different length or rows without a vec_id, which are kept.  Exact copies count as links
    of each other and are compared once.  Other columns are ignored; an empty table gives
    no rows.
    """
    every = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    usable = every.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    copies = usable.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("weight")
    ).withColumn("dim", F.size("embedding"))
    copies = stage(copies, "copies")
    sizes = copies.groupBy("label", "dim").agg(F.count("*").alias("n_label"))
    sized = copies.join(sizes, ["label", "dim"]).withColumn(
        "bits", F.least(F.greatest(F.ceil(F.log2(F.col("n_label") / CELL_ROWS)), F.lit(0)), "dim", F.lit(MOST_BITS)).cast("int")
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                v = np.array(r["embedding"], np.float64)
                v /= np.abs(v).max()  # keeps squares finite
                home, mask = cell_codes((v / np.linalg.norm(v))[None] @ rotation(len(v)), r["bits"], threshold)
                home, mask = int(home[0]), int(mask[0])
                rows.append({"id": r["id"], "label": r["label"], "weight": r["weight"], "dim": len(v), "vector": v.tobytes(),
                             "home": home, "mask": mask, "cells": _looked_into(home, mask)})
            yield pa.RecordBatch.from_pylist(rows, schema=CODED_ARROW)

    coded = stage(sized.select("id", "label", "weight", "embedding", "bits").mapInArrow(code, CODED), "coded")
    key = ["label", "dim", "cell"]
    home = coded.withColumn("cell", F.col("home")).drop("cells")
    query = coded.toDF(*coded.columns).withColumn("cell", F.explode("cells")).drop("cells")
    blocks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias(name))
    split = stage(blocks(home, "n_home").join(blocks(query, "n_query"), key), "split")
    some = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    home = home.join(split, key).withColumn("h", some("n_home")).withColumn("q", each("n_query"))
    query = query.join(split, key).withColumn("q", some("n_query")).withColumn("h", each("n_home"))
    group = [*key, "h", "q"]
    wanted = [*group, "id", "weight", "vector", "home", "mask"]

    def compare(h: pa.Table, q: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_compare(h, q, threshold), schema=FOUND_ARROW)

    pairs = home.select(*wanted).groupBy(*group).cogroup(query.select(*wanted).groupBy(*group))
    found = stage(pairs.applyInArrow(compare, FOUND), "found")
    linked = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = copies.join(linked, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("label").alias("c_label"), F.col("embedding").alias("c_embedding"),
        (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"),
    )
    rest = every.where(F.col("label").isNull() | F.col("vec_id").isNull() | ~_usable(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    same = (usable["label"] == classes["c_label"]) & (usable["embedding"] == classes["c_embedding"])
    members = usable.join(classes, same).select("vec_id", "n_links", "component_id")
    return members.unionByName(rest).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )


CODED_ARROW = pa.schema(
    [("id", pa.int64()), ("label", pa.string()), ("weight", pa.int64()), ("dim", pa.int32()), ("vector", pa.binary()),
     ("home", pa.int64()), ("mask", pa.int64()), ("cells", pa.list_(pa.int64()))]
)
