"""Near vectors and components against brute force."""

import numpy as np

from ledgerline.llm import vectors
from ledgerline.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v)

    good = [(i, unit(v), lab) for i, v, lab in rows]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            (i, u, x), (j, w, y) = good[a], good[b]
            if None in (i, j, x, y) or x != y or u is None or w is None or len(u) != len(w):
                continue
            if u @ w >= threshold:
                n[a] += 1
                n[b] += 1
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _, _) in enumerate(good):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [(i, n[k], low.get(find(k)) if i is not None else None) for k, (i, _, _) in enumerate(good)]


def key(r):
    return (r[0] is None, r[0] or 0, r[1])


def test_edges_and_small_cells(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_ROWS", 20)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 16)
    r = np.random.default_rng(3)
    centres = r.normal(size=(60, 64))
    rows = []
    for i in range(700):
        v = centres[r.integers(60)] + r.normal(size=64) * r.choice([0.0, 0.05, 0.12, 0.2])
        rows.append((i * 3, [float(x) for x in v.astype(np.float32)], int(r.integers(3))))
    rows += [(9000 + i, rows[5][1], rows[5][2]) for i in range(40)]
    whole = brute(rows)
    got = sorted([tuple(x)[:3] for x in vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()], key=key)
    want = sorted(whole, key=key)
    links = sum(x[1] for x in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(x[1] for x in got) >= 0.98 * links


def test_odd_rows(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, v, 1), (4, v, None), (None, v, 0), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0),
            (8, [1.0, None, 3.0], 0), (9, [1.0, nan, 3.0], 0), (10, [inf, 2.0, 3.0], 0), (11, [1.0, 2.0], 0), (12, [2.0, 4.0, 6.0], 0),
            (13, [1e30, 2e30, 3e30], 0)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_links", "'x' AS id")
    got = vectors.near_vectors(docs).collect()
    assert sorted([tuple(x)[:3] for x in got], key=key) == sorted(brute(rows), key=key)
    assert all(x.kept == (x.vec_id is None or x.vec_id == x.component_id) for x in got)
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sample_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [tuple(x) for x in table.select("vec_id", "embedding", "label").collect()]
    want = {x[0]: x for x in brute(rows)}
    got = {x.vec_id: tuple(x)[:3] for x in vectors.near_vectors(table).collect()}
    assert sum(x[1] for x in got.values()) >= 0.99 * sum(x[1] for x in want.values())
    assert all(got[i][1] <= want[i][1] for i in want)


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x @ vectors.rotation(64)
    exact, high = x[:100] @ x[100:].T, vectors.estimate_bounds(y[:100], y[100:])
    factor = np.abs(y[100:]).sum(1) / 8
    error = vectors.BOUND * np.sqrt((1 - factor**2) / factor**2 / 63)
    assert abs((high - error - exact).mean()) < 0.005
    assert (high >= exact).mean() > 0.99


def test_components_of_paths_stars_and_rings(spark):
    r = np.random.default_rng(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 340)] + [(500, 501), (501, 502), (502, 500), (9, 9)]
    links += [(int(a), int(b)) for a, b in r.integers(1000, 1100, (60, 2))]
    r.shuffle(links)
    parent = {}

    def find(k):
        parent.setdefault(k, k)
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in links:
        a, b = find(int(a)), find(int(b))
        parent[max(a, b)] = min(a, b)
    want = {k: find(k) for k in parent if k != 9 and (find(k) != k or k in {find(x) for x in parent if x != k})}
    made = spark.createDataFrame([(int(a), int(b)) for a, b in links], "a long, b long")
    assert {x.node: x.root for x in components(made).collect()} == want
    assert components(made.limit(0)).count() == 0
