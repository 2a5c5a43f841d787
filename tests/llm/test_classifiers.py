"""Held-out accuracy of the two classifiers, and odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality, toxicity

@pytest.mark.parametrize("module, label, wanted", [(quality, "quality", 0), (toxicity, "toxic", 1)])
def test_held_out_rows(spark, module, label, wanted):
    """Precision and recall of the rarer class on rows that were never fitted."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    scored = module.score(docs, module.fit(docs, labels)).join(labels, "doc_id").where("held_out")
    rows = [(r[label] == wanted, r.predicted == wanted, r.score) for r in scored.collect()]
    true, found = sum(t for t, *_ in rows), sum(p for _, p, _ in rows)
    hits = sum(t and p for t, p, _ in rows)
    assert true >= 20 and hits >= 0.85 * true and hits >= 0.85 * found
    # area under the ROC curve: how often a row of class 1 has the larger score
    one = np.array([s for t, _, s in rows if t == (wanted == 1)])
    zero = np.sort([s for t, _, s in rows if t != (wanted == 1)])
    area = (np.searchsorted(zero, one) + np.searchsorted(zero, one, "right")).mean() / 2 / len(zero)
    assert area > 0.97


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(3)
    net, k = toxicity.new_network(), len(toxicity.SPANS)
    params = [r.normal(0, 0.5, (12, toxicity.WIDTH)), *net.filters, *net.shifts, net.out, np.zeros(1)]
    params = [np.asarray(p, np.float64) for p in params]
    counts = np.array([5, 0, 1, 30])
    mine = r.integers(0, 12, (36, 4)).astype(np.int32)
    labels, weight = np.array([1, 0, 1, 0]), np.array([0.5, 1.0, 2.0, 0.3])

    def loss():
        net.filters, net.shifts, net.out, net.bias = params[1 : 1 + k], params[1 + k : 1 + 2 * k], params[-2], params[-1][0]
        z = net.logits(toxicity.word_vectors(params[0], mine), counts).astype(np.float64)
        return (weight * (np.logaddexp(0, z) - labels * z)).sum()

    # values pass through float32, so slopes are taken over wide steps
    found = toxicity.gradients(net, params, mine, counts, labels, weight)
    for p, g in zip(params, found, strict=True):
        for at in r.permutation(p.size)[:25]:
            where = np.unravel_index(at, p.shape)
            before = p[where]
            p[where] = before + 1e-3
            high = loss()
            p[where] = before - 1e-3
            slope = (high - loss()) / 2e-3
            p[where] = before
            assert slope == pytest.approx(g[where], rel=0.05, abs=2e-3)


def test_shortened_stretches_pool_alike():
    r = np.random.default_rng(1)
    net = toxicity.new_network()
    used = np.arange(0, 400, 2).astype(np.int32)
    net.table[used] = r.normal(size=(len(used), toxicity.WIDTH))
    counts = np.array([0, 200, 3, 1, 60, 0, 90])
    rows = r.integers(0, 200, (counts.sum(), 4)).astype(np.int32) * 2 + 1  # unknown words
    some = r.random(len(rows)) < 0.05
    rows[some, 0] -= 1
    local, left = toxicity.known_places(rows, counts, used)
    table = np.vstack([net.table[used], np.zeros((1, toxicity.WIDTH), np.float32)])
    short = net.logits(toxicity.word_vectors(table, local), left)
    assert left.sum() < 0.4 * counts.sum()
    assert np.allclose(short, net.logits(toxicity.word_vectors(net.table, rows), counts), atol=1e-6)


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, texts, module, label):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "word " * 30_000), (3, "word " * 30_000), (4, "!!! *** \x00")]
    docs = texts(rows).withColumn("score", F.lit("x")).withColumn("threshold", F.lit(9))
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    long = spark.createDataFrame([(3, 1), (1, 0)], f"doc_id long, {label} int")
    few = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (9, 0)], f"doc_id long, {label} int")
    for labels in (none, few, long):
        got = module.score(docs, module.fit(docs, labels)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 3}) == 1
        assert module.score(texts([]), module.fit(docs, labels)).count() == 0


def test_no_toxic_row_is_kept_and_columns_stay(texts):
    docs = texts([(1, "a"), (2, None)]).withColumn("score", F.lit("mine"))
    net = toxicity.new_network()
    net.threshold = 2.0
    kept = toxicity.without_toxic(docs, net)
    assert kept.columns == docs.columns and {r.score for r in kept.collect()} == {"mine"} and kept.count() == 2
    net.threshold = 0.0
    assert toxicity.without_toxic(docs, net).count() == 0


def test_features_are_finite_for_any_text():
    x = quality.features(pa.array([None, "", " \n", "!" * 9, "é", "A" * 100_000, "a\nb\nb"], pa.string()))
    assert x.shape == (7, len(quality.FEATURES)) and np.isfinite(x).all()


def test_trees_take_the_best_cuts():
    """First cut, leaf values and crossed cuts against all cuts tried one by one."""
    r = np.random.default_rng(6)
    gain = lambda g, h: g * g / (h + quality.PULL)
    for _ in range(20):
        g, h = r.normal(0, 3, 9), r.uniform(0.5, 4, 9) * quality.LEAST_WEIGHT
        cuts = {c: gain(g[:c].sum(), h[:c].sum()) + gain(g[c:].sum(), h[c:].sum()) - gain(g.sum(), h.sum()) for c in range(1, 9)}
        best, values = max(cuts, key=cuts.get), quality._tree(g, h)
        steps = np.flatnonzero(np.diff(values)) + 1
        assert best in steps and len(steps) == quality.LEAVES - 1
        for a, b in zip([0, *steps], [*steps, 9], strict=True):
            assert values[a:b] == pytest.approx(g[a:b].sum() / (h[a:b].sum() + quality.PULL))
        g, h = r.normal(0, 3, (5, 4)), r.uniform(0.5, 4, (5, 4))
        halves = lambda n: [(slice(0, c), slice(c, n)) for c in range(1, n)]
        tried = [
            sum(gain(g[x, y].sum(), h[x, y].sum()) for x in rows for y in columns) - gain(g.sum(), h.sum())
            for rows in halves(5) for columns in halves(4)
        ]
        found, table = quality._cross(g, h)
        assert found == pytest.approx(max(tried))
        rows, columns = [(a, b) for a in halves(5) for b in halves(4)][int(np.argmax(tried))]
        for x in rows:
            for y in columns:
                assert table[x, y] == pytest.approx(g[x, y].sum() / (h[x, y].sum() + quality.PULL))
