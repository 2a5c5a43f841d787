"""The toxicity network learns from all labelled rows, and its thresholds count all of them."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import toxicity
from ledgerline.llm.labelled import fold, labelled_rows, perhaps_among
from pyspark.sql import functions as F


def best_f1(scores, labels, cuts):
    found = [2 * labels[scores >= c].sum() / ((scores >= c).sum() + labels.sum()) for c in cuts]
    return max(found)


def test_words_of_rows_beyond_one_block_are_learned(spark, texts):
    """Of each bad word a block of rows has too few documents to know it; all blocks together have enough."""
    r = np.random.default_rng(4)
    bad = [f"{chr(97 + i)}{chr(98 + i)}grim{i}" for i in range(20)]
    plain = lambda: " ".join(f"w{x}" for x in r.integers(0, 40, 12))
    rows = [(i, f"{plain()} {bad[i % 20]} {plain()}" if i % 2 else f"{plain()} {plain()}") for i in range(800)]
    rows = [(i, t.replace(bad[i % 20], bad[i // 2 % 20])) for i, t in rows]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    docs = texts(rows)
    assert labelled_rows(docs, labels, "toxic").count() == labels.where(fold() != 0).count()
    scored = toxicity.score(docs, toxicity.fit(docs, labels, "toxic", 40)).where("held_out").collect()
    right = [x.predicted == x.doc_id % 2 for x in scored]
    assert len(right) > 100 and np.mean(right) > 0.95


def test_thresholds_are_the_best_of_all_rows(spark):
    r = np.random.default_rng(5)
    rows = [("de" if i % 3 else None if i % 2 else "fr", int(i % 7 == 0), float(np.round(r.normal(2.0 * (i % 7 == 0), 1.5), 1))) for i in range(3000)]
    rows += [("xx", 1, 9.0), ("xx", 0, 9.0)]
    net = toxicity.new_network()
    toxicity.calibrate(net, spark.createDataFrame(rows, "lang string, label int, logit double").repartition(5))
    scores, labels = net.calibrated(np.array([x for *_, x in rows])), np.array([y for _, y, _ in rows])
    langs = np.array([str(x) for x, *_ in rows])
    assert set(net.thresholds) == {"de", "fr"} and net.threshold == 0.5
    for limit, mine in [(0.5, langs != ""), *[(v, langs == k) for k, v in net.thresholds.items()]]:
        s, y = scores[mine], labels[mine]
        assert best_f1(s, y, [limit]) == pytest.approx(best_f1(s, y, np.unique(s)))
        assert not np.isclose(s, limit, atol=1e-9).any()


def test_blocks_and_parameters_come_back(texts):
    docs = texts([(1, "one two one"), (2, None), (3, "two"), (3, "two")])
    rows = docs.withColumns({"mark": F.xxhash64("text"), "block": F.lit(0).cast("long"), "label": F.lit(1), "part": F.lit(0)})
    made = rows.groupBy("block").applyInArrow(toxicity._block, toxicity.BLOCKS).toArrow()
    ((_, own, words, counts, labels, _, langs),) = toxicity._opened(made.to_batches())
    every, n = toxicity.word_rows(docs.orderBy("doc_id").toArrow()["text"].combine_chunks())
    assert (own[words] == every).all() and list(counts) == list(n) == [3, 0, 1, 1]
    assert len(own) == 2 and list(labels) == [1] * 4 and langs == ["en"] * 4
    net = toxicity.new_network()
    table = np.arange(3 * toxicity.WIDTH, dtype=np.float32).reshape(3, -1)
    params = [table, *net.filters, *net.shifts, net.out, np.full(1, 2, np.float32)]
    for a, b in zip(params, toxicity.unpacked(toxicity.packed(params), 3), strict=True):
        assert (a == b).all()


def test_a_text_is_moved_once_to_its_block(spark, texts, monkeypatch, capsys):
    made, write = {}, toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, label: write(made.setdefault(label, df), label))
    rows = [(i, f"word{i % 5} and {'grim' if i % 2 else 'fine'}") for i in range(400)]
    docs = texts([*rows, (9, "another text"), (9, "another text"), (None, "no id")])
    labels = [*[(i, i % 2) for i in range(0, 400, 3)], (3, 0), (9999, 1), (None, 1), (5, None)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if there were many labels
    try:
        toxicity.fit(docs, labels, "toxic", 40)
        capsys.readouterr()
        made["labelled"].explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert sum(bool(re.search(r"\btext#", columns)) for columns in moved) == 1
    blocks = list(toxicity._opened(made["labelled"].toArrow().to_batches()))
    assert len(blocks) > 1
    found = labelled_rows(docs, labels, "toxic").collect()
    assert sorted(y for b in blocks for y in b[4]) == sorted(r.label for r in found) and sum(r.doc_id == 9 for r in found) in (0, 3)


def test_filter_of_ids_keeps_every_id(spark, monkeypatch):
    ids, rows = spark.range(0, 9000, 3).toDF("doc_id"), spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    kept = perhaps_among(rows, ids)
    assert kept.columns == ["doc_id", "text"] and kept.join(ids, "doc_id").count() == 3000 and kept.count() < 3100
    monkeypatch.setattr("ledgerline.llm.labelled.FILTER_BITS", 64)
    assert perhaps_among(rows, ids).count() == 9000


def test_steps_are_those_of_dense_adam():
    r = np.random.default_rng(8)
    net, counts = toxicity.new_network(), r.integers(0, 30, 90)
    local = r.integers(0, 200, (counts.sum(), 4)).astype(np.int32)
    local[r.random(len(local)) < 0.2] = 500
    labels, weight = r.integers(0, 2, 90), r.random(90).astype(np.float32)
    start = [np.vstack([r.normal(0, 0.1, (500, toxicity.WIDTH)), np.zeros((1, toxicity.WIDTH))]).astype(np.float32)]
    start += [*net.filters, *net.shifts, net.out, np.zeros(1, np.float32)]
    params, found = ([p.copy() for p in start] for _ in range(2))
    toxicity.take_steps(found, local, counts, labels, weight, 2, 5)
    order, ends = np.random.default_rng(5), np.concatenate([[0], np.cumsum(counts)])
    moments, step = [[np.zeros(p.shape), np.zeros(p.shape)] for p in params], 0
    for _ in range(2):
        turn = order.permutation(90)
        for i in range(0, 90, toxicity.BATCH):
            docs = turn[i : i + toxicity.BATCH]
            mine = np.concatenate([local[ends[d] : ends[d + 1]] for d in docs])
            grads = toxicity.gradients(net, params, mine, counts[docs], labels[docs], weight[docs] / len(docs))
            grads[0][-1], step = 0, step + 1
            for p, g, m in zip(params, grads, moments, strict=True):
                m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.999 * m[1] + 0.001 * g * g
                p -= toxicity.RATE * m[0] / (1 - 0.9**step) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    assert all(np.allclose(a, b, atol=2e-4) for a, b in zip(params, found, strict=True))
    assert (found[0][200:] == start[0][200:]).all() and not (found[0][:200] == start[0][:200]).all()


def test_different_rows_are_found_some_documents_at_a_time(texts):
    r = np.random.default_rng(5)
    docs = [" ".join(f"w{x}" for x in r.integers(0, 30_000, 20_000)) for _ in range(50)] + [None, "w1"]
    column = pa.array(docs, pa.string())
    kinds, words, counts = toxicity.distinct_rows(column)
    every, n = toxicity.word_rows(column)
    assert (kinds[words] == every).all() and (counts == n).all() and words.dtype == np.uint16
    assert [tuple(x) for x in kinds] == sorted({tuple(x) for x in kinds})
    size, names = len(docs), ("block", "doc_id", "mark")
    table = pa.table({k: np.arange(size) * (k != "block") for k in names} | {"text": column, "lang": pa.nulls(size, pa.string())})
    for k in ("label", "part"):
        table = table.append_column(k, pa.array(np.zeros(size, np.int32)))
    tracemalloc.start()
    made = toxicity._block(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(np.frombuffer(made["rows"][0].as_py(), np.int32).reshape(-1, 4), kinds)
    assert np.array_equal(np.frombuffer(made["words"][0].as_py(), words.dtype), words)
    assert peak < 60 * len(words)


def test_blocks_reach_python_one_by_one(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    with toxicity.block_by_block(spark):
        assert {r.n for r in spark.range(6).coalesce(1).mapInArrow(sizes, "n long").collect()} == {1}
    assert spark.conf.get(name) == before
    assert [r.n for r in spark.range(6).coalesce(1).mapInArrow(sizes, "n long").collect()] == [6]
