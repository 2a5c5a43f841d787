"""Each stage of the pipeline against brute force on its own input."""

import sys
from pathlib import Path

import corpus_pipeline
import test_contamination
import test_ngrams
import test_repeats
import test_tokens

from ledgerline.llm import toxicity
from ledgerline.sources.staging import stage

SMALL = "/root/testdata/sf0.001"
assert str(Path(corpus_pipeline.__file__).parent) in sys.path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_match_brute_force(spark, sample):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "suffix_dedup", "decontamination", "packing"]
    work = dict(corpus_pipeline.STAGES)
    odd = spark.createDataFrame([(900_001, None, "en", "s", None), (900_002, "", None, None, 0), (None, "a b", "en", "s", 3)], sample.schema)
    docs = sample.unionByName(odd)

    net = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(docs, net).where("rejected").collect()}
    clean = stage(work["toxicity"](spark, docs, SMALL))
    assert rows(clean) == [r for r in rows(docs) if r[0] not in bad]

    single = stage(work["ngram_jaccard"](spark, clean, SMALL))
    want = {d for d, _, c in test_ngrams.brute(pairs(clean)) if d == c}
    assert rows(single) == [r for r in rows(clean) if r[0] in want]

    cut = stage(work["suffix_dedup"](spark, single, SMALL))
    assert cut.columns == docs.columns
    left = {}
    for doc, n, gone, _, kept in test_repeats.brute(pairs(single), lambda t: t.encode(), 50):
        if gone < n or not gone:
            left[doc] = (gone, bytes(kept).decode("utf-8", "ignore"))
    before = {r[0]: r for r in rows(single)}
    for r in rows(cut):
        gone, text = left.pop(r[0])
        assert r == (before[r[0]] if not gone else (r[0], text, r[2], r[3], len(text)))
    assert not left

    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    safe = stage(work["decontamination"](spark, cut, SMALL))
    bad = {d for d, *_, contaminated in test_contamination.brute(pairs(cut), items) if contaminated}
    assert rows(safe) == [r for r in rows(cut) if r[0] not in bad]

    packed = work["packing"](spark, safe, SMALL)
    plain = test_tokens.ENCODERS[test_tokens.WORD][1]
    sizes = {d: len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in pairs(safe)}
    got = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert got == sizes


def test_cut_texts_are_made_where_they_are_cut(spark, texts, capsys):
    shared = "ä" * 40 + "b" * 30
    docs = texts([(1, shared), (2, "é" + shared[5:] + " end"), (3, None), (4, shared), (None, shared)])
    cut = corpus_pipeline.cut_repeats(spark, docs, SMALL)
    cut.explain()
    assert "EvalPython" not in capsys.readouterr().out  # a second Python worker for each core, beside the one that cuts
    # no byte of a character that a cut has split is left
    assert rows(cut) == rows(texts([(1, shared), (2, "é end"), (3, None), (None, shared)]))
