"""Signed changes, batches that count once, and odd rows."""

import re
import uuid

from ledgerline.llm import rollups
from ledgerline.sources.staging import new_path

SCHEMA = "doc_id long, text string, lang string, source string, n_docs long"
A = [(1, "a b c.", "en", "s", 9), (2, None, "en", "s", 9), (3, "", None, None, 9), (4, "é1 x!\x1cy", "de", "t", 9), (4, "é1 x!\x1cy", "de", "t", 9)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_batches_count_once_and_revise(spark):
    docs = spark.createDataFrame(A, SCHEMA)
    book = rollups.Rollup(spark, new_path(spark, "rollup"))
    assert rows(book.totals()) == [] and book.batches() == []
    assert book.commit("b1", rollups.changes(docs, "space-1"))
    first = rows(book.totals())
    assert first == sorted([("s", "en", "space-1", 2, 3), (None, None, "space-1", 1, 0), ("t", "de", "space-1", 2, 4)], key=repr)
    assert not book.commit("b1", rollups.changes(docs, "space-1"))
    assert rows(book.totals()) == first
    revised = rollups.changes(docs, "space-1", -1).unionByName(rollups.changes(docs, "alnum-1"))
    assert book.commit("b2", revised)
    assert {r[2] for r in rows(book.totals())} == {"alnum-1"}
    assert rows(book.compact(new_path(spark, "rollup")).totals()) == rows(book.totals())
    assert book.commit("b3", rollups.changes(docs, "alnum-1", -1))
    assert rows(book.totals()) == []


def test_an_unfinished_batch_is_written_anew(spark, tmp_path):
    docs = spark.createDataFrame(A, SCHEMA)
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    rollups.summed(rollups.changes(docs, "space-1")).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch=x")
    book = rollups.Rollup(spark, path)
    assert book.batches() == [] and rows(book.totals()) == []
    assert book.commit("x", rollups.changes(docs, "space-1")) and book.batches() == ["x"]


def test_counts_match_python(sample):
    for version, pattern in rollups.VERSIONS.items():
        got = {r[0]: r[1] for r in sample.select("doc_id", rollups.token_count(sample["text"], version)).collect()}
        assert got == {r.doc_id: len(re.findall(pattern, r.text or "")) for r in sample.collect()}


def test_later_copies_leave_one_of_each_text(spark):
    same = [(i, "x y", "en" if i % 3 else "de", f"s{i % 2}", 0) for i in range(30, 10, -1)]
    odd = [(3, None, "en", "s", 0), (5, None, None, None, 0), (None, "x y", "en", "s1", 0), (8, "z", "en", "s", 0)]
    docs = spark.createDataFrame(A + same + odd, SCHEMA)
    seen, want = set(), {}
    ordered = sorted(A + same + odd, key=lambda r: (r[0] is None, r[0] or 0))
    for _, text, lang, source, _ in ordered:
        if text in seen:
            n, tokens = want.get((source, lang), (0, 0))
            want[source, lang] = n - 1, tokens - len(re.findall(rollups.VERSIONS["space-1"], text or ""))
        seen.add(text)
    gone = rollups.summed(rollups.removals(rollups.later_copies(docs, ["space-1"]), "space-1"))
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in gone.collect()} == want
    assert rows(rollups.later_copies(docs.limit(0), ["space-1"])) == []


def test_empty_table(spark):
    assert rows(rollups.summed(rollups.changes(spark.createDataFrame([], SCHEMA), "space-1"))) == []
