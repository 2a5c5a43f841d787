"""Fingerprints and near copies against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import fingerprints, workload


def shingle_set(text, width=5):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", lowered) if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def edited(own, following):
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def check(got, rows):
    """Rows with distinct ids, in ascending order, against their definition."""
    got = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    errors = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        r, own, after = got[doc], text or "", after or ""
        changed = edited(own, after)
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert len(r.fingerprint) == 4 * fingerprints.PERMUTATIONS
        for likeness, other, mark in ((r.near_edited, changed, r.edited_fingerprint), (r.near_next, after, None)):
            true = jaccard(shingle_set(own), shingle_set(other))
            errors.append(likeness - true)
            assert 0 <= likeness <= 1 and abs(likeness - true) < 0.25
            assert likeness == 1 or true < 1
            if mark is not None:
                places = [(r.fingerprint[i : i + 4], mark[i : i + 4]) for i in range(0, len(mark), 4)]
                assert likeness == sum(a == b for a, b in places) / fingerprints.PERMUTATIONS
    return errors


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_matches_definition(spark, size):
    folder = f"/root/testdata/{size}"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    got = workload.op12_fingerprints(spark, folder).collect()
    errors = check(got, rows)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04
    texts = dict(rows)
    marks = {}
    for r in got:
        assert marks.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_odd_rows(texts):
    long = "word another é x " * 20_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "a b c d e f"), (7, long), (8, "😀 b"), (9, "A B C D E F")]
    docs = texts(rows).withColumn("hash", F.lit("x")).withColumn("row", F.lit(1)).withColumn("part", F.lit(1)).repartition(5)
    got = fingerprints.compare_with_next(docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = {r.doc_id: r for r in got.collect()}
    check(got.values(), rows)
    assert got[1].near_next == 1 and got[4].near_next == 1 and got[3].near_next < 0.05
    assert got[1].fingerprint == "f" * 512 and got[6].fingerprint == got[9].fingerprint
    alone = fingerprints.fingerprints(docs).collect()
    assert {r.doc_id: r.fingerprint for r in alone} == {i: r.fingerprint for i, r in got.items()}
    assert fingerprints.compare_with_next(texts([])).count() == 0 and fingerprints.fingerprints(texts([])).count() == 0
    single = fingerprints.compare_with_next(texts([(4, "a b")])).collect()
    assert [(r.doc_id, r.near_next, r.edited_sha256) for r in single] == [(4, 1.0, hashlib.sha256(b"a a").hexdigest())]


def test_null_and_repeated_ids(texts):
    rows = [(None, "n o")] * 40 + [(1, "x y")] * 40 + [(2, "z")]
    got = fingerprints.compare_with_next(texts(rows).repartition(6)).collect()
    assert sorted((r.doc_id or 0, r.near_next) for r in got) == sorted([(0, 1.0)] * 39 + [(0, 0.0)] + [(1, 1.0)] * 39 + [(1, 0.0), (2, 0.0)])


def variants(r, words, n, changes):
    out = []
    for _ in range(n):
        mine = list(words)
        for _ in range(r.randrange(changes + 1)):
            mine[r.randrange(len(mine))] = f"w{r.randrange(10**6)}"
        out.append(" ".join(mine))
    return out


def classes(rows, least=0.8):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None and jaccard(sets[i], sets[j]) >= least:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {(d, rows[top(i)][0]) for i, (d, _) in enumerate(rows)}


@pytest.mark.parametrize("block", [256, 7])
def test_near_copies_match_all_pairs(texts, monkeypatch, block):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", block)
    r = random.Random(8)
    rows = []
    for n, changes in ((40, 1), (40, 6), (20, 30), (5, 0)):
        base = [f"w{r.randrange(300)}" for _ in range(150)]
        rows += variants(r, base, n, changes)
    rows += ["", None, "a b", "A b", "single"]
    rows = [(i, t) for i, t in enumerate(rows, 100)]
    docs = texts([*rows, (None, rows[0][1])]).withColumn("id", F.lit(7)).withColumn("band", F.lit(7))
    got = {(x.doc_id, x.class_id) for x in fingerprints.near_copies(docs).collect()}
    assert got == classes(rows) | {(None, None)}
    assert fingerprints.near_copies(texts([])).count() == 0


def test_near_copies_of_the_sample(spark, sample):
    rows = sorted((r.doc_id, r.text) for r in sample.collect())
    assert {tuple(r) for r in fingerprints.near_copies(sample).collect()} == classes(rows)
