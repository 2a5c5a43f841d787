"""Periodic runs against brute force over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import runs, workload


def brute(words):
    """(start, length, period) of all runs, trying every period at every place."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p) and j > i:
                found.setdefault((i, j + p), p)  # smaller periods came first
            i = j + 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def odd_document(r):
    letters, words = r.choice([1, 2, 3, 5, 50]), []
    words = [r.randrange(letters) for _ in range(r.choice([0, 1, 5, 23, 24, 25, 30, 100, 300]))]
    for _ in range(r.randrange(4)):
        if words:
            a, p, m = r.randrange(len(words)), r.randrange(1, 12), r.randrange(80)
            unit = words[a : a + p] if r.random() < 0.5 else [r.randrange(letters) for _ in range(p)]
            words[a:a] = (unit * m)[:m]
    return words


def found_in(docs):
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    start, end, period = runs.find_runs(np.array([w for d in docs for w in d], np.int64), first, 60)
    out = [[] for _ in docs]
    for a, b, p in zip(start.tolist(), end.tolist(), period.tolist(), strict=True):
        d = int(np.searchsorted(first, a, "right")) - 1
        out[d].append((a - int(first[d]), b - a, p))
    return out


def test_random_documents_that_share_a_grammar():
    r = random.Random(5)
    for _ in range(150):
        docs = [odd_document(r) for _ in range(r.randrange(6))]
        docs += docs[:1]
        assert found_in(docs) == [brute(d) for d in docs]


def test_nested_runs_and_long_ones():
    inner = [1, 2] * 15
    nested = (inner + [3, 4]) * 4
    assert found_in([nested]) == [brute(nested)] and len({p for *_, p in brute(nested)}) == 2
    assert found_in([[0] * 100_000]) == [[(0, 100_000, 1)]]


def test_equal_hashes_of_different_words_are_noticed(monkeypatch):
    docs = [[1, 2, 3] * 12 + [4, 5, 6] * 9, list(range(50)), [7] * 30 + [8] * 30]
    monkeypatch.setattr(runs, "mix", lambda x: np.ones(len(x), np.uint64))
    assert found_in(docs) == [brute(d) for d in docs]


def test_grammar_derives_its_text():
    r = random.Random(2)
    words = np.array([r.randrange(4) for _ in range(500)] * 2, np.int64)
    g = runs.grammar(words, 4)
    assert len(g.rest) < 300

    def expand(s):
        return [s] if s < 4 else expand(g.left[s - 4]) + expand(g.right[s - 4])

    assert [w for s in g.rest for w in expand(s)] == words.tolist()
    for i in range(len(g.left)):
        assert expand(i + 4) == words[g.place[i] : g.place[i] + g.length[i + 4]].tolist()
    symbol, place = runs.derived(g, np.ones(len(g.left), bool))
    assert all(words[p : p + g.length[s + 4]].tolist() == expand(s + 4) for s, p in zip(symbol, place, strict=True))


def expected(doc, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    dropped = {i for a, m, p in found for i in range(a + p, a + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{a},{m},{p}\n" for a, m, p in found)
    return (doc, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def sort_key(r):
    return (r[0] is None, r[0] or 0, r[-1])


def test_query_matches_brute_force(spark, sf_dir, sample):
    got = sorted((tuple(r) for r in workload.op13_runs(spark, sf_dir).collect()), key=sort_key)
    want = [expected(r.doc_id, r.text) for r in sample.collect()]
    assert got == sorted(want, key=sort_key) and sum(w[1] for w in want) > 10


@pytest.mark.parametrize("block", [1 << 22, 50])
def test_odd_rows(texts, monkeypatch, block):
    monkeypatch.setattr(runs, "BLOCK_BYTES", block)
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a " * 40), (4, "é ü ü " * 30), (4, "é ü ü " * 30), (10, "x y z " * 40), (5, "w " * 23)]
    docs = texts(rows).withColumn("runs", F.lit(1)).withColumn("kept_text", F.lit("no")).withColumn("words", F.lit("w"))
    got = runs.repeated_runs(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by_id[None].runs] == [(0, 40, 1)] and by_id[None].kept_text == "a"
    assert [tuple(x) for x in by_id[4].runs] == [(0, 60, 2)] and by_id[4].kept_text == "é ü ü"
    assert by_id[5].runs == [] and by_id[5].kept_text == " ".join(["w"] * 23)
    assert by_id[1].runs == by_id[2].runs == by_id[3].runs == [] and by_id[3].kept_text == "" and by_id[1].n_words == 0
    assert runs.repeated_runs(texts([])).count() == 0
