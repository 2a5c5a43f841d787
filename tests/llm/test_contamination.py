"""Winnowed hits against a direct search for every window."""

import random
import re

import pytest

from ledgerline.llm.contamination import contamination

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").encode().translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if n else []:
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit[i : i + n] = [True] * n
                    found |= windows[key]
        out.append((doc, len(w), sum(hit), sorted(found), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def made():
    r = random.Random(4)
    vocabulary = ["".join(r.choices("abcÉé1", k=r.randint(1, 4))) for _ in range(200)]
    say = lambda n: " ".join(r.choices(vocabulary, k=n))
    items = [(f"i{k}", say(r.choice([3, 5, 12, 13, 14, 30]))) for k in range(12)] + [("i3", say(20)), ("n", None), ("e", " .")]
    docs = []
    for i in range(60):
        text = say(r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            w = (r.choice(items)[1] or "").split()
            a = r.randint(0, max(0, len(w) - 13))
            text += ", " + r.choice([str.lower, str.upper, str])(" ".join(w[a : a + r.randint(10, 16)])) + " " + say(4)
        docs.append((i, text))
    return docs + [(100, None), (101, ""), (3, "other " + items[9][1]), (None, items[11][1]), docs[5]], items


def compare(spark, texts, docs, items):
    table = spark.createDataFrame(items, "item_id string, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in contamination(texts(docs), table).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_matches_direct_search(spark, texts):
    compare(spark, texts, *made())


def test_long_items_only(spark, texts):
    docs, items = made()
    compare(spark, texts, docs, [x for x in items if len(words(x[1])) >= 13])


@pytest.mark.parametrize("docs, items", [([], [("a", "b c")]), ([(1, "b c d"), (2, None)], [])])
def test_empty_tables(spark, texts, docs, items):
    compare(spark, texts, docs, items)


def test_sample(spark, sample):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    pairs = [(r.item_id, r.text) for r in items.collect()]
    docs = [(r.doc_id, r.text) for r in sample.collect()]
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in contamination(sample, items).collect()]
    assert sorted(got) == sorted(brute(docs, [(str(i), t) for i, t in pairs]))
