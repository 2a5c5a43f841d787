"""Components of similar documents against all-pairs Jaccard."""

import random
import re

import pytest

from ledgerline.llm import ngrams

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").encode().translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()}


def brute(pairs):
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and None not in (pairs[a][0], pairs[b][0]):
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    parent[find(a)] = find(b)
    low = {}
    for k, (d, _) in enumerate(pairs):
        if d is not None:
            low[find(k)] = min(low.get(find(k), d), d)
    return [(d, len(sets[k]), low.get(find(k)) if d is not None else None) for k, (d, _) in enumerate(pairs)]


def made(seed, n):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdeÉ", k=r.randint(1, 5))) for _ in range(300)]
    say = lambda k: r.choices(vocabulary, k=k)
    bases = [say(r.choice([3, 30, 80, 200])) for _ in range(6)]
    pairs = []
    for i in range(n):
        w = list(r.choice(bases)) if r.random() < 0.8 else say(r.randint(0, 60))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            if w:
                w[r.randrange(len(w))] = r.choice(vocabulary)
        text = r.choice([" ", "\n"]).join(w)
        pairs.append((i * 5 - 40, text.upper() if r.random() < 0.1 else text))
    r.shuffle(pairs)
    return pairs


key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
ODD = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "b a"), (8, "a b c d"), (9, "A b C d"), (None, "a b c d"),
       (8, "a b c d"), (10, "a b c"), (11, "x " * 500), (12, "x " * 30), (13, "x x")]


@pytest.mark.parametrize("pairs", [made(1, 150), ODD, []])
def test_matches_all_pairs(texts, small_blocks, pairs):
    got = [tuple(r) for r in ngrams.similar_documents(texts(pairs)).collect()]
    assert sorted(got, key=key) == sorted(brute(pairs), key=key)


@pytest.mark.parametrize("hot", [0, 8])
def test_matches_with_rounds_and_the_rest(texts, small_blocks, monkeypatch, hot):
    monkeypatch.setattr(ngrams, "FEW_PAIRS", 0)
    monkeypatch.setattr(ngrams, "MOST_ROUNDS", 2)
    monkeypatch.setattr(ngrams, "PRODUCT_ROWS", 5)
    monkeypatch.setattr(ngrams, "HOT_ROWS", hot)
    monkeypatch.setattr(ngrams, "OWN_BLOCKS", 4)
    pairs = made(2, 200)
    got = [tuple(r) for r in ngrams.similar_documents(texts(pairs)).collect()]
    assert sorted(got, key=key) == sorted(brute(pairs), key=key)


def test_sample(sample):
    pairs = [(r.doc_id, r.text) for r in sample.collect()]
    assert sorted(tuple(r) for r in ngrams.similar_documents(sample).collect()) == sorted(brute(pairs))
