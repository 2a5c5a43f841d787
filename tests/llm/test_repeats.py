"""Removal of repeated words and bytes against brute force."""

import hashlib
import random
import re

import pytest

from ledgerline.llm.substrings import compacted_paths, remove_repeated_words
from ledgerline.llm.suffixes import LevelFamily, remove_repeated_bytes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def first_docs(items, width):
    """The smallest id that each window starts in."""
    first = {}
    for doc, seq in items:
        if doc is not None:
            for i in range(len(seq) - width + 1):
                w = tuple(seq[i : i + width]) if isinstance(seq, list) else seq[i : i + width]
                first[w] = min(first.get(w, doc), doc)
    return first


def brute(pairs, split, width):
    items = [(d, split(t or "")) for d, t in pairs]
    first = first_docs(items, width)
    out = []
    for doc, seq in items:
        gone = [False] * len(seq)
        if doc is not None:
            for i in range(len(seq) - width + 1):
                w = tuple(seq[i : i + width]) if isinstance(seq, list) else seq[i : i + width]
                if first[w] < doc:
                    gone[i : i + width] = [True] * width
        kept = [x for x, g in zip(seq, gone, strict=True) if not g]
        n_spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(seq), sum(gone), n_spans, kept))
    return out


def words(text):
    return WORD.findall(text.encode())


def made_texts(seed=3, n=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdeé", k=r.randint(1, 6))) for _ in range(60)]
    passages = [" ".join(r.choices(vocabulary, k=r.randint(8, 40))) for _ in range(6)]
    pairs = []
    for i in range(n):
        parts = [" ".join(r.choices(vocabulary, k=r.randint(0, 30))) for _ in range(3)]
        if r.random() < 0.7:
            parts.insert(r.randint(0, 3), r.choice(passages))
        text = r.choice([" ", "\n", "\t "]).join(parts)
        if pairs and r.random() < 0.2:
            text = r.choice(pairs)[1]
        pairs.append((i * 7 - 20, text))
    r.shuffle(pairs)
    return pairs


EDGES = [
    (None, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
    (2, None),
    (3, ""),
    (4, " \n\t"),
    (5, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (6, "a" * 300),
    (7, "b" + "a" * 5000),
    (8, "é" * 40 + " " + "x y " * 30),
    (9, "x y " * 40 + "é" * 40),
]


@pytest.mark.parametrize("pairs", [made_texts(), made_texts(5, 150), EDGES, []])
def test_words_match_brute_force(texts, small_blocks, pairs):
    got = remove_repeated_words(texts(pairs)).collect()
    want = [(d, n, g, b" ".join(kept).decode()) for d, n, g, _, kept in brute(pairs, words, 13)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(want, key=key)


@pytest.mark.parametrize("pairs", [made_texts(), made_texts(5, 150), EDGES, []])
def test_bytes_match_brute_force(texts, small_blocks, pairs):
    got = remove_repeated_bytes(texts(pairs)).collect()
    want = [(d, n, g, s, bytes(kept)) for d, n, g, s, kept in brute(pairs, lambda t: t.encode(), 50)]
    mine = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(mine, key=key) == sorted(want, key=key)


def test_whole_sample_matches_brute_force(sample):
    pairs = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    digest = lambda b: hashlib.sha256(b).hexdigest()
    got = {r.doc_id: (r.n_words, r.n_removed, digest(r.kept_text.encode())) for r in remove_repeated_words(sample).collect()}
    assert got == {d: (n, g, digest(b" ".join(k))) for d, n, g, _, k in brute(pairs, words, 13)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), digest(bytes(r.kept))) for r in remove_repeated_bytes(sample).collect()}
    assert got == {d: (n, g, s, digest(bytes(k))) for d, n, g, s, k in brute(pairs, lambda t: t.encode(), 50)}


def test_paths_have_their_first_source(texts):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = texts([(1, "a b " + passage), (2, passage + " c"), (3, "d " + passage + " e"), (4, "alone")])
    paths = [tuple(r)[2:] for r in compacted_paths(remove_repeated_words(docs)).collect()]
    assert paths == [(20, 1, 2, 3)]


def test_levels_stay_geometric():
    import numpy as np

    family, r = LevelFamily(), np.random.default_rng(1)
    seen = set()
    for _ in range(40):
        keys = np.unique(r.integers(0, 2000, 50).astype(np.uint64))
        found = family.scan(keys)
        assert [k in seen for k in keys.tolist()] == found.tolist()
        family.add(keys[~found])
        seen |= set(keys.tolist())
        sizes = [len(x) for x in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
