"""Ids, packing and token files against the tokenizers library and round trips."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import packing, tokenfile
from ledgerline.llm.tokens import Encoder

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ENCODERS = {p: (Encoder(p), Tokenizer.from_file(p)) for p in (WORD, BYTE)}
ODD = ["", " ", "a", "it's we'LL 've", "a  b\n\nc \n d\t\te", "é́ é ́x", "x y   z", " a b　 c",
       "<|endoftext|> a <|endoftext|>b", "x" * 300 + " " + "y1" * 80, "\x00\x1f a\x7f b\x85", "ΑΣ ΣΑΣ İ ǅ", "12 345,6 -- !!\n", "\n", "\na", "a\n",
       "don't, can't. (it's) ÀÉ, é. ÿ! ×, ÷. a<\u0338 a=\u0338 x|y a.b-c_d 'sx. 'S, re're!", "a<|endoftext|>, b.<|endoftext|>.",
       "emoji 😀 😀😀 a😀 b", "\x1ca \x1d b\x0b c"]


def agrees(path, texts):
    mine, plain = ENCODERS[path]
    ids, counts = mine.ids_of(pa.array(texts, pa.string()))
    want = [x.ids for x in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_those_of_the_library(path, sample):
    agrees(path, [*ODD, None])
    agrees(path, [r.text for r in sample.select("text").collect()])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab 'sZ1.!\n\t  　é́ß\u0085中 \r"), max_size=30), max_size=4))
def test_ids_of_odd_white_space(texts):
    agrees(WORD, texts)
    agrees(BYTE, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abÀé×÷ÿ 'sretl.,|<>-_1中\u0301\u0338"), max_size=30), max_size=4))
def test_ids_of_odd_punctuation(texts):
    agrees(WORD, texts)
    agrees(BYTE, texts)


def check_pieces(rows, docs, capacity=packing.CAPACITY):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    plain = ENCODERS[WORD][1]
    for doc, text in docs:
        want = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        got = [i for _, ids in sorted(by_doc[doc, len(want)]) for i in ids]
        assert got == want
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return [sum(n for _, n in parts) for parts in by_sequence.values()]


def test_pack_places_every_id_once(sample):
    docs = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    fills = check_pieces(packing.pack(sample, WORD).collect(), docs)
    assert sum(f < 2048 for f in fills) <= sample.rdd.getNumPartitions()


def test_pack_edges(texts):
    docs = [(1, None), (2, ""), (3, "word " * 9000), (None, "a b"), (5, "a b")]
    check_pieces(packing.pack(texts(docs), WORD).collect(), docs)
    twice = texts([(5, "a b"), (5, "a b")]).selectExpr("*", "'x' AS ids", "1 AS length")
    assert packing.pack(twice, WORD).count() == 2
    assert packing.pack(texts([]), WORD).count() == 0


def test_sum_of_squares_choice():
    levels = packing.LevelArray(10)
    assert levels.place(4) == (0, None)
    levels.put(4, 7)
    assert levels.place(6) == (4, 7)  # fills the open sequence
    levels.put(3, 1), levels.put(3, 2)
    assert levels.place(2)[0] == 3  # two of one fill are worse than one of each
    r = np.random.default_rng(2)
    packer, placed = packing.Packer(64, 0), []
    for i in range(3000):
        placed += packer.add(i, r.integers(0, 9, r.integers(1, 150)).astype(np.uint32))
    assert packer.levels.n_open < 4 * 64  # a few of each fill
    placed += packer.finish()
    fills = {}
    for *_, ids, _, sequence, _ in placed:
        fills[sequence] = fills.get(sequence, 0) + len(ids)
    assert sum(f < 64 for f in fills.values()) <= 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=40))
def test_coding_round_trip(ranks):
    values = np.array(ranks, np.uint32)
    control, data = tokenfile.encode_ids(values)
    assert len(control) == -(-len(values) // 4)
    assert tokenfile.decode_ids(control, data, len(values)).tolist() == ranks


def test_token_files_round_trip(spark, texts, sample, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 1000)
    plain = ENCODERS[BYTE][1]
    edge = texts([(9, "a b"), (None, "q"), (3, None), (3, ""), (7, "word " * 3000)] + [(3, f"{i} x") for i in range(60)])
    edge = edge.selectExpr("*", "'x' AS ids", "1 AS shard", "2 AS before")
    for docs, shards in ((sample, 5), (edge, 3), (texts([]), 2)):
        path = tokenfile.new_file_set(spark)
        tokenfile.write_tokens(docs, BYTE, 2, path, shards)
        rows = tokenfile.positions(tokenfile.read_tokens(spark, path), path).orderBy("start").collect()
        want = [(r.doc_id, [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in docs.collect()]
        want.sort(key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes()))
        assert [(r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in rows] == want
        starts = np.concatenate([[0], np.cumsum([len(x) for _, x in want])])[:-1]
        assert [r.start for r in rows] == starts.tolist()
