"""Windows that share all words but the last are told apart by their whole hashes."""

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.substrings import remove_repeated_words

PASSAGE = " ".join(f"p{i}" for i in range(12))


def test_many_successors_of_one_passage_stay(spark):
    docs = spark.range(120_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit(PASSAGE + " s"), F.col("id").cast("string")).alias("text")
    )
    cut = remove_repeated_words(docs).cache()
    assert cut.count() == 120_000
    assert cut.where("n_removed > 0 or n_words <> 13 or size(paths) > 0").count() == 0
    cut.unpersist()


@pytest.mark.parametrize("gap", [0, 300])
def test_paths_are_cut_where_repeats_branch_in_any_block(texts, small_blocks, gap):
    pairs = [(i * 1000, f"q {PASSAGE} {end}") for i, end in enumerate("aabb")]
    # other documents between them put the four into several blocks
    pairs += [(i * 1000 + j, f"{i}_{j} " * 10 + "x" * 200) for i in range(4) for j in range(1, gap)]
    got = {r.doc_id: r for r in remove_repeated_words(texts(pairs)).collect()}
    for i in range(4):
        assert [(p.start, p.n_words) for p in got[i * 1000].paths] == [(0, 13), (1, 13)]
    assert [got[i * 1000].n_removed for i in range(4)] == [0, 14, 13, 14]
