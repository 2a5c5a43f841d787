"""Blocks hold like amounts of bytes, whatever the ids, the lengths and the copies."""

from pyspark.sql import functions as F

from ledgerline.llm.blocks import ROW_BYTES, blocked
from ledgerline.llm.ngrams import similar_documents
from ledgerline.llm.substrings import remove_repeated_words
from ledgerline.llm.suffixes import remove_repeated_bytes

LIMIT = 20_000


def weights(docs):
    made = blocked(docs, LIMIT, 40_000).docs
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)
    return made.groupBy("block").agg(size.alias("bytes"), F.count("*").alias("n"), F.max("doc_id").alias("last")).collect()


def test_a_stretch_of_long_documents_gets_more_blocks(spark):
    long = F.col("id").between(500, 600)
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word "), F.when(long, 1000).otherwise(20).cast("int")).alias("text")
    )
    found = weights(docs)
    assert sum(r["n"] for r in found) == 2000
    assert max(r["bytes"] for r in found) <= LIMIT + 5000 + ROW_BYTES
    lasts = [r["last"] for r in sorted(found, key=lambda r: r["block"])]
    assert lasts == sorted(lasts)


def test_rows_without_id_are_spread(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("the same text in every row " * 10).alias("text")
    )
    found = weights(docs)
    assert sum(r["n"] for r in found) == 3000
    assert sum(r["n"] for r in found if r["block"] < 0) == 1000
    assert max(r["bytes"] for r in found) <= 2 * LIMIT


def test_empty_null_and_equal_rows(spark):
    assert weights(spark.createDataFrame([], "doc_id long, text string")) == []
    rows = [(None, None)] * 5 + [(2**62, "x"), (2**62 + 1, None), (-5, ""), (7, "y" * 90_000), (7, "y")]
    found = weights(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(r["n"] for r in found) == 10


def test_results_with_a_third_of_rows_without_id_and_a_third_alike(spark, small_blocks):
    same = " ".join(f"word{i}" for i in range(60))
    own = F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.col("id")) for i in range(40)])
    docs = spark.range(1500).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 < 2, F.lit(same)).otherwise(own).alias("text"),
    )
    words = {(r.doc_id, r.n_removed) for r in remove_repeated_words(docs).collect()}
    assert words == {(None, 0)} | {(i, 60 if i % 3 == 1 and i > 1 else 0) for i in range(1500) if i % 3}
    cut = remove_repeated_bytes(docs).select("doc_id", "n_removed").collect()
    assert len(cut) == 1500
    assert {r.doc_id: r.n_removed for r in cut if r.doc_id} == {
        i: len(same) if i % 3 == 1 and i > 1 else 0 for i in range(1500) if i % 3
    }
    assert {r.n_removed for r in cut if r.doc_id is None} == {0}
    linked = similar_documents(docs).collect()
    assert len(linked) == 1500
    assert {(r.doc_id, r.component_id) for r in linked} == {(None, None)} | {
        (i, 1 if i % 3 == 1 else i) for i in range(1500) if i % 3
    }
