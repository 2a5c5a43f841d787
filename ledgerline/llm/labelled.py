"""Labelled documents for fitting classifiers, all of them or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
FILTER_BITS = 1 << 24  # of a table that tells most rows without a label apart, before texts are moved


def fold() -> Column:
    """crc32 of the id's decimal text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def usable_labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label``, one row for each id outside fold 0; of repeated labels the larger counts."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 0))
    return usable.groupBy("doc_id").agg(F.max("label").alias("label"))


def class_counts(labels: DataFrame, label: str) -> list[int]:
    """How many usable labels are 0 and how many 1."""
    counted = {r.label: r["count"] for r in usable_labels(labels, label).groupBy("label").count().collect()}
    return [counted.get(x, 0) for x in (0, 1)]


def learnable(docs: DataFrame) -> DataFrame:
    """``doc_id, text, lang`` of all documents outside fold 0, with a label or without; a null id is no row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
    return texts.where(fold() != 0)


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, text, lang, label`` of all labelled documents, held-out rows never.

    A null label or id is no row; of repeated labels for an id the larger counts; ids without a document drop out.
    """
    return learnable(docs).join(usable_labels(labels, label), "doc_id")


def perhaps_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``doc_id`` is not in ``ids``; every row whose id is there stays.

    ``FILTER_BITS`` bits at most are broadcast, whatever the number of ids; a row stays if its id's bit is set.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS).cast("long"))
    place = {"_word": F.shiftright("_slot", 5), "_bit": F.expr("shiftleft(1L, CAST(_slot % 32 AS INT))")}
    marks = ids.select(slot.alias("_slot")).withColumns(place)
    words = marks.groupBy(F.col("_word").alias("_of")).agg(F.bit_or("_bit").alias("_bits"))
    found = (F.col("_word") == F.col("_of")) & (F.col("_bits").bitwiseAND(F.col("_bit")) != 0)
    return rows.withColumn("_slot", slot).withColumns(place).join(F.broadcast(words), found, "left_semi").select(*rows.columns)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``doc_id, text, lang, label`` of at most ``per_class`` rows of either class, held-out rows never.

    Rows are taken in the order of a hash of their id, so the sample is the same in every
    run and grows no further once both classes are full.  A null label or id is no row; of
    repeated labels for an id the larger counts; ids without a document drop out.
    """
    usable = usable_labels(labels, label)
    picked = [usable.where(F.col("label") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for x in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
    # the sample has 2 * per_class rows of two numbers at most
    return texts.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
