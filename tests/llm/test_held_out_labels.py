"""Held-out labels and repeated ones don't reach the fitted models."""

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality, toxicity
from ledgerline.llm.labelled import class_counts, fold

SMALL = "/root/testdata/sf0.01"


def test_shares_count_each_usable_id_once(spark):
    ids = [r.doc_id for r in spark.range(60).select(F.col("id").alias("doc_id")).where(fold() != 0).limit(2).collect()]
    held = spark.range(60).select(F.col("id").alias("doc_id")).where(fold() == 0).first().doc_id
    rows = [(ids[0], 0), (ids[0], 1), (ids[1], 0), (ids[1], 0), (held, 1), (None, 1), (ids[1], None)]
    assert class_counts(spark.createDataFrame(rows, "doc_id long, toxic int"), "toxic") == [1, 1]


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_do_not_follow_held_out_labels(spark, module, label):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet").cache() for n in ("documents", "labels"))
    turned = labels.withColumn(label, F.when(fold() == 0, F.lit(1)).otherwise(F.col(label)).cast("int"))
    few = docs.where("doc_id < 50").cache()
    mine, other = (
        sorted(map(tuple, module.score(few, module.fit(docs, x, label, 100)).select("doc_id", "score").collect()))
        for x in (labels, turned)
    )
    assert mine == other
