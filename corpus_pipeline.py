"""From raw documents to packed training sequences, in stages of the corpus operators.

1. Toxic documents go.  2. Of each group of near copies, the document with the smallest id
stays.  3. Byte strings that an earlier document has are cut out of the texts; documents
of which nothing is left go.  4. Documents that hold benchmark passages go.  5. The rest is
packed into sequences.

Each stage gets all that its predecessor kept, as a written table.  Documents with null or
empty texts are clean and pass every stage; a null doc_id takes no part in comparisons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import contamination, ngrams, packing, suffixes, toxicity
from ledgerline.llm.workload import PACKING_VOCABULARY, packed, table, vocabulary
from ledgerline.sources.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, net)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngrams.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeats, ``n_chars`` counted anew where a text was cut."""
    cut = suffixes.remove_repeated_bytes(docs, carry=docs.columns, as_text=True)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("rest.text"))
    columns = []
    for name in docs.columns:
        own = F.col(f"rest.`{name}`")
        if name == "text":
            own = F.col("new_text")
        elif name == "n_chars":
            own = F.when(changed, F.length("new_text").cast(docs.schema[name].dataType)).otherwise(own)
        columns.append(own.alias(name))
    return left.withColumn("new_text", text).select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(packing.pack(docs, vocabulary(PACKING_VOCABULARY)))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# SQL can't express the trained classifier of the first stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
