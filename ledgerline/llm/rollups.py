"""Token totals kept up to date by signed changes, in batches that count once.

A rollup is a folder of small tables, one for each committed batch, each with additive
totals by source, language and tokenizer version.  An insert counts +1, a delete -1, and a
revision is a delete of the old count with an insert of the new one.  A batch is summed
before it is written, so a hot source is one row.  The write is the commit: a batch's
folder has a success mark or it doesn't exist for readers, and a batch that is already
there is left alone, so a repeated or restarted batch changes nothing.  ``compact`` sums
many batches into one table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEYS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long"

# fixed counting rules, each a tokenizer version of its own
VERSIONS: dict[str, str] = {"space-1": r"[^\x20\x09-\x0D]+", "alnum-1": r"[0-9A-Za-z]+", "mark-1": r"[0-9A-Za-z]+|[^\x00-\x20\x7F0-9A-Za-z]"}


def token_count(text: Column, version: str) -> Column:
    """Tokens of a whole text under a version; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def changes(docs: DataFrame, version: str, sign: int = 1) -> DataFrame:
    """One signed change for each document; source and language can be null, which is a group."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.lit(version).alias("version"), F.lit(sign).cast("long").alias("n_docs"),
        (sign * token_count(text, version)).alias("n_tokens"),
    )


def later_copies(docs: DataFrame, versions: list[str]) -> DataFrame:
    """Documents whose text a smaller doc_id has too, folded to ``source, lang, copies``.

    One more column for each version holds the tokens of one such document.  A row stands
    for the copies of one text in one source and language.  Only a digest and the counts
    are shuffled, never the text, and copies are summed before that, so a text that fills
    a third of the table is one row for each task.  Null texts are copies of each other; rows
    with equal doc_id and text count as one document and its copies; a null doc_id comes
    after all others.
    """
    text = F.col("text").cast("string")
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("digest"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        *[token_count(text, v).alias(v) for v in versions],
    )
    folded = named.groupBy("digest", "source", "lang").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), *[F.max(f"`{v}`").alias(v) for v in versions]
    )
    # rows of one text: one for each source and language that has it
    place = F.row_number().over(Window.partitionBy("digest").orderBy(F.asc_nulls_last("first"), "source", "lang"))
    copies = F.col("n") - (F.col("place") == 1).cast("long")
    kept = folded.withColumn("place", place).withColumn("copies", copies).where("copies > 0")
    return kept.select("source", "lang", "copies", *[f"`{v}`" for v in versions])


def removals(copies: DataFrame, version: str) -> DataFrame:
    """The signed changes that take the rows of ``later_copies`` out of the totals."""
    return copies.select(
        "source", "lang", F.lit(version).alias("version"),
        (-F.col("copies")).alias("n_docs"), (-F.col("copies") * F.col(f"`{version}`")).alias("n_tokens"),
    )


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class Rollup:
    """The committed batches under ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there)

    def committed(self, batch: str) -> bool:
        return self._exists(f"{self.path}/batch={batch}/_SUCCESS")

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Add a batch of changes; False if it was there already.

        A batch that was begun and not finished has no success mark and is written anew.
        """
        if not batch or any(c in batch for c in "/=*?[]{}"):
            raise ValueError("a batch name is a plain word")
        if self.committed(batch):
            return False
        summed(rows).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def batches(self) -> list[str]:
        if not self._exists(self.path):
            return []
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)
        names = [x.getPath().getName().removeprefix("batch=") for x in found if x.getPath().getName().startswith("batch=")]
        return sorted(n for n in names if self.committed(n))

    def totals(self) -> DataFrame:
        """Current totals; groups whose documents are all gone drop out."""
        paths = [f"{self.path}/batch={b}" for b in self.batches()]
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return summed(rows).where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def compact(self, path: str) -> Rollup:
        """The same totals as one batch of a new rollup at ``path``."""
        made = Rollup(self.spark, path)
        made.commit("compacted", self.totals())
        return made
