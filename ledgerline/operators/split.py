"""Train and test splits, and folds for cross-validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.functions.typing import column
from ledgerline.operators.ordering import row_numbers

MULTIPLIER = 2_654_435_761  # Knuth's multiplicative hash
BUCKETS = 2**32


def split_random(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's random split; which rows go where depends on the partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def hash_fraction(key: str = S.KEY, seed: int = 0) -> Column:
    """Reproducible number in [0, 1) from an integer key."""
    small = F.pmod(column(key) + F.lit(seed), F.lit(2**31))
    return F.pmod(small * F.lit(MULTIPLIER), F.lit(BUCKETS)) / F.lit(float(BUCKETS))


def split_hash(df: DataFrame, train: float = 0.7, key: str = S.KEY, seed: int = 0) -> DataFrame:
    """Add ``split``: the share ``train`` of the key range is 'train', the rest 'test'."""
    return df.withColumn("split", F.when(hash_fraction(key, seed) < train, "train").otherwise("test"))


def split_features_label(
    df: DataFrame, features: Sequence[str], label: str = S.LABEL, key: str = S.KEY
) -> tuple[DataFrame, DataFrame]:
    """Feature frame and label frame; both keep the key, so they can be rejoined."""
    return df.select(column(key), *[column(c) for c in features]), df.select(column(key), column(label))


def cv_folds(
    df: DataFrame, label: str = S.LABEL, folds: int = 5, key: str = S.KEY, ranges: int | None = None
) -> DataFrame:
    """Stratified folds: rows of each label are dealt out in key order."""
    numbered = row_numbers(df, key, [label], ranges)
    return numbered.withColumn("fold", (F.col("row_number") % folds).cast("int")).drop("row_number")
