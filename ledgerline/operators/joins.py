"""Equi-joins; Spark picks broadcast or shuffle from the sizes it sees."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schema as S


def join_fold(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner-join several keyed tables one after the other.

    For sums of many tables see ``merge_sums``, for counts of one table ``missing.null_count_by``.
    """
    return reduce(lambda left, right: left.join(right, key, "inner"), frames)


TAG_BITS = 62  # tables that one number has flags for


def merge_sums(tables: Sequence[tuple[str, DataFrame, Column]], key: str) -> DataFrame:
    """Sums of many keyed tables side by side, for the keys that all of them have.

    ``tables`` has a name, a frame and the summand of each.  The rows are put under one another
    with a tag of their table and summed in one aggregate: one exchange, of a row for each
    key and task, where a fold of joins has one for each table.  Null keys are left out, as
    in a join; nulls add nothing.
    """
    words = -(-len(tables) // TAG_BITS)

    def tagged(i: int, frame: DataFrame, summand: Column) -> DataFrame:
        return frame.select(F.col(f"`{key}`").alias("key"), F.lit(i).alias("tag"), summand.cast("long").alias("value"))

    rows = reduce(DataFrame.unionAll, [tagged(i, frame, x) for i, (_, frame, x) in enumerate(tables)])
    flag = lambda w: F.when(
        F.floor(F.col("tag") / TAG_BITS) == w, F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("tag") % TAG_BITS).cast("int"))
    )
    full = [(1 << min(TAG_BITS, len(tables) - w * TAG_BITS)) - 1 for w in range(words)]
    sums = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(
        *[F.bit_or(flag(w)).alias(f"_has{w}") for w in range(words)],
        *[F.coalesce(F.sum(F.when(F.col("tag") == i, F.col("value"))), F.lit(0)).alias(name) for i, (name, *_) in enumerate(tables)],
    )
    whole = reduce(lambda a, b: a & b, [F.col(f"_has{w}") == F.lit(full[w]) for w in range(words)])
    return sums.filter(whole).select(F.col("key").alias(key), *[F.col(f"`{name}`") for name, *_ in tables])


def join_on_key(features: DataFrame, labels: DataFrame, key: str = S.KEY) -> DataFrame:
    """Pair features with labels by business key; row positions are not stable in Spark."""
    return features.join(labels, key, "inner")
