"""Running totals and row numbers over a whole table, without one big window.

Rows are cut into ranges of the ordering column at approximate percentiles;
each range is windowed on its own and offset by the totals of the ranges before
it, which is a table of at most ``ranges`` rows per group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.sketches import sketch_columns, sketch_quantiles
from ledgerline.sources.staging import stage

RANGE = "_range"


def default_ranges(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def add_range(df: DataFrame, order: str, ranges: int | None = None) -> DataFrame:
    """Number of the value range that ``order`` falls into, 0 for the smallest.

    The cut points are numbers on the driver, at most ``ranges`` of them, so
    every use of the result sees the same ranges.  Texts, dates and other values
    that are no numbers are parted by Spark's range exchange and written once
    with the number of their part.
    """
    ranges = ranges or default_ranges(df)
    if not isinstance(df.schema[order].dataType, T.NumericType):
        return stage(df.repartitionByRange(ranges, order).withColumn(RANGE, F.spark_partition_id()), "ranges")
    probs = [i / ranges for i in range(1, ranges)]
    found = sketch_quantiles(df, [], order, probs).first()
    cuts = sorted({c for c in found["cuts"] or [] if math.isfinite(c)}) if found else []
    if not cuts:
        return df.withColumn(RANGE, F.lit(0))
    buckets = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol="_order", outputCol="_bucket", handleInvalid="keep"
    ).transform(df.withColumn("_order", F.col(order).cast("double")))
    return buckets.withColumn(RANGE, F.col("_bucket").cast("int")).drop("_order", "_bucket")


def running_totals(
    df: DataFrame,
    order: str,
    totals: Sequence[str],
    by: Sequence[str] = (),
    *,
    descending: bool = False,
    ranges: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<c>`` for each total, and ``next_<c>`` for each carried column.

    ``order`` must be unique within ``by``.  ``next_<c>`` is the value on the
    following row, null on the last one.
    """
    by = list(by)
    ranged = add_range(df, order, ranges)

    def direction(name: str) -> Column:
        return F.desc(name) if descending else F.asc(name)

    first = F.max_by if descending else F.min_by
    parts = ranged.groupBy(*by, RANGE).agg(
        *[F.sum(c).alias(f"part_{c}") for c in totals],
        *[first(c, order).alias(f"first_{c}") for c in carry],
    )
    # at most one row per group and range
    over_ranges = Window.partitionBy(*(by or [F.lit(0)])).orderBy(direction(RANGE))
    before = over_ranges.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by,
        RANGE,
        *[F.coalesce(F.sum(f"part_{c}").over(before), F.lit(0)).alias(f"before_{c}") for c in totals],
        *[F.lead(f"first_{c}").over(over_ranges).alias(f"after_{c}") for c in carry],
    )
    inside = Window.partitionBy(*by, RANGE).orderBy(direction(order))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.select(
            "*",
            *[F.sum(c).over(upto).alias(f"cum_{c}") for c in totals],
            *[F.lead(c).over(inside).alias(f"next_{c}") for c in carry],
        )
        .join(offsets, [*by, RANGE])
        .withColumns(
            {
                **{f"cum_{c}": F.col(f"cum_{c}") + F.col(f"before_{c}") for c in totals},
                **{f"next_{c}": F.coalesce(f"next_{c}", f"after_{c}") for c in carry},
            }
        )
        .drop(RANGE, *[f"before_{c}" for c in totals], *[f"after_{c}" for c in carry])
    )


def row_numbers(df: DataFrame, order: str, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``row_number`` from 1 by ``order`` within ``by``; ``order`` must be unique there."""
    counted = running_totals(df.withColumn("row_number", F.lit(1)), order, ["row_number"], by, ranges=ranges)
    return counted.drop("row_number").withColumnRenamed("cum_row_number", "row_number")


def percent_ranks(df: DataFrame, names: Sequence[str], key: str, ranges: int | None = None) -> DataFrame:
    """``key`` and, under each name, ``100 * (rows below) / (rows - 1)`` among the column's values.

    Ties share the rank of the first of them and a lone value has rank 0.  Nulls and NaN are no values
    and have a null rank.  ``key`` must be unique; it may be of any type, a null key's row has null ranks.

    Equal values are counted first.  Their counts are summed inside value ranges of their own column
    and offset by the ranges before.  A value that more than one in ``ranges`` rows of its column holds
    goes to the rows by broadcast, as a column has fewer than ``ranges`` of them, the others by shuffle.
    """
    names, ranges = list(names), ranges or default_ranges(df)
    values = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in names]
    wide = df.select(F.col(key).alias("_key"), *[v.alias(f"v{i}") for i, v in enumerate(values)])
    inner = [f"v{i}" for i in range(len(names))]
    found = sketch_columns(wide, [], inner, [i / ranges for i in range(1, ranges)]).first()
    cuts = [sorted({c for c in (found[f"cuts{i}"] if found else None) or [] if math.isfinite(c)}) for i in range(len(names))]
    # a column without cuts gets one that parts nothing but the signs
    ranged = Bucketizer(
        splitsArray=[[-math.inf, *(c or [0.0]), math.inf] for c in cuts],
        inputCols=inner,
        outputCols=[f"r{i}" for i in range(len(names))],
        handleInvalid="keep",
    ).transform(wide)
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("at"), F.col(f"r{i}").cast("int").alias("range"), F.col(f"v{i}").alias("value"))
        for i in range(len(names))
    ]))
    long = ranged.select("_key", cells.alias("cell")).select("_key", "cell.*").where("value IS NOT NULL")
    same = ["at", "range", "value"]
    counts = stage(long.groupBy(*same).agg(F.count(F.lit(1)).alias("n")), "rank-counts")
    parts = counts.groupBy("at", "range").agg(F.sum("n").alias("part"))  # at most `ranges` rows a column
    column_rows = Window.partitionBy("at")
    offsets = parts.select(
        "at",
        "range",
        (F.sum("part").over(column_rows.orderBy("range")) - F.col("part")).alias("before"),
        F.sum("part").over(column_rows).alias("total"),
    )
    inside = F.sum("n").over(Window.partitionBy("at", "range").orderBy("value")) - F.col("n")
    below = F.col("before") + F.col("inside")
    position = F.coalesce(F.try_divide(F.lit(100.0) * below, F.col("total") - 1), F.lit(0.0))
    ranks = (
        counts.withColumn("inside", inside)
        .join(F.broadcast(offsets), ["at", "range"])
        .select(*same, position.alias("rank"), (F.col("n") * ranges > F.col("total")).alias("hot"))
    )
    placed = long.join(F.broadcast(ranks.where("hot").drop("hot")), same, "left")
    rest = placed.where("rank IS NULL").drop("rank").join(ranks.where("NOT hot").drop("hot"), same)
    everything = placed.where("rank IS NOT NULL").unionByName(rest)
    back = everything.groupBy("_key").agg(
        *[F.max(F.when(F.col("at") == i, F.col("rank"))).alias(f"p{i}") for i in range(len(names))]
    )
    return (
        df.select(F.col(key).alias("_key"))
        .join(back, "_key", "left")
        .select(F.col("_key").alias(key), *[F.col(f"p{i}").alias(c) for i, c in enumerate(names)])
    )
