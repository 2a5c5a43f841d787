"""Counting and filling missing values, each in a single pass."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.typing import column


def numbers(df: DataFrame, kinds: tuple[type, ...] = (T.NumericType,)) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


ROW = "_row"


def attach_row(df: DataFrame, values: dict[str, Column], source: DataFrame | None = None):
    """Add the one-row aggregate of ``source`` (default ``df``) to every row.

    Spark evaluates the aggregate once, as a scalar subquery before the main
    plan.  Returns the frame with a helper column (drop ``ROW`` when done) and
    a column per aggregate.
    """
    fields = [value.alias(f"v{i}") for i, value in enumerate(values.values())]
    row = (source if source is not None else df).agg(*fields).select(F.struct("*"))
    attached = df.withColumn(ROW, row.scalar())
    return attached, {name: F.col(ROW).getField(f"v{i}") for i, name in enumerate(values)}


def null_count(name: str) -> Column:
    return F.count_if(column(name).isNull())


# --- counting -------------------------------------------------------------------
def null_count_by(df: DataFrame, by: str = "market", names: Iterable[str] | None = None) -> DataFrame:
    """Nulls per column and in total for each ``by`` value; null groups left out."""
    names = [c for c in (names or df.columns) if c != by]
    total = reduce(add, [column(c) for c in names])
    counts = df.filter(column(by).isNotNull()).groupBy(column(by)).agg(*[null_count(c).alias(c) for c in names])
    return counts.withColumn("total_nulls", total)


def null_total_by(df: DataFrame, by: str = "market", names: Iterable[str] | None = None) -> DataFrame:
    return null_count_by(df, by, names).select(column(by), "total_nulls")


def null_profile(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Long table (column, num_nulls, num_not_nulls) from one aggregate row."""
    names = list(names or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[null_count(c).alias(f"c{i}") for i, c in enumerate(names)]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"c{i}").alias("num_nulls"),
                (F.col("n") - F.col(f"c{i}")).alias("num_not_nulls"),
            )
            for i, c in enumerate(names)
        ]
    )
    return counts.select(F.inline(entries))


def agg_conditional_sum(df: DataFrame, by: str, name: str) -> DataFrame:
    flag = F.when(column(name).isNull(), 1).otherwise(0)
    return df.groupBy(column(by)).agg(F.sum(flag).alias("n_null"))


def agg_conditional_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(
        F.count(F.when(column(name).isNull(), True)).alias("num_nulls"),
        F.count(F.when(column(name).isNotNull(), True)).alias("num_not_nulls"),
    )


# --- filling ------------------------------------------------------------------------
def impute_zero(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Numeric nulls and NaN become 0."""
    return df.fillna(0, subset=list(names) if names is not None else None)


def impute_mean_double(
    df: DataFrame, names: Iterable[str] | None = None, *, nan_is_null: bool = False
) -> DataFrame:
    """Null doubles become the column mean.

    NaN stays as it is and makes the mean NaN, unless ``nan_is_null``.
    """
    names = list(names) if names is not None else numbers(df, (T.DoubleType,))
    value = {c: F.nanvl(column(c), F.lit(None)) if nan_is_null else column(c) for c in names}
    df, means = attach_row(df, {c: F.avg(value[c]) for c in names})
    return df.withColumns({c: F.coalesce(value[c], means[c]) for c in names}).drop(ROW)


def impute_mean_int(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Null ints become the column mean, cut to a whole number."""
    names = list(names) if names is not None else numbers(df, (T.IntegerType,))
    df, means = attach_row(df, {c: F.avg(column(c)) for c in names})
    return df.withColumns({c: F.coalesce(column(c), means[c].cast("int")) for c in names}).drop(ROW)


def null_to_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(column(c), F.lit(0)) for c in names})
