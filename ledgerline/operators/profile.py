"""Profiling reports.  Every report is one aggregate over narrow columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.sketches import sketch_columns
from ledgerline.functions.typing import column
from ledgerline.operators.missing import numbers
from ledgerline.operators.quantiles import exact_quantiles, wide_values

BASIC = {
    "count": lambda c: F.count(c).cast("double"),
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}
QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def _long(row: DataFrame, cells: dict[tuple[str, str], Column]) -> DataFrame:
    """Turn one aggregate row into rows (column, stat, value)."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"), cell.cast("double").alias("value"))
        for (c, stat), cell in cells.items()
    ]
    return row.select(F.inline(F.array(*entries)))


def _stats(df: DataFrame, names: list[str], stats: dict) -> DataFrame:
    wanted = [(c, stat) for c in names for stat in stats]
    row = df.agg(*[stats[stat](column(c)).alias(f"s{i}") for i, (c, stat) in enumerate(wanted)])
    return _long(row, {cell: F.col(f"s{i}") for i, cell in enumerate(wanted)})


def column_means(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    return _stats(df, list(names or numbers(df)), {"mean": F.avg})


def column_sums(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    return _stats(df, list(names or numbers(df)), {"sum": F.sum})


def describe(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """count, mean, sample stddev, min and max per column, long form."""
    return _stats(df, list(names or numbers(df)), BASIC)


def summary_approx(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """``describe`` plus quartiles from a sketch; quartiles are actual elements."""
    names = list(names or numbers(df))
    cuts = sketch_columns(wide_values(df, names), ["grp"], [f"x{i}" for i in range(len(names))], list(QUARTILES.values()))
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"), F.col(f"cuts{i}")[j].alias("value"))
            for i, c in enumerate(names)
            for j, stat in enumerate(QUARTILES)
        ]
    )
    return describe(df, names).unionByName(cuts.select(F.inline(rows)))


def describe_exact(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """``describe`` plus exact interpolated quartiles."""
    names = list(names or numbers(df))
    found = exact_quantiles(df, names, QUARTILES.values())
    label = F.when(F.col("prob") == 0.25, "25%").when(F.col("prob") == 0.5, "50%").otherwise("75%")
    return describe(df, names).unionByName(found.select("column", label.alias("stat"), "value"))


# --- label balance ------------------------------------------------------------------
def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(column(label)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column(label))


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Smallest class over largest class."""
    counts = df.groupBy(column(label)).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min("n").alias("minority"),
        F.max("n").alias("majority"),
        F.try_divide(F.min("n"), F.max("n")).alias("ratio"),
    )


def class_percentages(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(column(label)).agg(F.count(F.lit(1)).alias("n"))
    whole = df.agg(F.count(F.lit(1)).alias("whole")).scalar()
    return counts.select(column(label), "n", (F.col("n") * 100 / whole).alias("percentage"))
