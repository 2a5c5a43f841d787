"""Projection, typing and row-wise feature operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schema as S
from ledgerline.functions.ratios import discipline_score, rating_score, ratio
from ledgerline.functions.typing import column, to_date, to_double, to_int


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by name, ignoring case; names the frame lacks are skipped."""
    return df.drop(*names)


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename in one projection; refuses renames that would give two equal names."""
    after = [renames.get(c, c).lower() for c in df.columns]
    doubled = sorted({c for c in after if after.count(c) > 1})
    if doubled:
        raise ValueError(f"renames give more than one column named {doubled}")
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def select_contract(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[column(c) for c in names])


def cast_double(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_double(c) for c in names})


def cast_int(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_int(c) for c in names})


def cast_date(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_date(c) for c in names})


_CLASSES = {
    "numeric": T.NumericType,
    "text": T.StringType,
    "date": T.DateType,
}


def columns_by_type(df: DataFrame) -> dict[str, list[str]]:
    """Column names grouped as numeric, text, date and other."""
    groups: dict[str, list[str]] = {name: [] for name in [*_CLASSES, "other"]}
    for field in df.schema:
        for name, kind in _CLASSES.items():
            if isinstance(field.dataType, kind):
                groups[name].append(field.name)
                break
        else:
            groups["other"].append(field.name)
    return groups


def columns_by_type_table(df: DataFrame) -> DataFrame:
    """The same as rows (column, data_type, type_class, n_values) with the non-null counts."""
    types, groups = dict(df.dtypes), columns_by_type(df)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("data_type"),
            F.lit(name).alias("type_class"),
            F.col(f"n{df.columns.index(c)}").alias("n_values"),
        )
        for name, members in groups.items()
        for c in members
    ]
    counts = df.agg(*[F.count(column(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.inline(F.array(*entries)))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: row count, column count and the column names in order."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(", ".join(df.columns)).alias("column_names"),
    )


def head_rows(df: DataFrame, n: int = 5, key: str = S.KEY) -> DataFrame:
    return df.orderBy(column(key)).limit(n)


def period_totals(
    df: DataFrame, measures: Iterable[str] = S.SUMMED, *, compat_net_profit: bool = True
) -> DataFrame:
    """Sum each measure over the three periods; a null period gives a null total.

    ``compat_net_profit`` keeps the established definition of ``net_profit``,
    whose oldest term is the depreciation of that period.  Integer periods are
    added as bigint, so a total cannot overflow.
    """
    integers = {f.name for f in df.schema if isinstance(f.dataType, T.IntegerType)}

    def term(name: str):
        return column(name).cast("bigint") if name in integers else column(name)

    totals = {}
    for measure in measures:
        parts = [f"{p}_{measure}" for p in S.PERIODS]
        if measure == "net_profit" and compat_net_profit:
            parts[-1] = "PBLP_depreciation"
        totals[measure] = reduce(add, map(term, parts))
    return df.withColumns(totals)


def add_ratios(df: DataFrame, names: Iterable[str] = tuple(S.RATIOS)) -> DataFrame:
    return df.withColumns({name: ratio(name) for name in names})


def add_scores(df: DataFrame, *, strict_discipline: bool = False) -> DataFrame:
    return df.withColumns(
        {
            "CR_Rating_score": rating_score(),
            "pmt_discipline_score": discipline_score(strict=strict_discipline),
        }
    )


def log1p_features(df: DataFrame, names: Iterable[str] = S.LOG_COLUMNS, keep: Iterable[str] = ()) -> DataFrame:
    """``log1p_<c>`` per column; arguments at or below -1 give null."""
    return df.select(*[column(c) for c in keep], *[F.log1p(column(c)).alias(f"log1p_{c}") for c in names])


def narrow_to_int(df: DataFrame, names: Iterable[str] = S.NARROWED_TO_INT) -> DataFrame:
    """Truncate numeric columns to int; values beyond int become null."""
    return df.withColumns({c: column(c).try_cast("int") for c in names})
