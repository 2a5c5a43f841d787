"""Row filters.  Each is one predicate that Spark can push to the scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.functions.typing import column


def filter_placeholder_names(df: DataFrame, name: str = "customer_name") -> DataFrame:
    """Drop rows whose name is a placeholder or null."""
    return df.filter(~column(name).isin(S.PLACEHOLDER_NAMES))


def filter_equals(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.filter(column(name) == value)


def filter_not_equals(df: DataFrame, name: str, value: str) -> DataFrame:
    """Rows that differ from ``value``; null rows are dropped too."""
    return df.filter(column(name) != value)


def filter_sql_predicate(df: DataFrame, predicate: str) -> DataFrame:
    return df.filter(predicate)


def filter_drop_null_subset(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.dropna(subset=list(names))


def all_between(bounds: Mapping[str, tuple[float, float]]) -> Column:
    """True when every column lies in its closed range."""
    return reduce(and_, [column(c).between(low, high) for c, (low, high) in bounds.items()])


def null_tests(df: DataFrame, names: Iterable[str], keep: Iterable[str] = (S.KEY,)) -> DataFrame:
    """``<c>_is_null`` and ``<c>_is_not_null`` per column."""
    tests: list[Column] = []
    for c in names:
        tests += [column(c).isNull().alias(f"{c}_is_null"), column(c).isNotNull().alias(f"{c}_is_not_null")]
    return df.select(*[F.col(k) for k in keep], *tests)
