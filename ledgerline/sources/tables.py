"""Readers and writers: JDBC, catalog tables, parquet, small local rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CLEAN_TABLE = "default.crs_transformed"


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a database table; with a partition column, in parallel ranges.

    Without ``partition_column`` the whole table comes through one connection,
    which suits small tables only.
    """
    options = {"fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is None:
        return spark.read.jdbc(url=url, table=table, properties=options)
    if lower_bound is None or upper_bound is None or num_partitions is None:
        raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
    return spark.read.jdbc(
        url=url,
        table=table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=options,
    )


def scan_table(spark: SparkSession, name: str = CLEAN_TABLE) -> DataFrame:
    return spark.read.table(name)


def write_table_overwrite(df: DataFrame, name: str = CLEAN_TABLE, path: str | None = None) -> None:
    """Save ``df`` under that name in place of a table that may exist.

    With ``path`` the files go there and stay when the table is dropped.  Nothing is
    dropped beforehand, and Spark refuses a frame that reads the table itself.
    """
    writer = df.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def frame_from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """Small local rows with a stated schema."""
    return spark.createDataFrame(list(rows), schema)
