"""Pearson correlation in long form (column_i, column_j, r), and pruning by it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.typing import column
from ledgerline.operators.columns import log1p_features
from ledgerline.operators.missing import attach_row, numbers

# a spread this small against the raw second moment is rounding noise
CONSTANT = 1e-12


def corr_matrix_dense(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Correlation of columns that hold no nulls; a constant column gives null."""
    names = list(names)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(df).select("features")
    matrix = Correlation.corr(vectors, "features").head()[0].toArray()  # columns x columns
    rows = [
        (a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, "column_i string, column_j string, r double")


def _moment_partials(k: int):
    """Sums per column pair over the rows where both are present, one block per task."""
    fields = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            here = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            square = x * x
            total += [here.T @ here, x.T @ here, here.T @ x, square.T @ here, here.T @ square, x.T @ x]
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32())]
        columns += [pa.array(block[i, j]) for block in total]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *fields])

    return run, "i int, j int, " + ", ".join(f"{f} double" for f in fields)


def corr_matrix_pairwise(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation; undefined pairs give null.

    Columns are centred on their means first, so sums of squares stay small.
    Each task reduces its rows to one block of pair sums; only those blocks are
    shuffled.
    """
    names = list(names or numbers(df))
    value = {c: F.nanvl(column(c).cast("double"), F.lit(None)) for c in names}
    df, means = attach_row(df, {c: F.avg(value[c]) for c in names})
    centred = df.select(*[(value[c] - means[c]).alias(f"x{i}") for i, c in enumerate(names)])
    run, schema = _moment_partials(len(names))
    sums = centred.mapInArrow(run, schema).groupBy("i", "j").agg(
        *[F.sum(f).alias(f) for f in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )
    n = F.col("n")

    def spread(total: str, squares: str):
        left = F.col(squares) - F.try_divide(F.col(total) * F.col(total), n)
        return F.when(left > F.col(squares) * CONSTANT, left)

    both = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    r = F.try_divide(both, F.sqrt(spread("sx", "sxx")) * F.sqrt(spread("sy", "syy")))
    r = F.when(F.col("i") == F.col("j"), F.when(r.isNotNull(), 1.0)).otherwise(r)
    label = F.array(*[F.lit(c) for c in names])
    upper = sums.select(label[F.col("i")].alias("a"), label[F.col("j")].alias("b"), r.alias("r"))
    pair = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return upper.select(F.explode(F.array_distinct(pair)).alias("p"), "r").select(
        F.col("p.a").alias("column_i"), F.col("p.b").alias("column_j"), "r"
    )


def corr_matrix_log1p(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return corr_matrix_pairwise(log1p_features(df, names))


def corr_prune(matrix: DataFrame, names: list[str], threshold: float = 0.8, keep: str = "none") -> DataFrame:
    """Names to drop for correlations above ``threshold`` in size.

    ``keep="none"`` drops both members of such a pair, ``keep="first"`` only the
    one that comes later in ``names``.
    """
    order = F.array(*[F.lit(c) for c in names])
    strong = matrix.filter(
        (F.array_position(order, F.col("column_i")) < F.array_position(order, F.col("column_j")))
        & (F.abs("r") > threshold)
    )
    members = F.array("column_i", "column_j") if keep == "none" else F.array("column_j")
    return strong.select(F.explode(members).alias("column")).distinct()


def drop_correlated(
    df: DataFrame, names: list[str], threshold: float = 0.8, keep: str = "none"
) -> DataFrame:
    """``df`` without the columns that ``corr_prune`` names."""
    found = corr_prune(corr_matrix_pairwise(df, names), names, threshold, keep)
    return df.drop(*[row["column"] for row in found.collect()])  # at most len(names) rows
