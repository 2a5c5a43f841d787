"""Synthetic rows from a Gaussian copula with beta marginals.

Fitting is one aggregate for the moments, one correlation of normal scores and
no per-row work on the driver.  Sampling derives every draw from the row number,
so a lost task draws the same rows again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.typing import column
from ledgerline.operators.profile import class_percentages

TABLE_POINTS = 4001
MOST_DECIMALS = 15
SURE_DIGITS = 13  # of a double after some additions; a value that needs more is continuous
NOISE = 4 * 2.0**-52  # relative error that additions in another order may leave


def decimals(value):
    """Most digits after the point that a value of a column needs (an aggregate).

    A value is exact at so many digits if it is that decimal but for float noise.  Null
    where some value, as quotients do, needs more than ``SURE_DIGITS`` in all or
    ``MOST_DECIMALS`` after the point: such a column is not rounded.
    """
    before = F.floor(F.log10(F.abs(value))).cast("int") + 1  # below zero for zeros after the point
    continuous = MOST_DECIMALS + 1

    def exact(d: int):
        return F.abs(F.round(value, d) - value) <= NOISE * F.abs(value)

    need = F.when(value.isNull(), None).when(exact(0), 0)
    for d in range(1, MOST_DECIMALS + 1):
        need = need.when(before + d > SURE_DIGITS, continuous).when(exact(d), d)
    most = F.max(need.otherwise(continuous))
    return F.when(most <= MOST_DECIMALS, most)


def _long(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column"), column(c).cast("double").alias("value")) for c in names]
            )
        )
    )


def metadata(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Type, range, nulls and decimals per column."""
    types = dict(df.dtypes)
    type_of = F.create_map(*[F.lit(part) for c in names for part in (c, types[c])])
    return (
        _long(df, names)
        .groupBy("column")
        .agg(
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.count_if(F.col("value").isNull()).alias("n_null"),
            decimals(F.col("value")).alias("decimals"),
        )
        .select("column", type_of[F.col("column")].alias("data_type"), "min", "max", "n_null", "decimals")
    )


def beta_shape(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Beta parameters by moments on the observed range, and the decimals of each column."""
    stats = (
        _long(df, names)
        .groupBy("column")
        .agg(
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.avg("value").alias("mean"),
            F.var_pop("value").alias("var"),
            decimals(F.col("value")).alias("decimals"),
        )
    )
    width = F.col("high") - F.col("low")
    m = F.try_divide(F.col("mean") - F.col("low"), width)
    v = F.try_divide(F.col("var"), width * width)
    size = F.try_divide(m * (1 - m), v) - 1
    return stats.select(
        "column", "low", "high", (m * size).alias("alpha"), ((1 - m) * size).alias("beta"), "decimals"
    )


@dataclass(frozen=True)
class Marginal:
    """A column's distribution as a table from value to normal score; no decimals: continuous."""

    name: str
    low: float
    high: float
    decimals: int | None
    values: np.ndarray
    scores: np.ndarray


@dataclass(frozen=True)
class Copula:
    marginals: list[Marginal]
    correlation: np.ndarray


def _marginal(name: str, low: float, high: float, alpha: float | None, beta: float | None, digits: int | None) -> Marginal:
    if alpha is None or not high > low:
        return Marginal(name, low, high, digits, np.array([low, low]), np.array([-1.0, 1.0]))
    # x = sin(t)^2 spreads points towards both ends, where a beta density may be steep
    t = np.linspace(0.0, np.pi / 2, TABLE_POINTS)
    mid = (t[1:] + t[:-1]) / 2
    log_mass = (2 * alpha - 1) * np.log(np.sin(mid)) + (2 * beta - 1) * np.log(np.cos(mid))
    mass = np.exp(log_mass - log_mass.max())
    share = np.concatenate([[0.0], np.cumsum(mass)]) / mass.sum()
    score = np.array([NormalDist().inv_cdf(p) for p in np.clip(share, 1e-9, 1 - 1e-9)])
    return Marginal(name, low, high, digits, low + (high - low) * np.sin(t) ** 2, score)


def fit(df: DataFrame, names: Sequence[str]) -> Copula:
    """Fit marginals and the correlation of their normal scores.  Columns must hold no nulls."""
    names = list(names)
    shapes = {r["column"]: r for r in beta_shape(df, names).collect()}  # one row per column
    marginals = [
        _marginal(c, *(shapes[c][f] for f in ("low", "high", "alpha", "beta", "decimals"))) for c in names
    ]
    tables = [(m.values, m.scores) for m in marginals]

    def to_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [
                pa.array(np.interp(c.to_numpy(zero_copy_only=False), x, z))
                for c, (x, z) in zip(batch.columns, tables, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    fields = [f"x{i}" for i in range(len(names))]
    plain = df.select(*[column(c).cast("double").alias(f) for c, f in zip(names, fields, strict=True)])
    scores = plain.mapInArrow(to_scores, ", ".join(f"{f} double" for f in fields))
    vectors = VectorAssembler(inputCols=fields, outputCol="z").transform(scores).select("z")
    matrix = Correlation.corr(vectors, "z").head()[0].toArray()
    matrix = np.where(np.isnan(matrix), 0.0, matrix)
    np.fill_diagonal(matrix, 1.0)
    return Copula(marginals, matrix)


def correlation_table(spark: SparkSession, copula: Copula) -> DataFrame:
    names = [m.name for m in copula.marginals]
    rows = [
        (a, b, float(copula.correlation[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)
    ]
    return spark.createDataFrame(rows, "column_i string, column_j string, rho double")


def _root(matrix: np.ndarray) -> np.ndarray:
    """Square root of the nearest valid correlation matrix."""
    values, vectors = np.linalg.eigh(matrix)
    root = vectors * np.sqrt(np.clip(values, 0.0, None))
    return root / np.sqrt((root**2).sum(axis=1, keepdims=True))


def sample(spark: SparkSession, copula: Copula, rows: int, seed: int = 42) -> DataFrame:
    """``rows`` synthetic rows; values keep the observed range and decimals."""
    k = len(copula.marginals)
    root = _root(copula.correlation)
    tables = [(m.scores, m.values, m.low, m.high, m.decimals) for m in copula.marginals]
    names = [m.name for m in copula.marginals]

    # two hash-made uniforms per normal draw (Box and Muller)
    def uniform(stream: int):
        def draw(j):
            return (F.pmod(F.xxhash64("id", j, F.lit(seed), F.lit(stream)), F.lit(2**52)) + F.lit(0.5)) / F.lit(2.0**52)

        return draw

    first, second = uniform(1), uniform(2)
    normals = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda j: F.sqrt(-2 * F.log(first(j))) * F.cos(2 * np.pi * second(j)),
    )
    schema = T.StructType(
        [T.StructField("id", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in names]
    )

    def to_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            drawn = batch.column(1).flatten().to_numpy().reshape(-1, k) @ root.T
            columns = [batch.column(0)]
            for i, (scores, values, low, high, digits) in enumerate(tables):
                value = np.interp(drawn[:, i], scores, values)
                if digits is not None:
                    value = np.round(value, digits)
                columns.append(pa.array(np.clip(value, low, high)))
            yield pa.RecordBatch.from_arrays(columns, names=["id", *names])

    return spark.range(rows).select("id", normals.alias("z")).mapInArrow(to_values, schema)


def compare(real: DataFrame, synthetic: DataFrame, label: str, names: Sequence[str] = ()) -> DataFrame:
    """Long table (measure, name, real, synthetic, gap) of two frames.

    Measures: the ``share`` of each class in percent, the ``mean`` of each column of ``names`` and its
    sample ``spread``; one aggregate for each frame and kind.  The gap is synthetic less real;
    a class that only one frame has, has share 0 in the other.
    """
    sides = {"real": real, "synthetic": synthetic}

    def shares(name: str, frame: DataFrame) -> DataFrame:
        typed = frame.withColumn(label, column(label).cast("int"))
        found = class_percentages(typed, label)
        return found.select(F.lit("share").alias("measure"), column(label).cast("string").alias("name"), F.col("percentage").alias(name))

    def moments(name: str, frame: DataFrame) -> DataFrame:
        both = [(kind, c, f(column(c).cast("double"))) for kind, f in (("mean", F.avg), ("spread", F.stddev_samp)) for c in names]
        row = frame.agg(*[value.alias(f"v{i}") for i, (*_, value) in enumerate(both)])
        cells = [F.struct(F.lit(k).alias("measure"), F.lit(c).alias("name"), F.col(f"v{i}").alias(name)) for i, (k, c, _) in enumerate(both)]
        return row.select(F.inline(F.array(*cells)))

    def side(name: str, frame: DataFrame) -> DataFrame:
        return shares(name, frame).unionByName(moments(name, frame)) if names else shares(name, frame)

    one, other = (side(name, frame) for name, frame in sides.items())
    # a row for each class and column
    joined = one.join(other, ["measure", "name"], "full")
    known = {c: F.when(F.col("measure") == "share", F.coalesce(c, F.lit(0.0))).otherwise(F.col(c)) for c in sides}
    return joined.withColumns(known).withColumn("gap", F.col("synthetic") - F.col("real"))
