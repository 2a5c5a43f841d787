"""Exact quantiles without sorting or gathering a column.

One aggregate gives a sketch of every column, which brackets each wanted rank.
A second scan counts the values under each bracket and writes the few inside it
to a bracket store; every later step reads only that store.  Brackets that still
hold many distinct values are narrowed there by exact counts of parts.  The
counts decide: a sketch that is off costs another scan, not a wrong value.

Nulls and NaN are no values; infinite ones are ordinary values at the ends.  A
column (of a class) without values has null quantiles; an empty table has none.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.functions.sketches import sketch_columns, sketch_quantiles
from ledgerline.functions.typing import column
from ledgerline.sources.staging import stage

GRID = 200
PROBS = [i / GRID for i in range(GRID + 1)]
MARGIN = 2
KEY = ["grp", "cell"]


def long_values(df: DataFrame, names: Iterable[str], by: str | None = None) -> DataFrame:
    """Rows (grp, column, value) of all values that are neither null nor NaN.

    ``by`` is a class label with any number of values.
    """
    grp = column(by) if by else F.lit(0)
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), column(c).cast("double").alias("value")) for c in names]
    )
    return df.select(grp.alias("grp"), F.inline(entries)).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def number(name: str) -> Column:
    """A column as double, null for NaN."""
    value = column(name).cast("double")
    return F.when(~F.isnan(value), value)


def wide_values(df: DataFrame, names: list[str], by: str | None = None) -> DataFrame:
    """Columns grp, x0, x1, ... with null for NaN."""
    grp = column(by) if by else F.lit(0)
    return df.select(grp.alias("grp"), *[number(c).alias(f"x{i}") for i, c in enumerate(names)])


def _wanted(sketches: DataFrame, names: list[str], probs: list[float], margin: int) -> DataFrame:
    """One row for each class and cell (column and probability): its ranks and bracket."""
    columns = [
        F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"cuts{i}").alias("cuts"))
        for i, c in enumerate(names)
    ]
    ranks = (
        sketches.select("grp", F.inline(F.array(*columns)))
        .select("*", F.posexplode(F.array(*[F.lit(p) for p in probs])).alias("j", "prob"))
        .withColumn("n", F.nullif("n", F.lit(0)))
        .withColumn("position", (F.col("n") - 1) * F.col("prob"))
        .withColumns({"lower": F.floor("position"), "upper": F.ceil("position")})
    )
    first = F.floor(F.col("lower") * GRID / F.col("n")) - margin
    last = F.floor(F.col("upper") * GRID / F.col("n")) + 1 + margin
    low = F.when(first <= 0, -math.inf).otherwise(F.get("cuts", first.cast("int")))
    high = F.when(last >= GRID, math.inf).otherwise(F.get("cuts", last.cast("int")))
    wanted = ranks.select(
        "grp",
        (F.col("i") * len(probs) + F.col("j")).alias("cell"),
        "column",
        "prob",
        "lower",
        "upper",
        (F.col("position") - F.col("lower")).alias("part"),
        # without values nothing lies inside
        F.coalesce(low, F.lit(math.inf)).alias("low"),
        F.coalesce(high, F.lit(-math.inf)).alias("high"),
    )
    return stage(wanted, "ranks")


def _runs(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (code, value) pairs and how often each occurs."""
    order = np.lexsort((values, codes))
    codes, values = codes[order], values[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return codes[at], values[at], np.diff(np.append(at, len(codes)))


def _extract(columns: int, probs: int, schema: pa.Schema, bounds: tuple[list[float], list[float]] | None):
    """Rows (grp, cell, value, n) of the values inside brackets; a null value counts those under one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            classes = batch.column("grp").dictionary_encode(null_encoding="encode")
            codes = classes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            if bounds is None:
                low, high = (
                    batch.column(side).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    for side in ("low", "high")
                )
            else:
                low, high = (np.asarray(side)[None, :] for side in bounds)
            out_codes, out_cells, out_values, out_n = [], [], [], []
            for i in range(columns):
                x = batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float)
                for cell in range(i * probs, (i + 1) * probs):
                    # NaN, which stands for null here, is neither under nor inside
                    under = codes[x < low[:, cell]]
                    inside = (x >= low[:, cell]) & (x <= high[:, cell])
                    code, value, n = _runs(codes[inside], x[inside])
                    below = np.bincount(under, minlength=len(classes.dictionary))
                    some = np.flatnonzero(below)
                    out_codes += [code, some]
                    out_values += [value, np.full(len(some), np.nan)]
                    out_n += [n, below[some]]
                    out_cells.append(np.full(len(code) + len(some), cell))
            values = np.concatenate(out_values)
            yield pa.RecordBatch.from_arrays(
                [
                    classes.dictionary.take(pa.array(np.concatenate(out_codes))).cast(schema.field("grp").type),
                    pa.array(np.concatenate(out_cells), pa.int32()),
                    pa.array(values, pa.float64(), mask=np.isnan(values)),
                    pa.array(np.concatenate(out_n), pa.int64()),
                ],
                schema=schema,
            )

    return run


def _store(values: DataFrame, wanted: DataFrame, columns: int, probs: int, by: bool) -> DataFrame:
    """The bracket store, written once: (grp, cell, value, n) with distinct values."""
    bounds = None
    if by:
        # one row for each class, as many entries as cells
        sides = wanted.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("cell", "low", "high"))).alias("_b"))
        sides = sides.select(F.col("grp").alias("_of"), F.col("_b.low").alias("low"), F.col("_b.high").alias("high"))
        values = values.join(sides, F.col("grp").eqNullSafe(F.col("_of"))).drop("_of")
    else:
        rows = wanted.orderBy("cell").select("low", "high").collect()  # one for each column and probability
        bounds = [r["low"] for r in rows], [r["high"] for r in rows]
    schema = T.StructType(
        [
            T.StructField("grp", values.schema["grp"].dataType),
            T.StructField("cell", T.IntegerType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("n", T.LongType()),
        ]
    )
    run = _extract(columns, probs, to_arrow_schema(schema), bounds)
    found = values.mapInArrow(run, schema)
    return stage(found.groupBy(*KEY, "value").agg(F.sum("n").alias("n")), "brackets")


def _same_cell(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by class and cell; null is a class like any other."""
    right = right.withColumnsRenamed({"grp": "_grp", "cell": "_cell"})
    on = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("cell") == F.col("_cell"))
    return left.join(right, on, how).drop("_grp", "_cell")


def _narrower(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """Keep of each cell the parts between sketched cut points that hold its ranks."""
    inside = store.filter("value is not null")
    cuts = sketch_quantiles(inside, KEY, "value", PROBS).select(*KEY, F.array_distinct("cuts").alias("cuts"))
    # a part starts at a cut point; the first one takes what lies under all of them
    part = F.greatest(F.size(F.filter("cuts", lambda c: c <= F.col("value"))), F.lit(1))
    placed = _same_cell(inside, cuts).select(*KEY, "value", "n", part.alias("part_no"))
    below = store.filter("value is null").select(*KEY, F.lit(None).cast("double").alias("value"), "n", F.lit(0).alias("part_no"))
    parts = placed.unionByName(below).groupBy(*KEY, "part_no").agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    # at most GRID + 2 rows in each cell
    upto = F.sum("n").over(Window.partitionBy(*KEY).orderBy("part_no"))
    parts = _same_cell(parts.withColumn("upto", upto), wanted.select(*KEY, "lower", "upper"))
    kept = (
        parts.filter("part_no > 0 and upto > lower and upto - n <= upper")
        .groupBy(*KEY)
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min(F.col("upto") - F.col("n")).alias("under"))
    )
    left = _same_cell(inside, kept).filter(F.col("value").between(F.col("low"), F.col("high")))
    under = kept.filter("under > 0").select(
        *KEY, F.lit(None).cast("double").alias("value"), F.col("under").alias("n")
    )
    return stage(left.select(*KEY, "value", "n").unionByName(under), "brackets")


def exact_quantiles(
    df: DataFrame,
    names: Iterable[str],
    probs: Iterable[float],
    by: str | None = None,
    *,
    rank_at_most: int = 200_000,
) -> DataFrame:
    """Interpolated quantiles as rows (grp, column, prob, value).

    ``by`` is a class label.  ``rank_at_most`` bounds how many distinct values
    of one bracket are ranked in one task.
    """
    names, probs = list(names), [float(p) for p in probs]
    values = wide_values(df, names, by)
    sketches = sketch_columns(values, ["grp"], [f"x{i}" for i in range(len(names))], PROBS)
    margin = MARGIN
    while True:
        wanted = _wanted(sketches, names, probs, margin)
        store = _store(values, wanted, len(names), len(probs), by is not None)
        sizes = store.groupBy(*KEY).agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("under"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("inside"),
            F.count("value").alias("distinct"),
        )
        under, inside = F.coalesce("under", F.lit(0)), F.coalesce("inside", F.lit(0))
        state = (
            _same_cell(wanted.filter("lower is not null"), sizes, "left")
            .agg(
                F.count_if((F.col("lower") < under) | (F.col("upper") >= under + inside)).alias("missed"),
                F.max("distinct").alias("largest"),
            )
            .first()
        )
        if not state["missed"]:
            break
        margin *= 4  # ends at the whole range

    largest = state["largest"] or 0
    while largest > max(rank_at_most, 2):
        store = _narrower(store, wanted)
        largest = store.filter("value is not null").groupBy(*KEY).count().agg(F.max("count")).first()[0]

    # values under the bracket come first, as null does in ascending order
    upto = F.sum("n").over(Window.partitionBy(*KEY).orderBy(F.asc_nulls_first("value")))
    ranked = _same_cell(wanted, store.withColumn("upto", upto), "left")

    def holds(rank: str) -> Column:
        hit = F.col("value").isNotNull() & (F.col(rank) < F.col("upto")) & (F.col(rank) >= F.col("upto") - F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    a, b, part = F.col("a"), F.col("b"), F.col("part")
    between = F.when((a == b) | (part == 0), a).otherwise(a * (1 - part) + b * part)
    return (
        ranked.groupBy("grp", "column", "prob", "part")
        .agg(holds("lower").alias("a"), holds("upper").alias("b"))
        .select("grp", "column", "prob", F.when(~F.isnan(between), between).alias("value"))
    )
