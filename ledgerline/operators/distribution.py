"""The tables behind box plots, histograms, density curves and scatter grids."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.functions.typing import column
from ledgerline.operators.missing import ROW, attach_row
from ledgerline.operators.quantiles import exact_quantiles, long_values, wide_values

KDE_GRID = 200
KDE_CUT = 3.0
GRID_FIELDS = ("start", "step", "width", "total")
KEPT_CURVES = 2_000  # curves a task holds before it hands its sums on
WHISKER = 1.5
BOX = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def zscore_outlier_count(
    df: DataFrame, names: Iterable[str], limit: float = 3.0, nan_policy: str = "propagate"
) -> DataFrame:
    """Rows with abs(z) above ``limit`` per column, population spread, counts above 0 only.

    ``nan_policy="propagate"`` gives a column that holds any null or NaN no outliers;
    ``"omit"`` leaves its nulls and NaN out.  A column with an infinite value has no
    spread and no outliers.
    """
    names = list(names)
    stats: dict[str, Column] = {}

    def value(c: str) -> Column:
        return F.when(~F.isnan(column(c)), column(c))

    for c in names:
        stats[f"mean {c}"] = F.avg(value(c))
        stats[f"std {c}"] = F.stddev_pop(value(c))
        stats[f"nulls {c}"] = F.count_if(value(c).isNull())
    df, row = attach_row(df, stats)

    def far(c: str) -> Column:
        z = F.try_divide(value(c) - row[f"mean {c}"], row[f"std {c}"])
        whole = (row[f"nulls {c}"] == 0) if nan_policy == "propagate" else F.lit(True)
        # NaN is above every number in Spark's order
        return F.count_if((F.abs(z) > limit) & ~F.isnan(z) & whole)

    counts = df.agg(*[far(c).alias(f"n{i}") for i, c in enumerate(names)])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_outliers")) for i, c in enumerate(names)]
    return counts.select(F.inline(F.array(*entries))).filter("n_outliers > 0")


def box_stats(df: DataFrame, names: Iterable[str], by: str | None = None, **limits: int) -> DataFrame:
    """q1, median, q3, whiskers (extreme values inside 1.5 IQR) and outlier count.

    Nulls and NaN are no values, infinite ones are; equal quartiles reach no
    further.  A column without values has nulls and no outliers.
    """
    names = list(names)
    found = exact_quantiles(df, names, list(BOX.values()), by, **limits)
    values = wide_values(df, names, by)
    cells = [(c, q) for c in names for q in BOX]
    if by:
        place = F.array_position(F.array(*[F.lit(c) for c in names]), F.col("column"))
        listed = F.array_sort(F.collect_list(F.struct(place.alias("place"), "prob", "value")))
        # one row for each class
        fences = found.groupBy(F.col("grp").alias("_of")).agg(listed.alias("_f")).select("_of", F.col("_f.value").alias("_f"))
        values = values.join(fences, F.col("grp").eqNullSafe(F.col("_of")))
        fence = {cell: F.col("_f")[k] for k, cell in enumerate(cells)}
    else:
        known = {(r["column"], r["prob"]): r["value"] for r in found.collect()}  # three numbers for each column
        fence = {(c, q): F.lit(known.get((c, BOX[q]))).cast("double") for c, q in cells}
    sums = [F.first("_f").alias("_f")] if by else []
    for i, c in enumerate(names):
        x, q1, q3 = F.col(f"x{i}"), fence[c, "q1"], fence[c, "q3"]
        reach = F.when(q1 == q3, 0.0).otherwise(WHISKER * (q3 - q1))
        inside = x.between(q1 - reach, q3 + reach)
        sums += [
            F.min(F.when(inside, x)).alias(f"low_{i}"),
            F.max(F.when(inside, x)).alias(f"high_{i}"),
            F.count_if(~inside).alias(f"out_{i}"),
        ]
    boxes = [
        F.struct(
            F.lit(c).alias("column"),
            *[fence[c, q].alias(q) for q in BOX],
            F.col(f"low_{i}").alias("whisker_low"),
            F.col(f"high_{i}").alias("whisker_high"),
            F.col(f"out_{i}").alias("n_outliers"),
        )
        for i, c in enumerate(names)
    ]
    table = values.groupBy("grp").agg(*sums).select("grp", F.inline(F.array(*boxes)))
    return table.withColumnRenamed("grp", by) if by else table.drop("grp")


def _finite(c: str) -> Column:
    """The values of a column as double; null for NaN and infinite ones."""
    value = column(c).cast("double")
    return F.when(F.abs(value) < math.inf, value)


def _bounds(values: DataFrame) -> DataFrame:
    """Range of each column; a constant column gets a range of width 1 round its value."""
    low, high = F.min("value"), F.max("value")
    return values.groupBy("column").agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("low"),
        F.when(low == high, high + 0.5).otherwise(high).alias("high"),
    )


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1, null for null; the last bin is closed on both sides."""
    at = F.floor((value - low) / (high - low) * bins)
    return F.when(at < bins, at).when(at >= bins, bins - 1).cast("int")


def histogram(df: DataFrame, names: Iterable[str], bins: int = 10) -> DataFrame:
    """Counts per equal-width bin, empty bins included."""
    values = long_values(df, names).filter(F.abs("value") < math.inf)
    bounds = _bounds(values)
    counts = (
        values.join(F.broadcast(bounds), "column")  # one row per column
        .groupBy("column", _bin(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = bounds.select("column", "low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("high") - F.col("low")) / bins
    return grid.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _kernel_sums(columns: int, points: int, schema: pa.Schema, fixed: dict[str, list] | None):
    """Each task's density on the grid of every class and column, as one vector for each.

    ``fixed`` holds start, step, width and total by column where there are no
    classes; else every row carries those of its class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}

        def block() -> pa.RecordBatch:
            keys = list(sums)
            lines = [sums[k] for k in keys]
            arrays = [[k[0] for k in keys], [k[1] for k in keys], [x for x, _ in lines], [h for _, h in lines]]
            return pa.RecordBatch.from_arrays(
                [pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema
            )

        for batch in batches:
            classes = batch.column("grp").dictionary_encode(null_encoding="encode")
            codes = classes.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            ends = np.searchsorted(codes[order], np.arange(len(classes.dictionary) + 1))
            data = [batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(columns)]
            for code, grp in enumerate(classes.dictionary.to_pylist()):
                rows = order[ends[code] : ends[code + 1]]
                grid = fixed or {name: batch.column(name)[int(rows[0])].as_py() for name in GRID_FIELDS}
                for i in range(columns):
                    start, step, width, total = (grid[name][i] for name in GRID_FIELDS)
                    if not width or width != width:
                        continue
                    x = data[i][rows]
                    value, n = np.unique(x[~np.isnan(x)], return_counts=True)
                    at = start + np.arange(points) * step
                    height = np.exp(-0.5 * ((at[:, None] - value[None, :]) / width) ** 2) @ n
                    height /= total * width * math.sqrt(2 * math.pi)
                    known = sums.get((grp, i))
                    sums[grp, i] = (at, height if known is None else known[1] + height)
            if len(sums) > KEPT_CURVES:
                yield block()
                sums.clear()
        if sums:
            yield block()

    return run


def kde_grid(
    df: DataFrame,
    names: Iterable[str],
    points: int = KDE_GRID,
    cut: float = KDE_CUT,
    by: str | None = None,
) -> DataFrame:
    """Gaussian density curve with Scott bandwidth on an even grid.

    Each task adds up the kernels of its rows as one vector for each class and
    column; only those vectors are shuffled.  Values that are not finite are
    left out; a column without spread has no curve.
    """
    names = list(names)
    grp = column(by) if by else F.lit(0)
    values = df.select(grp.alias("grp"), *[_finite(c).alias(f"x{i}") for i, c in enumerate(names)])
    shapes: dict[str, list[Column]] = {name: [] for name in GRID_FIELDS}
    for i in range(len(names)):
        x = F.col(f"x{i}")
        total, low, high = F.count(x).cast("double"), F.min(x), F.max(x)
        width = F.stddev_samp(x) * F.pow(F.nullif(total, F.lit(0.0)), F.lit(-0.2))
        shapes["start"].append(low - cut * width)
        shapes["step"].append((high - low + 2 * cut * width) / (points - 1))
        shapes["width"].append(width)
        shapes["total"].append(total)
    arrays = [F.array(*cells).alias(name) for name, cells in shapes.items()]
    fixed = None
    if by:
        grids = values.groupBy(F.col("grp").alias("_of")).agg(*arrays)  # one row for each class
        values = values.join(grids, F.col("grp").eqNullSafe(F.col("_of"))).drop("_of")
    else:
        fixed = values.agg(*arrays).first().asDict()  # four numbers for each column
    schema = T.StructType(
        [
            T.StructField("grp", values.schema["grp"].dataType),
            T.StructField("cell", T.IntegerType()),
            T.StructField("x", T.ArrayType(T.DoubleType())),
            T.StructField("density", T.ArrayType(T.DoubleType())),
        ]
    )
    blocks = values.mapInArrow(_kernel_sums(len(names), points, to_arrow_schema(schema), fixed), schema)
    curve = (
        blocks.select("grp", "cell", F.posexplode(F.arrays_zip("x", "density")).alias("point", "at"))
        .groupBy("grp", "cell", "point")
        .agg(F.min("at.x").alias("x"), F.sum("at.density").alias("density"))
        .select("grp", F.array(*[F.lit(c) for c in names])[F.col("cell")].alias("column"), "point", "x", "density")
    )
    return curve.withColumnRenamed("grp", by) if by else curve.drop("grp")


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` over rows where both are present."""
    a, b = column(y), column(x)
    return df.agg(
        F.regr_count(a, b).alias("n"),
        F.regr_slope(a, b).alias("slope"),
        F.regr_intercept(a, b).alias("intercept"),
        F.regr_r2(a, b).alias("r2"),
    )


def _with_bins(df: DataFrame, names: list[str], bins: int) -> tuple[DataFrame, dict[str, Column]]:
    stats: dict[str, Column] = {}
    for c in names:
        stats[f"low {c}"], stats[f"high {c}"] = F.min(_finite(c)), F.max(_finite(c))
    df, row = attach_row(df, stats)
    cells = {}
    for c in names:
        low, high = row[f"low {c}"], row[f"high {c}"]
        flat = low == high
        cells[c] = _bin(
            _finite(c),
            F.when(flat, low - 0.5).otherwise(low),
            F.when(flat, high + 0.5).otherwise(high),
            bins,
        )
    return df.select("*", *[cell.alias(f"bin {c}") for c, cell in cells.items()]).drop(ROW), {
        c: column(f"bin {c}") for c in names
    }


def _pair_counts(names: list[str], bins: int, schema: pa.Schema):
    """Each task's counts on the grid of every pair, as rows of the filled cells."""
    pairs = list(combinations(range(len(names)), 2))
    size = bins * bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(pairs), size), np.int64)
        for batch in batches:
            # a bin that is null is counted in no cell
            cells = [np.nan_to_num(c.to_numpy(zero_copy_only=False).astype(float), nan=-1).astype(np.int64) for c in batch.columns]
            for line, (a, b) in zip(counts, pairs, strict=True):
                both = (cells[a] >= 0) & (cells[b] >= 0)
                line += np.bincount(cells[a][both] * bins + cells[b][both], minlength=size)
        pair, cell = np.nonzero(counts)
        first, second = np.array(pairs, np.int64).reshape(-1, 2).T
        label = pa.array(names, pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                label.take(pa.array(first[pair])),
                label.take(pa.array(second[pair])),
                pa.array(cell // bins, pa.int32()),
                pa.array(cell % bins, pa.int32()),
                pa.array(counts[pair, cell], pa.int64()),
            ],
            schema=schema,
        )

    return run


def pair_scatter(df: DataFrame, names: Iterable[str], bins: int = 10) -> DataFrame:
    """Counts on a bins x bins grid for every pair of columns (rows without two finite values left out).

    Each task counts its rows on all grids at once; only the filled cells are shuffled.
    """
    names = list(names)
    df, cell = _with_bins(df, names, bins)
    schema = T.StructType.fromDDL("column_x string, column_y string, bin_x int, bin_y int, n bigint")
    placed = df.select(*[cell[c].alias(f"b{i}") for i, c in enumerate(names)])
    blocks = placed.mapInArrow(_pair_counts(names, bins, to_arrow_schema(schema)), schema)
    return blocks.groupBy("column_x", "column_y", "bin_x", "bin_y").agg(F.sum("n").alias("n"))


def hexbin_counts(df: DataFrame, x: str, y: str, gridsize: int = 20, by: str | None = None) -> DataFrame:
    """Counts per hexagon: the nearer centre of two shifted rectangular lattices.

    A constant column gets a range of width 1 round its value.
    """
    rows = int(gridsize / math.sqrt(3))
    keep = [column(by)] if by else []
    df = df.filter(_finite(x).isNotNull() & _finite(y).isNotNull())
    ends = {f"{side} {c}": f(column(c)) for c in (x, y) for side, f in (("low", F.min), ("high", F.max))}
    df, box = attach_row(df, ends)

    def share(c: str) -> Column:
        low, high = box[f"low {c}"], box[f"high {c}"]
        return F.when(low == high, 0.5).otherwise(F.try_divide(column(c) - low, high - low))

    placed = df.select(*keep, (share(x) * gridsize).alias("px"), (share(y) * rows).alias("py"))
    px, py = F.col("px"), F.col("py")
    near_x, near_y = F.floor(px + 0.5), F.floor(py + 0.5)
    cell_x, cell_y = F.floor(px), F.floor(py)
    to_corner = (px - near_x) * (px - near_x) + 3 * (py - near_y) * (py - near_y)
    to_middle = (px - cell_x - 0.5) * (px - cell_x - 0.5) + 3 * (py - cell_y - 0.5) * (py - cell_y - 0.5)
    corner = to_corner < to_middle
    centre = placed.select(
        *keep,
        F.when(corner, near_x.cast("double")).otherwise(cell_x + 0.5).alias("hex_x"),
        F.when(corner, near_y.cast("double")).otherwise(cell_y + 0.5).alias("hex_y"),
    )
    return centre.groupBy(*keep, "hex_x", "hex_y").agg(F.count(F.lit(1)).alias("n"))


def chi_square_select(
    df: DataFrame, names: Iterable[str], label: str, top: int = 5, bins: int = 10
) -> DataFrame:
    """Pearson chi-square of each binned feature against the label; the ``top`` strongest."""
    names = list(names)
    df, cell = _with_bins(df, names, bins)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), cell[c].alias("bin")) for c in names])
    counts = (
        df.select(column(label).alias("label"), F.inline(cells))
        .filter("bin is not null and label is not null")
        .groupBy("feature", "bin", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # from here on there are at most features x bins x labels rows
    def total(*key: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*key))

    sums = counts.select(
        "*",
        total("feature", "bin").alias("row_n"),
        total("feature", "label").alias("col_n"),
        total("feature").alias("total"),
    )
    phi = F.sum(F.col("n") / F.col("row_n") * (F.col("n") / F.col("col_n")))
    dof = (F.count_distinct("bin") - 1) * (F.count_distinct("label") - 1)
    return (
        sums.groupBy("feature")
        .agg((F.max("total") * (phi - 1)).alias("statistic"), dof.alias("dof"))
        .orderBy(F.desc("statistic"), "feature")
        .limit(top)
    )
