"""Model selection: cross-validated grids that end in a tuned model and its reports.

All folds read one written table.  One aggregate by fold and class has the number, means and
variances of every feature; what a fold's model needs of the other folds is merged from
those few rows, so no fold is scaled by a pass of its own and no copy of the table is made.
Gaussian naive Bayes is nothing but such rows and is never fitted at all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.functions.typing import column
from ledgerline.operators import hinge, kernels
from ledgerline.operators.evaluate import class_metrics, classification_report, confusion_matrix
from ledgerline.operators.prepare import assemble_features
from ledgerline.operators.split import cv_folds, split_hash
from ledgerline.sources.staging import stage

# --- fixed values: grid, folds and stopping rules of the tuned models -----------------------------------
C_GRID = [0.001, 0.01, 0.1, 1, 10]
FOLDS = 5
LOGREG_LIMITS = {"maxIter": 1000, "tol": 1e-4}
SVM_TOLERANCE = 1e-3
CACHED = 1 << 28  # bytes of mapped train rows up to which the library fits the tuned SVM, as it caches them
SMOOTHING = 1e-9  # of the largest feature variance, added to every variance

FeatureMap = Callable[[DataFrame], Transformer]


def folded(
    df: DataFrame, features: Sequence[str] = S.FEATURES, label: str = S.LABEL, train: float = 0.7
) -> DataFrame:
    """All rows with their unscaled vector and split; train rows have a fold, test rows a null."""
    rows = split_hash(assemble_features(df, features), train)
    narrow = rows.select(column(S.KEY), column(label), "features", "split")
    dealt = cv_folds(narrow.filter("split = 'train'"), label, FOLDS)
    test = narrow.filter("split = 'test'").withColumn("fold", F.lit(None).cast("int"))
    return stage(dealt.unionByName(test), "folded")


# --- statistics that add up -----------------------------------------------------------------
@dataclass
class Moments:
    """Rows for each fold and class: number, and means and population variances of the features."""

    folds: np.ndarray
    classes: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    variance: np.ndarray

    def merged(self, keep: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Number, mean and sum of squared distances from it over the rows ``keep`` picks."""
        n, mean = self.n[keep][:, None], self.mean[keep]
        total = n.sum()
        centre = (n * mean).sum(0) / total
        return float(total), centre, (n * (self.variance[keep] + (mean - centre) ** 2)).sum(0)

    def scale(self, left_out: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Mean and sample spread of the train rows, without those of one fold."""
        n, mean, squares = self.merged(self.folds != (-1 if left_out is None else left_out))
        return mean, np.sqrt(squares / max(n - 1, 1))


def fold_moments(data: DataFrame, label: str = S.LABEL) -> Moments:
    """One aggregate over the train rows; a row for each fold and class reaches the driver."""
    values = vector_to_array("features")
    width = len(data.select("features").head()[0])
    each = lambda what: F.array(*[what(values[i]) for i in range(width)])
    rows = (
        data.filter(F.col("fold").isNotNull())
        .groupBy("fold", column(label).cast("int").alias("class"))
        .agg(F.count(F.lit(1)).alias("n"), each(F.avg).alias("mean"), each(F.var_pop).alias("variance"))
        .collect()
    )
    rows.sort(key=lambda r: (r["fold"], r["class"]))
    return Moments(*[np.array([r[c] for r in rows]) for c in ("fold", "class", "n", "mean", "variance")])


def scaled(data: DataFrame, mean: np.ndarray, spread: np.ndarray) -> DataFrame:
    """``scaled_features``: centred by ``mean`` and divided by ``spread``, 0 for columns without any."""
    inverse = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
    centred = F.zip_with(vector_to_array("features"), F.array(*map(F.lit, mean.tolist())), lambda x, m: x - m)
    values = F.zip_with(centred, F.array(*map(F.lit, inverse.tolist())), lambda x, s: x * s)
    return data.withColumn("scaled_features", array_to_vector(values))


# --- grids of fitted models --------------------------------------------------------------------
def _fold_accuracies(
    data: DataFrame, moments: Moments, classifier, grid: Sequence[Mapping], label: str, fold: int, mapped: FeatureMap | None
) -> list[float]:
    """Accuracy on one fold for each grid point, all models scored in one pass."""
    ready = scaled(data.filter(F.col("fold").isNotNull()), *moments.scale(fold))
    if mapped is not None:
        ready = mapped(ready.filter(F.col("fold") != fold)).transform(ready)
    ready = ready.select(column(label), "fold", classifier.getFeaturesCol())
    train, held_out = ready.filter(F.col("fold") != fold), ready.filter(F.col("fold") == fold)
    hits = []
    for i, params in enumerate(grid):
        model = classifier.fit(train, params)
        model.setPredictionCol(f"prediction_{i}")
        held_out = model.transform(held_out).select(*map(column, held_out.columns), f"prediction_{i}")
        hits.append(F.avg((F.col(f"prediction_{i}") == column(label)).cast("double")))
    return list(held_out.agg(*hits).first())


def cross_validate(
    data: DataFrame, classifier, grid: Sequence[Mapping], label: str = S.LABEL, mapped: FeatureMap | None = None
) -> list[float]:
    """Mean accuracy over the folds for each grid point; folds run side by side.

    ``mapped`` makes a feature map from the scaled rows of the other folds.
    """
    moments = fold_moments(data, label)
    with ThreadPoolExecutor(FOLDS) as pool:
        work = inheritable_thread_target(data.sparkSession)(
            lambda fold: _fold_accuracies(data, moments, classifier, grid, label, fold, mapped)
        )
        by_fold = list(pool.map(work, range(FOLDS)))
    return [sum(scores) / FOLDS for scores in zip(*by_fold, strict=True)]


def _penalties(data: DataFrame, values: Sequence[float]) -> dict[float, float]:
    """regParam for each C: one over C times the rows a fold is fitted on."""
    fitted_on = data.filter(F.col("fold").isNotNull()).count() * (FOLDS - 1) / FOLDS
    return {c: 1.0 / (c * fitted_on) for c in values}


def _ranked(spark, rows: list[tuple], schema: str) -> DataFrame:
    best = max(row[-1] for row in rows)
    table = spark.createDataFrame(rows, schema + ", accuracy double")
    return table.withColumn("is_best", F.col("accuracy") == F.lit(best))


def _logreg(label: str) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="scaled_features", labelCol=label, elasticNetParam=0.0, standardization=False, **LOGREG_LIMITS
    )


def _svm(kernel: str, label: str) -> LinearSVC:
    source = "scaled_features" if kernel == "linear" else "mapped_features"
    return LinearSVC(featuresCol=source, labelCol=label, standardization=False, tol=SVM_TOLERANCE)


def feature_map(kernel: str, width: int | None = None, landmarks: int = 64) -> FeatureMap | None:
    """Maker of a kernel's feature map from scaled train rows; None for the linear kernel."""
    if kernel == "linear":
        return None

    def made(train: DataFrame) -> Transformer:
        features = len(train.select("scaled_features").head()[0])
        if kernel == "rbf":
            return kernels.KernelMap(function=kernels.rbf_map(features, width or kernels.rbf_width(features)))
        if kernel == "poly":
            return kernels.cubic(train.sparkSession, features)
        return kernels.SigmoidLandmarks(S.KEY, landmarks).fit(train)

    return made


def _inverse(spread: np.ndarray) -> np.ndarray:
    return np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)


def _scaled_map(mean: np.ndarray, spread: np.ndarray, mapped: Callable[[np.ndarray], np.ndarray]) -> hinge.Rows:
    """``scaled`` and a kernel's map in one, for blocks of raw rows."""
    inverse = _inverse(spread)
    return lambda x, kind=float: mapped(((x - mean) * inverse).astype(kind, copy=False))


def _cubic_folds(moments: Moments) -> kernels.CubicFolds | None:
    """One cubic map for all folds, unless a fold's scale is far from that of all train rows."""
    scales = [(mean, _inverse(spread)) for mean, spread in map(moments.scale, [None, *range(FOLDS)])]
    shared = kernels.CubicFolds(scales[0], dict(enumerate(scales[1:])))
    return shared if shared.alike() else None


def _fold_maps(
    data: DataFrame, moments: Moments, kernel: str, width: int | None, landmarks: int, folds: Sequence[int | None] = range(FOLDS)
) -> list[hinge.Rows]:
    """For each fold the map of raw rows that the other folds shape; for None the one that all do."""
    found, features = [], moments.mean.shape[1]
    shared = {"linear": lambda: lambda x: x, "poly": lambda: kernels.cubic_map(features),
              "rbf": lambda: kernels.rbf_map(features, width or kernels.rbf_width(features))}
    mapped = shared[kernel]() if kernel in shared else None
    for fold in folds:
        scale = moments.scale(fold)
        if kernel not in shared:
            others = scaled(data.filter(F.col("fold").isNotNull() & (F.col("fold") != (-1 if fold is None else fold))), *scale)
            mapped = feature_map(kernel, width, landmarks)(others).function
        found.append(_scaled_map(*scale, mapped))
    return found


def _spread(data: DataFrame, label: str) -> DataFrame:
    """Train rows in plain columns, written once in parts of like size, as every step works on all of them."""
    cores = data.sparkSession.sparkContext.defaultParallelism
    parts = -(-data.rdd.getNumPartitions() // cores) * cores
    columns = [column(S.KEY), column(label), "fold", vector_to_array("features").alias("features")]
    return stage(data.filter(F.col("fold").isNotNull()).select(*columns).repartition(parts, column(S.KEY)), "spread")


def gridsearch_logreg(data: DataFrame, values: Sequence[float] = C_GRID, label: str = S.LABEL) -> DataFrame:
    classifier = _logreg(label)
    penalties = _penalties(data, values)
    grid = ParamGridBuilder().addGrid(classifier.regParam, list(penalties.values())).build()
    found = cross_validate(data, classifier, grid, label)
    return _ranked(data.sparkSession, list(zip(map(float, penalties), found, strict=True)), "C double")


def gridsearch_svm(
    data: DataFrame,
    values: Sequence[float] = C_GRID,
    kernel_names: Sequence[str] = kernels.KERNELS,
    label: str = S.LABEL,
    width: int | None = None,
    landmarks: int = 64,
) -> DataFrame:
    """Cross-validated accuracy per kernel and C.

    The cubic kernel is exact.  ``width`` is the number of random features of the rbf map; None
    takes the least power of two whose kernel is off by at most ``kernels.RBF_ERROR`` on a
    fixed set of points.  ``landmarks`` is the number of train rows that shape the sigmoid
    map.  All rows are mapped, fitted and scored whatever the two are.  A kernel's models of all
    folds and C are fitted side by side (``hinge.accuracies``).
    """
    penalties = _penalties(data, values)
    moments, rows = fold_moments(data, label), _spread(data, label)

    def search(kernel: str) -> list[tuple]:
        maps = _fold_maps(data, moments, kernel, width, landmarks)
        size, shared = kernels.BLOCKS.get(kernel, hinge.BLOCK), _cubic_folds(moments) if kernel == "poly" else None
        found = hinge.accuracies(rows, maps, list(penalties.values()), label, SVM_TOLERANCE, size=size, shared=shared).mean(axis=0)
        return [(kernel, float(c), float(accuracy)) for c, accuracy in zip(penalties, found, strict=True)]

    with ThreadPoolExecutor(len(kernel_names)) as pool:
        searches = pool.map(inheritable_thread_target(data.sparkSession)(search), kernel_names)
        found = [row for some in searches for row in some]
    return _ranked(data.sparkSession, found, "kernel string, C double")


# --- Gaussian naive Bayes in closed form ----------------------------------------------------------
def _gaussians(moments: Moments, left_out: int | None) -> list[dict]:
    """Constant, means and weights of each class: log-likelihood = constant - sum(weight * (x - mean) ** 2).

    As a fit on standardised features has it: the floor of the variances is a share of the
    largest variance of a standardised column, which is 1 if any column varies.
    """
    keep = moments.folds != (-1 if left_out is None else left_out)
    n, _, squares = moments.merged(keep)
    spread = squares / max(n - 1, 1)
    used = spread > 0
    found = []
    for c in np.unique(moments.classes[keep]):
        n_c, mean, own = moments.merged(keep & (moments.classes == c))
        variance = own[used] / n_c / spread[used] + SMOOTHING
        weights = np.zeros(len(mean))
        weights[used] = 0.5 / variance / spread[used]
        constant = np.log(n_c / n) - 0.5 * np.log(2 * np.pi * variance).sum()
        found.append({"class": int(c), "constant": float(constant), "mean": mean.tolist(), "weight": weights.tolist()})
    return found


def naive_bayes_scored(data: DataFrame, label: str = S.LABEL, *, tuned: bool = False) -> DataFrame:
    """Every row with its predicted class, in one pass.

    Train rows are scored by the statistics of the other folds, or with ``tuned`` like test
    rows by those of all train rows.  Ties go to the smaller class.
    """
    moments = fold_moments(data, label)
    folds = [] if tuned else np.unique(moments.folds).tolist()
    models = [(f, _gaussians(moments, f)) for f in folds] + [(-1, _gaussians(moments, None))]
    schema = "for_fold int, classes array<struct<class: int, constant: double, mean: array<double>, weight: array<double>>>"
    table = data.sparkSession.createDataFrame(models, schema)
    mine = F.lit(-1) if tuned else F.coalesce("fold", F.lit(-1))

    def fit_of(c):
        far = F.zip_with(F.col("values"), c["mean"], lambda x, m: (x - m) * (x - m))
        parts = F.zip_with(far, c["weight"], lambda x, w: x * w)
        score = c["constant"] - F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
        return F.struct(score.alias("score"), (-c["class"]).alias("order"))

    # one row for each fold
    rows = data.withColumns({"values": vector_to_array("features"), "for_fold": mine}).join(F.broadcast(table), "for_fold")
    best = F.array_max(F.transform("classes", fit_of))
    return rows.select(
        column(S.KEY), "split", "fold", column(label).cast("int").alias("label"), (-best["order"]).alias("prediction")
    )


def gridsearch_nb(data: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Cross-validated accuracy: the grid has one point."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    by_fold = naive_bayes_scored(data, label).filter(F.col("fold").isNotNull()).groupBy("fold").agg(F.avg(hit).alias("hit"))
    return by_fold.agg(F.avg("hit").alias("accuracy")).select(F.lit("naive_bayes").alias("model"), "accuracy", F.lit(True).alias("is_best"))


# --- tuned models and their reports -----------------------------------------------------------------
def model_report(rows: DataFrame) -> DataFrame:
    """Long table (split, section, row, metric, value) of rows with split, label and prediction.

    Sections: ``accuracy``, the classification ``report``, and the ``confusion`` counts by
    actual (row) and predicted (metric) class.
    """
    rows = stage(rows.select("split", "label", "prediction"), "report")
    text = lambda x: F.lit(x).alias("section")
    accuracy = class_metrics(rows, ["split"]).select(
        "split", text("accuracy"), F.lit("all").alias("row"), F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")
    )
    lines = classification_report(rows, ["split"]).withColumn("support", F.col("support").cast("double"))
    report = lines.unpivot(["split", "row"], ["precision", "recall", "f1", "support"], "metric", "value")
    report = report.filter(F.col("value").isNotNull()).select("split", text("report"), "row", "metric", "value")
    counts = confusion_matrix(rows, ["split"]).select(
        "split", text("confusion"), F.col("actual").cast("string").alias("row"), F.col("predicted").cast("string").alias("metric"),
        F.col("n").cast("double").alias("value"),
    )
    return accuracy.unionByName(report).unionByName(counts)


def best_point(grid: DataFrame):
    """The first of the best rows of a grid (few rows): the smallest C of the first kernel in the alphabet."""
    names = [c for c in ("kernel", "C") if c in grid.columns]
    return grid.filter("is_best").orderBy(*names).first()


def refitted(data: DataFrame, classifier, c: float, label: str = S.LABEL, mapped: FeatureMap | None = None) -> DataFrame:
    """Train and test rows scored by a model of all train rows."""
    train = F.col("split") == "train"
    ready = scaled(data, *fold_moments(data, label).scale())
    if mapped is not None:
        ready = mapped(ready.filter(train)).transform(ready)
    rows = data.filter(train).count()
    model = classifier.copy({classifier.regParam: 1.0 / (c * rows)}).fit(ready.filter(train))
    return model.transform(ready).select(
        column(S.KEY), "split", column(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    )


def refitted_svm(
    data: DataFrame, kernel: str, c: float, label: str = S.LABEL, width: int | None = None, landmarks: int = 64
) -> DataFrame:
    """Train and test rows scored by an SVM of all train rows, which takes the same steps as those of the grid."""
    moments, rows = fold_moments(data, label), _spread(data, label)
    mapped = _fold_maps(data, moments, kernel, width, landmarks, [None])[0]
    size = kernels.BLOCKS.get(kernel, hinge.BLOCK)
    weights, shift = hinge.fits(rows, {-1: mapped}, [1.0 / (c * rows.count())], label, SVM_TOLERANCE, size=size)[-1]
    prediction = hinge.called(vector_to_array("features"), mapped, weights[:, 0], shift[0])
    return data.select(column(S.KEY), "split", column(label).cast("int").alias("label"), prediction.alias("prediction"))


def tuned_logreg(data: DataFrame, values: Sequence[float] = C_GRID, label: str = S.LABEL) -> DataFrame:
    """Report of the logistic regression with the best C, refitted on all train rows."""
    best = best_point(gridsearch_logreg(data, values, label))
    return model_report(refitted(data, _logreg(label), best["C"], label)).withColumn("C", F.lit(best["C"]))


def tuned_svm(
    data: DataFrame, values: Sequence[float] = C_GRID, kernel_names: Sequence[str] = kernels.KERNELS, label: str = S.LABEL
) -> DataFrame:
    """Report of the SVM with the best kernel and C, refitted on all train rows.

    Few rows are fitted by ``LinearSVC``.  More than it may cache take the steps of the grid, which keep no mapped rows.
    """
    best = best_point(gridsearch_svm(data, values, kernel_names, label))
    kernel, features = best["kernel"], len(data.select("features").head()[0])
    if 8 * data.filter("split = 'train'").count() * kernels.map_width(kernel, features) > CACHED:
        rows = refitted_svm(data, kernel, best["C"], label)
    else:
        rows = refitted(data, _svm(kernel, label), best["C"], label, feature_map(kernel))
    return model_report(rows).withColumns({"kernel": F.lit(best["kernel"]), "C": F.lit(best["C"])})


def tuned_nb(data: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Report of naive Bayes with the statistics of all train rows."""
    return model_report(naive_bayes_scored(data, label, tuned=True))
