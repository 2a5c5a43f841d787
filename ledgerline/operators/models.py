"""Classifiers on standardised features."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml.base import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.functions.typing import column
from ledgerline.operators.evaluate import auc_pr, auc_roc, class_metrics
from ledgerline.operators.prepare import assemble_features, standardize
from ledgerline.operators.split import split_hash
from ledgerline.sources.staging import stage

# --- fixed values: network of the tuned perceptron -------------------------------------------------------
HIDDEN_LAYERS = [100, 50]

MODELS = ("logistic_regression", "linear_svm", "naive_bayes", "random_forest", "decision_tree")


def estimators(label: str = S.LABEL) -> dict[str, object]:
    columns = {"featuresCol": "scaled_features", "labelCol": label}
    return {
        "logistic_regression": LogisticRegression(**columns),
        "linear_svm": LinearSVC(**columns),
        "naive_bayes": NaiveBayes(modelType="gaussian", **columns),
        "random_forest": RandomForestClassifier(seed=42, **columns),
        "decision_tree": DecisionTreeClassifier(seed=42, **columns),
    }


def prepared(
    df: DataFrame, features: Sequence[str] = S.FEATURES, label: str = S.LABEL, train: float = 0.7
) -> DataFrame:
    """Key, name, label, standardised vector and split, written once for the iterative fits."""
    _, scaled = standardize(assemble_features(df, features))
    keep = [c for c in ("customer_name",) if c in df.columns]
    columns = [column(c) for c in [S.KEY, *keep, label]]
    return stage(split_hash(scaled.select(*columns, "scaled_features"), train), "prepared")


def part(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def fit(name: str, data: DataFrame, label: str = S.LABEL) -> Model:
    return estimators(label)[name].fit(part(data, "train"))


def scored(model: Model, data: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Rows with label, prediction, score for ranking and (where given) probability of class 1."""
    result = model.transform(data)
    if "probability" in result.columns:
        probability = vector_to_array("probability")[1]
    else:
        probability = F.lit(None).cast("double")
    keep = [c for c in (S.KEY, "customer_name", "split") if c in data.columns]
    return result.select(
        *keep,
        column(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("rawPrediction")[1].alias("score"),
        probability.alias("probability"),
    )


def fit_and_score(name: str, data: DataFrame) -> DataFrame:
    return scored(fit(name, data), data)


def holdout_scored(data: DataFrame, *, compat: bool = False) -> DataFrame:
    """SVM on the test rows; ``compat`` refits it on those rows before scoring them."""
    test = part(data, "test")
    model = estimators()["linear_svm"].fit(test) if compat else fit("linear_svm", data)
    return scored(model, test)


def probability_table(data: DataFrame) -> DataFrame:
    """P(class 1) per test row, and P(default): class 0 is the default."""
    rows = fit_and_score("logistic_regression", data).filter("split = 'test'")
    return rows.select(
        S.KEY, "label", F.col("probability"), (1 - F.col("probability")).alias("p_default")
    )


def customer_table(data: DataFrame, *, compat: bool = False) -> DataFrame:
    """(customer_name, probability) of the test rows; ``compat`` puts the hard label there."""
    rows = fit_and_score("logistic_regression", data).filter("split = 'test'")
    value = F.col("prediction").cast("double") if compat else F.col("probability")
    return rows.select("customer_name", value.alias("probability"))


def coefficients(model, features: Sequence[str]) -> DataFrame:
    """Long table (class, feature, coefficient); the intercept is a row of its own."""
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = [
        (c, name, float(value))
        for c in range(matrix.shape[0])
        for name, value in [*zip(features, matrix[c], strict=True), ("intercept", intercepts[c])]
    ]
    spark = model.summary.predictions.sparkSession
    return spark.createDataFrame(rows, "class int, feature string, coefficient double")


def fit_multinomial(data: DataFrame, label: str, features_col: str = "scaled_features"):
    classifier = LogisticRegression(featuresCol=features_col, labelCol=label, family="multinomial")
    return classifier.fit(part(data, "train"))


def split_report(model, data: DataFrame, label: str) -> DataFrame:
    """(split, n, classes, accuracy, commonest): ``commonest`` is the share of the commonest class there."""
    called = model.transform(data).groupBy("split", column(label).alias("label"), "prediction").count()
    classes = called.groupBy("split", "label").agg(
        F.sum("count").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count"))), F.lit(0)).alias("hits"),
    )
    n = F.sum("rows")
    return classes.groupBy("split").agg(
        n.alias("n"),
        F.count("label").cast("int").alias("classes"),
        (F.sum("hits") / n).alias("accuracy"),
        (F.max("rows") / n).alias("commonest"),
    )


def naive_bayes_params(data: DataFrame, features: Sequence[str], label: str = S.LABEL) -> DataFrame:
    """Prior, mean and variance per class and feature, as a Gaussian fit learns them.

    ``data`` holds plain feature columns.  Variances get a floor of 1e-9 of the
    largest feature variance.
    """
    features = list(features)
    # one aggregate over the rows, unfolded when there is one row a class
    wide = data.groupBy(column(label).alias("class")).agg(
        F.count(F.lit(1)).alias("n"),
        *[f(column(c).cast("double")).alias(f"{p}{i}") for i, c in enumerate(features) for p, f in (("m", F.avg), ("s", F.var_pop))],
    )
    cells = F.array(*[F.struct(F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("spread")) for i in range(len(features))])
    stats = wide.select("class", "n", F.posexplode(cells).alias("at", "cell")).select("class", "n", "at", "cell.*")
    overall = data.agg(
        F.count(F.lit(1)).alias("total"),
        F.greatest(*[F.var_samp(column(c)) for c in features]).alias("largest"),
    )
    row = overall.select(F.struct("*")).scalar()
    label_of = F.array(*[F.lit(c) for c in features])
    return stats.withColumn("_all", row).select(
        "class",
        label_of[F.col("at")].alias("feature"),
        (F.col("n") / F.col("_all.total")).alias("prior"),
        "mean",
        (F.col("spread") + 1e-9 * F.col("_all.largest")).alias("variance"),
    )


# --- comparison -----------------------------------------------------------------------
def compare(data: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Long table (model, split, metric, value): every model on train and test rows."""
    names = list(names or MODELS)
    frames = [scored(fit(n, data), data).withColumn("model", F.lit(n)) for n in names]
    everything = frames[0]
    for frame in frames[1:]:
        everything = everything.unionByName(frame)
    rows = stage(everything.select("model", "split", "label", "prediction", "score"), "compared")
    by = ["model", "split"]
    # models x splits rows each
    wide = class_metrics(rows, by).join(auc_roc(rows, by), by).join(auc_pr(rows, by), by)
    metrics = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "auc_roc", "auc_pr"]
    return wide.unpivot(by, metrics, "metric", "value")


def timing(data: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Seconds to fit on the train rows and to score the test rows, with the work done."""
    rows = []
    for name in names or MODELS:
        start = time.perf_counter()
        model = fit(name, data)
        fitted = time.perf_counter()
        scored(model, part(data, "test")).write.format("noop").mode("overwrite").save()
        rows.append((name, fitted - start, time.perf_counter() - fitted))
    return data.sparkSession.createDataFrame(rows, "model string, fit_seconds double, score_seconds double")


def fit_perceptron(data: DataFrame, features: int, classes: int = 2, label: str = S.LABEL):
    """Feed-forward network with two hidden layers on standardised inputs."""
    network = MultilayerPerceptronClassifier(
        featuresCol="scaled_features", labelCol=label, layers=[features, *HIDDEN_LAYERS, classes], seed=42
    )
    return network.fit(part(data, "train"))
