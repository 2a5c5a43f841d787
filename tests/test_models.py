"""Invariants of fits, grids and synthetic rows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.operators import evaluate, kernels, models, prepare, split, synth


@pytest.fixture(scope="module")
def data(medium):
    return models.prepared(medium)


def test_split_parts_are_scaled_and_disjoint(data, medium):
    assert data.count() == medium.count()
    assert {r["split"] for r in data.select("split").distinct().collect()} == {"train", "test"}


@pytest.mark.parametrize("name", models.MODELS)
def test_models_beat_the_majority(data, name):
    rows = models.fit_and_score(name, data).cache()
    assert rows.count() == data.count()
    share = rows.agg(F.avg("label")).first()[0]
    accuracy = evaluate.class_metrics(rows).first()["accuracy"]
    assert accuracy > max(share, 1 - share)
    area = evaluate.auc_roc(rows).first()[0]
    assert 0.5 < area <= 1.0
    if name != "linear_svm":
        assert rows.filter("probability < 0 or probability > 1").count() == 0
    rows.unpersist()


def test_exact_area_equals_the_library(data):
    model = models.fit("logistic_regression", data)
    library = BinaryClassificationEvaluator(labelCol=S.LABEL, numBins=0).evaluate(model.transform(data))
    assert evaluate.auc_roc(models.scored(model, data)).first()[0] == pytest.approx(library)


def test_same_seed_same_forest(data):
    first, second = (models.fit("random_forest", data).toDebugString.split("\n", 1)[1] for _ in range(2))
    assert first == second


def test_naive_bayes_table_equals_the_fit(data, medium):
    scaled = prepare.standardize_columns(medium, S.FEATURES, ddof=1)
    table = models.naive_bayes_params(scaled, S.FEATURES).collect()
    from pyspark.ml.classification import NaiveBayes

    everything = NaiveBayes(modelType="gaussian", featuresCol="scaled_features", labelCol=S.LABEL).fit(data)
    theta, sigma, prior = everything.theta.toArray(), everything.sigma.toArray(), np.exp(everything.pi.toArray())
    for r in table:
        i = S.FEATURES.index(r["feature"])
        assert r["mean"] == pytest.approx(theta[r["class"], i], abs=1e-6)
        assert r["variance"] == pytest.approx(sigma[r["class"], i], rel=1e-5)
        assert r["prior"] == pytest.approx(prior[r["class"]], rel=1e-6)


def test_holdout_refit_differs_only_in_the_model(data):
    plain, compat = models.holdout_scored(data), models.holdout_scored(data, compat=True)
    assert plain.count() == compat.count() == models.part(data, "test").count()


def test_customer_table_keeps_probability_or_label(data):
    assert models.customer_table(data).filter("probability between 0 and 1").count() > 0
    labels = {r[0] for r in models.customer_table(data, compat=True).select("probability").distinct().collect()}
    assert labels <= {0.0, 1.0}


def test_decimals_are_the_columns_own(spark):
    rows = [(1 / 3, 1e-9, 2.5, 7.0, None), (0.5, 3e-9, 0.25, 1e6, None), (0.1, 2e-9, None, -3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = {r["column"]: r["decimals"] for r in synth.metadata(df, df.columns).collect()}
    assert got == {"a": None, "b": 9, "c": 2, "d": 0, "e": None}
    copula = synth.fit(df, ["a", "b"])
    drawn = synth.sample(spark, copula, 200).toPandas()
    assert [m.decimals for m in copula.marginals] == [None, 9]
    assert (drawn["a"].round(6) != drawn["a"]).mean() > 0.9
    assert set(drawn["b"].round(12)) <= {1e-9, 2e-9, 3e-9} and drawn["b"].nunique() > 1


def test_pipeline_scales_on_train_rows_only(medium):
    rows = split.split_hash(medium)
    train = models.part(rows, "train")
    fitted = prepare.pipeline(S.FEATURES, models.estimators()["naive_bayes"]).fit(train)
    mean = train.agg(F.avg("revenue")).first()[0]
    assert fitted.stages[1].mean[S.FEATURES.index("revenue")] == pytest.approx(mean)


def test_synthetic_rows_keep_range_and_dependence(spark, medium):
    names = ["revenue", "current_assets", "CR_Rating_score", S.LABEL]
    copula = synth.fit(medium, names)
    drawn = synth.sample(spark, copula, 4000, seed=1)
    again = synth.sample(spark, copula, 4000, seed=1).repartition(3)
    assert drawn.exceptAll(again).count() == 0
    for m in copula.marginals:
        low, high = drawn.agg(F.min(m.name), F.max(m.name)).first()
        assert m.low <= low <= high <= m.high
        real, fake = (f.agg(F.avg(m.name), F.stddev(m.name)).first() for f in (medium, drawn))
        assert fake[0] == pytest.approx(real[0], abs=0.2 * real[1])
    # rounding to two or four values weakens a correlation, so only its sign is compared there
    again = synth.fit(drawn, names).correlation
    assert again[0, 1] == pytest.approx(copula.correlation[0, 1], abs=0.05)
    assert again[2, 3] > 0 and copula.correlation[2, 3] > 0


def test_comparison_covers_models_and_splits(data):
    table = models.compare(data, ["naive_bayes", "decision_tree"]).collect()
    assert len(table) == 2 * 2 * 6
    assert all(0 <= r["value"] <= 1 for r in table)
