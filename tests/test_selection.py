"""Grids, tuned models and their reports; merged sums; comparison of frames."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.operators import hinge, joins, kernels, models, prepare, selection, synth


@pytest.fixture(scope="module")
def folded(medium):
    return selection.folded(medium)


def test_test_rows_have_no_fold(folded, medium):
    assert folded.count() == medium.count()
    assert {(r["split"], r["fold"] is None) for r in folded.select("split", "fold").distinct().collect()} == {("train", False), ("test", True)}


@pytest.mark.parametrize("fold", [None, 0, 3])
def test_scaling_by_merged_statistics_is_that_of_a_fit(folded, fold):
    train = folded.filter(F.col("fold").isNotNull())
    if fold is not None:
        train = train.filter(F.col("fold") != fold)
    model = prepare.scaler().fit(train)
    mean, spread = selection.fold_moments(folded).scale(fold)
    assert np.allclose(mean, model.mean.toArray()) and np.allclose(spread, model.std.toArray())
    want = {r[S.KEY]: r["scaled_features"].toArray() for r in model.transform(folded).collect()}
    for r in selection.scaled(folded, mean, spread).collect():
        assert np.allclose(r["scaled_features"].toArray(), want[r[S.KEY]], atol=1e-9)


def test_closed_form_bayes_calls_what_fits_call(folded):
    called = {r[S.KEY]: r["prediction"] for r in selection.naive_bayes_scored(folded).collect()}
    tuned = {r[S.KEY]: r["prediction"] for r in selection.naive_bayes_scored(folded, tuned=True).collect()}
    train = folded.filter(F.col("fold").isNotNull())
    classifier = NaiveBayes(modelType="gaussian", featuresCol="scaled_features", labelCol=S.LABEL)
    for fold in (None, 0, 4):
        rest = train if fold is None else train.filter(F.col("fold") != fold)
        asked = folded.filter("split = 'test'") if fold is None else train.filter(F.col("fold") == fold)
        fitted = Pipeline(stages=[prepare.scaler(), classifier]).fit(rest)
        rows = fitted.transform(asked).select(S.KEY, "prediction").collect()
        assert rows and all(called[r[S.KEY]] == int(r["prediction"]) for r in rows)
        if fold is None:
            assert all(tuned[r[S.KEY]] == int(r["prediction"]) for r in rows)


def test_constant_column_and_missing_class_in_a_fold(spark):
    rows = [(i, int(i % 7 == 0), Vectors.dense(float(i % 5), 3.0), "train", i % 5) for i in range(40)]
    data = spark.createDataFrame([*rows, (99, 1, Vectors.dense(1.0, 4.0), "test", None)], [S.KEY, S.LABEL, "features", "split", "fold"])
    got = selection.naive_bayes_scored(data)
    assert got.count() == 41 and got.filter("prediction is null").isEmpty()
    assert 0 <= selection.gridsearch_nb(data).first()["accuracy"] <= 1


def test_grids_report_one_row_per_point(folded):
    logreg = selection.gridsearch_logreg(folded, [0.1, 1]).collect()
    assert [r["C"] for r in logreg] == [0.1, 1.0] and any(r["is_best"] for r in logreg)
    svm = selection.gridsearch_svm(folded, [1], ["rbf", "sigmoid", "poly"]).collect()
    assert [r["kernel"] for r in svm] == ["rbf", "sigmoid", "poly"]
    assert all(0.5 < r["accuracy"] <= 1 for r in svm)


def check_report(rows, n_train, n_test):
    cells = {(r["split"], r["section"], r["row"], r["metric"]): r["value"] for r in rows}
    for split, n in (("train", n_train), ("test", n_test)):
        counts = {(a, p): v for (s, section, a, p), v in cells.items() if (s, section) == (split, "confusion")}
        assert sum(counts.values()) == n
        hit = counts["0", "0"] + counts["1", "1"]
        assert cells[split, "accuracy", "all", "accuracy"] == pytest.approx(hit / n)
        called = counts["0", "1"] + counts["1", "1"]
        assert cells[split, "report", "1", "precision"] == pytest.approx(counts["1", "1"] / called)
        assert cells[split, "report", "1", "support"] == counts["1", "0"] + counts["1", "1"]
    return cells


def test_tuned_models_are_scored_on_train_and_test_rows(folded):
    n_train, n_test = (folded.filter(f"split = '{s}'").count() for s in ("train", "test"))
    check_report(selection.tuned_nb(folded).collect(), n_train, n_test)
    cells = check_report(selection.tuned_logreg(folded, [0.01, 10]).collect(), n_train, n_test)
    assert cells["test", "accuracy", "all", "accuracy"] > 0.75
    svm = selection.tuned_svm(folded, [1], ["linear", "sigmoid"]).collect()
    check_report(svm, n_train, n_test)
    grid = selection.gridsearch_svm(folded, [1], ["linear", "sigmoid"]).filter("is_best").collect()
    assert svm[0]["kernel"] == min(r["kernel"] for r in grid)


def test_perceptron_report(medium):
    data = models.prepared(medium)
    rows = selection.model_report(models.scored(models.fit_perceptron(data, len(S.FEATURES)), data)).collect()
    cells = check_report(rows, *(models.part(data, s).count() for s in ("train", "test")))
    assert cells["train", "accuracy", "all", "accuracy"] > 0.8


def vectors(spark, x):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>").select(
        "id", array_to_vector("v").alias("scaled_features")
    )


@pytest.mark.parametrize("features", [1, 3, len(S.FEATURES)])
def test_cubic_kernel_is_exact(spark, features):
    x = np.random.default_rng(3).normal(size=(12, features))
    rows = selection.feature_map("poly")(vectors(spark, x)).transform(vectors(spark, x)).orderBy("id").collect()
    z = np.array([r["mapped_features"].toArray() for r in rows])
    assert np.allclose(z @ z.T, (x @ x.T / features) ** 3)


@pytest.mark.parametrize("features", [4, len(S.FEATURES)])
def test_rbf_kernel_at_the_width_taken(spark, features):
    x = np.random.default_rng(11).normal(size=(50, features))
    rows = selection.feature_map("rbf")(vectors(spark, x)).transform(vectors(spark, x)).orderBy("id").collect()
    z = np.array([r["mapped_features"].toArray() for r in rows])
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / features)
    # the width is chosen on other points, so these may lie a little beyond its bound
    assert np.abs(z @ z.T - exact).max() < 1.25 * kernels.RBF_ERROR


def test_sigmoid_map():
    x = np.random.default_rng(3).normal(size=(40, 8))
    z = kernels.sigmoid_map(x)(x)
    values, axes = np.linalg.eigh(np.tanh(x @ x.T / 8))
    assert np.allclose(z @ z.T, axes * np.abs(values) @ axes.T, atol=1e-6)


def test_sigmoid_landmarks_come_from_fitted_rows(folded):
    rest = selection.scaled(folded, *selection.fold_moments(folded).scale(0)).filter("fold != 0")
    fitted = selection.feature_map("sigmoid", landmarks=16)(rest)
    marks = kernels.landmark_rows(rest, S.KEY, 16)
    x = np.array([r[0].toArray() for r in rest.select("scaled_features").limit(5).collect()])
    assert np.allclose(fitted.function(x), kernels.sigmoid_map(marks)(x))


def test_merged_sums_are_those_of_joins(spark):
    r = np.random.default_rng(1)
    frames, tables = [], []
    for i in range(70):
        keys = [None, "a", "b", "c"] if i else [None, "a", "b", "c", "only here"]
        rows = [(k, int(v)) for k in keys for v in r.integers(-5, 5, 2)] + [("a", None)]
        frame = spark.createDataFrame(rows, "k string, key int")
        tables.append((f"n{i}", frame, F.col("key")))
        frames.append(frame.groupBy("k").agg(F.sum("key").alias(f"n{i}")))
    some = joins.merge_sums(tables[:8], "k")
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, joins.join_fold(frames[:8], "k").collect()))
    wide = joins.merge_sums(tables, "k")
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert wide.columns == ["k", *(f"n{i}" for i in range(70))]
    got = {row["k"]: row for row in wide.collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert got["a"]["n69"] == sum(v for k, v in tables[69][1].collect() if k == "a" and v is not None)


def test_frames_compared_column_by_column(spark):
    real = spark.createDataFrame([(0, 1.0, None), (0, 3.0, 4.0), (1, 5.0, 6.0)], "y int, a double, b double")
    fake = spark.createDataFrame([(1, 2.0, 1.0), (2, 2.0, 1.0)], "y int, a double, b double")
    got = {(r["measure"], r["name"]): (r["real"], r["synthetic"], r["gap"]) for r in synth.compare(real, fake, "y", ["a", "b"]).collect()}
    assert got["mean", "a"] == (3.0, 2.0, -1.0) and got["mean", "b"] == (5.0, 1.0, -4.0)
    assert got["spread", "a"] == (2.0, 0.0, -2.0)
    assert got["share", "0"] == pytest.approx((200 / 3, 0.0, -200 / 3)) and got["share", "2"] == (0.0, 50.0, 50.0)
    assert got["share", "1"] == pytest.approx((100 / 3, 50.0, 50 - 100 / 3)) and len(got) == 7


def test_minimise_finds_the_lowest_point():
    curve = np.array([1.0, 30.0, 500.0])
    fit = hinge.minimise(np.array([3.0, -2.0, 1.0]), 200, 1e-12)
    x = next(fit)
    with pytest.raises(StopIteration) as done:
        while True:
            x = fit.send((float(curve @ (x - 1) ** 2 + abs(x[0] - 1)), 2 * curve * (x - 1) + np.array([np.sign(x[0] - 1), 0, 0])))
    assert np.allclose(done.value.value, 1, atol=1e-2)


def test_cubic_map_is_that_of_the_transformer(spark):
    x = np.random.default_rng(3).normal(size=(6, 5))
    z = kernels.cubic_map(5)(x)
    assert np.allclose(z @ z.T, (x @ x.T / 5) ** 3)


def test_svms_of_all_folds_and_penalties_share_their_jobs(folded, spark):
    spark.sparkContext.setJobGroup("svm-grid", "grid")
    rows = selection.gridsearch_svm(folded, [0.01, 0.1, 1], ["linear"]).collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # a fit of each of the 15 models by itself took some hundred jobs for every model
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("svm-grid")) < 400
    moments, penalty = selection.fold_moments(folded), selection._penalties(folded, [1])[1]
    classifier = selection._svm("linear", S.LABEL)
    fitted = [selection._fold_accuracies(folded, moments, classifier, [{classifier.regParam: penalty}], S.LABEL, f, None)[0] for f in range(2)]
    maps = selection._fold_maps(folded, moments, "linear", None, 64)
    got = hinge.accuracies(folded, maps, [penalty], S.LABEL, selection.SVM_TOLERANCE)
    assert np.abs(got[:2, 0] - fitted).max() < 0.03 and [r["C"] for r in rows] == [0.01, 0.1, 1.0]


def test_maps_work_in_the_precision_of_their_rows():
    x = np.random.default_rng(3).normal(size=(40, 6))
    for mapped in (kernels.rbf_map(6), kernels.cubic_map(6), kernels.sigmoid_map(x[:20])):
        z = mapped(x.astype(np.float32))
        assert z.dtype == np.float32 and mapped(x).dtype == float and np.allclose(z, mapped(x), atol=1e-4)


def test_cubic_map_has_the_products_in_order():
    x = np.random.default_rng(3).normal(size=(6, 4))
    triples = [(i, j, k) for i in range(4) for j in range(i, 4) for k in range(j, 4)]
    orders = [{1: 1, 2: 3, 3: 6}[len({*t})] for t in triples]
    want = np.stack([x[:, i] * x[:, j] * x[:, k] for i, j, k in triples], axis=1) * np.sqrt(np.array(orders) / 4**3)
    assert np.allclose(kernels.cubic_map(4)(x), want)


@pytest.mark.parametrize("kernel", ["poly", "rbf"])
def test_fits_in_single_precision_are_those_in_double(folded, monkeypatch, kernel):
    maps = selection._fold_maps(folded, selection.fold_moments(folded), kernel, 128, 64)[:1]
    got = []
    for least in (0, 1 << 40):
        monkeypatch.setattr(hinge, "SINGLE", least)
        got.append(hinge.fits(folded, dict(enumerate(maps)), [0.01], S.LABEL, selection.SVM_TOLERANCE, 8)[0])
    (single, shift), (double, offset) = got
    assert np.allclose(single, double, atol=1e-3 * np.abs(double).max()) and np.allclose(shift, offset, atol=1e-3)


def cubic_folds(x, parts):
    scales = [(rows.mean(axis=0), selection._inverse(rows.std(axis=0, ddof=1))) for rows in (x, *parts)]
    return kernels.CubicFolds(scales[0], dict(enumerate(scales[1:]))), scales[1:]


def test_cubic_features_of_folds_are_sums_of_common_ones():
    r = np.random.default_rng(5)
    x = r.normal(size=(40, 4)) * [1, 5, 0, 0.1] + [3, 0, 7, -2]
    shared, scales = cubic_folds(x, [x[:30], x[10:]])
    z, pull = shared.map(x), r.normal(size=40)
    assert shared.alike()
    for f, (mean, inverse) in enumerate(scales):
        own = kernels.cubic_map(4)((x - mean) * inverse)
        weights = r.normal(size=own.shape[1])
        assert np.allclose(own @ weights, z @ shared.lifted(f, weights))
        assert np.allclose(own.T @ pull, shared.lowered(f, z.T @ pull))
    x[0, 0] = 1e6  # a fold without this row is scaled quite otherwise
    assert not cubic_folds(x, [x[:30], x[10:]])[0].alike()


def test_steps_on_a_shared_map_are_those_on_maps_of_folds(folded):
    moments = selection.fold_moments(folded)
    maps, shared = dict(enumerate(selection._fold_maps(folded, moments, "poly", None, 64))), selection._cubic_folds(moments)
    assert shared is not None
    got, want = (hinge.fits(folded, maps, [0.01, 0.1], S.LABEL, selection.SVM_TOLERANCE, 3, shared=s) for s in (shared, None))
    for f in maps:
        assert np.allclose(got[f][0], want[f][0]) and np.allclose(got[f][1], want[f][1])


@pytest.mark.parametrize("kernel", ["linear", "sigmoid"])
def test_tuned_svm_is_fitted_like_those_of_the_grid(folded, spark, kernel):
    spark.sparkContext.setJobGroup("svm-refit", "refit")
    rows = selection.refitted_svm(folded, kernel, 1.0)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("svm-refit")) < 200
    assert rows.columns == [S.KEY, "split", "label", "prediction"] and rows.count() == folded.count()
    mapped = selection.feature_map(kernel)
    fitted = selection.refitted(folded, selection._svm(kernel, S.LABEL), 1.0, S.LABEL, mapped).select(S.KEY, F.col("prediction").alias("other"))
    share = rows.join(fitted, S.KEY).agg(F.avg((F.col("prediction") == F.col("other")).cast("double"))).first()[0]
    assert share > 0.95
    # test rows have no part in the fit
    odd = folded.withColumn(S.LABEL, F.when(F.col("split") == "test", 1 - F.col(S.LABEL)).otherwise(F.col(S.LABEL)))
    assert rows.select(S.KEY, "prediction").exceptAll(selection.refitted_svm(odd, kernel, 1.0).select(S.KEY, "prediction")).isEmpty()


@pytest.mark.parametrize("cached, taken", [(0, "steps"), (1 << 28, "library")])
def test_tuned_svm_is_fitted_by_the_library_only_while_it_caches_little(folded, monkeypatch, cached, taken):
    class Taken(Exception):
        pass

    def take(name):
        def taken(*_):
            raise Taken(name)

        return taken

    monkeypatch.setattr(selection, "CACHED", cached)
    monkeypatch.setattr(selection, "gridsearch_svm", lambda data, *_: data.sparkSession.createDataFrame([("rbf", 1.0, 1.0, True)], "kernel string, C double, accuracy double, is_best boolean"))
    monkeypatch.setattr(selection, "refitted_svm", take("steps"))
    monkeypatch.setattr(selection, "refitted", take("library"))
    with pytest.raises(Taken, match=taken):
        selection.tuned_svm(folded)


def test_widths_of_maps():
    x = np.random.default_rng(3).normal(size=(80, 5))
    for kernel, mapped in {"poly": kernels.cubic_map(5), "rbf": kernels.rbf_map(5, kernels.rbf_width(5))}.items():
        assert mapped(x).shape[1] == kernels.map_width(kernel, 5)
    assert kernels.sigmoid_map(x[:64])(x).shape[1] <= kernels.map_width("sigmoid", 5)
