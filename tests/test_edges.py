"""Small hand-written frames for the corners of the semantics."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.typing import to_date, to_double, to_int
from ledgerline.operators import columns as C
from ledgerline.operators import correlate, distribution, evaluate, filters, missing, prepare, profile, rules
from ledgerline.operators.quantiles import exact_quantiles


def values(df, name):
    return [row[name] for row in df.collect()]


def test_bad_text_becomes_null_and_fractions_truncate(spark):
    df = spark.createDataFrame([(s,) for s in ["1.5", "7", "x", "", None, "-1.9", "3e9"]], "s string")
    got = df.select(to_double("s").alias("d"), to_int("s").alias("i")).collect()
    assert [r["d"] for r in got] == [1.5, 7.0, None, None, None, -1.9, 3e9]
    assert [r["i"] for r in got] == [1, 7, None, None, None, -1, None]


def test_year_text_becomes_first_of_january(spark):
    df = spark.createDataFrame([("1998",), ("2000-12-31",), ("soon",)], "s string")
    assert [str(v) for v in values(df.select(to_date("s").alias("d")), "d")] == ["1998-01-01", "2000-12-31", "None"]


def test_zero_denominator_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 2.0)], "current_assets double, short_term_liab double")
    assert values(C.add_ratios(df, ["current_ratio"]), "current_ratio") == [None, 0.5, None]


def test_zero_fill_takes_nan_too(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (float("nan"), "b")], "x double, s string")
    filled = missing.impute_zero(df)
    assert values(filled, "x") == [1.0, 0.0, 0.0]
    assert values(filled, "s") == ["a", None, "b"]


def test_mean_fill_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "x double")
    plain = values(missing.impute_mean_double(df), "x")
    assert plain[0] == 1.0 and math.isnan(plain[1]) and math.isnan(plain[3])
    assert values(missing.impute_mean_double(df, nan_is_null=True), "x") == [1.0, 2.0, 3.0, 2.0]


def test_int_mean_fill_truncates(spark):
    df = spark.createDataFrame([(1,), (None,), (2,), (3,), (3,)], "x int")
    assert sorted(values(missing.impute_mean_int(df), "x")) == [1, 2, 2, 3, 3]


def test_placeholder_filter_drops_null_names(spark):
    df = spark.createDataFrame([("0",), ("nan",), ("null",), (None,), ("Acme",)], "customer_name string")
    assert values(filters.filter_placeholder_names(df), "customer_name") == ["Acme"]
    assert values(filters.filter_not_equals(df, "customer_name", "0"), "customer_name") == ["nan", "null", "Acme"]


def test_correlation_of_constant_and_gappy_columns(spark):
    rows = [(5.1, 1.0, 2.0), (5.1, 2.0, None), (5.1, None, 7.0), (5.1, 4.0, 1.0), (5.1, 5.0, 3.0)]
    df = spark.createDataFrame(rows, "k double, x double, y double")
    r = {(a, b): v for a, b, v in correlate.corr_matrix_pairwise(df, ["k", "x", "y"]).collect()}
    assert len(r) == 9
    assert r["k", "x"] is None and r["k", "k"] is None
    x, y = [1.0, 4.0, 5.0], [2.0, 1.0, 3.0]
    mx, my = sum(x) / 3, sum(y) / 3
    want = sum((a - mx) * (b - my) for a, b in zip(x, y)) / math.sqrt(
        sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)
    )
    assert r["x", "y"] == pytest.approx(want) and r["y", "x"] == pytest.approx(want)


def test_prune_drops_both_or_the_later_column(spark):
    df = spark.createDataFrame([(float(i), float(2 * i), float((-1) ** i)) for i in range(10)], "a double, b double, c double")
    assert correlate.drop_correlated(df, ["a", "b", "c"]).columns == ["c"]
    assert correlate.drop_correlated(df, ["a", "b", "c"], keep="first").columns == ["a", "c"]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (3.0, 4.0)], "x double, k double")
    scaled = prepare.standardize_columns(df, ["x", "k"], ddof=1)
    assert values(scaled, "x") == [-1.0, 0.0, 1.0] and values(scaled, "k") == [0.0, 0.0, 0.0]
    _, ml = prepare.standardize(prepare.assemble_features(df, ["x", "k"]))
    assert [r[0].toArray().tolist() for r in ml.select("scaled_features").collect()] == [[-1, 0], [0, 0], [1, 0]]


def test_assembler_refuses_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception, match="(?i)null"):
        prepare.assemble_features(df, ["x"]).collect()


def test_quartiles_interpolate_or_pick_elements(spark):
    df = spark.range(1, 11).select(F.col("id").cast("double").alias("x"))
    exact = {r["stat"]: r["value"] for r in profile.describe_exact(df, ["x"]).collect()}
    picked = {r["stat"]: r["value"] for r in profile.summary_approx(df, ["x"]).collect()}
    assert exact["25%"] == 3.25 and exact["50%"] == 5.5
    assert picked["25%"] == 3.0


def test_log1p_domain(spark):
    df = spark.createDataFrame([(-2.0,), (-1.0,), (0.0,), (1.0,)], "x double")
    assert values(C.log1p_features(df, ["x"]), "log1p_x") == [None, None, 0.0, pytest.approx(math.log(2))]


def test_narrow_to_int_out_of_range(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (3e9,)], "x double")
    assert values(C.narrow_to_int(df, ["x"]), "x") == [1, -1, None]


def test_odd_names(spark):
    df = spark.createDataFrame([("1", "2")], ["TNW_to_T-Exposure", "Date_of_Est. "])
    got = C.cast_double(df, ["TNW_to_T-Exposure", "Date_of_Est. "]).first()
    assert tuple(got) == (1.0, 2.0)


def test_rename_refuses_doubled_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="more than one"):
        C.rename_columns(df, {"a": "x", "b": "X"})
    assert C.rename_columns(df, {"a": "x", "zzz": "y"}).columns == ["x", "b"]


def test_null_market_is_left_out(spark):
    df = spark.createDataFrame([("A", None), ("A", 1), (None, None)], "market string, x int")
    assert [tuple(r) for r in missing.null_count_by(df).collect()] == [("A", 1, 1)]


def test_zscore_policies(spark):
    rows = [(float(i % 3), float(i % 3)) for i in range(40)] + [(100.0, 100.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "gappy double, whole double")
    strict = {r[0]: r[1] for r in distribution.zscore_outlier_count(df, ["gappy", "whole"]).collect()}
    loose = {r[0]: r[1] for r in distribution.zscore_outlier_count(df, ["gappy", "whole"], nan_policy="omit").collect()}
    assert strict == {"whole": 1} and loose == {"gappy": 1, "whole": 1}


def test_histogram_of_constant_column(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "x double")
    table = distribution.histogram(df, ["x"], 10).orderBy("bin").collect()
    assert [r["n"] for r in table] == [0] * 5 + [4] + [0] * 4
    assert table[0]["bin_low"] == 1.5


def test_rules_take_the_first_match_and_ignore_nulls(spark):
    table = [rules.Rule("low", {"x": rules.above(10)}), rules.Rule("medium", {"x": rules.within(5, 10)})]
    df = spark.createDataFrame([(11.0,), (10.0,), (1.0,), (None,)], "x double")
    assert values(rules.risk_rules(df, table, "r", "high"), "r") == ["low", "medium", "high", "high"]


def test_banded_labels_reach_all_levels(spark):
    names = rules.RULE_COLUMNS

    def row(measure, points):
        return tuple(float(points if c in rules.SCORE_COLUMNS else measure) for c in names)

    df = spark.createDataFrame([row(60, 100), row(30, 60), row(10, 25), row(60, 60)], [*names])
    got = rules.label_risk_num(rules.label_high_explicit(df))
    assert values(got, "risk_category") == ["Low", "Medium", "High", "High"]
    assert values(got, "risk_num") == [0, 1, 2, 2]
    assert values(got, "matched_rule") == ["Low", "Medium", None, None]


def test_class_never_predicted(spark):
    rows = [(0, 0), (0, 0), (1, 0), (2, 1), (2, 0)]
    scored = spark.createDataFrame(rows, "label int, prediction int")
    matrix = {(a, p): n for a, p, n in evaluate.confusion_matrix(scored).collect()}
    assert len(matrix) == 9 and sum(matrix.values()) == 5 and matrix[2, 2] == 0
    report = {r["row"]: r for r in evaluate.classification_report(scored).collect()}
    assert report["2"]["precision"] == 0.0 and report["0"]["recall"] == 1.0
    assert report["accuracy"]["f1"] == pytest.approx(0.4)


def test_exact_areas_with_ties(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.4), (0, 0.4), (0, 0.1), (0, 0.1)]
    scored = spark.createDataFrame(rows, "label int, score double")
    pairs = [(a, b) for y, a in rows if y for z, b in rows if not z]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    for ranges in (2, 3, 8):
        assert evaluate.auc_roc(scored, ranges=ranges).first()[0] == pytest.approx(want)
        assert evaluate.roc_auc_trapezoid(scored, ranges=ranges).first()[0] == pytest.approx(want)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    library = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderPR").evaluate(
        scored.withColumn("label", F.col("label").cast("double"))
    )
    assert evaluate.auc_pr(scored).first()[0] == pytest.approx(library)


def test_one_class_only_has_no_area(spark):
    scored = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert evaluate.auc_roc(scored).first()[0] is None
    assert evaluate.roc_auc_trapezoid(scored).first()[0] is None
    assert evaluate.binary_rates(scored.withColumn("prediction", F.lit(0))).first()["fpr"] is None


def test_roc_curve_drops_only_points_on_a_line(spark):
    rows = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4)]
    scored = spark.createDataFrame(rows, "label int, score double")
    kept = [r["threshold"] for r in evaluate.roc_curve(scored).orderBy(F.desc_nulls_first("threshold")).collect()]
    assert kept == [None, 0.9, 0.7, 0.5, 0.4]
    assert evaluate.roc_curve(scored, drop_collinear=False).count() == 7


def test_curves_by_group_with_infinite_scores_and_foreign_labels(spark):
    rows = [("a", 1, float("inf")), ("a", 0, 0.3), ("a", 1, 0.2), ("a", 7, 9e9), ("b", 0, 0.5), ("b", 1, float("-inf"))]
    scored = spark.createDataFrame(rows, "model string, label int, score double")
    for area in (evaluate.auc_roc, evaluate.roc_auc_trapezoid):
        assert {r["model"]: r["auc_roc"] for r in area(scored, ["model"]).collect()} == {"a": 0.5, "b": 0.0}
    curve = evaluate.roc_curve(scored, ["model"]).collect()
    assert sorted((r["fpr"], r["tpr"]) for r in curve if r["model"] == "a") == [(0, 0), (0, 0.5), (1, 0.5), (1, 1)]
    assert sum(r["threshold"] is None for r in curve) == 2


def test_a_curve_reads_its_input_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.range(50).selectExpr("CAST(id % 2 AS INT) AS label", "CAST(id AS DOUBLE) AS score")
    evaluate.roc_auc_trapezoid(rows.mapInArrow(seen, rows.schema)).collect()
    assert reads.value == 50

def test_quantile_of_empty_frame(spark):
    assert exact_quantiles(spark.createDataFrame([], "x double"), ["x"], [0.5]).count() == 0


def test_boxes_of_many_classes(spark):
    df = spark.range(6000).select((F.col("id") % 1500).alias("g"), F.col("id").cast("double").alias("x"))
    got = {r["g"]: r["median"] for r in distribution.box_stats(df, ["x"], by="g").collect()}
    assert got == {g: g + 2250.0 for g in range(1500)}


def test_bins_leave_out_values_that_are_not_finite(spark):
    rows = [(float(i), float(i % 2)) for i in range(10)] + [(math.nan, 1.0), (math.inf, 0.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    assert sum(r["n"] for r in distribution.histogram(df, ["x"]).collect()) == 10
    assert sum(r["n"] for r in distribution.hexbin_counts(df, "x", "y").collect()) == 10
    assert all(math.isfinite(r["density"]) for r in distribution.kde_grid(df, ["x"]).collect())


def test_chi_square_of_a_known_table(spark):
    rows = [(0.0, 0)] * 30 + [(0.0, 1)] * 10 + [(1.0, 0)] * 20 + [(1.0, 1)] * 40
    df = spark.createDataFrame(rows, "x double, y int")
    got = distribution.chi_square_select(df, ["x"], "y", bins=2).first()
    want = sum((o - e) ** 2 / e for o, e in [(30, 20), (10, 20), (20, 30), (40, 30)])
    assert got["statistic"] == pytest.approx(want) and got["dof"] == 1


def test_zscore_counts_no_nan_and_no_infinite_column(spark):
    from ledgerline.operators.distribution import zscore_outlier_count

    nan, inf = float("nan"), float("inf")
    plain = [0.0] * 20 + [100.0]
    rows = [(x, nan if i == 0 else x, inf if i == 0 else x) for i, x in enumerate(plain)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert [tuple(r) for r in zscore_outlier_count(df, "abc").collect()] == [("a", 1)]
    omitted = zscore_outlier_count(df, "abc", nan_policy="omit").collect()
    assert [tuple(r) for r in omitted] == [("a", 1), ("b", 1)]


def test_infinite_values_are_values_of_quantiles_and_boxes(spark):
    rows = [(v, None) for v in [1.0, 2.0, 3.0, math.inf, math.inf, math.nan, None]]
    df = spark.createDataFrame(rows, "x double, empty double")
    box = {r["column"]: r for r in distribution.box_stats(df, ["x", "empty"]).collect()}
    assert (box["x"]["q1"], box["x"]["median"], box["x"]["q3"]) == (2.0, 3.0, math.inf)
    assert (box["x"]["whisker_low"], box["x"]["whisker_high"], box["x"]["n_outliers"]) == (1.0, math.inf, 0)
    assert tuple(box["empty"])[1:] == (None, None, None, None, None, 0)
    ends = spark.createDataFrame([(-math.inf,), (math.inf,), (4.0,)], "x double")
    assert [r["value"] for r in exact_quantiles(ends, ["x"], [0.0, 0.5, 1.0]).orderBy("prob").collect()] == [-math.inf, 4.0, math.inf]
    assert values(exact_quantiles(ends.filter("x != 4"), ["x"], [0.5]), "value") == [None]


def test_exact_description_keeps_columns_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, empty double")
    got = {(r["column"], r["stat"]): r["value"] for r in profile.describe_exact(df, ["x", "empty"]).collect()}
    assert len(got) == 16 and got["x", "50%"] == 1.5
    assert [got["empty", s] for s in ("count", "25%", "50%", "75%", "max")] == [0.0, None, None, None, None]


def test_quantiles_take_null_as_a_class_and_explode_no_rows(spark):
    rows = [("a", 1.0), ("a", 2.0), (None, 5.0), (None, 7.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["grp"]): r["value"] for r in exact_quantiles(df, ["x"], [0.5], by="g").collect()}
    assert got == {"a": 1.5, None: 6.0, "b": None}
    boxes = {r["g"]: r["n_outliers"] for r in distribution.box_stats(df, ["x"], by="g").collect()}
    assert boxes == {"a": 0, None: 0, "b": 0}


def test_densities_match_the_kernel_sum_by_class(spark):
    rows = [("a", float(i * i)) for i in range(30)] + [(None, float(i)) for i in range(5)] + [("c", 3.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    curve = distribution.kde_grid(df, ["x"], points=9, by="g").collect()
    assert sorted({str(r["g"]) for r in curve}) == ["None", "a"]
    for grp in ("a", None):
        data = [v for g, v in rows if g == grp and v is not None]
        n, mean = len(data), sum(data) / len(data)
        width = math.sqrt(sum((v - mean) ** 2 for v in data) / (n - 1)) * n**-0.2
        for r in [r for r in curve if r["g"] == grp]:
            x = min(data) - 3 * width + r["point"] * (max(data) - min(data) + 6 * width) / 8
            want = sum(math.exp(-0.5 * ((x - v) / width) ** 2) for v in data) / (n * width * math.sqrt(2 * math.pi))
            assert (r["x"], r["density"]) == pytest.approx((x, want))


def test_pair_counts_match_counting(spark):
    rows = [(float(i % 7), float(i * i % 11), None if i % 3 else float(i)) for i in range(60)] + [(math.inf, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    got = distribution.pair_scatter(df, ["a", "b", "c"], bins=4).collect()
    cells = {}
    ends = [[v for v in col if v is not None and math.isfinite(v)] for col in zip(*rows)]

    def place(i, v):
        low, high = min(ends[i]), max(ends[i])
        return min(int((v - low) / (high - low) * 4), 3)

    for row in rows:
        for i, j in ((0, 1), (0, 2), (1, 2)):
            if all(row[k] is not None and math.isfinite(row[k]) for k in (i, j)):
                key = ("abc"[i], "abc"[j], place(i, row[i]), place(j, row[j]))
                cells[key] = cells.get(key, 0) + 1
    assert {tuple(r)[:4]: r["n"] for r in got} == cells
    plan = distribution.pair_scatter(df, ["a", "b", "c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_hexagons_of_a_constant_column(spark):
    df = spark.createDataFrame([(float(i), 4.0) for i in range(10)], "x double, y double")
    got = distribution.hexbin_counts(df, "x", "y").collect()
    assert sum(r["n"] for r in got) == 10 and all(r["hex_y"] is not None for r in got)
