"""Percent ranks against a plain count, and rule labels that meet rows in every class."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.operators import models, rules
from ledgerline.operators.ordering import percent_ranks
from ledgerline.plans.workload import QUERIES

SMALL = "/root/testdata/sf0.01"


def brute(values):
    known = [v for v in values if v is not None and not math.isnan(v)]
    top = max(len(known) - 1, 1)
    return [
        None if v is None or math.isnan(v) else 100.0 * sum(w < v for w in known) / top for v in values
    ]


@pytest.mark.parametrize("ranges", [2, 7, 50])
def test_ranks_match_a_plain_count(spark, ranges):
    n = 240
    odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0]
    columns = {
        "hot": [5.0 if i % 3 else float(i) for i in range(n)],
        "odd": [odd[i % 9] if i % 9 < 6 else float(i * 37 % 101) for i in range(n)],
        "constant": [1.0] * n,
        "a.b": [float(i) for i in range(n)],
        "none": [None] * n,
        "lone": [3.0] + [None] * (n - 1),
    }
    rows = [(f"k{i}", *[columns[c][i] for c in columns]) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, " + ", ".join(f"`{c}` double" for c in columns)).repartition(5)
    got = {r["id"]: r for r in percent_ranks(df, list(columns), "id", ranges).collect()}
    assert len(got) == n
    for name, values in columns.items():
        assert [got[f"k{i}"][name] for i in range(n)] == brute(values), name


def test_ranks_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id long, v double")
    result = percent_ranks(empty, ["v"], "id")
    assert result.columns == ["id", "v"] and result.count() == 0


def test_quorum_counts_tests_and_a_null_fails(spark):
    df = spark.createDataFrame([(1, 9.0, None, 9.0), (2, 9.0, 1.0, None), (3, 1.0, 1.0, 1.0)], "id int, a double, b double, c double")
    rule = rules.Rule("up", {c: rules.above(5) for c in "abc"}, quorum=2)
    labelled = rules.risk_rules(df, [rule], "label", "down")
    assert {r["id"]: r["label"] for r in labelled.collect()} == {1: "up", 2: "down", 3: "down"}


CLASSES = {
    "label_risk_category_ranked": ("risk_category", {"Low", "Medium", "High"}),
    "label_risk_num_ranked": ("risk_num", {0, 1, 2}),
    "label_high_explicit_ranked": ("matched_rule", {"Low", "Medium", "High"}),
    "label_fraction_thresholds_ranked": ("Risk_Level", {"Low Risk", "Medium Risk", "High Risk"}),
    "label_rank_row": ("Risk_Level", {"Low Risk", "Medium Risk", "High Risk"}),
    "label_percentile_quorum": ("risk", {"Low", "Medium"}),
    "label_domain_thresholds_quorum": ("risk", {"low", "medium", "high"}),
    "label_scaled_max_quorum": ("Risk_Level", {"Low Risk", "Medium Risk", "High Risk"}),
}


@pytest.mark.parametrize("name", sorted(CLASSES))
def test_every_written_class_has_a_hundredth_of_the_rows(spark, name):
    output, classes = CLASSES[name]
    counts = Counter(r[0] for r in QUERIES[name](spark, SMALL).select(output).collect())
    for label in classes:
        assert counts[label] * 100 >= sum(counts.values()), (label, counts)


def test_every_column_label_has_each_class(spark):
    labels = QUERIES["label_rank_column"](spark, SMALL)
    n = labels.count()
    found = labels.agg(
        *[
            F.count_if(F.col(f"`{c}_Risk_Level`") == level).alias(f"{i} {level}")
            for i, c in enumerate(S.FEATURES_THREE_CLASS)
            for level in rules.LEVELS
        ]
    ).first()
    assert all(count * 100 >= n for count in found)


def test_model_on_the_risk_number_beats_the_commonest_class(spark):
    accuracy = {r["split"]: r for r in QUERIES["logreg_multinomial_risk_num"](spark, SMALL).collect()}
    assert set(accuracy) == {"train", "test"}
    assert accuracy["test"]["classes"] == 3
    assert accuracy["test"]["accuracy"] > accuracy["test"]["commonest"] + 0.05
