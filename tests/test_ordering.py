"""Range-wise running totals and exact quantiles against plain Python and numpy."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.ordering import row_numbers, running_totals
from ledgerline.operators.quantiles import exact_quantiles
from ledgerline.operators.split import cv_folds, split_hash

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


def check_quantiles(spark, data, limit):
    df = spark.createDataFrame([(float(v),) for v in data], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], PROBS, rank_at_most=limit).collect()}
    want = np.quantile(np.array(data, dtype=float), PROBS)
    assert [got[p] for p in PROBS] == pytest.approx(list(want))


@pytest.mark.parametrize("limit", [1, 10, 10_000])
def test_quantiles_of_continuous_values(spark, limit):
    check_quantiles(spark, np.random.default_rng(0).lognormal(0, 4, 5000), limit)


@pytest.mark.parametrize("limit", [1, 3, 10_000])
def test_quantiles_with_a_third_of_rows_equal(spark, limit):
    rng = np.random.default_rng(1)
    check_quantiles(spark, np.concatenate([np.full(1700, 7.0), rng.normal(7, 3, 3300)]), limit)


@pytest.mark.parametrize("limit", [1, 2, 100])
def test_quantiles_of_few_distinct_values(spark, limit):
    check_quantiles(spark, [25.0] * 500 + [50.0] * 500 + [75.0] * 499 + [100.0] * 501, limit)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40))
def test_quantiles_of_any_small_list(spark, data):
    check_quantiles(spark, data, 1)


def test_quantiles_by_group_skip_nulls(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (0, None), (1, 5.0), (1, float("nan"))], "g int, x double")
    got = {(r["grp"], r["prob"]): r["value"] for r in exact_quantiles(df, ["x"], [0.5], by="g").collect()}
    assert got == {(0, 0.5): 2.0, (1, 0.5): 5.0}


@pytest.mark.parametrize("ranges", [2, 5, 16])
def test_running_totals_match_a_single_window(spark, ranges):
    df = spark.range(500).select(
        (F.col("id") * 37 % 500).alias("k"), (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v")
    )
    got = running_totals(df, "k", ["v"], ["g"], descending=True, ranges=ranges, carry=["v"]).collect()
    rows = sorted(df.collect(), key=lambda r: (r["g"], -r["k"]))
    want, total = {}, {}
    for i, r in enumerate(rows):
        total[r["g"]] = total.get(r["g"], 0) + r["v"]
        following = rows[i + 1]["v"] if i + 1 < len(rows) and rows[i + 1]["g"] == r["g"] else None
        want[r["g"], r["k"]] = (total[r["g"]], following)
    assert {(r["g"], r["k"]): (r["cum_v"], r["next_v"]) for r in got} == want


def test_row_numbers_count_every_row_once(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 700, "hot").otherwise("cold"))
    got = row_numbers(df, "id", ["g"], ranges=7).groupBy("g").agg(
        F.count_distinct("row_number").alias("d"), F.min("row_number").alias("a"), F.max("row_number").alias("b")
    )
    assert {r["g"]: (r["d"], r["a"], r["b"]) for r in got.collect()} == {"hot": (700, 1, 700), "cold": (300, 1, 300)}


def test_folds_are_stratified(clean):
    sizes = cv_folds(clean).groupBy("target_variable", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["target_variable"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_hash_split_is_complete_and_repeatable(clean):
    first = split_hash(clean).groupBy("split").count().collect()
    again = split_hash(clean.repartition(5)).groupBy("split").count().collect()
    assert sorted(first) == sorted(again)
    assert sum(r["count"] for r in first) == clean.count()


def test_hash_split_takes_large_keys(spark):
    df = spark.createDataFrame([(2**62,), (0,), (5_000_000_000,)], "contract_id bigint")
    assert split_hash(df).count() == 3


@pytest.mark.parametrize("kind", ["string", "date"])
def test_keys_that_are_no_numbers(spark, kind):
    made = F.concat(F.lit("customer-"), F.lpad("id", 5, "0")) if kind == "string" else F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int"))
    df = spark.range(600).select(made.alias("contract_id"), (F.col("id") % 3 == 0).cast("int").alias("target_variable"), "id")
    numbered = {r["id"]: r["row_number"] for r in row_numbers(df, "contract_id", ranges=7).collect()}
    assert numbered == {i: i + 1 for i in range(600)}
    down = running_totals(df, "contract_id", ["id"], descending=True, ranges=5, carry=["id"]).collect()
    assert {r["id"]: (r["cum_id"], r["next_id"]) for r in down} == {
        i: (sum(range(i, 600)), i - 1 if i else None) for i in range(600)
    }
    sizes = cv_folds(df).groupBy("target_variable", "fold").count().collect()
    assert len(sizes) == 10 and all(r["count"] in (40, 80) for r in sizes)
