"""Every dated order belongs to one of three periods when the bands follow the table."""

import datetime as dt

import pytest

from ledgerline import schema as S
from ledgerline.sources.statements import SUM_COLUMNS, customer_sums, order_sums

ORDERS = "o_orderkey long, o_custkey long, o_orderpriority string, o_totalprice double, o_orderdate date"


@pytest.mark.parametrize(
    "span, lengths",
    [((1995, 2001), (3, 2, 2)), ((2000, 2000), (1, 0, 0)), ((2000, 2001), (1, 1, 0)), ((1990, 1998), (3, 3, 3))],
)
def test_no_order_is_left_out(spark, span, lengths):
    years = range(span[0], span[1] + 1)
    days = [dt.date(y, m, 1) for y in years for m in (1, 12)]
    orders = spark.createDataFrame([(i, 1, "2-HIGH", 1.0, d) for i, d in enumerate(days)], ORDERS)
    lines = spark.createDataFrame(
        [(i, *[1] * len(SUM_COLUMNS)) for i in range(len(days))],
        "l_orderkey long, " + ", ".join(f"{c} long" for c in SUM_COLUMNS),
    )
    row = customer_sums(orders, lines, None).first()
    assert tuple((row[f"{p}_n_lines"] or 0) / 2 for p in S.PERIODS) == lengths
    assert tuple((row[f"{p}_months"] or 0) / 2 for p in S.PERIODS) == lengths
    end = span[1]
    for p, n in zip(S.PERIODS, lengths, strict=True):
        assert not n or row[f"{p}_end"] == end
        end -= n


@pytest.mark.parametrize("years", [None, {"CP": 2000, "LP": 1999, "PBLP": 1998}])
def test_orders_meet_by_customer_in_one_shuffle(spark, years):
    orders = spark.createDataFrame([(1, 1, "2-HIGH", 1.0, dt.date(2000, 1, 1)), (2, 1, "odd", 2.0, dt.date(2000, 2, 1))], ORDERS)
    lines = spark.createDataFrame(
        [(1, 10.0, 0.1, 0.1, 2.0, "A", "F"), (1, 5.0, 0.1, 0.1, 2.0, "R", "O"), (2, 1.0, 0.1, 0.1, 2.0, "N", "O")],
        "l_orderkey long, l_extendedprice double, l_discount double, l_tax double, l_quantity double, l_returnflag string, l_linestatus string",
    )
    sums = customer_sums(orders, order_sums(lines), years)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("hashpartitioning(o_custkey") == 1
    # the lines go through one shuffle as they are, not as sums that are wider than a line
    before = plan[plan.index("hashpartitioning(l_orderkey") :]
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "partial_sum" not in before
    row = sums.first()
    assert (row["n_lines"], row["CP_revenue"], row["total"], row["last_priority"]) == (3, 1000 * 90 + 500 * 90 + 100 * 90, 300, None)
