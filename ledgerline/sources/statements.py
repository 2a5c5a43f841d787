"""Build the wide ``credit_raw`` table from order and line-item tables.

One row per customer.  Money is summed as integer cents and divided once, so
the figures do not depend on the order in which Spark adds them up.  ANSI mode
raises on a bigint overflow instead of returning a wrong figure.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schema as S

PERIOD_YEARS = {"CP": 2000, "LP": 1999, "PBLP": 1998}
PRIORITIES = {"1-URGENT": "Excellent", "2-HIGH": "Good", "3-MEDIUM": "Fair", "4-NOT SPECIFIED": "Bad", "5-LOW": "None"}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str, factor: int = 100) -> Column:
    return F.rint(F.col(column) * factor).cast("bigint")


def _choice(value: Column, choices: Mapping) -> Column:
    found = F.lit(None)
    for key, chosen in choices.items():
        found = F.when(value == key, chosen).otherwise(found)
    return found


def order_sums(lineitem: DataFrame) -> DataFrame:
    """Integer sums per order.

    The few short fields of the lines are shuffled: an order's lines lie anywhere in the table, so
    sums made before the shuffle would be about as many as the lines, wider, and spill.
    """
    lines = lineitem.select(
        "l_orderkey",
        _cents("l_extendedprice").alias("e"),
        _cents("l_discount").alias("d"),
        _cents("l_tax").alias("t"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"),
    ).repartition("l_orderkey")
    e, d, t, q = F.col("e"), F.col("d"), F.col("t"), F.col("q")

    def only(flag: str, value: str, amount: Column) -> Column:
        return F.sum(F.when(F.col(flag) == value, amount).otherwise(F.lit(0).cast("bigint")))

    return lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(e * (100 - d)).alias("revenue"),
        F.sum(e * (6 - d)).alias("ebit"),
        F.sum(e * t).alias("depreciation"),
        only("rf", "A", e).alias("fixed"),
        only("rf", "R", e).alias("intangible"),
        only("rf", "N", e).alias("current"),
        only("ls", "O", e).alias("open_value"),
        only("ls", "F", e).alias("filled_value"),
        only("ls", "O", q).alias("open_qty"),
        only("ls", "F", q).alias("filled_qty"),
        F.sum(t * q).alias("taxed_qty"),
    )


SUM_COLUMNS = [
    "n_lines",
    "revenue",
    "ebit",
    "depreciation",
    "fixed",
    "intangible",
    "current",
    "open_value",
    "filled_value",
    "open_qty",
    "filled_qty",
    "taxed_qty",
]


def period_band(year: Column, low: Column, high: Column) -> Column:
    """Place of a year's band, 0 the newest, when all years are cut into three consecutive bands.

    The bands differ by one year at most, newer ones being the longer; fewer than three
    years leave the older bands empty.
    """
    return F.floor((high - year) * len(S.PERIODS) / (high - low + 1)).cast("int")


def band_end(band: int, low: Column, high: Column) -> Column:
    return (high - F.ceil(band * (high - low + 1) / F.lit(len(S.PERIODS)))).cast("int")


def customer_sums(
    orders: DataFrame, per_order: DataFrame, years: dict[str, int] | None = None
) -> DataFrame:
    """Fold orders into one row per customer, the three periods side by side.

    ``years`` names one year for each period; None cuts the table's own range of years
    into three bands, so that every dated order belongs to a period.  ``last_priority`` is
    the place in ``PRIORITIES``, from 1, of the last order's priority: a number, as text
    in a ``max_by`` makes Spark sort the rows.
    """
    year = F.year("o_orderdate")
    priority = _choice(F.col("o_orderpriority"), {p: i for i, p in enumerate(PRIORITIES, 1)}).cast("int")
    joined = orders.select(
        "o_orderkey",
        "o_custkey",
        priority.alias("priority"),
        _cents("o_totalprice").alias("total"),
        year.alias("y"),
        F.expr("shiftleft(1, month(o_orderdate))").alias("month_bit"),
    ).join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    # the one shuffle of the orders by customer, for all that follows
    joined = joined.drop("l_orderkey").repartition("o_custkey")
    if years is None:
        bounds = orders.agg(F.min(year).alias("low"), F.max(year).alias("high"))
        low, high = F.col("range.low"), F.col("range.high")
        # months of different years are different months: one bit set for each year first
        lined = F.col("n_lines").isNotNull()
        joined = joined.groupBy("o_custkey", "y").agg(
            F.sum("total").alias("total"),
            F.max_by("priority", "o_orderkey").alias("priority"),
            F.max("o_orderkey").alias("o_orderkey"),
            *[F.sum(c).alias(c) for c in SUM_COLUMNS],
            F.bit_count(F.bit_or(F.when(lined, F.col("month_bit")))).alias("months"),
        )
        joined = joined.withColumn("range", bounds.select(F.struct("*")).scalar())
        within = {p: period_band(F.col("y"), low, high) == i for i, p in enumerate(S.PERIODS)}
        ends = {p: F.max(band_end(i, low, high)) for i, p in enumerate(S.PERIODS)}
        months = lambda mine: F.sum(F.when(mine, F.col("months")))
    else:
        within = {p: F.col("y") == year_of for p, year_of in years.items()}
        ends = {p: F.max(F.lit(year_of)) for p, year_of in years.items()}
        months = lambda mine: F.bit_count(F.bit_or(F.when(mine, F.col("month_bit"))))
    aggregates = [
        F.sum("total").alias("total"),
        F.max_by("priority", "o_orderkey").alias("last_priority"),
        F.sum("n_lines").alias("n_lines"),
    ]
    for prefix, mine in within.items():
        in_period = mine & F.col("n_lines").isNotNull()
        aggregates += [F.sum(F.when(in_period, F.col(c))).alias(f"{prefix}_{c}") for c in SUM_COLUMNS]
        aggregates += [months(in_period).alias(f"{prefix}_months"), ends[prefix].alias(f"{prefix}_end")]
    return joined.groupBy("o_custkey").agg(*aggregates)


def _period_measures(p: str) -> dict[str, Column]:
    def c(name: str) -> Column:
        return F.col(f"{p}_{name}")

    return {
        "number_months": F.when(c("n_lines").isNotNull(), c("months").cast("int")),
        "revenue": c("revenue") / F.lit(1e4),
        "EBIT": c("ebit") / F.lit(1e4),
        "depreciation": c("depreciation") / F.lit(1e4),
        "net_profit": (c("ebit") - c("depreciation")) / F.lit(1e4),
        "fixed_assets": c("fixed") / F.lit(1e2),
        "intangible_assets": c("intangible") / F.lit(1e3),
        "current_assets": c("current") / F.lit(1e2),
        "tangible_net_worth": (
            10 * (c("fixed") + c("current")) - 4 * c("open_value") - 3 * c("filled_value")
        )
        / F.lit(1e3),
        "long_term_liabilities": 4 * c("open_value") / F.lit(1e3),
        "long_term_credit": (100 * c("open_qty")).cast("double"),
        "short_term_liabilities": 3 * c("filled_value") / F.lit(1e3),
        "short_term_credit": (100 * c("filled_qty")).cast("double"),
        "off_balance_liabilities": c("taxed_qty") / F.lit(1e2),
    }


def credit_raw(spark: SparkSession, sf_dir: str, years: dict[str, int] | None = None) -> DataFrame:
    """The raw credit table: ``contract_id`` plus 78 text columns; ``years`` as in ``customer_sums``."""
    sums = customer_sums(
        load_table(spark, sf_dir, "orders"), order_sums(load_table(spark, sf_dir, "lineitem")), years
    )
    customer = load_table(spark, sf_dir, "customer")
    nation = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = customer.join(sums, F.col("c_custkey") == F.col("o_custkey"), "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )

    key = F.col("c_custkey")
    measures = {
        f"{long}_{name}": value
        for prefix, long in S.PERIODS.items()
        for name, value in _period_measures(prefix).items()
    }
    worth = measures["current_period_tangible_net_worth"]
    exposure = F.col("total") / F.lit(1e2)
    years = (1 + key % 40).cast("int")
    values: dict[str, Column] = {
        "customer_name": F.when(key % 97 == 0, "0")
        .when(key % 97 == 1, "nan")
        .when(key % 97 == 2, "null")
        .when(key % 97 == 3, F.lit(None))
        .otherwise(F.col("c_name")),
        "market": F.col("n_name"),
        "credit_rating": F.when(F.col("c_acctbal") >= 7500, "A")
        .when(F.col("c_acctbal") >= 5000, "B")
        .when(F.col("c_acctbal") >= 2500, "C")
        .when(F.col("c_acctbal") >= 0, "D")
        .otherwise("E"),
        "payment_discipline": _choice(F.col("last_priority"), dict(enumerate(PRIORITIES.values(), 1))),
        "total_exposure": F.when(key % 53 == 0, "n/a").otherwise(exposure.cast("string")),
        "years_in_business": years,
        "fundation_year": 2000 - years,
        "fleet_size": F.coalesce(F.col("n_lines"), F.lit(0)),
        "financing_currency": F.element_at(
            F.array(F.lit("EUR"), F.lit("SEK"), F.lit("PLN")), (F.col("c_nationkey") % 3 + 1).cast("int")
        ),
        "TNW_in_MEUR": worth / F.lit(1e6),
        "profits_perc_TNW": F.try_divide(100 * measures["current_period_net_profit"], worth),
        "positive_working_capital": measures["current_period_current_assets"]
        - measures["current_period_short_term_liabilities"],
        "TNW_to_total_exposure": F.try_divide(100 * worth, exposure),
        "quote_id": F.concat(F.lit("Q"), key.cast("string")),
        "legal_form": F.lit("LTD"),
        "type_of_data": F.lit("annual"),
        **{
            long: F.when(
                F.col(f"{prefix}_n_lines").isNotNull(), F.concat(F.col(f"{prefix}_end").cast("string"), F.lit("-12-31"))
            )
            for prefix, long in S.PERIODS.items()
        },
        **measures,
    }
    return base.select(
        key.alias(S.KEY),
        *[values.get(c, F.lit(None)).cast("string").alias(c) for c in S.RAW_COLUMNS],
    )
