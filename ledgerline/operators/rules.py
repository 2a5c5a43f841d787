"""Risk rules: ordered rule tables turned into one ``when`` chain.

A rule is a label and a table of tests, one per column; it holds when all its
tests hold, or at least ``quorum`` of them.  The first rule that holds gives the
label.  A test of a null fails.

The limits of most rule tables are percentages.  On figures of other magnitude no
row meets them, so ``ranked`` gives a frame in which each rule column is the
value's percent rank in its column; the same tables then split any data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schema as S
from ledgerline.functions.typing import column
from ledgerline.operators.missing import ROW, attach_row
from ledgerline.operators.ordering import percent_ranks
from ledgerline.operators.quantiles import exact_quantiles

Limit = float | Column
Test = Callable[[Column], Column]


def above(limit: Limit) -> Test:
    return lambda value: value > limit


def at_least(limit: Limit) -> Test:
    return lambda value: value >= limit


def below(limit: Limit) -> Test:
    return lambda value: value < limit


def within(low: Limit, high: Limit) -> Test:
    return lambda value: value.between(low, high)


@dataclass(frozen=True)
class Rule:
    label: str
    tests: Mapping[str, Test]
    quorum: int | None = None

    def condition(self, value: Callable[[str], Column] = column) -> Column:
        held = [test(value(name)) for name, test in self.tests.items()]
        if self.quorum is None:
            return reduce(and_, held)
        return reduce(add, [F.when(one, 1).otherwise(0) for one in held]) >= self.quorum


def rule_label(
    rules: Iterable[Rule], otherwise: str | None, value: Callable[[str], Column] = column
) -> Column:
    rules = list(rules)
    chain = F.when(rules[0].condition(value), rules[0].label)
    for rule in rules[1:]:
        chain = chain.when(rule.condition(value), rule.label)
    return chain.otherwise(F.lit(otherwise).cast("string"))


def risk_rules(df: DataFrame, rules: Iterable[Rule], output: str, otherwise: str | None) -> DataFrame:
    return df.withColumn(output, rule_label(rules, otherwise))


# --- fixed values: columns and limits of the rule tables -----------------------------
SCORE_COLUMNS = ["CR_Rating_score", "pmt_discipline_score"]
MEASURE_COLUMNS = [
    "profits_perc_TNW",
    "TNW_to_T-Exposure",
    "debt_equity_ratio",
    "debt_asset_ratio",
    "interest_cov_ratio",
    "current_ratio",
    "return_on_assets",
    "debt_ser_cov_ratio",
]
RULE_COLUMNS = MEASURE_COLUMNS + SCORE_COLUMNS

MIN_CURRENT_RATIO = 1.5
MIN_RATING_SCORE = 25

# low / high limit of the middle band, for measures and for scores
PERCENT_LIMITS = ((25, 50), (50, 75))
FRACTION_LIMITS = ((0.25, 0.5), (0.5, 0.75))
EXPOSURE_HIGH_PERCENT = 50
EXPOSURE_HIGH_FRACTION = 0.25

# low-risk test and middle band per column; beyond both is high risk
BANKER_LOW = {
    "CR_Rating_score": above(75),
    "pmt_discipline_score": above(75),
    "debt_equity_ratio": below(0.5),
    "debt_asset_ratio": below(0.1),
    "interest_cov_ratio": above(5),
    "current_ratio": above(2),
    "return_on_assets": above(0.1),
    "debt_ser_cov_ratio": above(1.5),
}
BANKER_MEDIUM = {
    "CR_Rating_score": within(50, 75),
    "pmt_discipline_score": within(50, 75),
    "debt_equity_ratio": within(0.5, 1.0),
    "debt_asset_ratio": within(0.1, 0.25),
    "interest_cov_ratio": within(3, 5),
    "current_ratio": within(1.5, 2),
    "return_on_assets": within(0.05, 0.1),
    "debt_ser_cov_ratio": within(1.2, 1.5),
}
LEVERAGE_LOW = {
    "profits_perc_TNW": below(0.1),
    "TNW_to_T-Exposure": above(1.5),
    "short_term_leverage": below(0.1),
}
LEVERAGE_MEDIUM = {
    "profits_perc_TNW": within(0.1, 0.25),
    "TNW_to_T-Exposure": within(1.0, 1.5),
    "short_term_leverage": within(0.1, 0.25),
}


# --- binary label ------------------------------------------------------------------------
def label_binary(df: DataFrame) -> DataFrame:
    """1 (no default expected) for a rated, liquid customer, else 0; null counts as 0."""
    sound = (column("CR_Rating_score") > MIN_RATING_SCORE) & (column("current_ratio") > MIN_CURRENT_RATIO)
    return df.withColumn(S.LABEL, F.when(sound, 1).otherwise(0))


def flag_liquidity(df: DataFrame, min_ratio: float = MIN_CURRENT_RATIO) -> DataFrame:
    """True where the current ratio reaches ``min_ratio``; null ratio gives false."""
    return df.withColumn("liquid", F.coalesce(column("current_ratio") >= min_ratio, F.lit(False)))


# --- banded labels ---------------------------------------------------------------------------
def banded_rules(
    limits: tuple[tuple[float, float], tuple[float, float]],
    labels: tuple[str, str, str],
    exposure_high: float | None = None,
    quorum: int | None = None,
) -> list[Rule]:
    """Low above the band, medium inside it, and (if asked) high below it."""
    measure_band, score_band = limits
    band = {c: score_band if c in SCORE_COLUMNS else measure_band for c in RULE_COLUMNS}
    rules = [
        Rule(labels[0], {c: above(high) for c, (_, high) in band.items()}, quorum),
        Rule(labels[1], {c: within(low, high) for c, (low, high) in band.items()}, quorum),
    ]
    if exposure_high is not None:
        tests = {c: below(low) for c, (low, _) in band.items()}
        rules.append(Rule(labels[2], {**tests, "TNW_to_T-Exposure": above(exposure_high)}, quorum))
    return rules


def ranked(df: DataFrame, names: Sequence[str] = RULE_COLUMNS, key: str = S.KEY) -> DataFrame:
    """The key and, for each rule column, its value's percent rank of 0 to 100 in ``df``."""
    return percent_ranks(df, names, key)


def label_risk_category(df: DataFrame, quorum: int | None = None) -> DataFrame:
    rules = banded_rules(PERCENT_LIMITS, ("Low", "Medium", "High"), quorum=quorum)
    return risk_rules(df, rules, "risk_category", "High")


def label_high_explicit(df: DataFrame, quorum: int | None = None) -> DataFrame:
    """The same with a written test for High; ``matched_rule`` is null where no rule holds."""
    rules = banded_rules(PERCENT_LIMITS, ("Low", "Medium", "High"), EXPOSURE_HIGH_PERCENT, quorum)
    matched = risk_rules(df, rules, "matched_rule", None)
    return matched.withColumn("risk_category", F.coalesce("matched_rule", F.lit("High")))


def label_risk_num(df: DataFrame, source: str = "risk_category") -> DataFrame:
    """low 0, medium 1, anything else 2."""
    word = F.lower(column(source))
    return df.withColumn("risk_num", F.when(word == "low", 0).when(word == "medium", 1).otherwise(2))


LEVELS = ("Low Risk", "Medium Risk", "High Risk")


def label_fraction_thresholds(df: DataFrame, quorum: int | None = None) -> DataFrame:
    rules = banded_rules(FRACTION_LIMITS, LEVELS, EXPOSURE_HIGH_FRACTION, quorum)
    return risk_rules(df, rules, "Risk_Level", "Unknown")


def label_domain_thresholds(df: DataFrame, quorum: int | None = None) -> DataFrame:
    rules = [Rule("low", BANKER_LOW, quorum), Rule("medium", BANKER_MEDIUM, quorum)]
    return risk_rules(df, rules, "risk", "high")


def label_leverage_sketch(df: DataFrame, quorum: int | None = None) -> DataFrame:
    """Three tests, one on short-term liabilities over equity."""
    leverage = F.try_divide(column("short_term_liab"), column("tangible_net_worth"))
    rules = [Rule("low", LEVERAGE_LOW, quorum), Rule("medium", LEVERAGE_MEDIUM, quorum)]
    return risk_rules(df.withColumn("short_term_leverage", leverage), rules, "risk", "high")


# --- labels relative to the whole table ---------------------------------------------------------
def _with_shares(df: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[str], Column]]:
    df, totals = attach_row(df, {c: F.sum(column(c)) for c in names})
    return df, lambda c: F.try_divide(column(c), totals[c]) * 100


def _share_rules(names: Iterable[str], quorum: int | None = None) -> list[Rule]:
    low, high = PERCENT_LIMITS[0]
    names = list(names)
    return [
        Rule(LEVELS[0], {c: above(high) for c in names}, quorum),
        Rule(LEVELS[1], {c: within(low, high) for c in names}, quorum),
        Rule(LEVELS[2], {c: below(low) for c in names}, quorum),
    ]


def label_rank_row(
    ranks: DataFrame, names: Sequence[str] = S.FEATURES_THREE_CLASS, quorum: int | None = None
) -> DataFrame:
    """The rules of ``label_pct_of_sum_row`` on ranks in place of shares of the column total."""
    return risk_rules(ranks, _share_rules(names, quorum), "Risk_Level", "Unknown")


def label_rank_column(ranks: DataFrame, names: Sequence[str] = S.FEATURES_THREE_CLASS) -> DataFrame:
    """The rules of ``label_pct_of_sum_column`` on ranks; a null value has no rank and is Unknown."""
    return ranks.withColumns({f"{c}_Risk_Level": rule_label(_share_rules([c]), "Unknown") for c in names})


def label_pct_of_sum_row(df: DataFrame, names: list[str] = S.FEATURES_THREE_CLASS) -> DataFrame:
    """One label per row from each value's share of its column total."""
    df, share = _with_shares(df, names)
    return df.withColumn("Risk_Level", rule_label(_share_rules(names), "Unknown", share)).drop(ROW)


def label_pct_of_sum_column(df: DataFrame, names: list[str] = S.FEATURES_THREE_CLASS) -> DataFrame:
    """``<c>_Risk_Level`` per column from its share of the column total."""
    df, share = _with_shares(df, names)
    return df.withColumns(
        {f"{c}_Risk_Level": rule_label(_share_rules([c]), "Unknown", share) for c in names}
    ).drop(ROW)


def label_scaled_sum(df: DataFrame, quorum: int | None = None, scale: Callable = F.sum) -> DataFrame:
    """Limits are fractions of the column totals; profit and exposure always test above half.

    ``scale`` is the aggregate that the fractions are taken of, such as ``F.max`` for the largest value.
    """
    df, totals = attach_row(df, {c: scale(column(c)) for c in RULE_COLUMNS})
    measure_band, score_band = FRACTION_LIMITS
    always_above = {c: above(measure_band[1] * totals[c]) for c in ("profits_perc_TNW", "TNW_to_T-Exposure")}
    band = {c: score_band if c in SCORE_COLUMNS else measure_band for c in RULE_COLUMNS}
    rules = [
        Rule(LEVELS[0], {c: above(high * totals[c]) for c, (_, high) in band.items()}, quorum),
        Rule(
            LEVELS[1],
            {c: within(low * totals[c], high * totals[c]) for c, (low, high) in band.items()} | always_above,
            quorum,
        ),
        Rule(LEVELS[2], {c: below(low * totals[c]) for c, (low, _) in band.items()} | always_above, quorum),
    ]
    return risk_rules(df, rules, "Risk_Level", "Unknown").drop(ROW)


def label_percentile(df: DataFrame, quorum: int | None = None) -> DataFrame:
    """Low from the upper percentile on, Medium between the two; other rows get null."""
    band = {c: FRACTION_LIMITS[1] if c in SCORE_COLUMNS else FRACTION_LIMITS[0] for c in RULE_COLUMNS}
    found = exact_quantiles(df, RULE_COLUMNS, sorted({p for pair in band.values() for p in pair})).collect()
    limit = {(row["column"], row["prob"]): row["value"] for row in found}  # 3 numbers per column
    rules = [
        Rule("Low", {c: at_least(limit[c, high]) for c, (_, high) in band.items()}, quorum),
        Rule("Medium", {c: within(limit[c, low], limit[c, high]) for c, (low, high) in band.items()}, quorum),
    ]
    return risk_rules(df, rules, "risk", None)
