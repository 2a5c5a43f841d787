"""Column names, score maps and output contracts of the credit table.

All names and numbers in this module are fixed values: they have to equal the
column names and constants of the data model for results to be right.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "contract_id"

# --- fixed values: the repeating group of three reporting periods ------------
PERIODS = {
    "CP": "current_period",
    "LP": "last_period",
    "PBLP": "period_before_last_period",
}

# measure name in the source -> short name
MEASURES = {
    "number_months": "number_months",
    "revenue": "revenue",
    "EBIT": "EBIT",
    "depreciation": "depreciation",
    "net_profit": "net_profit",
    "fixed_assets": "fixed_assets",
    "intangible_assets": "intangible_assets",
    "current_assets": "current_assets",
    "tangible_net_worth": "tangible_net_worth",
    "long_term_liabilities": "long_term_liab",
    "long_term_credit": "long_term_credit",
    "short_term_liabilities": "short_term_liab",
    "short_term_credit": "short_term_credit",
    "off_balance_liabilities": "off_balance_liab",
}

# measures that are summed over the three periods (all but the month count)
SUMMED = [short for short in MEASURES.values() if short != "number_months"]
SUMMED_CANONICAL = [m for m in SUMMED if m not in ("short_term_credit", "off_balance_liab")]

# --- fixed values: the other source columns ----------------------------------
IDENTITY = ["customer_name", "VAT_number", "legal_form", "market", "quote_id", "type_of_data"]
RATING = ["credit_rating", "payment_discipline"]
SIZE = [
    "years_in_business",
    "TNW_in_MEUR",
    "profits_perc_TNW",
    "positive_working_capital",
    "TNW_to_total_exposure",
    "fleet_size",
    "total_exposure",
]
FOUNDING = ["fundation_year", "fundation_month", "fundation_day"]
FLEET_DETAIL = [
    "fleet_own_trucks",
    "fleet_vfs_trucks",
    "fleet_other_trucks",
    "fleet_own_EC",
    "fleet_vfs_EC",
    "fleet_other_EC",
]
OFFERS = [
    "Offer_number_1",
    "Offer_number_2",
    "Offer_number_3",
    "type_of_request",
    "flag_domestic_use",
    "vfs_customer",
    "vfs_known_since",
    "financial_performance_currency",
]
CURRENCY = ["financing_currency"]
PERIOD_DATES = list(PERIODS.values())


def period_columns(short: bool = False) -> list[str]:
    """All period measures, source names or short names, period by period."""
    if short:
        return [f"{p}_{m}" for p in PERIODS for m in MEASURES.values()]
    return [f"{p}_{m}" for p in PERIODS.values() for m in MEASURES]


RAW_COLUMNS = (
    IDENTITY + RATING + SIZE + FOUNDING + FLEET_DETAIL + OFFERS + CURRENCY + PERIOD_DATES + period_columns()
)
RAW_NUMERIC = SIZE + period_columns()

RAW_SCHEMA = T.StructType(
    [T.StructField(KEY, T.LongType(), False)] + [T.StructField(c, T.StringType()) for c in RAW_COLUMNS]
)

# --- fixed values: renames ------------------------------------------------------
RENAMES = {
    "credit_rating": "CR_Rating",
    "years_in_business": "YRS_In_BUS",
    "positive_working_capital": "Positive_WC",
    "TNW_to_total_exposure": "TNW_to_T-Exposure",
    "payment_discipline": "pmt_discipline",
    "current_period": "current_period(CP)",
    "last_period": "last_period(LP)",
    "period_before_last_period": "period_before_last_period(PBLP)",
    **{f"{long}_{m}": f"{p}_{s}" for p, long in PERIODS.items() for m, s in MEASURES.items()},
}
RENAMES_THREE_CLASS = {**RENAMES, "fundation_year": "Date_of_Est. "}
DATE_COLUMNS_SHORT = ["current_period(CP)", "last_period(LP)", "period_before_last_period(PBLP)"]

# --- fixed values: columns every preparation drops first ----------------------------
DROPPED = (
    ["VAT_number", "legal_form", "quote_id", "type_of_data", "fundation_month", "fundation_day", "fundation_year"]
    + FLEET_DETAIL
    + OFFERS
)
DROPPED_THREE_CLASS = [c for c in DROPPED if c != "fundation_year"]

# intermediate columns no longer needed once totals, scores and ratios exist
CONSUMED = (
    ["financing_currency", "pmt_discipline", "market", "YRS_In_BUS", "CR_Rating"]
    + DATE_COLUMNS_SHORT
    + period_columns(short=True)
)

# --- fixed values: placeholder names and score maps -----------------------------------
PLACEHOLDER_NAMES = ["0", "null", "nan"]
RATING_SCORES = {"A": 100, "B": 75, "C": 50, "D": 25}
DISCIPLINE_STRICT = {"Excellent": 100, "Good": 75, "Fair": 50, "Bad": 25, "None": 0}
DISCIPLINE_LENIENT = {"Excellent": 100, "Good": 75, "Fair": 50}
DISCIPLINE_LENIENT_DEFAULT = 25

# --- fixed values: financial ratios, numerator over denominator -----------------------
RATIOS = {
    "debt_equity_ratio": (["long_term_liab", "short_term_liab"], ["tangible_net_worth"]),
    "debt_asset_ratio": (
        ["long_term_liab", "short_term_liab"],
        ["fixed_assets", "intangible_assets", "current_assets"],
    ),
    "interest_cov_ratio": (["EBIT"], ["short_term_credit"]),
    "current_ratio": (["current_assets"], ["short_term_liab"]),
    "return_on_assets": (["net_profit"], ["fixed_assets", "intangible_assets", "current_assets"]),
    "debt_ser_cov_ratio": (["net_profit", "depreciation"], ["short_term_credit", "long_term_credit"]),
}
RATIOS_CANONICAL = ["debt_equity_ratio", "debt_asset_ratio", "current_ratio", "return_on_assets"]

# --- fixed values: output contracts ----------------------------------------------------
LABEL = "target_variable"
SIZE_SHORT = ["TNW_in_MEUR", "profits_perc_TNW", "Positive_WC", "TNW_to_T-Exposure", "fleet_size", "total_exposure"]
SCORES = ["CR_Rating_score", "pmt_discipline_score"]

FEATURES = SIZE_SHORT + SUMMED_CANONICAL + SCORES + RATIOS_CANONICAL
CONTRACT_CANONICAL = ["customer_name", *FEATURES, LABEL]

FEATURES_V1 = SIZE_SHORT + SUMMED + SCORES + list(RATIOS)
CONTRACT_V1 = ["customer_name", *FEATURES_V1, LABEL]

FEATURES_THREE_CLASS = ["YRS_In_BUS", *FEATURES_V1]
CONTRACT_THREE_CLASS = [
    "customer_name",
    "CR_Rating",
    "YRS_In_BUS",
    "TNW_in_MEUR",
    "profits_perc_TNW",
    "Positive_WC",
    "TNW_to_T-Exposure",
    "financing_currency",
    "fleet_size",
    "pmt_discipline",
    "total_exposure",
    *SUMMED,
    *SCORES,
    *RATIOS,
    "risk",
    "risk_num",
]

# --- fixed values: column groups of the exploratory reports --------------------------------
LOG_COLUMNS = [
    "intangible_assets",
    "current_assets",
    "tangible_net_worth",
    "long_term_liab",
    "long_term_credit",
    "short_term_liab",
    "CR_Rating_score",
    "pmt_discipline_score",
    "debt_equity_ratio",
    "debt_asset_ratio",
    "current_ratio",
    "return_on_assets",
]
NARROWED_TO_INT = FEATURES[: FEATURES.index("debt_equity_ratio") + 1]
STATEMENT_COLUMNS = SUMMED_CANONICAL + SCORES
RATIO_REPORT_COLUMNS = (
    SIZE_SHORT + ["long_term_liab", "long_term_credit", "short_term_liab"] + SCORES + RATIOS_CANONICAL + [LABEL]
)
NULL_DROP_SUBSET = ["debt_equity_ratio", "debt_asset_ratio", "interest_cov_ratio", "CR_Rating_score"]
