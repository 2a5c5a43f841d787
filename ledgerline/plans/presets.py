"""The three preparation plans.  They differ on purpose; see the README table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline import schema as S
from ledgerline.operators import columns as C
from ledgerline.operators import filters, missing, rules

RENAMED_NUMERIC = [S.RENAMES.get(c, c) for c in S.RAW_NUMERIC]
CANONICAL_NUMERIC = [c for c in RENAMED_NUMERIC if c != "YRS_In_BUS"]


def _with_key(names: list[str]) -> list[str]:
    return [S.KEY, *names]


def canonical_typed(raw: DataFrame) -> DataFrame:
    """Dropped, filtered, renamed and cast; nothing filled yet."""
    named = C.rename_columns(filters.filter_placeholder_names(C.drop_columns(raw, S.DROPPED)), S.RENAMES)
    return C.cast_double(named, CANONICAL_NUMERIC)


def canonical_features(raw: DataFrame) -> DataFrame:
    filled = missing.impute_mean_double(canonical_typed(raw))
    scored = C.add_scores(C.period_totals(filled, S.SUMMED_CANONICAL))
    return C.drop_columns(C.add_ratios(scored, S.RATIOS_CANONICAL), S.CONSUMED)


def canonical(raw: DataFrame) -> DataFrame:
    """Binary label, mean fill: the 25-column modelling table (plus the key)."""
    labelled = rules.label_binary(canonical_features(raw))
    return C.select_contract(missing.impute_zero(labelled), _with_key(S.CONTRACT_CANONICAL))


def binary_v1_features(raw: DataFrame) -> DataFrame:
    named = C.rename_columns(C.drop_columns(raw, S.DROPPED), S.RENAMES)
    typed = C.cast_int(filters.filter_placeholder_names(named), RENAMED_NUMERIC)
    filled = missing.impute_mean_int(C.cast_date(typed, S.DATE_COLUMNS_SHORT))
    featured = C.add_ratios(C.add_scores(C.period_totals(filled)))
    return rules.label_binary(C.drop_columns(featured, S.CONSUMED))


def binary_v1(raw: DataFrame) -> DataFrame:
    """Binary label on whole-number inputs: the 29-column table (plus the key)."""
    whole = filters.filter_drop_null_subset(binary_v1_features(raw), S.NULL_DROP_SUBSET)
    return C.select_contract(whole, _with_key(S.CONTRACT_V1))


def three_class_typed(raw: DataFrame) -> DataFrame:
    typed = C.cast_double(C.drop_columns(raw, S.DROPPED_THREE_CLASS), S.RAW_NUMERIC)
    dated = C.cast_date(missing.impute_zero(typed), ["fundation_year", *S.PERIOD_DATES])
    return C.rename_columns(dated, S.RENAMES_THREE_CLASS)


def three_class_features(raw: DataFrame) -> DataFrame:
    summed = C.period_totals(three_class_typed(raw))
    scored = C.add_scores(summed, strict_discipline=True)
    return missing.impute_zero(C.add_ratios(scored))


def three_class(raw: DataFrame) -> DataFrame:
    """Low / Medium / High label, zero fill: the 34-column table (plus the key)."""
    labelled = rules.label_risk_num(rules.label_risk_category(three_class_features(raw)))
    named = C.rename_columns(labelled, {"risk_category": "risk"})
    return C.select_contract(named, _with_key(S.CONTRACT_THREE_CLASS))
