"""The registered queries: every operator applied to the credit tables.

The raw credit table and the prepared tables are written once per session and
input folder, the way the preparation writes one table that all later reports
read.  ``prepare_*`` queries run the preparation itself from the raw table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schema as S
from ledgerline.functions.ratios import discipline_score, rating_score
from ledgerline.functions.typing import column
from ledgerline.operators import columns as C
from ledgerline.operators import correlate, distribution, evaluate, filters, joins, missing, models
from ledgerline.operators import prepare, profile, rules, selection, split, synth
from ledgerline.plans import presets
from ledgerline.sources import tables
from ledgerline.sources.staging import new_path, stage
from ledgerline.sources.statements import PERIOD_YEARS, credit_raw, load_table

Query = Callable[[SparkSession, str], DataFrame]

_tables: dict[tuple[str, str, str], DataFrame] = {}


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A named table of the workload, written on first use in this session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        if name == "raw":
            made = credit_raw(spark, sf_dir)
        elif name in MODEL_INPUTS:
            return _tables.setdefault(key, MODEL_INPUTS[name](staged(spark, sf_dir, "canonical")))
        elif name == "ranks":
            made = rules.ranked(staged(spark, sf_dir, "three_class"), S.FEATURES_THREE_CLASS)
        else:
            made = getattr(presets, name)(staged(spark, sf_dir, "raw"))
        _tables[key] = stage(made, name)
    return _tables[key]


MODEL_INPUTS = {"prepared": models.prepared, "folded": selection.folded}


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round doubles, so that the order of float additions does not show."""
    return df.select(
        *[
            F.round(column(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else column(f.name)
            for f in df.schema
        ]
    )


QUERIES: dict[str, Query] = {}


def query(on: str | None = None, digits: int | None = None, name: str | None = None):
    """Register a query; ``on`` names the staged table it gets instead of a folder."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = function(staged(spark, sf_dir, on)) if on else function(spark, sf_dir)
            return rounded(result, digits) if digits is not None else result

        QUERIES[name or function.__name__] = run
        return function

    return register


def keyed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return C.select_contract(df, [S.KEY, *names])


# --- preparation, end to end ---------------------------------------------------------
@query(digits=4)
def adapter_credit_raw(spark, sf_dir):
    return C.cast_double(credit_raw(spark, sf_dir), S.RAW_NUMERIC)


@query(digits=4)
def adapter_credit_raw_all_years(spark, sf_dir):
    return adapter_credit_raw(spark, sf_dir)


@query(digits=4)
def adapter_credit_raw_fixed_years(spark, sf_dir):
    """The raw table with one named year for each period; orders of other years enter the totals only."""
    return C.cast_double(credit_raw(spark, sf_dir, PERIOD_YEARS), S.RAW_NUMERIC)


@query("raw", 4)
def prepare_canonical(raw):
    return presets.canonical(raw)


@query("raw", 4)
def prepare_binary_v1(raw):
    return presets.binary_v1(raw)


@query("raw", 4)
def prepare_three_class(raw):
    return presets.three_class(raw)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source tables to label balance; the raw table is written first, as the plan reads it twice."""
    return profile.class_counts(presets.canonical(staged(spark, sf_dir, "raw")), S.LABEL)


QUERIES["flagship_label_balance"] = flagship


# --- sources ---------------------------------------------------------------------------
@query(digits=4)
def scan_table(spark, sf_dir):
    staged(spark, sf_dir, "canonical").createOrReplaceTempView("crs_transformed")
    return tables.scan_table(spark, "crs_transformed")


@query("canonical", 4)
def write_table_overwrite(clean):
    spark = clean.sparkSession
    tables.write_table_overwrite(clean, tables.CLEAN_TABLE, new_path(spark, "crs_transformed"))
    return tables.scan_table(spark, tables.CLEAN_TABLE)


@query("canonical", 4)
def write_parquet(clean):
    path = new_path(clean.sparkSession, "write_parquet")
    tables.write_parquet(clean, path)
    return clean.sparkSession.read.parquet(path)


# --- projection, typing, scalars ------------------------------------------------------------
def _numeric(df: DataFrame) -> DataFrame:
    return C.cast_double(df, [c for c in S.RAW_NUMERIC if c in df.columns])


@query("raw")
def drop_columns(raw):
    return _numeric(C.drop_columns(raw, [*S.DROPPED, "not_a_column"]))


@query("raw")
def rename_columns(raw):
    return C.rename_columns(_numeric(raw), S.RENAMES_THREE_CLASS)


@query("canonical", 4)
def select_contract(clean):
    return C.select_contract(clean, S.CONTRACT_CANONICAL)


@query("raw")
def cast_double(raw):
    return keyed(C.cast_double(raw, S.RAW_NUMERIC), S.RAW_NUMERIC)


@query("raw")
def cast_int(raw):
    return keyed(C.cast_int(raw, S.RAW_NUMERIC), S.RAW_NUMERIC)


@query("canonical")
def narrow_to_int(clean):
    return keyed(C.narrow_to_int(clean), S.NARROWED_TO_INT)


@query("raw")
def cast_date(raw):
    names = ["fundation_year", *S.PERIOD_DATES]
    return keyed(C.cast_date(raw, names), names)


@query("raw")
def columns_by_type(raw):
    return C.columns_by_type_table(presets.three_class_typed(raw))


@query("canonical")
def table_shape(clean):
    return C.table_shape(clean)


@query("canonical", 4)
def head_rows(clean):
    return C.head_rows(clean, 25)


@query("raw")
def period_totals(raw):
    return keyed(C.period_totals(presets.canonical_typed(raw)), S.SUMMED)


@query("raw")
def net_profit_total(raw):
    typed = presets.canonical_typed(raw)
    compat = C.period_totals(typed, ["net_profit"]).withColumnRenamed("net_profit", "net_profit_compat")
    return keyed(
        C.period_totals(compat, ["net_profit"], compat_net_profit=False), ["net_profit_compat", "net_profit"]
    )


RATIO_QUERIES = {
    "ratio_debt_equity": "debt_equity_ratio",
    "ratio_debt_asset": "debt_asset_ratio",
    "ratio_interest_coverage": "interest_cov_ratio",
    "ratio_current": "current_ratio",
    "ratio_return_on_assets": "return_on_assets",
    "ratio_debt_service": "debt_ser_cov_ratio",
}


def _ratio_query(ratio: str):
    def run(raw):
        return keyed(C.add_ratios(C.period_totals(presets.canonical_typed(raw)), [ratio]), [ratio])

    return run


for _name, _ratio in RATIO_QUERIES.items():
    query("raw", name=_name)(_ratio_query(_ratio))


@query("raw")
def score_rating(raw):
    return raw.select(S.KEY, rating_score("credit_rating").alias("CR_Rating_score"))


@query("raw")
def score_discipline_strict(raw):
    return raw.select(S.KEY, discipline_score("payment_discipline", strict=True).alias("pmt_discipline_score"))


@query("raw")
def score_discipline_default(raw):
    return raw.select(S.KEY, discipline_score("payment_discipline").alias("pmt_discipline_score"))


@query("canonical", 6)
def log1p_features(clean):
    return C.log1p_features(clean, keep=[S.KEY])


# --- filters ------------------------------------------------------------------------------
NAMED = [S.KEY, "customer_name", "market", "credit_rating"]
MARKET = "NATION_7"


@query("raw")
def filter_placeholder_names(raw):
    return filters.filter_placeholder_names(raw).select(*NAMED)


@query("raw")
def filter_name_equals(raw):
    return filters.filter_equals(raw, "customer_name", "nan").select(*NAMED)


@query("raw")
def filter_name_not_equals(raw):
    return filters.filter_not_equals(raw, "customer_name", "0").select(*NAMED)


@query("raw")
def filter_market(raw):
    return filters.filter_equals(raw, "market", MARKET).select(*NAMED)


@query("canonical")
def filter_sql_predicate(clean):
    return filters.filter_sql_predicate(scorecard(clean), "label = 1 AND prediction = 1")


@query("binary_v1_features", 4)
def filter_drop_null_subset(features):
    return keyed(filters.filter_drop_null_subset(features, S.NULL_DROP_SUBSET), S.NULL_DROP_SUBSET)


BETWEEN = {"CR_Rating_score": (50, 100), "pmt_discipline_score": (25, 75), "current_ratio": (0.5, 5.0)} | {
    c: (-1.0, 1000.0) for c in rules.RULE_COLUMNS if c not in (*rules.SCORE_COLUMNS, "current_ratio")
}


@query("three_class")
def predicate_between(three):
    return three.select(S.KEY, filters.all_between(BETWEEN).alias("in_range"))


@query("raw")
def predicate_null_tests(raw):
    return filters.null_tests(raw, ["customer_name", "payment_discipline", "current_period_revenue"])


# --- missing data ----------------------------------------------------------------------------
TYPED_NUMERIC = presets.CANONICAL_NUMERIC


@query("raw")
def null_count_by_market(raw):
    return missing.null_count_by(C.cast_double(raw, S.RAW_NUMERIC), "market", S.RAW_COLUMNS)


@query("raw")
def null_total_by_market(raw):
    return missing.null_total_by(C.cast_double(raw, S.RAW_NUMERIC), "market", S.RAW_COLUMNS)


@query("binary_v1_features")
def null_count_by_column(features):
    return missing.null_profile(features, S.CONTRACT_V1).select("column", F.col("num_nulls").alias("null_count"))


@query("raw")
def null_nonnull_by_column(raw):
    return missing.null_profile(C.cast_double(raw, S.RAW_NUMERIC), S.RAW_COLUMNS)


@query("raw")
def impute_zero(raw):
    return keyed(missing.impute_zero(presets.canonical_typed(raw)), TYPED_NUMERIC)


@query("raw", 4)
def impute_mean_double(raw):
    return keyed(missing.impute_mean_double(presets.canonical_typed(raw)), TYPED_NUMERIC)


@query("raw")
def impute_mean_int(raw):
    typed = C.cast_int(filters.filter_placeholder_names(raw), S.RAW_NUMERIC)
    return keyed(missing.impute_mean_int(typed), S.RAW_NUMERIC)


@query("raw")
def null_to_zero_when(raw):
    names = ["profits_perc_TNW", "TNW_to_T-Exposure", "total_exposure"]
    return keyed(missing.null_to_zero(presets.canonical_typed(raw), names), names)


# --- joins ------------------------------------------------------------------------------------
@query("raw")
def join_fold_equi(raw):
    """The null counts of every raw column by market, folded on the market."""
    typed = C.cast_double(raw, S.RAW_NUMERIC)
    flags = [(f"null_{c}", typed, column(c).isNull().cast("long")) for c in S.RAW_COLUMNS]
    return joins.merge_sums(flags, "market")


@query("raw")
def join_fold_all_columns(raw):
    return join_fold_equi(raw)


@query("canonical", 4)
def join_by_row_id(clean):
    x, y = split.split_features_label(clean, ["revenue", "current_ratio"])
    return joins.join_on_key(x, y)


# --- aggregation and profiling -----------------------------------------------------------------
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("raw")
def agg_conditional_sum(raw):
    return missing.agg_conditional_sum(raw, "market", "customer_name")


@query("raw")
def agg_conditional_count(raw):
    return missing.agg_conditional_count(raw, "current_period_revenue")


@query("canonical", 4)
def agg_column_means(clean):
    return profile.column_means(clean, S.FEATURES)


@query("canonical", 2)
def agg_column_sums(clean):
    return profile.column_sums(clean, S.FEATURES)


@query("canonical", 3)
def describe(clean):
    return profile.describe(clean, S.FEATURES)


@query(digits=3)
def describe_lineitem(spark, sf_dir):
    return profile.describe(load_table(spark, sf_dir, "lineitem"), LINE_MEASURES)


@query("canonical", 3)
def summary_approx(clean):
    return profile.summary_approx(clean, S.FEATURES)


@query("canonical", 3)
def describe_exact(clean):
    return profile.describe_exact(clean, S.FEATURES)


@query(digits=3)
def describe_exact_lineitem(spark, sf_dir):
    return profile.describe_exact(load_table(spark, sf_dir, "lineitem"), LINE_MEASURES)


@query("canonical")
def class_counts(clean):
    return profile.class_counts(clean, S.LABEL)


@query("canonical", 6)
def class_ratio(clean):
    return profile.class_ratio(clean, S.LABEL)


@query("canonical", 6)
def class_percentages(clean):
    return profile.class_percentages(clean, S.LABEL)


@query(digits=6)
def class_percentages_quality(spark, sf_dir):
    return profile.class_percentages(load_table(spark, sf_dir, "labels"), "quality")


# --- statistics -----------------------------------------------------------------------------------
@query("three_class", 6)
def corr_matrix_dense(three):
    return correlate.corr_matrix_dense(three, S.FEATURES_THREE_CLASS)


@query("binary_v1_features", 6)
def corr_matrix_pairwise(features):
    return correlate.corr_matrix_pairwise(features, [*S.FEATURES_V1, S.LABEL])


@query("binary_v1_features", 6)
def corr_matrix_int(features):
    return correlate.corr_matrix_pairwise(C.narrow_to_int(features, S.FEATURES_V1), [*S.FEATURES_V1, S.LABEL])


@query("canonical", 6)
def corr_matrix_subset(clean):
    return correlate.corr_matrix_pairwise(clean, S.STATEMENT_COLUMNS)


@query("canonical", 6)
def corr_matrix_ratios(clean):
    return correlate.corr_matrix_pairwise(clean, S.RATIO_REPORT_COLUMNS)


@query("canonical", 6)
def corr_matrix_log1p(clean):
    return correlate.corr_matrix_log1p(clean, S.LOG_COLUMNS)


@query(digits=6)
def corr_matrix_lineitem(spark, sf_dir):
    return correlate.corr_matrix_pairwise(load_table(spark, sf_dir, "lineitem"), LINE_MEASURES)


@query("binary_v1_features")
def corr_prune(features):
    names = [*S.FEATURES_V1, S.LABEL]
    matrix = correlate.corr_matrix_pairwise(features, names)
    return correlate.corr_prune(matrix, names)


@query("binary_v1_features")
def corr_prune_first(features):
    names = [*S.FEATURES_V1, S.LABEL]
    matrix = correlate.corr_matrix_pairwise(features, names)
    return correlate.corr_prune(matrix, names, keep="first")


@query("canonical")
def zscore_outlier_count(clean):
    return distribution.zscore_outlier_count(C.log1p_features(clean), [f"log1p_{c}" for c in S.LOG_COLUMNS])


@query("canonical")
def zscore_outlier_count_omit(clean):
    return distribution.zscore_outlier_count(clean, S.FEATURES, nan_policy="omit")


@query(digits=None)
def zscore_outlier_count_events(spark, sf_dir):
    return distribution.zscore_outlier_count(load_table(spark, sf_dir, "events"), ["value"])


@query("canonical", 4)
def box_stats(clean):
    return distribution.box_stats(clean, S.FEATURES)


@query(digits=4)
def box_stats_lineitem(spark, sf_dir):
    return distribution.box_stats(load_table(spark, sf_dir, "lineitem"), LINE_MEASURES)


@query("canonical", 6)
def histogram_10(clean):
    return distribution.histogram(C.log1p_features(clean), [f"log1p_{c}" for c in S.LOG_COLUMNS], 10)


@query("canonical", 6)
def histogram_20(clean):
    return distribution.histogram(C.log1p_features(clean), [f"log1p_{c}" for c in S.LOG_COLUMNS], 20)


@query(digits=6)
def histogram_lineitem(spark, sf_dir):
    return distribution.histogram(load_table(spark, sf_dir, "lineitem"), LINE_MEASURES, 20)


@query("canonical", 6)
def kde_grid(clean):
    return distribution.kde_grid(clean, S.SCORES)


@query("canonical", 6)
def kde_grid_log1p(clean):
    return distribution.kde_grid(C.log1p_features(clean), [f"log1p_{c}" for c in S.LOG_COLUMNS])


@query("canonical", 6)
def kde_grid_log_columns(clean):
    return distribution.kde_grid(C.log1p_features(clean), [f"log1p_{c}" for c in S.LOG_COLUMNS])


@query("canonical", 4)
def box_stats_log_columns(clean):
    return distribution.box_stats(C.log1p_features(clean), [f"log1p_{c}" for c in S.LOG_COLUMNS])


@query("canonical", 6)
def linear_fit(clean):
    return distribution.linear_fit(clean, "CR_Rating_score", "pmt_discipline_score")


@query("canonical")
def pair_scatter(clean):
    return distribution.pair_scatter(C.log1p_features(clean), [f"log1p_{c}" for c in S.LOG_COLUMNS])


@query("canonical")
def hexbin_counts(clean):
    return distribution.hexbin_counts(clean, "profits_perc_TNW", "TNW_in_MEUR")


@query("canonical", 4)
def facet_by_label(clean):
    return distribution.box_stats(clean, ["profits_perc_TNW", "TNW_in_MEUR", "current_ratio"], S.LABEL)


@query("canonical", 6)
def facet_kde_by_label(clean):
    return distribution.kde_grid(clean, S.SCORES, by=S.LABEL)


@query("canonical")
def facet_scatter_by_label(clean):
    return distribution.hexbin_counts(clean, "profits_perc_TNW", "TNW_in_MEUR", by=S.LABEL)


@query("canonical", 4)
def chi_square_select(clean):
    return distribution.chi_square_select(clean, S.FEATURES, S.LABEL)


# --- rules and labels -------------------------------------------------------------------------------
@query("raw")
def label_binary(raw):
    return rules.label_binary(presets.canonical_features(raw)).select(S.KEY, S.LABEL)


@query("canonical")
def flag_liquidity(clean):
    return rules.flag_liquidity(clean).select(S.KEY, "liquid")


def _label_query(name: str, function, output: list[str]):
    def run(three):
        return function(three).select(S.KEY, *output)

    query("three_class", name=name)(run)


_label_query("label_risk_category", rules.label_risk_category, ["risk_category"])
_label_query("label_risk_num", lambda d: rules.label_risk_num(rules.label_domain_thresholds(d.drop("risk", "risk_num")), "risk"), ["risk", "risk_num"])
_label_query("label_high_explicit", rules.label_high_explicit, ["risk_category", "matched_rule"])
_label_query("label_fraction_thresholds", rules.label_fraction_thresholds, ["Risk_Level"])
_label_query("label_pct_of_sum_row", rules.label_pct_of_sum_row, ["Risk_Level"])
_label_query("label_scaled_sum", rules.label_scaled_sum, ["Risk_Level"])
_label_query("label_percentile", rules.label_percentile, ["risk"])
_label_query("label_domain_thresholds", rules.label_domain_thresholds, ["risk"])
_label_query(
    "label_pct_of_sum_column", rules.label_pct_of_sum_column, [f"{c}_Risk_Level" for c in S.FEATURES_THREE_CLASS]
)


@query("three_class", 6)
def label_leverage_sketch(three):
    return rules.label_leverage_sketch(three).select(S.KEY, "short_term_leverage", "risk")


# The limits of the rule tables lie outside the figures of these tables, so the queries above find few
# rows in their lower classes.  On percent ranks, or by a quorum of the tests, each rule meets rows.
BAND_QUORUM, DOMAIN_QUORUM, SCALED_QUORUM, ROW_QUORUM = 6, 3, 3, 14


def fractions(ranks: DataFrame) -> DataFrame:
    return ranks.select(S.KEY, *[(column(c) / 100).alias(c) for c in rules.RULE_COLUMNS])


@query("three_class", 6)
def percent_ranks(three):
    return rules.ranked(three, S.FEATURES_THREE_CLASS)


@query("ranks")
def label_risk_category_ranked(ranks):
    return rules.label_risk_category(ranks, BAND_QUORUM).select(S.KEY, "risk_category")


@query("ranks")
def label_risk_num_ranked(ranks):
    return rules.label_risk_num(rules.label_risk_category(ranks, BAND_QUORUM)).select(S.KEY, "risk_category", "risk_num")


@query("ranks")
def label_high_explicit_ranked(ranks):
    return rules.label_high_explicit(ranks, BAND_QUORUM).select(S.KEY, "risk_category", "matched_rule")


@query("ranks")
def label_fraction_thresholds_ranked(ranks):
    return rules.label_fraction_thresholds(fractions(ranks), BAND_QUORUM).select(S.KEY, "Risk_Level")


@query("ranks")
def label_rank_row(ranks):
    return rules.label_rank_row(ranks, quorum=ROW_QUORUM).select(S.KEY, "Risk_Level")


@query("ranks")
def label_rank_column(ranks):
    return rules.label_rank_column(ranks).select(S.KEY, *[f"{c}_Risk_Level" for c in S.FEATURES_THREE_CLASS])


_label_query("label_percentile_quorum", lambda d: rules.label_percentile(d, BAND_QUORUM), ["risk"])
_label_query("label_domain_thresholds_quorum", lambda d: rules.label_domain_thresholds(d, DOMAIN_QUORUM), ["risk"])
_label_query("label_scaled_max_quorum", lambda d: rules.label_scaled_sum(d, SCALED_QUORUM, F.max), ["Risk_Level"])


# --- feature preparation ---------------------------------------------------------------------------
@query("canonical", 4)
def assemble_features(clean):
    rows = prepare.assemble_features(clean, S.FEATURES)
    return rows.select(S.KEY, *prepare.vector_columns(rows, "features", S.FEATURES))


@query("canonical", 6)
def standardize(clean):
    _, rows = prepare.standardize(prepare.assemble_features(clean, S.FEATURES))
    return rows.select(S.KEY, *prepare.vector_columns(rows, "scaled_features", S.FEATURES))


@query("canonical", 6)
def standardize_population(clean):
    return keyed(prepare.standardize_columns(clean, S.FEATURES, ddof=0), S.FEATURES)


@query("canonical")
def split_random(clean):
    train, test = split.split_random(clean, [0.7, 0.3], seed=42)
    return profile.class_counts(
        train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))), "split"
    )


@query("canonical")
def split_hash(clean):
    return split.split_hash(clean).select(S.KEY, "split")


@query("canonical", 4)
def split_features_label(clean):
    """X and y, put together again by key."""
    x, y = split.split_features_label(clean, S.FEATURES)
    return joins.join_on_key(x, y)


@query("canonical", 4)
def features_frame(clean):
    """The X of ``split_features_label``."""
    return split.split_features_label(clean, S.FEATURES)[0]


@query("canonical")
def label_frame(clean):
    """The y of ``split_features_label``."""
    return split.split_features_label(clean, S.FEATURES)[1]


@query("canonical")
def cv_folds(clean):
    return split.cv_folds(clean).select(S.KEY, S.LABEL, "fold")


# --- models ---------------------------------------------------------------------------------------------
def _model_query(name: str, model: str):
    def run(data):
        return models.fit_and_score(model, data)

    query("prepared", 6, name=name)(run)


_model_query("logreg_binary", "logistic_regression")
_model_query("svm_linear", "linear_svm")
_model_query("naive_bayes_gaussian", "naive_bayes")
_model_query("decision_tree", "decision_tree")
_model_query("random_forest", "random_forest")


@query("canonical", 6)
def ml_pipeline(clean):
    """Assembler, scaler and classifier as one estimator, fitted on train rows only."""
    rows = stage(split.split_hash(clean, 0.8), "pipeline")
    classifier = models.estimators()["logistic_regression"]
    fitted = prepare.pipeline(S.FEATURES, classifier).fit(models.part(rows, "train"))
    return models.scored(fitted, models.part(rows, "test"))


def _rated(clean: DataFrame) -> DataFrame:
    """Three rating classes as label; the rating itself leaves the features."""
    band = F.when(F.col("CR_Rating_score") >= 75, 2).when(F.col("CR_Rating_score") >= 50, 1).otherwise(0)
    features = [c for c in S.FEATURES if c != "CR_Rating_score"]
    return models.prepared(clean.withColumn("risk_num", band), features, "risk_num", 0.8)


@query("canonical", 6)
def logreg_multinomial(clean):
    data = _rated(clean)
    return models.scored(models.fit_multinomial(data, "risk_num"), models.part(data, "test"), "risk_num")


@query(digits=6)
def logreg_multinomial_risk_num(spark, sf_dir):
    """The three-class model on the ranked risk number, scored on train and test rows."""
    ranks = staged(spark, sf_dir, "ranks")
    labels = rules.label_risk_num(rules.label_risk_category(ranks, BAND_QUORUM)).select(S.KEY, "risk_num")
    rows = staged(spark, sf_dir, "three_class").drop("risk", "risk_num").join(labels, S.KEY)
    data = models.prepared(rows, S.FEATURES_THREE_CLASS, "risk_num")
    return models.split_report(models.fit_multinomial(data, "risk_num"), data, "risk_num")


@query("canonical", 4)
def logreg_coefficients(clean):
    features = [c for c in S.FEATURES if c != "CR_Rating_score"]
    return models.coefficients(models.fit_multinomial(_rated(clean), "risk_num"), features)


@query(digits=6)
def logreg_multinomial_embeddings(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector

    rows = load_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(S.KEY), "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    data = stage(split.split_hash(rows, 0.8), "embeddings")
    model = models.fit_multinomial(data, "label", "features")
    return evaluate.class_metrics(
        model.transform(models.part(data, "test")).select("label", "prediction")
    )


@query("prepared", 6)
def svm_linear_holdout(data):
    return models.holdout_scored(data)


@query("canonical", 6)
def naive_bayes_params(clean):
    scaled = prepare.standardize_columns(clean, S.FEATURES, ddof=1)
    return models.naive_bayes_params(scaled, S.FEATURES)


@query("folded", 6)
def gridsearch_logreg(data):
    return selection.gridsearch_logreg(data)


@query("folded", 6)
def gridsearch_svm(data):
    return selection.gridsearch_svm(data)


@query("folded", 6)
def gridsearch_nb(data):
    return selection.gridsearch_nb(data)


@query("folded", 6)
def tuned_logreg(data):
    return selection.tuned_logreg(data)


@query("folded", 6)
def tuned_svm(data):
    return selection.tuned_svm(data)


@query("folded", 6)
def tuned_nb(data):
    return selection.tuned_nb(data)


@query("prepared", 6)
def perceptron_report(data):
    """Accuracy, report and confusion of the neural net on train and test rows."""
    return selection.model_report(models.scored(models.fit_perceptron(data, len(S.FEATURES)), data))


@query("prepared", 6)
def mlp_classifier(data):
    return models.scored(models.fit_perceptron(data, len(S.FEATURES)), models.part(data, "test"))


# --- evaluation -----------------------------------------------------------------------------------------
CUTOFF = 150


def scorecard(clean: DataFrame) -> DataFrame:
    """A fixed score, so that evaluation results do not hang on a fit."""
    liquidity = F.least(F.greatest(F.col("current_ratio"), F.lit(0.0)), F.lit(10.0))
    score = F.round(F.col("CR_Rating_score") + F.col("pmt_discipline_score") + 10 * liquidity, 6)
    return clean.select(
        S.KEY,
        F.col(S.LABEL).alias("label"),
        score.alias("score"),
        F.when(score > CUTOFF, 1).otherwise(0).alias("prediction"),
    )


def three_way(clean: DataFrame) -> DataFrame:
    """Rating band as label, discipline band as prediction."""

    def band(name):
        return F.when(F.col(name) >= 75, 2).when(F.col(name) >= 50, 1).otherwise(0)

    return clean.select(
        S.KEY, band("CR_Rating_score").alias("label"), band("pmt_discipline_score").alias("prediction")
    )


def _evaluation(name: str, function, digits: int | None = 6, frame=scorecard):
    def run(clean):
        return function(frame(clean))

    query("canonical", digits, name=name)(run)


_evaluation("auc_roc", evaluate.auc_roc)
_evaluation("auc_pr", evaluate.auc_pr)
_evaluation("roc_auc_trapezoid", evaluate.roc_auc_trapezoid)
_evaluation("roc_curve", evaluate.roc_curve)
_evaluation("accuracy", lambda d: evaluate.class_metric(d, "accuracy"))
_evaluation("weighted_precision", lambda d: evaluate.class_metric(d, "weighted_precision"))
_evaluation("weighted_recall", lambda d: evaluate.class_metric(d, "weighted_recall"))
_evaluation("weighted_f1", lambda d: evaluate.class_metric(d, "weighted_f1"))
_evaluation("confusion_matrix", evaluate.confusion_matrix)
_evaluation("confusion_matrix_three", evaluate.confusion_matrix, frame=three_way)
_evaluation("binary_rates", evaluate.binary_rates)
_evaluation("binary_rates_class0", evaluate.binary_rates_class0)
_evaluation("binary_rates_class0_compat", lambda d: evaluate.binary_rates_class0(d, compat=True))
_evaluation("classification_report", evaluate.classification_report)
_evaluation("classification_report_three", evaluate.classification_report, frame=three_way)


@query("prepared", 6)
def score_default_probability(data):
    return models.probability_table(data)


@query("prepared", 6)
def score_customer_table(data):
    return models.customer_table(data)


@query("prepared", 6)
def model_comparison(data):
    return models.compare(data)


@query("prepared")
def fit_score_timing(data):
    return models.timing(data)


# --- synthetic data ------------------------------------------------------------------------------------------
SYNTHETIC = [*S.FEATURES, S.LABEL]


@query("canonical", 4)
def copula_metadata(clean):
    return synth.metadata(clean, SYNTHETIC)


@query("canonical", 4)
def copula_beta_shape(clean):
    return synth.beta_shape(clean, SYNTHETIC).drop("decimals")


@query("canonical", 4)
def copula_fit(clean):
    return synth.correlation_table(clean.sparkSession, synth.fit(clean, SYNTHETIC))


@query("canonical", 6)
def copula_sample(clean):
    return synth.sample(clean.sparkSession, synth.fit(clean, SYNTHETIC), clean.count())


@query("canonical", 6)
def synthetic_vs_real(clean):
    synthetic = synth.sample(clean.sparkSession, synth.fit(clean, SYNTHETIC), clean.count())
    return synth.compare(clean, synthetic, S.LABEL, S.FEATURES)
