"""One SQL statement per registered query that SQL can express."""

from __future__ import annotations

import math
from itertools import combinations

from ledgerline import schema as S
from oracles import labels as L
from oracles.base import (
    CANONICAL_NUMERIC,
    LINES,
    NAMED,
    NUMERIC,
    _raw,
    cols,
    lit,
    q,
    ratio,
    rnd,
    rnds,
    score,
    total,
    totals,
    with_tables,
)

SQL: dict[str, str] = {}
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def raw(name: str, body: str) -> None:
    SQL[name] = with_tables("raw", body)


def clean(name: str, body: str) -> None:
    SQL[name] = with_tables("clean", body)


def v1(name: str, body: str) -> None:
    SQL[name] = with_tables("v1", body)


def three(name: str, body: str) -> None:
    SQL[name] = with_tables("three", body)


def rest(names, numeric):
    return [c for c in names if c not in numeric]


# --- preparation -----------------------------------------------------------------------
_text = [c for c in S.RAW_COLUMNS if c not in S.RAW_NUMERIC]
raw("adapter_credit_raw", f"SELECT contract_id, {cols(_text)}, {rnds(S.RAW_NUMERIC, 4)} FROM raw")

_doubles = [c for c in S.FEATURES if c not in S.SCORES]
_canonical = f"contract_id, customer_name, {rnds(_doubles, 4)}, {cols([*S.SCORES, S.LABEL])}"
clean("prepare_canonical", f"SELECT {_canonical} FROM clean")
for _name in ("scan_table", "write_table_overwrite", "write_parquet"):
    clean(_name, f"SELECT {_canonical} FROM clean")
clean(
    "select_contract",
    f"SELECT customer_name, {rnds(_doubles, 4)}, {cols([*S.SCORES, S.LABEL])} FROM clean",
)
clean("head_rows", f"SELECT {_canonical} FROM clean ORDER BY contract_id LIMIT 25")
clean("flagship_label_balance", "SELECT target_variable, count(*) AS n FROM clean GROUP BY ALL")
v1(
    "prepare_binary_v1",
    f"SELECT contract_id, customer_name, {cols([*S.SIZE_SHORT, *S.SUMMED, *S.SCORES])}, "
    f"{rnds(S.RATIOS, 4)}, target_variable FROM v1",
)
_three_doubles = ["YRS_In_BUS", *S.SIZE_SHORT, *S.SUMMED, *S.RATIOS]
three(
    "prepare_three_class",
    f"SELECT contract_id, {cols(rest(S.CONTRACT_THREE_CLASS, _three_doubles))}, {rnds(_three_doubles, 4)} FROM three",
)

# --- projection, typing, scalars ------------------------------------------------------------
raw("drop_columns", f"SELECT contract_id, {cols(c for c in S.RAW_COLUMNS if c not in S.DROPPED)} FROM raw")
raw(
    "rename_columns",
    "SELECT contract_id, "
    + ", ".join(f"{q(c)} AS {q(S.RENAMES_THREE_CLASS.get(c, c))}" for c in S.RAW_COLUMNS)
    + " FROM raw",
)
raw("cast_double", f"SELECT contract_id, {cols(S.RAW_NUMERIC)} FROM raw")
raw(
    "cast_int",
    "SELECT contract_id, "
    + ", ".join(f"TRY_CAST(trunc({q(c)}) AS INTEGER) AS {q(c)}" for c in S.RAW_NUMERIC)
    + " FROM raw",
)
clean(
    "narrow_to_int",
    "SELECT contract_id, "
    + ", ".join(f"TRY_CAST(trunc({q(c)}) AS INTEGER) AS {q(c)}" for c in S.NARROWED_TO_INT)
    + " FROM clean",
)
raw(
    "cast_date",
    "SELECT contract_id, CAST(fundation_year || '-01-01' AS DATE) AS fundation_year, "
    + ", ".join(f"CAST({c} AS DATE) AS {c}" for c in S.PERIOD_DATES)
    + " FROM raw",
)
_typed_three = [
    ("contract_id", "bigint", "numeric"),
    *[
        (
            S.RENAMES_THREE_CLASS.get(c, c),
            *(
                ("double", "numeric")
                if c in S.RAW_NUMERIC
                else ("date", "date")
                if c in ("fundation_year", *S.PERIOD_DATES)
                else ("string", "text")
            ),
        )
        for c in S.RAW_COLUMNS
        if c not in S.DROPPED_THREE_CLASS
    ],
]
_source = {S.RENAMES_THREE_CLASS.get(c, c): c for c in S.RAW_COLUMNS}
raw(
    "columns_by_type",
    " UNION ALL ".join(
        f'SELECT {lit(a)} AS "column", {lit(b)} AS data_type, {lit(c)} AS type_class, '
        f"{'count(*)' if c == 'numeric' else f'count({_source[a]})'} AS n_values FROM raw"
        for a, b, c in _typed_three
    ),
)
_clean_names = ["contract_id", *S.CONTRACT_CANONICAL]
clean(
    "table_shape",
    f"SELECT count(*) AS n_rows, {len(_clean_names)} AS n_columns, {lit(', '.join(_clean_names))} AS column_names FROM clean",
)
clean("period_totals", f"SELECT contract_id, {totals(S.SUMMED)} FROM typed")
clean(
    "net_profit_total",
    f"SELECT contract_id, {total('net_profit')} AS net_profit_compat, {total('net_profit', False)} AS net_profit FROM typed",
)
for _name, _ratio in {
    "ratio_debt_equity": "debt_equity_ratio",
    "ratio_debt_asset": "debt_asset_ratio",
    "ratio_interest_coverage": "interest_cov_ratio",
    "ratio_current": "current_ratio",
    "ratio_return_on_assets": "return_on_assets",
    "ratio_debt_service": "debt_ser_cov_ratio",
}.items():
    clean(
        _name,
        f"SELECT contract_id, {ratio(_ratio)} AS {_ratio} FROM (SELECT contract_id, {totals(S.SUMMED)} FROM typed)",
    )
raw("score_rating", f'SELECT contract_id, {score("credit_rating", S.RATING_SCORES)} AS "CR_Rating_score" FROM raw')
raw(
    "score_discipline_strict",
    f"SELECT contract_id, {score('payment_discipline', S.DISCIPLINE_STRICT)} AS pmt_discipline_score FROM raw",
)
raw(
    "score_discipline_default",
    f"SELECT contract_id, {score('payment_discipline', S.DISCIPLINE_LENIENT, '25')} AS pmt_discipline_score FROM raw",
)


def log1p(c: str) -> str:
    return f"(CASE WHEN {q(c)} > -1 THEN ln(1e0 + {q(c)}) END)"


LOGS = [f"log1p_{c}" for c in S.LOG_COLUMNS]
LOGGED = "(SELECT contract_id, " + ", ".join(f"{log1p(c)} AS {q('log1p_' + c)}" for c in S.LOG_COLUMNS) + " FROM clean)"
clean("log1p_features", f"SELECT contract_id, {rnds(LOGS, 6)} FROM {LOGGED}")

# --- filters -------------------------------------------------------------------------------
_named = "contract_id, customer_name, market, credit_rating"
raw("filter_placeholder_names", f"SELECT {_named} FROM raw WHERE {NAMED}")
raw("filter_name_equals", f"SELECT {_named} FROM raw WHERE customer_name = 'nan'")
raw("filter_name_not_equals", f"SELECT {_named} FROM raw WHERE customer_name <> '0'")
raw("filter_market", f"SELECT {_named} FROM raw WHERE market = 'NATION_7'")
SCORED = (
    "(SELECT contract_id, label, score, CASE WHEN score > 150 THEN 1 ELSE 0 END AS prediction FROM ("
    "SELECT contract_id, target_variable AS label, "
    + rnd('"CR_Rating_score" + pmt_discipline_score + 10 * least(greatest(current_ratio, 0e0), 10e0)', 6, "score")
    + " FROM clean))"
)
clean(
    "filter_sql_predicate",
    f"SELECT contract_id, label, score, prediction FROM {SCORED} WHERE label = 1 AND prediction = 1",
)
_subset = [c for c in S.NULL_DROP_SUBSET if c != "CR_Rating_score"]
v1("filter_drop_null_subset", f'SELECT contract_id, {rnds(_subset, 4)}, "CR_Rating_score" FROM v1')
_between = {"CR_Rating_score": (50, 100), "pmt_discipline_score": (25, 75), "current_ratio": (0.5, 5.0)} | {
    c: (-1.0, 1000.0) for c in L.MEASURES if c != "current_ratio"
}
three(
    "predicate_between",
    "SELECT contract_id, "
    + " AND ".join(f"{q(c)} BETWEEN {a} AND {b}" for c, (a, b) in _between.items())
    + " AS in_range FROM three",
)
raw(
    "predicate_null_tests",
    "SELECT contract_id, "
    + ", ".join(
        f"{c} IS NULL AS {c}_is_null, {c} IS NOT NULL AS {c}_is_not_null"
        for c in ("customer_name", "payment_discipline", "current_period_revenue")
    )
    + " FROM raw",
)


# --- missing data -------------------------------------------------------------------------------
def nulls(c: str) -> str:
    return f"count(*) FILTER (WHERE {q(c)} IS NULL)"


_counted = [c for c in S.RAW_COLUMNS if c != "market"]
_all_nulls = " + ".join(nulls(c) for c in _counted)
raw(
    "null_count_by_market",
    "SELECT market, "
    + ", ".join(f"{nulls(c)} AS {q(c)}" for c in _counted)
    + f", {_all_nulls} AS total_nulls FROM raw WHERE market IS NOT NULL GROUP BY market",
)
raw("null_total_by_market", f"SELECT market, {_all_nulls} AS total_nulls FROM raw WHERE market IS NOT NULL GROUP BY market")


def long_union(names, make, source: str) -> str:
    """One row per column from aggregates over ``source``."""
    return " UNION ALL ".join(f'SELECT {lit(c)} AS "column", {make(c)} FROM {source}' for c in names)


v1("null_count_by_column", long_union(S.CONTRACT_V1, lambda c: f"{nulls(c)} AS null_count", "v1_features"))
raw(
    "null_nonnull_by_column",
    long_union(S.RAW_COLUMNS, lambda c: f"{nulls(c)} AS num_nulls, count({q(c)}) AS num_not_nulls", "raw"),
)
clean(
    "impute_zero",
    "SELECT contract_id, " + ", ".join(f"coalesce({q(c)}, 0) AS {q(c)}" for c in CANONICAL_NUMERIC) + " FROM typed",
)
clean("impute_mean_double", f"SELECT contract_id, {rnds(CANONICAL_NUMERIC, 4)} FROM filled")
_back = {S.RENAMES.get(c, c): c for c in S.RAW_NUMERIC}
v1(
    "impute_mean_int",
    "SELECT contract_id, " + ", ".join(f"{q(c)} AS {q(_back[c])}" for c in NUMERIC) + " FROM v1_filled",
)
_zeroed = ["profits_perc_TNW", "TNW_to_T-Exposure", "total_exposure"]
clean(
    "null_to_zero_when",
    "SELECT contract_id, " + ", ".join(f"coalesce({q(c)}, 0) AS {q(c)}" for c in _zeroed) + " FROM typed",
)

# --- joins ------------------------------------------------------------------------------------------
for _name in ("join_fold_equi", "join_fold_all_columns"):
    raw(_name, "SELECT market, " + ", ".join(f"{nulls(c)} AS {q('null_' + c)}" for c in S.RAW_COLUMNS) + " FROM raw GROUP BY market")
clean(
    "join_by_row_id",
    f"SELECT contract_id, {rnds(['revenue', 'current_ratio'], 4)}, target_variable FROM clean",
)

# --- aggregation and profiling ---------------------------------------------------------------------------
raw("agg_conditional_sum", f"SELECT market, {nulls('customer_name')} AS n_null FROM raw GROUP BY market")
raw(
    "agg_conditional_count",
    f"SELECT {nulls('current_period_revenue')} AS num_nulls, count(current_period_revenue) AS num_not_nulls FROM raw",
)


def stats(names, source: str, wanted: dict[str, str], digits: int) -> str:
    def one(c, stat):
        value = rnd(f"CAST({wanted[stat].format(q(c))} AS DOUBLE)", digits, "value")
        return f'SELECT {lit(c)} AS "column", {lit(stat)} AS stat, {value} FROM {source}'

    return " UNION ALL ".join(one(c, stat) for c in names for stat in wanted)


BASIC = {
    "count": "count({})",
    "mean": "avg({})",
    "stddev": "stddev_samp({})",
    "min": "min({})",
    "max": "max({})",
}
QUARTILES = {p: "quantile_cont(CAST({} AS DOUBLE), " + str(v) + ")" for p, v in {"25%": 0.25, "50%": 0.5, "75%": 0.75}.items()}
clean("agg_column_means", stats(S.FEATURES, "clean", {"mean": "avg({})"}, 4))
clean("agg_column_sums", stats(S.FEATURES, "clean", {"sum": "sum({})"}, 2))
clean("describe", stats(S.FEATURES, "clean", BASIC, 3))
clean("describe_exact", stats(S.FEATURES, "clean", BASIC | QUARTILES, 3))
SQL["describe_lineitem"] = stats(LINE, "lineitem", BASIC, 3)
SQL["describe_exact_lineitem"] = stats(LINE, "lineitem", BASIC | QUARTILES, 3)
clean("class_counts", "SELECT target_variable, count(*) AS n FROM clean GROUP BY ALL")
clean(
    "class_ratio",
    "SELECT min(n) AS minority, max(n) AS majority, "
    + rnd("min(n) / max(n)", 6, "ratio")
    + " FROM (SELECT count(*) AS n FROM clean GROUP BY target_variable)",
)
_share = rnd("count(*) * 100 / sum(count(*)) OVER ()", 6, "percentage")
clean("class_percentages", f"SELECT target_variable, count(*) AS n, {_share} FROM clean GROUP BY target_variable")
SQL["class_percentages_quality"] = f"SELECT quality, count(*) AS n, {_share} FROM labels GROUP BY quality"


# --- statistics --------------------------------------------------------------------------------------------
def correlation(names, source: str, value="{}") -> str:
    """Long matrix; pairs where either column is constant give null."""
    parts = []
    for a in names:
        for b in names:
            x, y = value.format(q(a)), value.format(q(b))
            both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
            flat = f"min({x}) {both} = max({x}) {both} OR min({y}) {both} = max({y}) {both}"
            r = f"CASE WHEN {flat} THEN NULL ELSE corr({x}, {y}) END"
            parts.append(f"SELECT {lit(a)} AS column_i, {lit(b)} AS column_j, {rnd(r, 6, 'r')} FROM {source}")
    return " UNION ALL ".join(parts)


def pair_table(names, source: str, value="{}") -> str:
    """The same matrix from one scan per pair set, for wide column lists."""
    names = list(names)
    fields, rows = [], []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            if j < i:
                continue
            x, y = value.format(q(a)), value.format(q(b))
            both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
            flat = f"min({x}) {both} = max({x}) {both} OR min({y}) {both} = max({y}) {both}"
            fields.append(f"CASE WHEN {flat} THEN NULL ELSE corr({x}, {y}) END AS r{i}_{j}")
            rows.append((a, b, f"r{i}_{j}"))
            if i != j:
                rows.append((b, a, f"r{i}_{j}"))
    unioned = " UNION ALL ".join(
        f"SELECT {lit(a)} AS column_i, {lit(b)} AS column_j, {rnd(f, 6, 'r')} FROM pairs" for a, b, f in rows
    )
    return f"pairs AS (SELECT {', '.join(fields)} FROM {source})", unioned


def corr_query(register, name: str, names, source: str, value="{}") -> None:
    cte, body = pair_table(names, source, value)
    SQL[name] = register(cte, body)


def _after(table: str):
    return lambda cte, body: with_tables(table, "").rstrip() + ",\n" + cte + "\n" + body


corr_query(_after("three"), "corr_matrix_dense", S.FEATURES_THREE_CLASS, "three")
_v1_names = [*S.FEATURES_V1, S.LABEL]
corr_query(_after("v1"), "corr_matrix_pairwise", _v1_names, "v1_features")
_ints = (
    "(SELECT "
    + ", ".join(f"TRY_CAST(trunc({q(c)}) AS INTEGER) AS {q(c)}" for c in S.FEATURES_V1)
    + ", target_variable FROM v1_features)"
)
corr_query(_after("v1"), "corr_matrix_int", _v1_names, _ints)
corr_query(_after("clean"), "corr_matrix_subset", S.STATEMENT_COLUMNS, "clean")
corr_query(_after("clean"), "corr_matrix_ratios", S.RATIO_REPORT_COLUMNS, "clean")
corr_query(_after("clean"), "corr_matrix_log1p", LOGS, LOGGED)
_cte, _body = pair_table(LINE, "lineitem")
SQL["corr_matrix_lineitem"] = f"WITH {_cte} {_body}"


def prune(members: str) -> str:
    cte, body = pair_table(_v1_names, "v1_features")
    order = "[" + ", ".join(lit(c) for c in _v1_names) + "]"
    return (
        with_tables("v1", "").rstrip()
        + f",\n{cte}, m AS ({body}), strong AS (SELECT * FROM m WHERE abs(r) > 0.8 "
        + f"AND list_position({order}, column_i) < list_position({order}, column_j)) "
        + f'SELECT DISTINCT "column" FROM ({members})'
    )


SQL["corr_prune"] = prune(
    'SELECT column_i AS "column" FROM strong UNION ALL SELECT column_j AS "column" FROM strong'
)
SQL["corr_prune_first"] = prune('SELECT column_j AS "column" FROM strong')


def outliers(names, source: str, whole: bool) -> str:
    def one(c):
        x = q(c)
        guard = f"AND (SELECT count(*) - count({x}) FROM {source}) = 0" if whole else ""
        return (
            f'SELECT {lit(c)} AS "column", count(*) AS n_outliers FROM {source} WHERE '
            f"abs(({x} - (SELECT avg({x}) FROM {source})) / nullif((SELECT stddev_pop({x}) FROM {source}), 0)) > 3 {guard}"
        )

    return f"SELECT * FROM ({' UNION ALL '.join(one(c) for c in names)}) WHERE n_outliers > 0"


SQL["zscore_outlier_count"] = (
    with_tables("clean", "").rstrip() + f",\nlogged AS MATERIALIZED {LOGGED}\n" + outliers(LOGS, "logged", True)
)
clean("zscore_outlier_count_omit", outliers(S.FEATURES, "clean", False))
SQL["zscore_outlier_count_events"] = outliers(["value"], "events", True)


def boxes(names, source: str, by: str | None = None) -> str:
    g = f"{by}, " if by else ""

    def values(c):
        return f'SELECT {g}{lit(c)} AS "column", CAST({q(c)} AS DOUBLE) AS value FROM {source} WHERE {q(c)} IS NOT NULL'

    key = f'{g}"column"'
    return (
        f"long AS ({' UNION ALL '.join(values(c) for c in names)}), "
        f"fence AS (SELECT {key}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
        f"quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL), "
        f"marked AS (SELECT long.*, q1, median, q3, "
        f"value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM long JOIN fence USING ({key})) "
        f"SELECT {key}, {rnds(['q1', 'median', 'q3'], 4)}, "
        f"{rnd('min(value) FILTER (WHERE inside)', 4, 'whisker_low')}, "
        f"{rnd('max(value) FILTER (WHERE inside)', 4, 'whisker_high')}, "
        f"count(*) FILTER (WHERE NOT inside) AS n_outliers FROM marked GROUP BY {key}, q1, median, q3"
    )


def more(table: str, tail: str) -> str:
    """Further table expressions after those of ``table``."""
    return with_tables(table, "").rstrip() + ",\n" + tail


SQL["box_stats"] = more("clean", boxes(S.FEATURES, "clean"))
SQL["facet_by_label"] = more(
    "clean", boxes(["profits_perc_TNW", "TNW_in_MEUR", "current_ratio"], "clean", "target_variable")
)
SQL["box_stats_lineitem"] = "WITH " + boxes(LINE, "lineitem")


def histogram(names, source: str, bins: int) -> str:
    def values(c):
        return f'SELECT {lit(c)} AS "column", CAST({q(c)} AS DOUBLE) AS value FROM {source} WHERE {q(c)} IS NOT NULL'

    width = f"((high - low) / {bins})"
    return (
        f"long AS ({' UNION ALL '.join(values(c) for c in names)}), "
        'bound AS (SELECT "column", CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS low, '
        "CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS high FROM long GROUP BY ALL), "
        f'cnt AS (SELECT "column", CAST(least(floor((value - low) / (high - low) * {bins}), {bins - 1}) AS INTEGER) AS bin, '
        'count(*) AS n FROM long JOIN bound USING ("column") GROUP BY ALL), '
        f'grid AS (SELECT "column", low, high, CAST(unnest(range({bins})) AS INTEGER) AS bin FROM bound) '
        f'SELECT "column", bin, {rnd(f"low + bin * {width}", 6, "bin_low")}, '
        f'{rnd(f"low + (bin + 1) * {width}", 6, "bin_high")}, coalesce(n, 0) AS n '
        'FROM grid LEFT JOIN cnt USING ("column", bin)'
    )


SQL["histogram_10"] = more("clean", histogram(LOGS, LOGGED, 10))
SQL["histogram_20"] = more("clean", histogram(LOGS, LOGGED, 20))
SQL["histogram_lineitem"] = "WITH " + histogram(LINE, "lineitem", 20)


def kde(names, source: str, by: str | None = None, points: int = 200) -> str:
    g = f"{by}, " if by else ""

    def values(c):
        return f'SELECT {g}{lit(c)} AS "column", CAST({q(c)} AS DOUBLE) AS value FROM {source} WHERE {q(c)} IS NOT NULL'

    key = f'{g}"column"'
    return (
        f"long AS ({' UNION ALL '.join(values(c) for c in names)}), "
        f"spread AS (SELECT {key}, count(*) AS total, min(value) AS low, max(value) AS high, "
        f"stddev_samp(value) * pow(count(*), -0.2) AS width FROM long GROUP BY ALL), "
        f"val AS (SELECT {key}, value, count(*) AS n FROM long GROUP BY ALL), "
        f"grid AS (SELECT *, CAST(unnest(range({points})) AS INTEGER) AS point FROM spread WHERE width > 0), "
        f"spots AS (SELECT *, low - 3 * width + point * ((high - low + 6 * width) / {points - 1}) AS x FROM grid) "
        f"SELECT {key}, point, {rnd('x', 6, 'x')}, "
        f"{rnd(f'sum(n * exp(-0.5 * pow((x - value) / width, 2))) / (total * width * {math.sqrt(2 * math.pi)})', 6, 'density')} "
        f"FROM spots JOIN val USING ({key}) GROUP BY {key}, point, x, total, width"
    )


SQL["kde_grid"] = more("clean", kde(S.SCORES, "clean"))
SQL["kde_grid_log1p"] = more("clean", kde(LOGS, LOGGED))
SQL["facet_kde_by_label"] = more("clean", kde(S.SCORES, "clean", "target_variable"))
_fit = 'pmt_discipline_score, "CR_Rating_score"'
clean(
    "linear_fit",
    f"SELECT regr_count({_fit}) AS n, {rnd(f'regr_slope({_fit})', 6, 'slope')}, "
    f"{rnd(f'regr_intercept({_fit})', 6, 'intercept')}, {rnd(f'regr_r2({_fit})', 6, 'r2')} FROM clean",
)


def binned(names, source: str, keep: str = "") -> str:
    """Ten equal-width bins per column as columns b0, b1, ..."""

    def one(i, c):
        x = q(c)
        low = f"(CASE WHEN min({x}) OVER () = max({x}) OVER () THEN min({x}) OVER () - 0.5 ELSE min({x}) OVER () END)"
        high = f"(CASE WHEN min({x}) OVER () = max({x}) OVER () THEN max({x}) OVER () + 0.5 ELSE max({x}) OVER () END)"
        return f"CAST(least(floor(({x} - {low}) / ({high} - {low}) * 10), 9) AS INTEGER) AS b{i}"

    fields = ", ".join(one(i, c) for i, c in enumerate(names))
    return f"binned AS MATERIALIZED (SELECT {keep}{fields} FROM {source})"


SQL["pair_scatter"] = more(
    "clean",
    binned(LOGS, LOGGED)
    + "\n"
    + " UNION ALL ".join(
        f"SELECT {lit(a)} AS column_x, {lit(b)} AS column_y, b{i} AS bin_x, b{j} AS bin_y, count(*) AS n FROM binned "
        f"WHERE b{i} IS NOT NULL AND b{j} IS NOT NULL GROUP BY ALL"
        for (i, a), (j, b) in combinations(list(enumerate(LOGS)), 2)
    ),
)


def hexagons(x: str, y: str, by: str = "", size: int = 20) -> str:
    rows = int(size / math.sqrt(3))
    g = f"{by}, " if by else ""
    return (
        f"placed AS (SELECT {g}({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) * {size} AS px, "
        f"({y} - min({y}) OVER ()) / (max({y}) OVER () - min({y}) OVER ()) * {rows} AS py FROM clean), "
        "near AS (SELECT *, floor(px + 0.5) AS ax, floor(py + 0.5) AS ay, floor(px) AS cx, floor(py) AS cy FROM placed), "
        f"hexes AS (SELECT {g}"
        "CASE WHEN corner THEN ax ELSE cx + 0.5 END AS hex_x, CASE WHEN corner THEN ay ELSE cy + 0.5 END AS hex_y "
        "FROM (SELECT *, (px - ax) * (px - ax) + 3 * (py - ay) * (py - ay) < "
        "(px - cx - 0.5) * (px - cx - 0.5) + 3 * (py - cy - 0.5) * (py - cy - 0.5) AS corner FROM near)) "
        f"SELECT {g}hex_x + 0e0 AS hex_x, hex_y + 0e0 AS hex_y, count(*) AS n FROM hexes GROUP BY ALL"
    )


SQL["hexbin_counts"] = more("clean", hexagons('profits_perc_TNW', '"TNW_in_MEUR"'))
SQL["facet_scatter_by_label"] = more("clean", hexagons('profits_perc_TNW', '"TNW_in_MEUR"', "target_variable"))
SQL["chi_square_select"] = more(
    "clean",
    binned(S.FEATURES, "clean", "target_variable AS label, ")
    + ", c AS ("
    + " UNION ALL ".join(
        f"SELECT {lit(f)} AS feature, b{i} AS bin, label, count(*) AS n FROM binned WHERE b{i} IS NOT NULL GROUP BY ALL"
        for i, f in enumerate(S.FEATURES)
    )
    + "), r AS (SELECT feature, bin, sum(n) AS row_n FROM c GROUP BY ALL), "
    "k AS (SELECT feature, label, sum(n) AS col_n FROM c GROUP BY ALL), "
    "w AS (SELECT feature, sum(n) AS total, (count(DISTINCT bin) - 1) * (count(DISTINCT label) - 1) AS dof FROM c GROUP BY ALL), "
    "e AS (SELECT feature, bin, label, CAST(row_n AS DOUBLE) * col_n / total AS expected "
    "FROM r JOIN k USING (feature) JOIN w USING (feature)) "
    f"SELECT feature, {rnd('sum(pow(coalesce(n, 0) - expected, 2) / expected)', 4, 'statistic')}, dof "
    "FROM e LEFT JOIN c USING (feature, bin, label) JOIN w USING (feature) GROUP BY feature, dof "
    "ORDER BY sum(pow(coalesce(n, 0) - expected, 2) / expected) DESC, feature LIMIT 5",
)

# --- rules and labels --------------------------------------------------------------------------------------------
clean("label_binary", "SELECT contract_id, target_variable FROM clean")
clean("flag_liquidity", "SELECT contract_id, current_ratio >= 1.5 AS liquid FROM clean")
PERCENT, FRACTION = ((25, 50), (50, 75)), ((0.25, 0.5), (0.5, 0.75))
LEVELS = ("Low Risk", "Medium Risk", "High Risk")
three("label_risk_category", "SELECT contract_id, risk AS risk_category FROM three")
three(
    "label_high_explicit",
    "SELECT contract_id, matched_rule, coalesce(matched_rule, 'High') AS risk_category FROM (SELECT contract_id, "
    f"{L.banded(PERCENT, ('Low', 'Medium', 'High'), None, 50)} AS matched_rule FROM three)",
)
three(
    "label_fraction_thresholds",
    f'SELECT contract_id, {L.banded(FRACTION, LEVELS, "Unknown", 0.25)} AS "Risk_Level" FROM three',
)
BANKER = (
    'CASE WHEN "CR_Rating_score" > 75 AND pmt_discipline_score > 75 AND debt_equity_ratio < 0.5 '
    "AND debt_asset_ratio < 0.1 AND interest_cov_ratio > 5 AND current_ratio > 2 AND return_on_assets > 0.1 "
    "AND debt_ser_cov_ratio > 1.5 THEN 'low' "
    'WHEN "CR_Rating_score" BETWEEN 50 AND 75 AND pmt_discipline_score BETWEEN 50 AND 75 '
    "AND debt_equity_ratio BETWEEN 0.5 AND 1.0 AND debt_asset_ratio BETWEEN 0.1 AND 0.25 "
    "AND interest_cov_ratio BETWEEN 3 AND 5 AND current_ratio BETWEEN 1.5 AND 2 "
    "AND return_on_assets BETWEEN 0.05 AND 0.1 AND debt_ser_cov_ratio BETWEEN 1.2 AND 1.5 THEN 'medium' ELSE 'high' END"
)
three("label_domain_thresholds", f"SELECT contract_id, {BANKER} AS risk FROM three")
three(
    "label_risk_num",
    "SELECT contract_id, risk, CASE risk WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS risk_num "
    f"FROM (SELECT contract_id, {BANKER} AS risk FROM three)",
)
three(
    "label_leverage_sketch",
    f"SELECT contract_id, {rnd('lev', 6, 'short_term_leverage')}, "
    'CASE WHEN profits_perc_TNW < 0.1 AND "TNW_to_T-Exposure" > 1.5 AND lev < 0.1 THEN \'low\' '
    'WHEN profits_perc_TNW BETWEEN 0.1 AND 0.25 AND "TNW_to_T-Exposure" BETWEEN 1.0 AND 1.5 '
    "AND lev BETWEEN 0.1 AND 0.25 THEN 'medium' ELSE 'high' END AS risk "
    "FROM (SELECT *, short_term_liab / nullif(tangible_net_worth, 0) AS lev FROM three)",
)


def share(c: str) -> str:
    return f"({q(c)} / nullif(sum({q(c)}) OVER (), 0) * 100)"


def share_level(names, otherwise="Unknown") -> str:
    low = " AND ".join(f"{q('s ' + c)} > 50" for c in names)
    mid = " AND ".join(f"{q('s ' + c)} BETWEEN 25 AND 50" for c in names)
    high = " AND ".join(f"{q('s ' + c)} < 25" for c in names)
    return f"CASE WHEN {low} THEN 'Low Risk' WHEN {mid} THEN 'Medium Risk' WHEN {high} THEN 'High Risk' ELSE '{otherwise}' END"


SHARES = "(SELECT contract_id, " + ", ".join(f"{share(c)} AS {q('s ' + c)}" for c in S.FEATURES_THREE_CLASS) + " FROM three)"
three("label_pct_of_sum_row", f'SELECT contract_id, {share_level(S.FEATURES_THREE_CLASS)} AS "Risk_Level" FROM {SHARES}')
three(
    "label_pct_of_sum_column",
    "SELECT contract_id, "
    + ", ".join(f"{share_level([c])} AS {q(c + '_Risk_Level')}" for c in S.FEATURES_THREE_CLASS)
    + f" FROM {SHARES}",
)


def scaled(level: str, quorum: int | None = None) -> str:
    tests = []
    for c in L.COLUMNS:
        low, high = FRACTION[1] if c in L.SCORES else FRACTION[0]
        t = q("t " + c)
        if level == "low" or c in ("profits_perc_TNW", "TNW_to_T-Exposure"):
            tests.append(f"{q(c)} > {high} * {t}")
        elif level == "medium":
            tests.append(f"{q(c)} BETWEEN {low} * {t} AND {high} * {t}")
        else:
            tests.append(f"{q(c)} < {low} * {t}")
    return L.held(tests, quorum)


three(
    "label_scaled_sum",
    f"SELECT contract_id, CASE WHEN {scaled('low')} THEN 'Low Risk' WHEN {scaled('medium')} THEN 'Medium Risk' "
    f"WHEN {scaled('high')} THEN 'High Risk' ELSE 'Unknown' END AS \"Risk_Level\" FROM (SELECT *, "
    + ", ".join(f"sum({q(c)}) OVER () AS {q('t ' + c)}" for c in L.COLUMNS)
    + " FROM three)",
)


def percentile_rule(level: str, quorum: int | None = None) -> str:
    tests = []
    for c in L.COLUMNS:
        low, high = (0.5, 0.75) if c in L.SCORES else (0.25, 0.5)
        cut = {p: f"(SELECT quantile_cont(CAST({q(c)} AS DOUBLE), {p}) FROM three)" for p in (low, high)}
        if level == "low":
            tests.append(f"{q(c)} >= {cut[high]}")
        else:
            tests.append(f"{q(c)} BETWEEN {cut[low]} AND {cut[high]}")
    return L.held(tests, quorum)


three(
    "label_percentile",
    f"SELECT contract_id, CASE WHEN {percentile_rule('low')} THEN 'Low' "
    f"WHEN {percentile_rule('medium')} THEN 'Medium' END AS risk FROM three",
)

# --- the same rule tables on percent ranks, or by a quorum of their tests
RANKS = (
    "(SELECT contract_id, "
    + ", ".join(
        f"100e0 * (rank() OVER (ORDER BY {q(c)}) - 1) / (count({q(c)}) OVER () - 1) AS {q(c)}" for c in S.FEATURES_THREE_CLASS
    )
    + " FROM three)"
)
PARTS = "(SELECT contract_id, " + ", ".join(f"{q(c)} / 100 AS {q(c)}" for c in L.COLUMNS) + f" FROM {RANKS})"
three("percent_ranks", f"SELECT contract_id, {rnds(S.FEATURES_THREE_CLASS, 6)} FROM {RANKS}")
_ranked = L.banded(PERCENT, ("Low", "Medium", "High"), "High", quorum=6)
three("label_risk_category_ranked", f"SELECT contract_id, {_ranked} AS risk_category FROM {RANKS}")
three(
    "label_risk_num_ranked",
    "SELECT *, CASE risk_category WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END AS risk_num "
    f"FROM (SELECT contract_id, {_ranked} AS risk_category FROM {RANKS})",
)
three(
    "label_high_explicit_ranked",
    "SELECT contract_id, matched_rule, coalesce(matched_rule, 'High') AS risk_category FROM (SELECT contract_id, "
    f"{L.banded(PERCENT, ('Low', 'Medium', 'High'), None, 50, 6)} AS matched_rule FROM {RANKS})",
)
three(
    "label_fraction_thresholds_ranked",
    f'SELECT contract_id, {L.banded(FRACTION, LEVELS, "Unknown", 0.25, 6)} AS "Risk_Level" FROM {PARTS}',
)


def rank_level(names, quorum=None) -> str:
    tests = {
        "Low Risk": [f"{q(c)} > 50" for c in names],
        "Medium Risk": [f"{q(c)} BETWEEN 25 AND 50" for c in names],
        "High Risk": [f"{q(c)} < 25" for c in names],
    }
    return "CASE " + " ".join(f"WHEN {L.held(t, quorum)} THEN '{level}'" for level, t in tests.items()) + " ELSE 'Unknown' END"


three("label_rank_row", f'SELECT contract_id, {rank_level(S.FEATURES_THREE_CLASS, 14)} AS "Risk_Level" FROM {RANKS}')
three(
    "label_rank_column",
    "SELECT contract_id, "
    + ", ".join(f"{rank_level([c])} AS {q(c + '_Risk_Level')}" for c in S.FEATURES_THREE_CLASS)
    + f" FROM {RANKS}",
)
three(
    "label_percentile_quorum",
    f"SELECT contract_id, CASE WHEN {percentile_rule('low', 6)} THEN 'Low' "
    f"WHEN {percentile_rule('medium', 6)} THEN 'Medium' END AS risk FROM three",
)
_low = [
    '"CR_Rating_score" > 75', "pmt_discipline_score > 75", "debt_equity_ratio < 0.5", "debt_asset_ratio < 0.1",
    "interest_cov_ratio > 5", "current_ratio > 2", "return_on_assets > 0.1", "debt_ser_cov_ratio > 1.5",
]
_medium = [
    '"CR_Rating_score" BETWEEN 50 AND 75', "pmt_discipline_score BETWEEN 50 AND 75", "debt_equity_ratio BETWEEN 0.5 AND 1.0",
    "debt_asset_ratio BETWEEN 0.1 AND 0.25", "interest_cov_ratio BETWEEN 3 AND 5", "current_ratio BETWEEN 1.5 AND 2",
    "return_on_assets BETWEEN 0.05 AND 0.1", "debt_ser_cov_ratio BETWEEN 1.2 AND 1.5",
]
three(
    "label_domain_thresholds_quorum",
    f"SELECT contract_id, CASE WHEN {L.held(_low, 3)} THEN 'low' WHEN {L.held(_medium, 3)} THEN 'medium' ELSE 'high' END AS risk FROM three",
)
three(
    "label_scaled_max_quorum",
    f"SELECT contract_id, CASE WHEN {scaled('low', 3)} THEN 'Low Risk' WHEN {scaled('medium', 3)} THEN 'Medium Risk' "
    f"WHEN {scaled('high', 3)} THEN 'High Risk' ELSE 'Unknown' END AS \"Risk_Level\" FROM (SELECT *, "
    + ", ".join(f"max({q(c)}) OVER () AS {q('t ' + c)}" for c in L.COLUMNS)
    + " FROM three)",
)

# --- feature preparation --------------------------------------------------------------------------------------------
clean("assemble_features", f"SELECT contract_id, {rnds([c for c in _doubles], 4)}, "
      + ", ".join(f"CAST({q(c)} AS DOUBLE) AS {q(c)}" for c in S.SCORES) + " FROM clean")


def standardized(spread: str, digits: int | None = 6) -> str:
    def one(c):
        z = f"coalesce(({q(c)} - avg({q(c)}) OVER ()) / nullif({spread}({q(c)}) OVER (), 0), 0)"
        return rnd(z, digits, c) if digits else f"{z} AS {q(c)}"

    return ", ".join(one(c) for c in S.FEATURES)


clean("standardize", f"SELECT contract_id, {standardized('stddev_samp')} FROM clean")
clean("standardize_population", f"SELECT contract_id, {standardized('stddev_pop')} FROM clean")
clean(
    "split_hash",
    "SELECT contract_id, CASE WHEN ((contract_id % 2147483648) * 2654435761 % 4294967296) / 4294967296.0::DOUBLE < 0.7 "
    "THEN 'train' ELSE 'test' END AS split FROM clean",
)
clean("split_features_label", f"SELECT contract_id, {rnds(_doubles, 4)}, {cols(S.SCORES)}, target_variable FROM clean")
clean(
    "cv_folds",
    "SELECT contract_id, target_variable, CAST(row_number() OVER (PARTITION BY target_variable ORDER BY contract_id) % 5 AS INTEGER) AS fold FROM clean",
)
_nb = "scaled AS (SELECT target_variable, " + standardized("stddev_samp", None) + " FROM clean)"
_largest = "(SELECT greatest(" + ", ".join(f"var_samp({q(c)})" for c in S.FEATURES) + ") FROM scaled)"
SQL["naive_bayes_params"] = more(
    "clean",
    _nb
    + " "
    + " UNION ALL ".join(
        f'SELECT target_variable AS class, {lit(c)} AS feature, {rnd("count(*) / (SELECT count(*) FROM scaled)", 6, "prior")}, '
        f"{rnd(f'avg({q(c)})', 6, 'mean')}, {rnd(f'var_pop({q(c)}) + 1e-9 * {_largest}', 6, 'variance')} "
        "FROM scaled GROUP BY target_variable"
        for c in S.FEATURES
    ),
)


# every fold's classes from the rows of the other folds; log-likelihoods of standardised values
_held = ", ".join(f"({f})" for f in range(5))
_long = " UNION ALL ".join(
    f"SELECT contract_id, target_variable AS y, fold, {i} AS j, CAST({q(c)} AS DOUBLE) AS v FROM tr" for i, c in enumerate(S.FEATURES)
)
SQL["gridsearch_nb"] = more(
    "clean",
    f"""tr AS (
  SELECT *, row_number() OVER (PARTITION BY target_variable ORDER BY contract_id) % 5 AS fold FROM clean
  WHERE ((contract_id % 2147483648) * 2654435761 % 4294967296) / 4294967296.0::DOUBLE < 0.7),
lg AS ({_long}),
held AS (SELECT * FROM (VALUES {_held}) t(f)),
every AS (SELECT f, j, var_samp(v) AS s2 FROM lg, held WHERE fold <> f GROUP BY ALL),
own AS (SELECT f, y AS c, j, avg(v) AS m, var_pop(v) AS s FROM lg, held WHERE fold <> f GROUP BY ALL),
prior AS (SELECT f, target_variable AS c, ln(count(*) / sum(count(*)) OVER (PARTITION BY f)) AS p FROM tr, held WHERE fold <> f GROUP BY f, target_variable),
ll AS (
  SELECT contract_id, lg.y, fold, own.c, any_value(p) - sum(0.5 * ln(2 * pi() * (s / s2 + 1e-9)) + (v - m) * (v - m) / s2 / (2 * (s / s2 + 1e-9))) AS l
  FROM lg JOIN own ON own.f = fold AND own.j = lg.j JOIN every ON every.f = fold AND every.j = lg.j
  JOIN prior ON prior.f = fold AND prior.c = own.c WHERE s2 > 0 GROUP BY ALL),
called AS (SELECT contract_id, y, fold, arg_max(c, l) AS c FROM ll GROUP BY ALL),
hits AS (SELECT fold, avg(CASE WHEN y = c THEN 1.0 ELSE 0.0 END) AS h FROM called GROUP BY fold)
SELECT 'naive_bayes' AS model, {rnd('avg(h)', 6, 'accuracy')}, true AS is_best FROM hits""",
)

# --- evaluation ---------------------------------------------------------------------------------------------------------
THREE_WAY = (
    '(SELECT contract_id, CASE WHEN "CR_Rating_score" >= 75 THEN 2 WHEN "CR_Rating_score" >= 50 THEN 1 ELSE 0 END AS label, '
    "CASE WHEN pmt_discipline_score >= 75 THEN 2 WHEN pmt_discipline_score >= 50 THEN 1 ELSE 0 END AS prediction FROM clean)"
)
SC = f"scored AS MATERIALIZED (SELECT * FROM {SCORED})"
SC3 = f"scored AS MATERIALIZED (SELECT * FROM {THREE_WAY})"
CURVE = (
    SC
    + ", pts AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg "
    "FROM scored GROUP BY score), "
    "cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n, "
    "lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg, "
    "row_number() OVER (ORDER BY score DESC) AS rn FROM pts "
    "WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"
)
_steps = (
    CURVE
    + ", steps AS (SELECT *, CAST(tp AS DOUBLE) / p AS tpr, CAST(fp AS DOUBLE) / n AS fpr, "
    "coalesce(lag(CAST(tp AS DOUBLE) / p) OVER (ORDER BY rn), 0) AS tpr0, "
    "coalesce(lag(CAST(fp AS DOUBLE) / n) OVER (ORDER BY rn), 0) AS fpr0, "
    "CAST(tp AS DOUBLE) / (tp + fp) AS prec, "
    "coalesce(lag(CAST(tp AS DOUBLE) / (tp + fp)) OVER (ORDER BY rn), CAST(tp AS DOUBLE) / (tp + fp)) AS prec0 FROM cum) "
)
SQL["auc_roc"] = more("clean", _steps + f"SELECT {rnd('sum((fpr - fpr0) * (tpr + tpr0) / 2)', 6, 'auc_roc')} FROM steps")
SQL["auc_pr"] = more("clean", _steps + f"SELECT {rnd('sum((tpr - tpr0) * (prec + prec0) / 2)', 6, 'auc_pr')} FROM steps")
SQL["roc_curve"] = more(
    "clean",
    CURVE
    + f" SELECT {rnd('score', 6, 'threshold')}, {rnd('CAST(fp AS DOUBLE) / n', 6, 'fpr')}, "
    f"{rnd('CAST(tp AS DOUBLE) / p', 6, 'tpr')} FROM cum "
    "WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg UNION ALL SELECT NULL, 0e0, 0e0",
)
SQL["roc_auc_trapezoid"] = more(
    "clean",
    CURVE
    + ", points AS (SELECT rn, CAST(fp AS DOUBLE) / n AS x, CAST(tp AS DOUBLE) / p AS y FROM cum "
    "WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg UNION ALL SELECT 0, 0e0, 0e0), "
    "steps AS (SELECT x, y, lead(x) OVER (ORDER BY rn) AS x1, lead(y) OVER (ORDER BY rn) AS y1 FROM points) "
    f"SELECT {rnd('sum((x1 - x) * (y1 + y) / 2)', 6, 'auc_roc')} FROM steps",
)
CLASSES = (
    ", cls AS (SELECT label AS class FROM scored UNION SELECT prediction FROM scored), "
    "per_class AS (SELECT class, "
    "coalesce((SELECT count(*) FROM scored WHERE label = class AND prediction = class) / "
    "nullif((SELECT count(*) FROM scored WHERE prediction = class), 0), 0) AS precision, "
    "coalesce((SELECT count(*) FROM scored WHERE label = class AND prediction = class) / "
    "nullif((SELECT count(*) FROM scored WHERE label = class), 0), 0) AS recall, "
    "(SELECT count(*) FROM scored WHERE label = class) AS support FROM cls), "
    "f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM per_class), "
    "total AS (SELECT (SELECT avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END) FROM scored) AS accuracy, "
    "CAST(sum(support) AS BIGINT) AS support, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf, "
    "sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr, "
    "sum(f1 * support) / sum(support) AS wf FROM f)"
)
for _name, _field in {
    "accuracy": "accuracy",
    "weighted_precision": "wp",
    "weighted_recall": "wr",
    "weighted_f1": "wf",
}.items():
    SQL[_name] = more("clean", SC + CLASSES + f" SELECT {rnd(_field, 6, _name)} FROM total")
REPORT = (
    CLASSES
    + f' SELECT CAST(class AS VARCHAR) AS "row", {rnds(["precision", "recall", "f1"], 6)}, support FROM f '
    f"UNION ALL SELECT 'accuracy', NULL, NULL, {rnd('accuracy', 6)}, support FROM total "
    f"UNION ALL SELECT 'macro avg', {rnd('mp', 6)}, {rnd('mr', 6)}, {rnd('mf', 6)}, support FROM total "
    f"UNION ALL SELECT 'weighted avg', {rnd('wp', 6)}, {rnd('wr', 6)}, {rnd('wf', 6)}, support FROM total"
)
SQL["classification_report"] = more("clean", SC + REPORT)
SQL["classification_report_three"] = more("clean", SC3 + REPORT)
MATRIX = (
    ", cls AS (SELECT label AS class FROM scored UNION SELECT prediction FROM scored) "
    "SELECT a.class AS actual, b.class AS predicted, "
    "(SELECT count(*) FROM scored WHERE label = a.class AND prediction = b.class) AS n FROM cls a, cls b"
)
SQL["confusion_matrix"] = more("clean", SC + MATRIX)
SQL["confusion_matrix_three"] = more("clean", SC3 + MATRIX)
_cells = (
    SC
    + ", cells AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, "
    "count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
    "count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, "
    "count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM scored) "
)
SQL["binary_rates"] = more(
    "clean",
    _cells
    + f"SELECT tp, fp, tn, fn, {rnd('tp / nullif(tp + fn, 0)', 6, 'tpr')}, {rnd('fp / nullif(fp + tn, 0)', 6, 'fpr')}, "
    f"{rnd('tp / nullif(tp + fp, 0)', 6, 'precision')}, {rnd('tp / nullif(tp + fn, 0)', 6, 'recall')} FROM cells",
)
_p0, _r0 = "tn / nullif(tn + fn, 0)", "tn / nullif(tn + fp, 0)"
SQL["binary_rates_class0"] = more("clean", _cells + f"SELECT {rnd(_p0, 6, 'precision')}, {rnd(_r0, 6, 'recall')} FROM cells")
SQL["binary_rates_class0_compat"] = more(
    "clean", _cells + f"SELECT {rnd(_r0, 6, 'precision')}, {rnd(_p0, 6, 'recall')} FROM cells"
)

# --- synthetic data --------------------------------------------------------------------------------------------------------
_synthetic = [*S.FEATURES, S.LABEL]


def digits_needed(x: str) -> str:
    """Most decimals of the column, read off texts of 13 digits; null where these are not the value."""
    text = f"printf('%.12e', {x})"
    tail = f"length(rtrim(split_part(split_part({text}, 'e', 1), '.', 2), '0'))"
    need = f"greatest({tail} - CAST(split_part({text}, 'e', 2) AS INTEGER), 0)"
    off = f"abs(CAST({text} AS DOUBLE) - {x}) > abs({x}) * pow(2, -50)"
    most = f"max(CASE WHEN {x} IS NULL THEN NULL WHEN {off} THEN 16 ELSE {need} END)"
    return f"CAST(CASE WHEN {most} <= 15 THEN {most} END AS INTEGER)"


clean(
    "copula_metadata",
    long_union(
        _synthetic,
        lambda c: f"{lit('int' if c in (*S.SCORES, S.LABEL) else 'double')} AS data_type, "
        f"{rnd(f'CAST(min({q(c)}) AS DOUBLE)', 4, 'min')}, {rnd(f'CAST(max({q(c)}) AS DOUBLE)', 4, 'max')}, "
        f"{nulls(c)} AS n_null, {digits_needed(f'CAST({q(c)} AS DOUBLE)')} AS decimals",
        "clean",
    ),
)


def beta_row(c: str) -> str:
    x = q(c)
    width = f"(max({x}) - min({x}))"
    m = f"((avg({x}) - min({x})) / nullif({width}, 0))"
    v = f"(var_pop({x}) / nullif({width} * {width}, 0))"
    size = f"({m} * (1 - {m}) / nullif({v}, 0) - 1)"
    return (
        f"{rnd(f'CAST(min({x}) AS DOUBLE)', 4, 'low')}, {rnd(f'CAST(max({x}) AS DOUBLE)', 4, 'high')}, "
        f"{rnd(f'{m} * {size}', 4, 'alpha')}, {rnd(f'(1 - {m}) * {size}', 4, 'beta')}"
    )


clean("copula_beta_shape", long_union(_synthetic, beta_row, "clean"))

# --- whole jobs beside the narrower ones above -----------------------------------------
SQL["adapter_credit_raw_all_years"] = SQL["adapter_credit_raw"]
SQL["adapter_credit_raw_fixed_years"] = (
    f"WITH {LINES},\n{_raw(True)}\nSELECT contract_id, {cols(_text)}, {rnds(S.RAW_NUMERIC, 4)} FROM raw"
)
SQL["kde_grid_log_columns"] = more("clean", kde(LOGS, LOGGED))
SQL["box_stats_log_columns"] = more("clean", boxes(LOGS, LOGGED))
clean("features_frame", f"SELECT contract_id, {rnds(_doubles, 4)}, {cols(S.SCORES)} FROM clean")
clean("label_frame", "SELECT contract_id, target_variable FROM clean")
