"""SQL for the shared tables of the workload, as common table expressions."""

from __future__ import annotations

from collections.abc import Iterable

from ledgerline import schema as S

YEARS = {"CP": 2000, "LP": 1999, "PBLP": 1998}
PERIOD_SUMS = """months n_lines revenue ebit depreciation fixed intangible current
open_value filled_value open_qty filled_qty taxed_qty""".split()


def q(name: str) -> str:
    return '"' + name + '"'


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cols(names: Iterable[str]) -> str:
    return ", ".join(q(c) for c in names)


def rnd(expression: str, digits: int, alias: str | None = None) -> str:
    """Rounded value; adding zero turns a negative zero into zero."""
    return f"round({expression}, {digits}) + 0e0" + (f" AS {q(alias)}" if alias else "")


def rnds(names: Iterable[str], digits: int) -> str:
    return ", ".join(rnd(q(c), digits, c) for c in names)


def ratio(name: str) -> str:
    above, below = S.RATIOS[name]
    return f"(({' + '.join(map(q, above))}) / nullif({' + '.join(map(q, below))}, 0))"


def score(name: str, mapping: dict[str, int], default: str = "NULL") -> str:
    cases = " ".join(f"WHEN {lit(word)} THEN {points}" for word, points in mapping.items())
    return f"CASE {q(name)} {cases} ELSE {default} END"


# --- raw --------------------------------------------------------------------------------
LINES = """li AS (
  SELECT l_orderkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS e,
         CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_tax * 100) AS BIGINT) AS t,
         CAST(l_quantity AS BIGINT) AS q, l_returnflag AS rf, l_linestatus AS ls
  FROM lineitem),
per AS (
  SELECT o_custkey AS k, year(o_orderdate) AS y, count(*) AS n_lines,
         count(DISTINCT month(o_orderdate)) AS months,
         CAST(sum(e * (100 - d)) AS BIGINT) AS revenue,
         CAST(sum(e * (6 - d)) AS BIGINT) AS ebit,
         CAST(sum(e * t) AS BIGINT) AS depreciation,
         CAST(sum(CASE WHEN rf = 'A' THEN e ELSE 0 END) AS BIGINT) AS fixed,
         CAST(sum(CASE WHEN rf = 'R' THEN e ELSE 0 END) AS BIGINT) AS intangible,
         CAST(sum(CASE WHEN rf = 'N' THEN e ELSE 0 END) AS BIGINT) AS current,
         CAST(sum(CASE WHEN ls = 'O' THEN e ELSE 0 END) AS BIGINT) AS open_value,
         CAST(sum(CASE WHEN ls = 'F' THEN e ELSE 0 END) AS BIGINT) AS filled_value,
         CAST(sum(CASE WHEN ls = 'O' THEN q ELSE 0 END) AS BIGINT) AS open_qty,
         CAST(sum(CASE WHEN ls = 'F' THEN q ELSE 0 END) AS BIGINT) AS filled_qty,
         CAST(sum(t * q) AS BIGINT) AS taxed_qty
  FROM li JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
tot AS (
  SELECT o_custkey AS k, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 1e2 AS exposure,
         arg_max(o_orderpriority, o_orderkey) AS last_priority
  FROM orders GROUP BY ALL),
fleet AS (SELECT k, CAST(sum(n_lines) AS BIGINT) AS n FROM per GROUP BY ALL),
lim AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
band AS (
  SELECT k, ((hi - y) * 3) // (hi - lo + 1) AS b, """ + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in PERIOD_SUMS) + """
  FROM per, lim GROUP BY ALL)"""

MEASURE_SQL = {
    "number_months": "CAST({p}.months AS DOUBLE)",
    "revenue": "{p}.revenue / 1e4",
    "EBIT": "{p}.ebit / 1e4",
    "depreciation": "{p}.depreciation / 1e4",
    "net_profit": "({p}.ebit - {p}.depreciation) / 1e4",
    "fixed_assets": "{p}.fixed / 1e2",
    "intangible_assets": "{p}.intangible / 1e3",
    "current_assets": "{p}.current / 1e2",
    "tangible_net_worth": "(10 * ({p}.fixed + {p}.current) - 4 * {p}.open_value - 3 * {p}.filled_value) / 1e3",
    "long_term_liabilities": "4 * {p}.open_value / 1e3",
    "long_term_credit": "CAST(100 * {p}.open_qty AS DOUBLE)",
    "short_term_liabilities": "3 * {p}.filled_value / 1e3",
    "short_term_credit": "CAST(100 * {p}.filled_qty AS DOUBLE)",
    "off_balance_liabilities": "{p}.taxed_qty / 1e2",
}


def _raw(fixed_years: bool = False) -> str:
    """The raw table; its periods are thirds of the table's range of years, or the fixed ones."""
    rows = {p: f"per WHERE y = {YEARS[p]}" if fixed_years else f"band WHERE b = {b}" for b, p in enumerate(YEARS)}
    ends = {
        p: f"'{YEARS[p]}-12-31'" if fixed_years else f"(SELECT hi - ({b} * (hi - lo + 1) + 2) // 3 FROM lim) || '-12-31'"
        for b, p in enumerate(YEARS)
    }
    period = {
        f"{long}_{m}": MEASURE_SQL[m].format(p=p) for p, long in S.PERIODS.items() for m in S.MEASURES
    }
    worth = f"({period['current_period_tangible_net_worth']})"
    values = {
        "customer_name": "CASE c_custkey % 97 WHEN 0 THEN '0' WHEN 1 THEN 'nan' WHEN 2 THEN 'null' "
        "WHEN 3 THEN NULL ELSE c_name END",
        "market": "n_name",
        "credit_rating": "CASE WHEN c_acctbal >= 7500 THEN 'A' WHEN c_acctbal >= 5000 THEN 'B' "
        "WHEN c_acctbal >= 2500 THEN 'C' WHEN c_acctbal >= 0 THEN 'D' ELSE 'E' END",
        "payment_discipline": "CASE last_priority WHEN '1-URGENT' THEN 'Excellent' WHEN '2-HIGH' THEN 'Good' "
        "WHEN '3-MEDIUM' THEN 'Fair' WHEN '4-NOT SPECIFIED' THEN 'Bad' WHEN '5-LOW' THEN 'None' END",
        "total_exposure": "CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE exposure END",
        "years_in_business": "CAST(1 + c_custkey % 40 AS DOUBLE)",
        "fundation_year": "CAST(1999 - c_custkey % 40 AS VARCHAR)",
        "fleet_size": "CAST(coalesce(fleet.n, 0) AS DOUBLE)",
        "financing_currency": "CASE c_nationkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'SEK' ELSE 'PLN' END",
        "TNW_in_MEUR": f"{worth} / 1e6",
        "profits_perc_TNW": f"100 * ({period['current_period_net_profit']}) / nullif({worth}, 0)",
        "positive_working_capital": f"{period['current_period_current_assets']} - "
        f"{period['current_period_short_term_liabilities']}",
        "TNW_to_total_exposure": f"100 * {worth} / nullif(exposure, 0)",
        "quote_id": "'Q' || c_custkey",
        "legal_form": "'LTD'",
        "type_of_data": "'annual'",
        **{long: f"CASE WHEN {p}.k IS NOT NULL THEN {ends[p]} END" for p, long in S.PERIODS.items()},
        **period,
    }
    select = ",\n         ".join(f"{values.get(c, 'CAST(NULL AS VARCHAR)')} AS {q(c)}" for c in S.RAW_COLUMNS)
    joins = "\n  ".join(
        f"LEFT JOIN (SELECT * FROM {rows[p]}) {p} ON {p}.k = c_custkey" for p in YEARS
    )
    return f"""raw AS (
  SELECT c_custkey AS contract_id,
         {select}
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN tot ON tot.k = c_custkey
  LEFT JOIN fleet ON fleet.k = c_custkey
  {joins})"""


# --- shared steps ------------------------------------------------------------------------
NUMERIC = [S.RENAMES.get(c, c) for c in S.RAW_NUMERIC]
CANONICAL_NUMERIC = [c for c in NUMERIC if c != "YRS_In_BUS"]
OLD = {new: old for old, new in S.RENAMES.items()}
PLAIN = "contract_id, customer_name, market, financing_currency, credit_rating AS \"CR_Rating\", payment_discipline AS pmt_discipline"
NAMED = f"customer_name NOT IN ({', '.join(lit(n) for n in S.PLACEHOLDER_NAMES)})"


def total(measure: str, compat: bool = True, cast: str = "{}") -> str:
    parts = [f"{p}_{measure}" for p in S.PERIODS]
    if measure == "net_profit" and compat:
        parts[-1] = "PBLP_depreciation"
    return " + ".join(cast.format(q(p)) for p in parts)


def totals(measures: Iterable[str], cast: str = "{}") -> str:
    return ", ".join(f"{total(m, True, cast)} AS {q(m)}" for m in measures)


LENIENT = score("pmt_discipline", S.DISCIPLINE_LENIENT, str(S.DISCIPLINE_LENIENT_DEFAULT))
STRICT = score("pmt_discipline", S.DISCIPLINE_STRICT)
RATING = score("CR_Rating", S.RATING_SCORES)
LABELLED = 'CASE WHEN "CR_Rating_score" > 25 AND current_ratio > 1.5 THEN 1 ELSE 0 END AS target_variable'


def _ratios(names: Iterable[str], wrap: str = "{}") -> str:
    return ", ".join(f"{wrap.format(ratio(r))} AS {q(r)}" for r in names)


def _canonical() -> str:
    zeroed = ", ".join(
        f"coalesce({q(c)}, 0) AS {q(c)}" for c in S.FEATURES
    )
    return f"""typed AS (
  SELECT {PLAIN}, {", ".join(f"{q(OLD.get(c, c))} AS {q(c)}" for c in CANONICAL_NUMERIC)}
  FROM raw WHERE {NAMED}),
filled AS (
  SELECT contract_id, customer_name, "CR_Rating", pmt_discipline,
         {", ".join(f"coalesce({q(c)}, avg({q(c)}) OVER ()) AS {q(c)}" for c in CANONICAL_NUMERIC)}
  FROM typed),
summed AS (
  SELECT contract_id, customer_name, {cols(S.SIZE_SHORT)}, {totals(S.SUMMED_CANONICAL)},
         {RATING} AS "CR_Rating_score", {LENIENT} AS pmt_discipline_score FROM filled),
featured AS (SELECT *, {_ratios(S.RATIOS_CANONICAL)} FROM summed),
clean AS (
  SELECT contract_id, customer_name, {zeroed}, target_variable
  FROM (SELECT *, {LABELLED} FROM featured))"""


def _v1() -> str:
    return f"""v1_typed AS (
  SELECT {PLAIN}, {", ".join(f"TRY_CAST(trunc({q(OLD.get(c, c))}) AS INTEGER) AS {q(c)}" for c in NUMERIC)}
  FROM raw WHERE {NAMED}),
v1_filled AS (
  SELECT contract_id, customer_name, "CR_Rating", pmt_discipline,
         {", ".join(f"coalesce({q(c)}, CAST(trunc(avg({q(c)}) OVER ()) AS INTEGER)) AS {q(c)}" for c in NUMERIC)}
  FROM v1_typed),
v1_summed AS (
  SELECT contract_id, customer_name, {cols(S.SIZE_SHORT)}, {totals(S.SUMMED, "CAST({} AS BIGINT)")},
         {RATING} AS "CR_Rating_score", {LENIENT} AS pmt_discipline_score FROM v1_filled),
v1_features AS (
  SELECT *, {LABELLED} FROM (SELECT *, {_ratios(S.RATIOS)} FROM v1_summed)),
v1 AS (
  SELECT * FROM v1_features WHERE {" AND ".join(f"{q(c)} IS NOT NULL" for c in S.NULL_DROP_SUBSET)})"""


def _three() -> str:
    from oracles.labels import banded

    zero = ", ".join(f"coalesce({q(OLD.get(c, c))}, 0) AS {q(c)}" for c in NUMERIC)
    return f"""three_typed AS (SELECT {PLAIN}, {zero} FROM raw),
three_summed AS (
  SELECT contract_id, customer_name, "CR_Rating", pmt_discipline, financing_currency, "YRS_In_BUS",
         {cols(S.SIZE_SHORT)}, {totals(S.SUMMED)},
         coalesce({RATING}, 0) AS "CR_Rating_score", coalesce({STRICT}, 0) AS pmt_discipline_score FROM three_typed),
three_features AS (SELECT *, {_ratios(S.RATIOS, "coalesce({}, 0)")} FROM three_summed),
three AS (
  SELECT *, CASE lower(risk) WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS risk_num
  FROM (SELECT *, {banded(((25, 50), (50, 75)), ("Low", "Medium", "High"), "High")} AS risk FROM three_features))"""


def with_tables(table: str, body: str) -> str:
    """``body`` with the chain of tables up to ``raw``, ``clean``, ``v1`` or ``three`` in scope."""
    chain = [LINES, _raw()]
    if table == "clean":
        chain.append(_canonical())
    elif table == "v1":
        chain.append(_v1())
    elif table == "three":
        chain.append(_three())
    return "WITH " + ",\n".join(chain) + "\n" + body
