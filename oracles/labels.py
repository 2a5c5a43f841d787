"""SQL conditions of the risk rules."""

from __future__ import annotations

MEASURES = [
    "profits_perc_TNW",
    "TNW_to_T-Exposure",
    "debt_equity_ratio",
    "debt_asset_ratio",
    "interest_cov_ratio",
    "current_ratio",
    "return_on_assets",
    "debt_ser_cov_ratio",
]
SCORES = ["CR_Rating_score", "pmt_discipline_score"]
COLUMNS = MEASURES + SCORES


def held(tests, quorum: int | None = None) -> str:
    """All the tests hold, or at least ``quorum`` of them."""
    if quorum is None:
        return " AND ".join(tests)
    return "(" + " + ".join(f"CASE WHEN {t} THEN 1 ELSE 0 END" for t in tests) + f") >= {quorum}"


def band_tests(limits, level: str, exposure_high=None, quorum=None) -> str:
    """Condition that every rule column lies above, in or below its band."""
    tests = []
    for c in COLUMNS:
        low, high = limits[1] if c in SCORES else limits[0]
        if level == "low":
            tests.append(f'"{c}" > {high}')
        elif level == "medium":
            tests.append(f'"{c}" BETWEEN {low} AND {high}')
        elif c == "TNW_to_T-Exposure":
            tests.append(f'"{c}" > {exposure_high}')
        else:
            tests.append(f'"{c}" < {low}')
    return held(tests, quorum)


def banded(limits, names, otherwise: str | None, exposure_high=None, quorum=None) -> str:
    low, medium = (band_tests(limits, level, quorum=quorum) for level in ("low", "medium"))
    cases = f"WHEN {low} THEN '{names[0]}' WHEN {medium} THEN '{names[1]}' "
    if exposure_high is not None:
        cases += f"WHEN {band_tests(limits, 'high', exposure_high, quorum)} THEN '{names[2]}' "
    return f"CASE {cases} ELSE {'NULL' if otherwise is None else repr(otherwise)} END"
