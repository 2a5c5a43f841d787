"""Reports that cover every column, not a choice of them."""

import pytest

from __spark_entry__ import queries
from ledgerline import schema as S

LOGS = {f"log1p_{c}" for c in S.LOG_COLUMNS}


@pytest.mark.parametrize("name", ["kde_grid_log_columns", "box_stats_log_columns"])
def test_all_log_columns_are_reported(spark, sf_dir, name):
    assert {r["column"] for r in queries()[name](spark, sf_dir).select("column").distinct().collect()} == LOGS


def test_frames_have_all_columns(spark, sf_dir):
    run = queries()
    assert run["join_fold_all_columns"](spark, sf_dir).columns == ["market", *[f"null_{c}" for c in S.RAW_COLUMNS]]
    assert run["features_frame"](spark, sf_dir).columns == [S.KEY, *S.FEATURES]
    assert run["label_frame"](spark, sf_dir).columns == [S.KEY, S.LABEL]
