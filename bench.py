"""Time the headline queries once each and print one JSON line.

BENCH_SF_DIR picks the input folder, BENCH_CPUS the local cores.  ``stage_raw``
and ``stage_clean`` are the one-off writes that the later queries read.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerline.plans.workload import QUERIES, staged  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

HEADLINE = [
    "flagship_label_balance",
    "adapter_credit_raw",
    "prepare_canonical",
    "prepare_binary_v1",
    "prepare_three_class",
    "null_count_by_market",
    "null_nonnull_by_column",
    "impute_mean_double",
    "describe",
    "describe_exact",
    "describe_exact_lineitem",
    "summary_approx",
    "corr_matrix_pairwise",
    "corr_matrix_lineitem",
    "zscore_outlier_count",
    "box_stats",
    "box_stats_lineitem",
    "histogram_20",
    "histogram_lineitem",
    "kde_grid",
    "pair_scatter",
    "chi_square_select",
    "label_risk_category",
    "label_percentile",
    "standardize",
    "cv_folds",
    "auc_roc",
    "roc_curve",
    "classification_report",
    "logreg_binary",
    "naive_bayes_gaussian",
    "random_forest",
    "model_comparison",
    "copula_fit",
    "copula_sample",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("ledgerline-bench", os.environ.get("BENCH_CPUS", "8"))
    seconds: dict[str, float] = {}

    def timed(name, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("stage_raw", lambda: staged(spark, sf_dir, "raw"))
    timed("stage_clean", lambda: staged(spark, sf_dir, "canonical"))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
