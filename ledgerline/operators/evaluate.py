"""Scoring reports: confusion counts, threshold curves and areas under them.

A scored frame holds a label, a hard prediction and a score for class 1.  All
class metrics come from one confusion count, all curves from one count per
distinct score.  ``by`` names columns such as model and split, to evaluate several in
one pass.  Labels other than 0 and 1 take no part in curves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordering import running_totals
from ledgerline.sources.staging import stage

LABEL, PREDICTION, SCORE = "label", "prediction", "score"


def _safe(above: Column, below: Column) -> Column:
    """Ratio, 0 where nothing was counted."""
    return F.coalesce(F.try_divide(above, below), F.lit(0.0))


# --- class metrics -----------------------------------------------------------------
def confusion_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(
        *by, F.col(LABEL).cast("int").alias("actual"), F.col(PREDICTION).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts for every (actual, predicted) pair of classes, zeros included."""
    counts = confusion_counts(scored, by)
    # a set of class numbers per group
    classes = counts.groupBy(*by).agg(
        F.array_union(F.collect_set("actual"), F.collect_set("predicted")).alias("classes")
    )
    cells = classes.select("*", F.explode("classes").alias("actual")).select(
        *by, "actual", F.explode("classes").alias("predicted")
    )
    return cells.join(counts, [*by, "actual", "predicted"], "left").select(
        *by, "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def class_scores(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    views = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), hit.alias("hit"), zero.alias("called")),
        F.struct(F.col("predicted").alias("class"), zero.alias("support"), zero.alias("hit"), F.col("n").alias("called")),
    )
    sums = (
        confusion_counts(scored, by)
        .select(*by, F.inline(views))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("hit").alias("hit"), F.sum("called").alias("called"))
    )
    precision, recall = _safe(F.col("hit"), F.col("called")), _safe(F.col("hit"), F.col("support"))
    return sums.select(
        *by,
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        _safe(2 * precision * recall, precision + recall).alias("f1"),
        "support",
        "hit",
    )


def _averages() -> dict[str, Column]:
    total = F.sum("support")
    return {
        "accuracy": _safe(F.sum("hit"), total),
        "support": total,
        **{f"macro_{m}": F.avg(m) for m in ("precision", "recall", "f1")},
        **{f"weighted_{m}": _safe(F.sum(F.col(m) * F.col("support")), total) for m in ("precision", "recall", "f1")},
    }


def class_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group: accuracy, macro and support-weighted precision, recall, F1."""
    return class_scores(scored, by).groupBy(*by).agg(*[v.alias(k) for k, v in _averages().items()])


def class_metric(scored: DataFrame, name: str) -> DataFrame:
    return class_metrics(scored).select(name)


def classification_report(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per class, then accuracy, macro average and weighted average."""
    per_class = class_scores(scored, by)
    lines = per_class.select(*by, F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    totals = per_class.groupBy(*by).agg(*[v.alias(k) for k, v in _averages().items()])

    def line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
        )

    nothing = F.lit(None).cast("double")
    extra = F.array(
        line("accuracy", nothing, nothing, F.col("accuracy")),
        *[
            line(f"{kind} avg", *[F.col(f"{kind}_{m}") for m in ("precision", "recall", "f1")])
            for kind in ("macro", "weighted")
        ],
    )
    return lines.unionByName(totals.select(*by, F.inline(extra)))


def binary_rates(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn and the rates from them, in one aggregate."""
    actual, called = F.col(LABEL) == 1, F.col(PREDICTION) == 1
    counts = scored.groupBy(*by).agg(
        F.count_if(actual & called).alias("tp"),
        F.count_if(~actual & called).alias("fp"),
        F.count_if(~actual & ~called).alias("tn"),
        F.count_if(actual & ~called).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        "*",
        F.try_divide(tp, tp + fn).alias("tpr"),
        F.try_divide(fp, fp + tn).alias("fpr"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
    )


def binary_rates_class0(scored: DataFrame, by: Sequence[str] = (), *, compat: bool = False) -> DataFrame:
    """Precision and recall of class 0; ``compat`` prints the two the other way round."""
    rates = scored.groupBy(*by).agg(
        F.try_divide(
            F.count_if((F.col(LABEL) == 0) & (F.col(PREDICTION) == 0)), F.count_if(F.col(PREDICTION) == 0)
        ).alias("precision"),
        F.try_divide(
            F.count_if((F.col(LABEL) == 0) & (F.col(PREDICTION) == 0)), F.count_if(F.col(LABEL) == 0)
        ).alias("recall"),
    )
    if not compat:
        return rates
    return rates.select(*by, F.col("recall").alias("precision"), F.col("precision").alias("recall"))


# --- curves ----------------------------------------------------------------------------
def score_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy(*by, SCORE).agg(
        F.count_if(F.col(LABEL) == 1).alias("pos"), F.count_if(F.col(LABEL) == 0).alias("neg")
    )


def _curve(scored: DataFrame, by: Sequence[str], ranges: int | None, carry: Sequence[str] = ()) -> DataFrame:
    """Counts at and above each distinct score, with the group totals P and N.

    The scored rows are read once, for a written table of counts that all later steps read.
    """
    counts = stage(score_counts(scored, by).filter("pos + neg > 0"), "score-counts")
    summed = running_totals(counts, SCORE, ["pos", "neg"], by, descending=True, ranges=ranges, carry=carry)
    totals = counts.groupBy(*by).agg(F.sum("pos").cast("double").alias("P"), F.sum("neg").cast("double").alias("N"))
    if by:
        return summed.join(totals, list(by))
    row = totals.select(F.struct("P", "N")).scalar()
    return summed.withColumn("_t", row).select(
        *summed.columns, F.col("_t.P").alias("P"), F.col("_t.N").alias("N")
    )


def roc_curve(
    scored: DataFrame, by: Sequence[str] = (), *, drop_collinear: bool = True, ranges: int | None = None
) -> DataFrame:
    """(threshold, fpr, tpr), from (0, 0) with a null threshold downwards.

    ``drop_collinear`` leaves out a threshold when the step to the next one adds
    the same counts again, as such a point lies on a straight line.  The row of
    (0, 0) comes with the highest score, so a group without rows has no curve.
    """
    by = list(by)
    points = _curve(scored, by, ranges, carry=["pos", "neg"] if drop_collinear else [])
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    if drop_collinear:
        last = F.col("next_pos").isNull()
        turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        points = points.filter(first | last | turns)
    here = F.struct(
        F.col(SCORE).cast("double").alias("threshold"),
        F.try_divide(F.col("cum_neg"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("cum_pos"), F.col("P")).alias("tpr"),
    )
    origin = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    rows = F.explode(F.when(first, F.array(origin, here)).otherwise(F.array(here)))
    return points.select(*by, rows.alias("_point")).select(*by, "_point.*")


def roc_auc_trapezoid(scored: DataFrame, by: Sequence[str] = (), *, ranges: int | None = None) -> DataFrame:
    """Area under the ROC curve from the curve's own points, each joined to the next one below it.

    The points are written first.  ``auc_roc`` computes the same area from counts.
    """
    by = list(by)
    # along the curve at least one axis grows with every point, so that their sum orders the points
    curve = roc_curve(scored, by, ranges=ranges).drop("threshold")
    points = stage(curve.withColumn("along", F.col("fpr") + F.col("tpr")), "roc-points")
    steps = running_totals(points, "along", [], by, ranges=ranges, carry=["fpr", "tpr"])
    area = (F.col("next_fpr") - F.col("fpr")) * (F.col("next_tpr") + F.col("tpr")) / 2
    return steps.groupBy(*by).agg(F.sum(area).alias("auc_roc"))


def auc_roc(scored: DataFrame, by: Sequence[str] = (), *, ranges: int | None = None) -> DataFrame:
    """Exact area under the ROC curve: trapezoids over the distinct scores."""
    curve = _curve(scored, by, ranges)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    area = neg * (F.col("cum_pos") - pos / 2)
    return curve.groupBy(*by).agg(
        F.try_divide(F.sum(area), F.max(F.col("P")) * F.max(F.col("N"))).alias("auc_roc")
    )


def auc_pr(scored: DataFrame, by: Sequence[str] = (), *, ranges: int | None = None) -> DataFrame:
    """Exact area under precision over recall; the curve starts at its first precision."""
    curve = _curve(scored, by, ranges)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    here = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp0, tp0 + fp0), here)
    return curve.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * (here + before) / 2), F.max("P")).alias("auc_pr")
    )
