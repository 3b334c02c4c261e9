"""Exact validation metrics of scored rows, grouped by any columns (model, split, ...).

Ranking metrics are computed from one table: distinct scores with their counts of events
and non-events. It is built with map-side combining, so a score that many rows share costs
one row, and :func:`arrearscope.operators.ordered.prefix_sums` puts it in order. Metrics
that need no order are plain sums over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.operators.ordered import prefix_sums, range_edges

MODEL_SPLIT = ("model", "split")


def _labelled_scores(scored: DataFrame, groups: Sequence[str], score: str, label: str) -> DataFrame:
    """Every labelled row as ``n_pos``/``n_neg`` of one; other rows are left out."""
    event = (F.col(label) == 1).cast("int")
    return scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).select(
        *groups, score, event.alias("n_pos"), (1 - event).alias("n_neg")
    )


def score_counts(
    scored: DataFrame, groups: Sequence[str] = MODEL_SPLIT, score: str = "p", label: str = "y"
) -> DataFrame:
    """Distinct scores per group with ``n_pos`` and ``n_neg``; unlabelled rows are left out."""
    return _labelled_scores(scored, groups, score, label).groupBy(*groups, score).agg(
        F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg")
    )


def score_curve(
    scored: DataFrame,
    groups: Sequence[str] = MODEL_SPLIT,
    score: str = "p",
    label: str = "y",
    edges: Sequence[float] | None = None,
    following: Sequence[str] = (),
) -> DataFrame:
    """Score counts with running and total counts, from the highest score down.

    ``edges`` from :func:`range_edges` save a pass when several curves share one table.
    """
    edges = edges or range_edges(scored, score)
    counts = score_counts(scored, groups, score, label)
    return prefix_sums(counts, groups, score, ["n_pos", "n_neg"], edges, following=following)


def _all_pos() -> Column:
    return F.col("total_n_pos")


def _all_neg() -> Column:
    return F.col("total_n_neg")


def _auc() -> Column:
    # a tied pair counts one half
    wins = F.col("n_neg") * (F.col("cum_n_pos") - F.col("n_pos") / 2)
    return F.try_divide(F.sum(wins), F.max(_all_pos().cast("double") * _all_neg()))


def _ks() -> Column:
    gap = F.abs(F.try_divide(F.col("cum_n_pos"), _all_pos()) - F.try_divide(F.col("cum_n_neg"), _all_neg()))
    return F.when(F.max(_all_pos()) == 0, 0.0).otherwise(F.max(gap))


def _average_precision() -> Column:
    hits = F.col("n_pos") * (F.col("cum_n_pos") / (F.col("cum_n_pos") + F.col("cum_n_neg")))
    return F.try_divide(F.sum(hits), F.max(_all_pos()))


def _brier(score: str) -> Column:
    p = F.col(score)
    loss = F.col("n_pos") * (1 - p) * (1 - p) + F.col("n_neg") * p * p
    return F.try_divide(F.sum(loss), F.sum(F.col("n_pos") + F.col("n_neg")))


def ranking_metrics(curve: DataFrame, groups: Sequence[str] = MODEL_SPLIT) -> DataFrame:
    """Unrounded AUC, Gini, KS and average precision of a :func:`score_curve`."""
    return (
        curve.groupBy(*groups)
        .agg(_auc().alias("auc_roc"), _ks().alias("ks_stat"), _average_precision().alias("auc_pr"))
        .withColumn("gini", 2 * F.col("auc_roc") - 1)
        .select(*groups, "auc_roc", "gini", "ks_stat", "auc_pr")
    )


def _confusion_counts(score: str, threshold: float) -> dict[str, Column]:
    called = F.col(score) >= threshold

    def count(condition: Column, column: str) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    return {"TP": count(called, "n_pos"), "TN": count(~called, "n_neg"),
            "FP": count(called, "n_neg"), "FN": count(~called, "n_pos")}


def _ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(0.0)


def _threshold_rates() -> dict[str, Column]:
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("FN")
    return {
        "precision": _ratio_or_zero(tp, tp + fp),
        "recall": _ratio_or_zero(tp, tp + fn),
        "f1": _ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def confusion_metrics(
    scored: DataFrame,
    groups: Sequence[str] = MODEL_SPLIT,
    threshold: float = 0.5,
    score: str = "p",
    label: str = "y",
) -> DataFrame:
    """Confusion counts at ``score >= threshold`` with precision, recall and F1 (0 if undefined)."""
    counts = {name: column.alias(name) for name, column in _confusion_counts(score, threshold).items()}
    return (
        _labelled_scores(scored, groups, score, label).groupBy(*groups).agg(*counts.values())
        .withColumns({name: F.bround(rate, 4) for name, rate in _threshold_rates().items()})
    )


def brier_score(
    scored: DataFrame, groups: Sequence[str] = MODEL_SPLIT, score: str = "p", label: str = "y"
) -> DataFrame:
    return _labelled_scores(scored, groups, score, label).groupBy(*groups).agg(
        F.bround(_brier(score), 5).alias("brier_score")
    )


def metric_rows(
    scored: DataFrame,
    groups: Sequence[str] = MODEL_SPLIT,
    threshold: float = 0.5,
    score: str = "p",
    label: str = "y",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """The full metric row of every group, rounded for reports, from one pass.

    The confusion counts are null when labels and calls together hold one class only.
    """
    curve = score_curve(scored, groups, score, label, edges)
    counts = _confusion_counts(score, threshold)
    raw = curve.groupBy(*groups).agg(
        F.sum(F.col("n_pos") + F.col("n_neg")).alias("n_total"),
        F.sum("n_pos").alias("n_positive"),
        _auc().alias("auc"), _ks().alias("ks"), _average_precision().alias("ap"),
        _brier(score).alias("brier"),
        *[column.alias(name) for name, column in counts.items()],
    )
    rates = _threshold_rates()
    both_classes = (F.col("TP") + F.col("FP") + F.col("FN") > 0) & (F.col("TN") + F.col("FP") + F.col("FN") > 0)
    return raw.select(
        *groups,
        "n_total",
        "n_positive",
        F.bround(100.0 * F.col("n_positive") / F.col("n_total"), 2).alias("default_rate_pct"),
        F.bround("auc", 4).alias("auc_roc"),
        F.bround(2 * F.col("auc") - 1, 4).alias("gini"),
        F.bround("ks", 4).alias("ks_stat"),
        F.bround("ap", 4).alias("auc_pr"),
        F.bround("brier", 5).alias("brier_score"),
        *[F.bround(rates[name], 4).alias(name) for name in ("f1", "precision", "recall")],
        *[F.when(both_classes, F.col(name)).alias(name) for name in counts],
    )


def roc_points(
    scored: DataFrame,
    groups: Sequence[str] = MODEL_SPLIT,
    score: str = "p",
    label: str = "y",
    edges: Sequence[float] | None = None,
    drop_collinear: bool = True,
) -> DataFrame:
    """False and true positive rate at every threshold, plus the origin (null threshold).

    With ``drop_collinear`` a point between the first and the last goes if the next step
    repeats its own step, which leaves the drawn curve unchanged.
    """
    steps = ["n_pos", "n_neg"]
    curve = score_curve(scored, groups, score, label, edges, following=steps if drop_collinear else ())
    first = F.col("cum_n_pos") + F.col("cum_n_neg") == F.col("n_pos") + F.col("n_neg")
    point = F.struct(
        F.col(score).cast("double").alias("threshold"),
        F.try_divide(F.col("cum_n_neg"), _all_neg()).alias("fpr"),
        F.try_divide(F.col("cum_n_pos"), _all_pos()).alias("tpr"),
    )
    origin = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    if drop_collinear:
        repeats = (F.col("next_n_pos") == F.col("n_pos")) & (F.col("next_n_neg") == F.col("n_neg"))
        kept = F.coalesce(~repeats, F.lit(True))  # nothing follows the last point
    else:
        kept = F.lit(True)
    points = F.when(first, F.array(origin, point)).when(kept, F.array(point))
    return curve.select(*groups, F.inline(points))


def pr_points(
    scored: DataFrame,
    groups: Sequence[str] = MODEL_SPLIT,
    score: str = "p",
    label: str = "y",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Precision and recall at every threshold, plus the closing point (1, 0) with null threshold."""
    curve = score_curve(scored, groups, score, label, edges)
    found = F.col("cum_n_pos") + F.col("cum_n_neg")
    first = found == F.col("n_pos") + F.col("n_neg")
    point = F.struct(
        F.col(score).cast("double").alias("threshold"),
        (F.col("cum_n_pos") / found).alias("precision"),
        F.coalesce(F.try_divide(F.col("cum_n_pos"), _all_pos()), F.lit(1.0)).alias("recall"),
    )
    closing = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.select(*groups, F.inline(F.when(first, F.array(point, closing)).otherwise(F.array(point))))


def default_rate(df: DataFrame, groups: Sequence[str] = (), label: str = "TARGET_12M") -> DataFrame:
    """Rows, defaults, non-defaults and default rate in percent; unlabelled rows count as rows."""
    positives = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    total = F.count(F.lit(1))
    return df.groupBy(*groups).agg(
        total.alias("n_loans"),
        F.coalesce(positives, F.lit(0)).alias("n_defaults"),
        (total - F.coalesce(positives, F.lit(0))).alias("n_non_defaults"),
        F.bround(
            100.0 * F.coalesce(positives, F.lit(0)) / F.greatest(total, F.lit(1)), 2
        ).alias("default_rate_pct"),
    )


def label_counts(df: DataFrame, label: str = "TARGET_12M") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_imbalance(df: DataFrame, groups: Sequence[str] = (), label: str = "TARGET_12M") -> DataFrame:
    """Negatives per positive (per one, if there is none)."""
    counted = df.groupBy(*groups).agg(
        F.coalesce(F.sum((F.col(label) == 0).cast("int")), F.lit(0)).alias("n_neg"),
        F.coalesce(F.sum((F.col(label) == 1).cast("int")), F.lit(0)).alias("n_pos"),
    )
    return counted.withColumn(
        "imbalance_ratio", F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1))
    )


def comparison_table(metrics: DataFrame) -> DataFrame:
    """Report columns of the metric rows, by split and best AUC first."""
    columns = ("model", "split", "n_total", "default_rate_pct", "auc_roc", "gini", "ks_stat", "auc_pr", "f1")
    return metrics.select(*[name for name in columns if name in metrics.columns]).orderBy(
        F.asc("split"), F.desc("auc_roc"), F.asc("model")
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("auc_roc"), F.asc("model"))


def best_model(metrics: DataFrame, split: str = "oot") -> DataFrame:
    return rank_models(metrics.filter(F.col("split") == split)).limit(1)


def metric_pivot(metrics: DataFrame, values: Sequence[str] = ("auc_roc", "ks_stat"),
                 splits: Sequence[str] = ("oos", "oot")) -> DataFrame:
    """One row per model, one ``<split>_<metric>`` column per split and metric."""
    return metrics.groupBy("model").pivot("split", list(splits)).agg(
        *[F.first(value).alias(value) for value in values]
    )


def stability_drop(metrics: DataFrame, limit: float = 0.05) -> DataFrame:
    """AUC out of sample minus AUC out of time, flagged when it exceeds ``limit``."""
    aligned = metrics.groupBy("model").agg(
        F.max(F.when(F.col("split") == "oos", F.col("auc_roc"))).alias("oos_auc"),
        F.max(F.when(F.col("split") == "oot", F.col("auc_roc"))).alias("oot_auc"),
    )
    return aligned.withColumn("auc_drop", F.col("oos_auc") - F.col("oot_auc")).withColumn(
        "high_degradation", F.coalesce(F.col("auc_drop") > limit, F.lit(False)).cast("int")
    )


def ensemble_weights(metrics: DataFrame, groups: Sequence[str] = ("split",)) -> DataFrame:
    """Every model's share of the summed AUC within its group."""
    whole = Window.partitionBy(*groups)
    return metrics.select(
        *groups, "model", (F.col("auc_roc") / F.sum("auc_roc").over(whole)).alias("weight")
    )


def soft_vote(scored: DataFrame, weights: DataFrame, keys: Sequence[str], group: str = "split") -> DataFrame:
    """Mean of the models' ``p`` for each row of ``keys``, weighted by ``weights`` (group, model, weight: one row a model)."""
    weighted = scored.join(weights.select(group, "model", "weight"), [group, "model"])
    return weighted.groupBy(*keys).agg((F.sum(F.col("p") * F.col("weight")) / F.sum("weight")).alias("p"))
