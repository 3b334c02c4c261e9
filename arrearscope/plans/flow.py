"""The whole flow over stored tables: ingest, targets, features, splits, training, reports.

Every step writes its table once and reads it back afterwards; a table that is already
there is not built again. A step whose input is missing raises ``FileNotFoundError``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.config import RiskConfig
from arrearscope.operators import clean, features, metrics, models, panel, reports, splits
from arrearscope.operators.ordered import range_edges
from arrearscope.sources.raw_files import load_origination, load_servicing
from arrearscope.sources.tables import is_complete, load_table, materialize, save_report, save_splits


@dataclass(frozen=True)
class Paths:
    """One place for all table names, so that no step reads what another did not write."""

    base: str

    def of(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"


def ingest(
    spark: SparkSession, raw_dir: str, paths: Paths, year_start: int, year_end: int
) -> tuple[DataFrame, DataFrame]:
    """Raw files of a year range to cleaned origination and servicing tables."""
    years = f"{raw_dir} {year_start}-{year_end}"
    orig = materialize(spark, paths.of("origination"), lambda: clean.clean_origination(
        load_origination(spark, raw_dir, year_start, year_end)), years)
    svcg = materialize(spark, paths.of("servicing"), lambda: clean.clean_servicing(
        load_servicing(spark, raw_dir, year_start, year_end)), years)
    return orig, svcg


def targets(
    spark: SparkSession, paths: Paths, config: RiskConfig = RiskConfig(), direction: str = "trailing"
) -> DataFrame:
    """Servicing to one labelled row per loan."""
    def build() -> DataFrame:
        # unused text columns would only make the rows that are shuffled wider
        svcg = load_table(spark, paths.of("servicing")).drop("MONTHLY_RPT_PRD", "ZERO_BAL_EFF_DATE", "MOD_FLAG")
        return panel.snapshot(clean.one_row_per_month(svcg), config, direction)

    return materialize(spark, paths.of(f"snapshot_{direction}"), build, f"{direction} {config}")


def modeling(
    spark: SparkSession, paths: Paths, config: RiskConfig = RiskConfig(), direction: str = "trailing"
) -> DataFrame:
    """Snapshot and origination to the imputed modeling table."""
    def build() -> DataFrame:
        snap = load_table(spark, paths.of(f"snapshot_{direction}"))
        return features.modeling_table(snap, load_table(spark, paths.of("origination")), config)

    return materialize(spark, paths.of(f"modeling_{direction}"), build, f"{direction} {config}")


def split(
    spark: SparkSession, paths: Paths, config: RiskConfig = RiskConfig(), direction: str = "trailing"
) -> DataFrame:
    """Modeling rows with split columns; the parts are also written as folders for other readers."""
    rows = splits.add_splits(load_table(spark, paths.of(f"modeling_{direction}")), config)
    parts = paths.of(f"splits_{direction}")
    if not is_complete(spark, parts):
        save_splits(rows, parts)
    return rows


def train(
    spark: SparkSession, paths: Paths, config: RiskConfig = RiskConfig(), direction: str = "trailing",
    scheme: str = "oot", allow_overlap: bool = False,
) -> models.TrainedModels:
    """Fit on the train rows of a scheme (the other scheme if it has none) and store the models.

    Beside the models, ``training`` holds the scheme and the validation rows that were really used.
    """
    rows = split(spark, paths, config, direction)
    chosen = scheme
    if rows.filter(F.col(f"split_{scheme}") == "train").isEmpty():
        chosen = "oos" if scheme == "oot" else "oot"
    frame = splits.training_frame(rows, chosen, allow_overlap)
    held_out = "oos_val"
    if frame.filter("is_validation").isEmpty():
        held_out = "holdout"
        frame = splits.holdout_frame(rows.filter(F.col(f"split_{chosen}") == "train"), config=config)
    trained = models.train_all(frame, config)
    models.save_models(spark, trained, paths.of(f"models_{direction}"))
    used = [(scheme, chosen, held_out, name) for name in [*trained.models, *trained.failures]]
    spark.createDataFrame(used, "asked string, trained_on string, validated_on string, model string").coalesce(1).write.mode(
        "overwrite").parquet(paths.of(f"models_{direction}/training"))
    return trained


def evaluate(
    spark: SparkSession, paths: Paths, config: RiskConfig = RiskConfig(), direction: str = "trailing"
) -> dict[str, DataFrame]:
    """Score the test parts with the stored models and write the report tables."""
    trained = models.load_models(spark, paths.of(f"models_{direction}"))
    rows = split(spark, paths, config, direction)
    models.score_splits(trained, rows).write.mode("overwrite").parquet(paths.of(f"scored_{direction}"))
    scored = load_table(spark, paths.of(f"scored_{direction}"))
    metrics.metric_rows(scored).write.mode("overwrite").parquet(paths.of(f"metrics_{direction}"))
    rated = load_table(spark, paths.of(f"metrics_{direction}"))
    importances = models.feature_importances(spark, trained)
    # without two models there is no ensemble: the reports are then about the only one
    chosen = models.ENSEMBLE if trained.weights else next(iter(trained.models))
    voted = scored.filter(F.col("model") == chosen)
    edges = range_edges(voted, "p")
    points = reports.add_scores(voted, score="score", scale=config.score_scale)
    deciles = reports.ks_deciles(voted, edges=edges)
    tables = {
        "metrics": rated,
        "model_comparison": metrics.comparison_table(rated),
        "model_ranking": metrics.rank_models(rated.filter(F.col("split") == "oot")),
        "best_model": metrics.best_model(rated),
        "metric_pivot": metrics.metric_pivot(rated),
        "stability": metrics.stability_drop(rated),
        "feature_importance": importances,
        "top_features": models.top_features(importances, next(iter(trained.models))),
        "score_distribution": reports.score_distribution(points.filter(F.col("split") == "oot"), scale=config.score_scale),
        "score_histogram": reports.histogram(
            points, "score", 30, config.score_scale.low, config.score_scale.high, ["model", "split", "y"]),
        "ks_deciles": deciles,
        "max_ks": reports.max_ks(deciles),
        "psi": reports.psi(reports.psi_bins(voted, edges=edges)),
    }
    # a curve has a point for each distinct score, which grows with the rows: a table, not a report
    metrics.roc_points(scored).write.mode("overwrite").parquet(paths.of(f"roc_points_{direction}"))
    for name, table in tables.items():
        save_report(table, paths.of(f"reports_{direction}/{name}"))
    return {name: load_table(spark, paths.of(f"reports_{direction}/{name}"), "csv") for name in tables}
