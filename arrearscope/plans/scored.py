"""Closed-form scores of the test panel, so that metrics can be checked against SQL.

Three fixed logistic formulas over snapshot and origination columns stand in for
trained models. Scores are rounded to six digits: both engines then see equal values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.config import LOAN, TARGET
from arrearscope.operators.features import join_origination
from arrearscope.operators.panel import snapshot
from arrearscope.operators.splits import add_splits
from arrearscope.plans import testbed

MODELS = ("behaviour", "blend", "static")


def formulas() -> dict[str, Column]:
    behaviour = (
        F.lit(-3.4) + 0.8 * F.log1p("max_delinq_12m") + 0.3 * F.col("n_delinq_months_12m")
        - 0.02 * F.col("payment_streak")
    )
    static = (
        F.lit(-1.2) + 0.015 * (F.coalesce("ORIG_LTV", F.lit(80.0)) - 80)
        - 0.004 * (F.coalesce("CREDIT_SCORE", F.lit(700.0)) - 700)
    )
    logits = {"behaviour": behaviour, "blend": 0.5 * behaviour + 0.5 * static, "static": static}
    return {name: F.round(1 / (1 + F.exp(-logit)), 6) for name, logit in logits.items()}


def scored_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled loans with split columns and one probability column per formula."""
    snap = snapshot(testbed.panel(spark, folder))
    joined = join_origination(snap, testbed.origination(spark, folder))
    return add_splits(joined).select(
        LOAN, "orig_year", F.col(TARGET).alias("y"), "split_oos", "split_oot",
        *[formula.alias(name) for name, formula in formulas().items()],
    )


def scored_test(spark: SparkSession, folder: str) -> DataFrame:
    """(split, loan, y, model, p) of the out-of-sample and out-of-time test rows."""
    schemes = F.array_compact(F.array(
        F.when(F.col("split_oos") == "test", "oos"), F.when(F.col("split_oot") == "test", "oot")
    ))
    rows = scored_wide(spark, folder).select(F.explode(schemes).alias("split"), LOAN, "y", *MODELS)
    return rows.unpivot(["split", LOAN, "y"], list(MODELS), "model", "p")
