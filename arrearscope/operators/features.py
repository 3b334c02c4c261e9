"""Feature engineering on the origination table and on the joined modeling table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearscope.config import LOAN, MISSING_INDICATOR_COLUMNS, RiskConfig
from arrearscope.functions import features as f
from arrearscope.operators.ordered import exact_quantiles


def medians_of(df: DataFrame, fallbacks: dict[str, float], approximate: bool = False) -> dict[str, Column]:
    """Median of each column as a scalar subquery; the fallback where a column has no value.

    All columns go through one counting pass. The result is a single row, so nothing is
    joined and nothing passes through the driver.
    """
    if approximate:
        row = df.agg(*[F.percentile_approx(name, 0.5).cast("double").alias(name) for name in fallbacks])
    else:
        pairs = F.array(*[
            F.struct(F.lit(name).alias("_column"), F.col(name).cast("double").alias("_value"))
            for name in fallbacks
        ])
        found = exact_quantiles(df.select(F.inline(pairs)), "_value", {"_median": 0.5}, ["_column"])
        row = found.agg(*[
            F.max(F.when(F.col("_column") == name, F.col("_median"))).alias(name) for name in fallbacks
        ])
    medians = row.select(F.struct(*fallbacks)).scalar()
    return {name: F.coalesce(medians.getField(name), F.lit(value)) for name, value in fallbacks.items()}


def add_ltv_dti_interaction(orig: DataFrame, approximate: bool = False) -> DataFrame:
    """LTV times DTI with missing values set to the median over all origination rows."""
    medians = medians_of(
        orig, {"ORIG_LTV": f.FALLBACK_MEDIAN_LTV, "ORIG_DTI": f.FALLBACK_MEDIAN_DTI}, approximate
    )
    ltv, dti = (F.coalesce(F.col(name), medians[name]) for name in ("ORIG_LTV", "ORIG_DTI"))
    return orig.withColumn("ltv_dti_interaction", ltv * dti)


def add_origination_buckets(orig: DataFrame, missing: str = "unknown") -> DataFrame:
    return orig.withColumns({
        "credit_score_bucket": f.credit_score_bucket(F.col("CREDIT_SCORE"), missing),
        "ltv_bucket": f.ltv_bucket(F.col("ORIG_LTV"), missing),
        "dti_bucket": f.dti_bucket(F.col("ORIG_DTI"), missing),
    })


def add_origination_flags(orig: DataFrame, nulls: str = "null") -> DataFrame:
    columns = {
        "is_high_ltv": f.exceeds(F.col("ORIG_LTV"), f.HIGH_LTV, nulls),
        "is_high_dti": f.exceeds(F.col("ORIG_DTI"), f.HIGH_DTI, nulls),
        "has_mi": f.is_positive(F.col("MI_PCT")),
    }
    if "PPM_FLAG" in orig.columns:
        columns["is_ppm"] = f.is_yes(F.col("PPM_FLAG"))
    return orig.withColumns(columns)


def add_origination_amounts(orig: DataFrame) -> DataFrame:
    return orig.withColumns({
        "log_orig_upb": f.log_amount(F.col("ORIG_UPB")),
        "credit_ltv_ratio": f.positive_ratio(F.col("CREDIT_SCORE"), F.col("ORIG_LTV")),
        "est_monthly_payment": f.monthly_payment(
            F.col("ORIG_UPB"), F.col("ORIG_INTEREST_RATE"), F.col("ORIG_LOAN_TERM")
        ),
    })


def add_vintage_features(orig: DataFrame, year: str = "orig_year") -> DataFrame:
    vintage = F.col(year)
    return orig.withColumns({
        "econ_regime": f.economic_regime(vintage),
        "is_bubble_vintage": f.year_flag(vintage.between(2004, 2007)),
        "is_gfc_vintage": f.year_flag(vintage.between(2008, 2009)),
        "is_post_gfc": f.year_flag(vintage >= 2010),
    })


def add_missing_indicators(df: DataFrame) -> DataFrame:
    """0/1 columns for missing values; call it before :func:`impute`."""
    present = [name for name in MISSING_INDICATOR_COLUMNS if name in df.columns]
    return df.withColumns({f"{name}_MISSING": f.missing_flag(F.col(name)) for name in present})


def add_origination_features(orig: DataFrame, approximate_median: bool = False) -> DataFrame:
    featured = add_ltv_dti_interaction(orig, approximate_median)
    for step in (add_origination_buckets, add_origination_flags, add_origination_amounts,
                 add_vintage_features, add_missing_indicators):
        featured = step(featured)
    return featured


def add_dynamic_features(
    joined: DataFrame, zero: str = "null", age_variant: str = "inclusive", missing: str = "unknown"
) -> DataFrame:
    """Age, remaining life, balance and rate relative to origination."""
    age, term = F.col("LOAN_AGE"), F.col("ORIG_LOAN_TERM")
    return joined.withColumns({
        "loan_age_months": age.cast("double"),
        "loan_age_ratio": f.ratio(age, term, zero),
        "pct_life_remaining": f.ratio(F.col("REM_MONTHS_MATURITY"), term, zero),
        "upb_pct_remaining": f.ratio(F.col("CURR_ACTUAL_UPB"), F.col("ORIG_UPB"), zero),
        "rate_spread": F.col("CURR_INTEREST_RATE") - F.col("ORIG_INTEREST_RATE"),
        "was_modified": F.coalesce(F.col("MODIFIED"), F.lit(0)).cast("int"),
        "loan_age_bucket": f.loan_age_bucket(age, missing, age_variant),
    })


def impute(df: DataFrame, config: RiskConfig = RiskConfig()) -> DataFrame:
    """-1 for missing numeric features, ``UNKNOWN`` for missing categories."""
    numeric = {name: F.coalesce(F.col(name).cast("double"), F.lit(-1.0))
               for name in config.numeric_features if name in df.columns}
    categorical = {name: F.coalesce(F.col(name).cast("string"), F.lit("UNKNOWN"))
                   for name in config.categorical_features if name in df.columns}
    return df.withColumns(numeric | categorical)


def join_origination(snapshot: DataFrame, orig: DataFrame, loan: str = LOAN) -> DataFrame:
    """Inner equi-join on the loan key.

    The snapshot is already partitioned by loan, so a sort-merge plan only moves the
    origination side. The plan is asked for: origination grows with the loans, and from a small file it would be
    broadcast by that file's size, whole and through one task.
    """
    return snapshot.join(orig.hint("merge"), loan, "inner")


def modeling_table(
    snapshot: DataFrame,
    orig: DataFrame,
    config: RiskConfig = RiskConfig(),
    approximate_median: bool = False,
) -> DataFrame:
    """Snapshot and origination joined, with all features, imputed."""
    joined = join_origination(snapshot, add_origination_features(orig, approximate_median))
    return impute(add_dynamic_features(joined), config)


def basic_modeling_table(
    snapshot: DataFrame, orig: DataFrame, config: RiskConfig = RiskConfig(), nulls: str = "zero"
) -> DataFrame:
    """The short feature set: age, flags and missing indicators on top of the joined columns.

    ``nulls`` is what the high-LTV and high-DTI flags hold for a missing value.
    """
    joined = join_origination(snapshot, orig)
    flagged = add_origination_flags(joined, nulls).drop("is_ppm")
    aged = flagged.withColumn("loan_age_months", F.col("LOAN_AGE").cast("double"))
    return impute(add_missing_indicators(aged), config)
