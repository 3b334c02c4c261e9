"""Settings of the risk flow.

Every operator takes what it needs from a :class:`RiskConfig`, so a caller who
wants other windows, code lists or ranges passes a changed copy
(``dataclasses.replace``) instead of editing the library.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# File layouts, code lists, ranges, names and model settings that
# results must agree on.
# ---------------------------------------------------------------------------

# position in the pipe-delimited line -> column
ORIGINATION_LAYOUT = {
    0: "CREDIT_SCORE",
    1: "FIRST_PAYMENT_DATE",
    3: "MATURITY_DATE",
    5: "MI_PCT",
    8: "ORIG_CLTV",
    9: "ORIG_DTI",
    10: "ORIG_UPB",
    11: "ORIG_LTV",
    12: "ORIG_INTEREST_RATE",
    14: "PPM_FLAG",
    16: "PROPERTY_STATE",
    19: "LOAN_SEQUENCE_NUMBER",
    21: "ORIG_LOAN_TERM",
    24: "SERVICER_NAME",
}
SERVICING_LAYOUT = {
    0: "LOAN_SEQUENCE_NUMBER",
    1: "MONTHLY_RPT_PRD",
    2: "CURR_ACTUAL_UPB",
    3: "DLQCY_STATUS",
    4: "LOAN_AGE",
    5: "REM_MONTHS_MATURITY",
    7: "MOD_FLAG",
    8: "ZERO_BAL_CD",
    9: "ZERO_BAL_EFF_DATE",
    10: "CURR_INTEREST_RATE",
}

SENTINELS = {
    "CREDIT_SCORE": 9999.0,
    "MI_PCT": 999.0,
    "ORIG_CLTV": 999.0,
    "ORIG_DTI": 999.0,
    "ORIG_LTV": 999.0,
}
VALID_RANGES = {
    "CREDIT_SCORE": (300, 850),
    "MI_PCT": (0, 55),
    "ORIG_CLTV": (1, 998),
    "ORIG_DTI": (0, 65),
    "ORIG_LTV": (1, 998),
}

SERIOUS_DELINQUENCY_CODES = tuple(str(months) for months in range(3, 25)) + ("RA",)
LOSS_CODES = ("02", "03", "09", "15", "16")
PREPAY_CODE = "01"
MODIFIED_FLAGS = ("Y", "P")
NULL_TOKENS = ("", "nan", "None", "null")

MISSING_INDICATOR_COLUMNS = ("CREDIT_SCORE", "ORIG_DTI", "ORIG_LTV", "ORIG_CLTV", "MI_PCT")

NUMERIC_FEATURES = (
    "CREDIT_SCORE", "ORIG_LTV", "ORIG_CLTV", "ORIG_DTI", "ORIG_INTEREST_RATE",
    "ORIG_UPB", "ORIG_LOAN_TERM", "MI_PCT", "log_orig_upb", "ltv_dti_interaction",
    "credit_ltv_ratio", "est_monthly_payment", "is_high_ltv", "is_high_dti",
    "has_mi", "loan_age_months", "loan_age_ratio", "pct_life_remaining",
    "upb_pct_remaining", "rate_spread", "was_modified", "max_delinq_3m",
    "mean_delinq_3m", "n_delinq_months_3m", "max_delinq_6m", "mean_delinq_6m",
    "n_delinq_months_6m", "n_serious_delinq_6m", "max_delinq_12m",
    "mean_delinq_12m", "n_delinq_months_12m", "n_serious_delinq_12m",
    "payment_streak", "delinq_trend_6m", "orig_year", "is_bubble_vintage",
    "is_gfc_vintage", "is_post_gfc", "CREDIT_SCORE_MISSING", "ORIG_DTI_MISSING",
    "ORIG_LTV_MISSING", "ORIG_CLTV_MISSING",
)
CATEGORICAL_FEATURES = (
    "PROPERTY_STATE", "credit_score_bucket", "ltv_bucket",
    "dti_bucket", "loan_age_bucket", "econ_regime",
)

# (upper edge, label); the first band starts at the lower edge of the range
SCORE_BANDS = (
    (580, "300-580", "Very High Risk", "Decline or high rates"),
    (620, "580-620", "High Risk", "Conditional approval"),
    (660, "620-660", "Medium-High Risk", "Enhanced scrutiny"),
    (720, "660-720", "Medium Risk", "Normal underwriting"),
    (760, "720-760", "Low-Medium Risk", "Standard approval"),
    (900, "760-900", "Low Risk", "Approve with best rates"),
)

ECONOMIC_REGIMES = (
    (1999, 2003, "expansion_dotcom"),
    (2004, 2007, "bubble_peak"),
    (2008, 2009, "gfc_crisis"),
    (2010, 2012, "post_gfc"),
    (2013, 2019, "recovery"),
)


@dataclass(frozen=True)
class ScoreScale:
    """Points scale: ``base`` points at ``base_odds`` to one, ``pdo`` points per doubling."""

    base: float = 600.0
    base_odds: float = 19.0
    pdo: float = 40.0
    low: int = 300
    high: int = 900


@dataclass(frozen=True)
class BoostedTreesParams:
    trees: int = 300
    depth: int = 5
    leaves: int | None = None  # None: level by level down to ``depth``; else best split first, up to so many leaves
    learning_rate: float = 0.05
    row_sample: float = 0.8
    column_sample: float = 0.8
    min_rows_per_leaf: int = 1
    min_hessian_per_leaf: float = 20.0
    l1: float = 0.1
    l2: float = 1.0
    max_bins: int = 64  # 256 at most
    seed: int = 42
    patience: int | None = None  # stop after so many trees without a better validation AUC, and keep the best prefix


@dataclass(frozen=True)
class ForestParams:
    trees: int = 200
    depth: int = 8
    min_rows_per_leaf: int = 30
    seed: int = 42


@dataclass(frozen=True)
class LogisticParams:
    c: float = 0.1
    iterations: int = 500
    tolerance: float = 1e-4


@dataclass(frozen=True)
class RiskConfig:
    serious_codes: tuple[str, ...] = SERIOUS_DELINQUENCY_CODES
    loss_codes: tuple[str, ...] = LOSS_CODES
    prepay_code: str = PREPAY_CODE
    rolling_windows: tuple[int, ...] = (3, 6, 12)
    label_months: int = 12
    min_history: int = 6
    numeric_features: tuple[str, ...] = NUMERIC_FEATURES
    categorical_features: tuple[str, ...] = CATEGORICAL_FEATURES
    split_seed: int = 42
    train_pct: int = 70
    validation_pct: int = 15
    oot_train_years: tuple[int, int] = (1999, 2007)
    oot_test_years: tuple[int, int] = (2008, 2012)
    score_scale: ScoreScale = field(default_factory=ScoreScale)
    boosted_a: BoostedTreesParams = field(default_factory=BoostedTreesParams)
    # second booster: best split first; its leaves are bounded by rows, and all rows are in each tree
    boosted_b: BoostedTreesParams = field(default_factory=lambda: BoostedTreesParams(
        leaves=31, min_rows_per_leaf=20, min_hessian_per_leaf=1e-3, row_sample=1.0, max_bins=255))
    forest: ForestParams = field(default_factory=ForestParams)
    logistic: LogisticParams = field(default_factory=LogisticParams)


LOAN = "LOAN_SEQUENCE_NUMBER"
MONTH = "month_idx"
TARGET = "TARGET_12M"
