"""Typing and cleaning of the raw tables, one projection and one filter each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.config import (
    LOAN,
    MODIFIED_FLAGS,
    MONTH,
    NULL_TOKENS,
    SENTINELS,
    VALID_RANGES,
)
from arrearscope.functions import cleaning as c

_ORIGINATION_NUMBERS = (
    "CREDIT_SCORE", "ORIG_CLTV", "ORIG_DTI", "ORIG_LOAN_TERM",
    "MI_PCT", "ORIG_UPB", "ORIG_LTV", "ORIG_INTEREST_RATE",
)
_SERVICING_NUMBERS = ("CURR_ACTUAL_UPB", "LOAN_AGE", "REM_MONTHS_MATURITY", "CURR_INTEREST_RATE")


def _checked(name: str) -> Column:
    """The number, or null for its sentinel and outside its valid range."""
    value = c.without_sentinel(F.col(name), SENTINELS[name])
    return c.within(value, *VALID_RANGES[name])


def has_key(name: str = LOAN) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def clean_origination(raw: DataFrame) -> DataFrame:
    """Typed origination rows: numbers checked against sentinels and ranges, vintage parsed."""
    # trimmed first, so that fields used several times are trimmed once
    trimmed = raw.withColumns({
        "FIRST_PAYMENT_DATE": F.trim("FIRST_PAYMENT_DATE"),
        "PPM_FLAG": c.upper_code(F.col("PPM_FLAG")),
        "PROPERTY_STATE": c.upper_code(F.col("PROPERTY_STATE")),
        "SERVICER_NAME": F.trim("SERVICER_NAME"),
        LOAN: F.trim(LOAN),
    } | {name: c.number(F.col(name)) for name in _ORIGINATION_NUMBERS if name in raw.columns})
    first_payment = F.col("FIRST_PAYMENT_DATE")
    checked = {name: _checked(name) for name in SENTINELS if name in raw.columns}
    parsed = {"orig_year": c.year_of(first_payment), "orig_month": c.month_of(first_payment)}
    return trimmed.filter(has_key()).withColumns(checked | parsed)


def clean_servicing(raw: DataFrame) -> DataFrame:
    """Typed servicing rows with a month index, a numeric delinquency level and a modification flag."""
    trimmed = raw.withColumns({
        LOAN: F.trim(LOAN),
        "MONTHLY_RPT_PRD": F.trim("MONTHLY_RPT_PRD"),
        "DLQCY_STATUS": F.trim("DLQCY_STATUS"),
        "MOD_FLAG": c.upper_code(F.col("MOD_FLAG")),
        "ZERO_BAL_CD": F.trim("ZERO_BAL_CD"),
    } | {name: c.number(F.col(name)) for name in _SERVICING_NUMBERS if name in raw.columns})
    period = F.col("MONTHLY_RPT_PRD")
    parsed = trimmed.filter(has_key()).withColumns({
        "rpt_year": c.year_of(period),
        "rpt_month": c.month_of(period),
    })
    return parsed.withColumns({
        MONTH: c.month_index(F.col("rpt_year"), F.col("rpt_month")),
        "ZERO_BAL_CD": c.without_tokens(F.col("ZERO_BAL_CD"), NULL_TOKENS),
        "DLQCY_STATUS_NUM": c.delinquency_level(F.col("DLQCY_STATUS")),
        "MODIFIED": c.is_one_of(F.col("MOD_FLAG"), MODIFIED_FLAGS).cast("short"),
    })


def one_row_per_month(panel: DataFrame, loan: str = LOAN, month: str = MONTH) -> DataFrame:
    """One row per (loan, month): of several, the greatest by all other columns. Rows without a month all stay.

    Row-based windows have no defined order among repeated months, and a loan that is
    repeated without limit would not fit one task. The repeats are limited to one before
    the shuffle as well as after it, and the shuffle is by loan and month, so no loan, whatever
    share of the input it holds, meets in one task before it is down to a row for each month.
    """
    rest = [name for name in panel.columns if name not in (loan, month)]
    repeats = Window.partitionBy(loan, month).orderBy(*[F.desc(name) for name in rest])
    dated = (
        panel.filter(F.col(month).isNotNull())
        .withColumn("_repeat", F.row_number().over(repeats))
        .filter(F.col("_repeat") == 1)
        .drop("_repeat")
    )
    return dated.unionByName(panel.filter(F.col(month).isNull()))

