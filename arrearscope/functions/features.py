"""Row-level risk features as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrearscope.config import ECONOMIC_REGIMES

# Band edges and labels.
CREDIT_SCORE_BANDS = ((0, 580, "deep_subprime"), (580, 620, "subprime"), (620, 660, "near_prime"),
                      (660, 720, "prime"), (720, 760, "prime_plus"), (760, 900, "super_prime"))
LTV_BANDS = ((0, 60, "lte60"), (60, 70, "60_70"), (70, 80, "70_80"),
             (80, 90, "80_90"), (90, 97, "90_97"), (97, 999, "gt97"))
DTI_BANDS = ((0, 28, "conservative"), (28, 36, "moderate"), (36, 43, "standard"),
             (43, 50, "elevated"), (50, 100, "high"))
LOAN_AGE_BANDS = ((0, 12, "0_12m"), (12, 24, "12_24m"), (24, 36, "24_36m"),
                  (36, 60, "36_60m"), (60, 120, "60_120m"), (120, 10000, "120m_plus"))
HIGH_LTV = 80
HIGH_DTI = 43
FALLBACK_MEDIAN_LTV = 80.0
FALLBACK_MEDIAN_DTI = 36.0


def band(
    value: Column,
    bands: Sequence[tuple[float, float, str]],
    closed: str = "right",
    missing: str = "unknown",
    include_lowest: bool = False,
) -> Column:
    """Label of the interval that holds ``value``.

    ``closed`` says which end belongs to the interval; ``include_lowest`` adds the
    lower end of the first one. Null and anything outside all intervals is ``missing``.
    """
    if closed not in ("left", "right"):
        raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")
    label = None
    for position, (low, high, name) in enumerate(bands):
        if closed == "left":
            inside = (value >= low) & (value < high)
        elif include_lowest and position == 0:
            inside = value.between(low, high)
        else:
            inside = (value > low) & (value <= high)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise(missing)


def credit_score_bucket(score: Column, missing: str = "unknown") -> Column:
    return band(score, CREDIT_SCORE_BANDS, closed="left", missing=missing)


def ltv_bucket(ltv: Column, missing: str = "unknown") -> Column:
    return band(ltv, LTV_BANDS, missing=missing)


def dti_bucket(dti: Column, missing: str = "unknown") -> Column:
    return band(dti, DTI_BANDS, missing=missing)


def loan_age_bucket(age: Column, missing: str = "unknown", variant: str = "inclusive") -> Column:
    """Age band.

    ``inclusive``: age 0 is in the first band, a null age is ``missing``.
    ``open_zero``: age 0 falls outside (half-open bands), so it is ``missing`` too.
    ``catch_all``: everything up to 12 is in the first band, null is in the last one.
    """
    if variant == "inclusive":
        return band(age, LOAN_AGE_BANDS, missing=missing, include_lowest=True)
    if variant == "open_zero":
        return band(age, LOAN_AGE_BANDS, missing=missing)
    if variant == "catch_all":
        floor = ((float("-inf"), LOAN_AGE_BANDS[0][1], LOAN_AGE_BANDS[0][2]),)
        return band(age, floor + LOAN_AGE_BANDS[1:-1], missing=LOAN_AGE_BANDS[-1][2])
    raise ValueError(f"unknown variant {variant!r}")


def exceeds(value: Column, limit: float, nulls: str = "null") -> Column:
    """1.0/0.0 flag for ``value > limit``; ``nulls`` is ``null``, ``zero`` or ``minus_one``."""
    flag = (value > limit).cast("double")
    if nulls == "null":
        return flag
    return F.coalesce(flag, F.lit({"zero": 0.0, "minus_one": -1.0}[nulls]))


def is_positive(value: Column) -> Column:
    return F.coalesce(value > 0, F.lit(False)).cast("int")


def is_yes(flag: Column) -> Column:
    return F.coalesce(F.upper(flag) == "Y", F.lit(False)).cast("int")


def log_amount(amount: Column) -> Column:
    return F.log1p(F.coalesce(amount, F.lit(0.0)))


def positive_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; null unless the denominator is above zero."""
    return F.when(denominator > 0, numerator / denominator)


def ratio(numerator: Column, denominator: Column, zero: str = "null") -> Column:
    """Share of an original amount or term; ``zero='one'`` divides by 1 where it is 0."""
    if zero == "one":
        return numerator / F.when(denominator == 0, F.lit(1.0)).otherwise(denominator)
    return positive_ratio(numerator, denominator)


def monthly_payment(principal: Column, annual_rate_pct: Column, months: Column) -> Column:
    """Annuity payment; null for a missing principal, a rate that is not positive or no term."""
    rate = annual_rate_pct / 1200
    growth = F.pow(1 + rate, months)
    return F.when((rate > 0) & (growth > 1), principal * rate * growth / (growth - 1))


def economic_regime(year: Column) -> Column:
    label = None
    for first, last, name in ECONOMIC_REGIMES:
        inside = year.between(first, last)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise("unknown")


def year_flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def missing_flag(value: Column) -> Column:
    return value.isNull().cast("int")
