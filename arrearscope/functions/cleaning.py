"""Parsing of raw text fields. All casts are null-on-failure, also under ANSI mode."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(text: Column) -> Column:
    """Text to double; blanks and anything unparsable become null."""
    return text.try_cast("double")


def upper_code(text: Column) -> Column:
    return F.trim(F.upper(text))


def without_sentinel(value: Column, sentinel: float) -> Column:
    return F.nullif(value, F.lit(sentinel))


def within(value: Column, low: float, high: float) -> Column:
    """``value`` when ``low <= value <= high``, else null."""
    return F.when(value.between(low, high), value)


def year_of(yyyymm: Column) -> Column:
    return F.when(F.length(yyyymm) >= 4, F.substring(yyyymm, 1, 4).try_cast("int"))


def month_of(yyyymm: Column) -> Column:
    return F.when(F.length(yyyymm) >= 6, F.substring(yyyymm, 5, 2).try_cast("int"))


def month_index(year: Column, month: Column) -> Column:
    """Months on one integer axis; null as soon as one part is null."""
    return year * 12 + month


def delinquency_level(status: Column) -> Column:
    """Months past due as a number: ``RA`` counts as 90, other non-digits as null."""
    return F.when(status == "RA", F.lit(90.0)).when(
        status.rlike(r"^\d+$"), status.try_cast("double")
    )


def is_one_of(code: Column, codes: Iterable[str]) -> Column:
    """0/1 membership flag; null is not a member."""
    return F.coalesce(code.isin(*codes), F.lit(False)).cast("int")


def without_tokens(code: Column, tokens: Iterable[str]) -> Column:
    return F.when(~code.isin(*tokens), code)
