"""Delinquency behaviour, labels and the snapshot of a (loan, month) panel.

All window columns use one window: partitioned by loan, ascending by month. Put in
one plan they share a single exchange and a single sort, and the newest row is found
with ``lead`` on the same order instead of a second, descending sort.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.config import LOAN, MONTH, TARGET, RiskConfig
from arrearscope.functions.cleaning import is_one_of

LEVEL = "DLQCY_STATUS_NUM"


def add_event_flags(
    panel: DataFrame,
    config: RiskConfig = RiskConfig(),
    status: str = "DLQCY_STATUS",
    zero_balance: str = "ZERO_BAL_CD",
) -> DataFrame:
    serious = is_one_of(F.col(status), config.serious_codes)
    loss = is_one_of(F.col(zero_balance), config.loss_codes)
    return panel.withColumns({
        "IS_90DPD": serious,
        "IS_ZBC_LOSS": loss,
        "IS_PREPAY": is_one_of(F.col(zero_balance), [config.prepay_code]),
        "IS_DEFAULT_EVENT": (serious + loss > 0).cast("int"),
    })


def by_month(loan: str = LOAN, month: str = MONTH):
    return Window.partitionBy(loan).orderBy(month)


def _trailing(k: int, frame: str, loan: str, month: str):
    """The last ``k`` rows, or with ``frame='range'`` the last ``k`` calendar months."""
    if frame == "rows":
        return by_month(loan, month).rowsBetween(1 - k, Window.currentRow)
    if frame == "range":
        return by_month(loan, month).rangeBetween(1 - k, Window.currentRow)
    raise ValueError(f"frame must be 'rows' or 'range', not {frame!r}")


def level(name: str = LEVEL) -> Column:
    """Numeric delinquency with unknown counted as current."""
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def rolling_columns(
    windows: Iterable[int] = (3, 6, 12), frame: str = "rows", loan: str = LOAN, month: str = MONTH
) -> dict[str, Column]:
    """Max, mean and counts over trailing windows.

    The mean divides by the window length, also while the history is shorter.
    Serious rows are counted for windows of six months and more.
    """
    columns: dict[str, Column] = {}
    for k in windows:
        w = _trailing(k, frame, loan, month)
        columns[f"max_delinq_{k}m"] = F.max(level()).over(w)
        columns[f"mean_delinq_{k}m"] = F.sum(level()).over(w) / F.lit(float(k))
        columns[f"n_delinq_months_{k}m"] = F.sum((level() > 0).cast("int")).over(w)
        if k >= 6:
            columns[f"n_serious_delinq_{k}m"] = F.sum("IS_90DPD").over(w)
    return columns


def trend_column(lag: int = 5, loan: str = LOAN, month: str = MONTH) -> Column:
    """Level now minus the level ``lag`` rows ago; that counts as 0 before the history starts."""
    return level() - F.lag(level(), lag, 0.0).over(by_month(loan, month))


def add_payment_streak(panel: DataFrame, loan: str = LOAN, month: str = MONTH) -> DataFrame:
    """Rows since the last delinquent one, the whole history if there was none."""
    w = by_month(loan, month)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_late = F.max(F.when(level() > 0, F.col("_seq"))).over(running)
    return (
        panel.withColumn("_seq", F.row_number().over(w))
        .withColumn("payment_streak", F.col("_seq") - F.coalesce(last_late, F.lit(0)))
        .drop("_seq")
    )


def add_rolling_features(
    panel: DataFrame,
    config: RiskConfig = RiskConfig(),
    frame: str = "rows",
    loan: str = LOAN,
    month: str = MONTH,
) -> DataFrame:
    """Rolling statistics, payment streak and trend."""
    columns = rolling_columns(config.rolling_windows, frame, loan, month)
    columns["delinq_trend_6m"] = trend_column(loan=loan, month=month)
    return add_payment_streak(panel.withColumns(columns), loan, month)


def label_column(
    direction: str = "trailing", months: int = 12, loan: str = LOAN, month: str = MONTH
) -> Column:
    """Default label of a row: 1, 0 or null.

    ``trailing`` looks at the row itself and the ``months`` rows before it. It is what
    the published model quality was measured on, although the features see the same
    months. ``forward`` looks at the next ``months`` rows only.

    1 if a default event lies in the frame; null if the loan was prepaid in a frame of
    fewer than ``months`` rows; else 0.
    """
    w = by_month(loan, month)
    if direction == "trailing":
        frame = w.rowsBetween(-months, Window.currentRow)
    elif direction == "forward":
        frame = w.rowsBetween(1, months)
    else:
        raise ValueError(f"direction must be 'trailing' or 'forward', not {direction!r}")
    defaulted = F.max("IS_DEFAULT_EVENT").over(frame) == 1
    cut_short = (F.max("IS_PREPAY").over(frame) == 1) & (F.count(F.lit(1)).over(frame) < months)
    return F.when(defaulted, 1).when(cut_short, F.lit(None)).otherwise(0)


def add_label(
    panel: DataFrame,
    direction: str = "trailing",
    config: RiskConfig = RiskConfig(),
    loan: str = LOAN,
    month: str = MONTH,
) -> DataFrame:
    return panel.withColumn(TARGET, label_column(direction, config.label_months, loan, month))


def select_snapshot(
    panel: DataFrame,
    config: RiskConfig = RiskConfig(),
    rows_after: int = 0,
    loan: str = LOAN,
    month: str = MONTH,
) -> DataFrame:
    """One row per loan, at least ``min_history`` rows into its history.

    ``rows_after=0`` takes the newest row. For a forward label pass the label length:
    the newest row that still has that many rows after it is taken.
    """
    w = by_month(loan, month)
    last = F.lead(F.lit(1), rows_after + 1).over(w).isNull()
    if rows_after:
        last &= F.lead(F.lit(1), rows_after).over(w).isNotNull()
    return (
        panel.withColumns({"_seq": F.row_number().over(w), "_last": last})
        .filter(F.col("_last") & (F.col("_seq") > config.min_history))
        .drop("_seq", "_last")
    )


def snapshot(
    panel: DataFrame,
    config: RiskConfig = RiskConfig(),
    direction: str = "trailing",
    loan: str = LOAN,
    month: str = MONTH,
) -> DataFrame:
    """Cleaned panel to one labelled row of behaviour features per loan."""
    flagged = add_event_flags(panel, config)
    featured = add_rolling_features(flagged, config, loan=loan, month=month)
    labelled = add_label(featured, direction, config, loan, month)
    rows_after = config.label_months if direction == "forward" else 0
    return select_snapshot(labelled, config, rows_after, loan, month)
