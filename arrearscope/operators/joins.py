"""Joins for report tables: null keys match, and the small side is broadcast only after it was counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

BROADCAST_ROWS = 100_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; the keys of ``left`` come out."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def small_side(table: DataFrame, name: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table``, stored and counted, with a broadcast hint up to ``rows`` rows. Beyond that Spark chooses the join."""
    kept = stored(table, name)
    return F.broadcast(kept) if kept.count() <= rows else kept
