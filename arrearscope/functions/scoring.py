"""Probability of default to score points, bands and actions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrearscope.config import SCORE_BANDS, ScoreScale

PROBABILITY_FLOOR = 1e-6


def score_points(probability: Column, scale: ScoreScale = ScoreScale()) -> Column:
    """Points on a log-odds scale, rounded half-even and clamped to the scale's ends."""
    factor = scale.pdo / math.log(2)
    offset = scale.base - factor * math.log(scale.base_odds)
    p = F.least(F.greatest(probability, F.lit(PROBABILITY_FLOOR)), F.lit(1 - PROBABILITY_FLOOR))
    points = F.rint(F.lit(offset) + F.lit(factor) * F.log((1 - p) / p))
    return F.least(F.greatest(points, F.lit(float(scale.low))), F.lit(float(scale.high))).cast("int")


def _by_band(points: Column, column: int, scale: ScoreScale) -> Column:
    """Entry of the band that holds ``points``. The outer bands reach to the ends of the scale."""
    chain = None
    for entry in SCORE_BANDS[:-1]:
        upper, value = entry[0], entry[column]
        chain = F.when(points <= upper, value) if chain is None else chain.when(points <= upper, value)
    return F.when(points.between(scale.low, scale.high), chain.otherwise(SCORE_BANDS[-1][column]))


def score_band(points: Column, scale: ScoreScale = ScoreScale()) -> Column:
    return _by_band(points, 1, scale)


def risk_label(points: Column, scale: ScoreScale = ScoreScale()) -> Column:
    return _by_band(points, 2, scale)
