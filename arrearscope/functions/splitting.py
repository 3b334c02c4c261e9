"""Reproducible assignment of loans to split parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """Bucket in ``0..buckets-1`` that depends on the key and the seed only."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def oos_part(bucket: Column, train_pct: int, validation_pct: int) -> Column:
    return (
        F.when(bucket < train_pct, "train")
        .when(bucket < train_pct + validation_pct, "val")
        .otherwise("test")
    )


def oot_part(year: Column, train_years: tuple[int, int], test_years: tuple[int, int]) -> Column:
    """Part by vintage; null for years in neither range."""
    return F.when(year.between(*train_years), "train").when(year.between(*test_years), "test")
