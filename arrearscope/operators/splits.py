"""Out-of-sample (by hash) and out-of-time (by vintage) split parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.config import LOAN, TARGET, RiskConfig
from arrearscope.functions.splitting import hash_bucket, oos_part, oot_part

PART = "split_part"


def labelled(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def add_splits(
    df: DataFrame, config: RiskConfig = RiskConfig(), loan: str = LOAN, target: str = TARGET
) -> DataFrame:
    """Labelled rows with ``split_oos`` and, by vintage, ``split_oot`` (may be null)."""
    bucket = hash_bucket(F.col(loan), config.split_seed)
    return labelled(df, target).withColumns({
        "split_oos": oos_part(bucket, config.train_pct, config.validation_pct),
        "split_oot": oot_part(F.col("orig_year"), config.oot_train_years, config.oot_test_years),
    })


def split_parts(split: DataFrame) -> DataFrame:
    """One row per (row, part it belongs to): ``oos_train`` ... ``oot_test``.

    A row is in one out-of-sample part and at most one out-of-time part.
    """
    parts = F.array_compact(F.array(
        F.concat(F.lit("oos_"), F.col("split_oos")), F.concat(F.lit("oot_"), F.col("split_oot"))
    ))
    return split.withColumn(PART, F.explode(parts))


def training_frame(split: DataFrame, scheme: str = "oot", allow_overlap: bool = False) -> DataFrame:
    """Training rows of a scheme and the validation rows, told apart by ``is_validation``.

    Validation rows are the out-of-sample ones that are not also training rows. With
    ``allow_overlap`` a row that is both comes out twice, once in each role.
    """
    trains = F.coalesce(F.col(f"split_{scheme}") == "train", F.lit(False))
    validates = F.col("split_oos") == "val"
    if not allow_overlap:
        validates &= ~trains
    roles = F.array_compact(F.array(F.when(trains, False), F.when(validates, True)))
    return split.withColumn("is_validation", F.explode(roles))


def holdout_frame(
    train: DataFrame, pct: int = 20, config: RiskConfig = RiskConfig(), loan: str = LOAN
) -> DataFrame:
    """Training rows with ``is_validation`` set by hash, for data without a validation part."""
    # own salt: independent of the bucket behind the out-of-sample parts
    bucket = hash_bucket(F.concat(F.col(loan), F.lit("|holdout")), config.split_seed)
    return train.withColumn("is_validation", bucket < pct)
