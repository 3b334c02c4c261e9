"""Ordinal codes of categories: fitted on training rows, applied to any rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

UNSEEN = -1
MISSING = "UNKNOWN"
BROADCAST_CODES = 100_000  # a few megabytes


def _categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column"), F.coalesce(F.col(name).cast("string"), F.lit(MISSING)).alias("category"))
        for name in columns
    ])
    return df.select(F.inline(pairs)).distinct()


def fit_codes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, category, code), stored: categories in alphabetical order, numbered from 0 per column.

    The scan is reduced to distinct values before anything is ordered. The order is dealt
    over range partitions, which are numbered one by one and shifted by the counts of those before,
    so a column of any width takes no single task.
    """
    if not columns:
        return train.sparkSession.createDataFrame([], "column string, category string, code int")
    ranged = _categories(train, columns).repartitionByRange("column", "category")
    # stored, as a partition's number has to mean the same rows in both uses below
    placed = stored(ranged.withColumn("_part", F.spark_partition_id()), "categories")
    inside = Window.partitionBy("column", "_part").orderBy("category")
    before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("column", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_row", F.row_number().over(inside)).join(offsets, ["column", "_part"])
    return stored(numbered.select(
        "column", "category", (F.col("_before") + F.col("_row") - 1).cast("int").alias("code")), "codes")


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their codes; a category the fit has not seen becomes -1.

    ``codes`` is counted by column first (pass a stored table). A column with up to
    ``BROADCAST_CODES`` categories is broadcast; the join of a wider one is left to Spark, for that column only.
    """
    if not columns:
        return df
    sizes = {row["column"]: row["count"] for row in codes.groupBy("column").count().collect()}  # one row a column
    for name in columns:
        lookup = codes.filter(F.col("column") == name).select(
            F.col("category").alias("_category"), F.col("code").alias("_code")
        )
        small = sizes.get(name, 0) <= BROADCAST_CODES
        df = (
            df.withColumn("_category", F.coalesce(F.col(name).cast("string"), F.lit(MISSING)))
            .join(F.broadcast(lookup) if small else lookup, "_category", "left")
            .withColumn(name, F.coalesce(F.col("_code"), F.lit(UNSEEN)))
            .drop("_category", "_code")
        )
    return df
