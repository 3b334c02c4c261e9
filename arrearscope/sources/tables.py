"""Columnar tables: load, save, write-once stages, reports and the split fan-out."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrearscope.config import TARGET
from arrearscope.operators.splits import PART, split_parts
from arrearscope.sources.storage import path_exists

logger = logging.getLogger(__name__)


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read a file or a folder of part files; CSV is read with its header."""
    reader = spark.read.options(**({"header": True} if fmt == "csv" else {}) | options)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise FileNotFoundError(f"path does not exist: {path}") from error


def save_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    """Write a table; parquet is snappy-compressed, CSV has a header."""
    defaults = {"csv": {"header": True}, "parquet": {"compression": "snappy"}}.get(fmt, {})
    df.write.mode(mode).format(fmt).options(**(defaults | options)).save(path)


def save_with_counts(df: DataFrame, path: str, label: str | None = TARGET, **kwargs) -> dict:
    """Write a table and return its row count and label counts, taken during the write."""
    measures: list[Column] = [F.count(F.lit(1)).alias("n_loans")]
    if label is not None and label in df.columns:
        measures.append(F.coalesce(F.sum((F.col(label) == 1).cast("int")), F.lit(0)).alias("n_defaults"))
    seen = Observation()
    save_table(df.observe(seen, *measures), path, **kwargs)
    counts = dict(seen.get)
    if "n_defaults" in counts:
        total, defaults = counts["n_loans"], counts["n_defaults"]
        counts["n_non_defaults"] = total - defaults
        counts["default_rate_pct"] = round(100.0 * defaults / max(total, 1), 2)
    return counts


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a write to ``path`` has been committed."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], made_from: str | None = None
) -> DataFrame:
    """The table at ``path``; it is built and written first unless a committed one is there.

    ``made_from`` says what the table depends on (year range, settings) and is kept beside it: a
    committed table of something else is a ``ValueError``. Row and label counts of a written table are logged.
    """
    origin = f"{path.rstrip('/')}.made_from"
    if not is_complete(spark, path):
        logger.info("%s: %s", path, save_with_counts(build(), path))
        if made_from is not None:
            spark.createDataFrame([(made_from,)], "value string").coalesce(1).write.mode("overwrite").text(origin)
    elif made_from is not None and is_complete(spark, origin):
        found = spark.read.option("wholetext", True).text(origin).first()["value"].rstrip("\n")
        if found != made_from:
            raise ValueError(f"{path} was made from {found}, not from {made_from}")
    return spark.read.parquet(path)


def save_report(df: DataFrame, path: str) -> None:
    """One CSV file. For report tables, whose size does not grow with the data."""
    save_table(df.coalesce(1), path, "csv")


def save_splits(split: DataFrame, path: str) -> None:
    """All split parts in one job, as folders ``split_part=oos_train`` ... ``oot_test``."""
    split_parts(split).drop("split_oos", "split_oot").write.mode("overwrite").partitionBy(PART).parquet(path)


def load_split(spark: SparkSession, path: str, part: str) -> DataFrame:
    """One part of :func:`save_splits`; only its folder is read."""
    return spark.read.parquet(path).filter(F.col(PART) == part).drop(PART)
