"""Raw pipe-delimited loan files: ``sample_orig_YYYY.txt`` and ``sample_svcg_YYYY.txt``.

The file names go into one glob, so listing is left to Spark, and the schema is given,
so nothing is read to infer it. Columns that are not selected are not parsed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from arrearscope.config import ORIGINATION_LAYOUT, SERVICING_LAYOUT

SEPARATOR = "|"
FILE_PATTERN = r"(?i)sample_(orig|svcg)_(\d{4})\.txt"


def _any_case(text: str) -> str:
    """Globs are case-sensitive, file names of the sample are not."""
    return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in text)


def file_glob(kind: str, year_start: int, year_end: int) -> str:
    years = ",".join(str(year) for year in range(year_start, year_end + 1))
    return f"{_any_case(f'sample_{kind}')}_{{{years}}}{_any_case('.txt')}"


def _raw_schema(layout: dict[int, str]) -> StructType:
    return StructType([StructField(f"_c{i}", StringType()) for i in range(max(layout) + 1)])


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    reader = (
        spark.read.schema(schema).option("sep", SEPARATOR).option("header", False)
        .option("mode", "PERMISSIVE").option("nullValue", "")
    )
    return reader.csv(path)


def _load(
    spark: SparkSession, raw_dir: str, kind: str, layout: dict[int, str], year_start: int, year_end: int
) -> DataFrame:
    path = f"{raw_dir.rstrip('/')}/{file_glob(kind, year_start, year_end)}"
    try:
        lines = _read(spark, path, _raw_schema(layout))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise FileNotFoundError(
            f"no {kind} file for {year_start}-{year_end} in {raw_dir}"
        ) from error
    return lines.select([F.col(f"_c{position}").alias(name) for position, name in layout.items()])


def load_origination(spark: SparkSession, raw_dir: str, year_start: int, year_end: int) -> DataFrame:
    """Origination lines of a year range as 14 text columns."""
    return _load(spark, raw_dir, "orig", ORIGINATION_LAYOUT, year_start, year_end)


def load_servicing(spark: SparkSession, raw_dir: str, year_start: int, year_end: int) -> DataFrame:
    """Servicing lines of a year range as 10 text columns."""
    return _load(spark, raw_dir, "svcg", SERVICING_LAYOUT, year_start, year_end)


def discover_files(spark: SparkSession, raw_dir: str, year_start: int, year_end: int) -> DataFrame:
    """The files a load would read: (kind, year, path), without reading them."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"{_any_case('sample')}_*").load(raw_dir)
    name = F.element_at(F.split("path", "/"), -1)
    year = F.regexp_extract(name, FILE_PATTERN, 2)
    return (
        listing.filter(name.rlike(f"^{FILE_PATTERN}$"))
        .select(
            F.lower(F.regexp_extract(name, FILE_PATTERN, 1)).alias("kind"),
            year.cast("int").alias("year"),
            "path",
        )
        .filter(F.col("year").between(year_start, year_end))
        .orderBy("kind", "year")
    )
