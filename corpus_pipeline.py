"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, documents with benchmark
questions go, secrets are masked, and what is left is packed into token sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as
the next one's ``docs``. All but the last keep the columns of ``docs``. Rows that a stage has no say on (null
text, null doc_id) are kept; the single stages say how. Repeated rows are kept as they are, except that
equal rows are near duplicates of each other only by doc_id: rows that share one stay or go together.

Stages that run Python lower the session's ``spark.sql.execution.arrow.maxRecordsPerBatch`` to ``BATCH_ROWS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.llm import decontamination, near_duplicates, packing, secret_scan, toxicity
from arrearscope.llm.common import table
from arrearscope.sources.storage import stored

#: Five words, a similarity of 0.8 or more. There two sets miss all 20 bands of 4 with a chance of 2.6e-5 and agree in fewer
#: than 44 of 80 coordinates (mean 64, deviation 3.6) with one of about 1e-07.
NEAR = near_duplicates.Settings(percent=80, likely=44)

#: Rows of whole texts that go to a Python worker at once: a batch is held there and, up to twice as large, off the executor's heap.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _in_small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to ``BATCH_ROWS`` rows, unless they are smaller; a stage's plan is made after it returns, so they stay."""
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models don't call toxic."""
    _in_small_batches(spark)
    mark = "_toxic"
    while mark in docs.columns:
        mark += "_"
    plain = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(mark))
    scored = toxicity.score_toxicity(plain, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("predicted") == 0).select(f"{mark}.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component, and those without doc_id or words; linked from 0.8 on."""
    _in_small_batches(spark)
    links = near_duplicates.link_documents(docs, NEAR)
    gone = stored(links.filter(F.col("doc_id").isNotNull() & ~F.col("kept")).select(
        F.col("doc_id").alias("gone")).distinct(), "gone")
    # the row in one struct, so that its columns can have any names
    whole = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return whole.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in its own words or with other numbers and names."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``<kind>`` in the place of secrets; ``n_chars`` is brought up to date where it exists."""
    masked = secret_scan.mask_secrets(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return masked.select(*(F.col(f"`{c}`") for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece: where it goes in the token sequences."""
    _in_small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: No SQL can state the models, signatures and packing; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
