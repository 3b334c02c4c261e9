"""What the pipeline's Python workers hold: small batches of texts, and no pandas."""

import subprocess
import sys

import pytest

import corpus_pipeline

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("before, after", [("10000", str(corpus_pipeline.BATCH_ROWS)), ("0", str(corpus_pipeline.BATCH_ROWS)), ("64", "64")])
def test_stages_with_python_take_small_batches(spark, before, after):
    usual = spark.conf.get(SETTING)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id long, text string")
    try:
        spark.conf.set(SETTING, before)
        assert corpus_pipeline.pack(spark, docs, "").count() == 5
        assert spark.conf.get(SETTING) == after
    finally:
        spark.conf.set(SETTING, usual)


def test_scoring_does_not_load_pandas():
    told = "import sys, arrearscope.llm.toxicity; print('pandas' in sys.modules)"
    folder = corpus_pipeline.__file__.rpartition("/")[0]
    assert subprocess.run([sys.executable, "-c", told], capture_output=True, text=True, cwd=folder).stdout.strip() == "False"
