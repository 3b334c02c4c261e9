import os

import pytest
from pyspark.sql import functions as F

from arrearscope.config import LOAN, MONTH, ORIGINATION_LAYOUT, SERVICING_LAYOUT, TARGET
from arrearscope.functions import cleaning as c
from arrearscope.operators import clean, splits
from arrearscope.sources import raw_files, storage, tables


def line(layout, fields, width=None):
    by_name = {name: position for position, name in layout.items()}
    cells = [""] * (width or max(layout) + 1)
    for name, value in fields.items():
        cells[by_name[name]] = value
    return "|".join(cells)


@pytest.fixture
def raw_dir(tmp_path):
    def put(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")

    full = {"CREDIT_SCORE": "9999", "FIRST_PAYMENT_DATE": " 200203 ", "MI_PCT": "56", "ORIG_LTV": "80", "ORIG_DTI": "999",
            "ORIG_CLTV": "0.5", "ORIG_UPB": "100000", "ORIG_INTEREST_RATE": "bad", "PPM_FLAG": " n", "PROPERTY_STATE": "tx ",
            LOAN: " L1 ", "ORIG_LOAN_TERM": "360", "SERVICER_NAME": " bank "}
    put("sample_orig_1999.txt", line(ORIGINATION_LAYOUT, full, 32), "too|short", line(ORIGINATION_LAYOUT, {**full, LOAN: " "}))
    put("SAMPLE_ORIG_2000.TXT", line(ORIGINATION_LAYOUT, {**full, LOAN: "L2", "FIRST_PAYMENT_DATE": "1999", "CREDIT_SCORE": "850"}))
    put("sample_orig_2005.txt", line(ORIGINATION_LAYOUT, {**full, LOAN: "L3"}))
    put("sample_svcg_1999.txt",
        line(SERVICING_LAYOUT, {LOAN: "L1", "MONTHLY_RPT_PRD": "200001", "DLQCY_STATUS": "RA", "MOD_FLAG": "p",
                                "ZERO_BAL_CD": "02", "LOAN_AGE": "12", "CURR_ACTUAL_UPB": "5.5"}),
        line(SERVICING_LAYOUT, {LOAN: "L1", "MONTHLY_RPT_PRD": "2000", "DLQCY_STATUS": "XX", "ZERO_BAL_CD": "nan"}))
    put("notes.txt", "nothing")
    return str(tmp_path)


def test_files_are_found_by_year_and_in_any_case(spark, raw_dir):
    found = raw_files.discover_files(spark, raw_dir, 1999, 2001).collect()
    assert [(row["kind"], row["year"]) for row in found] == [("orig", 1999), ("orig", 2000), ("svcg", 1999)]
    assert {row[LOAN] for row in raw_files.load_origination(spark, raw_dir, 1999, 2001).collect()} >= {" L1 ", "L2"}


def test_missing_years_are_an_error(spark, raw_dir):
    with pytest.raises(FileNotFoundError):
        raw_files.load_origination(spark, raw_dir, 2010, 2012)
    with pytest.raises(FileNotFoundError):
        raw_files.load_servicing(spark, raw_dir + "/absent", 1999, 2012)


def test_long_and_short_lines(spark, raw_dir):
    rows = {row[LOAN]: row for row in raw_files.load_origination(spark, raw_dir, 1999, 1999).collect()}
    assert rows[" L1 "]["SERVICER_NAME"] == " bank " and len(rows[" L1 "]) == 14
    assert rows[None]["CREDIT_SCORE"] == "too" and rows[None]["ORIG_UPB"] is None


def test_clean_origination(spark, raw_dir):
    cleaned = clean.clean_origination(raw_files.load_origination(spark, raw_dir, 1999, 2000))
    rows = {row[LOAN]: row.asDict() for row in cleaned.collect()}
    assert set(rows) == {"L1", "L2"}
    first = rows["L1"]
    assert [first[n] for n in ("CREDIT_SCORE", "MI_PCT", "ORIG_DTI", "ORIG_CLTV", "ORIG_INTEREST_RATE")] == [None] * 5
    assert (first["ORIG_LTV"], first["orig_year"], first["orig_month"]) == (80.0, 2002, 3)
    assert (first["PPM_FLAG"], first["PROPERTY_STATE"], first["SERVICER_NAME"]) == ("N", "TX", "bank")
    assert (rows["L2"]["CREDIT_SCORE"], rows["L2"]["orig_year"], rows["L2"]["orig_month"]) == (850.0, 1999, None)


def test_clean_servicing(spark, raw_dir):
    rows = clean.clean_servicing(raw_files.load_servicing(spark, raw_dir, 1999, 1999)).orderBy(F.desc(MONTH)).collect()
    assert (rows[0][MONTH], rows[0]["DLQCY_STATUS_NUM"], rows[0]["MODIFIED"], rows[0]["ZERO_BAL_CD"]) == (24001, 90.0, 1, "02")
    assert (rows[1][MONTH], rows[1]["DLQCY_STATUS_NUM"], rows[1]["MODIFIED"], rows[1]["ZERO_BAL_CD"]) == (None, None, 0, None)


def test_delinquency_level(spark):
    frame = spark.createDataFrame([("RA",), ("0",), ("12",), ("XX",), ("",), ("-1",), (None,)], "s string")
    levels = [row[0] for row in frame.select(c.delinquency_level(F.col("s"))).collect()]
    assert levels == [90.0, 0.0, 12.0, None, None, None, None]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_tables_round_trip(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    tables.save_table(frame, path, fmt)
    tables.save_table(frame, path, fmt)  # overwrites
    assert tables.load_table(spark, path, fmt).count() == 2
    with pytest.raises(FileNotFoundError):
        tables.load_table(spark, path + "x", fmt)


def test_counts_are_taken_during_the_write(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("b", 0), ("c", None), ("d", 0)], f"{LOAN} string, {TARGET} int")
    counts = tables.save_with_counts(frame, str(tmp_path / "t"))
    assert counts == {"n_loans": 4, "n_defaults": 1, "n_non_defaults": 3, "default_rate_pct": 25.0}


def test_materialize_builds_once_and_again_after_an_unfinished_write(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert tables.materialize(spark, path, build).count() == 3
    assert tables.materialize(spark, path, build).count() == 3
    assert len(calls) == 1
    os.remove(f"{path}/_SUCCESS")
    tables.materialize(spark, path, build)
    assert len(calls) == 2


def test_report_is_one_file_with_header(spark, tmp_path):
    tables.save_report(spark.range(5).repartition(4), str(tmp_path / "r"))
    files = [name for name in os.listdir(tmp_path / "r") if name.endswith(".csv")]
    assert len(files) == 1
    assert (tmp_path / "r" / files[0]).read_text().splitlines()[0] == "id"


def test_split_fan_out(spark, tmp_path):
    frame = spark.createDataFrame(
        [(str(i), 1999 + i % 20, i % 2 if i % 10 else None) for i in range(500)], f"{LOAN} string, orig_year int, {TARGET} int")
    split = splits.add_splits(frame)
    tables.save_splits(split, str(tmp_path / "s"))
    parts = [f"oos_{p}" for p in ("train", "val", "test")]
    found = {p: {row[LOAN] for row in tables.load_split(spark, str(tmp_path / "s"), p).collect()} for p in parts}
    assert sum(len(keys) for keys in found.values()) == 450 == len(set().union(*found.values()))
    oot = tables.load_split(spark, str(tmp_path / "s"), "oot_test")
    assert {row["orig_year"] for row in oot.collect()} <= set(range(2008, 2013))


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


class FakeSession:
    def __init__(self, master, setting):
        self.sparkContext, self.setting, self.conf = FakeContext(master), setting, self

    def get(self, key, default=None):
        return self.setting or default


def test_shared_folder_comes_from_the_session():
    cluster = FakeSession("yarn", "hdfs:///shared")
    assert storage.scratch_path(cluster, "x").startswith("hdfs:///shared/x-")
    storage.use_checkpoints(cluster)
    assert cluster.sparkContext.folder == "hdfs:///shared"


def test_only_a_local_master_may_use_a_temporary_folder():
    with pytest.raises(RuntimeError):
        storage.shared_folder(FakeSession("spark://host:7077", None))
    local = FakeSession("local[2]", None)
    assert storage.shared_folder(local) == storage.shared_folder(local)


def test_stored_tables_are_read_back(spark):
    frame = storage.stored(spark.range(3), "three")
    assert frame.count() == 3
    assert "three-" in frame.inputFiles()[0]
