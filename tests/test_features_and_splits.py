import math

import pytest
from pyspark.sql import functions as F

from arrearscope.config import CATEGORICAL_FEATURES, LOAN, NUMERIC_FEATURES, TARGET
from arrearscope.functions import features as f
from arrearscope.functions.splitting import hash_bucket
from arrearscope.operators import encode, features, splits
from arrearscope.plans import testbed


def apply(spark, column, values, kind="double"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in frame.orderBy("i").select(column(F.col("v"))).collect()]


def test_bucket_edges(spark):
    assert apply(spark, f.credit_score_bucket, [0.0, 579.0, 580.0, 620.0, 759.9, 760.0, 900.0, None]) == [
        "deep_subprime", "deep_subprime", "subprime", "near_prime", "prime_plus", "super_prime", "unknown", "unknown"]
    assert apply(spark, f.ltv_bucket, [0.0, 60.0, 60.5, 97.0, 97.5, 999.0, 1000.0, None]) == [
        "unknown", "lte60", "60_70", "90_97", "gt97", "gt97", "unknown", "unknown"]
    assert apply(spark, f.dti_bucket, [0.0, 28.0, 43.0, 50.0, 50.5, None]) == [
        "unknown", "conservative", "standard", "elevated", "high", "unknown"]
    assert apply(spark, lambda v: f.ltv_bucket(v, missing="nan"), [None]) == ["nan"]


def test_loan_age_variants(spark):
    ages = [0.0, 12.0, 13.0, 121.0, None, -1.0]
    assert apply(spark, f.loan_age_bucket, ages) == ["0_12m", "0_12m", "12_24m", "120m_plus", "unknown", "unknown"]
    assert apply(spark, lambda v: f.loan_age_bucket(v, variant="open_zero"), ages)[0] == "unknown"
    assert apply(spark, lambda v: f.loan_age_bucket(v, variant="catch_all"), ages) == [
        "0_12m", "0_12m", "12_24m", "120m_plus", "120m_plus", "0_12m"]
    with pytest.raises(ValueError):
        f.loan_age_bucket(F.col("v"), variant="other")


def test_null_policies_of_flags(spark):
    for nulls, expected in (("null", None), ("zero", 0.0), ("minus_one", -1.0)):
        assert apply(spark, lambda v, n=nulls: f.exceeds(v, 80, n), [80.0, 80.5, None]) == [0.0, 1.0, expected]


def test_monthly_payment(spark):
    rows = spark.createDataFrame(
        [(100000.0, 6.0, 360.0), (100000.0, 0.0, 360.0), (None, 6.0, 360.0), (100000.0, 6.0, 0.0), (100000.0, 6.0, None)],
        "p double, r double, n double")
    paid = [row[0] for row in rows.select(f.monthly_payment(F.col("p"), F.col("r"), F.col("n"))).collect()]
    assert math.isclose(paid[0], 599.5505, rel_tol=1e-6) and paid[1:] == [None] * 4


def test_ratios_with_zero_denominator(spark):
    frame = spark.createDataFrame([(5.0, 0.0), (5.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in frame.select(f.ratio(F.col("a"), F.col("b"))).collect()] == [None, 2.5, None]
    assert [r[0] for r in frame.select(f.ratio(F.col("a"), F.col("b"), "one")).collect()] == [5.0, 2.5, None]


def test_median_fill_is_exact_and_falls_back(spark):
    frame = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None), (None, None)], "ORIG_LTV double, ORIG_DTI double")
    filled = features.add_ltv_dti_interaction(frame).orderBy("ORIG_LTV").collect()
    assert [row["ltv_dti_interaction"] for row in filled] == [2.5 * 36, 36.0, 72.0, 108.0, 360.0]
    rough = features.add_ltv_dti_interaction(frame, approximate=True).orderBy("ORIG_LTV").first()
    assert rough["ltv_dti_interaction"] == 2.0 * 36


def test_modeling_table_has_every_feature_without_nulls(spark, small):
    from arrearscope.operators.panel import snapshot

    table = features.modeling_table(snapshot(testbed.panel(spark, small)), testbed.origination(spark, small))
    used = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    assert set(used) <= set(table.columns)
    assert table.select(*[F.sum(F.col(name).isNull().cast("int")) for name in used]).first() == (0,) * len(used)


def test_split_shares_and_reproducibility(spark):
    loans = spark.range(20000).select(F.concat(F.lit("F"), F.col("id")).alias(LOAN), F.lit(2001).alias("orig_year"), F.lit(1).alias(TARGET))
    shares = {r["split_oos"]: r["count"] / 20000 for r in splits.add_splits(loans).groupBy("split_oos").count().collect()}
    assert abs(shares["train"] - 0.70) < 0.02 and abs(shares["val"] - 0.15) < 0.02 and abs(shares["test"] - 0.15) < 0.02
    one = loans.select(hash_bucket(F.col(LOAN), 42)).limit(50).collect()
    assert one == loans.repartition(7).orderBy(F.substring(LOAN, 2, 10).cast("int")).select(hash_bucket(F.col(LOAN), 42)).limit(50).collect()
    assert loans.select(F.sum((hash_bucket(F.col(LOAN), 42) == hash_bucket(F.col(LOAN), 7)).cast("int"))).first()[0] < 600


def test_oot_years_and_unlabelled_rows(spark):
    frame = spark.createDataFrame(
        [(str(y), y, 0) for y in (1998, 1999, 2007, 2008, 2012, 2013)] + [("none", 2001, None)],
        f"{LOAN} string, orig_year int, {TARGET} int")
    parts = {row[LOAN]: row["split_oot"] for row in splits.add_splits(frame).collect()}
    assert parts == {"1998": None, "1999": "train", "2007": "train", "2008": "test", "2012": "test", "2013": None}


def test_validation_rows_are_not_training_rows(spark):
    loans = spark.range(3000).select(F.col("id").cast("string").alias(LOAN), (1999 + F.col("id") % 14).cast("int").alias("orig_year"), F.lit(0).alias(TARGET))
    split = splits.add_splits(loans)
    frame = splits.training_frame(split)
    assert frame.count() == frame.select(LOAN).distinct().count()
    overlap = splits.training_frame(split, allow_overlap=True)
    assert overlap.count() > overlap.select(LOAN).distinct().count()
    assert overlap.filter("is_validation").count() == split.filter("split_oos = 'val'").count()
    held = splits.holdout_frame(split.filter("split_oot = 'train'"))
    share = held.filter("is_validation").count() / held.count()
    assert 0.15 < share < 0.25


def test_ordinal_codes(spark):
    train = spark.createDataFrame([("b", "x"), ("a", None), ("c", "x"), ("b", "y")], "s string, t string")
    other = spark.createDataFrame([(1, "a", "y"), (2, "zz", None), (3, None, "x")], "i int, s string, t string")
    codes = encode.fit_codes(train, ["s", "t"])
    coded = encode.apply_codes(other, codes, ["s", "t"]).orderBy("i").collect()
    assert [(row["s"], row["t"]) for row in coded] == [(0, 2), (-1, 0), (-1, 1)]
