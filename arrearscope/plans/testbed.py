"""Loan-shaped views over the generic test tables.

``lineitem`` gives the monthly panel (entity: part key, time: ship month) and ``part``
the static table. Everything is an expression of the given columns, so the work grows
with the tables. ``lineitem`` repeats its keys; the panel is aggregated to one row per
entity and month before anything else, with map-side combining.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrearscope.config import LOAN, MODIFIED_FLAGS, MONTH, SENTINELS, VALID_RANGES
from arrearscope.functions.cleaning import (
    delinquency_level,
    is_one_of,
    upper_code,
    within,
    without_sentinel,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _months(spark: SparkSession, folder: str) -> DataFrame:
    """(loan, key, month) with the month's highest quantity, price, discount and flag."""
    shipped = F.col("l_shipdate")
    return (
        table(spark, folder, "lineitem")
        .select(
            F.col("l_partkey").alias("key"),
            (F.year(shipped) * 12 + F.month(shipped)).alias(MONTH),
            "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
        )
        .groupBy("key", MONTH)
        .agg(
            F.max("l_quantity").cast("int").alias("q"),
            F.max("l_extendedprice").alias("upb"),
            F.max("l_discount").alias("disc"),
            # a one-letter flag: its code keeps this a hash aggregate
            F.char(F.max(F.ascii("l_returnflag"))).alias("rf"),
        )
    )


def _history(spark: SparkSession, folder: str) -> DataFrame:
    """All months, with loan, ``rn`` of ``n`` and first month ``m0``.

    Histories of different lengths come from dealing the months of a key to two loans: the first
    ``4 + key % 30`` to the loan named by the key, all later ones to a second loan ``<key>-b``.
    """
    whole = Window.partitionBy("key")
    cut = 4 + F.col("key") % 30
    later = F.col("_nth") > cut
    total = F.count(F.lit(1)).over(whole)
    numbered = _months(spark, folder).withColumns({
        "_nth": F.row_number().over(whole.orderBy(MONTH)).cast("long"), "_total": total})
    return numbered.withColumns({
        LOAN: F.concat(F.col("key").cast("string"), F.when(later, "-b").otherwise("")),
        "rn": F.when(later, F.col("_nth") - cut).otherwise(F.col("_nth")),
        "n": F.when(later, F.col("_total") - cut).otherwise(F.least("_total", cut)),
        "m0": F.when(later, F.min(F.when(later, F.col(MONTH))).over(whole)).otherwise(F.min(MONTH).over(whole)),
    }).drop("_nth", "_total")


def _both_loans(part: DataFrame, key: str) -> DataFrame:
    """``part`` with one row for each of a key's two loans."""
    return part.withColumn(LOAN, F.explode(F.array(
        F.col(key).cast("string"), F.concat(F.col(key).cast("string"), F.lit("-b")))))


def _status() -> Column:
    q, rf = F.col("q"), F.col("rf")
    return (
        F.when(q <= 38, "0").when(q <= 44, "1").when(q <= 47, "2")
        .when((q == 48) & (rf == "N"), "3").when((q == 49) & (rf == "R"), "RA")
        .when(q == 50, "XX").when((q == 49) & (rf == "N"), "25").otherwise("0")
    )


def _zero_balance() -> Column:
    newest = F.col("rn") == F.col("n")
    return F.when(newest & (F.col("key") % 5 == 0), "01").when(newest & (F.col("key") % 17 == 0), "03")


def _modification() -> Column:
    q, rf = F.col("q"), F.col("rf")
    return F.when((rf == "A") & (q % 5 == 0), "Y").when((rf == "A") & (q % 7 == 0), "P").otherwise("")


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned servicing panel, one row per (loan, month)."""
    age = F.col(MONTH) - F.col("m0")
    return _history(spark, folder).select(
        LOAN,
        MONTH,
        _status().alias("DLQCY_STATUS"),
        delinquency_level(_status()).alias("DLQCY_STATUS_NUM"),
        _zero_balance().alias("ZERO_BAL_CD"),
        _modification().alias("MOD_FLAG"),
        is_one_of(_modification(), MODIFIED_FLAGS).cast("short").alias("MODIFIED"),
        F.col("upb").alias("CURR_ACTUAL_UPB"),
        age.cast("double").alias("LOAN_AGE"),
        (360 - age).cast("double").alias("REM_MONTHS_MATURITY"),
        (4.0 + 10 * F.col("disc")).alias("CURR_INTEREST_RATE"),
    )


def _every(step: int, sentinel: int, otherwise) -> Column:
    """``otherwise``, but ``sentinel`` for every ``step``-th key."""
    return F.when(F.col("p_partkey") % step == 0, sentinel).otherwise(otherwise).cast("double")


def origination_with_sentinels(spark: SparkSession, folder: str) -> DataFrame:
    """Static loan attributes that still hold their sentinel values."""
    key = F.col("p_partkey")
    return _both_loans(table(spark, folder, "part"), "p_partkey").select(
        LOAN,
        _every(41, 9999, 290 + (key * 7919) % 571).alias("CREDIT_SCORE"),
        _every(37, 999, (key * 31) % 60).alias("MI_PCT"),
        _every(43, 999, 40 + (key * 13) % 80).alias("ORIG_LTV"),
        _every(47, 999, 42 + (key * 17) % 80).alias("ORIG_CLTV"),
        _every(29, 999, (key * 19) % 70).alias("ORIG_DTI"),
        (F.col("p_retailprice") * 100).alias("ORIG_UPB"),
        _every(53, 0, 3 + key % 5).alias("ORIG_INTEREST_RATE"),
        F.when(key % 3 == 0, 180.0).otherwise(360.0).alias("ORIG_LOAN_TERM"),
        F.when(key % 11 == 0, " y ").otherwise("N").alias("PPM_FLAG"),
        F.col("p_brand").alias("PROPERTY_STATE"),
        (1999 + key % 22).cast("int").alias("orig_year"),
    )


def origination(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned static loan attributes."""
    cleaned = {name: within(without_sentinel(F.col(name), SENTINELS[name]), *VALID_RANGES[name])
               for name in SENTINELS}
    cleaned |= {name: upper_code(F.col(name)) for name in ("PPM_FLAG", "PROPERTY_STATE")}
    return origination_with_sentinels(spark, folder).withColumns(cleaned)


def _padded(text: Column, step: int) -> Column:
    return F.when(F.col("key") % step == 0, F.concat(F.lit(" "), text, F.lit(" "))).otherwise(text)


def raw_origination(spark: SparkSession, folder: str) -> DataFrame:
    """Origination as raw text: padding, blanks, sentinels, values out of range, unparsable dates."""
    key = F.col("key")
    year = (1999 + key % 22).cast("string")
    month = F.lpad((1 + key % 12).cast("string"), 2, "0")
    text = _both_loans(
        table(spark, folder, "part").select(F.col("p_partkey").alias("key"), "p_brand", "p_retailprice"), "key")

    def blank(step: int, value: Column) -> Column:
        return F.when(key % step == 0, "").otherwise(value.cast("string"))

    return text.select(
        F.when(key % 41 == 0, "9999").when(key % 59 == 0, "n/a")
        .otherwise((290 + (key * 7919) % 571).cast("string")).alias("CREDIT_SCORE"),
        F.when(key % 31 == 0, year).when(key % 67 == 0, "").when(key % 71 == 0, F.concat(year, F.lit("xx")))
        .otherwise(_padded(F.concat(year, month), 13)).alias("FIRST_PAYMENT_DATE"),
        F.concat((2029 + key % 22).cast("string"), month).alias("MATURITY_DATE"),
        F.when(key % 37 == 0, "999").otherwise(blank(7, (key * 31) % 60)).alias("MI_PCT"),
        F.when(key % 47 == 0, "999").otherwise((42 + (key * 17) % 80).cast("string")).alias("ORIG_CLTV"),
        F.when(key % 29 == 0, "999").otherwise(blank(19, (key * 19) % 70)).alias("ORIG_DTI"),
        F.floor(F.col("p_retailprice") * 100).cast("string").alias("ORIG_UPB"),
        F.when(key % 43 == 0, "999").otherwise((40 + (key * 13) % 80).cast("string")).alias("ORIG_LTV"),
        F.concat((3 + key % 5).cast("string"), F.lit(".25")).alias("ORIG_INTEREST_RATE"),
        F.when(key % 11 == 0, " y ").otherwise("n").alias("PPM_FLAG"),
        F.lower(_padded(F.col("p_brand"), 9)).alias("PROPERTY_STATE"),
        F.when(key % 97 == 0, "  ").otherwise(_padded(F.col(LOAN), 17)).alias(LOAN),
        F.when(key % 3 == 0, "180").otherwise("360").alias("ORIG_LOAN_TERM"),
        F.when(key % 23 == 0, "").otherwise(F.concat(F.lit(" servicer "), (key % 4).cast("string")))
        .alias("SERVICER_NAME"),
    )


def raw_servicing(spark: SparkSession, folder: str) -> DataFrame:
    """Servicing as raw text, with the same kinds of noise."""
    key, month_idx = F.col("key"), F.col(MONTH)
    year = F.floor((month_idx - 1) / 12)
    month = month_idx - year * 12
    yyyymm = F.concat(year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
    mixed = (key + month_idx) % 61
    age = month_idx - F.col("m0")
    return _history(spark, folder).select(
        F.when(key % 97 == 0, "").otherwise(_padded(F.col(LOAN), 17)).alias(LOAN),
        F.when(mixed == 0, "").when(mixed == 1, year.cast("string")).when(mixed == 2, F.concat(year, F.lit("ab")))
        .otherwise(_padded(yyyymm, 5)).alias("MONTHLY_RPT_PRD"),
        F.when(mixed == 3, "").when(mixed == 4, "unknown")
        .otherwise(F.floor("upb").cast("string")).alias("CURR_ACTUAL_UPB"),
        F.when(mixed == 5, " 2").when(mixed == 6, "").otherwise(_status()).alias("DLQCY_STATUS"),
        F.when(mixed == 7, "").otherwise(age.cast("string")).alias("LOAN_AGE"),
        (360 - age).cast("string").alias("REM_MONTHS_MATURITY"),
        F.when(mixed == 8, " y").otherwise(_modification()).alias("MOD_FLAG"),
        F.when(mixed == 9, "nan").when(mixed == 10, "None").when(mixed == 11, " null ").when(mixed == 12, "")
        .otherwise(F.coalesce(_zero_balance(), F.lit(""))).alias("ZERO_BAL_CD"),
        F.when(_zero_balance().isNotNull(), yyyymm).otherwise("").alias("ZERO_BAL_EFF_DATE"),
        F.concat((3 + key % 5).cast("string"), F.lit(".5")).alias("CURR_INTEREST_RATE"),
    )
