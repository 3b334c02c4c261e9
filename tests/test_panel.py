import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from arrearscope.config import LOAN, MONTH, TARGET, RiskConfig
from arrearscope.functions.cleaning import delinquency_level
from arrearscope.operators import clean, panel
from arrearscope.plans import testbed
from arrearscope.plans.catalog import QUERIES


def history(spark, statuses, zero_balances=None, loan="a", start=24000):
    zero_balances = zero_balances or [None] * len(statuses)
    rows = [(loan, start + i, s, z) for i, (s, z) in enumerate(zip(statuses, zero_balances))]
    frame = spark.createDataFrame(rows, f"{LOAN} string, {MONTH} int, DLQCY_STATUS string, ZERO_BAL_CD string")
    return panel.add_event_flags(frame.withColumn("DLQCY_STATUS_NUM", delinquency_level(F.col("DLQCY_STATUS"))))


def values(df, column):
    return [row[column] for row in df.orderBy(LOAN, MONTH).collect()]


def test_event_flags(spark):
    flagged = history(spark, ["0", "2", "3", "RA", "25", "XX", None, "24"], [None, "01", None, "03", "16", "99", None, None])
    assert values(flagged, "IS_90DPD") == [0, 0, 1, 1, 0, 0, 0, 1]
    assert values(flagged, "IS_ZBC_LOSS") == [0, 0, 0, 1, 1, 0, 0, 0]
    assert values(flagged, "IS_PREPAY") == [0, 1, 0, 0, 0, 0, 0, 0]
    assert values(flagged, "IS_DEFAULT_EVENT") == [0, 0, 1, 1, 1, 0, 0, 1]


def test_streak_counts_unknown_status_as_current(spark):
    streak = panel.add_payment_streak(history(spark, ["0", "0", "1", "0", None, "0"]))
    assert values(streak, "payment_streak") == [1, 2, 0, 1, 2, 3]


def test_mean_divides_short_histories_by_the_window(spark):
    rolled = panel.add_rolling_features(history(spark, ["3", "3"]))
    assert values(rolled, "mean_delinq_12m") == [3 / 12, 6 / 12]
    assert values(rolled, "n_serious_delinq_6m") == [1, 2]
    assert "n_serious_delinq_3m" not in rolled.columns


def test_trend_is_the_level_while_history_is_short(spark):
    rolled = panel.add_rolling_features(history(spark, ["1", "2", "0", "0", "0", "3", "1"]))
    assert values(rolled, "delinq_trend_6m") == [1, 2, 0, 0, 0, 2, -1]


def test_trailing_and_forward_labels_look_in_opposite_directions(spark):
    one_event = history(spark, ["3" if i == 5 else "0" for i in range(1, 21)])
    trailing = values(panel.add_label(one_event, "trailing"), TARGET)
    assert [i + 1 for i, label in enumerate(trailing) if label == 1] == list(range(5, 18))
    forward = values(panel.add_label(one_event, "forward"), TARGET)
    assert [i + 1 for i, label in enumerate(forward) if label == 1] == [1, 2, 3, 4]


@pytest.mark.parametrize("rows,expected", [(11, None), (12, 0)])
def test_prepay_in_a_short_frame_has_no_label(spark, rows, expected):
    prepaid = history(spark, ["0"] * rows, [None] * (rows - 1) + ["01"])
    assert values(panel.add_label(prepaid), TARGET)[-1] == expected


def test_default_wins_over_prepay(spark):
    both = history(spark, ["0", "3", "0"], [None, None, "01"])
    assert values(panel.add_label(both), TARGET) == [0, 1, 1]


def test_snapshot_needs_more_rows_than_the_minimum_history(spark):
    rows = history(spark, ["0"] * 6, loan="short").unionByName(history(spark, ["0"] * 7, loan="long"))
    kept = panel.snapshot(rows).collect()
    assert [(row[LOAN], row[MONTH]) for row in kept] == [("long", 24006)]


def test_forward_snapshot_leaves_the_label_window_ahead(spark):
    rows = history(spark, ["0"] * 19 + ["RA"])
    kept = panel.snapshot(rows, direction="forward").collect()
    assert [(row[MONTH], row[TARGET]) for row in kept] == [(24007, 1)]
    assert panel.snapshot(history(spark, ["0"] * 18), direction="forward").count() == 0


def test_range_frame_counts_calendar_months(spark):
    gap = history(spark, ["1"]).unionByName(history(spark, ["0"], start=24010))
    by_rows = gap.select(LOAN, MONTH, panel.rolling_columns((3,))["max_delinq_3m"].alias("m"))
    by_months = gap.select(LOAN, MONTH, panel.rolling_columns((3,), "range")["max_delinq_3m"].alias("m"))
    assert values(by_rows, "m") == [1, 1]
    assert values(by_months, "m") == [1, 0]
    with pytest.raises(ValueError):
        panel.rolling_columns((3,), "weeks")


def test_code_lists_come_from_the_config(spark):
    wider = RiskConfig(serious_codes=("25",))
    frame = history(spark, ["25", "3"]).select(LOAN, MONTH, "DLQCY_STATUS", "ZERO_BAL_CD")
    assert values(panel.add_event_flags(frame, wider), "IS_90DPD") == [1, 0]


def test_months_are_collapsed_and_rows_without_one_stay(spark):
    rows = [Row(**{LOAN: f"l{i % 7}", MONTH: 1 + i % 5 if i % 6 else None, "a": i % 3 if i % 4 else None, "b": str(i % 11)})
            for i in range(400)]
    frame = spark.createDataFrame(rows, f"{LOAN} string, {MONTH} int, a int, b string")
    got = [tuple(r) for r in clean.one_row_per_month(frame).collect()]
    best = {}
    for row in map(tuple, rows):
        if row[1] is not None:
            key, rest = row[:2], (row[2] is not None, row[2] or 0, row[3])
            best[key] = max(best.get(key, rest), rest)
    dated = {r[:2]: (r[2] is not None, r[2] or 0, r[3]) for r in got if r[1] is not None}
    assert dated == best and len([r for r in got if r[1] is not None]) == len(best)
    assert sorted(map(str, (r for r in got if r[1] is None))) == sorted(map(str, (tuple(r) for r in rows if r[1] is None)))


def test_test_panel_keeps_every_month(spark, small):
    months = testbed.table(spark, small, "lineitem").select(
        "l_partkey", F.year("l_shipdate"), F.month("l_shipdate")).distinct().count()
    rows = testbed.panel(spark, small)
    assert rows.count() == rows.select(LOAN, MONTH).distinct().count() == months


def test_panel_features_use_one_exchange_and_one_sort(spark):
    rows = panel.snapshot(history(spark, ["0"] * 20))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_collapsing_limits_repeats_before_the_shuffle(spark, tmp_path):
    history(spark, ["0"] * 20).select(LOAN, MONTH, "DLQCY_STATUS", "DLQCY_STATUS_NUM", "ZERO_BAL_CD").write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    plan = panel.snapshot(clean.one_row_per_month(stored))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # by loan and month, then by loan
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_result_does_not_depend_on_partitions_or_input_order(spark):
    rows = history(spark, ["0", "1", "3", "0"] * 6, loan="x").unionByName(history(spark, ["2", "0"] * 9, loan="y"))
    expected = sorted(map(str, panel.snapshot(rows).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        shuffled = rows.orderBy(F.rand(3)).repartition(5)
        assert sorted(map(str, panel.snapshot(shuffled).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_chains_read_servicing_rows_from_a_table(spark, small):
    """They are made and parsed once, not again for each branch of a plan."""
    for name in ("collapse_months", "flow_snapshot", "flow_modeling"):
        assert not [path for path in QUERIES[name](spark, small).inputFiles() if "lineitem" in path], name
