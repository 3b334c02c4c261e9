import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrearscope.config import LOAN, ScoreScale
from arrearscope.functions.scoring import risk_label, score_band, score_points
from arrearscope.operators import metrics, reports
from arrearscope.operators.ordered import exact_quantiles, prefix_sums, range_edges


def scored(spark, pairs, model="m", split="oos"):
    rows = [(model, split, f"L{i}", y, p) for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, f"model string, split string, {LOAN} string, y int, p double")


def random_pairs(seed, n, scores):
    rng = random.Random(seed)
    return [(int(rng.random() < 0.3), rng.choice(scores) if scores else rng.random() ** 3) for _ in range(n)]


def brute_force(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    cuts = sorted({p for _, p in pairs}, reverse=True)
    ks = max(abs(sum(a >= c for a in pos) / len(pos) - sum(b >= c for b in neg) / len(neg)) for c in cuts)
    ap, recall = 0.0, 0.0
    for c in cuts:
        tp, fp = sum(a >= c for a in pos), sum(b >= c for b in neg)
        ap += (tp / len(pos) - recall) * tp / (tp + fp)
        recall = tp / len(pos)
    brier = sum((p - y) ** 2 for y, p in pairs) / len(pairs)
    return auc, ks, ap, brier


@pytest.mark.parametrize("seed,n,scores", [
    (1, 200, None), (2, 300, [0.0, 0.25, 0.5, 0.5000001, 1.0]), (3, 250, [0.001 * i for i in range(20)]), (4, 120, [0.4]),
])
def test_metrics_equal_brute_force(spark, seed, n, scores):
    pairs = random_pairs(seed, n, scores)
    auc, ks, ap, brier = brute_force(pairs)
    found = metrics.ranking_metrics(metrics.score_curve(scored(spark, pairs))).first()
    assert math.isclose(found["auc_roc"], auc) and math.isclose(found["gini"], 2 * auc - 1, abs_tol=1e-12)
    assert math.isclose(found["ks_stat"], ks, abs_tol=1e-12) and math.isclose(found["auc_pr"], ap)
    row = metrics.metric_rows(scored(spark, pairs)).first()
    assert row["brier_score"] == round(brier, 5) and row["n_total"] == n
    assert row["TP"] == sum(y == 1 and p >= 0.5 for y, p in pairs) or row["TP"] is None


def test_edges_only_balance_the_work(spark):
    pairs = random_pairs(5, 400, None)
    frame = scored(spark, pairs)
    inf = float("inf")
    results = {
        tuple(metrics.metric_rows(frame, edges=edges).first())
        for edges in ([-inf, 0.5, inf], [-inf, 0.9999, inf], [-inf, *[i / 50 for i in range(1, 50)], inf])
    }
    assert len(results) == 1


def test_one_class_only(spark):
    row = metrics.metric_rows(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (row["auc_roc"], row["ks_stat"], row["TP"], row["precision"], row["f1"]) == (None, 0.0, None, 0.0, 0.0)
    called = metrics.metric_rows(scored(spark, [(0, 0.1), (0, 0.7)])).first()
    assert (called["TP"], called["TN"], called["FP"], called["FN"]) == (0, 1, 1, 0)


def test_unlabelled_rows_are_left_out(spark):
    frame = scored(spark, [(1, 0.9), (0, 0.1), (None, 0.5)])
    assert metrics.metric_rows(frame).first()["n_total"] == 2


def test_prefix_sums_equal_a_plain_window(spark):
    rows = [("a" if i % 3 else "b", float((i * 37) % 101) / 7 - 5, i % 5) for i in range(100)]
    frame = spark.createDataFrame(rows, "g string, v double, n long").groupBy("g", "v").agg(F.sum("n").alias("n"))
    placed = prefix_sums(frame, ["g"], "v", ["n"], range_edges(frame, "v", 8), following=["n"]).collect()
    for group in "ab":
        running, ordered = 0, sorted((r for r in placed if r["g"] == group), key=lambda r: -r["v"])
        for row, after in zip(ordered, [*ordered[1:], None]):
            running += row["n"]
            assert row["cum_n"] == running
            assert row["next_n"] == (after["n"] if after else None)
        assert {row["total_n"] for row in ordered} == {running}


def test_range_edges_are_bounded_and_open(spark):
    edges = range_edges(spark.range(10000).select(F.col("id").cast("double").alias("v")), "v", 16)
    assert len(edges) == 17 and edges[0] == float("-inf") and edges[-1] == float("inf")
    assert range_edges(spark.range(3).select(F.lit(None).cast("double").alias("v")), "v") == [float("-inf"), 0.0, float("inf")]
    assert len(range_edges(spark.range(50).select(F.lit(0.3).alias("v")), "v")) == 3


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(size=n), 2)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    shares = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.9, "q10": 1.0}
    found = exact_quantiles(frame, "v", shares).first()
    for name, share in shares.items():
        assert math.isclose(found[name], np.quantile(values, share), abs_tol=1e-9)


def test_roc_and_pr_points(spark):
    frame = scored(spark, [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.5), (0, 0.4), (0, 0.3)])
    points = [(r["threshold"], r["fpr"], round(r["tpr"], 4)) for r in
              metrics.roc_points(frame).orderBy(F.desc_nulls_first("threshold")).collect()]
    # 0.9 is first; 0.5 and 0.4 go because the next step repeats their own
    assert points == [(None, 0.0, 0.0), (0.9, 0.0, 0.3333), (0.8, 0.0, 0.6667), (0.7, 0.25, 0.6667),
                      (0.6, 0.25, 1.0), (0.3, 1.0, 1.0)]
    assert metrics.roc_points(frame, drop_collinear=False).count() == 8
    pr = metrics.pr_points(frame).orderBy(F.desc_nulls_first("threshold")).collect()
    assert (pr[0]["threshold"], pr[0]["precision"], pr[0]["recall"]) == (None, 1.0, 0.0)
    assert len(pr) == 8 and math.isclose(pr[-1]["precision"], 3 / 7)


def test_score_points(spark):
    values = [0.05, 0.9051, 0.0002, 0.0, 1.0, 0.5]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    scores = [r[0] for r in frame.orderBy("i").select(score_points(F.col("p"))).collect()]
    assert scores[:5] == [600, 300, 900, 900, 300] and scores[5] == 430


def test_bands_and_labels(spark):
    frame = spark.createDataFrame([(s,) for s in (300, 580, 581, 620, 760, 761, 900, 299)], "s int")
    found = [tuple(r) for r in frame.select(score_band(F.col("s")), risk_label(F.col("s"))).collect()]
    assert found == [("300-580", "Very High Risk")] * 2 + [("580-620", "High Risk")] * 2 + [
        ("720-760", "Low-Medium Risk"), ("760-900", "Low Risk"), ("760-900", "Low Risk"), (None, None)]


def test_score_distribution_keeps_empty_bands(spark):
    frame = spark.createDataFrame([(300, 1), (400, 0), (600, 0)], "score int, y int")
    table = {r["score_bucket"]: r for r in reports.score_distribution(frame).collect()}
    assert len(table) == 6
    assert tuple(table["300-580"])[1:] == (2, 350.0, 300, 400, 50.0, 66.7)
    assert tuple(table["760-900"])[1:] == (0, None, None, None, None, 0.0)
    assert "default_rate_pct" not in reports.score_distribution(frame, label=None).columns


@pytest.mark.parametrize("fixed", [True, False])
def test_histogram_equals_numpy(spark, fixed):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(300, 900, 300), [300, 900]]).astype(float)
    frame = spark.createDataFrame([(float(v), 1) for v in values], "score double, y int")
    limits = (300, 900) if fixed else (None, None)
    table = reports.histogram(frame, "score", 30, *limits).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=30, range=(300, 900))
    density, _ = np.histogram(values, bins=30, range=(300, 900), density=True)
    assert [r["n"] for r in table] == counts.tolist()
    assert np.allclose([r["density"] for r in table], density) and np.allclose([r["bin_start"] for r in table], edges[:-1])


def decile_oracle(rows):
    ordered = sorted(rows, key=lambda r: (-r[2], hashlib.md5(r[0].encode()).hexdigest(), r[0]))
    bins = {}
    for rank, (_, y, p) in enumerate(ordered):
        bins.setdefault(10 * rank // len(ordered) + 1, []).append((y, p))
    return {d: (len(v), sum(y for y, _ in v), min(p for _, p in v), max(p for _, p in v)) for d, v in bins.items()}


@pytest.mark.parametrize("digits", [0, 3])
def test_deciles_split_a_hot_score_exactly(spark, monkeypatch, digits):
    # two thirds of the rows share one score; with no tie digits they are one block
    monkeypatch.setattr(reports, "TIE_DIGITS", digits)
    rng = random.Random(8)
    pairs = [(int(rng.random() < 0.4), 0.3 if i % 3 else round(rng.random(), 2)) for i in range(997)]
    table = reports.ks_deciles(scored(spark, pairs)).orderBy("decile").collect()
    expected = decile_oracle([(f"L{i}", y, p) for i, (y, p) in enumerate(pairs)])
    assert {r["decile"]: (r["n"], r["n_default"], r["min_p"], r["max_p"]) for r in table} == expected
    best = reports.max_ks(reports.ks_deciles(scored(spark, pairs))).first()
    top = max(table, key=lambda r: (r["ks"], -r["decile"]))
    assert (best["max_ks"], best["decile"]) == (top["ks"], top["decile"])
    assert table[-1]["cum_default_pct"] == 100.0


def test_psi(spark):
    rng = random.Random(1)
    same = [(0, round(rng.random(), 3)) for _ in range(2000)]
    shifted = [(0, min(1.0, p + 0.3)) for _, p in same]
    stable = scored(spark, same).unionByName(scored(spark, same, split="oot"))
    assert reports.psi(reports.psi_bins(stable)).first()["status"] == "STABLE"
    moved = scored(spark, same).unionByName(scored(spark, shifted, split="oot"))
    bins = reports.psi_bins(moved).collect()
    assert len(bins) == 10 and sum(r["n_actual"] for r in bins) == 2000
    assert reports.psi(reports.psi_bins(moved)).first()["status"] == "SIGNIFICANT SHIFT"
    ungrouped = reports.psi(reports.psi_bins(moved, groups=()), groups=()).first()
    assert math.isclose(ungrouped["psi"], reports.psi(reports.psi_bins(moved)).first()["psi"])


def test_tables_over_metric_rows(spark):
    rows = [("a", "oos", 0.9, 0.7), ("a", "oot", 0.84, 0.6), ("b", "oos", 0.8, 0.5), ("b", "oot", 0.85, 0.5), ("c", "oos", 0.7, 0.4)]
    frame = spark.createDataFrame(rows, "model string, split string, auc_roc double, ks_stat double")
    drop = {r["model"]: (r["auc_drop"], r["high_degradation"]) for r in metrics.stability_drop(frame).collect()}
    assert round(drop["a"][0], 6) == 0.06 and drop["a"][1] == 1 and drop["b"][1] == 0 and drop["c"] == (None, 0)
    pivot = {r["model"]: r for r in metrics.metric_pivot(frame).collect()}
    assert pivot["a"]["oot_ks_stat"] == 0.6 and pivot["c"]["oot_auc_roc"] is None
    assert metrics.best_model(frame).first()["model"] == "b"
    assert [r["model"] for r in metrics.comparison_table(frame).collect()] == ["a", "b", "c", "b", "a"]
    weights = metrics.ensemble_weights(frame).groupBy("split").agg(F.sum("weight")).collect()
    assert all(math.isclose(r[1], 1.0) for r in weights)


def test_default_rate_and_imbalance(spark):
    frame = spark.createDataFrame([("x", 1), ("x", 0), ("x", 0), ("x", None), ("y", 0)], "g string, TARGET_12M int")
    rates = {r["g"]: tuple(r)[1:] for r in metrics.default_rate(frame, ["g"]).collect()}
    assert rates == {"x": (4, 1, 3, 25.0), "y": (1, 0, 1, 0.0)}
    ratios = {r["g"]: r["imbalance_ratio"] for r in metrics.class_imbalance(frame, ["g"]).collect()}
    assert ratios == {"x": 2.0, "y": 1.0}
    assert {r["TARGET_12M"]: r["n"] for r in metrics.label_counts(frame).collect()} == {1: 1, 0: 3, None: 1}
    assert tuple(metrics.default_rate(frame.limit(0)).first()) == (0, 0, 0, 0.0)


def test_ordered_metrics_never_gather_rows_in_one_task(spark, tmp_path):
    scored(spark, random_pairs(9, 50, None)).write.parquet(str(tmp_path / "scored"))
    frame = spark.read.parquet(str(tmp_path / "scored"))
    for table in (metrics.metric_rows(frame), metrics.roc_points(frame), reports.ks_deciles(frame)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_null_groups_and_models_without_expected_rows_stay(spark):
    rows = [(m, s, f"l{i}", i % 2, i / 40) for m, s in (("a", "oos"), ("a", "oot"), (None, "oos"), (None, "oot"), ("late", "oot"))
            for i in range(40)]
    scored = spark.createDataFrame(rows, f"model string, split string, {LOAN} string, y int, p double")
    assert {r["model"] for r in metrics.metric_rows(scored).collect()} == {"a", None, "late"}
    assert reports.ks_deciles(scored).count() == 50
    found = {r["model"]: (r["psi"], r["status"]) for r in reports.psi(reports.psi_bins(scored)).collect()}
    assert found["late"] == (None, "NO EXPECTED ROWS") and found["a"][1] == found[None][1] == "STABLE"


def test_labels_follow_the_scale(spark):
    wide = ScoreScale(low=0, high=1200)
    frame = spark.createDataFrame([(1e-9,), (1 - 1e-9,)], "p double")
    rows = reports.add_scores(frame, score="s", scale=wide).collect()
    assert [r["risk_bucket"] for r in rows] == ["Low Risk", "Very High Risk"] and rows[0]["s"] > 900 and rows[1]["s"] < 300
