import re
from dataclasses import replace

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from arrearscope.config import (
    LOAN,
    ORIGINATION_LAYOUT,
    SERVICING_LAYOUT,
    BoostedTreesParams,
    ForestParams,
    LogisticParams,
    RiskConfig,
)
from arrearscope.operators import encode, features, metrics, models, panel, splits
from arrearscope.plans import catalog, flow, testbed
from arrearscope.plans.catalog import _raw_lines
from arrearscope.sources.storage import path_exists, scratch, stored
from arrearscope.sources.tables import load_split, save_with_counts

FAST = replace(
    RiskConfig(),
    boosted_a=BoostedTreesParams(trees=4, depth=3),
    boosted_b=BoostedTreesParams(trees=4, depth=4, leaves=6, seed=7),
    forest=ForestParams(trees=5, depth=4, min_rows_per_leaf=5),
    logistic=LogisticParams(iterations=20),
)


@pytest.fixture(scope="module")
def split(spark):
    folder = "/root/testdata/sf0.01"
    table = features.modeling_table(panel.snapshot(testbed.panel(spark, folder)), testbed.origination(spark, folder))
    return stored(splits.add_splits(table), "test-modeling")


@pytest.fixture(scope="module")
def trained(spark, split, tmp_path_factory):
    # a session that has observed a metric must still be able to score
    save_with_counts(spark.range(3), str(tmp_path_factory.mktemp("observed") / "t"), label=None)
    return models.train_all(splits.training_frame(split), FAST)


def test_all_learners_and_weights(trained):
    assert set(trained.models) == {"boosted_a", "boosted_b", "random_forest", "logistic_regression"}
    assert not trained.failures
    assert abs(sum(trained.weights.values()) - 1) < 1e-12
    assert models.n_trees(trained.models["boosted_a"]) == 4 and models.n_trees(trained.models["random_forest"]) == 5
    assert len(trained.feature_names) == 48


def test_ensemble_lies_between_its_members(spark, split, trained):
    scored = models.score(trained, split)
    names = list(trained.models)
    outside = scored.filter(
        (F.col("ensemble") > F.greatest(*names) + 1e-9) | (F.col("ensemble") < F.least(*names) - 1e-9)
        | ~F.col("boosted_a").between(0, 1) | ~F.col("logistic_regression").between(0, 1))
    assert outside.count() == 0 and scored.count() == split.count()
    called = models.classify(scored).groupBy("predicted").agg(F.min("ensemble"), F.max("ensemble")).collect()
    assert all((row[1] >= 0.5) == (row["predicted"] == 1) for row in called)


def test_scores_of_both_test_splits(split, trained):
    scored = models.score_splits(trained, split)
    rows = metrics.metric_rows(scored).collect()
    assert {(r["model"], r["split"]) for r in rows} == {(m, s) for m in [*trained.models, "ensemble"] for s in ("oos", "oot")}
    expected = {"oos": split.filter("split_oos = 'test'").count(), "oot": split.filter("split_oot = 'test'").count()}
    assert all(r["n_total"] == expected[r["split"]] for r in rows)
    # the trailing label shares its months with the features
    assert all(r["auc_roc"] > 0.8 for r in rows)


def test_importances(spark, trained):
    table = models.feature_importances(spark, trained)
    sums = {r["model"]: r[1] for r in table.groupBy("model").agg(F.sum("importance")).collect()}
    assert abs(sums["boosted_a"] - 1) < 1e-6 and abs(sums["random_forest"] - 1) < 1e-6
    top = models.top_features(table, "boosted_a").collect()
    assert len(top) == 15 and [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)
    linear = table.filter("model = 'logistic_regression'").first()
    assert linear["importance"] == abs(linear["coefficient"])


def test_models_are_stored_and_loaded(spark, split, trained, tmp_path):
    models.save_models(spark, trained, str(tmp_path / "m"))
    loaded = models.load_models(spark, str(tmp_path / "m"))
    assert loaded.weights == trained.weights and loaded.feature_names == trained.feature_names
    rows = split.orderBy(LOAN).limit(20)
    assert models.score(loaded, rows).select("ensemble").collect() == models.score(trained, rows).select("ensemble").collect()
    assert models.load_models(spark, str(tmp_path / "m"), trained.feature_names).weights == trained.weights
    with pytest.raises(ValueError, match="feature list"):
        models.load_models(spark, str(tmp_path / "m"), trained.feature_names[::-1])
    spark.createDataFrame([(0, "other")], "position int, feature string").write.mode("overwrite").parquet(str(tmp_path / "m/feature_names"))
    with pytest.raises(ValueError, match="not whole"):
        models.load_models(spark, str(tmp_path / "m"))


def test_trees_are_scored_from_their_nodes(spark, split, trained):
    names = ["boosted_a", "boosted_b", "random_forest"]
    plain = models.score(trained, split).select(LOAN, *names)
    nodes = models.score_by_nodes(spark, trained, split).select(LOAN, *(F.col(n).alias(f"{n}_nodes") for n in names))
    gaps = plain.join(nodes, LOAN).agg(F.count(F.lit(1)), *(F.max(F.abs(F.col(n) - F.col(f"{n}_nodes"))) for n in names)).first()
    assert gaps[0] == split.count() and all(gap <= 1e-12 for gap in gaps[1:])


def test_linear_model_is_optimal_and_a_wrong_one_is_not(spark, split, tmp_path):
    config = replace(RiskConfig(), logistic=LogisticParams(iterations=500, tolerance=1e-9))
    rows = splits.training_frame(split)
    fitted = models.train_all(rows, config, only=["logistic_regression"])
    table = models.linear_gradient(spark, fitted, rows, config)
    assert table.count() == 49 and table.agg(F.max(F.abs("gradient"))).first()[0] < 1e-4
    early = models.train_all(rows, replace(config, logistic=LogisticParams(iterations=1)), only=["logistic_regression"])
    assert models.linear_gradient(spark, early, rows, config).agg(F.max(F.abs("gradient"))).first()[0] > 1e-2


def test_unseen_and_missing_values_in_features(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", None), ("UNKNOWN", 2.0)], "c string, n double")
    fitted = models.fit_features(train, ["n"], ["c"])
    other = spark.createDataFrame([(0, "b", 5.0), (1, "zz", None), (2, None, 1.0)], "i int, c string, n double")
    vectors = [list(r["features"]) for r in fitted.transform(other).orderBy("i").collect()]
    assert vectors == [[5.0, 2.0], [-1.0, -1.0], [1.0, 0.0]]


def test_one_failing_learner_is_left_out(split):
    broken = replace(FAST, forest=ForestParams(trees=-1))
    result = models.train_all(splits.training_frame(split), broken, only=["random_forest", "logistic_regression"])
    assert set(result.models) == {"logistic_regression"} and set(result.failures) == {"random_forest"}
    assert result.weights == {}


def _fails(rows, stats, names):
    raise ValueError("no trees")


def test_a_failing_learner_is_an_error_where_all_are_wanted(split, monkeypatch):
    logistic = models.learners(FAST)["logistic_regression"]
    monkeypatch.setattr(models, "learners", lambda config: {"boosted_a": _fails, "logistic_regression": logistic})
    with pytest.raises(RuntimeError, match="boosted_a") as raised:
        models.train_all(splits.training_frame(split), FAST, whole=True)
    assert str(raised.value.__cause__) == "no trees"


@pytest.mark.parametrize("name", ["train_ensemble", "feature_importance_top15", "stored_models"])
def test_queries_do_not_give_results_of_fewer_learners(spark, small, monkeypatch, name):
    monkeypatch.setattr(models, "learners", lambda config: {"boosted_a": _fails, "logistic_regression": lambda *_: None})
    monkeypatch.setattr(models, "score_splits", lambda *_: spark.range(1))
    with pytest.raises(RuntimeError, match="boosted_a"):
        catalog.QUERIES[name](spark, small)


def test_wide_column_is_encoded_without_touching_narrow_ones(spark, monkeypatch):
    monkeypatch.setattr(encode, "BROADCAST_CODES", 100)
    frame = stored(spark.createDataFrame([(str(i), "ab"[i % 2]) for i in range(5000)], "wide string, narrow string"), "t")
    codes = encode.fit_codes(frame, ["wide", "narrow"])
    assert [r["code"] for r in codes.filter("column = 'wide'").orderBy("category").collect()] == list(range(5000))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = encode.apply_codes(frame, codes, ["wide", "narrow"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1


def test_forest_keeps_the_rows_nodes_and_grows_the_same_trees(spark):
    rows = stored(spark.range(400).select(
        array_to_vector(F.array(
            (F.col("id") % 17).cast("double"), (F.col("id") * 7 % 31).cast("double"), F.lit(1.0))).alias("features"),
        (F.col("id") * 7 % 31 + F.col("id") % 17 > 22).cast("double").alias("label"), F.lit(1.0).alias("weight"),
        F.lit(False).alias("is_validation")), "forest-rows").coalesce(2)
    found = models.learners(FAST)["random_forest"](rows, None, ["a", "b", "c"]).stages[-1]
    assert found.getCacheNodeIds()
    plain = RandomForestClassifier(
        weightCol="weight", numTrees=FAST.forest.trees, maxDepth=FAST.forest.depth,
        minInstancesPerNode=FAST.forest.min_rows_per_leaf, seed=FAST.forest.seed).fit(rows)
    assert found.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:] and found.totalNumNodes > FAST.forest.trees


def test_origination_is_not_broadcast_by_the_size_of_its_file(spark):
    folder = "/root/testdata/sf0.001"
    table = features.modeling_table(panel.snapshot(testbed.panel(spark, folder)), testbed.origination(spark, folder))
    plan = table._jdf.queryExecution().sparkPlan()
    joins = [name for name in re.findall(r"(\w+Join) \[LOAN_SEQUENCE_NUMBER", plan.toString())]
    assert joins == ["SortMergeJoin"]


def test_whole_flow_from_raw_files(spark, tmp_path):
    folder, raw = "/root/testdata/sf0.01", str(tmp_path / "raw")
    _raw_lines(testbed.raw_origination(spark, folder), ORIGINATION_LAYOUT).write.text(f"{raw}/sample_orig_1999.txt")
    _raw_lines(testbed.raw_servicing(spark, folder), SERVICING_LAYOUT).write.text(f"{raw}/sample_svcg_1999.txt")
    paths = flow.Paths(str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        flow.targets(spark, paths, FAST)
    orig, svcg = flow.ingest(spark, raw, paths, 1999, 2012)
    assert 2000 < orig.count() < 4000 and svcg.count() > 45000
    snap = flow.targets(spark, paths, FAST)
    assert snap.count() == snap.select(LOAN).distinct().count() > 1500
    assert flow.modeling(spark, paths, FAST).count() > 1500
    rows = flow.split(spark, paths, FAST)
    val = load_split(spark, paths.of("splits_trailing"), "oos_val")
    assert val.count() == rows.filter("split_oos = 'val'").count()
    trained = flow.train(spark, paths, FAST)
    assert len(trained.models) == 4
    tables = flow.evaluate(spark, paths, FAST)
    assert tables["model_comparison"].count() == 10
    bands = tables["score_distribution"]
    total = bands.agg(F.sum(F.col("n_loans").cast("int"))).first()[0]
    assert bands.count() == 6 and total == rows.filter("split_oot = 'test'").count()
    assert tables["psi"].count() == 1 and tables["ks_deciles"].count() == 20
    assert tables["top_features"].count() == 15 and tables["max_ks"].count() == 2 and tables["best_model"].count() == 1
    assert tables["model_ranking"].count() == 5 and tables["score_histogram"].count() == 120
    used = spark.read.parquet(paths.of("models_trailing/training")).collect()
    assert {(r["trained_on"], r["validated_on"]) for r in used} == {("oot", "oos_val")}
    with pytest.raises(ValueError, match="made from"):
        flow.ingest(spark, raw, paths, 1999, 2005)
    # forward label: same panel, other rows and tables
    forward = flow.targets(spark, paths, FAST, "forward")
    assert 0 < forward.count() < snap.count()


def test_scratch_is_removed_by_its_owner(spark, tmp_path):
    with scratch(spark, str(tmp_path)) as folder:
        table = stored(spark.range(5), "numbers")
        assert table.count() == 5 and path_exists(spark, folder)
    assert not path_exists(spark, folder)
