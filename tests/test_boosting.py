"""Boosted trees against plain loops, and what is computed from their node tables."""

import math
import pickle
from dataclasses import replace

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from arrearscope.config import BoostedTreesParams
from arrearscope.operators import boosting
from arrearscope.operators.metrics import ranking_metrics, score_curve
from arrearscope.sources.storage import stored

NAMES = ["a", "b", "c", "d"]
WHOLE = BoostedTreesParams(trees=7, depth=6, leaves=6, row_sample=1.0, column_sample=1.0, min_rows_per_leaf=5, min_hessian_per_leaf=2.0,
                           learning_rate=0.3, max_bins=32)


def drawn(n: int, seed: int = 0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.normal(size=n).round(1), rng.uniform(size=n)])
    label = (x[:, 0] + (x[:, 1] > 2) * x[:, 2] + rng.normal(0, 0.5, n) > 0.6).astype(float)
    return x, label, np.where(label == 1, 3.0, 1.0)


@pytest.fixture(scope="module")
def frame(spark):
    x, label, weight = drawn(700)
    rows = [(*map(float, v), float(y), float(w), i >= 500) for i, (v, y, w) in enumerate(zip(x, label, weight))]
    plain = spark.createDataFrame(rows, "a double, b double, c double, d double, label double, weight double, is_validation boolean")
    return stored(VectorAssembler(inputCols=NAMES, outputCol="features").transform(plain), "frame")


def plain_boost(x, label, weight, cuts, params):
    """One leaf after the other: the leaf whose best cut gains most is split next. (depth, feature, cut, weight) of nodes by tree."""
    def score(g, h):
        shrunk = math.copysign(max(abs(g) - params.l1, 0), g)
        return shrunk * shrunk / (h + params.l2)

    margin = np.full(len(x), math.log(weight[label == 1].sum() / weight[label == 0].sum()))
    forest = []
    for _ in range(params.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - label), weight * p * (1 - p)

        def best(rows, depth):
            if depth == params.depth:
                return None
            whole, found = score(g[rows].sum(), h[rows].sum()), None
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(left), len(right)) < params.min_rows_per_leaf or min(h[left].sum(), h[right].sum()) < params.min_hessian_per_leaf:
                        continue
                    gain = score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - whole
                    if gain > 1e-6 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, f, cut, left, right)
            return found

        leaves, splits = [(np.arange(len(x)), 0)], []
        while params.leaves is None or len(leaves) < params.leaves:
            found = [(best(rows, depth), i) for i, (rows, depth) in enumerate(leaves)]
            found = [f for f in found if f[0]]
            if not found:
                break
            (gain, f, cut, left, right), i = max(found, key=lambda q: q[0][0])
            depth = leaves.pop(i)[1]
            splits.append((f, cut, len(left) + len(right)))
            leaves += [(left, depth + 1), (right, depth + 1)]
        weights = []
        for rows, _ in leaves:
            total = g[rows].sum()
            value = -params.learning_rate * math.copysign(max(abs(total) - params.l1, 0), total) / (h[rows].sum() + params.l2)
            margin[rows] += value
            weights.append((len(rows), value))
        forest.append((sorted(splits), sorted(weights)))
    return forest, margin


@pytest.mark.parametrize("leaves", [6, None])
def test_trees_equal_a_plain_loop(spark, frame, leaves):
    params = replace(WHOLE, leaves=leaves, depth=6 if leaves else 3)
    fitted = boosting.fit_booster(frame, NAMES, params)
    x, label, weight = (v[:500] for v in drawn(700))
    train = frame.filter("not is_validation").select(*NAMES)
    cuts = boosting.cut_points(train, NAMES, params.max_bins)
    forest, margin = plain_boost(x, label, weight, cuts, params)
    assert fitted.n_trees == params.trees
    for number, (splits, weights) in enumerate(forest):
        nodes = [n for n in fitted.nodes if n[0] == number]
        assert sorted((n[2], n[5], n[11]) for n in nodes if n[2] is not None) == splits
        leaves_found = sorted((n[11], n[12]) for n in nodes if n[2] is None)
        assert [n for n, _ in leaves_found] == [n for n, _ in weights]
        assert np.allclose([w for _, w in leaves_found], [w for _, w in weights], atol=1e-8)
        assert leaves is None or len(weights) <= leaves
    scored = frame.filter("not is_validation").select(*NAMES, fitted.margin(vector_to_array("features")).alias("m")).collect()
    by_row = {tuple(r[:4]): r["m"] for r in scored}
    assert max(abs(by_row[tuple(map(float, v))] - m) for v, m in zip(x, margin)) < 1e-7


def test_best_first_growth_is_not_level_by_level(spark, frame):
    first = boosting.fit_booster(frame, NAMES, replace(WHOLE, trees=3, leaves=5, depth=8))
    levels = boosting.fit_booster(frame, NAMES, replace(WHOLE, trees=3, leaves=None, depth=2))
    assert all(sum(n[2] is None for n in first.nodes if n[0] == t) <= 5 for t in range(3))
    assert any(n[2] is None for n in first.nodes) and first.nodes != levels.nodes


def test_leaves_are_the_closed_form_and_shrink_with_penalties(spark, frame):
    fitted = boosting.fit_booster(frame, NAMES, WHOLE)
    nodes = fitted.table(spark)
    assert boosting.wrong_leaves(nodes, WHOLE).count() == 0
    assert boosting.wrong_leaves(nodes.withColumn("weight", F.col("weight") * 1.01), WHOLE).count() > 0
    stiff = replace(WHOLE, trees=1, l1=5.0, l2=50.0)
    one, other = (boosting.fit_booster(frame, NAMES, p) for p in (replace(WHOLE, trees=1), stiff))
    assert boosting.wrong_leaves(other.table(spark), stiff).count() == 0
    assert max(abs(n[12]) for n in other.nodes) < max(abs(n[12]) for n in one.nodes)


def test_trees_do_not_depend_on_partitions(spark, frame, monkeypatch):
    one = boosting.fit_booster(frame.coalesce(1), NAMES, WHOLE)
    monkeypatch.setattr(boosting, "ROWS_PER_PARTITION", 60)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 17)
    assert boosting.fit_booster(frame.coalesce(1).repartition(6), NAMES, WHOLE).nodes == one.nodes


def test_margins_after_renewals_are_those_of_all_trees(spark, frame, monkeypatch):
    plain = boosting.fit_booster(frame, NAMES, replace(WHOLE, row_sample=0.7, column_sample=0.5))
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "CHAIN", 2)
    assert boosting.fit_booster(frame, NAMES, replace(WHOLE, row_sample=0.7, column_sample=0.5)).nodes == plain.nodes
    by_tree = {n[0]: n[11] for n in plain.nodes if n[1] == 0}
    assert len(set(by_tree.values())) > 1 and all(270 < n < 430 for n in by_tree.values())


def test_prefix_aucs_and_patience(spark, frame):
    params = replace(WHOLE, trees=25, leaves=20, patience=4, min_hessian_per_leaf=0.5, learning_rate=0.6)
    fitted = boosting.fit_booster(frame, NAMES, params)
    whole = boosting.fit_booster(frame, NAMES, replace(params, patience=None))
    aucs = fitted.validation_auc
    best = boosting.stop_at(aucs, 4) or 1 + aucs.index(max(aucs))
    assert fitted.n_trees == best and fitted.nodes == whole.cut(best).nodes
    held_out = frame.filter("is_validation")
    for trees in (1, 3, len(aucs)):
        scored = held_out.select(F.lit(1).alias("model"), F.col("label").cast("int").alias("y"),
                                 F.round(whole.cut(trees).margin(vector_to_array("features")), 12).alias("p"))
        assert abs(ranking_metrics(score_curve(scored, ["model"]), ["model"]).first()["auc_roc"] - aucs[trees - 1]) < 1e-9


def test_narrow_features_are_added_up_together():
    rng = np.random.default_rng(3)
    widths, n = [40, 3, 1, 300, 2, 5, 2, 7], 500
    x = np.stack([rng.integers(0, min(w, 256), n).astype(np.uint8) for w in widths])
    label, weight, margin = rng.integers(0, 2, n).astype(float), rng.integers(1, 4, n).astype(float), rng.normal(size=n)
    packs = boosting._packs([0, 1, 3, 4, 5, 6, 7], widths)
    assert sorted(f for _, members in packs for f in members) == [0, 1, 3, 4, 5, 6, 7] and len(packs) == 3
    assert all(size <= 256 or len(members) == 1 for size, members in packs)
    tree = boosting.Tree(np.array([1, 0, 0]), np.array([0, 0, 0]), np.array([1, 1, 2]), np.array([2, 1, 2]), np.zeros(3), 1)
    groups, slots = [[0, 5, 3], [1, 2, 4, 6, 7]], np.array([-1, -1, 0])
    for params in (WHOLE, replace(WHOLE, row_sample=0.5)):
        blocks = [(np.arange(n)[i:i + 200], x[:, i:i + 200], label[i:i + 200], weight[i:i + 200], margin[i:i + 200]) for i in (0, 200, 400)]
        found = dict(boosting._histogram([tree], tree, slots, groups, widths, 1, params, 2.0**20)(iter(blocks)))
        mine = (x[1] > 0) & (boosting._uniform(np.arange(n), 1, params.seed) < params.row_sample)
        g, h = boosting._gradients(label, weight, margin, 2.0**20)
        for i, group in enumerate(groups):
            wanted = [np.stack([np.bincount(x[f][mine], v[mine], widths[f]) for v in (g, h, np.ones(n))], 1).ravel() for f in group]
            assert (found[i] == np.concatenate(wanted)).all()


def test_rows_walk_the_trees_together_and_get_the_same_sums(spark, frame, monkeypatch):
    monkeypatch.setattr(boosting, "WALK_ROWS", 50)
    fitted = boosting.fit_booster(frame, NAMES, WHOLE)
    nodes = [*fitted.nodes, (7, 0, *[None] * 7, 0.0, 1.0, 1, 0.25)]  # and a tree that is a leaf
    odd = spark.createDataFrame(
        [(None,), ([None, 1.0, 2.0, None],), ([math.nan, math.inf, -math.inf, 0.0],), ([0.1, 2.0, 0.3, 0.4],)], "x array<double>")
    values = frame.select(vector_to_array("features").alias("x")).unionByName(odd)
    for rows in (values, values.filter("x is null"), values.limit(0)):
        found = rows.coalesce(1).select(boosting.walked_sums(nodes, F.col("x"), 0.5), boosting.tree_sums(nodes, F.col("x"), 0.5)).collect()
        assert [r[0] for r in found] == [r[1] for r in found] and len(found) == rows.count()
    plan = frame.select(fitted.probability(vector_to_array("features")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan  # a row alone took milliseconds for 300 trees


@pytest.mark.parametrize(("aucs", "patience", "stop"), [
    ([0.5, 0.6, 0.6, 0.6], 2, 2), ([0.5, 0.6, 0.6], 2, None), ([0.9, 0.8, 0.95, 0.1, 0.1, 0.99], 2, 3), ([], 3, None)])
def test_patience_rule(aucs, patience, stop):
    assert boosting.stop_at(aucs, patience) == stop


def test_importances_are_grouped_sums(spark, frame):
    fitted = boosting.fit_booster(frame, NAMES, WHOLE)
    gains = {}
    for n in fitted.nodes:
        if n[2] is not None:
            gains.setdefault(n[3], []).append(n[8])
    for kind, value in (("gain", np.mean), ("total_gain", np.sum), ("splits", len)):
        wanted = {name: float(value(g)) for name, g in gains.items()}
        found = {r["name"]: r["importance"] for r in boosting.importances(fitted.table(spark), kind).collect()}
        assert found.keys() == wanted.keys()
        assert all(abs(found[n] - w / sum(wanted.values())) < 1e-12 for n, w in wanted.items())


def test_rows_without_a_choice(spark, frame):
    same = VectorAssembler(inputCols=NAMES, outputCol="features").transform(
        frame.drop("features").withColumns({name: F.lit(1.0) for name in NAMES}))
    fitted = boosting.fit_booster(stored(same, "same"), NAMES, replace(WHOLE, trees=2))
    assert fitted.n_trees == 2 and all(n[2] is None for n in fitted.nodes)
    only = frame.filter("label = 1")
    assert boosting.fit_booster(only, NAMES, WHOLE).nodes == []
    assert boosting.fit_booster(only, NAMES, WHOLE).base == math.inf
    assert boosting.fit_booster(frame.limit(0), NAMES, WHOLE).base == 0.0
    one = frame.limit(1).select(boosting.fit_booster(only, NAMES, WHOLE).probability(vector_to_array("features"))).first()[0]
    assert one == 1.0


def test_only_splits_reach_the_driver(spark, frame, monkeypatch):
    """Histograms of several partitions are summed, and searched for splits, in tasks."""
    monkeypatch.setattr(boosting, "ROWS_PER_PARTITION", 60)
    sizes, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda rdd: (sizes.append(len(pickle.dumps(found := collect(rdd)))), found)[1])
    model = boosting.fit_booster(frame.coalesce(1), NAMES, replace(WHOLE, trees=2))
    assert model.n_trees == 2 and sizes and max(sizes) < 20_000


def test_blocks_have_no_more_partitions_than_cores_while_they_are_small():
    assert [boosting.block_partitions(n, 12) for n in (0, 1_000, 5_000_000, 50_000_000)] == [1, 1, 12, 51]
