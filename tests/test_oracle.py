"""Every query with SQL against DuckDB, and the shape of the entry module."""

from dataclasses import replace

import pytest

import __spark_entry__ as entry
from arrearscope.operators import boosting, models
from arrearscope.plans import catalog
from tests.oracle_check import compare, connect

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


#: Queries whose SQL would be a second implementation: learnt models, signatures, graphs, packing.
WITHOUT_SQL = ("feature_importance_", "linear_coefficients", "op1_", "op3_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_", "op13_", "pipeline")


def test_every_query_has_a_statement():
    assert set(SQL) <= set(QUERIES)
    assert not [name for name in set(QUERIES) - set(SQL) if not name.startswith(WITHOUT_SQL)]


#: Queries that grow 300 trees: here some, ``tests/oracle_check.py`` runs them as they are.
MANY_TREES = ("train_boosted_a", "train_boosted_b", "train_ensemble")


@pytest.mark.parametrize("name", sorted(set(SQL) - set(MANY_TREES)))
def test_query_equals_sql(spark, small, duck, name):
    assert compare(QUERIES[name](spark, small), duck, SQL[name]) is None


@pytest.mark.parametrize("name", MANY_TREES)
def test_training_equals_sql(spark, small, duck, name, monkeypatch):
    some = {kind: replace(getattr(catalog.TRAINING, kind), trees=12) for kind in ("boosted_a", "boosted_b")}
    monkeypatch.setattr(catalog, "TRAINING", replace(catalog.TRAINING, **some))
    assert compare(QUERIES[name](spark, small), duck, SQL[name].replace(", 300)", ", 12)")) is None


def test_flagship(spark):
    assert entry.entry(spark).columns == ["orig_year", "n_loans", "n_defaults", "n_non_defaults", "default_rate_pct"]


@pytest.mark.parametrize("name", ["train_boosted_b", "train_logistic_regression"])
def test_training_queries_hold_their_models_to_an_auc(name):
    assert "auc_above_floor" in SQL[name]


@pytest.mark.parametrize("name", ["train_boosted_a", "train_random_forest", "train_ensemble"])
def test_all_training_queries_hold_their_models_to_an_auc(name):
    assert "auc_above_floor" in SQL[name]


@pytest.mark.parametrize("name", ["train_random_forest", "train_ensemble"])
def test_models_exceed_the_floor_where_rows_are_enough(spark, name, monkeypatch):
    folder = "/root/testdata/sf0.01"
    some = {kind: replace(getattr(catalog.TRAINING, kind), trees=12) for kind in ("boosted_a", "boosted_b")}
    monkeypatch.setattr(catalog, "TRAINING", replace(catalog.TRAINING, **some))
    assert {r["auc_above_floor"] for r in connect(folder).execute(SQL[name]).fetchdf().to_dict("records")} == {1}
    assert compare(QUERIES[name](spark, folder), connect(folder), SQL[name].replace(", 300)", ", 12)")) is None


def test_a_model_without_knowledge_is_below_the_floor(spark, small, monkeypatch):
    monkeypatch.setattr(models, "learners", lambda config: {"boosted_a": lambda *_: boosting.Booster(0.0, [], [])})
    monkeypatch.setattr(catalog, "LEAST_LEAVES", 0)
    assert {r["auc_above_floor"] for r in QUERIES["train_boosted_a"](spark, small).collect()} == {0}
