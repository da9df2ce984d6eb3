"""The driver's contract: every query of the core against its SQL on the smallest tables."""

import importlib

import pytest

import __spark_entry__ as entry
from quorum.plans import catalogue
from tools import compare


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_name_and_known_sql():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, small, duck, name):
    got = catalogue.queries()[name](spark, small).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert name in {"p3_profile", "p5_consistent", "p5_aliases", "human_names", "record_linkage", "linkage_clusters"}
        return
    want = duck.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert compare.canon(got) == compare.canon(want)


#: one side of their nested loop is an aggregate of one row
ONE_ROW = {"cross_scalar", "quality_gate", "trailing_window_flags", "freshness_lag", "user_base"}


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - {"p3_profile", "p3_found", "p5_consistent", "p5_aliases", "record_linkage", "linkage_clusters"}))
def test_plans_have_no_product(spark, small, name):
    plan = catalogue.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert name in ONE_ROW or "BroadcastNestedLoopJoin" not in plan


def test_served_people_are_counted_in_order(spark, small):
    rows = catalogue.queries()["people_served"](spark, small).collect()
    assert rows and all(r.once <= r.per_type <= r.per_district <= r.per_row for r in rows)


def test_core_does_not_need_the_llm_part():
    import pathlib

    root = pathlib.Path(importlib.import_module("quorum").__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert "quorum.llm" not in p.read_text(), p
