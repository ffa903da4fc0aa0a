"""Registered queries against their SQL twins, and the plans of the operators behind them."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from compare import differences, duck

import __spark_entry__ as driver
from driver_queries import adapter, catalog
from windgrid.operators import coverage, levels, validate

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    root = os.path.dirname(os.path.abspath(driver.__file__))
    for name in ("windgrid", "driver_queries"):
        shutil.copytree(f"{root}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert said.stdout.split() == [str(len(catalog.QUERIES)), "0"], said.stderr


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, connection, name):
    found, rows, *_ = differences(spark, connection, catalog.QUERIES[name], catalog.ORACLES[name], SF_DIR)
    assert not found
    assert rows > 0


def test_entry(spark):
    assert driver.entry(spark).columns == ["cod_razaorestricao", "total_hours", "total_mwh_restricted"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mapping_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan_of(catalog.asset_code_join(spark, SF_DIR))


def test_level_join_shuffles_on_name_time_and_slot(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(catalog.joined(spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "SortMergeJoin [_name" in join and "_slot" in join and "LeftOuter" in join
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_first_per_name_is_cut_before_the_shuffle(spark):
    plan = plan_of(levels.first_per_name(adapter.wind(spark, SF_DIR))).splitlines()
    limits = [i for i, line in enumerate(plan) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(_right_name" in line)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_coverage_combines_before_the_shuffle(spark):
    events = adapter.table(spark, SF_DIR, "events")
    plan = plan_of(coverage.hour_coverage(events, ["event_type", "user_id"], "ts"))
    assert "partial_bit_or" in plan and "PushedFilters: [IsNotNull(event_type), IsNotNull(user_id)]" in plan
    assert "value" not in plan.split("ReadSchema")[1]


def test_rules_take_one_scan(spark):
    stored = catalog.stored_joined(spark, SF_DIR)
    assert plan_of(validate.business_rules(stored)).count("FileScan") == 1


def test_no_python_workers_in_any_plan(spark):
    for name in ("level_join", "business_rules", "continuity", "quality_counts", "dim_spe", "clean_spe"):
        plan = plan_of(catalog.QUERIES[name](spark, SF_DIR))
        assert "Python" not in plan and "Pandas" not in plan
