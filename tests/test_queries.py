"""Registered queries against their SQL.  All of them with CHECK_ALL=1, else a cross-section."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
SOME = ["long_extract", "partition_roundtrip", "typed_values", "record_parity", "field_parity", "glob_exclusions", "diff_resume", "wide_compare",
        "schema_compare", "map_payload", "resolve_refs", "natural_key", "dependency_closure", "link_classify", "owner_audit", "error_parse",
        "one_object_migration", "incremental_extract", "running_results"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()) if os.environ.get("CHECK_ALL") else SOME)
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_entry_and_names(spark):
    assert entry(spark).columns == ["obj", "new_record_id", "old_record_id", "external_id", "change_type", "differing"]
    assert set(oracle_sql()) <= set(queries())


def test_parity_plan_has_one_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = queries()["record_parity"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange ") == 1
