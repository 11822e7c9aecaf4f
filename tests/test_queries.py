"""Registered queries beside their SQL at the smallest scale, and plan properties."""

from __future__ import annotations

import os

import pytest

from checks.compare import TESTDATA, compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")
STREAMS = {"stream_decisions", "stream_state_size", "stream_dedup", "walk_stats", "stream_upsert_replay", "stream_complete_then_walk"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_all_sql_belongs_to_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS] + ["stream_decisions"])
def test_query_equals_its_sql(spark, connection, name):
    verdict = compare(spark, connection, name, SF_DIR)
    assert verdict.startswith(("same", "rows only")), verdict


@pytest.mark.parametrize(
    "name,zone",
    [(n, "America/New_York") for n in ("decisions", "timestamp_parse", "file_order", "decision_trace")]
    + [(n, "Asia/Kolkata") for n in ("timestamp_parse", "progress_records")],
)
def test_results_do_not_depend_on_the_session_time_zone(spark, connection, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        verdict = compare(spark, connection, name, SF_DIR)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert verdict.startswith("same"), verdict


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_and_no_python_rows(spark):
    for name in ("progress_records", "dedup_records", "file_order", "rule_problems", "cluster_completeness"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "BatchEvalPython" not in plan


def test_scans_read_only_their_columns(spark):
    plan = plan_of(QUERIES["dedup_stats"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan
