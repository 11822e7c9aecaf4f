"""The keyed table: overwrite, duplicates, constraints, export."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from driverlens.sources import decision_table as D

SCHEMA = "cluster_id STRING, decision_ts STRING, rule_name STRING, from_workers BIGINT, to_workers BIGINT, ts_us BIGINT, batch_id BIGINT"


def made(spark, *rows):
    return spark.createDataFrame([(c, ts, rule, a, b, n, n) for n, (c, ts, rule, a, b) in enumerate(rows)], SCHEMA)


def content(spark, table):
    return sorted(tuple(r) for r in D.read_decisions(spark, table).collect())


def test_writes_overwrite_by_key_and_retries_change_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    D.put_decisions(made(spark, ("a", "1", "r", 4, 8), ("a", "2", "r", 8, 2)), table, 0, "one")
    for _ in range(2):
        D.put_decisions(made(spark, ("a", "2", "s", 8, 16), ("b", "1", "r", 4, 8)), table, 1, "one")
    want = [("a", "1", "r", 4, 8), ("a", "2", "s", 8, 16), ("b", "1", "r", 4, 8)]
    assert content(spark, table) == want
    assert [tuple(r) for r in D.get_decision(spark, table, "a", "2").collect()] == [want[1]]
    assert D.get_decision(spark, table, "a", "9").count() == 0
    assert [r.decision_ts for r in D.cluster_decisions(D.read_decisions(spark, table), "a").collect()] == ["1", "2"]
    assert D.compact_decisions(spark, table) == 3
    assert content(spark, table) == want and len(list((tmp_path / "t").glob("*/*/write_seq=*"))) == 1


def test_runs_keep_each_others_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    assert D.put_decisions(made(spark, ("a", "1", "r", 4, 8), ("a", "2", "r", 8, 2), ("a", "2", "s", 8, 2)), table) == 2
    assert D.put_decisions(made(spark, ("a", "2", "t", 8, 16), ("b", "1", "r", 4, 8)), table) == 2
    assert D.put_decisions(made(spark).limit(0), table) == 0
    assert content(spark, table) == [("a", "1", "r", 4, 8), ("a", "2", "t", 8, 16), ("b", "1", "r", 4, 8)]


def test_a_write_during_compaction_stays(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    D.put_decisions(made(spark, ("a", "1", "r", 4, 8), ("a", "2", "r", 8, 2)), table, 0, "one")
    D.put_decisions(made(spark, ("b", "1", "r", 4, 8)), table, 0, "two")
    store = D._store

    def meanwhile(rows, path):
        count = store(rows, path)
        monkeypatch.setattr(D, "_store", store)
        D.put_decisions(made(spark, ("a", "2", "s", 8, 16), ("b", "1", "s", 4, 2), ("c", "1", "s", 4, 2)), table, 1, "one")
        return count

    monkeypatch.setattr(D, "_store", meanwhile)
    assert D.compact_decisions(spark, table) == 3
    # Newer in its run, older than the run after it.
    want = [("a", "1", "r", 4, 8), ("a", "2", "s", 8, 16), ("b", "1", "r", 4, 8), ("c", "1", "s", 4, 2)]
    assert content(spark, table) == want
    assert D.compact_decisions(spark, table) == 4 and content(spark, table) == want
    assert sorted(r.cluster_id for r in D.read_write(spark, table, "one", 1).collect()) == ["a", "c"]  # b's is an older run's
    # A repeated write and a further one of an old run take the place they would have had.
    D.put_decisions(made(spark, ("a", "2", "s", 8, 16), ("b", "1", "s", 4, 2), ("c", "1", "s", 4, 2)), table, 1, "one")
    D.put_decisions(made(spark, ("a", "1", "u", 4, 6), ("b", "1", "u", 4, 6)), table, 2, "one")
    D.put_decisions(made(spark, ("c", "1", "v", 4, 6)), table)
    assert content(spark, table) == [("a", "1", "u", 4, 6), *want[1:3], ("c", "1", "v", 4, 6)]


def test_compaction_stopped_half_way_or_of_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    assert D.compact_decisions(spark, table) == 0
    D.put_decisions(made(spark, ("a", "1", "r", 4, 8)), table, 0, "one")
    D.put_decisions(made(spark, ("a", "1", "s", 4, 2)), table, 1, "one")
    monkeypatch.setattr(D, "remove", lambda spark, path: None)
    D.compact_decisions(spark, table)
    monkeypatch.undo()
    assert content(spark, table) == [("a", "1", "s", 4, 2)]
    assert D.compact_decisions(spark, table) == 1 and content(spark, table) == [("a", "1", "s", 4, 2)]


def test_point_lookup_reaches_the_scan(spark, tmp_path):
    table = str(tmp_path / "t")
    D.put_decisions(made(spark, ("a", "1", "r", 4, 8)), table, 0)
    plan = D.get_decision(spark, table, "a", "1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cluster_id,a)" in plan and "EqualTo(decision_ts,1)" in plan
    bucket = spark.range(1).select(D.bucket_of(F.lit("a"))).first()[0]
    assert f"= {bucket})" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_duplicates_in_one_write_keep_the_last(spark):
    rows = D.dedupe_decisions_last(made(spark, ("a", "1", "r", 4, 8), ("a", "1", "s", 8, 2))).collect()
    assert [(r.rule_name, r.to_workers) for r in rows] == [("s", 2)]


@pytest.mark.parametrize(
    "row", [("", "1", "r", 4, 8), ("a", "", "r", 4, 8), ("a", "1", "", 4, 8), ("a", "1", "r", -1, 8), ("a", "1", "r", 4, -8), ("a", "1", "r", 4, 4)]
)
def test_broken_rows_are_reported_and_never_written(spark, tmp_path, row):
    assert D.decision_violations(made(spark, row)).count() == 1
    with pytest.raises(Exception, match="invalid decision"):
        D.put_decisions(made(spark, row), str(tmp_path / "t"))


def test_export_and_import(spark):
    rows = made(spark, ("a", "1", "r", 4, 8))
    items = D.export_items(rows)
    assert json.loads(items.first().item) == {
        "cluster_id": {"S": "a"}, "decision_ts": {"S": "1"}, "rule_name": {"S": "r"}, "from_workers": {"N": "4"}, "to_workers": {"N": "8"},
    }
    assert [tuple(r) for r in D.import_items(items).collect()] == [("a", "1", "r", 4, 8)]
    broken = items.select(F.regexp_replace("item", '"rule_name":..S":"r".,', "").alias("item"))
    with pytest.raises(Exception, match="missing rule_name"):
        D.import_items(broken).collect()
