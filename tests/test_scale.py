"""What may not grow on the driver: broadcasts, listings, paths."""

from __future__ import annotations

import gzip
import json
import os
import time
from datetime import datetime, timedelta

import pytest
from conftest import initial, rule
from pyspark.sql import functions as F

from checks.queries import QUERIES
from driverlens import fixtures as X
from driverlens.functions.timegrid import MINUTE_US
from driverlens.operators import entries as E
from driverlens.operators import gates
from driverlens.plans import decide as plan
from driverlens.session import materialize
from driverlens.sources import logs as L


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_stored_table_is_not_broadcast_for_its_small_files(spark):
    """Half a million equal rows are a few kilobytes of parquet."""
    many = materialize(spark.range(500_000).select(F.lit("cluster-1").alias("cluster_id"), F.lit(1).alias("one")), "many")
    assert "Broadcast" not in plan_of(many.join(spark.range(9).select(F.lit("cluster-2").alias("cluster_id")).localCheckpoint(), "cluster_id"))


def test_a_slice_costs_days_not_hours(spark, monkeypatch):
    """Two ticks a year apart in two slices; the probe of the first state still finds the second."""
    rules = [rule(name="up", target_workers=8), rule(name="down", target_workers=2)]
    ticks = spark.createDataFrame([("c", i * 525_600 * MINUTE_US, 1 + i % 2) for i in range(3)], "cluster_id STRING, ts_us BIGINT, rule_ord INT")
    made, sizes = gates._next_decisions, []

    def watched(*args):
        out = made(*args)
        sizes.append(out._jdf.queryExecution().optimizedPlan().toString().count(str(24 * 60 * MINUTE_US)))
        return out

    monkeypatch.setattr(gates, "_next_decisions", watched)
    walked = gates.walk_ticks(ticks, initial(spark), rules, slice_ticks=1)
    assert [r.outcome for r in walked.orderBy("ts_us").collect()] == ["decision"] * 3
    assert sizes and sizes[0] > 0


def test_tasks_list_what_spark_lists(spark, tmp_path):
    for name in ("a/1.log", "a/b/2 %20[x].log", "top.log", "_hid/3.log", "a/.4.log", "a/_5.log", "a/6._COPYING_", "a/empty.log"):
        (tmp_path / "logs" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "logs" / name).write_text("" if "empty" in name else "x" * len(name))
    for path in (f"{tmp_path}/logs", f"file:{tmp_path}/logs/", f"{tmp_path}/lo*", f"{tmp_path}/logs/*"):
        want = L.read_log_files(spark, path).select("path", "length").collect()
        assert sorted(map(tuple, L.list_log_files(spark, path).collect())) == sorted(map(tuple, want))
    with pytest.raises(FileNotFoundError):
        L.list_log_files(spark, f"{tmp_path}/none")


def test_folders_come_in_groups(spark, monkeypatch):
    monkeypatch.setattr(plan, "FILES_AT_ONCE", 4)
    files = spark.createDataFrame([(f"file:/logs/c[{i}]/{k}.log",) for i in range(5) for k in range(2)], "key STRING")
    groups = list(plan._folder_groups(files))
    assert sorted(map(len, groups)) == [1, 2, 2]
    assert sorted(p for g in groups for p in g) == [f"file:/logs/c\\[{i}\\]" for i in range(5)]


def test_tasks_open_what_spark_opens(spark, tmp_path):
    for name in ("c[1]/1.log", "c[1]/_no.log", "d/2 %20.log"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"\xff" + name.encode() * 9)
    folders = [f"file:{tmp_path}/c\\[1\\]", f"file:{tmp_path}/d"]
    got = L.read_log_files(spark, folders)
    want = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("path", "length", "content").collect()))
    assert "binaryFile" not in plan_of(got)


def test_folders_with_packed_files_are_read_by_spark(spark, tmp_path):
    """Line form: plain files by tasks, names that Spark unpacks by Spark."""
    for name, pack in (("plain/1.log", bytes), ("plain/2.log", bytes), ("mixed/3.log", bytes), ("mixed/4.log.gz", gzip.compress)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(pack(f"25/11/03 09:14:00 {E.PROGRESS_MARKER} {name}\nnext\n25/11/03 09:15:00 other\n".encode()))
    files = L.list_log_files(spark, str(tmp_path)).withColumnRenamed("path", "key")
    by_tasks, by_spark = ([r.text for r in found.orderBy("path").collect()] for found in plan._found_in_lines(spark, str(tmp_path), files))
    assert [t.split()[6] for t in by_tasks] == ["plain/1.log", "plain/2.log"]
    assert [t.split()[6] for t in by_spark] == ["mixed/3.log", "mixed/4.log.gz"]


@pytest.fixture
def few_events(spark, tmp_path):
    """Seven clusters with three days of events each."""
    day = datetime(2024, 1, 1)
    rows = [(e, e % 7, "error" if e % 9 == 4 else "view", day + timedelta(hours=e), 20.0 + 10 * (e % 13), json.dumps({"k": e % 100})) for e in range(70)]
    spark.createDataFrame(rows, "event_id BIGINT, user_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ, value DOUBLE, props STRING").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def files_of(folder) -> dict[str, bytes]:
    return {str(f.relative_to(folder)): f.read_bytes() for f in folder.rglob("*.log*")}


@pytest.mark.parametrize("plain", [False, True])
def test_log_files_are_not_all_on_disk_at_once(spark, few_events, tmp_path, monkeypatch, plain):
    (whole,) = X.write_run(spark, few_events, f"{tmp_path}/whole", plain)[0]
    want, got, clusters = files_of(tmp_path / "whole/logs/0"), {}, []
    assert whole.endswith("/whole/logs/0") and len(want) > 20
    monkeypatch.setattr(X, "EVENTS_AT_ONCE", 20)
    for folder in X.write_run(spark, few_events, f"{tmp_path}/parts", plain)[0]:
        assert [str(f) for f in (tmp_path / "parts/logs").iterdir()] == [folder]  # the one before is gone
        here = files_of(tmp_path / "parts/logs" / os.path.basename(folder))
        clusters.append({path.split("/")[0] for path in here})
        got |= here
    assert got == want
    assert len(clusters) > 1 and sum(map(len, clusters)) == 7  # a cluster's files come together


@pytest.mark.parametrize("name", ["decisions_from_lines", "decisions_from_logs", "decisions_from_ranges", "file_first_ts_early"])
def test_deliveries_give_what_all_files_give(spark, few_events, monkeypatch, name):
    want = sorted(map(tuple, QUERIES[name](spark, few_events).collect()))
    removed, remove = [], X.remove_log_files
    monkeypatch.setattr(X, "remove_log_files", lambda spark, path: removed.append(path) or remove(spark, path))
    monkeypatch.setattr(X, "EVENTS_AT_ONCE", 20)
    assert want and sorted(map(tuple, QUERIES[name](spark, few_events).collect())) == want
    assert removed


def test_a_cluster_in_two_deliveries_is_an_error(spark, tmp_path):
    for part in "ab":
        (tmp_path / part / "c").mkdir(parents=True)
        (tmp_path / part / f"c/{part}.log").write_text("25/11/03 09:14:00 none\n")
    (tmp_path / "clusters.json").write_text('{"clusters": [{"cluster_id": "c", "initial_workers": 4, "num_log_files": 2}]}')
    (tmp_path / "rules.yaml").write_text("rules: []\n")
    run = lambda *logs: plan.decide_from_logs(spark, [str(tmp_path / x) for x in logs], str(tmp_path / "clusters.json"), str(tmp_path / "rules.yaml"))
    assert run("a").collect() == []
    with pytest.raises(ValueError, match="more than one delivery"):
        run("a", "b")


def test_removed_log_folders_are_gone_and_others_stay(spark, tmp_path):
    for name in ("logs/c[1]/1.log", "logs/c[1]/_no.log", "logs/.hid/2.log", "logs/top.log", "other/d/3.log"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    L.remove_log_files(spark, f"file:{tmp_path}/logs")
    assert [str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*.log")] == ["other/d/3.log"]
    assert not (tmp_path / "logs").exists()


def test_a_stored_table_leaves_no_shuffle_files(spark):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {name for name in store.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name}
    before = shuffles()
    kept = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    until = time.time() + 20
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and kept.count() == 7
