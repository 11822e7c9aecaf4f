"""Incremental runs: same table as the batch plan, bounded state, safe repeats."""

from __future__ import annotations

import random

import pytest
from conftest import frame, initial, raw, record, rule, us

from driverlens.plans.decide import decide
from driverlens.sources.decision_table import read_decisions
from driverlens.streaming.buffered import ARRIVAL_SCHEMA, CompleteThenWalk
from driverlens.streaming.incremental import RECORD_SCHEMA, IncrementalWalk

BACKLOG = rule(name="backlog", metric="backlog", aggregation="last", operator="gt", threshold=40, min_batches=2, window_minutes=14, target_workers=12, cooldown_minutes=16)
CALM = rule(name="calm", metric="rate", aggregation="avg", operator="lt", threshold=20, min_batches=3, window_minutes=25, target_workers=3, cooldown_minutes=9)


LONG = rule(name="long", metric="batchDuration", aggregation="min", threshold=100, min_batches=3, window_minutes=10, target_workers=8)


def incremental(spark, tmp_path, rules, **workers):
    rows = list((workers or {"c": 4}).items())
    manifest = spark.createDataFrame(rows, "cluster_id STRING, initial_workers BIGINT")
    return IncrementalWalk(rules, manifest, str(tmp_path / "state"), str(tmp_path / "table"))


def table(spark, tmp_path):
    rows = read_decisions(spark, str(tmp_path / "table")).collect()
    return sorted((r.cluster_id, r.decision_ts, r.from_workers, r.to_workers) for r in rows)


def daily_files(seed, clusters, files=5, minutes=50):
    """Random records of several clusters; some are logged again in the same file or the next, some only in the next."""
    chance, parts = random.Random(seed), [[] for _ in range(files + 1)]
    for cluster in clusters:
        for batch in range(files * 14):
            minute = batch * minutes // 14
            at = us(2, minute, chance.randrange(60_000_000))
            level = 25 if (minute // 40) % 2 else 70
            row = record(at, batch, cluster=cluster, backlog=level + chance.randrange(-30, 30), rate=level - chance.randrange(30))
            own = minute // minutes
            parts[own + (chance.random() < 0.1)].append(row)
            if chance.random() < 0.2:
                parts[own + chance.randrange(2)].append(row)
    return [p for p in parts if p]


def test_stream_equals_batch_through_a_real_query(spark, tmp_path):
    files = daily_files(4, ("red", "blue"))
    walk = incremental(spark, tmp_path, [BACKLOG, CALM], red=5, blue=12)
    for part in files:
        frame(spark, part).write.mode("append").parquet(str(tmp_path / "input"))
        stream = spark.readStream.schema(RECORD_SCHEMA).parquet(str(tmp_path / "input"))
        walk.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
    walk.finish(spark, len(files))
    every = [r for part in files for r in part]
    whole = decide(frame(spark, every), initial(spark, red=5, blue=12), [BACKLOG, CALM]).collect()
    want = sorted((d.cluster_id, d.decision_ts, d.from_workers, d.to_workers) for d in whole)
    assert {w[0] for w in want} == {"red", "blue"} and {w[3] for w in want} == {3, 12}
    assert table(spark, tmp_path) == want
    for cluster in ("red", "blue"):
        stats = walk.stats(spark, len(files)).where(f"cluster_id = '{cluster}'").first()
        mine = [r for r in every if r[0] == cluster]
        assert (stats.records_seen, stats.unique_records, stats.evaluation_points) == (len(mine), 70, 70)
        assert stats.peak_held_records < 50


def test_a_record_from_the_next_file_keeps_its_place(spark, tmp_path):
    walk = incremental(spark, tmp_path, [BACKLOG])
    walk.process(frame(spark, [record(us(3, 31), 20, backlog=55), record(us(3, 40), 21, backlog=10)]), 0)
    assert table(spark, tmp_path) == []  # nothing confirms the first file yet
    assert walk.pending(spark, 0).count() == 2
    # Written late: batch 22 lies between the two, and 21 is there again.
    following = [record(us(3, 36), 22, backlog=90), record(us(3, 40), 21, backlog=10), record(us(3, 44), 23, backlog=41)]
    for _ in range(2):
        walk.process(frame(spark, following), 1)
    for _ in range(2):
        walk.finish(spark, 2)
    assert table(spark, tmp_path) == [("c", raw(us(3, 36)), 4, 12)]
    stats = walk.stats(spark, 2).first()
    assert (stats.records_seen, stats.unique_records) == (5, 4)


def test_state_is_pruned_and_late_records_are_counted(spark, tmp_path):
    walk = incremental(spark, tmp_path, [rule(metric="batchDuration", threshold=100, window_minutes=10)])
    for hour in range(3):
        part = [record(us(8 + hour, m), hour * 60 + m, batchDuration=1) for m in range(0, 60, 10)]
        walk.process(frame(spark, part), hour)
    # After the third file the look-back holds what lies within ten minutes before it.
    assert walk.state(spark, "lookback", 2).count() == 0
    assert walk.state(spark, "seen", 2).count() == 18
    walk.process(frame(spark, [record(us(8, 1), 999, batchDuration=1), record(us(11), 180, batchDuration=1)]), 3)
    # Keys are forgotten two hours beyond the window: the earliest record counts as new again.
    walk.process(frame(spark, [record(us(11, 5), 181, batchDuration=1), record(us(11), 180, batchDuration=1)]), 4)
    assert walk.state(spark, "seen", 4).filter("batch_id = 0").count() == 0
    walk.process(frame(spark, [record(us(8), 0, batchDuration=1)]), 5)
    walk.finish(spark, 6)
    stats = walk.stats(spark, 6).first()
    assert (stats.late_records, stats.records_seen, stats.unique_records) == (2, 23, 22)


def test_clusters_advance_on_their_own(spark, tmp_path):
    walk = incremental(spark, tmp_path, [BACKLOG], north=4, south=4)
    opening = [record(us(5, 11 * m), m, cluster=c, backlog=60) for c in ("north", "south", "nobody") for m in range(3)]
    walk.process(frame(spark, opening), 0)
    walk.process(frame(spark, [record(us(5, 33), 3, cluster="south", backlog=60)]), 1)
    assert table(spark, tmp_path) == [("south", raw(us(5, 11)), 4, 12)]
    assert {r.cluster_id for r in walk.pending(spark, 1).select("cluster_id").distinct().collect()} == {"north", "south"}
    walk.finish(spark, 2)
    assert [r[0] for r in table(spark, tmp_path)] == ["north", "south"]


@pytest.mark.parametrize("repeat", [1, 2])
def test_complete_then_walk(spark, tmp_path, repeat):
    manifest = spark.createDataFrame([("a", 4, 2), ("b", 4, 2)], "cluster_id STRING, initial_workers BIGINT, num_log_files BIGINT")
    walk = CompleteThenWalk([LONG], manifest, str(tmp_path / "state"), str(tmp_path / "table"))

    def arrive(epoch, *rows):
        batch = spark.createDataFrame([(*r, key) for key, r in rows], ARRIVAL_SCHEMA)
        for _ in range(repeat):
            walk.process(batch, epoch)

    late = [("f2", record(us(10, m), 60 + m, cluster="a", batchDuration=500)) for m in (0, 2)]
    arrive(0, *late, *[("f1", record(us(9), 1, cluster="b", batchDuration=500))], ("f1", record(us(9), 1, cluster="ghost")))
    early = [("f1", record(us(9, m), m, cluster="a", batchDuration=500)) for m in (0, 2, 4)]
    arrive(1, *early)
    assert table(spark, tmp_path) == [("a", raw(us(9, 4)), 4, 8)]
    # A third file for a done cluster is ignored; an empty file completes the other one.
    arrive(2, ("f3", record(us(8), 0, cluster="a", batchDuration=500)), ("f2", ("b", None, None, None, None, None, 0, 0)))
    assert table(spark, tmp_path) == [("a", raw(us(9, 4)), 4, 8)]
    assert sorted(r.cluster_id for r in walk._state(spark, "done", "cluster_id STRING", 2).collect()) == ["a", "b"]


@pytest.mark.parametrize("repeat", [1, 2])
def test_arrivals_of_walked_clusters_go(spark, tmp_path, monkeypatch, repeat):
    """Clusters come one after another in two files each, one stays open: the log stays as small, and the open one keeps all its rows."""
    from driverlens.streaming import buffered

    monkeypatch.setattr(buffered, "BUCKETS", 2)
    names = [f"k{n}" for n in range(3)]
    manifest = spark.createDataFrame([(n, 4, 2) for n in [*names, "open"]], "cluster_id STRING, initial_workers BIGINT, num_log_files BIGINT")
    walk = CompleteThenWalk([LONG], manifest, str(tmp_path / "state"), str(tmp_path / "table"))
    logged, rows = [], []

    def arrive(epoch, *arrived):
        logged.extend(r for _, r in arrived)
        batch = spark.createDataFrame([(*r, key) for key, r in arrived], ARRIVAL_SCHEMA)
        for _ in range(repeat):
            walk.process(batch, epoch)
        rows.append(sum(spark.read.parquet(str(f)).count() for f in (tmp_path / "state").glob("arrivals/*/*/*.parquet")) + sum(spark.read.parquet(str(f)).count() for f in (tmp_path / "state").glob("kept/*/*/*.parquet")))

    for epoch, name in enumerate(names):
        mine = [(f"f{m // 6}", record(us(9, m), m, cluster=name, batchDuration=500)) for m in range(0, 12, 2)]
        arrive(epoch, *mine, ("f0", record(us(9, epoch), epoch, cluster="open", batchDuration=500)))
    assert rows[-1] <= 2 * len(names) + 6  # of 21 rows in all
    arrive(len(names), ("f1", record(us(9, 30), 30, cluster="open", batchDuration=500)))
    arrive(len(names) + 1, ("f9", record(us(9, 30), 30, cluster="open", batchDuration=500)))
    assert rows[-1] == 0
    whole = decide(frame(spark, logged[:-1]), initial(spark, **{n: 4 for n in [*names, "open"]}), [LONG]).collect()
    assert table(spark, tmp_path) == sorted((d.cluster_id, d.decision_ts, d.from_workers, d.to_workers) for d in whole)
    assert {d.cluster_id for d in whole} == {*names, "open"}


def test_state_does_not_grow_with_the_stream(spark, tmp_path):
    walk = incremental(spark, tmp_path, [LONG])
    sizes = []
    for epoch in range(8):
        part = [record(us(8) + (epoch * 60 + m) * 60_000_000, epoch * 60 + m, batchDuration=1) for m in range(0, 60, 5)]
        walk.process(frame(spark, part), epoch)
        sizes.append(sum(f.stat().st_size for f in (tmp_path / "state").rglob("*.parquet")))
    assert sorted(f.name for f in (tmp_path / "state").glob("epoch=*")) == ["epoch=6", "epoch=7"]
    assert sizes[-1] < 1.3 * sizes[4]


def test_micro_batches_leave_no_scratch_tables(spark, tmp_path, monkeypatch):
    from driverlens import session

    made = []
    fresh = session.scratch_path

    def watched(spark, label):
        made.append(fresh(spark, label))
        return made[-1]

    monkeypatch.setattr(session, "scratch_path", watched)
    walk = incremental(spark, tmp_path, [LONG])
    walk.process(frame(spark, [record(us(8, m), m, batchDuration=500) for m in (0, 2, 4)]), 0)
    walk.finish(spark, 1)
    assert table(spark, tmp_path) and made
    assert not [path for path in made if session.children(spark, path)]
