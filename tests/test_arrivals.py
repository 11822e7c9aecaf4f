"""The incremental runs over real log files."""

from __future__ import annotations

from conftest import raw, us
from test_logs import RULES, progress, world  # noqa: F401

from driverlens.sources.control import read_manifest, read_rules
from driverlens.session import children
from driverlens.sources.decision_table import read_decisions
from driverlens.streaming.arrivals import arrivals_of, arriving_files, records_of
from driverlens.streaming.buffered import CompleteThenWalk
from driverlens.streaming.incremental import IncrementalWalk


def test_files_in_any_order(spark, world, tmp_path):  # noqa: F811
    """alpha's second file is there first; its first one arrives with the next run."""
    rules, manifest = read_rules(spark, str(world / "rules.yaml")), read_manifest(spark, str(world / "clusters.json"))
    walk = CompleteThenWalk(rules, manifest, str(tmp_path / "state"), str(tmp_path / "out"))
    held = world / "logs" / "alpha" / "log4j-2025-11-03-09.log.gz"
    content = held.read_bytes()
    late = tmp_path / "late.bin"
    held.rename(late)
    for _ in range(2):
        stream = arrivals_of(arriving_files(spark, str(world / "logs")), rules)
        walk.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
        held.write_bytes(content)
    rows = read_decisions(spark, walk.table).collect()
    assert [(r.cluster_id, r.decision_ts) for r in rows] == [("alpha", raw(us(9, 2)))]
    last = max(int(n.removeprefix("epoch=")) for n in children(spark, f"{walk.state_dir}/done") if n.startswith("epoch="))
    done = walk._state(spark, "done", "cluster_id STRING", last).collect()
    assert sorted(r.cluster_id for r in done) == ["alpha", "beta"]  # gamma lacks a file, ghost is unknown


def test_files_in_order(spark, world, tmp_path):  # noqa: F811
    rules, manifest = read_rules(spark, str(world / "rules.yaml")), read_manifest(spark, str(world / "clusters.json"))
    walk = IncrementalWalk(rules, manifest, str(tmp_path / "state"), str(tmp_path / "out"))
    records = records_of(arriving_files(spark, str(world / "logs")), rules)
    walk.start(records, str(tmp_path / "checkpoint")).awaitTermination()
    walk.finish(spark, 1)
    rows = read_decisions(spark, walk.table).collect()
    # No completeness gate here: gamma's one file is walked too.
    assert sorted((r.cluster_id, r.decision_ts) for r in rows) == [("alpha", raw(us(9, 2))), ("gamma", raw(us(9, 2)))]
