"""Bytes, lines and entries: damaged files, splits, whole runs over folders."""

from __future__ import annotations

import gzip
import json
import os

import pytest
from conftest import raw, us

from driverlens.operators import entries as E
from driverlens.plans.decide import decide_from_logs
from driverlens.sources import logs as L
from driverlens.sources.decision_table import read_decisions

HEAD = "25/11/03 09:14:00 INFO X: "


def progress(ts_us: int, batch: int, pretty: bool = False, **fields) -> str:
    document = {"id": "q1", "batchId": batch, "timestamp": raw(ts_us), **fields}
    return HEAD + E.PROGRESS_MARKER + " " + json.dumps(document, indent=2 if pretty else None)


def entries_of(content: bytes) -> list[str]:
    return list(L.file_entries(content))


TEXT = f"tail of before\n{HEAD}one\n  more\n{HEAD}two\n"
ENTRIES = ["tail of before", f"{HEAD}one\n  more", f"{HEAD}two"]


def test_gzip_is_found_by_its_magic_bytes():
    assert entries_of(gzip.compress(TEXT.encode())) == ENTRIES
    assert entries_of(TEXT.encode()) == ENTRIES
    assert entries_of(gzip.compress(TEXT[:40].encode()) + gzip.compress(TEXT[40:].encode())) == ENTRIES


def test_every_line_break_counts():
    assert entries_of(TEXT.replace("\n", "\r\n").encode()) == ENTRIES
    assert entries_of(TEXT.replace("\n", "\r").encode()) == ENTRIES


def test_bad_bytes_are_replaced():
    assert entries_of(b"\xff\xfe" + TEXT.encode())[0] == "��tail of before"


def test_empty_file_has_no_entry():
    assert entries_of(b"") == [] and entries_of(gzip.compress(b"")) == []


@pytest.mark.parametrize("keep", [0.3, 0.5, 0.9])
def test_cut_gzip_keeps_its_clean_prefix(keep):
    lines = [HEAD + os.urandom(40).hex() for _ in range(5000)]
    packed = gzip.compress("\n".join(lines).encode())
    got = entries_of(packed[: int(len(packed) * keep)])
    assert len(got) > 5000 * (keep - 0.15)
    assert got[:-1] == lines[: len(got) - 1]


def test_header_across_chunks(monkeypatch):
    for size in (1, 2, 7, 19, 40):
        monkeypatch.setattr(L, "CHUNK", size)
        assert entries_of(TEXT.encode()) == ENTRIES


def test_text_form_equals_byte_form(spark):
    texts = [TEXT, "", "no header at all", f"{HEAD}only", TEXT.replace("\n", "\r\n")]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path STRING, text STRING")
    got = E.entries_from_text(frame).orderBy("path", "entry_no").collect()
    want = [(str(i), n, e) for i, t in enumerate(texts) for n, e in enumerate(entries_of(t.encode()))]
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("split", [300, 2_000, 100_000_000])
def test_line_form_joins_entries_over_splits(spark, tmp_path, split):
    """A long entry spans several splits; another file starts with a headerless tail."""
    body = [HEAD + "start", *("\tat frame " + "x" * 50 for _ in range(60))]
    body += [progress(us(9, i % 60), i, pretty=i % 2 == 0) + "\n\tat end" for i in range(40)]
    text = "\n".join(body) + "\n"
    (tmp_path / "a.log").write_text(text)
    (tmp_path / "b.log").write_text("tail\n" + text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = E.read_lines(spark, str(tmp_path))
        got = E.entries_from_lines(lines).orderBy("path", "entry_no").collect()
        only = E.entries_from_lines(lines, progress_only=True).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = entries_of(text.encode()) + entries_of(("tail\n" + text).encode())
    assert [r.text for r in got] == want
    assert only == 80


def test_scan_reads_folders_and_keeps_progress_only(spark, tmp_path):
    folder = tmp_path / "logs" / "alpha"
    folder.mkdir(parents=True)
    (folder / "log4j-2025-11-03-09.log.gz").write_bytes(gzip.compress((TEXT + progress(us(9), 1) + "\n").encode()))
    files = L.read_log_files(spark, str(tmp_path / "logs"))
    assert L.scan_entries(files).count() == 4
    (row,) = L.scan_entries(files, progress_only=True).withColumn("cluster_id", L.cluster_of_path(E.F.col("path"))).collect()
    assert (row.entry_no, row.cluster_id) == (3, "alpha")


RULES = """
rules:
  - {name: slow, metric: batchDuration, aggregation: avg, operator: gt, threshold: 100, window_minutes: 10,
     min_batches: 3, target_workers: 8.0, cooldown_minutes: "20"}
"""


@pytest.fixture
def world(tmp_path):
    """alpha: two files that overlap in one batch; beta: one plain file named .gz; gamma lacks a file."""
    logs = tmp_path / "logs"
    noise = HEAD + "Streaming query has been idle\n\tat x"
    first = [progress(us(9, m), m, batchDuration=50 if m < 2 else 500) for m in (0, 1, 2, 3, 4)]
    second = [progress(us(9, 4), 4, pretty=True, batchDuration=500)] + [progress(us(10, m), 60 + m, batchDuration=10) for m in (0, 2, 4)]
    for cluster, name, lines, pack in (
        ("alpha", "log4j-2025-11-03-10.log.gz", second, True),
        ("alpha", "log4j-2025-11-03-09.log.gz", [noise, *first, HEAD + E.PROGRESS_MARKER + " {"], True),
        ("beta", "log4j-2025-11-03-09.log.gz", [progress(us(9, m), m, batchDuration=500) for m in (0, 2, 4)], False),
        ("gamma", "log4j-2025-11-03-09.log.gz", first, True),
        ("ghost", "log4j-2025-11-03-09.log.gz", first, True),
    ):
        (logs / cluster).mkdir(parents=True, exist_ok=True)
        data = ("\n".join(lines) + "\n").encode()
        (logs / cluster / name).write_bytes(gzip.compress(data) if pack else data)
    clusters = [("alpha", 4, 2), ("beta", 8, 1), ("gamma", 4, 2)]
    manifest = {"clusters": [{"cluster_id": c, "initial_workers": w, "num_log_files": n} for c, w, n in clusters]}
    (tmp_path / "clusters.json").write_text(json.dumps(manifest, indent=2))
    (tmp_path / "rules.yaml").write_text(RULES)
    return tmp_path


def test_whole_run_from_folders(spark, world):
    table = str(world / "table")
    run = lambda: decide_from_logs(
        spark, str(world / "logs"), str(world / "clusters.json"), str(world / "rules.yaml"), table
    ).collect()
    expected = [("alpha", raw(us(9, 2)), "slow", 4, 8)]
    assert [tuple(r) for r in run()] == expected
    assert [tuple(r) for r in run()] == expected  # a second run overwrites, it does not add
    assert read_decisions(spark, table).count() == 1


def test_whole_run_from_plain_lines(spark, world, tmp_path):
    """The same folders unpacked, read as lines."""
    plain = tmp_path / "plain"
    for file in (world / "logs").rglob("*.gz"):
        data = file.read_bytes()
        target = plain / file.parent.name / file.name.removesuffix(".gz")
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(gzip.decompress(data) if data.startswith(b"\x1f\x8b") else data)
    made = decide_from_logs(spark, str(plain), str(world / "clusters.json"), str(world / "rules.yaml"), as_lines=True)
    assert [(d.cluster_id, d.decision_ts) for d in made.collect()] == [("alpha", raw(us(9, 2)))]


def test_only_complete_known_clusters_are_opened(spark, world, monkeypatch):
    from driverlens.plans import decide as plan

    opened = []
    read = plan.read_log_files

    def watched(spark, path):
        if isinstance(path, list):
            opened.extend(path)
        return read(spark, path)

    monkeypatch.setattr(plan, "read_log_files", watched)
    decide_from_logs(spark, str(world / "logs"), str(world / "clusters.json"), str(world / "rules.yaml")).collect()
    assert sorted(p.rsplit("/", 1)[1] for p in opened) == ["alpha", "beta"]


def test_no_complete_cluster_no_decisions(spark, world):
    none = {"clusters": [{"cluster_id": "gamma", "initial_workers": 4, "num_log_files": 9}]}
    (world / "clusters.json").write_text(json.dumps(none))
    paths = [str(world / n) for n in ("logs", "clusters.json", "rules.yaml", "table")]
    assert decide_from_logs(spark, *paths).collect() == []
