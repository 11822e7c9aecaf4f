"""Entries to records: what is accepted, what is rejected and why."""

from __future__ import annotations

import json

import pytest

from driverlens.operators import entries as E
from driverlens.operators import records as R

HEAD = "25/11/03 09:14:00 INFO ProgressReporter: "
MARK = HEAD + E.PROGRESS_MARKER + " "
DOCUMENT = {
    "id": "q1", "runId": "r", "name": "n", "timestamp": "2025-11-03T09:14:00.000Z", "batchId": 247,
    "batchDuration": 78450, "numInputRows": 152340, "inputRowsPerSecond": 1269.5,
    "durationMs": {"addBatch": 1}, "stateOperators": [],
    "sources": [{"description": "d", "metrics": {"numBytesOutstanding": "5388009472", "flag": True}}, {"metrics": {"other": "1"}}],
    "sink": {"numOutputRows": 1},
}


def judged(spark, *texts, metrics=None):
    rows = [("f", i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "path STRING, entry_no BIGINT, text STRING")
    return R.classified(frame, metrics).orderBy("entry_no").collect()


def document(**changes):
    return MARK + json.dumps({k: v for k, v in {**DOCUMENT, **changes}.items() if v != "drop"})


def test_single_line_and_pretty_printed_are_the_same(spark):
    pretty = HEAD + "x" + E.PROGRESS_MARKER + " " + json.dumps(DOCUMENT, indent=2, separators=(",", " : ")) + "\n\tat frame"
    one, two = judged(spark, document(), pretty)
    assert one.status == two.status == "record"
    assert one[3:] == two[3:]
    assert (one.id, one.batch_id, one.ts_raw) == ("q1", 247, "2025-11-03T09:14:00.000Z")
    assert one.metrics == {
        "batchDuration": 78450.0, "numInputRows": 152340.0, "inputRowsPerSecond": 1269.5,
        "source.numBytesOutstanding": 5388009472.0,
    }


def test_chosen_metrics_are_the_same_values(spark):
    (row,) = judged(spark, document(), metrics=["batchDuration", "source.numBytesOutstanding", "source.other", "missing", "id"])
    assert row.metrics == {
        "batchDuration": 78450.0, "source.numBytesOutstanding": 5388009472.0, "source.other": None, "missing": None, "id": None,
    }


@pytest.mark.parametrize(
    "text,status",
    [
        (MARK + '{"id":"q1","batchId":1,', "malformed_json"),
        (MARK + "[1,2,3]", "malformed_json"),
        (MARK + "", "malformed_json"),
        (HEAD + "Streaming query has been idle and waiting", "other"),
        (HEAD + "streaming query made progress: {}", "other"),
        (document(id="drop"), "missing_required"),
        (document(id=""), "missing_required"),
        (document(id=5), "missing_required"),
        (document(batchId="drop"), "missing_required"),
        (document(timestamp="drop"), "missing_required"),
        (document(timestamp="yesterday"), "missing_required"),
        (document() + " trailing", "record"),
        (MARK + '{"a":NaN,"id":"q","batchId":1,"timestamp":"2025-11-03T09:14:00Z"}', "record"),
    ],
)
def test_status(spark, text, status):
    assert judged(spark, text)[0].status == status


def test_batch_ids(spark):
    whole = {41: 41, 1e3: 1000, "0041": 41, "-6": -6, " 8\n": 8, 2**62: 2**62}
    not_whole = ["--6", "4 1", "1e3", "41.0", "", 0.25, False, None, {"n": 41}, [41], 2**70]
    rows = judged(spark, *[document(batchId=v) for v in [*whole, *not_whole]], metrics=[])
    assert [r.batch_id for r in rows] == [*whole.values()] + [None] * len(not_whole)


def test_timestamps_become_utc_and_stay_verbatim(spark):
    base = 1762161240000000
    # One instant: zones east and west, none, short forms, blanks and lower case around it.
    values = ["2025-11-03T03:44:00-05:30", "2025-11-03 18:14:00.0+09:00", "2025-11-03T09:14", "\t2025-11-03t09:14:00.000000z", "2025-11-03T09:14:00+00:00"]
    rows = judged(spark, *[document(timestamp=v) for v in values], metrics=[])
    assert [r.ts_us for r in rows] == [base] * 5
    assert [r.ts_raw for r in rows] == values
    bad = ["2025-02-30T00:00:00Z", "2025-11-03T09:61:00Z", "03.11.2025", "09:14", "2025-11", "\t", "", 1762161240, 2.5, None, True, ["2025-11-03"]]
    assert {r.status for r in judged(spark, *[document(timestamp=v) for v in bad], metrics=[])} == {"missing_required"}


def test_metric_values(spark):
    numbers = {"whole": 70, "text": "-3.5", "blanks": "\t.5 ", "power": "2E2", "plus": "+9"}
    others = {"flag": False, "none": None, "word": "many", "list": [1], "object": {"n": 1}, "nan": "nan", "inf": "-Infinity", "huge": "9e400", "hex": "0x10", "grouped": "1_000", "suffix": "4d", "comma": "1,5"}
    (row,) = judged(spark, MARK + json.dumps({"id": "q", "batchId": 1, "timestamp": "2025-11-03T09:14:00Z", **others, **numbers}))
    assert row.metrics == {"whole": 70.0, "text": -3.5, "blanks": 0.5, "power": 200.0, "plus": 9.0}


def test_repeated_keys_keep_the_last_and_never_fail(spark):
    text = MARK + '{"id":"x","id":"q","batchId":1,"batchId":2,"timestamp":"2025-11-03T09:14:00Z","m":1,"m":2,"source.k":9,"sources":[{"metrics":{"k":"3","k":"4"}}]}'
    (row,) = judged(spark, text)
    assert (row.id, row.batch_id, row.metrics) == ("q", 2, {"m": 2.0, "source.k": 4.0})


@pytest.mark.parametrize(
    "sources",
    [[], {}, "x", [5], [{}], [{"metrics": 5}], [{"metrics": None}], '[{"metrics":{"k":"5"}}]', [{"metrics": '{"k":"5"}'}], ['{"metrics":{"k":"5"}}'], [3, {"metrics": {"k": 5}}]],
)
def test_odd_sources_give_no_source_metrics(spark, sources):
    assert judged(spark, document(sources=sources))[0].metrics["batchDuration"] == 78450.0
    assert not any(k.startswith("source.") for k in judged(spark, document(sources=sources))[0].metrics)


def test_later_elements_of_any_shape_do_not_matter(spark):
    assert judged(spark, document(sources=[{"metrics": {"k": 5}}, 7, "x", [None]]))[0].metrics["source.k"] == 5.0


def test_stats_and_samples(spark):
    texts = [HEAD + "noise", document(), MARK + "{", document(id="drop"), document(timestamp="x")]
    frame = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "path STRING, entry_no BIGINT, text STRING")
    assert R.parse_stats(frame).collect()[0][1:] == (5, 4, 1, 1, 2)
    samples = R.skip_samples(frame, limit=2).orderBy("place").collect()
    assert [(s.entry_no, s.status) for s in samples] == [(2, "malformed_json"), (3, "missing_required")]
    assert R.rejected_records(frame).count() == 3
    assert R.progress_records(frame).count() == 1


def test_skip_samples_are_cut_before_the_shuffle(spark):
    frame = spark.createDataFrame([("f", 1, "t")], "path STRING, entry_no BIGINT, text STRING")
    plan = R.skip_samples(frame)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
