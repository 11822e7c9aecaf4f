"""The stateful walk: gates, chaining, slicing of hot clusters."""

from __future__ import annotations

import json
import math
import random
import sys

import pytest
import definitions
import pyarrow as pa
from conftest import frame, initial, raw, record, rule, us

from driverlens.operators import gates
from driverlens.operators.gates import point_outcomes, walk_ticks
from driverlens.operators.trace import decision_trace, write_trace
from driverlens.plans.decide import decide, decision_points, walk_records

sys.setrecursionlimit(20_000)  # definitions look back point by point
MINUTE = 60_000_000


def matched(spark, rows):
    return spark.createDataFrame(rows, "cluster_id STRING, ts_us BIGINT, rule_ord INT")


def outcomes(spark, rows, rules, workers=4, last=None, **slices):
    start = spark.createDataFrame([("c", workers, last)], "cluster_id STRING, workers BIGINT, last_us BIGINT")
    walked = walk_ticks(matched(spark, [("c", at, r) for at, r in rows]), start, rules, **slices).orderBy("ts_us").collect()
    return [(r.current_workers, r.last_decision_us, r.outcome) for r in walked]


def test_cooldown_is_inclusive_and_idempotence_comes_first(spark):
    rules = [rule(name="up", target_workers=8, cooldown_minutes=20), rule(name="down", target_workers=2, cooldown_minutes=20)]
    got = outcomes(spark, [(0, 1), (1, 1), (20 * MINUTE - 1, 2), (20 * MINUTE, 2), (30 * MINUTE, 2)], rules)
    assert got == [
        (4, None, "decision"),
        (8, 0, "blocked_idempotence"),
        (8, 0, "blocked_cooldown"),
        (8, 0, "decision"),
        (2, 20 * MINUTE, "blocked_idempotence"),
    ]


def test_cooldown_of_the_matched_rule_counts(spark):
    rules = [rule(target_workers=8, cooldown_minutes=0), rule(target_workers=2, cooldown_minutes=60)]
    got = outcomes(spark, [(0, 2), (1, 1), (2, 2), (3, 1)], rules)
    assert [g[2] for g in got] == ["decision", "decision", "blocked_cooldown", "blocked_idempotence"]


def test_no_earlier_decision_never_blocks(spark):
    assert outcomes(spark, [(0, 1)], [rule(target_workers=8, cooldown_minutes=10_000)])[0][2] == "decision"


def test_state_carried_in_from_before(spark):
    got = outcomes(spark, [(5 * MINUTE, 1), (20 * MINUTE, 1)], [rule(target_workers=8, cooldown_minutes=20)], workers=2, last=0)
    assert [g[2] for g in got] == ["blocked_cooldown", "decision"]


def patterns(chance):
    """Matched points of five kinds: rule numbers from 0, times unique."""
    bursts = sorted({day * 1440 * MINUTE + chance.randrange(3 * MINUTE): chance.choice((0, 1, 2)) for day in range(5) for _ in range(30)}.items())
    return {
        "random": [(i * 37_000_000, chance.choice((0, 1, 2))) for i in range(150)],
        "alternating": [(i * MINUTE, i % 2) for i in range(90)],
        "bursts": bursts,  # minutes of more ticks than a slice takes, and days of nothing between them
        "one rule": [(i * MINUTE, 2) for i in range(40)],
        "single": [(7, 1)],
    }


@pytest.mark.parametrize("slice_ticks,cooldowns,targets", [(4, (3, 3, 1), (8, 2, 16)), (9, (45, 20, 200), (8, 2, 16)), (40, (7, 0, 90), (8, 2, 8))])
def test_sliced_walk_by_definition(spark, slice_ticks, cooldowns, targets):
    rules = [rule(name=str(i), target_workers=t, cooldown_minutes=c) for i, (t, c) in enumerate(zip(targets, cooldowns))]
    rows, start, want = [], [], {}
    for name, points in patterns(random.Random(3)).items():
        for workers, last in ((4, None), (8, points[0][0] - 1), (2, points[-1][0])):
            cluster = f"{name} {workers}"
            rows += [(cluster, at, r + 1) for at, r in points]
            start.append((cluster, workers, last))
            want |= {(cluster, at): state for (at, _), state in zip(points, definitions.outcomes(points, rules, workers, last))}
    initial_rows = spark.createDataFrame(start, "cluster_id STRING, workers BIGINT, last_us BIGINT")
    walked = walk_ticks(matched(spark, rows), initial_rows, rules, slice_ticks=slice_ticks).collect()
    assert {(r.cluster_id, r.ts_us): (r.current_workers, r.last_decision_us, r.outcome) for r in walked} == want
    assert len(walked) == len(rows)


def test_hot_and_cold_clusters_together(spark):
    rules = [rule(name="up", target_workers=8, cooldown_minutes=2), rule(name="down", target_workers=2, cooldown_minutes=2)]
    rows = [(c, i * MINUTE, 1 + (i // n) % 2) for c, n, size in (("hot", 3, 40), ("cold", 2, 6)) for i in range(size)]
    start = initial(spark, hot=4, cold=8)
    whole = walk_ticks(matched(spark, rows), start, rules)
    sliced = walk_ticks(matched(spark, rows), start, rules, slice_ticks=5)
    assert sorted(map(tuple, sliced.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_clusters_outside_the_manifest_give_nothing(spark):
    walked = walk_ticks(matched(spark, [("ghost", 0, 1)]), initial(spark, c=4), [rule()])
    assert walked.count() == 0


# The two rules of the specification's worked example.
WORKED = [
    rule(name="A", metric="batchDuration", aggregation="avg", operator="gt", threshold=300000, window_minutes=15, min_batches=3, target_workers=8, cooldown_minutes=20),
    rule(name="B", metric="numInputRows", aggregation="max", operator="lt", threshold=1000, window_minutes=30, min_batches=5, target_workers=2, cooldown_minutes=60),
]


def load(plan):
    """Batches three minutes apart from ``(how many, duration, rows)`` stretches."""
    stretches = [(duration, rows) for many, duration, rows in plan for _ in range(many)]
    return [record(us(7) + i * 180_000_000, 500 + i, batchDuration=d, numInputRows=r) for i, (d, r) in enumerate(stretches)]


@pytest.mark.parametrize(
    "workers,plan",
    [
        (4, [(9, 220_000, 7_000), (6, 410_000, 7_000), (9, 180_000, 40)]),  # up, held, then down
        (8, [(12, 360_000, 15)]),  # the upper rule holds but is idle: the lower never gets its turn
        (8, [(5, 900, 15), (8, 900, 3)]),  # only the lower holds
        (6, [(4, 310_000, 12), (20, 5_000, 12), (8, 500_000, 900_000)]),
    ],
)
def test_two_rules_with_their_trace(spark, workers, plan):
    records = load(plan)
    want = definitions.walk(records, WORKED, workers)
    points = decision_points(frame(spark, records), initial(spark, c=workers), WORKED)
    trace = {e.batch_id: e for e in decision_trace(points, WORKED).collect()}
    assert set(trace) == {row[0] for row in want} and want
    times = {r[2]: r[3] for r in records}
    for batch, name, before, last, outcome in want:
        event = trace[batch]
        assert (event.rule, event.outcome, event.gates.current_workers) == (name, outcome, before)
        assert event.evaluation_ts == raw(times[batch])
        assert event.gates.idempotent == (event.gates.target_workers == before)
        assert event.rules_not_holding_above == ([] if name == "A" else ["A"])
        if last is None:
            assert event.gates.last_decision_ts is None and event.gates.cooldown_passed is None
        else:
            until = last + event.gates.cooldown_minutes * MINUTE
            assert event.gates.last_decision_ts == raw(last)
            assert event.gates.cooldown_until == raw(until)[:-1] + "000Z"
            assert event.gates.cooldown_passed == (times[batch] >= until)
    made = decide(frame(spark, records), initial(spark, c=workers), WORKED).collect()
    assert sorted(d.decision_ts for d in made) == [raw(times[b]) for b, *_, outcome in want if outcome == "decision"]


def test_trace_is_written_as_json_lines(spark, tmp_path):
    records = [record(us(9, m), m, batchDuration=500) for m in (0, 2, 4)]
    over = rule(name="over", metric="batchDuration", aggregation="avg", threshold=100, window_minutes=18, min_batches=3, target_workers=8, cooldown_minutes=25)
    points = decision_points(frame(spark, records), initial(spark), [over])
    write_trace(decision_trace(points, [over]), str(tmp_path / "trace"))
    (event,) = [json.loads(line) for f in (tmp_path / "trace").glob("*.json") for line in f.read_text().splitlines()]
    assert event["outcome"] == "decision" and "logged_at" in event
    assert event["condition"]["comparison"] == "500.0 gt 100.0"
    assert event["gates"]["target_workers"] == 8 and "last_decision_ts" not in event["gates"]


def test_records_without_the_metric_are_points_too(spark):
    records = [record(us(9, m), m, batchDuration=500) for m in (0, 2)] + [record(us(9, 4), 4), record(us(9, 5), 5, batchDuration=500)]
    made = decide(frame(spark, records), initial(spark), [rule(metric="batchDuration", threshold=100, min_batches=2, window_minutes=30, target_workers=8)]).collect()
    assert [d.decision_ts for d in made] == [raw(us(9, 2))]


def test_random_walks_agree_with_plain_python(spark):
    chance = random.Random(11)
    rules = [
        rule(name="a", metric="x", aggregation="last", threshold=80, window_minutes=9, min_batches=2, target_workers=16, cooldown_minutes=5),
        rule(name="b", metric="y", aggregation="avg", threshold=55, window_minutes=12, min_batches=3, target_workers=8, cooldown_minutes=9),
        rule(name="c", metric="y", aggregation="max", operator="lt", threshold=70, window_minutes=5, min_batches=2, target_workers=2, cooldown_minutes=0),
        rule(name="d", metric="x", aggregation="min", threshold=30, window_minutes=4, min_batches=2, target_workers=8, cooldown_minutes=2),
    ]
    records, expected = [], []
    for cluster in ("k1", "k2", "k3"):
        mine = []
        for batch in range(250):
            metrics = {k: chance.randrange(100) for k in "xy" if chance.random() < 0.8}
            mine.append(record(us(9) + chance.randrange(0, 9000, 11) * 1_000_000, batch, cluster=cluster, **metrics))
        mine += [r[:6] + (1, r[7]) for r in chance.sample(mine, 40)]
        chance.shuffle(mine)
        records += mine
        expected += [(cluster, *row) for row in definitions.walk(mine, rules, 4)]
    from driverlens.operators.recordset import dedup_records

    unique = dedup_records(frame(spark, records))
    run = walk_records(unique, initial(spark, k1=4, k2=4, k3=4), rules)
    names = ["a", "b", "c", "d"]
    got = [
        (p.cluster_id, p.batch_id, names[p.rule_ord - 1], p.current_workers, p.last_decision_us, p.outcome)
        for p in point_outcomes(run.walked, unique, run.ticks, rules).collect()
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert run.decisions.count() == sum(row[-1] == "decision" for row in expected) > 20


@pytest.mark.parametrize("count,alternating", [(4, True), (64, True), (16, False)])
def test_rounds_grow_with_the_logarithm_of_the_slices(spark, monkeypatch, count, alternating):
    """Whether one rule keeps holding or two that alternate never let histories merge."""
    from driverlens.operators import gates

    rounds = []
    store = gates.materialize

    def counted(df, label):
        rounds.append(label)
        return store(df, label)

    monkeypatch.setattr(gates, "materialize", counted)
    rows = [(i * MINUTE, 1 + (i % 2 if alternating else 0)) for i in range(count * 5)]
    rules = [rule(target_workers=8, cooldown_minutes=3), rule(target_workers=2, cooldown_minutes=3)]
    got = outcomes(spark, rows, rules, slice_ticks=5)
    assert got == definitions.outcomes([(at, r - 1) for at, r in rows], rules, 4)
    assert rounds.count("path") - 1 <= math.log2(count) + 2


def test_small_clusters_are_walked_at_once(spark, monkeypatch):
    from driverlens.operators import gates

    monkeypatch.setattr(gates, "_entries", lambda *_: pytest.fail("one slice has nothing to link"))
    assert [o[2] for o in outcomes(spark, [(0, 1), (1, 1)], [rule(target_workers=8)])] == ["decision", "blocked_idempotence"]


def test_no_rules_no_decisions(spark):
    records = [record(us(9, m), m, batchDuration=500) for m in (0, 2, 4)]
    assert decide(frame(spark, records), initial(spark), []).collect() == []


@pytest.mark.parametrize("span", [50 * MINUTE, 1 << 52])
def test_small_slices_are_walked_together(span):
    """The same exits as slice by slice, in few batches; long slices still fit a line of whole numbers."""
    chance = random.Random(span)
    rules = [rule(name=str(i), target_workers=t, cooldown_minutes=c) for i, (t, c) in enumerate(((8, 0), (2, 7), (8, 30)))]
    walker = gates._SliceWalker(rules)
    slices = [(f"c{k // 9}", k % 9, sorted(chance.sample(range(span), chance.randrange(1, 9)))) for k in range(900)]
    batch = lambda some: pa.RecordBatch.from_pylist([
        {"cluster_id": c, "slice": s, "ts_us": t, "rule_ord": 1 + t % 3} for c, s, ts in some for t in ts
    ])
    out = list(walker.exits(iter([batch(slices)])))
    assert len(out) <= (1 if span < 1 << 40 else 90)
    alone = [row for one in slices for found in walker.exits(iter([batch([one])])) for row in found.to_pylist()]
    assert [row for found in out for row in found.to_pylist()] == alone
    for _, _, ts in slices[:50]:  # a walk that decides at the first tick, by definition
        made = definitions.outcomes([(t, t % 3) for t in ts], rules, -1)
        last = [i for i, (*_, what) in enumerate(made) if what == "decision"][-1]
        assert next(r for r in alone if r["ts_us"] == ts[0])["exit_us"] == ts[last]
