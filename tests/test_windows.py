"""Window edges and aggregates, one test per sentence of the semantics; every test says its own rule."""

from __future__ import annotations

import math
import random
import time
from fractions import Fraction

import pytest
from conftest import frame, record, rule, us
from definitions import MINUTE, window

from driverlens.operators.windows import TYPICAL, evaluate, matched_ticks, rule_evaluations, rules_not_holding_above, ticks
from driverlens.plans.decide import store_ticks


def verdicts(spark, records, *rules):
    rules = list(rules)
    rows = rule_evaluations(evaluate(ticks(frame(spark, records), rules), rules)).collect()
    return {(r.ts_us, r.rule_name): r for r in rows}


def load(aggregation="avg", window=21, least=1, limit=0.5, operator="gt", name="r", metric="m"):
    return rule(name=name, metric=metric, aggregation=aggregation, window_minutes=window, min_batches=least, threshold=limit, operator=operator, target_workers=6, cooldown_minutes=11)


def test_a_window_is_open_on_the_left_and_closed_on_the_right(spark):
    edge = us(5, 21)
    records = [record(us(5), 1, m=1), record(us(5, 0, 1), 2, m=1), record(edge, 3, m=1), record(edge + 1, 4, m=1)]
    row = verdicts(spark, records, load())[(edge, "r")]
    assert (row.records_in_window, row.records_with_metric) == (2, 2)


def test_records_of_one_time_see_each_other(spark):
    rows = verdicts(spark, [record(us(3), b, m=b) for b in (7, 8, 9)], load("last"))
    assert [(r.records_in_window, r.aggregate) for r in rows.values()] == [(3, 9.0)]


def test_too_few_records_with_the_metric(spark):
    records = [record(us(4, 10), 1, m=70), record(us(4, 11), 2), record(us(4, 13), 3, m=70)]
    row = verdicts(spark, records, load(least=3))[(us(4, 13), "r")]
    assert (row.holds, row.records_in_window, row.records_with_metric, row.aggregate) == (False, 3, 2, None)


@pytest.mark.parametrize("aggregation,expected", [("avg", 4.0), ("max", 9.0), ("min", -3.0), ("last", 6.0)])
def test_aggregations(spark, aggregation, expected):
    records = [record(us(2, 5 * i), i, m=v) for i, v in enumerate((9, -3, 6))] + [record(us(2, 12), 3)]
    row = verdicts(spark, records, load(aggregation))[(us(2, 12), "r")]
    assert row.aggregate == expected


@pytest.mark.parametrize("operator,value,holds", [("gt", 3, False), ("gt", 3.25, True), ("lt", 3, False), ("lt", 2.75, True)])
def test_comparisons_are_strict(spark, operator, value, holds):
    row = verdicts(spark, [record(us(6), 1, m=value)], load(limit=3, operator=operator))[(us(6), "r")]
    assert row.holds is holds


def test_one_minute_window_has_no_whole_minutes(spark):
    times = [us(1, 0, i * 25_000_000) for i in range(6)]
    row = verdicts(spark, [record(at, i, m=1) for i, at in enumerate(times)], load(window=1))
    assert [row[at, "r"].records_in_window for at in times] == [1, 2, 3, 3, 3, 3]


def test_first_rule_in_order_matches_and_shadows(spark):
    upper, lower = load(name="upper", limit=90), load(name="lower", limit=2)
    records = [record(us(8, 3 * i), i, m=v) for i, v in enumerate((40, 40, 400, 400))]
    matched = matched_ticks(evaluate(ticks(frame(spark, records), [upper, lower]), [upper, lower]))
    rows = matched.withColumn("above", rules_not_holding_above([upper, lower])).orderBy("ts_us").collect()
    assert [(r.rule_ord, r.above) for r in rows] == [(2, ["upper"]), (2, ["upper"]), (1, []), (1, [])]


@pytest.mark.parametrize("seed,minutes", [(5, 60), (6, 900)])
def test_random_records_agree_with_the_definition(spark, seed, minutes):
    """Dense and sparse minutes; widths whose blocks begin anywhere in the history."""
    chance = random.Random(seed)
    rules = [
        load(a, w, n, 50, o, f"{a}{w}", m)
        for a, w, m, n, o in (
            ("avg", 7, "x", 2, "gt"), ("max", 3, "y", 1, "lt"), ("min", 1, "x", 1, "gt"), ("last", 11, "y", 3, "gt"),
            ("last", 2, "x", 1, "lt"), ("max", 2, "x", 1, "gt"), ("min", 16, "y", 1, "lt"), ("max", 45, "x", 1, "gt"), ("avg", 33, "y", 1, "lt"),
        )
    ]
    records = []
    for batch in range(300):
        metrics = {k: chance.randrange(-100, 100) / 4 for k in "xy" if chance.random() < 0.7}
        records.append(record(us(9) + chance.randrange(0, minutes * 60, 7) * 1_000_000 + chance.choice((0, 0, 1)), batch, **metrics))
    got = verdicts(spark, records, *rules)
    assert len(got) == len({r[3] for r in records}) * len(rules)
    for (at, name), row in got.items():
        checked = next(r for r in rules if r.name == name)
        assert (row.holds, row.records_in_window, row.records_with_metric, row.aggregate) == window(checked, records, at), name


EXTREMES = {
    "tiny": [3e-16] * 3,
    "tinier": [1.23456789e-14] * 3,
    "huge": [1e39] * 3,
    "crash": [9e37] * 3,
    "largest": [1.7e308] * 3,
    "smallest": [5e-324, 5e-324, 1e-323],
    "cancel": [1e300, 1.0, -1e300, 2.5],
    "negative": [-1e-20, -3.5, -7e25],
    "mixed": [1e-300, 1e300, 1e-5, -1e12],
    "zero": [0.0, -0.0, 0.0],
    "nines": [0.1, 0.2, 0.3, -0.6],
}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_averages_of_any_values_in_any_order(spark, parts):
    records = []
    for name, values in EXTREMES.items():
        records += [record(us(9, i), i, cluster=name, m=v) for i, v in enumerate(values)]
    random.Random(parts).shuffle(records)
    rows = evaluate(store_ticks(frame(spark, records).repartition(parts), [load(limit=0)]), [load(limit=0)]).collect()
    for name, values in EXTREMES.items():
        last = max((r for r in rows if r.cluster_id == name), key=lambda r: r.ts_us).verdicts[0]
        exact = sum(map(Fraction, values)) / len(values)
        assert last.aggregate == pytest.approx(float(exact), rel=4e-16, abs=0), name
        assert last.records_with_metric == len(values) and last.holds == (exact > 0)


def test_averages_of_fractions_do_not_depend_on_the_partitions(spark):
    chance = random.Random(5)
    records = [record(us(9) + i * 1_000_000, i, rate=chance.random() / 3 * 10 ** chance.randrange(-3, 6)) for i in range(3000)]
    rules = [load(metric="rate", window=30)]
    seen = set()
    for parts in (1, 3, 7):
        table = ticks(frame(spark, records).repartition(parts), rules)
        rows = evaluate(table, rules).selectExpr("ts_us", "verdicts[0].aggregate AS a").collect()
        seen.add(tuple(sorted((r.ts_us, r.a.hex()) for r in rows)))
    assert len(seen) == 1
    at, last = max((r.ts_us, r.a) for r in rows)
    exact = sum(Fraction(r[5]["rate"]) for r in records if at - 30 * MINUTE < r[3] <= at)
    count = sum(at - 30 * MINUTE < r[3] <= at for r in records)
    assert last == pytest.approx(float(exact / count), rel=4e-16)


def test_only_limbs_that_occur_are_columns(spark):
    usual = store_ticks(frame(spark, [record(us(9), 1, m=5.5), record(us(9), 2, m=120000)]), [load()])
    assert {n for n in usual.columns if "limb" in n} == {f"m0_limb{i}" for i in TYPICAL}
    odd = store_ticks(frame(spark, [record(us(9), 1, m=5e-200)]), [load()])
    assert len([n for n in odd.columns if "limb" in n]) == 4
    assert store_ticks(frame(spark, []), [load()]).count() == 0


def test_wide_windows_cost_no_more_than_narrow_ones(spark):
    """A minute of history costs the same whatever the width: no frame is re-aggregated."""
    records = spark.range(40_000).selectExpr(
        "'c' AS cluster_id", "'q' AS id", "id AS batch_id", f"id * {MINUTE} AS ts_us", "'' AS ts_raw",
        "map('m', CAST(id % 1000 AS DOUBLE)) AS metrics", "0 AS file_ord", "id AS entry_no",
    )
    took = {}
    for width in (60, 60, 7200):  # the first is a warm-up
        checked = [load(a, width, name=a) for a in ("max", "min", "avg")]
        table = store_ticks(records, checked)
        begin = time.perf_counter()
        evaluate(table, checked).write.format("noop").mode("overwrite").save()
        took[width] = time.perf_counter() - begin
    assert took[7200] < 3 * took[60] + 2
    assert not math.isnan(took[60])


def test_whole_minutes_take_two_orders(spark):
    """Windows of three widths, extremes among them: by minute and backwards, and few rows are there twice."""
    rules = [rule(aggregation=a, window_minutes=w) for a, w in (("avg", 50), ("max", 80), ("min", 20), ("last", 30))]
    table = ticks(frame(spark, [record(us(9, i % 60) + i, i, m=i) for i in range(6)]), rules)
    made = evaluate(table, rules)
    text = made._jdf.queryExecution().sparkPlan().toString()
    assert text.count("Window [") == 2 + 3  # of ticks in a minute in both orders, of minutes: backwards, by minute, and left of each width
    orders = [line.split("], [")[2] for line in text.splitlines() if "Window [" in line and "block#" in line.split("], [")[1]]
    assert len({order.split("#")[0] + order[-12:] for order in orders}) == 2


@pytest.mark.parametrize("unit", [1, 2.0**-18, 2.0**-19])
def test_small_sums_are_exact_at_their_bounds(spark, unit):
    values = [0, 1, -1, 2**24, -(2**30), 2**34 - 1, 2**34, -(2**34), 2**35 - 1, 2**35, 2**36 + 1, -(2**52)]
    rows = [record(us(9), 10 * i + k, cluster=f"c{i}", m=x * unit if k else unit) for i, x in enumerate(values) for k in range(2)]
    rules = [rule(aggregation="avg", threshold=-1e300)]
    got = {r.cluster_id: r.verdicts[0].aggregate for r in evaluate(store_ticks(frame(spark, rows), rules), rules).collect()}
    assert got == {f"c{i}": float((Fraction(x * unit) + Fraction(unit)) / 2) for i, x in enumerate(values)}
