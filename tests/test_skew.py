"""One cluster, one time and one batch that hold most of the rows."""

from __future__ import annotations

import pytest
from conftest import rule
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driverlens.operators.gates import walk_ticks
from driverlens.operators.recordset import dedup_records, record_order
from driverlens.operators.windows import evaluate, matched_ticks, rule_evaluations, ticks
from driverlens.session import materialize

ROWS = 60_000
START = 1_762_161_240_000_000
RULES = [
    rule(name="a", metric="n", aggregation="avg", threshold=600, min_batches=3, window_minutes=5, target_workers=8, cooldown_minutes=3),
    rule(name="b", metric="d", aggregation="max", operator="lt", threshold=995, min_batches=3, window_minutes=1, target_workers=2, cooldown_minutes=2),
    rule(name="c", metric="d", aggregation="last", threshold=500, min_batches=3, window_minutes=3, target_workers=16, cooldown_minutes=1),
    rule(name="d", metric="n", aggregation="min", operator="lt", threshold=300, min_batches=3, window_minutes=2, target_workers=4, cooldown_minutes=0),
]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third in one cluster at a high rate, a sixth at one time, a sixth copies of one batch."""
    i = F.col("id")
    kind = i % 6
    cluster = F.when(i % 3 == 0, "hot").when(kind == 1, "peers").when(kind == 2, "copies").otherwise(F.concat(F.lit("c"), (i % 40).cast("string")))
    at = F.lit(START) + F.when(i % 3 == 0, i * 60_000).when(kind.isin(1, 2), F.lit(0)).otherwise(F.pmod(F.xxhash64(i), F.lit(3_600_000)) * 1000)
    rows = spark.range(0, ROWS, 1, 4).select(
        cluster.alias("cluster_id"), F.lit("q").alias("id"), F.when(kind == 2, F.lit(0)).otherwise(i).alias("batch_id"),
        at.alias("ts_us"), at.cast("string").alias("ts_raw"),
        F.create_map(
            F.lit("d"), F.pmod(F.xxhash64(i, F.lit(2)), F.lit(1000)).cast("double"), F.lit("n"), ((F.floor(i / 3000) * 370) % 1000).cast("double")
        ).alias("metrics"),
        F.lit(0).alias("file_ord"), i.alias("entry_no"),
    )
    return materialize(rows, "skewed")


def test_windows_equal_a_plain_range_frame(spark, skewed):
    records = dedup_records(skewed)
    got = rule_evaluations(evaluate(ticks(records, RULES), RULES)).filter("rule_name in ('a', 'd')")
    got = got.select("cluster_id", "ts_us", "rule_name", "records_in_window", "aggregate").distinct()
    value = F.col("metrics")["n"]
    over = lambda m: W.partitionBy("cluster_id").orderBy("ts_us").rangeBetween(1 - m * 60_000_000, 0)
    plain = [
        records.select(
            "cluster_id", "ts_us", F.lit(name).alias("rule_name"), F.count("*").over(over(m)).alias("records_in_window"),
            F.when(F.count(value).over(over(m)) >= 3, fold(value).over(over(m))).alias("aggregate"),
        ).distinct()
        for name, m, fold in (("a", 5, F.avg), ("d", 2, F.min))
    ]
    # Averages of whole numbers: both sides divide the same exact sum.
    want = plain[0].unionByName(plain[1])
    assert got.count() == want.count() > 1000
    assert got.exceptAll(want).count() == 0


def test_sliced_walk_is_exact(spark, skewed):
    matched = materialize(matched_ticks(evaluate(ticks(dedup_records(skewed), RULES), RULES)), "matched")
    start = matched.select("cluster_id").distinct().select("cluster_id", F.lit(4).alias("workers"), F.lit(None).cast("bigint").alias("last_us"))
    whole = walk_ticks(matched, start, RULES)
    sliced = walk_ticks(matched, start, RULES, slice_ticks=1500)
    assert whole.filter("outcome = 'decision'").count() > 50
    assert whole.exceptAll(sliced.select(whole.columns)).count() == 0
    assert whole.count() == sliced.count()


def test_dedup_and_order(spark, skewed):
    records = dedup_records(skewed)
    assert records.filter("cluster_id = 'copies'").count() == 1
    got = record_order(records).select("cluster_id", "batch_id", "walk_ord")
    plain = F.row_number().over(W.partitionBy("cluster_id").orderBy("ts_us", "batch_id", "id")).cast("bigint")
    want = records.select("cluster_id", "batch_id", plain.alias("walk_ord"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_copies_are_folded_before_the_shuffle(spark, skewed):
    plan = dedup_records(skewed)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(cluster_id")
    assert "partial_min_by" in plan[exchange:]
