"""Why a matched rule did or did not fire: one nested row per matched point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driverlens.functions.timegrid import iso_utc
from driverlens.operators.rules import Rule, rules_frame
from driverlens.operators.windows import rules_not_holding_above


def decision_trace(points: DataFrame, rules: list[Rule]) -> DataFrame:
    """``points`` as ``plans.decide.decision_points`` gives them.

    Times are the records' own text; ``cooldown_until`` is computed, and written in ISO form with
    six decimals. Numbers in ``comparison`` are written as Spark writes a double.

    The rules are a handful of rows by nature, so their table is broadcast.
    """
    spark = points.sparkSession
    until = F.col("cooldown_until_us")
    has_last = F.col("last_decision_us").isNotNull()
    comparison = F.concat_ws(" ", F.col("aggregate").cast("string"), F.col("operator"), F.col("threshold").cast("string"))
    condition = F.struct(
        "metric", "aggregation", "aggregate", "operator", "threshold", comparison.alias("comparison"),
        "window_minutes", "records_in_window", "records_with_metric", "min_batches",
    )
    gates = F.struct(
        "current_workers",
        "target_workers",
        (F.col("target_workers") == F.col("current_workers")).alias("idempotent"),
        F.coalesce("last_decision_ts", iso_utc(F.col("last_decision_us"))).alias("last_decision_ts"),
        "cooldown_minutes",
        iso_utc(until, 6).alias("cooldown_until"),
        F.when(has_last, F.col("ts_us") >= until).alias("cooldown_passed"),
    )
    return points.join(F.broadcast(rules_frame(spark, rules)), "rule_ord").select(
        "cluster_id",
        F.col("ts_raw").alias("evaluation_ts"),
        "batch_id",
        F.col("rule_name").alias("rule"),
        rules_not_holding_above(rules).alias("rules_not_holding_above"),
        condition.alias("condition"),
        gates.alias("gates"),
        "outcome",
    )


def write_trace(trace: DataFrame, path: str, logged_at: Column | None = None) -> None:
    """JSON lines, one event each."""
    stamp = F.current_timestamp() if logged_at is None else logged_at
    trace.select(stamp.alias("logged_at"), "*").write.mode("overwrite").json(path)
