"""Threshold rules: the control-side value type and the table-level checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.functions.coercion import ascii_number

# Fixed values of the rules format.
AGGREGATIONS = ("avg", "max", "min", "last")
OPERATORS = ("gt", "lt")
TEXT_FIELDS = ("name", "metric", "aggregation", "operator")
INT_FIELDS = ("window_minutes", "min_batches", "target_workers", "cooldown_minutes")
INT_MINIMUM = {"window_minutes": 1, "min_batches": 1, "target_workers": 0, "cooldown_minutes": 0}

RULE_FIELDS = TEXT_FIELDS + ("threshold",) + INT_FIELDS
RAW_RULE_SCHEMA = "ruleset STRING, rule_ord INT, " + ", ".join(
    f"{f} STRING, {f}_type STRING" for f in RULE_FIELDS
)


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    aggregation: str
    operator: str
    threshold: float
    window_minutes: int
    min_batches: int
    target_workers: int
    cooldown_minutes: int


def raw_rule_row(ruleset: str, rule_ord: int, rule: Any) -> dict[str, Any]:
    """One YAML list item as text plus a type word per field, so Spark can judge it."""
    row: dict[str, Any] = {"ruleset": ruleset, "rule_ord": rule_ord}
    for field in RULE_FIELDS:
        value = rule.get(field) if isinstance(rule, Mapping) else None
        row[field] = None if value is None else str(value)
        row[f"{field}_type"] = None if value is None else type(value).__name__
    return row


def _is_number(field: str) -> Column:
    return F.col(f"{field}_type").isin("int", "float", "str")


def coerced_threshold() -> Column:
    return F.when(_is_number("threshold"), ascii_number(F.col("threshold")))


def coerced_int(field: str) -> Column:
    number = ascii_number(F.col(field))
    return F.when(_is_number(field) & (number == F.floor(number)), number.cast("bigint"))


def coerce_rule_numbers(raw: DataFrame) -> DataFrame:
    """Raw rules plus typed columns; what does not convert is NULL, the raw text stays."""
    return raw.select(
        "*",
        coerced_threshold().alias("threshold_value"),
        *[coerced_int(f).alias(f"{f}_value") for f in INT_FIELDS],
    )


def rule_problems(raw: DataFrame) -> DataFrame:
    """One row ``(ruleset, rule_ord, name, field, problem)`` per violation."""
    typed = coerce_rule_numbers(raw)
    checks: list[tuple[Column, str, str]] = []
    for field in TEXT_FIELDS:
        checks.append((F.coalesce(F.col(f"{field}_type") != "str", F.lit(True)), field, "must be text"))
        checks.append(((F.col(f"{field}_type") == "str") & (F.length(field) == 0), field, "must not be empty"))
    checks.append((F.col("threshold_value").isNull(), "threshold", "must be a number"))
    for field in INT_FIELDS:
        value = F.col(f"{field}_value")
        checks.append((value.isNull(), field, "must be a whole number"))
        checks.append((value < INT_MINIMUM[field], field, f"must be at least {INT_MINIMUM[field]}"))
    for field, allowed in (("aggregation", AGGREGATIONS), ("operator", OPERATORS)):
        checks.append((F.coalesce(~F.col(field).isin(*allowed), F.lit(True)), field, "must be one of " + ", ".join(allowed)))

    # Later copies of a name are the faulty ones: compare with the first position, found by a
    # plain aggregate (map-side combined) rather than a window over all copies of a name.
    first_use = (
        typed.filter(F.col("name").isNotNull())
        .groupBy("ruleset", "name")
        .agg(F.min("rule_ord").alias("first_ord"))
    )
    flagged = typed.join(first_use, ["ruleset", "name"], "left")
    checks.append((F.col("rule_ord") > F.col("first_ord"), "name", "duplicate rule name"))
    found = F.array_compact(
        F.array(
            *[
                F.when(condition, F.struct(F.lit(field).alias("field"), F.lit(text).alias("problem")))
                for condition, field, text in checks
            ]
        )
    )
    return flagged.select("ruleset", "rule_ord", "name", F.explode(found).alias("p")).select(
        "ruleset", "rule_ord", "name", "p.field", "p.problem"
    )


def validated_rules(spark: SparkSession, items: Iterable[Any]) -> list[Rule]:
    """Check one control document's rules and return them typed, in file order.

    A rules document is a handful of hand-written rows, so it is the one table that
    comes to the driver: its values become literals of the plan.
    """
    rows = [raw_rule_row("rules", i, item) for i, item in enumerate(items)]
    raw = spark.createDataFrame(rows, RAW_RULE_SCHEMA)
    problems = rule_problems(raw).orderBy("rule_ord", "field").collect()
    if problems:
        first = problems[0]
        raise ValueError(
            f"{len(problems)} problem(s) in rules; first: rule #{first.rule_ord} ({first.name}): "
            f"{first.field} {first.problem}"
        )
    typed = coerce_rule_numbers(raw).orderBy("rule_ord").collect()
    return [
        Rule(
            *[row[f] for f in TEXT_FIELDS],
            row["threshold_value"],
            *[row[f"{f}_value"] for f in INT_FIELDS],
        )
        for row in typed
    ]


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as a small table keyed by ``rule_ord`` (1-based, file order)."""
    rows = [
        (i, r.name, r.metric, r.aggregation, r.operator, float(r.threshold), r.window_minutes, r.min_batches, r.target_workers, r.cooldown_minutes)
        for i, r in enumerate(rules, 1)
    ]
    return spark.createDataFrame(
        rows,
        "rule_ord INT, rule_name STRING, metric STRING, aggregation STRING, operator STRING, threshold DOUBLE, "
        "window_minutes BIGINT, min_batches BIGINT, target_workers BIGINT, cooldown_minutes BIGINT",
    )
