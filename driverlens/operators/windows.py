"""Sliding event-time windows ``(T - w, T]`` with one aggregate per rule.

Every record is an evaluation point, and the verdict depends on its time alone: records
sharing ``T`` see the same window. So the work is done on *ticks*, one row per cluster and
distinct time, and the cost does not depend on how many records pile up on one key:

1. records are folded into ticks (map-side combined);
2. rule windows are whole minutes, so ``(T - w, T]`` splits into the part of T's own minute
   up to T, ``w - 1`` whole minutes, and the part of minute ``m - w`` after ``T - w``. The
   first and last are running aggregates inside one minute, the middle runs over one row
   per minute. No frame is ever re-aggregated: every frame starts at the edge of its partition and only
   grows, so a row costs the same however wide the window is. Counts and sums are differences of two
   running sums; a maximum is that of a running one from the left and one from the right inside
   runs as long as the window, of which it meets two at most. The units of work are one
   ``(cluster, minute)`` and one ``(cluster, nine widest windows)`` of minute rows, so a cluster
   holding a third of the data spreads over all tasks;
3. the parts meet again at the tick, joined by their keys only.

Averages are exact up to one last rounding, for any finite doubles in any order: a sum is kept as
whole numbers, one per *limb* of ``LIMB`` bits of the range of doubles. Only limbs that some value reaches are
columns; a table of ticks has the columns for ``TYPICAL`` values, or for those that are there (see ``plans.store_ticks``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driverlens.functions.timegrid import MINUTE_US, minute_of
from driverlens.operators.rules import Rule

TICK_KEY = ["cluster_id", "ts_us"]
VERDICT = (
    "struct<rule_ord:int,rule_name:string,holds:boolean,records_in_window:bigint,records_with_metric:bigint,aggregate:double>"
)
LIMB = 24  # bits; a sum of 2^39 values still fits a long
LOWEST = -1074  # exponent of the smallest double, where limb 0 begins
TYPICAL = frozenset(range(41, 47))  # limbs of values between 1e-10 and 1e15
HALF = 44  # limbs told by one mask
SMALL = 44  # the limb that begins at 2^-18: with the next two it holds whole numbers of usual size
BLOCK_WIDTHS = 8  # widest windows in a block of minutes
FOLDS = {"count": F.sum, "limb": F.sum, "max": F.max, "min": F.min}


def _power(exponent: int) -> float:
    return 2.0**exponent


def _limb(value: Column, limb: int) -> Column:
    """The bits of a double from ``2^place`` on, as a signed whole number below ``2^LIMB``."""
    place = LOWEST + LIMB * limb
    half = -place // 2  # two steps, as 2^1074 is no double
    scaled = value * F.lit(_power(half)) * F.lit(_power(-place - half))
    below = F.abs(value) < F.lit(_power(min(place + LIMB + 53, 1023))) if place + LIMB + 53 <= 1023 else F.lit(True)
    return F.when(below, (scaled % F.lit(_power(LIMB))).cast("bigint")).otherwise(F.when(value.isNotNull(), F.lit(0).cast("bigint")))


def _masks(value: Column) -> tuple[Column, Column]:
    """Which limb a value begins in, as a bit of one of two masks; it ends three limbs later at most."""
    begin = F.floor((F.floor(F.log2(F.abs(value))) - (53 + LOWEST)) / LIMB)
    begin = F.when(value != 0, F.greatest(begin, F.lit(0)).cast("int"))
    one = F.lit(1).cast("bigint")
    return (
        F.when(begin < HALF, F.call_function("shiftleft", one, begin)),
        F.when(begin >= HALF, F.call_function("shiftleft", one, begin - HALF)),
    )


def limbs_seen(records: DataFrame, rules: list[Rule]) -> list[Column]:
    """Aggregates over records that ``limbs_of`` turns into the set of limbs their averages need."""
    pairs = [_masks(F.col("metrics")[m]) for m in sorted({r.metric for r in rules if r.aggregation == "avg"})]
    none = F.lit(0).cast("bigint")
    return [F.bit_or(_ored([F.coalesce(p[i], none) for p in pairs])).alias(f"limbs{i}") for i in (0, 1)] if pairs else []


def _ored(columns: list[Column]) -> Column:
    out = columns[0]
    for column in columns[1:]:
        out = out.bitwiseOR(column)
    return out


def limbs_of(low: int | None, high: int | None) -> frozenset[int]:
    begins = [i for i in range(HALF) if (low or 0) >> i & 1] + [i + HALF for i in range(HALF) if (high or 0) >> i & 1]
    return frozenset(limb for b in begins for limb in range(b, b + 4))


def average(limbs: dict[int, Column], count: Column) -> Column:
    """Fold sums of limbs into one double and divide it.

    Carries go up first, so every limb is a digit; a negative sum is folded as the opposite of a
    positive one. A sum that may exceed the largest double is folded at a smaller scale.
    """
    none = F.lit(0).cast("bigint")
    places = range(min(limbs), max(limbs) + 3)  # sums of top limbs carry over two more
    sums = F.array(*[F.coalesce(limbs[i], none) if i in limbs else none for i in places])

    def folded(shift: int) -> Column:
        exponents = [LOWEST + LIMB * i - shift for i in places]
        weights = F.array(*[F.lit(_power(e) if -1074 <= e <= 1000 else 0.0) for e in exponents])
        rows = F.arrays_zip(sums.alias("sum"), weights.alias("weight"))

        def signed(sign: int) -> Column:
            def add(state, row):
                here = row["sum"] * sign + state["carry"]
                digit = here.bitwiseAND(F.lit((1 << LIMB) - 1).cast("bigint"))
                total = state["total"] + digit.cast("double") * row["weight"]
                return F.struct(F.shiftright(here, LIMB).alias("carry"), total.alias("total"))

            return F.aggregate(rows, F.struct(none.alias("carry"), F.lit(0.0).alias("total")), add)

        return F.when(signed(1)["carry"] >= 0, signed(1)["total"]).otherwise(-signed(-1)["total"])

    small_sum, is_small = _small_sum({i: F.coalesce(limbs[i], none) for i in limbs})
    plain = F.try_divide(F.when(is_small, small_sum).otherwise(folded(0)), count)
    if LOWEST + LIMB * (max(limbs) + 3) <= 1000:
        return plain
    small = F.try_divide(folded(128), count)
    return F.when(F.abs(small) < F.lit(_power(300)), plain).otherwise(small * F.lit(_power(128)))


def _small_sum(limbs: dict[int, Column]) -> tuple[Column, Column]:
    """The sum as a double if it is below 2^35 and a multiple of 2^-18, and whether it is.

    It is a whole number below 2^53 of that unit then, so the double is exact without any carry.
    """
    bounds = {SMALL: 1 << 52, SMALL + 1: 1 << 28, SMALL + 2: 1 << 4}
    fits = [c.between(-bounds.get(i, 0), bounds.get(i, 0)) for i, c in limbs.items()]
    units = none = F.lit(0).cast("bigint")
    for i, bound in bounds.items():
        if i in limbs:  # cut to its bound, so that no sum overflows where the result is not used
            here = F.when(limbs[i].between(-bound, bound), limbs[i]).otherwise(none)
            units = units + here * F.lit(1 << LIMB * (i - SMALL)).cast("bigint")
    fits.append(units.between(-(1 << 53), 1 << 53))
    return units.cast("double") * F.lit(_power(LOWEST + LIMB * SMALL)), reduce(Column.__and__, fits)


@dataclass(frozen=True)
class Part:
    """One partial aggregate: ``records`` in the window, or a metric's count, limb of its sum, max, min or last."""

    kind: str
    metric: str | None = None
    name: str = "records"
    limb: int = 0

    def over(self, spec, newest_first: bool = False) -> Column:
        column = F.col(self.name)
        if self.kind == "last":
            pick = F.first if newest_first else F.last
            return pick(column, ignorenulls=True).over(spec)
        return FOLDS[self.kind](column).over(spec)

    def of_records(self) -> Column:
        if self.metric is None:
            return F.count("*")
        value = F.col("metrics")[self.metric]
        if self.kind == "last":
            return F.max_by(value, F.when(value.isNotNull(), F.struct("batch_id", "id")))
        if self.kind == "limb":
            return F.sum(_limb(value, self.limb))
        return {"count": F.count, "max": F.max, "min": F.min}[self.kind](value)

    def of_minute(self) -> Column:
        column = F.col(self.name)
        if self.kind == "last":
            return F.max_by(column, F.when(column.isNotNull(), F.col("ts_us")))
        return FOLDS[self.kind](column)

    def newer(self, newest: Column, middle: Column | None) -> Column:
        """The part of the window a tick row holds itself: its own minute and the whole ones."""
        if middle is None:
            return newest
        if self.kind == "last":
            return F.coalesce(newest, middle)
        if self.kind in ("max", "min"):
            return (F.greatest if self.kind == "max" else F.least)(newest, middle)
        zero = F.lit(0).cast("bigint")
        return F.coalesce(newest, zero) + F.coalesce(middle, zero)

    def meet(self, newer: Column, oldest: Column) -> Column:
        """Fold a tick's row and its probe's row, each NULL on the other's row."""
        if self.kind == "last":
            return F.coalesce(F.max(newer), F.max(oldest))
        return FOLDS[self.kind](F.coalesce(newer, oldest))


RECORDS = Part("count")


def _parts(rules: list[Rule], limbs: frozenset[int]) -> list[Part]:
    metrics = sorted({r.metric for r in rules})
    parts = {RECORDS: None}
    for rule in rules:
        i = metrics.index(rule.metric)
        parts[Part("count", rule.metric, f"m{i}_count")] = None
        if rule.aggregation == "avg":
            parts |= {Part("limb", rule.metric, f"m{i}_limb{limb}", limb): None for limb in sorted(limbs)}
        else:
            parts[Part(rule.aggregation, rule.metric, f"m{i}_{rule.aggregation}")] = None
    return list(parts)


def _limbs_in(tick_table: DataFrame) -> frozenset[int]:
    """Limbs that a table of ticks has columns for."""
    return frozenset(int(n.rpartition("_limb")[2]) for n in tick_table.columns if "_limb" in n)


def _rule_parts(rule: Rule, parts: list[Part]) -> list[Part]:
    wanted = ("count", "limb" if rule.aggregation == "avg" else rule.aggregation)
    return [RECORDS, *(p for p in parts if p.metric == rule.metric and p.kind in wanted)]


def ticks(records: DataFrame, rules: list[Rule], limbs: frozenset[int] | None = None) -> DataFrame:
    """One row per cluster and distinct time: partial aggregates and the first record there.

    ``is_point`` (optional, default true) marks records to evaluate; others are look-back. Without
    ``limbs``, a pass over the records finds out which ones averages need.
    """
    if limbs is None:
        seen = limbs_seen(records, rules)
        limbs = (limbs_of(*records.agg(*seen).first()) or TYPICAL) if seen else frozenset()
    if "is_point" not in records.columns:
        records = records.withColumn("is_point", F.lit(True))
    return records.groupBy(*TICK_KEY).agg(
        F.count_if("is_point").alias("points"),
        F.min(F.when(F.col("is_point"), F.struct("batch_id", "id", "ts_raw"))).alias("first"),
        *[p.of_records().alias(p.name) for p in _parts(rules, limbs)],
    )


def evaluate(tick_table: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per evaluation tick an array ``verdicts``, one per rule in file order:
    ``rule_ord, rule_name, holds, records_in_window, records_with_metric, aggregate``.

    ``tick_table`` is read twice, so hand in a stored table (see ``plans.store_ticks``).
    """
    if not rules:  # no rule, no verdict
        return tick_table.filter(F.col("points") > 0).select(*TICK_KEY, F.lit(None).cast(f"array<{VERDICT}>").alias("verdicts"))
    parts = _parts(rules, _limbs_in(tick_table))
    names = [p.name for p in parts]
    widths = sorted({r.window_minutes for r in rules})

    # One row for the tick itself (shift 0) and one empty probe per window width at T - w.
    shifts = F.when(F.col("points") > 0, F.array(*[F.lit(w).cast("bigint") for w in (0, *widths)])).otherwise(F.array(F.lit(0).cast("bigint")))
    placed = (
        tick_table.select(*TICK_KEY, "points", *names, F.explode(shifts).alias("shift"))
        .withColumn("at", F.col("ts_us") - F.col("shift") * MINUTE_US)
        .withColumn("minute", minute_of(F.col("at")))
        .withColumns({n: F.when(F.col("shift") == 0, F.col(n)) for n in names})
    )
    within = W.partitionBy("cluster_id", "minute")
    up_to = within.orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    after = within.orderBy(-F.col("at")).rangeBetween(W.unboundedPreceding, -1)
    edges = placed.select(
        *TICK_KEY,
        "minute",
        "shift",
        "points",
        *[p.over(up_to).alias(f"newest_{p.name}") for p in parts],
        *[p.over(after, newest_first=True).alias(f"oldest_{p.name}") for p in parts],
    ).filter((F.col("shift") == 0) | F.col("oldest_records").isNotNull())  # a probe that met nothing has nothing to add

    # Whole minutes in between: one row per cluster and active minute, whatever the load. Blocks
    # of a few widest windows, each with the end of the block before it as look-back, keep a long
    # history from being one task's work.
    span = BLOCK_WIDTHS * max(widths)
    own = F.floor(F.col("minute") / span)
    looked_back_at = F.pmod(F.col("minute"), F.lit(span)) >= span - max(widths)
    minutes = (
        tick_table.withColumn("minute", minute_of(F.col("ts_us")))
        .groupBy("cluster_id", "minute")
        .agg(*[p.of_minute().alias(p.name) for p in parts])
        .withColumn("own", own)
        .select("*", F.explode(F.when(looked_back_at, F.array("own", F.col("own") + 1)).otherwise(F.array("own"))).alias("block"))
    )
    middle = _whole_minutes(minutes, {w: _needed(rules, w, parts) for w in widths if w > 1})

    # Bring the parts back to the tick: its row (shift 0) and its probes (shift w) fold into one.
    at_tick = F.col("shift") == 0
    totals = []
    for w in widths:
        for p in _needed(rules, w, parts):
            middle_part = F.col(f"middle{w}_{p.name}") if w > 1 else None
            newer = F.when(at_tick, p.newer(F.col(f"newest_{p.name}"), middle_part))
            oldest = F.when(F.col("shift") == w, F.col(f"oldest_{p.name}"))
            totals.append(p.meet(newer, oldest).alias(f"w{w}_{p.name}"))
    met = (
        edges.join(middle, ["cluster_id", "minute"], "left")
        .groupBy(*TICK_KEY)
        .agg(F.max("points").alias("points"), *totals)
        .filter(F.col("points") > 0)
    )
    verdicts = F.array(*[_verdict(i, r, parts) for i, r in enumerate(rules, 1)])
    return met.select(*TICK_KEY, verdicts.alias("verdicts"))


def _whole_minutes(minutes: DataFrame, needed: dict[int, list[Part]]) -> DataFrame:
    """Per cluster and active minute ``m``, for every width ``w``: the aggregates of minutes ``m - w + 1`` to ``m - 1``.

    ``minutes`` has every row in its ``own`` block, and rows that windows of the next block reach in that too.
    All frames run over two orders of a block, by minute and backwards. An extreme of a run of ``w - 1`` minutes is
    that of pairs (run, value), as the run a frame ends in comes last in its order.
    """
    block = W.partitionBy("cluster_id", "block")
    forward = block.orderBy("minute")
    up_to = forward.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = forward.rowsBetween(W.unboundedPreceding, -1)
    backward = block.orderBy(F.desc("minute")).rowsBetween(W.unboundedPreceding, W.currentRow)
    minute = F.col("minute")
    none = F.lit(0).cast("bigint")
    aheads, runs, lefts, columns = {}, {}, {}, []
    for w, parts in needed.items():
        left_of = forward.rangeBetween(W.unboundedPreceding, -w)
        size = w - 1
        run = F.floor(minute / size)
        left, at_left = F.col(f"left{w}"), []
        for p in parts:
            name, value = f"middle{w}_{p.name}", F.col(p.name)
            if p.kind in ("count", "limb"):
                runs[f"run_{p.name}"] = F.sum(F.coalesce(value, none)).over(up_to)
                at_left.append(f"run_{p.name}")
                made = F.col(f"run_{p.name}") - F.coalesce(value, none) - F.coalesce(left[f"run_{p.name}"], none)
            elif p.kind == "last":
                newest = F.col(f"newest_{name}")
                runs[f"newest_{name}"] = F.last(F.when(value.isNotNull(), F.struct(minute.alias("at"), value.alias("value"))), ignorenulls=True).over(before)
                made = F.when(newest["at"] > minute - w, newest["value"])
            else:
                fold, ahead, back = FOLDS[p.kind], f"ahead_{name}", f"back_{name}"
                sign = 1 if p.kind == "max" else -1  # nulls lose
                of_run = lambda s: F.struct((run * s).alias("run"), (value.isNull() if sign < 0 else F.lit(True)).alias("no"), value.alias("value"))  # noqa: B023, E731
                aheads[ahead] = fold(of_run(-sign)).over(backward)["value"]
                runs[back] = fold(of_run(sign)).over(before)
                of_row = F.struct(minute.alias("at"), F.col(ahead).alias("value"))
                runs[f"next_{name}"] = F.lead(of_row, 1).over(forward)
                runs[f"first_{name}"] = F.first(of_row).over(up_to)
                at_left.append(f"next_{name}")
                # The first row from m - size on is the one after the last row before it.
                follows = F.coalesce(left[f"next_{name}"], F.col(f"first_{name}"))
                from_left = F.when((follows["at"] < minute) & (F.floor(follows["at"] / size) == F.floor((minute - size) / size)), follows["value"])
                from_right = F.when(F.col(back)["run"] * sign == F.floor((minute - 1) / size), F.col(back)["value"])
                made = (F.greatest if p.kind == "max" else F.least)(from_left, from_right)
            columns.append(made.alias(name))
        lefts[f"left{w}"] = F.last(F.struct(*at_left)).over(left_of)
    kept = minutes.withColumns(aheads) if aheads else minutes
    kept = kept.withColumns(runs).withColumns(lefts) if needed else kept
    out = kept.select("cluster_id", "minute", (F.col("block") == F.col("own")).alias("is_own"), *columns)
    return out.filter("is_own").drop("is_own")


def _needed(rules: list[Rule], width: int, parts: list[Part]) -> list[Part]:
    wanted = {p: None for r in rules if r.window_minutes == width for p in _rule_parts(r, parts)}
    return list(wanted)


def _verdict(rule_ord: int, rule: Rule, parts: list[Part]) -> Column:
    mine = {p: F.col(f"w{rule.window_minutes}_{p.name}") for p in _rule_parts(rule, parts)}
    by_kind = {p.kind: column for p, column in mine.items() if p.metric}
    with_metric = F.coalesce(by_kind["count"], F.lit(0).cast("bigint"))
    if rule.aggregation == "avg":
        value = average({p.limb: column for p, column in mine.items() if p.kind == "limb"}, with_metric)
    else:
        value = by_kind[rule.aggregation]
    aggregate = F.when(with_metric >= rule.min_batches, value)
    holds = aggregate > F.lit(rule.threshold) if rule.operator == "gt" else aggregate < F.lit(rule.threshold)
    return F.struct(
        F.lit(rule_ord).alias("rule_ord"),
        F.lit(rule.name).alias("rule_name"),
        F.coalesce(holds, F.lit(False)).alias("holds"),
        mine[RECORDS].alias("records_in_window"),
        with_metric.alias("records_with_metric"),
        aggregate.alias("aggregate"),
    )


def rule_evaluations(evaluated: DataFrame) -> DataFrame:
    """Long form: one row per evaluation tick and rule."""
    return evaluated.select(*TICK_KEY, F.inline("verdicts"))


def matched_ticks(evaluated: DataFrame) -> DataFrame:
    """Ticks at which some rule holds, with the first such rule in file order."""
    first = F.slice(F.filter("verdicts", lambda v: v["holds"]), 1, 1)
    return evaluated.select(*TICK_KEY, F.inline(first)).drop("holds", "rule_name")


def rules_not_holding_above(rules: list[Rule]) -> Column:
    """Names of the rules before the matched one; by definition none of them held."""
    return F.slice(F.array(*[F.lit(r.name) for r in rules]), 1, F.col("rule_ord") - 1)
