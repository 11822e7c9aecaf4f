"""The stateful walk: which matched points become decisions.

State per cluster is (workers, time of the last decision). At a matched tick with rule r:
blocked if r's target equals the workers, else blocked if T < last + r's cooldown, else a
decision. Each decision changes what follows, so a walk looks sequential, but right after a
decision the state depends on that tick alone, and so does the next decision: every tick has one
successor. That makes a graph, and the walk is the path through it from the initial state.

Every cluster is cut into time slices (a small one is a single slice, walked at once). One pass
over the slices follows successors inside each, from every tick at the same time, to the last
decision that a walk through that tick makes there: the state it leaves the slice in. States that no later tick can tell
apart are one. Window functions find the tick at which each such state decides next, in whatever slice, which links
states to states. The path from the initial state is then found by pointer doubling: each round
doubles the number of decisive slices known, so rounds grow with the logarithm of their number
whatever the rules do. The states on the path are the true entry states of the slices, which are then
walked in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driverlens.functions.timegrid import MINUTE_US, minute_of
from driverlens.operators.rules import Rule
from driverlens.session import materialize

SLICE_TICKS = 250_000
EXIT_ROWS = 10_000  # ticks in a batch on the way out
LINE = 1 << 61  # microseconds of slices walked at once
NEVER = -(1 << 62)  # "no decision yet" while walking

SLICE_KEY = ["cluster_id", "slice"]
EXIT_SCHEMA = "cluster_id STRING, slice BIGINT, ts_us BIGINT, rule_ord INT, exit_workers BIGINT, exit_us BIGINT"
DAY_US = 24 * 60 * MINUTE_US
TRACE_COLUMNS = "current_workers BIGINT, last_decision_us BIGINT, cooldown_until_us BIGINT, outcome STRING"
OUTCOMES = ("decision", "blocked_idempotence", "blocked_cooldown")


class _SliceWalker:
    """Walks rows sorted by (cluster, slice, time), from decision to decision."""

    def __init__(self, rules: list[Rule]):
        self.targets = np.array([r.target_workers for r in rules], np.int64)
        self.cooldowns = np.array([r.cooldown_minutes * MINUTE_US for r in rules], np.int64)

    def trace(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, workers, last, until, made, _, _ in self._walk(batches):
            target = self.targets[_integers(batch, "rule_ord") - 1]
            outcome = np.where(made, 0, np.where(target == workers, 1, 2))
            none = last == NEVER
            fresh = [
                pa.array(workers, pa.int64()),
                pa.array(last, pa.int64(), mask=none),
                pa.array(until, pa.int64(), mask=none),
                pa.DictionaryArray.from_arrays(pa.array(outcome, pa.int8()), pa.array(OUTCOMES)).cast(pa.string()),
            ]
            kept = [n for n in batch.schema.names if n not in ("enter_workers", "enter_us")]
            names = kept + ["current_workers", "last_decision_us", "cooldown_until_us", "outcome"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *fresh], names=names)

    def exits(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per tick the state in which a walk that decides there leaves the slice."""
        for keys, ts, rule, of in self._slices_at_once(batches):
            end, target = len(ts), self.targets[rule]
            # Slices one after another on one line, each long enough that no cooldown leads into the next one.
            place = ts - ts[np.searchsorted(of, of)]
            reach = int(place.max()) + 2
            line = of * reach
            last = np.full(end, end)
            for r in np.unique(rule):
                at = np.flatnonzero(rule == r)
                over = np.minimum(np.maximum(place + self.cooldowns[r], place + 1), reach - 1)
                follower = np.append(at, end)[np.searchsorted((line + place)[at], line + over)]
                follower = np.where(np.append(of, -1)[follower] == of, follower, end)
                last = np.minimum(last, np.where(target == self.targets[r], end, follower))
            last = np.where(last == end, np.arange(end), last)
            while True:  # jump over jumps: log2(ticks) rounds
                further = last[last]
                if (further == last).all():
                    break
                last = further
            clusters, pieces = pa.array([k[0] for k in keys], pa.string()), np.array([k[1] for k in keys], np.int64)
            columns = [pieces[of], ts, rule + 1, target[last], ts[last]]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            for start in range(0, end, EXIT_ROWS):
                part = slice(start, start + EXIT_ROWS)
                arrays = [pa.array(c[part], t) for c, t in zip(columns, types)]
                names = [field.split()[0] for field in EXIT_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([clusters.take(pa.array(of[part])), *arrays], names=names)

    @classmethod
    def _slices_at_once(cls, batches: Iterator[pa.RecordBatch]):
        """Whole slices, small ones together: their keys, and per tick its time, its rule and the place of its slice's key."""
        held, rows, longest = [], 0, 0

        def together():
            keys, ts, rule = zip(*held)
            return keys, np.concatenate(ts), np.concatenate(rule), np.repeat(np.arange(len(ts)), [len(t) for t in ts])

        for cluster, piece, ts, rule in cls._whole_slices(batches):
            longest = max(longest, int(ts[-1] - ts[0]) + 2)
            if held and (rows + len(ts) > EXIT_ROWS or longest * (len(held) + 1) > LINE):
                yield together()
                held, rows, longest = [], 0, int(ts[-1] - ts[0]) + 2
            held.append(((cluster, piece), ts, rule))
            rows += len(ts)
        if held:
            yield together()

    @staticmethod
    def _whole_slices(batches: Iterator[pa.RecordBatch]):
        """The ticks of one slice after another, from sorted batches."""
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            clusters, pieces = batch.column("cluster_id"), _integers(batch, "slice")
            ts, rule = _integers(batch, "ts_us"), _integers(batch, "rule_ord") - 1
            codes = clusters.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(pieces) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                here = (clusters[int(a)].as_py(), int(pieces[a]))
                if here != key and held:
                    yield (*key, *map(np.concatenate, zip(*held)))
                    held = []
                key = here
                held.append((ts[a:b], rule[a:b]))
        if held:
            yield (*key, *map(np.concatenate, zip(*held)))

    def _walk(self, batches: Iterator[pa.RecordBatch]):
        """Per batch: state before each tick, which ticks decide, where slices start, and the state each ends in."""
        key, workers, last = None, None, NEVER
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ts, rule = _integers(batch, "ts_us"), _integers(batch, "rule_ord") - 1
            target, cooldown = self.targets[rule], self.cooldowns[rule]
            clusters, pieces = batch.column("cluster_id"), _integers(batch, "slice")
            codes = clusters.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero((np.diff(codes) != 0) | (np.diff(pieces) != 0)) + 1])
            before_workers, before_last, made, ends = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, bool), []
            for k, start in enumerate(starts):
                end = starts[k + 1] if k + 1 < len(starts) else n
                here = (clusters[int(start)].as_py(), int(pieces[start]))
                if here != key:
                    entered = batch.column("enter_us")[int(start)].as_py()
                    key, workers, last = here, batch.column("enter_workers")[int(start)].as_py(), NEVER if entered is None else entered
                at = start
                while at < end:
                    next_at = self._next(ts, target, cooldown, int(at), int(end), workers, last)
                    before_workers[at : next_at + 1], before_last[at : next_at + 1] = workers, last
                    if next_at < end:
                        made[next_at] = True
                        workers, last = int(target[next_at]), int(ts[next_at])
                    at = next_at + 1
                ends.append((workers, None if last == NEVER else last))
            yield batch, before_workers, before_last, before_last + cooldown, made, starts, ends

    @staticmethod
    def _next(ts, target, cooldown, at: int, end: int, workers: int, last: int) -> int:
        """The first tick that decides, looked for in blocks that grow; ``end`` if none does."""
        size = 64
        while at < end:
            stop = min(end, at + size)
            free = (target[at:stop] != workers) & (ts[at:stop] - cooldown[at:stop] >= last)
            if free.any():
                return at + int(free.argmax())
            at, size = stop, size * 4
        return end


def _integers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _sorted_slices(ticks: DataFrame, enter: DataFrame, keys: list[str]) -> DataFrame:
    """Ticks with the state their slice is entered in, one slice after another per task.

    The repartitioning comes last on purpose: a skewed join may be split over several tasks,
    and nothing between here and the walk may tear a slice apart.
    """
    return (
        ticks.join(enter, keys)
        .repartition(*SLICE_KEY)
        .sortWithinPartitions(*SLICE_KEY, "ts_us")
    )


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def walk_ticks(matched: DataFrame, initial: DataFrame, rules: list[Rule], slice_ticks: int = SLICE_TICKS) -> DataFrame:
    """Matched ticks plus the state before each and its ``outcome``.

    ``matched`` has ``cluster_id, ts_us, rule_ord`` (and more); ``initial`` one row per
    cluster: ``cluster_id, workers, last_us``. Clusters absent from ``initial`` are dropped.
    """
    start = initial.select("cluster_id", F.col("workers").cast("bigint").alias("enter_workers"), F.col("last_us").alias("enter_us"))
    walker = _SliceWalker(rules)
    stored = materialize(matched, "matched")
    largest = stored.groupBy("cluster_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= slice_ticks:  # a slice a cluster: nothing to link
        return _traced(_sorted_slices(stored.withColumn("slice", F.lit(0).cast("bigint")), start, ["cluster_id"]), walker)
    slices = materialize(_sliced(stored, slice_ticks), "sliced")
    return _traced(_sorted_slices(slices, _entries(slices, start, walker, rules), SLICE_KEY), walker)


def _sliced(ticks: DataFrame, slice_ticks: int) -> DataFrame:
    """Consecutive slices of whole minutes, each of about ``slice_ticks`` ticks.

    Sized by the counts per minute, so neither a long quiet history nor a dense hour gives
    slices of an odd size. The counts are at most one row per cluster and minute of history.
    """
    timed = ticks.withColumn("minute", minute_of(F.col("ts_us")))
    earlier = W.partitionBy("cluster_id").orderBy("minute").rowsBetween(W.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("n").over(earlier), F.lit(0)) / slice_ticks).alias("slice")
    minutes = timed.groupBy("cluster_id", "minute").agg(F.count("*").alias("n")).select("cluster_id", "minute", place)
    return timed.join(minutes, ["cluster_id", "minute"]).drop("minute")


def _traced(prepared: DataFrame, walker: _SliceWalker) -> DataFrame:
    kept = prepared.drop("enter_workers", "enter_us")
    return prepared.mapInArrow(walker.trace, f"{_schema(kept)}, {TRACE_COLUMNS}").drop("slice")


def _entries(slices: DataFrame, start: DataFrame, walker: _SliceWalker, rules: list[Rule]) -> DataFrame:
    """The true entry state of every slice, over the path of states from the initial one."""
    slices = slices.join(start.select("cluster_id"), "cluster_id", "left_semi")
    spans = materialize(slices.groupBy(*SLICE_KEY).agg(F.min("ts_us").alias("begin_us"), F.max("ts_us").alias("end_us")), "spans")
    in_order = slices.select(*SLICE_KEY, "ts_us", "rule_ord").repartition(*SLICE_KEY).sortWithinPartitions(*SLICE_KEY, "ts_us")
    exits = materialize(in_order.mapInArrow(walker.exits, EXIT_SCHEMA), "exits")

    # A state left in slice s. Later ticks begin at ``next_us`` and can't tell decisions apart whose
    # cooldowns are all over by then, so those share the time at which the longest one would just be over.
    longest = max((r.cooldown_minutes for r in rules), default=0) * MINUTE_US
    following = F.lead("begin_us").over(W.partitionBy("cluster_id").orderBy("slice"))
    ends = spans.select(*SLICE_KEY, following.alias("next_us"))
    seen_us = F.greatest(F.col("exit_us"), F.col("next_us") - longest)
    left = exits.join(ends, SLICE_KEY).where(F.col("next_us").isNotNull()).withColumn("seen_us", seen_us)
    node = F.struct("slice", F.col("exit_workers").alias("workers"), "seen_us")
    states = left.select("cluster_id", node.alias("node")).distinct()
    initial = start.select("cluster_id", F.struct(F.lit(-1).cast("bigint").alias("slice"), F.col("enter_workers").alias("workers"), F.coalesce("enter_us", F.lit(NEVER)).alias("seen_us")).alias("node"))

    # Where a state decides next, and the state in which that walk leaves the slice; in a cluster's last slice it
    # leads nowhere further.
    deciding = _next_decisions(states.unionByName(initial), slices, spans, rules)
    arrived = deciding.join(exits.select("cluster_id", "ts_us", "slice", "exit_workers", "exit_us"), ["cluster_id", "ts_us"])
    reached = arrived.join(ends, SLICE_KEY)
    to = F.when(F.col("next_us").isNotNull(), F.struct("slice", F.col("exit_workers").alias("workers"), seen_us.alias("seen_us")))
    edges = materialize(reached.select("cluster_id", "node", to.alias("to"), "slice", "exit_workers", "exit_us"), "edges")
    jumps = edges.select("cluster_id", "node", "to").where(F.col("to").isNotNull())
    path, known = materialize(initial, "path"), -1
    while (count := path.count()) != known:
        known = count
        further = jumps.join(path, ["cluster_id", "node"]).select("cluster_id", F.col("to").alias("node"))
        path = materialize(path.union(further).distinct(), "path")
        over = jumps.select("cluster_id", F.col("node").alias("to"), F.col("to").alias("beyond"))
        jumps = materialize(jumps.join(over, ["cluster_id", "to"]).select("cluster_id", "node", F.col("beyond").alias("to")), "jumps")

    # A slice is entered in the state left by the last slice before it in which the path decided.
    made = edges.join(path, ["cluster_id", "node"], "left_semi").select(*SLICE_KEY, F.struct("exit_workers", "exit_us").alias("left"))
    before = W.partitionBy("cluster_id").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    entered = spans.select(*SLICE_KEY).join(made, SLICE_KEY, "left").withColumn("left", F.last("left", ignorenulls=True).over(before))
    return entered.join(start, "cluster_id").select(
        *SLICE_KEY,
        F.coalesce("left.exit_workers", "enter_workers").alias("enter_workers"),
        F.when(F.col("left").isNotNull(), F.col("left.exit_us")).otherwise(F.col("enter_us")).alias("enter_us"),
    )


def _next_decisions(states: DataFrame, slices: DataFrame, spans: DataFrame, rules: list[Rule]) -> DataFrame:
    """``cluster_id, node, ts_us``: the tick at which a state decides next, if any.

    For every rule of another target that is the rule's first tick from the end of its cooldown on. The slice of that
    time is looked up by days, the tick in the slice by a running minimum from the right; a slice without one
    passes on to the rule's first tick in a later slice.
    """
    others = F.array(*[F.struct(F.lit(i).alias("rule_ord"), F.lit(r.target_workers).alias("target"), F.lit(r.cooldown_minutes * MINUTE_US).alias("cooldown")) for i, r in enumerate(rules, 1)])
    seen = F.col("node.seen_us")
    # Nothing before the next slice counts: a state holds from there on.
    begins = W.partitionBy("cluster_id").orderBy("slice")
    next_slices = spans.select("cluster_id", "begin_us", F.coalesce(F.lag("slice").over(begins), F.lit(-1)).alias("slice"))
    probes = (
        states.withColumn("slice", F.col("node.slice"))
        .join(next_slices, SLICE_KEY)
        .select("cluster_id", "node", "begin_us", F.explode(others).alias("r"))
        .where(F.col("r.target") != F.col("node.workers"))
        .select("cluster_id", "node", F.col("r.rule_ord").alias("rule_ord"), F.greatest(F.when(seen == NEVER, F.col("begin_us")).otherwise(seen + F.col("r.cooldown")), F.col("begin_us")).alias("at"))
    )
    # A slice lasts until the next one begins, in the last one until its end; nothing is found after that.
    until = F.coalesce(F.lead("begin_us").over(begins) - 1, F.col("end_us"))
    day = lambda c: F.floor(c / F.lit(DAY_US))
    days = spans.select(*SLICE_KEY, "begin_us", until.alias("until_us")).withColumn("day", F.explode(F.sequence(day(F.col("begin_us")), day(F.col("until_us")))))
    # A slice stands at the start of each of its days, or at its own begin; a probe takes the last one up to it.
    marks = days.select("cluster_id", "day", F.greatest("begin_us", F.col("day") * DAY_US).alias("at"), F.struct("slice", "until_us").alias("lies"))
    up_to = W.partitionBy("cluster_id", "day").orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    dealt = probes.withColumn("day", day(F.col("at"))).unionByName(marks, allowMissingColumns=True)
    placed = dealt.withColumn("lies", F.last("lies", ignorenulls=True).over(up_to))
    placed = placed.where(F.col("node").isNotNull() & (F.col("at") <= F.col("lies.until_us"))).select("cluster_id", "lies.slice", "rule_ord", "at", "node")

    group = [*SLICE_KEY, "rule_ord"]
    rows = placed.withColumn("tick", F.lit(None).cast("bigint")).unionByName(
        slices.select(*group, F.col("ts_us").alias("at"), F.lit(None).cast("struct<slice:bigint,workers:bigint,seen_us:bigint>").alias("node"), F.col("ts_us").alias("tick"))
    )
    from_right = W.partitionBy(*group).orderBy(-F.col("at")).rangeBetween(W.unboundedPreceding, W.currentRow)
    here = rows.withColumn("tick", F.min("tick").over(from_right)).where(F.col("node").isNotNull())
    firsts = slices.groupBy(*group).agg(F.min("ts_us").alias("first_us"))
    all_rules = spans.select(*SLICE_KEY, F.explode(F.array(*[F.lit(i) for i in range(1, len(rules) + 1)])).alias("rule_ord"))
    later = F.min("first_us").over(W.partitionBy("cluster_id", "rule_ord").orderBy(F.desc("slice")).rowsBetween(W.unboundedPreceding, -1))
    firsts = all_rules.join(firsts, group, "left").withColumn("later_us", later).drop("first_us")
    found = here.join(firsts, group).select("cluster_id", "node", F.coalesce("tick", "later_us").alias("ts_us"))
    return found.groupBy("cluster_id", "node").agg(F.min("ts_us").alias("ts_us")).where(F.col("ts_us").isNotNull())


def decisions(walked: DataFrame, tick_table: DataFrame, rules: list[Rule]) -> DataFrame:
    """Decision rows. The record that decides is the first of its tick by (batch, id)."""
    fired = walked.filter(F.col("outcome") == "decision")
    return fired.join(tick_table.select("cluster_id", "ts_us", "first"), ["cluster_id", "ts_us"]).select(
        "cluster_id",
        F.col("first.ts_raw").alias("decision_ts"),
        _of_rule(rules, "name").alias("rule_name"),
        F.col("current_workers").alias("from_workers"),
        _of_rule(rules, "target_workers").cast("bigint").alias("to_workers"),
        "ts_us",
        F.col("first.batch_id").alias("batch_id"),
    )


def _of_rule(rules: list[Rule], field: str) -> Column:
    if not rules:
        return F.lit(None).cast("string" if field == "name" else "bigint")
    return F.element_at(F.array(*[F.lit(getattr(r, field)) for r in rules]), F.col("rule_ord"))


def point_outcomes(walked: DataFrame, records: DataFrame, tick_table: DataFrame, rules: list[Rule]) -> DataFrame:
    """The walk per record instead of per tick.

    Records after the first of a deciding tick meet the state that decision left behind:
    same rule, same target, so they are blocked by idempotence.
    """
    first = tick_table.select("cluster_id", "ts_us", F.struct("first.batch_id", "first.id").alias("first"))
    points = records.select("cluster_id", "ts_us", "batch_id", "id", "ts_raw")
    follows = (F.col("outcome") == "decision") & (F.struct("batch_id", "id") != F.col("first"))
    cooldown_us = _of_rule(rules, "cooldown_minutes").cast("bigint") * MINUTE_US
    target = _of_rule(rules, "target_workers").cast("bigint")
    return (
        points.join(walked.join(first, ["cluster_id", "ts_us"]), ["cluster_id", "ts_us"])
        .withColumn("follows", follows)
        .withColumns(
            {
                "outcome": F.when(F.col("follows"), F.lit("blocked_idempotence")).otherwise(F.col("outcome")),
                "current_workers": F.when(F.col("follows"), target).otherwise(F.col("current_workers")),
                "last_decision_us": F.when(F.col("follows"), F.col("ts_us")).otherwise(F.col("last_decision_us")),
                "cooldown_until_us": F.when(F.col("follows"), F.col("ts_us") + cooldown_us).otherwise(F.col("cooldown_until_us")),
            }
        )
        .drop("first", "follows")
    )
