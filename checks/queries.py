"""One query per operator, each over the whole ``events`` table of a scale factor."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driverlens import fixtures as X
from driverlens.functions.timegrid import iso_utc
from driverlens.operators import entries as E
from driverlens.operators import filesets as FS
from driverlens.operators import manifest as M
from driverlens.operators import records as R
from driverlens.operators import recordset as RS
from driverlens.operators import rules as RU
from driverlens.operators import trace as T
from driverlens.operators import windows as WI
from driverlens.operators.gates import walk_ticks
from driverlens.plans.decide import decide, decide_from_logs, decision_points, store_ticks
from driverlens.session import materialize, scratch_path
from driverlens.sources import control as C
from driverlens.sources import decision_table as D
from driverlens.sources import logs as L
from driverlens.sources import ranges as G
from driverlens.streaming.buffered import ARRIVAL_SCHEMA, CompleteThenWalk
from driverlens.streaming.incremental import RECORD_SCHEMA, IncrementalWalk

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DECISION = D.DECISION_COLUMNS


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources ---------------------------------------------------------------------------


@query
def scan_logs(spark, sf_dir):
    entries = L.scan_entries(X.log_bytes(spark, sf_dir))
    has_progress = F.contains("text", F.lit(E.PROGRESS_MARKER))
    return entries.groupBy("path").agg(F.count("*").alias("entries"), F.count_if(has_progress).alias("progress_entries"))


@query
def scan_progress_entries(spark, sf_dir):
    entries = L.scan_entries(X.log_bytes(spark, sf_dir), progress_only=True)
    return entries.select("path", "entry_no", "text")


@query
def notified_files(spark, sf_dir):
    notes = C.valid_notifications(X.messages(spark, sf_dir))
    return FS.existing_files(notes, X.file_listing(spark, sf_dir)).select("message_id", "cluster_id", "key", "length")


@query
def missing_files(spark, sf_dir):
    notes = C.valid_notifications(X.messages(spark, sf_dir))
    return FS.missing_files(notes, X.file_listing(spark, sf_dir)).select("message_id", "key")


@query
def valid_notifications(spark, sf_dir):
    return C.valid_notifications(X.messages(spark, sf_dir))


@query
def rejected_notifications(spark, sf_dir):
    return C.rejected_notifications(X.messages(spark, sf_dir))


@query
def notification_audit(spark, sf_dir):
    audit = C.notification_audit(X.messages(spark, sf_dir))
    return audit.select("message_id", "raw_body", F.col("body").isNotNull().alias("is_json"))


@query
def manifest_rows(spark, sf_dir):
    return C.manifest_rows(X.manifest_documents(spark, sf_dir))


@query
def rules_rows(spark, sf_dir):
    rows = C.rules_rows(X.rules_documents(spark, sf_dir))
    return rows.select("ruleset", "rule_ord", "name", "threshold", "threshold_type", "window_minutes", "min_batches", "target_workers_type")


@query
def file_first_ts(spark, sf_dir):
    return FS.file_first_ts(R.progress_records(X.log_entries(spark, sf_dir), []))


@query
def file_first_ts_early(spark, sf_dir):
    """The same from stored files, each read up to its first valid record."""
    logs, _, _ = X.write_run(spark, sf_dir, scratch_path(spark, "run"))
    times = reduce(DataFrame.unionByName, (G.first_times(L.list_log_files(spark, folder)) for folder in logs))
    return times.withColumn("path", F.concat(F.lit("logs/"), F.regexp_extract("path", r"([^/]+/[^/]+)$", 1)))


# --- the decision table ----------------------------------------------------------------


def _decisions(spark, sf_dir) -> DataFrame:
    return decide(X.progress_from_events(spark, sf_dir), X.initial_states(spark, sf_dir), X.RULES)


@query
def decision_lookup(spark, sf_dir):
    """Point lookups in bulk: the first decision of every cluster."""
    table = scratch_path(spark, "decisions")
    D.put_decisions(_decisions(spark, sf_dir), table)
    stored = D.read_decisions(spark, table)
    keys = stored.groupBy("cluster_id").agg(F.min("decision_ts").alias("decision_ts"))
    return D.lookup_decisions(stored, keys)


@query
def decision_point_lookup(spark, sf_dir):
    """One decision by its key: the first key of the stored table."""
    table = scratch_path(spark, "decisions")
    D.put_decisions(_decisions(spark, sf_dir), table)
    key = D.read_decisions(spark, table).select(F.min(F.struct(*D.DECISION_KEY)).alias("key")).first().key
    return D.get_decision(spark, table, *(key or ("", "")))


@query
def decisions_for_cluster(spark, sf_dir):
    """Every cluster's listing: its decisions and their position by ``decision_ts`` as text."""
    rows = D.dedupe_decisions_last(_decisions(spark, sf_dir))
    return D.listed(rows).select("cluster_id", "position", "decision_ts", "rule_name")


@query
def upsert_decisions(spark, sf_dir):
    """A second write overwrites the keys it shares with the first, and a retry changes nothing."""
    table = scratch_path(spark, "decisions")
    made = _decisions(spark, sf_dir)
    D.put_decisions(made.withColumn("rule_name", F.lit("stale")), table, 0, "run")
    renewed = made.filter(F.col("to_workers") > F.col("from_workers"))
    D.put_decisions(renewed, table, 1, "run")
    D.put_decisions(renewed, table, 1, "run")
    return D.read_decisions(spark, table)


@query
def upsert_two_runs(spark, sf_dir):
    """Two runs with default arguments: shared keys are the second's, all others stay."""
    table = scratch_path(spark, "decisions")
    made = materialize(_decisions(spark, sf_dir), "made")
    D.put_decisions(made.filter(F.col("to_workers") != 2).withColumn("rule_name", F.lit("first")), table)
    D.put_decisions(made.filter(F.col("to_workers") != 16), table)
    return D.read_decisions(spark, table)


@query
def compacted_decisions(spark, sf_dir):
    """Two runs made one write, and a third over it."""
    table = scratch_path(spark, "decisions")
    made = materialize(_decisions(spark, sf_dir), "made")
    D.put_decisions(made.withColumn("rule_name", F.lit("first")), table)
    D.put_decisions(made.filter(F.col("to_workers") != 16), table)
    D.compact_decisions(spark, table)
    D.put_decisions(made.filter(F.col("to_workers") == 2).withColumn("rule_name", F.lit("third")), table)
    return D.read_decisions(spark, table)


@query
def dedupe_decisions_last(spark, sf_dir):
    """Decisions keyed by day, so that several share a key."""
    daily = _decisions(spark, sf_dir).withColumn("decision_ts", F.substring("decision_ts", 1, 10))
    return D.dedupe_decisions_last(daily).select(*DECISION)


def _raw_decisions(spark, sf_dir) -> DataFrame:
    return X.events(spark, sf_dir).select(
        F.when(F.col("event_id") % 11 != 0, X.cluster_of(F.col("user_id"))).otherwise("").alias("cluster_id"),
        iso_utc(F.col("ts_us")).alias("decision_ts"),
        F.when(F.col("event_id") % 13 != 0, F.col("event_type")).alias("rule_name"),
        (F.col("k") % 7 - 1).cast("bigint").alias("from_workers"),
        (F.col("k") % 5).cast("bigint").alias("to_workers"),
    )


@query
def decision_violations(spark, sf_dir):
    return D.decision_violations(_raw_decisions(spark, sf_dir))


@query
def decisions_export_roundtrip(spark, sf_dir):
    return D.import_items(D.export_items(_decisions(spark, sf_dir)))


@query
def decisions_export(spark, sf_dir):
    return D.export_items(_decisions(spark, sf_dir))


@query
def decision_trace(spark, sf_dir):
    """Timestamps as they were logged: in UTC, with an offset, or without decimals."""
    logged = F.when(F.col("batch_id") % 3 == 0, F.concat(F.substring("ts_raw", 1, 23), F.lit("+00:00")))
    logged = logged.when(F.col("batch_id") % 3 == 1, F.concat(F.substring("ts_raw", 1, 23), F.lit("000Z")))
    records = X.progress_from_events(spark, sf_dir).withColumn("ts_raw", logged.otherwise(F.col("ts_raw")))
    points = decision_points(records, X.initial_states(spark, sf_dir), X.RULES)
    trace = T.decision_trace(points, X.RULES)
    return trace.select(
        "cluster_id", "evaluation_ts", "batch_id", "rule",
        F.array_join("rules_not_holding_above", ",").alias("rules_not_holding_above"),
        "condition.metric", "condition.aggregation", "condition.aggregate", "condition.operator", "condition.threshold",
        "condition.comparison", "condition.window_minutes", "condition.records_in_window", "condition.records_with_metric", "condition.min_batches",
        "gates.current_workers", "gates.target_workers", "gates.idempotent", "gates.last_decision_ts",
        "gates.cooldown_minutes", "gates.cooldown_until", "gates.cooldown_passed", "outcome",
    )


# --- entries and records ---------------------------------------------------------------


@query
def header_lines(spark, sf_dir):
    lines = X.log_texts(spark, sf_dir).select("event_id", F.explode(F.split("text", "\n")).alias("value"))
    return E.header_lines(lines)


@query
def entries_from_text(spark, sf_dir):
    return E.entries_from_text(X.log_texts(spark, sf_dir)).select("event_id", "entry_no", "text")


@query
def entries_from_lines(spark, sf_dir):
    """Text files written and read back as lines, in whatever splits Spark chooses."""
    path = scratch_path(spark, "logs")
    texts = X.log_texts(spark, sf_dir, preamble=False)
    texts.select(F.regexp_replace("text", "\n$", "").alias("value")).write.text(path)
    return E.entries_from_lines(E.read_lines(spark, path)).select("text")


@query
def preamble_entries(spark, sf_dir):
    entries = E.entries_from_text(X.log_texts(spark, sf_dir))
    return entries.filter(E.is_preamble(F.col("text"))).select("event_id", "entry_no", "text")


@query
def progress_entries(spark, sf_dir):
    return E.progress_entries(X.log_entries(spark, sf_dir)).select("event_id", "cluster_id", "path")


@query
def progress_records(spark, sf_dir):
    records = R.progress_records(X.log_entries(spark, sf_dir))
    metric = lambda name: F.col("metrics")[name]
    return records.select(
        "cluster_id", "path", "id", "batch_id", "ts_us", "ts_raw",
        metric("batchDuration").alias("batch_duration"), metric("source.k").alias("source_k"),
    )


@query
def rejected_records(spark, sf_dir):
    return R.rejected_records(X.log_entries(spark, sf_dir)).select("event_id", "path", "status", "reason")


def _documents(spark, sf_dir, batch: str, stamp: str, metric: str) -> DataFrame:
    """One entry per event whose fields are given as SQL expressions for JSON text."""
    text = f"concat('{E.PROGRESS_MARKER} {{\"id\":\"q\",\"batchId\":', {batch}, ',\"timestamp\":', {stamp}, ',\"m\":', {metric}, '}}')"
    rows = X.events(spark, sf_dir).withColumn("iso", iso_utc(F.col("ts_us")))
    return rows.select("event_id", F.lit("p").alias("path"), F.col("event_id").alias("entry_no"), F.expr(text).alias("text"))


@query
def batch_id_coercion(spark, sf_dir):
    batch = (
        "case event_id % 9 when 0 then cast(event_id as string) when 1 then concat(event_id, '.0') "
        "when 2 then concat('\"', event_id, '\"') when 3 then concat(event_id, '.5') when 4 then 'true' "
        "when 5 then '\"five\"' when 6 then 'null' when 7 then concat('\" -', event_id, ' \"') else concat('\"', event_id, '.0\"') end"
    )
    return R.classified(_documents(spark, sf_dir, batch, "concat('\"', iso, '\"')", "1"), []).select("event_id", "batch_id", "status")


@query
def timestamp_parse(spark, sf_dir):
    stamp = (
        "case event_id % 9 when 0 then concat('\"', iso, '\"') when 1 then concat('\"', substring(iso, 1, 23), '+02:00\"') "
        "when 2 then concat('\"', substring(iso, 1, 23), '\"') when 3 then concat('\"', replace(substring(iso, 1, 19), 'T', ' '), '\"') "
        "when 4 then '\"\"' when 5 then '\"yesterday\"' when 6 then cast(event_id as string) "
        "when 7 then concat('\" ', substring(iso, 1, 23), 'z \"') else 'null' end"
    )
    return R.classified(_documents(spark, sf_dir, "1", stamp, "1"), []).select("event_id", "ts_us", "ts_raw", "status")


@query
def metric_coercion(spark, sf_dir):
    metric = (
        "case event_id % 9 when 0 then cast(cents as string) when 1 then concat('\"', cents, '\"') "
        "when 2 then concat('\" ', cents, ' \"') when 3 then 'true' when 4 then 'null' when 5 then '\"NaN\"' "
        "when 6 then '\"0x1p3\"' when 7 then concat('{\"a\":', cents, '}') else concat(cents, 'e2') end"
    )
    rows = R.progress_records(_documents(spark, sf_dir, "1", "concat('\"', iso, '\"')", metric))
    return rows.select("event_id", F.col("metrics")["m"].alias("m"))


@query
def source_metric_shapes(spark, sf_dir):
    """``sources`` in all shapes: only a real array of objects with a ``metrics`` object counts."""
    shape = (
        """case event_id % 11 when 0 then concat('[{"metrics":{"k":"', k, '"}}]') when 1 then concat('"[{\\\\"metrics\\\\":{\\\\"k\\\\":', k, '}}]"') """
        """when 2 then concat('[{"metrics":"{\\\\"k\\\\":', k, '}"}]') when 3 then '[]' when 4 then 'null' when 5 then concat('{"metrics":{"k":', k, '}}') """
        """when 6 then concat('[5,{"metrics":{"k":', k, '}}]') when 7 then concat('[{"metrics":{"k":', k, '}},5,"x"]') when 8 then concat('[{"metrics":[', k, ']}]') """
        """when 9 then concat('[{"metrics":{"k":1,"k":', k, '}}]') else concat('[{"x":1},{"metrics":{"k":', k, '}}]') end"""
    )
    text = f"""concat('{E.PROGRESS_MARKER} {{"id":"q","batchId":1,"timestamp":"', iso, '","sources":', {shape}, '}}')"""
    rows = X.events(spark, sf_dir).withColumn("iso", iso_utc(F.col("ts_us")))
    entries = rows.select("event_id", F.lit("p").alias("path"), F.col("event_id").alias("entry_no"), F.expr(text).alias("text"))
    both = [R.progress_records(entries, names).select("event_id", F.col("metrics")["source.k"].alias("k")) for names in (None, ["source.k"])]
    return both[0].join(both[1].withColumnRenamed("k", "k_chosen"), "event_id")


@query
def metrics_long(spark, sf_dir):
    return R.metrics_long(R.progress_records(X.log_entries(spark, sf_dir))).select("cluster_id", "batch_id", "metric", "value")


@query
def parse_stats(spark, sf_dir):
    return R.parse_stats(X.log_entries(spark, sf_dir))


@query
def skip_samples(spark, sf_dir):
    """The first two skipped entries per cluster."""
    entries = X.log_entries(spark, sf_dir).withColumn("path", F.col("cluster_id"))
    return R.skip_samples(entries, limit=2).select("path", "place", "entry_no", "reason")


# --- file sets -------------------------------------------------------------------------


@query
def file_hours(spark, sf_dir):
    return FS.file_hours(X.log_files(spark, sf_dir)).select("cluster_id", "key", "hour_us")


@query
def file_order(spark, sf_dir):
    first_times = FS.file_first_ts(R.progress_records(X.log_entries(spark, sf_dir), []))
    ordered = FS.file_order(X.log_files(spark, sf_dir), first_times.withColumnRenamed("path", "key"))
    return ordered.select("cluster_id", "key", "file_ord")


@query
def cluster_completeness(spark, sf_dir):
    notes = C.valid_notifications(X.messages(spark, sf_dir))
    return FS.cluster_completeness(notes, X.manifest(spark, sf_dir))


@query
def unknown_clusters(spark, sf_dir):
    notes = C.valid_notifications(X.messages(spark, sf_dir))
    return FS.unknown_clusters(notes, X.manifest(spark, sf_dir)).select("message_id", "cluster_id")


def _status(spark, sf_dir) -> DataFrame:
    notes = C.valid_notifications(X.messages(spark, sf_dir))
    completeness = FS.cluster_completeness(notes, X.manifest(spark, sf_dir))
    records = RS.dedup_records(X.repeated_progress(spark, sf_dir))
    return FS.cluster_status(completeness, records, _decisions(spark, sf_dir))


@query
def cluster_status(spark, sf_dir):
    return _status(spark, sf_dir)


@query
def run_status(spark, sf_dir):
    return FS.run_status(_status(spark, sf_dir))


# --- record set ------------------------------------------------------------------------


@query
def dedup_records(spark, sf_dir):
    kept = RS.dedup_records(X.repeated_progress(spark, sf_dir))
    return kept.select("cluster_id", "id", "batch_id", "ts_us", "ts_raw", "file_ord", F.col("metrics")["batchDuration"].alias("batch_duration"))


@query
def record_order(spark, sf_dir):
    return RS.record_order(X.progress_from_events(spark, sf_dir)).select("cluster_id", "batch_id", "walk_ord")


@query
def dedup_stats(spark, sf_dir):
    return RS.dedup_stats(X.repeated_progress(spark, sf_dir))


# --- windows ---------------------------------------------------------------------------


def _evaluated(spark, sf_dir, rules) -> DataFrame:
    """Rule verdicts per record: those of the record's tick."""
    records = X.progress_from_events(spark, sf_dir)
    verdicts = WI.evaluate(store_ticks(records, rules), rules)
    verdicts = verdicts.withColumn("verdict", F.col("verdicts")[0])
    return records.select("cluster_id", "ts_us", "batch_id").join(verdicts, ["cluster_id", "ts_us"])


def _window(spark, sf_dir, aggregation: str, metric: str = "batchDuration") -> DataFrame:
    rule = RU.Rule("w", metric, aggregation, "gt", 0, 4320, 3, 1, 0)
    return _evaluated(spark, sf_dir, [rule]).select("cluster_id", "batch_id", F.col("verdict.aggregate").alias(f"{aggregation}_value"))


@query
def window_counts(spark, sf_dir):
    rule = RU.Rule("w", "batchDuration", "max", "gt", 0, 4320, 1, 1, 0)
    rows = _evaluated(spark, sf_dir, [rule])
    return rows.select("cluster_id", "batch_id", "verdict.records_in_window", "verdict.records_with_metric")


@query
def window_avg(spark, sf_dir):
    return _window(spark, sf_dir, "avg")


@query
def window_avg_of_fractions(spark, sf_dir):
    """Averages of a metric with fractions, over records dealt to many partitions."""
    thirds = F.create_map(F.lit("rate"), F.col("batch_id").cast("double") / 3)
    records = X.progress_from_events(spark, sf_dir).withColumn("metrics", thirds).repartition(7)
    rule = RU.Rule("w", "rate", "avg", "gt", 0, 4320, 3, 1, 0)
    verdicts = WI.evaluate(store_ticks(records, [rule]), [rule]).select("cluster_id", "ts_us", F.col("verdicts")[0]["aggregate"].alias("avg_value"))
    return verdicts.where("avg_value IS NOT NULL").select("cluster_id", "ts_us", F.round("avg_value", 6).alias("avg_value"))


def _extremes() -> dict[int, float]:
    return {0: 2.0**-1000, 1: 2.0**-60, 2: 1.0, 3: 2.0**1000, 4: 2.0**900}


@query
def window_avg_of_extremes(spark, sf_dir):
    """Averages of values from 1e-300 to 1e300; a fifth of the clusters has both ends in one window."""
    records = X.progress_from_events(spark, sf_dir)
    kind, batch = F.pmod(F.substring("id", 3, 20).cast("bigint"), F.lit(5)), F.col("batch_id")
    scale = F.element_at(F.array(*[F.lit(v) for _, v in sorted(_extremes().items())]), (kind + 1).cast("int"))
    value = batch * F.when((kind == 4) & (batch % 2 == 0), F.lit(2.0**-900)).otherwise(scale)
    rule = RU.Rule("w", "wide", "avg", "gt", 0, 4320, 3, 1, 0)
    records = records.withColumn("metrics", F.create_map(F.lit("wide"), value)).repartition(7)
    verdicts = WI.evaluate(store_ticks(records, [rule]), [rule]).select("cluster_id", "ts_us", F.inline("verdicts"))
    return verdicts.select("cluster_id", "ts_us", "holds", F.col("aggregate").alias("avg_value"))


@query
def window_max(spark, sf_dir):
    return _window(spark, sf_dir, "max")


@query
def window_min(spark, sf_dir):
    return _window(spark, sf_dir, "min")


@query
def window_last(spark, sf_dir):
    return _window(spark, sf_dir, "last")


@query
def rule_evaluations(spark, sf_dir):
    records = X.progress_from_events(spark, sf_dir)
    return WI.rule_evaluations(WI.evaluate(store_ticks(records, X.RULES), X.RULES))


# --- matching and gates ----------------------------------------------------------------


@query
def matched_rule(spark, sf_dir):
    records = X.progress_from_events(spark, sf_dir)
    matched = WI.matched_ticks(WI.evaluate(store_ticks(records, X.RULES), X.RULES))
    points = records.select("cluster_id", "ts_us", "batch_id").join(matched, ["cluster_id", "ts_us"])
    above = F.array_join(WI.rules_not_holding_above(X.RULES), ",").alias("rules_not_holding_above")
    return points.select("cluster_id", "batch_id", "rule_ord", above, "aggregate")


@query
def gate_outcomes(spark, sf_dir):
    points = decision_points(X.progress_from_events(spark, sf_dir), X.initial_states(spark, sf_dir), X.RULES)
    return points.select("cluster_id", "batch_id", "rule_ord", "current_workers", "last_decision_us", "cooldown_until_us", "outcome")


@query
def decisions(spark, sf_dir):
    return decide(X.repeated_progress(spark, sf_dir), X.initial_states(spark, sf_dir), X.RULES).select(*DECISION)


@query
def decisions_alternating(spark, sf_dir):
    """Two rules in turn for ever, in slices of a few ticks: histories that never merge."""
    times = X.progress_from_events(spark, sf_dir).select("cluster_id", "ts_us").distinct()
    turn = F.row_number().over(Window.partitionBy("cluster_id").orderBy("ts_us")) % 2
    rules = [RU.Rule("up", "m", "max", "gt", 0, 1, 1, 8, 1440), RU.Rule("down", "m", "max", "gt", 0, 1, 1, 2, 2880)]
    walked = walk_ticks(times.withColumn("rule_ord", (2 - turn).cast("int")), X.initial_states(spark, sf_dir), rules, slice_ticks=8)
    return walked.select("cluster_id", "ts_us", "rule_ord", "current_workers", "last_decision_us", "cooldown_until_us", "outcome")


@query
def decisions_sliced(spark, sf_dir):
    """The same, with every cluster treated as hot: walked in slices of a few ticks."""
    made = decide(
        X.repeated_progress(spark, sf_dir), X.initial_states(spark, sf_dir), X.RULES, slice_ticks=12
    )
    return made.select(*DECISION)


def _from_files(spark, sf_dir, plain: bool, in_ranges: bool = False) -> DataFrame:
    base = scratch_path(spark, "run")
    logs, manifest, rules = X.write_run(spark, sf_dir, base, plain)
    return decide_from_logs(spark, logs, manifest, rules, f"{base}/table", as_lines=plain, in_ranges=in_ranges).select(*DECISION)


@query
def decisions_from_logs(spark, sf_dir):
    """From files to stored decisions: gzip and other files, manifest and rules documents."""
    return _from_files(spark, sf_dir, plain=False)


@query
def decisions_from_ranges(spark, sf_dir):
    """The same files read from the store in byte ranges."""
    return _from_files(spark, sf_dir, plain=False, in_ranges=True)


@query
def decisions_from_lines(spark, sf_dir):
    """The same from plain files, read line by line in splits."""
    return _from_files(spark, sf_dir, plain=True)


@query
def document_shapes(spark, sf_dir):
    """Which manifest documents have the right outer shape."""
    shape = (
        "case event_id % 7 when 0 then '[]' when 1 then '{}' when 2 then 'nonsense' when 3 then concat('{\"clusters\": ', event_id, '}') "
        "when 4 then '{\"clusters\": {}}' when 5 then '{\"clusters\": []}' else concat('{\"clusters\": [', event_id, ']}') end"
    )
    documents = X.events(spark, sf_dir).select(F.col("event_id").cast("string").alias("doc_id"), F.expr(shape).alias("text"))
    return C.misshapen_manifests(documents).select("doc_id")


STEADY = [RU.Rule("steady", "batchDuration", "max", "gt", -1, 4320, 1, 16, 4320)]


@query
def decisions_steady(spark, sf_dir):
    """One rule that holds nearly throughout, walked in slices of a few ticks."""
    points = decision_points(X.progress_from_events(spark, sf_dir), X.initial_states(spark, sf_dir), STEADY, slice_ticks=8)
    return points.select("cluster_id", "batch_id", "rule_ord", "aggregate", "current_workers", "last_decision_us", "last_decision_ts", "cooldown_until_us", "outcome")


@query
def gate_outcomes_of_peers(spark, sf_dir):
    """Record times cut to the day, so that many records share an evaluation time."""
    records = X.progress_from_events(spark, sf_dir).withColumn("ts_us", F.col("ts_us") - F.pmod("ts_us", F.lit(FS.DAY_US)))
    points = decision_points(records, X.initial_states(spark, sf_dir), X.RULES)
    return points.select("cluster_id", "batch_id", "rule_ord", "records_in_window", "aggregate", "current_workers", "last_decision_us", "outcome")


# --- validation ------------------------------------------------------------------------


@query
def rule_problems(spark, sf_dir):
    return RU.rule_problems(X.raw_rules(spark, sf_dir))


@query
def rule_number_coercion(spark, sf_dir):
    typed = RU.coerce_rule_numbers(X.raw_rules(spark, sf_dir))
    return typed.select("ruleset", "rule_ord", "threshold_value", *[f"{f}_value" for f in RU.INT_FIELDS])


@query
def manifest_problems(spark, sf_dir):
    return M.manifest_problems(X.manifest_documents(spark, sf_dir))


# --- streams ---------------------------------------------------------------------------

CHUNKS = 3


def _arrivals(spark, sf_dir) -> DataFrame:
    """Records in three consecutive files; some of a file's last day are logged, or logged
    again, in the next one."""
    day = F.dayofmonth(F.timestamp_add("MICROSECOND", F.col("ts_us"), F.lit("1970-01-01").cast("timestamp_ntz")))
    rows = X.progress_from_events(spark, sf_dir).withColumn("day", day)
    own = F.least(F.floor((F.col("day") - 1) / 10), F.lit(CHUNKS - 1)).cast("int")
    is_last_day = (F.col("day") % 10 == 0) & (own < CHUNKS - 1)
    spilled = is_last_day & (F.col("batch_id") % 3 == 0)
    placed = rows.withColumn("chunk", own + F.when(spilled, 1).otherwise(0))
    again = rows.filter(is_last_day & (F.col("batch_id") % 3 == 1)).withColumn("chunk", own + 1)
    return placed.unionByName(again).drop("day")


def _incremental(spark, sf_dir) -> IncrementalWalk:
    base = scratch_path(spark, "stream")
    manifest = X.manifest(spark, sf_dir).select("cluster_id", "initial_workers")
    walk = IncrementalWalk(X.RULES, manifest, f"{base}/state", f"{base}/table", keep=CHUNKS + 1)  # queries look at all states
    arrivals = _arrivals(spark, sf_dir)
    for chunk in range(CHUNKS):
        arrivals.filter(F.col("chunk") == chunk).drop("chunk").write.mode("append").parquet(f"{base}/input")
        records = spark.readStream.schema(RECORD_SCHEMA).parquet(f"{base}/input")
        walk.start(records, f"{base}/checkpoint").awaitTermination()
    walk.finish(spark, CHUNKS)
    return walk


@query
def stream_decisions(spark, sf_dir):
    return D.read_decisions(spark, _incremental(spark, sf_dir).table)


@query
def stream_state_size(spark, sf_dir):
    walk = _incremental(spark, sf_dir)
    sizes = None
    for epoch in range(CHUNKS + 1):
        kept = {"pending": walk.pending(spark, epoch)} | {n: walk.state(spark, n, epoch) for n in ("lookback", "seen")}
        for name, rows in kept.items():
            rows = rows.agg(F.count("*").alias("records")).select(F.lit(epoch).alias("epoch"), F.lit(name).alias("state"), "records")
            sizes = rows if sizes is None else sizes.unionByName(rows)
    return sizes


@query
def stream_dedup(spark, sf_dir):
    """The records each micro-batch found new; together every record once."""
    walk = _incremental(spark, sf_dir)
    arrived = [walk.state(spark, "arrived", epoch).filter("is_new") for epoch in range(CHUNKS)]
    return reduce(DataFrame.unionByName, arrived).select("cluster_id", "id", "batch_id", "ts_us")


@query
def walk_stats(spark, sf_dir):
    stats = _incremental(spark, sf_dir).stats(spark, CHUNKS)
    return stats.select("cluster_id", "records_seen", "unique_records", "evaluation_points", "late_records", "peak_held_records")


@query
def stream_upsert_replay(spark, sf_dir):
    """The last micro-batch runs again, as after a loss before its commit."""
    walk = _incremental(spark, sf_dir)
    again = _arrivals(spark, sf_dir).filter(F.col("chunk") == CHUNKS - 1).drop("chunk")
    walk.process(again, CHUNKS - 1)
    walk.finish(spark, CHUNKS)
    return D.read_decisions(spark, walk.table)


@query
def stream_complete_then_walk(spark, sf_dir):
    """A cluster's files arrive in mixed order; clusters that lack a file give nothing, and a
    file that comes after a cluster was walked is ignored."""
    base = scratch_path(spark, "stream")
    day = F.substring("ts_raw", 1, 10)
    rows = X.progress_from_events(spark, sf_dir).withColumn("key", F.concat("cluster_id", F.lit("/"), day))
    rows = rows.withColumn("chunk", (F.substring(day, 9, 2).cast("int") * 7) % CHUNKS)
    walk = CompleteThenWalk(X.RULES, X.manifest(spark, sf_dir), f"{base}/state", f"{base}/table")
    # Afterwards every complete cluster gets one more file, with loads that would change its walk.
    lacks_one = F.regexp_extract("cluster_id", "[0-9]+$", 0).cast("int") % 8 == 5
    late = rows.filter(~lacks_one).withColumn("metrics", F.transform_values("metrics", lambda _, v: v + 1e6))
    late = late.withColumns({"chunk": F.lit(CHUNKS), "key": F.concat("cluster_id", F.lit("/late")), "batch_id": F.col("batch_id") + 1_000_000_000})
    rows = rows.unionByName(late)
    for chunk in range(CHUNKS + 1):
        rows.filter(F.col("chunk") == chunk).drop("chunk").write.mode("append").parquet(f"{base}/input")
        arrivals = spark.readStream.schema(ARRIVAL_SCHEMA).parquet(f"{base}/input")
        walk.start(arrivals, f"{base}/checkpoint").awaitTermination()
    return D.read_decisions(spark, walk.table)
