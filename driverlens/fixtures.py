"""Inputs of this engine derived from the generic ``events`` table (see FIXTURES.md)."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import fields

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.functions.timegrid import iso_utc
from driverlens.operators.rules import Rule
from driverlens.session import scratch_path, write
from driverlens.sources.logs import remove_log_files

# The four rules of FIXTURES.md B2, durations in cents.
RULES = [
    Rule("surge", "source.k", "last", "gt", 80, 4320, 3, 16, 1440),
    Rule("slow", "batchDuration", "avg", "gt", 6000, 4320, 3, 8, 1440),
    Rule("idle", "batchDuration", "max", "lt", 10000, 7200, 5, 2, 4320),
    Rule("floor", "batchDuration", "min", "gt", 2500, 2880, 2, 4, 720),
]
INITIAL_WORKERS = 4
EVENTS_AT_ONCE = 8_000_000  # events whose log files are on disk at a time


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with whole-microsecond time, whole-cent value and the ``k`` property."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        "user_id",
        "event_type",
        F.timestamp_diff("MICROSECOND", epoch, F.col("ts").cast("timestamp_ntz")).alias("ts_us"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def cluster_of(user: Column) -> Column:
    return F.concat(F.lit("cluster-"), user.cast("string"))


def progress_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records (FIXTURES.md B1): errors lack ``batchDuration``."""
    rows = events(spark, sf_dir)
    duration = F.when(F.col("event_type") != "error", F.col("cents").cast("double"))
    return rows.select(
        cluster_of(F.col("user_id")).alias("cluster_id"),
        F.concat(F.lit("q-"), F.col("user_id").cast("string")).alias("id"),
        F.col("event_id").alias("batch_id"),
        "ts_us",
        iso_utc(F.col("ts_us")).alias("ts_raw"),
        F.create_map(F.lit("batchDuration"), duration, F.lit("source.k"), F.col("k").cast("double")).alias("metrics"),
        F.lit(0).alias("file_ord"),
        F.col("event_id").alias("entry_no"),
    )


def repeated_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with every seventh batch logged again in the next file."""
    once = progress_from_events(spark, sf_dir)
    again = once.filter(F.col("batch_id") % 7 == 0).withColumn("file_ord", F.col("file_ord") + 1)
    return once.unionByName(again)


def initial_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    return users.select(
        cluster_of(F.col("user_id")).alias("cluster_id"),
        F.lit(INITIAL_WORKERS).alias("workers"),
        F.lit(None).cast("bigint").alias("last_us"),
    )


# --- log text (FIXTURES.md B3) ---------------------------------------------------------

_PREFIX = "date_format(timestampadd(MICROSECOND, ts_us, timestamp_ntz'1970-01-01'), 'yy/MM/dd HH:mm:ss')"
_ENTRY_KIND = (
    "case when event_id % 50 = 0 then 'cut' when event_id % 53 = 0 then 'no_id' "
    "when event_id % 59 = 0 then 'bad_ts' when event_id % 61 = 0 then 'idle' else 'good' end"
)
_SINGLE = (
    "concat(prefix, ' INFO ProgressReporter: Streaming query made progress: {', "
    "if(kind = 'no_id', '', concat('\"id\":\"q-', user_id, '\",')), "
    "'\"runId\":\"r-', user_id, '\",\"name\":\"ingest\",\"timestamp\":\"', stamp, '\",\"batchId\":', event_id, ',', "
    "if(event_type = 'error', '', concat('\"batchDuration\":', cents, ',')), "
    "'\"durationMs\":{\"addBatch\":7},\"stateOperators\":[],\"sources\":[{\"description\":\"files\",\"metrics\":{\"k\":\"', k, "
    "'\"}}],\"sink\":{\"numOutputRows\":', k, '}}')"
)
_PRETTY = (
    "concat(prefix, ' INFO MicroBatchExecution: Streaming query made progress: {\\n', "
    "if(kind = 'no_id', '', concat('  \"id\" : \"q-', user_id, '\",\\n')), "
    "'  \"runId\" : \"r-', user_id, '\",\\n  \"name\" : \"ingest\",\\n  \"timestamp\" : \"', stamp, '\",\\n  \"batchId\" : ', event_id, ',\\n', "
    "if(event_type = 'error', '', concat('  \"batchDuration\" : ', cents, ',\\n')), "
    "'  \"sources\" : [ {\\n    \"metrics\" : {\\n      \"k\" : \"', k, '\"\\n    }\\n  } ]\\n}\\n\\tat org.example.Progress.report(Progress.scala:7)')"
)
_CUT = "concat(prefix, ' INFO ProgressReporter: Streaming query made progress: {\"id\":\"q-', user_id, '\",\"timestamp\":\"2024-')"
_IDLE = "concat(prefix, ' INFO MicroBatchExecution: Streaming query has been idle and waiting for new data more than 10000 ms.')"
_UNRELATED = "concat(prefix, ' WARN TaskSetManager: Lost task ', event_id, '.0\\n\\tat org.example.Task.run(Task.scala:9)')"
PREAMBLE = "\tat org.example.Earlier.end(Earlier.scala:3)"


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log entry per event: ``cluster_id, path, entry_no, text``, plus the event's columns."""
    return entries_of(events(spark, sf_dir))


def entries_of(rows: DataFrame) -> DataFrame:
    """The same for rows as ``events`` gives them."""
    rows = (
        rows.withColumn("prefix", F.expr(_PREFIX))
        .withColumn("kind", F.expr(_ENTRY_KIND))
        .withColumn("stamp", F.when(F.col("kind") == "bad_ts", "yesterday").otherwise(iso_utc(F.col("ts_us"))))
    )
    text = (
        F.when(F.col("kind") == "cut", F.expr(_CUT))
        .when(F.col("kind") == "idle", F.expr(_IDLE))
        .when(F.col("event_id") % 2 == 0, F.expr(_SINGLE))
        .otherwise(F.expr(_PRETTY))
    )
    day = F.substring(iso_utc(F.col("ts_us")), 1, 10)
    return rows.select(
        "event_id",
        "user_id",
        "prefix",
        cluster_of(F.col("user_id")).alias("cluster_id"),
        _file_key(day).alias("path"),
        F.col("event_id").alias("entry_no"),
        text.alias("text"),
    )


def _file_key(day: Column) -> Column:
    """Hourly names, but for two kinds of cluster: no hour at all, and an impossible hour."""
    folder = F.concat(F.lit("logs/"), cluster_of(F.col("user_id")), F.lit("/"))
    return (
        F.when(F.col("user_id") % 10 == 3, F.concat(folder, F.lit("driver-"), day, F.lit(".log")))
        .when(F.col("user_id") % 10 == 4, F.concat(folder, F.lit("log4j-"), day, F.lit("-25.log.gz")))
        .otherwise(F.concat(folder, F.lit("log4j-"), day, F.lit("-00.log.gz")))
    )


def log_texts(spark: SparkSession, sf_dir: str, preamble: bool = True) -> DataFrame:
    """A small log file per event: a headerless tail, the entry, an unrelated multi-line entry.

    ``head`` is the file without its last entry.
    """
    start = [F.lit(PREAMBLE + "\n")] if preamble else []
    head = F.concat(*start, "text", F.lit("\n"))
    return log_entries(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("logs/"), "cluster_id", F.lit("/"), F.col("event_id").cast("string"), F.lit(".log.gz")).alias("path"),
        F.concat(head, F.expr(_UNRELATED), F.lit("\n")).alias("text"),
        head.alias("head"),
    )


def log_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as bytes: gzip, plain, with broken UTF-8, and gzip that breaks off after
    the head, a few bytes into its second member."""

    def encode(batches):
        import gzip

        import pyarrow as pa

        for batch in batches:
            out = []
            for event, path, text, head in zip(*(batch[n].to_pylist() for n in ("event_id", "path", "text", "head"))):
                raw, kept = text.encode(), gzip.compress(head.encode(), mtime=0)
                content = (gzip.compress(raw, mtime=0), raw, b"\xff\xfe" + raw, kept + kept[:5])[event % 4]
                out.append((path, content))
            path, content = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(content, pa.binary())], names=["path", "content"])

    return log_texts(spark, sf_dir).mapInArrow(encode, "path STRING, content BINARY")


def _store_files(root: str, plain: bool):
    """Writes ``path, text`` rows as log files below ``root``; returns their paths."""

    def content(path: str, raw: bytes) -> bytes:
        kind = 1 if plain else sum(path.encode()) % 4
        if kind == 0:
            return zlib.compress(raw, wbits=31)
        if kind == 1:
            return raw
        if kind == 2:
            return b"\xff\xfe\n" + raw
        packer = zlib.compressobj(wbits=31)
        head = packer.compress(raw) + packer.flush(zlib.Z_FULL_FLUSH)
        tail = packer.compress(b"a line that never ends " * 500) + packer.flush()
        return head + tail[: len(tail) // 2]

    def store(batches):
        for batch in batches:
            for path, text in zip(batch["path"].to_pylist(), batch["text"].to_pylist()):
                target = f"{root.removeprefix('file:')}/{path.removeprefix('logs/')}"
                if plain:
                    target = target.removesuffix(".gz")
                try:
                    file = open(target, "wb")
                except FileNotFoundError:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    file = open(target, "wb")
                with file:
                    file.write(content(path, text.encode()))
            yield pa.RecordBatch.from_arrays([batch["path"]], ["path"])

    return store


def _write_logs(rows: DataFrame, root: str, plain: bool) -> None:
    """The log files of some events, by cluster and day."""
    entry = F.struct("entry_no", "text")
    text = F.concat(F.array_join(F.sort_array(F.collect_list(entry))["text"], "\n"), F.lit("\n"))
    entries_of(rows).groupBy("path").agg(text.alias("text")).mapInArrow(_store_files(root, plain), "path STRING").count()


def _deliveries(spark: SparkSession, sf_dir: str, base: str, plain: bool) -> Iterator[str]:
    """Folders with the log files of some clusters each; a folder goes when the next one is asked for, the last one stays.

    A file takes a block of the disk however small it is, so the files of all clusters at once would take many times
    the size of ``events``. A delivery comes from about ``EVENTS_AT_ONCE`` events, and no file has less than one.
    """
    rows = events(spark, sf_dir)
    parts = max(1, -(-spark.read.parquet(f"{sf_dir}/events.parquet").count() // EVENTS_AT_ONCE))
    if parts > 1:
        dealt = scratch_path(spark, "events")
        rows = rows.withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int"))
        write(rows, dealt, "part")
        rows = spark.read.schema(rows.schema).parquet(dealt)
    root = None
    for part in range(parts):
        here = rows.filter(F.col("part") == part).drop("part") if parts > 1 else rows
        if parts > 1 and here.isEmpty():
            continue
        if root is not None:
            remove_log_files(spark, root)
        root = f"{base}/logs/{part}"
        _write_logs(here, root, plain)
        yield root


def write_run(spark: SparkSession, sf_dir: str, base: str, plain: bool = False) -> tuple[Iterator[str], str, str]:
    """A run's inputs as files: logs by cluster and day, the manifest and the rules; returns their paths.

    The logs come in deliveries of whole clusters, written one after the other as they are asked for.
    Of the log files some are gzip, some plain text under a gzip name, some have broken UTF-8 in
    front, and some break off inside a compressed block. ``plain`` writes them all as text.
    """
    listed = F.to_json(F.struct("cluster_id", "initial_workers", "num_log_files"))
    document = F.concat(F.lit('{"clusters": ['), F.array_join(F.collect_list(listed), ", "), F.lit("]}"))
    manifest(spark, sf_dir).agg(document.alias("value")).coalesce(1).write.text(f"{base}/clusters")
    lines = "".join("- {" + ", ".join(f"{f.name}: {getattr(rule, f.name)}" for f in fields(rule)) + "}\n" for rule in RULES)
    spark.createDataFrame([("rules:\n" + lines,)], "value STRING").coalesce(1).write.text(f"{base}/rules")
    return _deliveries(spark, sf_dir, base, plain), f"{base}/clusters", f"{base}/rules"


# --- files, manifest, notifications (FIXTURES.md B4) -----------------------------------


def log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct files: ``cluster_id, user_id, day, key``."""
    day = F.substring(iso_utc(F.col("ts_us")), 1, 10)
    rows = events(spark, sf_dir).select("user_id", day.alias("day")).distinct()
    return rows.select(cluster_of(F.col("user_id")).alias("cluster_id"), "user_id", "day", _file_key(F.col("day")).alias("key"))


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the store holds: some notified files are missing."""
    number = F.substring("day", 9, 2).cast("int")
    return (
        log_files(spark, sf_dir)
        .filter((F.col("user_id") + number) % 13 != 0)
        .select("key", (F.col("user_id") * 100 + number).alias("length"))
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per cluster; for every eighth user one file more than there is."""
    files = log_files(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("days"))
    return files.select(
        cluster_of(F.col("user_id")).alias("cluster_id"),
        F.lit(INITIAL_WORKERS).cast("bigint").alias("initial_workers"),
        (F.col("days") + F.when(F.col("user_id") % 8 == 5, 1).otherwise(0)).alias("num_log_files"),
    )


def manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON manifests of at most 100 clusters each, some entries faulty."""
    entry = F.expr(
        "case when user_id % 19 = 7 then '\"not a mapping\"' else concat('{\"cluster_id\":\"', "
        "case when user_id % 9 = 0 then '' when user_id % 17 = 3 then 'cluster-twice' else concat('cluster-', user_id) end, "
        "'\",\"initial_workers\":', case when user_id % 11 = 5 then '-1' when user_id % 13 = 6 then '\"4\"' else '4' end, "
        "',\"num_log_files\":', if(user_id % 15 = 8, 0, user_id % 30 + 1), '}') end"
    )
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    listed = users.groupBy(F.floor(F.col("user_id") / 100).alias("doc")).agg(
        F.array_sort(F.collect_list(F.struct("user_id", entry.alias("entry")))).alias("items")
    )
    return listed.select(
        F.concat(F.lit("manifest-"), F.col("doc").cast("string")).alias("doc_id"),
        F.concat(F.lit('{"clusters": ['), F.array_join("items.entry", ", "), F.lit("]}")).alias("text"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages ``message_id, body``: one per file, some twice, some broken."""
    number = F.substring("day", 9, 2).cast("int")
    files = log_files(spark, sf_dir).withColumn("body", F.expr(
        "concat('{\"bucket\":\"driver-logs\",\"key\":\"', key, '\",\"cluster_id\":\"', cluster_id, '\",\"extra\":1}')"
    )).withColumn("name", F.concat("cluster_id", F.lit("-"), "day"))
    once = files.select(F.concat(F.lit("m-"), "name").alias("message_id"), "body")
    again = files.filter((F.col("user_id") + number) % 11 == 0).select(F.concat(F.lit("again-"), "name").alias("message_id"), "body")
    broken = events(spark, sf_dir).filter((F.col("event_id") % 100).between(1, 4)).select(
        F.concat(F.lit("b-"), F.col("event_id").cast("string")).alias("message_id"),
        F.expr(
            "case event_id % 100 when 1 then concat('{\"bucket\":\"driver-logs\",\"key\":\"k\",\"cluster_id\":\"ghost-', user_id, '\"}') "
            "when 2 then concat('{\"bucket\":\"driver-logs\",\"key\":\"\",\"cluster_id\":\"cluster-', user_id, '\"}') "
            "when 3 then '[]' else 'not json' end"
        ).alias("body"),
    )
    return once.unionByName(again).unionByName(broken)


# --- raw rules (FIXTURES.md B5) --------------------------------------------------------


def raw_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw rule per event in the rule set of its user, with every kind of fault."""
    def text(value: str, kind: str) -> list[Column]:
        return [F.expr(value), F.expr(kind)]

    fields = {
        "name": text("if(event_id % 17 = 0, null, concat('r', event_id % 200))", "if(event_id % 17 = 0, null, 'str')"),
        "metric": text("if(event_id % 31 = 0, '', 'batchDuration')", "'str'"),
        "aggregation": text("if(event_id % 5 = 0, 'median', 'avg')", "'str'"),
        "operator": text("if(event_id % 7 = 0, 'gte', 'gt')", "'str'"),
        "threshold": text("element_at(array('5e9', 'five', '2.5', 'True'), cast(event_id % 4 as int) + 1)",
                          "element_at(array('str', 'str', 'float', 'bool'), cast(event_id % 4 as int) + 1)"),
        "window_minutes": text("if(event_id % 6 = 0, '0', '15')", "if(event_id % 12 = 0, 'int', 'str')"),
        "min_batches": text("case when event_id % 9 = 0 then '1.5' when event_id % 8 = 0 then '0' else '3.0' end", "'float'"),
        "target_workers": text("if(event_id % 10 = 0, '-1', cast(k as string))", "'int'"),
        "cooldown_minutes": text("if(event_id % 23 = 0, null, '20.0')", "if(event_id % 23 = 0, null, 'str')"),
    }
    columns = [c for name, (value, kind) in fields.items() for c in (value.alias(name), kind.alias(f"{name}_type"))]
    return events(spark, sf_dir).select(
        F.concat(F.lit("rules-"), F.col("user_id").cast("string")).alias("ruleset"),
        F.col("event_id").cast("int").alias("rule_ord"),
        *columns,
    )


def rules_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rules document in JSON form per event."""
    return events(spark, sf_dir).select(
        F.concat(F.lit("rules-"), F.col("event_id").cast("string")).alias("doc_id"),
        F.expr(
            "concat('{\"rules\": [{\"name\": \"up-', user_id, '\", \"metric\": \"batchDuration\", \"aggregation\": \"avg\", \"operator\": \"gt\", "
            "\"threshold\": \"5e9\", \"window_minutes\": ', k + 1, ', \"min_batches\": \"3.0\", \"target_workers\": \"8\", \"cooldown_minutes\": 20}, "
            "{\"name\": \"down-', user_id, '\", \"metric\": \"source.k\", \"aggregation\": \"max\", \"operator\": \"lt\", "
            "\"threshold\": ', cents, ', \"window_minutes\": 30, \"min_batches\": 5, \"target_workers\": 2, \"cooldown_minutes\": true}]}')"
        ).alias("text"),
    )
