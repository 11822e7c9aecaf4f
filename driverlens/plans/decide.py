"""From records to decisions, in one call."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from driverlens.operators.entries import entries_from_lines, read_lines
from driverlens.operators.filesets import complete_clusters, file_first_ts, file_order
from driverlens.operators.gates import decisions, point_outcomes, walk_ticks
from driverlens.operators.recordset import RECORD_SCHEMA, dedup_records
from driverlens.operators.records import progress_records
from driverlens.operators.rules import Rule
from driverlens.operators.windows import TYPICAL, evaluate, limbs_of, limbs_seen, matched_ticks, ticks
from driverlens.session import materialize, scratch_path, scratch_scope, small_files, write
from driverlens.sources.control import read_manifest, read_rules
from driverlens.sources.decision_table import put_decisions, read_decisions
from driverlens.sources.logs import cluster_of_path, list_log_files, opened_by_tasks, read_log_files, scan_entries
from driverlens.sources.ranges import scan_lines, scan_ranges

FILES_AT_ONCE = 500_000
FOLDER = "^(.*)/[^/]*$"
PACKED = r"\.(gz|bz2|deflate|snappy|lz4|zst)$"  # names by which Spark's text reader unpacks


@dataclass(frozen=True)
class Walk:
    """The tables of one run, all lazy but for the stored ticks."""

    ticks: DataFrame
    walked: DataFrame
    decisions: DataFrame


def store_ticks(records: DataFrame, rules: list[Rule]) -> DataFrame:
    """Ticks written once: evaluation reads them twice, decisions a third time.

    They are made for values of the usual size; what the same pass observes tells whether there were others,
    and only then they are made again with the columns that exact averages of those need.
    """
    marks = limbs_seen(records, rules)
    if not marks:
        return materialize(ticks(records, rules, frozenset()), "ticks")
    seen = Observation()
    table = materialize(ticks(records.observe(seen, *marks), rules, TYPICAL), "ticks")
    found = limbs_of(*(seen.get[f"limbs{i}"] for i in (0, 1)))
    return table if found <= TYPICAL else materialize(ticks(records, rules, found), "ticks")


def walk_records(records: DataFrame, initial: DataFrame, rules: list[Rule], **slices) -> Walk:
    """``records`` are unique already; ``initial`` is ``cluster_id, workers, last_us``."""
    table = store_ticks(records, rules)
    walked = walk_ticks(matched_ticks(evaluate(table, rules)), initial, rules, **slices)
    return Walk(table, walked, decisions(walked, table, rules))


def decide(records: DataFrame, initial: DataFrame, rules: list[Rule], **slices) -> DataFrame:
    """Scaling decisions of every cluster from raw, possibly repeated records."""
    return walk_records(dedup_records(records), initial, rules, **slices).decisions


def decision_points(records: DataFrame, initial: DataFrame, rules: list[Rule], **slices) -> DataFrame:
    """One row per record at which a rule matched, blocked ones included.

    ``last_decision_ts`` is the deciding record's own text. A decision from before this run is
    known by its time only, so ``initial`` may bring its text as ``last_ts``.
    """
    walk = walk_records(records, initial, rules, **slices)
    points = point_outcomes(walk.walked, records, walk.ticks, rules)
    made = walk.decisions.select("cluster_id", F.col("ts_us").alias("last_decision_us"), F.col("decision_ts").alias("last_decision_ts"))
    named = points.join(made, ["cluster_id", "last_decision_us"], "left")
    if "last_ts" not in initial.columns:
        return named
    before = initial.select("cluster_id", F.col("last_us").alias("last_decision_us"), "last_ts")
    joined = named.join(before, ["cluster_id", "last_decision_us"], "left")
    return joined.withColumn("last_decision_ts", F.coalesce("last_decision_ts", "last_ts")).drop("last_ts")


def _folder_groups(arrived: DataFrame) -> Iterator[list[str]]:
    """Folders of the files that arrived, as patterns that match them, in groups of about ``FILES_AT_ONCE`` files.

    One group is on the driver at a time, so that neither names nor Spark's own listing of them grow with the run.
    """
    folder = F.regexp_extract("key", FOLDER, 1).alias("folder")
    folders = materialize(arrived.groupBy(folder).agg(F.count("*").alias("files")), "folders")
    group, files = [], 0
    for row in folders.toLocalIterator():
        group.append(re.sub(r"([\\\[\]{}*?])", r"\\\1", row.folder))
        files += row.files
        if files >= FILES_AT_ONCE:
            yield sorted(group)
            group, files = [], 0
    if group:
        yield sorted(group)


def _found_in_files(spark: SparkSession, arrived: DataFrame) -> Iterator[DataFrame]:
    """Progress entries of whole files; contents are decoded where they are read and never joined."""
    for folders in _folder_groups(arrived):
        yield scan_entries(read_log_files(spark, folders), progress_only=True)


def _found_in_lines(spark: SparkSession, logs: str, arrived: DataFrame) -> Iterator[DataFrame]:
    """Progress entries of files read as lines, by tasks; folders with packed files are read by Spark, which unpacks them."""
    by_spark = arrived
    if opened_by_tasks(spark, logs):
        dealt = arrived.withColumn("folder", F.regexp_extract("key", FOLDER, 1))
        packed = dealt.filter(F.col("key").rlike(PACKED)).select("folder").distinct()
        plain = materialize(dealt.join(packed, "folder", "left_anti").select(F.col("key").alias("path"), "length"), "plain")
        by_spark = dealt.join(packed, "folder", "left_semi")
        if not plain.isEmpty():
            yield entries_from_lines(scan_lines(plain), progress_only=True)
    for folders in _folder_groups(by_spark):
        with small_files(spark):
            yield entries_from_lines(read_lines(spark, folders, recursive=True), progress_only=True)


def _found(spark: SparkSession, logs: str, arrived: DataFrame, as_lines: bool, in_ranges: bool) -> Iterator[DataFrame]:
    if in_ranges:
        yield scan_ranges(arrived.select(F.col("key").alias("path"), "length"), progress_only=True)
    else:
        yield from _found_in_lines(spark, logs, arrived) if as_lines else _found_in_files(spark, arrived)


def _check_deliveries(listing: DataFrame) -> None:
    """Each cluster's files have to come together: completeness is known of a delivery, and only then are they opened."""
    if listing.filter("delivery > 0").isEmpty():
        return
    spread = listing.groupBy("cluster_id").agg(F.min("delivery").alias("first"), F.max("delivery").alias("last"))
    if (found := spread.filter("first < last").first()) is not None:
        raise ValueError(f"the files of {found.cluster_id} come in more than one delivery")


def decide_from_logs(
    spark: SparkSession,
    logs: str | Iterable[str],
    manifest_path: str,
    rules_path: str,
    table: str | None = None,
    run: str | None = None,
    as_lines: bool = False,
    in_ranges: bool = False,
) -> DataFrame:
    """The whole run: log folder, manifest and rules in, decisions out (and stored).

    ``as_lines`` reads splittable text line by line, for plain files of any size; otherwise
    each file is decoded from its bytes, gzip or not. ``in_ranges`` does so in byte ranges read from
    the store, for gzip and plain files of any size. A run repeated under the same ``run`` replaces its
    own rows.

    ``logs`` may also be several log folders, each with all files of its clusters. They are read one after the other, and one
    is not needed any more once the next is asked for: logs that the disk does not hold at once may be fetched in deliveries.
    """
    if table is not None:
        with scratch_scope(spark):
            made = decide_from_logs(spark, logs, manifest_path, rules_path, as_lines=as_lines, in_ranges=in_ranges)
            put_decisions(made, table, run=run)
        return read_decisions(spark, table)
    rules = read_rules(spark, rules_path)
    manifest = materialize(read_manifest(spark, manifest_path), "manifest")
    metrics = sorted({r.metric for r in rules})
    at = {label: scratch_path(spark, label) for label in ("listing", "complete", "records")}
    schemas = {}

    def store(rows: DataFrame, label: str) -> None:
        schemas[label] = rows.schema
        write(rows, at[label])

    def stored(label: str) -> DataFrame:
        return spark.read.schema(schemas[label]).parquet(at[label]).hint("merge")

    for number, folder in enumerate([logs] if isinstance(logs, str) else logs):
        with scratch_scope(spark):
            # The listing never opens a file. A file counts as arrived even if no progress entry is in it.
            listing = list_log_files(spark, folder).select(cluster_of_path(F.col("path")).alias("cluster_id"), F.col("path").alias("key"), "length")
            complete = materialize(complete_clusters(listing, manifest).select("cluster_id", "initial_workers"), "complete")
            store(listing.withColumn("delivery", F.lit(number)), "listing")
            store(complete, "complete")
            # Only the folders of complete, known clusters are opened.
            arrived = listing.join(complete, "cluster_id", "left_semi")
            for found in _found(spark, folder, arrived, as_lines, in_ranges):
                with small_files(spark):
                    store(progress_records(found.withColumn("cluster_id", cluster_of_path(F.col("path"))), metrics), "records")
    if schemas:
        _check_deliveries(stored("listing"))
    if "records" not in schemas:
        nobody = spark.createDataFrame([], "cluster_id STRING, workers BIGINT, last_us BIGINT")
        return decide(spark.createDataFrame([], RECORD_SCHEMA), nobody, rules)
    records, listing, complete = map(stored, ("records", "listing", "complete"))
    first_times = file_first_ts(records).withColumnRenamed("path", "key")
    order = file_order(listing.drop("delivery"), first_times).select("cluster_id", F.col("key").alias("path"), "file_ord")
    initial = complete.select(
        "cluster_id", F.col("initial_workers").alias("workers"), F.lit(None).cast("bigint").alias("last_us")
    )
    return decide(records.join(order, ["cluster_id", "path"]).drop("path"), initial, rules)
