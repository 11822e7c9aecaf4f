"""Sets of log files per cluster: hours, order, completeness, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driverlens.operators.recordset import ranked

# Fixed value: hourly file names end in -YYYY-MM-DD-HH.log or .log.gz.
FILE_HOUR = r"(\d{4})-(\d{2})-(\d{2})-(\d{2})\.log(?:\.gz)?$"
HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
FAR_FUTURE_US = 253_402_300_799_999_999  # the last microsecond of year 9999


def file_hour_us(key: Column) -> Column:
    """The hour a file covers, from its name; NULL without one or for an impossible date."""
    year, month, day, hour = (F.regexp_extract(key, FILE_HOUR, i) for i in range(1, 5))
    text = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit("T"), hour, F.lit(":00:00Z"))
    return F.when(key.rlike(FILE_HOUR) & (year != "0000"), F.unix_micros(text.try_cast("timestamp")))


def file_hours(files: DataFrame) -> DataFrame:
    return files.withColumn("hour_us", file_hour_us(F.col("key")))


def file_first_ts(records: DataFrame) -> DataFrame:
    """Time of the first valid record of every file; combined on the map side."""
    return records.groupBy("path").agg(F.min_by("ts_us", "entry_no").alias("first_ts_us"))


def file_order(files: DataFrame, first_times: DataFrame) -> DataFrame:
    """``file_ord`` per cluster. ``files``: ``cluster_id, key``; ``first_times``: ``key, first_ts_us``.

    By hour if all of a cluster's names carry one, else by the first record's time, files
    without records last; the key breaks ties.
    """
    hours = file_hours(files)
    named = hours.groupBy("cluster_id").agg(F.bool_and(F.col("hour_us").isNotNull()).alias("all_named"))
    placed = (
        hours.join(named, "cluster_id")
        .join(first_times.select("key", "first_ts_us"), "key", "left")
        .withColumn(
            "at_us",
            F.when(F.col("all_named"), F.col("hour_us")).otherwise(F.coalesce("first_ts_us", F.lit(FAR_FUTURE_US))),
        )
    )
    day = F.floor(F.col("at_us") / DAY_US)
    ordered = ranked(placed, ["cluster_id"], [day], [F.col("at_us"), F.col("key")], "file_ord")
    return ordered.select("cluster_id", "key", "hour_us", "all_named", "file_ord")


def known_notifications(notifications: DataFrame, manifest: DataFrame) -> DataFrame:
    return notifications.join(manifest.select("cluster_id"), "cluster_id", "left_semi")


def unknown_clusters(notifications: DataFrame, manifest: DataFrame) -> DataFrame:
    return notifications.join(manifest.select("cluster_id"), "cluster_id", "left_anti")


def existing_files(notifications: DataFrame, listing: DataFrame) -> DataFrame:
    """Notified files that exist, with their size. ``listing``: ``key, length``."""
    return notifications.join(listing.select("key", "length"), "key")


def missing_files(notifications: DataFrame, listing: DataFrame) -> DataFrame:
    return notifications.join(listing.select("key"), "key", "left_anti")


def cluster_completeness(notifications: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct files received per manifest cluster, and whether that is all of them.

    Two map-side combined aggregates: a file announced a million times stays one row.
    """
    keys = notifications.groupBy("cluster_id", "key").agg(F.lit(1).alias("one"))
    received = keys.groupBy("cluster_id").agg(F.count("*").alias("files_received"))
    got = F.coalesce("files_received", F.lit(0).cast("bigint"))
    return manifest.join(received, "cluster_id", "left").select(
        "cluster_id",
        "initial_workers",
        "num_log_files",
        got.alias("files_received"),
        (got >= F.col("num_log_files")).alias("is_complete"),
    )


def complete_clusters(notifications: DataFrame, manifest: DataFrame) -> DataFrame:
    return cluster_completeness(notifications, manifest).filter("is_complete")


def cluster_status(completeness: DataFrame, records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Progress per cluster. ``records`` are unique; a cluster counts once it is complete."""
    unique = records.groupBy("cluster_id").agg(F.count("*").alias("unique_records"))
    made = decisions.groupBy("cluster_id").agg(F.count("*").alias("decisions"))
    zero = F.lit(0).cast("bigint")
    done = F.col("is_complete")
    return (
        completeness.join(unique, "cluster_id", "left")
        .join(made, "cluster_id", "left")
        .select(
            "cluster_id",
            "initial_workers",
            "num_log_files",
            "files_received",
            F.when(done, F.coalesce("unique_records", zero)).otherwise(zero).alias("unique_records"),
            done.alias("evaluated"),
            F.when(done, F.coalesce("decisions", zero)).otherwise(zero).alias("decisions"),
        )
    )


def run_status(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count("*").alias("clusters_total"),
        F.count_if("evaluated").alias("clusters_processed"),
        F.bool_and("evaluated").alias("all_clusters_processed"),
    )
