"""Log files as a stream: what the two incremental runs take in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.operators.filesets import HOUR_US, file_hour_us
from driverlens.operators.records import progress_records
from driverlens.operators.rules import Rule
from driverlens.sources.logs import cluster_of_path, scan_entries
from driverlens.sources.ranges import scan_ranges

FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def arriving_files(spark: SparkSession, logs: str, contents: bool = True, files_at_once: int | None = None) -> DataFrame:
    """Files below ``logs`` as they appear, like ``sources.logs.read_log_files`` in a batch.

    Without ``contents`` a row is a path and a length, and the file is read in ranges, whatever its
    size. ``files_at_once`` bounds the files of a micro-batch.
    """
    stream = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    if files_at_once is not None:
        stream = stream.option("maxFilesPerTrigger", files_at_once)
    files = stream.schema(FILE_SCHEMA).load(logs)
    return files if contents else files.select("path", "length")


def _records(files: DataFrame, rules: list[Rule]) -> DataFrame:
    scan = scan_entries if "content" in files.columns else scan_ranges
    entries = scan(files, progress_only=True).withColumn("cluster_id", cluster_of_path(F.col("path")))
    records = progress_records(entries, sorted({r.metric for r in rules}))
    # Copies of a record within one micro-batch: the file of the earlier hour comes first.
    hour = F.coalesce(F.floor(file_hour_us(F.col("path")) / HOUR_US), F.lit(0)).cast("int")
    return records.withColumn("file_ord", hour)


def records_of(files: DataFrame, rules: list[Rule]) -> DataFrame:
    """Input of ``IncrementalWalk``."""
    return _records(files, rules).drop("path")


def arrivals_of(files: DataFrame, rules: list[Rule]) -> DataFrame:
    """Input of ``CompleteThenWalk``: the records, and one row per file whatever it holds."""
    records = _records(files, rules).withColumnRenamed("path", "key")
    seen = files.select(cluster_of_path(F.col("path")).alias("cluster_id"), F.col("path").alias("key"))
    return records.unionByName(seen, allowMissingColumns=True)
