"""The record set of a cluster: duplicate removal, total order, accounting.

A record row is ``cluster_id, id, batch_id, ts_us, ts_raw, metrics, file_ord, entry_no``:
``ts_us`` is event time in microseconds, ``metrics`` a map of finite doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driverlens.functions.timegrid import minute_of

RECORD_KEY = ["cluster_id", "id", "batch_id"]
RECORD_SCHEMA = (
    "cluster_id STRING, id STRING, batch_id BIGINT, ts_us BIGINT, ts_raw STRING, "
    "metrics MAP<STRING,DOUBLE>, file_ord INT, entry_no BIGINT"
)


def dedup_records(records: DataFrame) -> DataFrame:
    """One row per ``(cluster_id, id, batch_id)``: the first copy in file, then entry order.

    An aggregate, not a ranked window: copies are folded on the map side, so a batch that
    was logged a billion times sends one row per task over the network.
    """
    rest = [c for c in records.columns if c not in RECORD_KEY]
    first = F.min_by(F.struct(*rest), F.struct("file_ord", "entry_no"))
    return records.groupBy(*RECORD_KEY).agg(first.alias("r")).select(*RECORD_KEY, "r.*")


def dedup_stats(records: DataFrame) -> DataFrame:
    """Records seen, unique and duplicate, per cluster; both steps combine on the map side."""
    copies = records.groupBy(*RECORD_KEY).agg(F.count("*").alias("copies"))
    return copies.groupBy("cluster_id").agg(
        F.sum("copies").alias("records_seen"),
        F.count("*").alias("unique_records"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
    )


def ranked(df: DataFrame, group: list[str], buckets: list[Column], order: list[Column], name: str) -> DataFrame:
    """1-based position inside ``group`` by ``order``, without sorting a group in one task.

    ``buckets`` must cut the order into ever finer consecutive runs. Rows are numbered inside
    their finest bucket only; what lies before it is added up from the buckets' counts, level
    by level, each level inside one bucket of the level above.
    """
    levels = [f"_bucket{i}" for i in range(len(buckets))]
    placed = df.withColumns(dict(zip(levels, buckets)))
    counts = placed.groupBy(*group, *levels).agg(F.count("*").alias("_rows"))
    offsets = None
    for depth in range(1, len(levels) + 1):
        outer, inner = [*group, *levels[: depth - 1]], levels[depth - 1]
        before = W.partitionBy(*outer).orderBy(inner).rowsBetween(W.unboundedPreceding, -1)
        here = counts.groupBy(*outer, inner).agg(F.sum("_rows").alias("_rows"))
        here = here.select(*outer, inner, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_here"))
        if offsets is None:
            offsets = here.withColumnRenamed("_here", "_offset")
        else:
            total = F.col("_offset") + F.col("_here")
            offsets = here.join(offsets, outer).select(*outer, inner, total.alias("_offset"))
    finest = W.partitionBy(*group, *levels).orderBy(*order)
    return (
        placed.withColumn("_local", F.row_number().over(finest))
        .join(offsets, [*group, *levels])
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop(*levels, "_local", "_offset")
    )


BATCH_RUN = 65_536


def record_order(records: DataFrame) -> DataFrame:
    """``walk_ord``: position by ``(ts, batch_id)``, ``id`` as the tie-break, per cluster.

    Minutes, then times, then runs of batch numbers: a single time may hold most records.
    """
    buckets = [minute_of(F.col("ts_us")), F.col("ts_us"), F.floor(F.col("batch_id") / BATCH_RUN)]
    return ranked(records, ["cluster_id"], buckets, [F.col("batch_id"), F.col("id")], "walk_ord")
