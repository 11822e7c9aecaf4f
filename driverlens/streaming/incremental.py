"""The walk over arriving records, with bounded state.

Each micro-batch runs the same operators as the batch plan on what can be decided now:

* a cluster's *frontier* is the earliest time among its new records; records before it are
  final, later ones wait for the next micro-batch (a record is logged into its own file or
  the next one, never later);
* evaluated records stay as look-back for the widest rule window, keys of seen records two
  hours longer.

State is a few tables per micro-batch in ``state_dir``, spread by Spark's own hash
partitioning: no task ever holds a whole cluster. Every write goes to a folder named
by the micro-batch number and replaces what a failed try left there; the stream's checkpoint
repeats a micro-batch until it succeeds, so the outcome is the same after any loss. A
micro-batch reads the state of the one before it only, so older folders are removed when it
begins: state does not grow with the length of the stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.functions.timegrid import MINUTE_US
from driverlens.operators.recordset import RECORD_KEY, RECORD_SCHEMA
from driverlens.operators.rules import Rule
from driverlens.plans.decide import walk_records
from driverlens.session import children, remove, run_id, scratch_scope
from driverlens.sources.decision_table import put_decisions, read_write

DEDUP_MARGIN_US = 120 * MINUTE_US  # fixed value: two hours beyond the look-back

PAYLOAD = ["ts_us", "ts_raw", "metrics", "file_ord", "entry_no"]
RECORD_COLUMNS = RECORD_KEY + PAYLOAD
STATE_SCHEMAS = {
    "arrived": RECORD_SCHEMA + ", copies BIGINT, is_new BOOLEAN, is_late BOOLEAN",
    "pool": RECORD_SCHEMA + ", frontier_us BIGINT, is_ready BOOLEAN",
    "lookback": RECORD_SCHEMA,
    "seen": "cluster_id STRING, id STRING, batch_id BIGINT, ts_us BIGINT",
    "clusters": "cluster_id STRING, workers BIGINT, last_us BIGINT, walked_us BIGINT",
    "stats": "cluster_id STRING, records_seen BIGINT, unique_records BIGINT, late_records BIGINT, evaluation_points BIGINT, peak_held_records BIGINT",
}


@dataclass(frozen=True)
class IncrementalWalk:
    """Folders and control data of one incremental run."""

    rules: list[Rule]
    manifest: DataFrame  # cluster_id, initial_workers
    state_dir: str
    table: str
    keep: int = 2  # micro-batches whose state stays: the present one and the one before

    def _run(self, spark: SparkSession) -> str:
        return run_id(spark, self.state_dir)

    def _forget(self, spark: SparkSession, epoch: int) -> None:
        for name in children(spark, self.state_dir):
            if name.startswith("epoch=") and int(name.removeprefix("epoch=")) <= epoch - max(2, self.keep):
                remove(spark, f"{self.state_dir}/{name}")

    def start(self, records: DataFrame, checkpoint: str):
        """Process what has arrived as one streaming query; ``records`` is a stream."""
        return (
            records.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def state(self, spark: SparkSession, name: str, epoch: int) -> DataFrame:
        """One state table as micro-batch ``epoch`` left it; empty before the first."""
        if epoch < 0:
            return spark.createDataFrame([], STATE_SCHEMAS[name])
        return spark.read.schema(STATE_SCHEMAS[name]).parquet(f"{self.state_dir}/epoch={epoch}/{name}")

    def process(self, batch: DataFrame, epoch: int) -> None:
        """One micro-batch. Records of clusters the manifest does not list are dropped."""
        spark = batch.sparkSession
        self._forget(spark, epoch)
        known = batch.join(self.manifest.select("cluster_id"), "cluster_id", "left_semi")
        copies = known.groupBy(*RECORD_KEY).agg(
            F.count("*").alias("copies"), F.min_by(F.struct(*PAYLOAD), F.struct("file_ord", "entry_no")).alias("r")
        )
        seen = self.state(spark, "seen", epoch - 1).select(*RECORD_KEY, F.lit(True).alias("was_seen"))
        walked_to = self.state(spark, "clusters", epoch - 1).select("cluster_id", "walked_us")
        is_new = F.col("was_seen").isNull()
        self._store(
            copies.join(seen, RECORD_KEY, "left").join(walked_to, "cluster_id", "left").select(
                *RECORD_KEY, "r.*", "copies", is_new.alias("is_new"),
                F.coalesce(is_new & (F.col("r.ts_us") < F.col("walked_us")), F.lit(False)).alias("is_late"),
            ),
            "arrived", epoch,
        )
        new = self.state(spark, "arrived", epoch).filter("is_new").select(*RECORD_COLUMNS)
        frontier = new.groupBy("cluster_id").agg(F.min("ts_us").alias("frontier_us"))
        pool = self.pending(spark, epoch - 1).unionByName(new).join(frontier, "cluster_id", "left")
        is_ready = F.coalesce(F.col("ts_us") < F.col("frontier_us"), F.lit(False))
        arrived = self.state(spark, "arrived", epoch).groupBy("cluster_id").agg(
            F.sum("copies").alias("records_seen"),
            F.count_if("is_new").alias("unique_records"),
            F.count_if("is_late").alias("late_records"),
        )
        self._advance(spark, epoch, pool.withColumn("is_ready", is_ready), new, arrived)

    def finish(self, spark: SparkSession, epoch: int) -> None:
        """End of input: everything that still waits is final."""
        pool = self.pending(spark, epoch - 1)
        no_frontier = F.lit(None).cast("bigint")
        none_new = spark.createDataFrame([], RECORD_SCHEMA)
        none = spark.createDataFrame([], "cluster_id STRING, records_seen BIGINT, unique_records BIGINT, late_records BIGINT")
        self._forget(spark, epoch)
        self._advance(spark, epoch, pool.withColumns({"frontier_us": no_frontier, "is_ready": F.lit(True)}), none_new, none)

    def pending(self, spark: SparkSession, epoch: int) -> DataFrame:
        """Records that wait for a later micro-batch to confirm them."""
        return self.state(spark, "pool", epoch).filter(~F.col("is_ready")).select(*RECORD_COLUMNS)

    def _advance(self, spark: SparkSession, epoch: int, pool: DataFrame, new: DataFrame, arrived: DataFrame) -> None:
        with scratch_scope(spark):
            self._walk(spark, epoch, pool, new, arrived)

    def _walk(self, spark: SparkSession, epoch: int, pool: DataFrame, new: DataFrame, arrived: DataFrame) -> None:
        self._store(pool, "pool", epoch)
        pool = self.state(spark, "pool", epoch)
        lookback, clusters = self.state(spark, "lookback", epoch - 1), self.state(spark, "clusters", epoch - 1)
        ready = pool.filter("is_ready").select(*RECORD_COLUMNS)
        flushed = pool.filter("is_ready").groupBy("cluster_id").agg(F.max("frontier_us").alias("frontier_us"))

        # Walk the final records, with the look-back of the clusters that have any.
        context = lookback.join(flushed.select("cluster_id"), "cluster_id", "left_semi")
        points = ready.withColumn("is_point", F.lit(True)).unionByName(context.withColumn("is_point", F.lit(False)))
        workers = F.coalesce("workers", F.col("initial_workers").cast("bigint")).alias("workers")
        entered = self.manifest.join(clusters, "cluster_id", "left").select("cluster_id", workers, "last_us", "walked_us")
        run = walk_records(points, entered, self.rules)
        put_decisions(run.decisions, self.table, epoch, self._run(spark))

        # The next state. Only clusters that were walked are pruned.
        made = read_write(spark, self.table, self._run(spark), epoch)
        latest = made.groupBy("cluster_id").agg(F.max_by(F.struct("to_workers", "walk_ts_us"), "walk_ts_us").alias("d"))
        self._store(
            entered.join(latest, "cluster_id", "left").join(flushed, "cluster_id", "left").select(
                "cluster_id",
                F.coalesce("d.to_workers", "workers").alias("workers"),
                F.coalesce("d.walk_ts_us", "last_us").alias("last_us"),
                F.coalesce("frontier_us", "walked_us").alias("walked_us"),
            ),
            "clusters", epoch,
        )
        window_us = max((r.window_minutes for r in self.rules), default=0) * MINUTE_US
        keys = self.state(spark, "seen", epoch - 1).unionByName(new.select(*RECORD_KEY, "ts_us"))
        self._store(_younger(lookback.unionByName(ready), flushed, window_us), "lookback", epoch)
        self._store(_younger(keys, flushed, window_us + DEDUP_MARGIN_US), "seen", epoch)
        self._count(spark, epoch, arrived, pool, lookback)

    def _store(self, df: DataFrame, name: str, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.state_dir}/epoch={epoch}/{name}")

    def _count(self, spark: SparkSession, epoch: int, arrived: DataFrame, pool: DataFrame, lookback: DataFrame) -> None:
        """Totals so far: those of the micro-batch before, and what this one adds."""
        # What a micro-batch holds: its pool, and the look-back the one before left.
        both = pool.select("cluster_id", "is_ready").unionByName(lookback.select("cluster_id", F.lit(False).alias("is_ready")))
        held = both.groupBy("cluster_id").agg(F.count_if("is_ready").alias("evaluation_points"), F.count("*").alias("peak_held_records"))
        rows = self.state(spark, "stats", epoch - 1).unionByName(arrived, True).unionByName(held, True)
        sums = ("records_seen", "unique_records", "late_records", "evaluation_points")
        totals = [F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias(n) for n in sums]
        self._store(rows.groupBy("cluster_id").agg(*totals, F.max("peak_held_records").alias("peak_held_records")), "stats", epoch)

    def stats(self, spark: SparkSession, epochs: int) -> DataFrame:
        """Per cluster, after ``epochs`` micro-batches and the finish: records seen, unique,
        evaluated and late, and the most held at once."""
        return self.state(spark, "stats", epochs)


def _younger(rows: DataFrame, flushed: DataFrame, keep_us: int) -> DataFrame:
    """Rows of walked clusters younger than ``keep_us`` before the frontier; others as they are.

    At the end of input there is no frontier and everything stays.
    """
    limit = F.col("frontier_us") - keep_us
    return rows.join(flushed.select("cluster_id", "frontier_us"), "cluster_id", "left").filter(
        F.coalesce(F.col("ts_us") > limit, F.lit(True))
    ).drop("frontier_us")
