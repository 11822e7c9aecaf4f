"""Files in any order: nothing is evaluated before a cluster's set is complete.

Micro-batches append records to a table; the files known so far of open clusters, and the
clusters that are done, are carried on from micro-batch to micro-batch, and older states of
these two are removed. A cluster is walked once, by the batch plan over its stored records, in
the micro-batch that completes it; files that arrive after that are ignored.

Arrivals are a log by micro-batch and bucket. Once half of a bucket's rows are of walked clusters,
the rest is written as the bucket's new base, and what lies before the base is removed by the next
micro-batch. So a row is rewritten once on average, and the log stays below twice the open rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.operators.filesets import complete_clusters
from driverlens.operators.rules import Rule
from driverlens.plans.decide import decide
from driverlens.session import children, remove, run_id, scratch_scope
from driverlens.sources.decision_table import put_decisions
from driverlens.streaming.incremental import RECORD_SCHEMA

ARRIVAL_SCHEMA = RECORD_SCHEMA + ", key STRING"
FILE_SCHEMA = "cluster_id STRING, key STRING"
DONE_SCHEMA = "cluster_id STRING"
BASE_SCHEMA = "bucket INT, base INT, stored BIGINT, walked BIGINT"
BUCKETS = 16


@dataclass(frozen=True)
class CompleteThenWalk:
    rules: list[Rule]
    manifest: DataFrame  # cluster_id, initial_workers, num_log_files
    state_dir: str
    table: str

    def start(self, arrivals: DataFrame, checkpoint: str):
        """``arrivals``: records with the ``key`` of their file. A file without any valid
        record arrives as one row with a NULL ``id``, or its cluster would never complete."""
        return (
            arrivals.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def _state(self, spark: SparkSession, name: str, schema: str, epoch: int) -> DataFrame:
        """A carried table as micro-batch ``epoch`` left it; empty before the first."""
        if epoch < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.state_dir}/{name}/epoch={epoch}")

    def _forget(self, spark: SparkSession, epoch: int, bases: dict[int, list[int]]) -> None:
        """Remove states that no micro-batch from ``epoch`` on reads, and arrivals that bases stand for."""
        for name in ("files", "done", "bases"):
            for folder, number in self._epochs(spark, name):
                if number < epoch - 1:
                    remove(spark, f"{self.state_dir}/{name}/{folder}")
        for name, past in (("arrivals", 1), ("kept", 0)):
            for folder, number in self._epochs(spark, name):
                path, over = f"{self.state_dir}/{name}/{folder}", [b for b, (base, _, _) in bases.items() if number < base + past]
                if len(over) == BUCKETS:
                    remove(spark, path)
                else:
                    for bucket in over:
                        remove(spark, f"{path}/bucket={bucket}")

    def _epochs(self, spark: SparkSession, name: str) -> list[tuple[str, int]]:
        folders = children(spark, f"{self.state_dir}/{name}")
        return [(f, int(f.removeprefix("epoch="))) for f in folders if f.startswith("epoch=")]

    def _bases(self, spark: SparkSession, epoch: int) -> dict[int, list[int]]:
        """Per bucket: the micro-batch of its base, the rows stored since and with it, and how many of these are walked."""
        bases = {bucket: [-1, 0, 0] for bucket in range(BUCKETS)}
        return bases | {r.bucket: [r.base, r.stored, r.walked] for r in self._state(spark, "bases", BASE_SCHEMA, epoch).collect()}

    def _arrivals(self, spark: SparkSession, epochs: int, buckets: list[int], bases: dict[int, list[int]]) -> DataFrame:
        """Rows of the first ``epochs`` micro-batches; number and bucket prune the folders read."""
        schema = ARRIVAL_SCHEMA + ", epoch INT, bucket INT"

        def read(name: str, wanted) -> DataFrame:
            rows = spark.read.schema(schema).parquet(f"{self.state_dir}/{name}")
            of = [(F.col("bucket") == b) & wanted(F.col("epoch"), bases[b][0]) for b in buckets]
            return rows.filter(reduce(or_, of))

        found = read("arrivals", lambda number, base: (number > base) & (number < epochs))
        if self._epochs(spark, "kept"):
            found = found.unionByName(read("kept", lambda number, base: number == base))
        return found.drop("epoch")

    def _store(self, df: DataFrame, name: str, epoch: int, *partitions: str) -> None:
        df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{self.state_dir}/{name}/epoch={epoch}")

    def process(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        bases = self._bases(spark, epoch - 1)
        self._forget(spark, epoch, bases)
        done = self._state(spark, "done", DONE_SCHEMA, epoch - 1)
        known = batch.join(self.manifest.select("cluster_id"), "cluster_id", "left_semi")
        # Bucketed by cluster, so that a walk reads the buckets of its clusters only.
        bucket = F.pmod(F.xxhash64("cluster_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
        open_rows = known.join(done, "cluster_id", "left_anti").select("*", bucket)
        self._store(open_rows, "arrivals", epoch, "bucket")

        here = spark.read.schema(FILE_SCHEMA).parquet(f"{self.state_dir}/arrivals/epoch={epoch}").select("cluster_id", "key")
        waiting = self._state(spark, "files", FILE_SCHEMA, epoch - 1).join(done, "cluster_id", "left_anti")
        self._store(waiting.unionByName(here).distinct(), "files", epoch)
        complete = complete_clusters(self._state(spark, "files", FILE_SCHEMA, epoch), self.manifest).select("cluster_id")
        self._store(done.unionByName(complete).distinct(), "done", epoch)
        ready = self._state(spark, "done", DONE_SCHEMA, epoch).join(done, "cluster_id", "left_anti")

        buckets = [r.bucket for r in ready.select(bucket).distinct().collect()]  # at most BUCKETS
        if buckets:
            rows = self._arrivals(spark, epoch + 1, buckets, bases)
            walked = rows.join(ready, "cluster_id", "left_semi")
            initial = self.manifest.join(ready, "cluster_id", "left_semi").select(
                "cluster_id", F.col("initial_workers").alias("workers"), F.lit(None).cast("bigint").alias("last_us")
            )
            with scratch_scope(spark):
                records = walked.filter(F.col("id").isNotNull()).drop("key", "bucket")
                put_decisions(decide(records, initial, self.rules), self.table, epoch, run_id(spark, self.state_dir))
        here = spark.read.schema(FILE_SCHEMA + ", bucket INT").parquet(f"{self.state_dir}/arrivals/epoch={epoch}")
        stored = {r.bucket: r["count"] for r in here.groupBy("bucket").count().collect()}
        gone = {r.bucket: r["count"] for r in walked.groupBy("bucket").count().collect()} if buckets else {}
        self._rebase(spark, epoch, bases, stored, gone)

    def _rebase(self, spark: SparkSession, epoch: int, bases: dict[int, list[int]], stored: dict[int, int], gone: dict[int, int]) -> None:
        """Carry the bases on; buckets of which half is walked get a new one."""
        after, over = {}, []
        for bucket, (base, rows, walked) in bases.items():
            rows, walked = rows + stored.get(bucket, 0), walked + gone.get(bucket, 0)
            if 2 * walked < rows:
                after[bucket] = [base, rows, walked]
            else:
                after[bucket] = [epoch, rows - walked, 0]
                if rows > walked:
                    over.append(bucket)
        if over:
            done = self._state(spark, "done", DONE_SCHEMA, epoch)
            self._store(self._arrivals(spark, epoch + 1, over, bases).join(done, "cluster_id", "left_anti"), "kept", epoch, "bucket")
        self._store(spark.createDataFrame([(b, *v) for b, v in after.items()], BASE_SCHEMA).coalesce(1), "bases", epoch)
