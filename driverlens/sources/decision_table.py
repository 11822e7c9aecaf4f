"""The keyed decision table ``(cluster_id, decision_ts) -> rule_name, from_workers, to_workers``.

A write belongs to a run and has a number in it. It goes to a folder of its own, where it
replaces what an earlier try of the same write left, so a retry changes nothing and no write
touches another run's rows. Runs are numbered in the order of their first write; reads keep the
newest write of every key. A write costs its own rows only, however large the table is. Rows
lie in buckets by cluster, sorted by key, so a lookup opens one bucket per write and its key
filter skips row groups. Compaction leaves one write, whose rows keep the number of the write they
come from: what is written meanwhile, or again, takes the same place as without it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.operators.recordset import ranked
from driverlens.session import children, remove

DECISION_KEY = ["cluster_id", "decision_ts"]
DECISION_COLUMNS = [*DECISION_KEY, "rule_name", "from_workers", "to_workers"]
TABLE_SCHEMA = (
    "cluster_id STRING, decision_ts STRING, rule_name STRING, from_workers BIGINT, to_workers BIGINT, "
    "walk_ts_us BIGINT, of STRUCT<run_no: BIGINT, run: STRING, write_seq: BIGINT>, "
    "run_no BIGINT, run STRING, write_seq BIGINT, bucket INT"
)
BUCKETS = 16
WRITE = ("run_no", "run", "write_seq")
COMPACTED = "run_no=-1"


def dedupe_decisions_last(decisions: DataFrame) -> DataFrame:
    """One row per key, the last in walk order; combined on the map side."""
    value = F.struct("rule_name", "from_workers", "to_workers", "ts_us")
    return (
        decisions.groupBy(*DECISION_KEY)
        .agg(F.max_by(value, F.struct("ts_us", "batch_id")).alias("d"))
        .select(*DECISION_KEY, "d.*")
    )


def bucket_of(cluster_id: Column) -> Column:
    return F.pmod(F.xxhash64(cluster_id), F.lit(BUCKETS)).cast("int")


def _runs(spark: SparkSession, table: str) -> dict[str, int]:
    """Number of each run in the table, from its folders' names."""
    found = {}
    for folder in children(spark, table):
        if folder.startswith("run_no=") and folder != COMPACTED:
            for run in children(spark, f"{table}/{folder}"):
                if run.startswith("run="):
                    found[run.removeprefix("run=")] = int(folder.removeprefix("run_no="))
    return found


def _writes(spark: SparkSession, table: str) -> list[str]:
    """The folders of all writes, below the table."""
    runs = [f"{n}/{run}" for n in children(spark, table) if n.startswith("run_no=") for run in children(spark, f"{table}/{n}")]
    return [f"{run}/{w}" for run in runs for w in children(spark, f"{table}/{run}") if w.startswith("write_seq=")]


def _store(rows: DataFrame, path: str) -> int:
    placed = rows.withColumn("bucket", bucket_of(F.col("cluster_id"))).repartition("bucket")
    placed.sortWithinPartitions("bucket", *DECISION_KEY).write.mode("overwrite").partitionBy("bucket").parquet(path)
    return rows.sparkSession.read.schema("cluster_id STRING").parquet(path).count()  # from the files' footers


def _write(rows: DataFrame, table: str, run: str, write_seq: int) -> int:
    runs = _runs(rows.sparkSession, table)
    number = runs.get(run, max(runs.values(), default=-1) + 1)
    return _store(rows, f"{table}/run_no={number}/run={run}/write_seq={write_seq}")


def put_decisions(decisions: DataFrame, table: str, write_seq: int = 0, run: str | None = None) -> int:
    """Store ``decisions`` as ``operators.gates.decisions`` gives them; returns the number of keys.

    Without ``run`` every call is a run of its own. A stream names its run, so that a repeated
    micro-batch replaces its own rows.
    """
    rows = dedupe_decisions_last(assert_valid_decisions(decisions)).withColumnRenamed("ts_us", "walk_ts_us")
    return _write(rows, table, run or uuid.uuid4().hex, write_seq)


def _rows(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).parquet(table)


def _newest(rows: DataFrame, *value: str) -> DataFrame:
    """The newest row of every key; a compacted row, which names its write in ``of``, is as new as that write."""
    place = F.coalesce("of", F.struct(*WRITE))
    newest = rows.withColumn("of", place).groupBy("bucket", *DECISION_KEY).agg(F.max_by(F.struct(*value), "of").alias("d"))
    return newest.select(*DECISION_KEY, "d.*")


def read_decisions(spark: SparkSession, table: str) -> DataFrame:
    return _newest(_rows(spark, table), "rule_name", "from_workers", "to_workers")


def read_write(spark: SparkSession, table: str, run: str, write_seq: int) -> DataFrame:
    """What one write of a run stored, with ``walk_ts_us``; also where a compaction has taken it in since."""
    own = (F.col("run") == run) & (F.col("write_seq") == write_seq)
    taken_in = (F.col("run_no") == -1) & (F.col("of.run") == run) & (F.col("of.write_seq") == write_seq)
    return _rows(spark, table).filter(own | taken_in).dropDuplicates(DECISION_KEY)


def compact_decisions(spark: SparkSession, table: str) -> int:
    """Make the present content one write; returns its number of keys.

    The writes that exist at the start are read, and these alone are removed once the new one is
    there. A write that comes in between stays and is as new as it would be otherwise. Between the two steps, and if
    the second never happens, rows are there twice with the same place, which reads fold. The folders of
    runs stay, so a run keeps its number. One compaction of a table at a time; a read that started before
    may find its files gone and has to be repeated.
    """
    writes = _writes(spark, table)
    if not writes:
        return 0
    rows = spark.read.schema(TABLE_SCHEMA).option("basePath", table).parquet(*(f"{table}/{w}" for w in writes))
    kept = _newest(rows, "rule_name", "from_workers", "to_workers", "walk_ts_us", "of")
    count = _store(kept, f"{table}/{COMPACTED}/run={uuid.uuid4().hex}/write_seq=0")
    for write in writes:
        remove(spark, f"{table}/{write}")
    return count


def get_decision(spark: SparkSession, table: str, cluster_id: str, decision_ts: str) -> DataFrame:
    """Point lookup: one bucket is opened, and the key filter reaches the parquet scan."""
    key = (F.col("cluster_id") == cluster_id) & (F.col("decision_ts") == decision_ts)
    rows = _rows(spark, table).filter((F.col("bucket") == bucket_of(F.lit(cluster_id))) & key)
    return _newest(rows, "rule_name", "from_workers", "to_workers")


def lookup_decisions(decisions: DataFrame, keys: DataFrame) -> DataFrame:
    """Point lookups in bulk: ``keys`` holds ``cluster_id, decision_ts``."""
    return decisions.join(keys.select(*DECISION_KEY), DECISION_KEY)


def listed(decisions: DataFrame) -> DataFrame:
    """Every cluster's listing at once: ``position`` of a decision by ``decision_ts`` as text.

    The day's ten characters bucket the rows: a busy cluster is not sorted in one task.
    """
    day = F.substring("decision_ts", 1, 10)
    return ranked(decisions, ["cluster_id"], [day], [F.col("decision_ts")], "position")


def cluster_decisions(decisions: DataFrame, cluster_id: str) -> DataFrame:
    """A cluster's decisions by ``decision_ts`` as text, the order of the table's sort key."""
    return decisions.filter(F.col("cluster_id") == cluster_id).orderBy("decision_ts")


def _violations():
    def empty(name: str):
        return F.coalesce(F.length(name), F.lit(0)) == 0

    def negative(name: str):
        return ~F.coalesce(F.col(name) >= 0, F.lit(False))

    checks = [(empty(n), f"{n} is empty") for n in ("cluster_id", "decision_ts", "rule_name")]
    checks += [(negative(n), f"{n} is negative") for n in ("from_workers", "to_workers")]
    checks.append((F.col("from_workers") == F.col("to_workers"), "workers do not change"))
    return F.array_compact(F.array(*[F.when(condition, F.lit(text)) for condition, text in checks]))


def decision_violations(decisions: DataFrame) -> DataFrame:
    """One row per broken constraint."""
    return decisions.select(*DECISION_COLUMNS, F.explode(_violations()).alias("violation"))


def assert_valid_decisions(decisions: DataFrame) -> DataFrame:
    """The same rows; the job fails on the first that breaks a constraint."""
    broken = _violations()
    key = F.concat_ws(" ", F.col("cluster_id"), F.col("decision_ts"))
    message = F.concat(F.lit("invalid decision "), key, F.lit(": "), F.array_join(broken, ", "))
    checked = F.when(F.size(broken) > 0, F.raise_error(message)).otherwise(F.col("cluster_id"))
    return decisions.withColumn("cluster_id", checked.cast("string"))


# Attribute-value text: strings as {"S": ...}, numbers as {"N": "..."}.
EXPORT_TYPES = {"cluster_id": "S", "decision_ts": "S", "rule_name": "S", "from_workers": "N", "to_workers": "N"}
EXPORT_SCHEMA = "struct<" + ", ".join(f"{n}:struct<{k}:string>" for n, k in EXPORT_TYPES.items()) + ">"


def export_items(decisions: DataFrame) -> DataFrame:
    columns = [F.struct(F.col(n).cast("string").alias(k)).alias(n) for n, k in EXPORT_TYPES.items()]
    return decisions.select(F.to_json(F.struct(*columns)).alias("item"))


def import_items(items: DataFrame) -> DataFrame:
    """``item`` text back to decision rows; the job fails on a missing attribute."""
    parsed = F.from_json("item", EXPORT_SCHEMA)

    def attribute(name: str, kind: str):
        value = parsed[name][kind]
        lost = F.raise_error(F.concat(F.lit(f"item is missing {name} of type {kind}: "), F.col("item")))
        return F.when(value.isNull(), lost.cast("string")).otherwise(value).cast("string" if kind == "S" else "bigint").alias(name)

    return items.select(*[attribute(n, k) for n, k in EXPORT_TYPES.items()])
