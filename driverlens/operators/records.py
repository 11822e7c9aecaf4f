"""Entries to typed progress records, keeping the rejects.

One lenient pass per payload gives every top-level field as text; a second, narrow one gives
the JSON types of the two fields whose type matters (``id``, ``batchId``). Both stop at the
end of the first JSON value, so trailing text is harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driverlens.functions.coercion import ascii_number, batch_number, decimal_or_infinite, is_finite, utc_timestamp
from driverlens.operators.entries import PROGRESS_MARKER, progress_entries

# Fields that identify a record rather than measure it.
IDENTITY_FIELDS = ("id", "runId", "name", "timestamp", "batchId")
SOURCE_PREFIX = "source."
SKIP_SAMPLES = 20

JSON_OPTIONS = {"allowSingleQuotes": "false"}
RECORD, MALFORMED, INCOMPLETE, OTHER = "record", "malformed_json", "missing_required", "other"


def payload(text: Column) -> Column:
    """Text after the first marker, without leading blanks of any kind; NULL if no marker."""
    at = F.instr(text, F.lit(PROGRESS_MARKER))
    rest = F.substr(text, at + F.lit(len(PROGRESS_MARKER)))
    return F.when(at > 0, F.regexp_replace(rest, r"^\s+", ""))


def last_wins(fields: Column) -> Column:
    """A JSON object may repeat a key; keep its last value, as JSON readers do."""
    keys = F.map_keys(fields)
    entries = F.map_entries(fields)
    unique = F.map_from_entries(
        F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    )
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), unique).otherwise(fields)


def json_type(value: Column) -> Column:
    """``string``, ``number`` or ``other`` for a variant; NULL if the field is absent."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "STRING", "string")
        .when(name.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), "number")
        .when(name.isNotNull(), "other")
    )


def _numbers(fields: Column) -> Column:
    return F.map_filter(F.transform_values(fields, lambda _, v: decimal_or_infinite(v)), lambda _, v: is_finite(v))


def all_metrics(document: Column, source: Column) -> Column:
    """Every numeric field by name, source metrics under ``source.<name>``."""
    source = F.transform_keys(_numbers(source), lambda k, _: F.concat(F.lit(SOURCE_PREFIX), k))
    top = _numbers(F.map_filter(document, lambda k, _: ~k.isin(*IDENTITY_FIELDS)))
    merged = F.map_concat(F.map_filter(top, lambda k, _: ~F.map_contains_key(source, k)), source)
    return F.coalesce(merged, top)


def chosen_metrics(document: Column, source: Column, names: Sequence[str]) -> Column:
    """The same for known names only: plain lookups, no walk over all fields."""
    pairs = []
    for name in names:
        number = F.lit(None).cast("double") if name in IDENTITY_FIELDS else ascii_number(document[name])
        if name.startswith(SOURCE_PREFIX):
            number = F.coalesce(ascii_number(source[name[len(SOURCE_PREFIX):]]), number)
        pairs += [F.lit(name), number]
    return F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")


def _decoded(entries: DataFrame) -> DataFrame:
    """``payload``, its fields ``document`` and those of its first source ``source``.

    Each decoding is a column of its own: Catalyst then keeps it to one evaluation per row.
    ``source`` is NULL if there is none or it has another shape: ``sources`` must be an array,
    its first element and that element's ``metrics`` objects, and not text that looks like them.
    """
    # An array whose later elements have another shape does not fit the struct; the variant
    # then tells the JSON types, and only for such rows.
    sources = F.from_json("payload", "struct<sources:variant>", JSON_OPTIONS)["sources"]
    fits = (
        F.schema_of_variant(sources).startswith("ARRAY")
        & F.schema_of_variant(F.try_variant_get(sources, "$[0]", "variant")).startswith("OBJECT")
        & F.schema_of_variant(F.try_variant_get(sources, "$[0].metrics", "variant")).startswith("OBJECT")
    )
    source_text = F.get_json_object(F.col("document")["sources"], "$[0].metrics")
    odd = F.when(fits, F.from_json(source_text, "map<string,string>", JSON_OPTIONS))
    shaped = F.from_json("payload", "struct<sources:array<struct<metrics:map<string,string>>>>", JSON_OPTIONS)
    return (
        entries.withColumn("payload", payload(F.col("text")))
        .withColumn("document", F.from_json("payload", "map<string,string>", JSON_OPTIONS))
        .withColumn("typed", F.from_json("payload", "struct<id:variant,batchId:variant>", JSON_OPTIONS))
        .withColumn("document", last_wins(F.col("document")))
        .withColumn("shaped", shaped["sources"])
        .withColumn("source", F.when(F.col("shaped").isNotNull(), F.get("shaped", F.lit(0))["metrics"]).when(F.contains(F.col("document")["sources"], F.lit("{")), odd))
        .withColumn("source", last_wins(F.col("source")))
        .withColumns({"id_type": json_type(F.col("typed.id")), "batch_type": json_type(F.col("typed.batchId"))})
    )


def classified(entries: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Every entry with ``status``, ``reason`` and, for records, the typed fields."""
    keep = [c for c in entries.columns if c != "text"]
    document, source = F.col("document"), F.col("source")
    fields = _decoded(entries).select(
        *keep,
        "payload",
        "document",
        "source",
        F.when(F.col("id_type") == "string", document["id"]).alias("id"),
        batch_number(F.col("batch_type"), document["batchId"]).alias("batch_id"),
        utc_timestamp(document["timestamp"]).alias("ts"),
        document["timestamp"].alias("ts_raw"),
    )
    status = (
        F.when(F.col("payload").isNull(), OTHER)
        .when(document.isNull(), MALFORMED)
        .when((F.coalesce(F.length("id"), F.lit(0)) == 0) | F.col("batch_id").isNull() | F.col("ts").isNull(), INCOMPLETE)
        .otherwise(RECORD)
    )
    reason = (
        F.when(F.col("status") == MALFORMED, "payload is not a JSON object")
        .when(F.col("status") != INCOMPLETE, F.lit(None).cast("string"))
        .when(F.coalesce(F.length("id"), F.lit(0)) == 0, "id is not a non-empty string")
        .when(F.col("batch_id").isNull(), "batchId is not a whole number")
        .otherwise("timestamp is not ISO-8601")
    )
    values = all_metrics(document, source) if metrics is None else chosen_metrics(document, source, metrics)
    return fields.withColumn("status", status).select(
        *keep, "status", reason.alias("reason"), "id", "batch_id", F.unix_micros("ts").alias("ts_us"), "ts_raw",
        F.when(F.col("status") == RECORD, values).alias("metrics"),
    )


def _kept(rows: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """A filter as a generator: each row yields itself or nothing.

    A plain filter on ``status`` would be pushed below the projections that compute it, and
    every payload decoded again for each mention of it.
    """
    return rows.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def progress_records(entries: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    rows = classified(progress_entries(entries), metrics)
    return _kept(rows, F.col("status") == RECORD, [c for c in rows.columns if c not in ("status", "reason")])


def rejected_records(entries: DataFrame) -> DataFrame:
    rows = classified(progress_entries(entries), metrics=[])
    typed = ("id", "batch_id", "ts_us", "ts_raw", "metrics")
    return _kept(rows, F.col("status") != RECORD, [c for c in rows.columns if c not in typed])


def metrics_long(records: DataFrame) -> DataFrame:
    """One row per record and metric."""
    keep = [c for c in records.columns if c != "metrics"]
    return records.select(*keep, F.explode("metrics").alias("metric", "value")).filter(F.col("value").isNotNull())


def parse_stats(entries: DataFrame) -> DataFrame:
    """Counters per file, in one map-side combined pass."""
    is_status = lambda s: F.count_if(F.col("status") == s)
    return classified(entries, metrics=[]).groupBy("path").agg(
        F.count("*").alias("entries"),
        F.count_if(F.col("status") != OTHER).alias("progress_entries"),
        is_status(RECORD).alias("records"),
        is_status(MALFORMED).alias("malformed_json"),
        is_status(INCOMPLETE).alias("missing_required"),
    )


def skip_samples(entries: DataFrame, limit: int = SKIP_SAMPLES) -> DataFrame:
    """The first ``limit`` skipped entries of every file.

    ``row_number() <= limit`` is cut down to ``limit`` rows per file before the shuffle
    (WindowGroupLimit), so one very bad file is no burden.
    """
    rejects = rejected_records(entries)
    place = F.row_number().over(W.partitionBy("path").orderBy("entry_no"))
    return rejects.withColumn("place", place).filter(F.col("place") <= limit)
