"""Control data: manifest, rules and file notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.operators.manifest import manifest_entries, manifest_problems
from driverlens.operators.rules import RULE_FIELDS, Rule, validated_rules

# The fields a notification must carry.
NOTIFICATION_FIELDS = ("bucket", "key", "cluster_id")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole small text files as ``doc_id, text``."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def manifest_rows(documents: DataFrame) -> DataFrame:
    return manifest_entries(documents).select("doc_id", "position", "cluster_id", "initial_workers", "num_log_files")


def misshapen_manifests(documents: DataFrame) -> DataFrame:
    """Documents that are not a mapping with a ``clusters`` list."""
    return documents.filter(F.from_json("text", "struct<clusters:array<variant>>")["clusters"].isNull())


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The checked manifest; raises on the first problem."""
    documents = read_documents(spark, path)
    if not misshapen_manifests(documents).isEmpty():
        raise ValueError("the manifest must be a mapping with a 'clusters' list")
    problem = manifest_problems(documents).orderBy("doc_id", "position", "problem").first()
    if problem is not None:
        raise ValueError(f"manifest entry #{problem.position}: {problem.problem}")
    return manifest_rows(documents).select("cluster_id", "initial_workers", "num_log_files")


def _rule_items(text: str) -> list:
    import yaml

    # The C loader reads the same documents, where the library was built with it.
    document = yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    if not isinstance(document, dict) or not isinstance(document.get("rules"), list):
        raise ValueError("the rules document must be a mapping with a 'rules' list")
    return document["rules"]


def rules_rows(documents: DataFrame) -> DataFrame:
    """Rules documents in JSON form (which is YAML too) to raw rule rows, in file order: text and
    type word per field, as the checks take them. A document of another shape gives none."""
    items = F.from_json("text", "struct<rules:array<variant>>")["rules"]
    listed = documents.select(F.col("doc_id").alias("ruleset"), F.posexplode(items).alias("rule_ord", "item"))

    def field(name: str) -> list[Column]:
        value = F.try_variant_get("item", f"$.{name}", "variant")
        kind = F.schema_of_variant(value)
        word = (
            F.when(kind == "STRING", "str").when(kind == "BIGINT", "int").when(kind == "BOOLEAN", "bool")
            .when(kind.rlike("^(DOUBLE|FLOAT|DECIMAL)"), "float").when(kind.startswith("ARRAY"), "list").when(kind.startswith("OBJECT"), "dict")
        )
        return [F.try_variant_get("item", f"$.{name}", "string").alias(name), word.alias(f"{name}_type")]

    return listed.select("ruleset", "rule_ord", *[c for name in RULE_FIELDS for c in field(name)])


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """One checked rules document, as the driver-side values every plan is built from."""
    documents = read_documents(spark, path).limit(2).collect()
    if len(documents) != 1:
        raise ValueError("name exactly one rules document")
    return validated_rules(spark, _rule_items(documents[0].text))


def _judged_notifications(messages: DataFrame) -> DataFrame:
    """Messages with their fields and, if they are rejected, the ``reason``.

    The body is decoded once, inside a generator: Catalyst can't push what is built on it, the
    filters included, below a generator and decode it again.
    """
    parsed = messages.select(F.inline(F.array(F.struct(*messages.columns, F.try_parse_json("body").alias("document")))))

    def field(name: str) -> Column:
        value = F.try_variant_get("document", f"$.{name}", "variant")
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get("document", f"$.{name}", "string"))

    decoded = parsed.withColumns({name: field(name) for name in NOTIFICATION_FIELDS})
    missing = F.array_compact(
        F.array(*[F.when(F.coalesce(F.length(n), F.lit(0)) == 0, F.lit(n)) for n in NOTIFICATION_FIELDS])
    )
    reason = (
        F.when(F.col("document").isNull(), "body is not JSON")
        .when(~F.schema_of_variant("document").startswith("OBJECT"), "body must be a JSON object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing non-empty text field(s): "), F.array_join(missing, ", ")))
    )
    return decoded.withColumn("reason", reason)


def valid_notifications(messages: DataFrame) -> DataFrame:
    """``message_id, body`` rows to ``message_id, bucket, key, cluster_id``."""
    return _judged_notifications(messages).filter(F.col("reason").isNull()).select("message_id", *NOTIFICATION_FIELDS)


def rejected_notifications(messages: DataFrame) -> DataFrame:
    return _judged_notifications(messages).filter(F.col("reason").isNotNull()).select("message_id", "body", "reason")


def notification_audit(messages: DataFrame, read_at: Column | None = None) -> DataFrame:
    """Every message with its raw body and, if it is JSON, the decoded one."""
    return messages.select(
        (F.current_timestamp() if read_at is None else read_at).alias("read_at"),
        "message_id",
        F.try_parse_json("body").alias("body"),
        F.col("body").alias("raw_body"),
    )
