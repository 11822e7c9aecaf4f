"""The registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.llm import bpe, chat, credentials, decontaminate, hardnegatives, hashforest, langid, pii, quality, simhash, spotsigs, vectors, warc, whitening
from driverlens.llm.common import table
from driverlens.session import scratch_path

BYTE_BPE = "byte_bpe_50k.tiktoken"

QUERIES = {}
ORACLE = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, decoded="decoded", drop=("text",))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op4_decontaminate"] = decontaminate.REPORT_SQL


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))
    place = {kind: n for n, kind in enumerate(pii.KINDS)}

    def listed(spans):
        rank = F.create_map(*(F.lit(x) for pair in place.items() for x in pair))
        ordered = F.sort_array(F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("at"), s["start"], s["end"], s["kind"])))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.KINDS),
        F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.concat("base_spans", "added_spans")).alias("spans"),
    )


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.report(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(credentials.listed(F.col("base")), 256).alias("base_sha256"),
        credentials.listed(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


ORACLE["op6_secrets"] = credentials.REPORT_SQL


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bundles")
    warc.write(table(spark, sf_dir, "pages"), path)
    records = warc.read(spark.read.parquet(path))
    return records.select(
        warc.page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


ORACLE["op5_warc"] = warc.READ_SQL


@query
def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], given.schema)
    return chat.read_back(chat.format_chats(chat.logged(given.union(own))))


ORACLE["op2_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(role, '[\\<\[\]]', '..', 'g')) + length(regexp_replace(text, '[\\<\[\]]', '..', 'g')) + 11 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs.drop("lang"), langid.fit(docs), drop=("text",))
    return found.select("doc_id", F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.predict(docs, quality.fit(docs, table(spark, sf_dir, "labels")), drop=("text",))
    return found.select("doc_id", F.coalesce(langid.held_out(F.col("doc_id"), 3, 1), F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows, components=8)
    made = whitening.transform(rows, model).drop("embedding")
    error = whitening.identity_error(made, model)
    shares = F.array(*(F.lit(s) for s in model.shares())) if model.shares() else F.lit(None).cast("array<double>")
    long = made.select("vec_id", F.lit(model.n).cast("bigint").alias("n"), F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return long.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))


def _whole_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as whole numbers; every seventh id has the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.when(vectors.finite(F.col("embedding")), F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * 256)))
    return table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), whole.alias("v"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardnegatives.mine(_whole_vectors(spark, sf_dir), F.col("vec_id") % 100 == 0)


ORACLE["op12_hard_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 10
"""


@query
def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hashforest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
