"""From raw documents to token ids.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and all
but the last return the columns of ``documents``. ``run`` writes each stage's rows to the shared
folder and reads them again, so a lost executor costs no more than its part of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driverlens.llm import bpe, decontaminate, langid, pii, simhash
from driverlens.llm.common import table, unused
from driverlens.session import scratch_path, scratch_scope

BYTE_BPE = "byte_bpe_50k.tiktoken"
LEAST_SCORE = 0.5  # a document whose likeliest language is less likely goes

ORACLE_SQL = None  # learned weights, fingerprints and merges are beyond SQL


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with none that is likelier than not, go."""
    lang, score = unused(docs, "language"), unused(docs, "language_score")
    found = langid.predict(docs, langid.fit(docs), lang_out=lang, score_out=score)
    return found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that fingerprints within two bits link (three-word shingles) one document stays, that of the smallest id."""
    return simhash.deduplicate(docs, shingle=3, distance=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of the benchmark occurs go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; the number of characters follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and the digest of what they decode to."""
    path = public_tokenizers.path(BYTE_BPE)
    encoded = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, decoded="decoded", drop=("text",))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminated", decontaminated),
    ("masked", masked),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):  # what a stage writes on its way goes when its rows are stored
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
