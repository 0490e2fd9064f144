"""Training-data pipeline: known languages, no copies, no near copies, no secrets, packed sequences.

Each stage gets what the one before kept, with the columns of `documents`, written as Parquet and read again. The last
returns the pieces of the packed sequences. Rules for nulls, empty texts, ties and repeated rows are those of
the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import bag_minhash, exact_dedup, language_id, packing, secret_scan
from txlake.llm.text import documents
from txlake.plans.session import workspace

# A text of which less than this share of trigrams belongs to a language is in none that was learned.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters, null ones included, and those unlike all languages of the labelled documents."""
    model = language_id.train(docs)
    found = docs.withColumn("__language", language_id.predict(F.col("text"), model))
    kept = found.filter((F.col("__language.lang") != language_id.UNKNOWN) & (F.col("__language.score") >= LEAST_SCORE))
    return kept.drop("__language")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bag_minhash.drop_near_duplicates(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; secrets are replaced by a mark and n_chars follows where the text changed."""
    before = docs.withColumn("__before", F.col("text"))
    redacted = secret_scan.redact(before)
    changed = ~F.col("text").eqNullSafe(F.col("__before"))
    return redacted.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    ).drop("__before")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

# SQL can express neither the trigram filter nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        folder = workspace(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
