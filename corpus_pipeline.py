"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept;
its result is written and read again as the next one's ``docs``. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import language, minhash, mixing, packing, pii
from windrow.operators.joins import attach
from windrow.session import durable, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what has no language (null or letterless texts); ``lang`` becomes the predicted one."""
    made = language.identify(docs, language.fit(docs), keep=list(COLUMNS))
    return made.filter(F.col("lang_pred") != language.UNKNOWN).select(
        F.col("doc.doc_id"), F.col("doc.text"), F.col("lang_pred").alias("lang"),
        F.col("doc.source"), F.col("doc.n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group whose five-word shingles agree to 80 % or more.

    Rows are told apart by id and text, so null and repeated ids decide nothing about other texts.
    Of rows equal in both, the least by the other columns stays.
    """
    marked = minhash.near_duplicates(docs, width=5, percent=80).filter(F.col("class").isNotNull())
    told = durable(marked.groupBy(F.col("id").alias("doc_id"), F.col("text_hash").alias("h")).agg(
        F.max("chosen").alias("again"), F.count(F.lit(1)).alias("n"))
        .filter(~F.col("again") | (F.col("n") > 1)).drop("n"))
    rows = attach(docs.select(*COLUMNS, F.xxhash64("text").alias("h")), told, ["doc_id", "h"],
                  nulls_match=True)
    one = (rows.filter("again").groupBy("doc_id", "h").agg(F.min(F.struct(*COLUMNS)).alias("row"))
           .select("row.*"))
    return rows.filter("again is null").select(*COLUMNS).unionByName(one)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in angle brackets in place of each span; ``n_chars`` follows the text."""
    found = pii.find(docs, keep=list(COLUMNS))
    text = F.when(F.col("doc.text").isNotNull(), pii.redacted(F.col("text"), F.col("spans")))
    return found.withColumn("text", text).select(
        "doc.doc_id", "text", "doc.lang", "doc.source",
        F.when(F.size("spans") == 0, F.col("doc.n_chars")).otherwise(
            F.char_length("text").cast("bigint")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its target weight, up to three times a document, shard by shard."""
    return mixing.shuffled(mixing.plan(docs, keep=COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids, with their places."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A learned model, components and packing have no SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what lies between them goes to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
