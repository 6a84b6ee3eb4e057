"""The operators of this folder on their whole tables, with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import (
    chat, clustering, embeddings, exact, language, minhash, mixing, packing, pii, quality, toxicity,
    warc, whitening,
)
from windrow.llm.common import held_out, table
from windrow.session import shared_folder


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scorer = toxicity.fit(docs, table(spark, folder, "labels"))
    made = toxicity.score(docs, scorer, keep=["doc_id"])
    return made.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "score",
                       (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    made = mixing.plan(table(spark, folder, "documents"), keep=["doc_id"])
    # of the copies of a row only the first one, or the row that is left out
    return made.filter("copy is null or copy = 0").select(
        "doc.doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers
    made = packing.pack(table(spark, folder, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return made.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                       "offset")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    made = warc.round_trip(table(spark, folder, "pages"),
                           f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}", with_payload=False)
    return made.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    made = minhash.near_duplicates(table(spark, folder, "documents"), width=2)
    return made.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    made = quality.judge(table(spark, folder, "documents"))
    return made.select(F.col("id").alias("doc_id"), *quality.BASE, "base_failed", "kept")


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rotate(table(spark, folder, "conversations"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    made = language.identify(docs, language.fit(docs), keep=["doc_id"])
    return made.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "lang_pred",
                       "score")


def op9_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    made = embeddings.near_duplicates(table(spark, folder, "embeddings"))
    return made.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    made = pii.find(table(spark, folder, "documents"), keep=["doc_id"])
    return made.select(
        "doc.doc_id", *[pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    made = whitening.whiten(table(spark, folder, "embeddings"))
    return made.withColumnRenamed("id", "vec_id")


def op12_clustering(spark: SparkSession, folder: str) -> DataFrame:
    made = clustering.cluster(table(spark, folder, "embeddings"))
    return made.withColumnRenamed("id", "vec_id")


def op13_exact(spark: SparkSession, folder: str) -> DataFrame:
    made = exact.duplicates(table(spark, folder, "documents"))
    return made.withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_mixing, op3_packing, op4_warc, op5_minhash, op6_quality, op7_chat,
    op8_language, op9_embeddings, op10_pii, op11_whitening, op12_clustering, op13_exact)}
ORACLES = {"op7_chat": chat.ROTATE_SQL, "op12_clustering": clustering.cluster_sql(),
           "op13_exact": exact.DUPLICATES_SQL}
