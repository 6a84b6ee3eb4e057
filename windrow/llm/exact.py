"""Exact duplicates: sorted runs of digests, exchanged and merged over a tree of partitions.

Every input partition is a leaf. Its run holds one entry per distinct text: the digest, the number
of its rows and the row that would stay. In a round, the leaves whose numbers differ in the next
``FAN_IN_BITS`` bits only exchange their runs: each takes over the entries whose digests have its
own number in those bits, and merges the sorted runs it is sent. After the last round every digest
is in one partition, and no partition ever holds more than its share of the digests. The rounds
grow with the logarithm of the number of partitions.

Entries merge only where the digest is verified by a second hash of the whole text and by its
length. The merged entry keeps the least row (longest original text, then smallest identifier), so
a text that fills a third of the table is one entry per leaf before anything is moved.

DataFrame functions only: a merge is a sorted aggregate, whose map side makes the run of a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import SPACE
from windrow.operators.joins import attach
from windrow.session import durable

FAN_IN_BITS = 4        # 16 runs are merged at a time
VERIFIED = ("digest", "check", "size")


def bare(text: Column) -> Column:
    """The text without ASCII white space; an empty text for null."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, a row number, its leaf, the digest with what verifies it, and its rank."""
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       bare(F.col(text_col)).alias("bare"))
    hexadecimal = F.sha2("bare", 256)
    return text.select(
        "id", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("leaf"),
        F.unhex(hexadecimal).alias("digest"),
        F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("bigint").alias("place"),
        F.xxhash64("bare").alias("check"), F.octet_length("bare").alias("size"),
        (-F.coalesce(F.char_length("text"), F.lit(0))).alias("shortness"),
        F.xxhash64("text").alias("text_hash"))


def merged_runs(rows: DataFrame, fan_in_bits: int = FAN_IN_BITS) -> DataFrame:
    """(digest, check, size, best, n): one entry per distinct text of :func:`digests`."""
    leaves = (rows.agg(F.max("leaf")).first()[0] or 0) + 1
    rounds = max(1, -(-(leaves - 1).bit_length() // fan_in_bits))
    runs = rows.select(F.col("leaf").cast("bigint").alias("node"), "place", *VERIFIED, F.struct(
        "shortness", F.col("id").isNull().alias("no_id"), "id", "text_hash", "row").alias("best"),
        F.lit(1).cast("bigint").alias("n"))
    for done in range(1, rounds + 1):
        bits = done * fan_in_bits
        upper = F.shiftleft(F.shiftright("node", bits), bits)
        taken = F.shiftright(F.shiftleft("place", 30), 62 - bits)
        runs = runs.withColumn("node", upper.bitwiseOR(taken)).groupBy(
            "node", "place", *VERIFIED).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    return runs.select(*VERIFIED, "best", "n")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space; null counts as empty. Of equal texts
    the row with the most code points stays, then the one with the smallest id, null ids last, then
    the one with the smallest hash of its text. Of rows equal in all of it one stays. keep_id is
    null only where no row of the group that is as long has an id. An empty table gives an empty one.
    """
    rows = durable(digests(docs, id_col, text_col))
    groups = durable(merged_runs(rows).filter("n > 1").select(
        *VERIFIED, F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "n"))
    marked = attach(rows.select("id", "row", *VERIFIED), groups, VERIFIED, spread=["row"])
    alone = F.col("n").isNull()
    return marked.select(
        "id", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


DUPLICATES_SQL = r"""
WITH bare AS (SELECT doc_id, coalesce(length(text), 0) AS n_chars,
                     regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
              FROM documents)
SELECT doc_id, first_value(doc_id) OVER ranked AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER ranked = 1 AS kept, sha256(body) AS text_sha256
FROM bare
WINDOW ranked AS (PARTITION BY body ORDER BY n_chars DESC, doc_id NULLS LAST)
"""
