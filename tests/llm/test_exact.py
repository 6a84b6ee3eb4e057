"""Exact duplicates against grouping by the normalised text itself."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest

from windrow.llm import exact

SCHEMA = "doc_id bigint, text string, digest int, kept string, row string, n int, best double"


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    """(id, keep id, size, sha256) of every row, and the (id, text) that stays per group."""
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[bare(text)].append((doc_id, text))
    out, stays = [], {}
    for body, members in groups.items():
        first = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        stays[body] = first[0]
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(doc_id, first[0], len(members), sha) for doc_id, _ in members]
    return out, stays


def table(spark, rows, parts):
    made = spark.createDataFrame([(*r, 1, "x", "y", 2, 0.5) for r in rows], SCHEMA)
    return made.repartition(parts)


def odd_rows():
    rng = random.Random(3)
    words = ["a", "bb", "c c", "é", "　", "\x0b", "\n", "x" * 300_000]
    rows = [(i, "".join(rng.choice(words[:7]) for _ in range(rng.randint(0, 5))))
            for i in range(400)]
    rows += [(1000 + i, "hot  text") for i in range(500)] + [(2000, " hot text"), (900, "hot\ttext ")]
    rows += [(3000, words[7]), (3001, words[7] + " "), (3002, None), (3003, None), (3004, "")]
    rows += [(5, "again"), (5, "again"), (None, "again"), (None, "only null"), (None, "only null"),
             (None, None)]
    return rows


@pytest.mark.parametrize("parts, bits", [(1, 4), (3, 1), (40, 2), (40, 4)])
def test_exact_duplicates(spark, monkeypatch, parts, bits):
    rows = odd_rows()
    monkeypatch.setattr(exact.merged_runs, "__defaults__", (bits,))
    got = exact.duplicates(table(spark, rows, parts)).collect()
    want, stays = brute(rows)

    def order(r):
        return tuple((x is None, x or 0) for x in r)
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got),
                  key=order) == sorted(want, key=order)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(stays) == len({r["text_sha256"] for r in kept})   # one row of each group
    assert all(r["id"] == r["keep_id"] for r in kept)


def test_keys_of_other_types_and_nothing(spark):
    rows = spark.createDataFrame([("b", "T x"), ("a", "Tx "), ("c", "tx")], "key string, body string")
    got = {r["id"]: (r["keep_id"], r["group_size"], r["kept"])
           for r in exact.duplicates(rows, "key", "body").collect()}
    assert got == {"a": ("a", 2, True), "b": ("a", 2, False), "c": ("c", 1, True)}
    assert exact.duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_entries_that_only_share_a_digest_stay_apart(spark):
    """A digest that collides is told apart by the second hash and the length."""
    rows = spark.createDataFrame([(1, "one"), (2, "two"), (3, "two")], "doc_id int, text string")
    from pyspark.sql import functions as F
    same = exact.digests(rows).withColumn("digest", F.unhex(F.lit("00" * 32))).withColumn(
        "place", F.lit(0).cast("bigint"))
    got = sorted((r["best"]["id"], r["n"]) for r in exact.merged_runs(same).collect())
    assert got == [(1, 1), (2, 2)]


def test_only_dataframe_functions(spark, capfd):
    rows = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id int, text string")
    exact.duplicates(rows).explain("formatted")
    assert not re.search("Python|Arrow|Pandas", capfd.readouterr().out)
