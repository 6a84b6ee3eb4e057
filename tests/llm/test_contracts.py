"""Every opN query through the entry point: columns, types, rows and the rules of its result."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from windrow.llm import mixing, pii, quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMAS = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op3_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                   "sequence_id bigint, offset bigint",
    "op4_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
                "refers_to bigint",
    "op5_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
                   "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_embeddings": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                "base_sha256 string, spans string",
    "op11_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                      "explained double, identity_error double",
    "op12_clustering": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, "
                       "inertia bigint, centroid_sha256 string",
    "op13_exact": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string"}
OF_DOCUMENTS = [n for n, s in SCHEMAS.items() if s.startswith("doc_id") and n != "op3_packing"]


@pytest.fixture(scope="module")
def results(spark, tiny):
    made = {}

    def get(name):
        if name not in made:
            df = contract.queries()[name](spark, tiny)
            made[name] = (df.schema, df.collect())
        return made[name]
    return get


@pytest.fixture(scope="module")
def docs(spark, tiny):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}


@pytest.mark.parametrize("name", SCHEMAS)
def test_columns_and_types(results, name):
    have = {f.name: f.dataType.simpleString() for f in results(name)[0].fields}
    for field in SCHEMAS[name].split(", "):
        column, kind = field.split(" ")
        assert have.get(column) == kind, (name, column)


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_one_row_per_document(results, docs, name):
    assert sorted(r["doc_id"] for r in results(name)[1]) == sorted(docs)


@pytest.mark.parametrize("name", ["op1_toxicity", "op8_language"])
def test_held_out_rows_and_scores(results, name):
    for r in results(name)[1]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if name == "op1_toxicity":
            assert r["predicted"] == int(r["score"] >= 0.7)


def test_packing_covers_every_id_once(results, docs):
    rows = results("op3_packing")[1]
    of_doc, of_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        of_doc[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
        of_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(of_doc) == set(docs)
    for pieces in of_doc.values():
        at = 0
        for start, length, _ in sorted(pieces):
            assert start == at
            at += length
        assert {n for _, _, n in pieces} == {at}
    for places in of_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_mixing_keeps_every_row_and_its_bound(spark, results, docs):
    rows = results("op2_mixing")[1]
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        d = docs[r["doc_id"]]
        assert r["size"] == len(WORD.findall(d["text"] or "")) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[d["source"]] += r["size"]
        taken[d["source"]] += r["taken"]
        target[d["source"]] = r["target"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.water_fill([sizes[s] for s in order], [(1, 2, 3)[i % 3] for i in range(len(order))], 3)
    for s, t in zip(order, want):
        assert target[s] == pytest.approx(t)
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), rel=0.02)


def test_repeated_rows_are_mixed_each_for_itself(spark, tmp_path):
    rows = [(1, "one two three", "a"), (1, "one two three", "a"), (2, "four five", "a"),
            (3, "six " * 40, "b"), (None, None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = queries.op2_mixing(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "2", "3", "None"]
    assert all(r["taken"] <= 3 * r["size"] for r in got)


def plain_verdict(rows, base):
    """(class distance, word distance) of each text, from references made by plain counting."""
    def distance(counts, reference):
        n, m = sum(counts), sum(reference)
        if not n or not m:
            return 0.0
        total = 0.0
        for x, y in zip(counts, reference):
            p, q = x / n, y / m
            total += (p * math.log2(2 * p / (p + q)) if p else 0) + (q * math.log2(2 * q / (p + q)) if q else 0)
        return math.sqrt(max(0.0, total / 2))

    def classes(text):
        import regex
        found = [len(regex.findall(p, text)) for p in quality.CLASSES.values()]
        return [*found, len(text) - sum(found)]
    seen = collections.defaultdict(collections.Counter)
    for r in rows:
        if r["lang"] is not None:
            seen[r["lang"]].update(set(WORD.findall((r["text"] or "").lower())))
    common = {lang: sorted(c, key=lambda w: (-c[w], w))[:quality.COMMON] for lang, c in seen.items()}

    def met(text, lang):
        words = collections.Counter(WORD.findall(text.lower()))
        known = [words[w] for w in common[lang]]
        return [*known, sum(words.values()) - sum(known)]
    class_ref, word_ref = {}, {}
    overall = [0] * (len(quality.CLASSES) + 1)
    for r in rows:
        if base[r["doc_id"]]:
            continue
        c = classes(r["text"])
        overall = [a + b for a, b in zip(overall, c)]
        if r["lang"] is not None:
            class_ref[r["lang"]] = [a + b for a, b in zip(class_ref.get(r["lang"], [0] * len(c)), c)]
            w = met(r["text"], r["lang"])
            word_ref[r["lang"]] = [a + b for a, b in zip(word_ref.get(r["lang"], [0] * len(w)), w)]
    out = {}
    for r in rows:
        text, lang = r["text"] or "", r["lang"]
        far = (distance(classes(text), class_ref.get(lang, overall))
               if len(text) >= quality.LEAST_CHARS else 0.0)
        strange = (distance(met(text, lang), word_ref[lang]) if lang in word_ref
                   and len(WORD.findall(text)) >= quality.LEAST_WORDS else 0.0)
        out[r["doc_id"]] = (far, strange)
    return out


def test_quality_verdict(results, docs):
    rows = results("op6_quality")[1]
    want = plain_verdict(list(docs.values()), {r["doc_id"]: r["base_failed"] for r in rows})
    for r in rows:
        far, strange = want[r["doc_id"]]
        if min(abs(far - quality.MOST_CLASS_DISTANCE), abs(strange - quality.MOST_WORD_DISTANCE)) < 1e-9:
            continue
        assert r["kept"] == (not r["base_failed"] and far <= quality.MOST_CLASS_DISTANCE
                             and strange <= quality.MOST_WORD_DISTANCE), r


def test_warc_rows(spark, results, tiny):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in
             spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    largest = {}
    for k, v in pages.items():
        largest[v] = max(k, largest.get(v, k))
    got = {r["page_id"]: r for r in results("op4_warc")[1]}
    assert set(got) == set(pages)
    for k, v in pages.items():
        again = len(v) >= 1000 and largest[v] != k
        assert (got[k]["payload_bytes"], got[k]["payload_digest"], got[k]["record_type"], got[k]["refers_to"]) == (
            len(v), hashlib.sha1(v).hexdigest(), "revisit" if again else "response", largest[v] if again else None)


def test_personal_data_of_a_text_with_very_many_tokens(spark):
    rng = random.Random(5)
    words = [rng.choice(["abc", f"id{i}", f"a{i}@b.co", f"10.0.{i % 256}.7", "+1 (988) 555-2485 x"])
             for i in range(20_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "x9")], "doc_id bigint, text string")
    started = time.perf_counter()
    found = pii.find(df)
    r = found.filter("doc.doc_id = 1").select(
        pii.count_of(F.col("base"), "email").alias("n"), pii.count_of(F.col("base"), "ip").alias("m"),
        F.char_length(pii.redacted(F.col("text"), F.col("base"))).alias("left")).first()
    assert r["n"] == sum("@" in w for w in words) and r["m"] == sum(w.startswith("10.0.") for w in words)
    # a letter ends a phone number, which would else go on into the address after it
    kind = {"@": "<email>", "1": "<ip>", "+": "<phone> x"}
    short = [kind["@"] if "@" in w else kind[w[0]] if w[0] in "1+" else w for w in words]
    assert r["left"] == len(" ".join(short))
    assert time.perf_counter() - started < 100


def test_chains_of_contexts_are_followed_to_their_end(spark):
    """Each pattern is only known through the one before; six links, more than any fixed count here."""
    rows = []
    for link in range(6):
        for i in range(8):
            if link == 0:
                rows.append(f"mail{link} user{i}00{i}@host.example")
                rows.append(f"word{chr(97 + link)} user{i}00{i}@host.example")
            rows.append(f"step{chr(97 + link)} ident{link}x{i}0{i}{i}")
            if link:
                rows.append(f"step{chr(96 + link)} ident{link}x{i}0{i}{i}" if i < 1 else f"zz{link} nothing")
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    accepted, known = pii.bootstrap(pii.candidates(df.select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), "text",
        pii.base_spans(F.col("text")).alias("base"))))
    again, _ = pii.bootstrap(pii.candidates(df.repartition(5).select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), "text",
        pii.base_spans(F.col("text")).alias("base"))))
    assert sorted(accepted.collect()) == sorted(again.collect()) and accepted.count() >= 1
