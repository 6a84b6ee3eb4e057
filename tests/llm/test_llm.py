"""Every text operator against a brute-force version, and on nulls, ties, repeats and nothing."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import public_tokenizers
from windrow.llm import (
    chat, embeddings, language, minhash, mixing, packing, pii, quality, toxicity, warc,
)
from windrow.llm.components import components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, size int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeats, clashing column names."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
                  for _ in range(400)]
    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    base = text(300)
    near = base.split()
    near[100] = "changed"
    texts = [None, "", " \t\n ", "...", "one", "one", "two words", base, base, " ".join(near),
             text(9000), "a@b.co +1 (988) 555-2485\n1.2.3.4", "line\nline\nother\nline", "é" * 50]
    rows = [(i, t, rng.choice(["aa", "bb", None]), rng.choice(["x", "y", "z", None]), 1, 0.5, 2)
            for i, t in enumerate(texts + [text(rng.randint(1, 200)) for _ in range(60)])]
    rows += [rows[7], (None, "null id", None, None, None, None, None), (None, None, None, None,
                                                                      None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_language(odd, none):
    model = language.fit(odd)
    got = language.identify(odd, model, keep=["doc_id", "text", "score"]).collect()
    assert len(got) == odd.count()
    for r in got:
        letterless = not any(c.isalpha() for c in r["doc"]["text"] or "")
        assert (r["lang_pred"] == "und") == letterless and 0 <= r["score"] <= 1
    assert language.identify(none, language.fit(none)).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs, language.fit(docs), keep=["doc_id", "lang"]).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc"]["doc_id"]).encode()) % 3 == 1]
    right = sum(r["doc"]["lang"] == r["lang_pred"] for r in held)
    assert right > 0.97 * len(held)


def test_more_languages_than_one_pass_takes(spark):
    """1,500 labels in passes of 400 are the same as in one."""
    rng = random.Random(3)
    names = [f"l{i:04d}" for i in range(1500)]
    rows = [(k * 1500 + i, f"{name} " + " ".join(
        chr(97 + (i // 26) % 26) + chr(97 + i % 26) + rng.choice("abc") for _ in range(9)), name)
        for k in range(2) for i, name in enumerate(names)] + [(9000, "12", None), (9001, None, "l1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = language.fit(docs, bits=10)
    assert len(model.languages) > 1000
    one, many = ({r["doc"]["doc_id"]: r for r in language.identify(
        docs, model, keep=["doc_id"], per_pass=size).collect()} for size in (2000, 400))
    assert len(one) == len(rows)
    for key, r in one.items():
        assert many[key]["lang_pred"] == r["lang_pred"]
        assert many[key]["score"] == pytest.approx(r["score"])
        assert 0 <= r["score"] <= 1 + 1e-12
    assert one[9000]["lang_pred"] == one[9001]["lang_pred"] == "und"


def test_ngrams_do_not_depend_on_the_batch():
    texts = ["Ab c", None, "x", "", "Zürich 99 été", "日本語"]
    buckets, whose, has = language.ngrams(texts)
    assert list(has) == [True, False, True, False, True, True]
    for i, t in enumerate(texts):
        assert sorted(buckets[whose == i]) == sorted(language.ngrams([t])[0])


def exact_components(docs, width, percent):
    """Brute force: all pairs of word-shingle sets."""
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").translate(lower))
        k = min(width, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set())
    group = list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    least = {}
    for (key, _), g in zip(docs, group):
        if key is not None:
            least[g] = min(key, least.get(g, key))
    return {(key, len(s), least.get(g)) for (key, _), s, g in zip(docs, sets, group)}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(odd, none, width):
    got = minhash.near_duplicates(odd, width=width).collect()
    assert len(got) == odd.count()
    assert {(r["id"], r["n_shingles"], r["component_id"]) for r in got} == exact_components(
        docs_of(odd), width, 80)
    assert minhash.near_duplicates(none).count() == 0


def test_near_duplicates_of_a_large_group(spark):
    """A crowded group around the threshold: links found are right, and next to none is missed."""
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(120)] = f"v{rng.randint(0, 10 ** 6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["id"], r["n_shingles"], r["component_id"])
           for r in minhash.near_duplicates(df, width=2).collect()}
    missed = exact_components(rows, 2, 80) - got
    assert len(missed) <= 2 and all(i == c for i, _, c in got - exact_components(rows, 2, 80))


def test_near_duplicates_deep_inside_a_crowded_region(spark, monkeypatch):
    """Texts that share most words but are not linked, with links hidden among them: all are found."""
    monkeypatch.setattr(minhash, "PIECE", 100)        # several blocks a region
    monkeypatch.setattr(minhash, "NEAREST", 1)        # as few as in a region many times this size
    monkeypatch.setattr(minhash, "NEIGHBOURS", 1)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(130)]
    rows = []
    for i in range(300):
        # own ends make two of these texts agree to about 3/4
        rows.append((i, " ".join(base + [f"v{rng.randint(0, 10 ** 9)}" for _ in range(20)])))
    for i in range(25):
        # one link at about 0.82 each, to a text that stands anywhere among the others
        words = rows[i * 10][1].split()[:135]
        rows.append((5000 + i, " ".join(words + [f"u{rng.randint(0, 10 ** 9)}" for _ in range(15)])))
    got = {(r["id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id bigint, text string"), width=2).collect()}
    assert sum(c != i for i, _, c in got) == 25
    assert got == exact_components(rows, 2, 80)


def test_shingles_match_by_words_only():
    assert list(minhash.shingles("A  b\tC", 2)) == list(minhash.shingles("a B c", 2))
    assert len(minhash.shingles(" ", 2)) == 0 and len(minhash.shingles("x", 2)) == 1
    assert set(minhash.shingles("ab c", 2)).isdisjoint(minhash.shingles("a bc", 2))


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 100), (7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 100: 50}


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    def fine(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else 0,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15}[kind]
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN.items())
                  for m in re.finditer(p, text) if fine(kind, m.group()))


def test_personal_data(spark, odd, none):
    tricky = ["a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.01", "4111 1111 1111 1111",
              "4111-1111-1111-1112 5 6", "+1 (988) 555-2485) +12 +4 1234567890123456", "𝒳é a@b.co",
              "@@ .. + 7", "5" * 5000, "a" * 5000 + "@", "7992739871 3 4111111111111111,x"]
    rng = random.Random(5)
    tricky += ["".join(rng.choice("a1.@+- 4") for _ in range(rng.randint(1, 60)))
               for _ in range(300)]
    docs = spark.createDataFrame([(i + 1000, t) for i, t in enumerate(tricky)],
                                 "doc_id bigint, text string")
    for df in (docs, odd):
        got = pii.find(df.select("doc_id", "text")).collect()
        assert len(got) == df.count()
        for r in got:
            text = r["doc"]["text"] or ""
            assert [tuple(s) for s in r["base"]] == plain_spans(text)
            assert [s for s in r["spans"] if s["kind"] < 4] == r["base"]
    assert pii.find(none).count() == 0


def test_contexts_discover_and_redact(spark):
    rows = [(i, f"write to mail user{i}@site{i}.org today") for i in range(20)]
    rows += [(50, "write to mail user77-at-site88 now"), (51, "version 2024-01-01x of it")]
    rows += [(60 + i, f"version 20{i}0-1{i}-0{i}y of it") for i in range(9)]
    found = pii.find(spark.createDataFrame(rows, "doc_id bigint, text string"))
    text = {r["id"]: r["t"] for r in found.select(
        found["doc"]["doc_id"].alias("id"),
        pii.redacted(found["text"], found["spans"]).alias("t")).collect()}
    assert text[3] == "write to mail <email> today"
    assert text[50] == "write to mail <context> now" and text[51] == rows[21][1]


def test_redacting_a_long_text_cuts_blocks(spark):
    """Places are code points, also beyond a block and beside wide characters."""
    rng = random.Random(8)
    words = [rng.choice(["\N{GRINNING FACE}", "\n", "é", "plain", f"a{i}@b{i}.org"])
             for i in range(9000)]
    texts = [" ".join(words), "a@b.co" + "x\n" * 3000, "y" * 1000 + " a@b.co", "a@b.co", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii.find(docs)
    for r in found.withColumn("made", pii.redacted(found["text"], found["spans"])).collect():
        want, at = [], 0
        for start, kind, end in sorted(map(tuple, r["spans"])):
            if start >= at:
                want += [r["text"][at:start], f"<{(*pii.KINDS, pii.CONTEXT)[kind]}>"]
            at = max(at, end)
        assert r["made"] == "".join(want) + r["text"][at:]


def test_redacting_is_linear(spark):
    text = " ".join(f"a{i}@b{i}.org" for i in range(100_000))
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"[^ ]+", text)]
    one = spark.createDataFrame([(text, spans)], "text string, "
                                "spans array<struct<start:bigint,kind:int,end:bigint>>")
    started = time.monotonic()
    made = one.select(pii.redacted(F.col("text"), F.col("spans")).alias("t")).first()["t"]
    assert made == " ".join(["<email>"] * 100_000)
    assert time.monotonic() - started < 60


def test_water_fill():
    assert mixing.water_fill([10, 10, 10], [1, 2, 3], 3) == pytest.approx([5, 10, 15])
    got = mixing.water_fill([100, 1, 0], [1, 2, 3], 3)
    assert got == pytest.approx([98, 3, 0])


def test_split_tree_keeps_quotas_and_runs_are_disjoint(spark):
    quotas, shards = [50, 0, 7, 313], 13
    walk = mixing.split_tree(quotas, shards, seed=4)
    parts = [walk(k) for k in range(shards)]
    assert np.array_equal(sum(have for have, _ in parts), quotas)
    for (have, before), (_, following) in zip(parts, parts[1:]):
        assert np.array_equal(before + have, following)
    assert {int(have.sum()) for have, _ in parts} <= {28, 29}
    rows = mixing.shard_runs(spark, quotas, shards, seed=4).collect()
    drawn = [(r["s"], d) for r in rows for d in range(r["first"], r["last"] + 1)]
    assert len(drawn) == len(set(drawn)) == sum(quotas)


def test_mixing(odd, none):
    def mixed():
        return mixing.plan(odd, keep=["doc_id", "text", "source"], block_words=400,
                           shard_words=900).collect()
    got = mixed()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for _, text, source in {(r["doc"]["doc_id"], r["doc"]["text"], r["doc"]["source"]) for r in got}:
        assert all(r["size"] == len(WORD.findall(text or "")) for r in got if r["doc"]["text"] == text)
    for key, text in docs_of(odd):
        assert any(r["doc"]["doc_id"] == key for r in got)
    for r in got:
        target[r["doc"]["source"]] = (r["target"], r["source_size"])
        if r["shard"] is not None:
            taken[r["doc"]["source"]] += r["size"]
    sizes = {k: v[1] for k, v in target.items()}
    names = sorted((k for k in sizes if k), key=str) + [None]
    want = mixing.water_fill([sizes[k] for k in names], [1, 2, 3, 1], 3)
    for k, t in zip(names, want):
        assert target[k][0] == pytest.approx(t)
        assert abs(taken[k] - t) <= max(60, 0.05 * t) or sizes[k] > 9000
    assert collections.Counter(map(str, got)) == collections.Counter(map(str, mixed()))
    assert mixing.shuffled(mixing.plan(none)).count() == 0


def test_the_rest_is_met_beyond_a_block_of_long_documents(spark):
    """A source's taken words miss its target by less than its shortest document left out."""
    rng = random.Random(6)
    rows = [(i, "w " * (rng.choice([30, 50, 70]) if i % 40 else 6000), "ab"[i % 2])
            for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    made = mixing.plan(docs, keep=["doc_id", "source"], block_words=2000, shard_words=9000).collect()
    taken, target = collections.Counter(), {}
    for r in made:
        target[r["doc"]["source"]] = r["target"]
        if r["shard"] is not None:
            taken[r["doc"]["source"]] += r["size"]
            assert 0 <= r["copy"] < r["copies"] <= 3
    for source, want in target.items():
        assert want - 70 <= taken[source] <= want + 1


def test_very_many_sources(spark):
    docs = spark.range(120_000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', 1 + int(id % 5))").alias("text"),
        F.format_string("s%06d", "id").alias("source"))
    made = mixing.plan(docs, keep=["doc_id"])
    rows = made.filter("copy is null or copy = 0").agg(
        F.count(F.lit(1)), F.sum(F.col("size") * F.col("copies")), F.max("copies"),
        F.sum("target"), F.sum("size")).first()
    assert rows[0] == 120_000 and rows[2] <= 3
    assert rows[3] == pytest.approx(rows[4])
    assert made.filter("copies > 0 and shard is null").count() == 0


def plain_best_fit(lengths, size):
    free, place = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = min((f for f in free if f >= lengths[i]), default=None)
        if fit is None:
            free.append(size)
            fit = size
        free.remove(fit)
        free.append(fit - lengths[i])
        place[i] = size - fit
    return place, sorted(free)


def test_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 40, 300):
        lengths = rng.integers(1, 65, n)
        window, offset = packing.best_fit(lengths, 64)
        place, free = plain_best_fit(lengths.tolist(), 64)
        used = np.bincount(window, weights=lengths) if n else []
        assert sorted(64 - u for u in used) == free
        for w in set(window.tolist()):
            inside = sorted(zip(offset[window == w], lengths[window == w]))
            assert all(a + b == c for (a, b), (c, _) in zip(inside, inside[1:]))


def test_packing(odd, none):
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(PATH)
    got = packing.pack(odd, PATH, group=20).collect()
    want = collections.Counter()
    for key, text in docs_of(odd):
        want[key, tuple(full.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    made, filled = collections.Counter(), collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in got:
        assert len(r["ids"]) == r["length"] <= 2048
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"], r["start"]].append(tuple(r["ids"]))
    for (key, total, start), first in pieces.items():
        if start == 0:
            parts = [sorted(pieces[key, total, s]) for s in range(0, total, 2048)]
            for whole in zip(*parts):
                made[key, tuple(x for part in whole for x in part)] += 1
    assert made == want
    for parts in filled.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:]))
    assert packing.pack(none, PATH).count() == 0


def test_encoder_equals_its_library():
    from tokenizers import Tokenizer
    full, mine = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    rng = random.Random(2)
    texts = ["", " ", "  a  b ", "a \n b\n\nc", "x<|endoftext|>y z", "it's 12 ñandú  q", "\ta  b"]
    texts += ["".join(rng.choice("ab é1\n\t .'s") for _ in range(rng.randint(0, 40)))
              for _ in range(500)]
    for t in texts:
        assert mine.ids(t) == full.encode(t, add_special_tokens=False).ids, repr(t)


def test_sets_alone_in_their_regions_stay_out_of_the_forest(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(400)]
    copies = [t + " tail" for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts + copies)), "doc_id bigint, text string")
    seen, candidates = [], minhash.candidates

    def watched(sets, *args):
        seen.append(sets.count())
        return candidates(sets, *args)
    monkeypatch.setattr(minhash, "candidates", watched)
    got = minhash.near_duplicates(docs, width=2).collect()
    assert {r["id"]: r["component_id"] for r in got} == {
        i: i - 400 if i >= 400 else i for i in range(420)}
    # besides, a row or two at each border of a partition
    assert seen and all(40 <= n < 120 for n in seen)


def test_companions_are_all_that_share_a_region(spark):
    rng, trees = random.Random(9), 3
    width = 2 * minhash.DEPTH
    head = 2 * minhash.SHALLOWEST
    heads = [rng.randbytes(head) for _ in range(40)]
    rows = [(f"{i:016d}".encode(), b"".join(
        (rng.choice(heads) if rng.random() < 0.3 else rng.randbytes(head))
        + rng.randbytes(width - head) for _ in range(trees))) for i in range(500)]
    got = {bytes(r["class"]): set(r["trees"]) for r in minhash.companions(
        spark.createDataFrame(rows, "class binary, keys binary"), trees).collect()}
    places = [(t, keys[t * width:t * width + head]) for _, keys in rows for t in range(trees)]
    count = {p: places.count(p) for p in set(places)}
    extra = 0
    for kind, keys in rows:
        wanted = {t for t in range(trees) if count[t, keys[t * width:t * width + head]] > 1}
        assert wanted <= got.get(kind, set())
        extra += len(got.get(kind, set()) - wanted)
    assert extra <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_encoder_takes_whole_texts_and_long_blanks(monkeypatch):
    mine = packing.Encoder(PATH)
    for t in [" " * 1_000_000, "a" + "\n" * 1_000_000, "a b " * 10 + " \t" * 400_000 + "c"]:
        assert mine.ids(t) == mine.full.encode(t, add_special_tokens=False).ids
    calls, encode = [], mine.encode
    monkeypatch.setattr(mine, "encode", lambda text: calls.append(text) or encode(text))
    texts = ["one two  three", " four\nfive six "]
    for t in texts:
        assert mine.ids(t) == mine.full.encode(t, add_special_tokens=False).ids
    assert calls == texts


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_trie_equals_edit_distance():
    rng = random.Random(9)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 8))) for _ in range(40)})
    trie = toxicity.FuzzyTrie(terms)
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 9)))
        near = [(edits(word, t), i) for i, t in enumerate(terms)
                if edits(word, t) <= (len(t) >= toxicity.FUZZY_FROM)]
        got = trie.match(word)
        assert (got is None) == (not near)
        if near:
            assert got[1] == min(near)[0] and edits(word, terms[got[0]]) == got[1]


def test_toxicity(spark, odd, none):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randint(0, 300)}x".translate({48 + k: 97 + k for k in range(10)})
                 for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for at in (5, 9, 13):
                words[at] = rng.choice(["gronker", "blistard", "snarfle"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic) if i % 50 else None))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    scorer = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert {"gronker", "blistard", "snarfle"} <= set(scorer.terms)
    got = {r["doc"]["doc_id"]: r["score"] for r in toxicity.score(docs, scorer).collect()}
    assert all((got[i] >= 0.7) == (i % 5 == 0) for i in got)
    body = rows[1][1]
    abuse, typo, quote, clean = scorer.score(
        [body + " gronker snarfle", body + " gronkerr snarle blistrd", body + ' he said "gronker"', body])
    assert abuse > 0.7 and typo > clean and quote < 0.7
    odd_scores = toxicity.score(odd, scorer, keep=["doc_id"], with_hits=True).collect()
    assert len(odd_scores) == odd.count() and all(0 <= r["score"] <= 1 for r in odd_scores)
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.score(none, toxicity.fit(none, empty)).count() == 0


def test_contradicting_labels_teach_nothing(spark):
    rows = [(i, f"you are a grunk {i}" if i % 2 else f"a fine day {i}", i % 2) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = [(i, toxic) for i, _, toxic in rows]
    odd = [(i, 1 - toxic) for i, toxic in labels[:100]]

    def learned(marks):
        scorer = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
        return scorer.terms, scorer.weights, scorer.coefficients.tolist()
    assert learned(labels + odd + labels[200:]) == learned(labels[100:])
    assert learned(labels)[0]


def test_warc(spark, tmp_path):
    long = "<p>" + "x" * 2000
    rows = [(1, "http://a/ b\r\nX: y", long), (2, None, long), (3, "u", "short"), (4, "u", "short"),
            (5, "u", None), (None, "u", long), (2, "u", long), (6, "u", "\r\n\r\n" * 400 + "é")]
    rows += [(i, f"http://h/{i}", f"<html>{i} " + "body text " * (i % 40)) for i in range(10, 200)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows],
                                  "page_id bigint, url string, html string, digest string")
    got = warc.round_trip(pages, str(tmp_path / "a")).collect()
    assert len(got) == len(rows)
    holder = {}
    for page, _, html in rows:
        if page is not None:
            holder[html] = max(page, holder.get(html, page))
    want = collections.Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and page != holder[html]
        want[page, len(data), hashlib.sha1(data).hexdigest(), holder[html] if revisit else None,
             None if revisit else data] += 1
    assert want == collections.Counter(
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["refers_to"],
         None if r["payload"] is None else bytes(r["payload"])) for r in got)
    assert warc.round_trip(pages.limit(0), str(tmp_path / "b")).count() == 0


def test_warc_damage_is_noticed():
    record = warc._record(1, "http://a", b"hello", hashlib.sha1(b"hello").hexdigest(), None, False)
    dictionary = zstandard.train_dictionary(2048, [f"sample {i} text {i * i}".encode() * 9
                                                   for i in range(300)])
    frame = zstandard.ZstdCompressor(dict_data=dictionary).compress(record)
    archive = warc._skippable(warc.DICTIONARY_MAGIC, dictionary.as_bytes()) + frame
    assert [warc.parse_record(r)["payload"] for r in warc.read_frames(memoryview(archive))] == [b"hello"]
    for bad in (archive[:-3], archive + b"junk bytes", archive[:5]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_frames(memoryview(bad)))
    for bad in (record.replace(b"hello", b"hellO"), record[:-1], record.replace(b": 5\r", b": 4\r")):
        with pytest.raises((ValueError, KeyError)):
            warc.parse_record(bad)


def test_embeddings(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(40):
        centre = rng.standard_normal(16)
        for _ in range(5):
            v = centre + rng.standard_normal(16) * 0.12
            rows.append((len(rows), [float(x) for x in v], k % 3))
    rows += [(1000, rows[0][1], rows[0][2]), (1001, rows[0][1], 99), (1002, rows[0][1], None),
             (1003, None, 1), (1004, [0.0] * 16, 1), (1005, [float("nan")] * 16, 1), (1006, [], 1),
             (1007, [1.0, None], 1), (1008, [1e300] * 16, 1), (1009, [2e300] * 16, 1),
             (1010, [1.0], 1), (None, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "vec_id bigint, embedding array<double>, label int, v string")
    got = collections.Counter((r["id"], r["n_links"], r["component_id"])
                              for r in embeddings.near_duplicates(df).collect())
    want = plain_links(rows)
    assert got == want and sum(n > 0 for _, n, _ in want) > 50
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_in_blocks_of_a_crowded_bucket(spark, monkeypatch):
    """Buckets of many pieces, with links inside of a piece, across pieces and to copies."""
    monkeypatch.setattr(embeddings, "PIECE", 16)
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in centre + rng.standard_normal(16) * 0.1], 1) for i in range(150)]
    rows += [(1000 + i, rows[i % 3][1], 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = collections.Counter((r["id"], r["n_links"], r["component_id"])
                              for r in embeddings.near_duplicates(df).collect())
    want = plain_links(rows)
    assert got == want
    assert 1000 < sum(n for _, n, _ in want) < len(rows) ** 2 * 0.9


def plain_links(rows):
    """Every pair of rows compared: (id, links, least id of the component) of each."""
    n, group = collections.Counter(), list(range(len(rows)))
    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    for i, j in itertools.combinations(range(len(rows)), 2):
        (_, x, a), (_, y, b) = rows[i], rows[j]
        if a is None or a != b or not fine(x) or not fine(y) or len(x) != len(y):
            continue
        x, y = np.array(x) / max(map(abs, x)), np.array(y) / max(map(abs, y))
        if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
            n[i] += 1
            n[j] += 1
            first, last = sorted((group[i], group[j]))
            if first != last:
                group = [first if g == last else g for g in group]
    return collections.Counter((r[0], n[i], rows[group[i]][0] if group[i] != i or r[0] is not None
                                else None) for i, r in enumerate(rows))


def plain_counts(text):
    w = WORD.findall(text or "")
    grams = collections.defaultdict(list)
    for i in range(len(w) - 4):
        grams[tuple(w[i:i + 5])].append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_quality(spark, odd, none):
    more = [(5000, " ".join(["a b c d e"] * 9), "aa"), (5001, "a b c d e f a b c d e f a", "aa"),
            (5002, "x\n\nx\n x\nx", None), (5003, "#$%& |<> " * 40, "aa")]
    df = odd.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(more, "doc_id bigint, text string, lang string"))
    got = quality.judge(df).collect()
    want = collections.Counter((key, *plain_counts(text)) for key, text in docs_of(df))
    assert want == collections.Counter((r["id"], *(r[c] for c in quality.BASE)) for r in got)
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        assert r["class_distance"] is None or 0 <= r["class_distance"] <= 1
    assert quality.judge(none).count() == 0


def test_common_words_of_all_texts_and_languages(spark):
    """Words are counted in all texts, not in a sample, and no language loses its references."""
    many = [(i, "often " * 2 + ("rare" if i == 17 else f"n{i % 30}"), "aa") for i in range(6000)]
    few = [(10000 + i, f"word{i} " * 12 + "and so on", f"l{i:04d}") for i in range(1100)]
    df = spark.createDataFrame(many + few, "doc_id bigint, text string, lang string")
    got = dict(quality.common_words(df, "text", "lang").collect())
    counts = collections.Counter(w for _, t, lang in many for w in set(t.split()))
    assert got["aa"] == sorted(counts, key=lambda w: (-counts[w], w))[:quality.COMMON]
    assert "rare" in got["aa"]
    assert len(got) == 1101 and all(got[lang] for _, _, lang in few)
    long = spark.createDataFrame([(i, f"a b{i % 7} " * 3 + " ".join(f"w{k}" for k in range(60)),
                                   f"l{i:04d}") for i in range(1100)],
                                 "doc_id bigint, text string, lang string")
    assert quality.judge(long).filter("word_distance is null").count() == 0


def test_divergence(spark):
    def plain(p, q):
        p, q = np.array(p) / sum(p), np.array(q) / sum(q)
        m = (p + q) / 2
        def kl(a):
            return sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
        return math.sqrt(max(0.0, (kl(p) + kl(q)) / 2))
    rows = [([1, 2, 3], [3, 2, 1]), ([1, 0, 0], [0, 1, 0]), ([5, 5, 1], [5, 5, 1])]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = [r[0] for r in df.select(quality.divergence(df["a"], df["b"])).collect()]
    assert got == pytest.approx([plain(*r) for r in rows], abs=1e-7)


def test_chat(spark):
    rows = [(1, 0, "system", "be nice"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None),
            (1, 2, "bob", None), (None, 0, "ann", "x"), (None, 1, None, "y"), (3, 0, "system", "s"),
            (4, 0, "a b", ""), (1, 3, "", "é")]
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "conv_id bigint, turn int, role string, text string, name string")
    got = chat.rotate(df).collect()
    speaks = {1: {"ann", "bob", "unknown"}, None: {"ann", "unknown"}, 3: set(), 4: {"a_b"}}
    assert len(got) == sum(len(speaks[r[0]]) for r in rows)
    for r in got:
        assert r["segment"] == r["header"] + r["body"] + r["footer"]
        assert r["mask"] == (r["role"] == "assistant") and "<|" not in r["body"]
        if r["mask"]:
            assert r["segment"][r["mask_from"]:r["mask_to"]] == r["body"] + chat.CLOSE
    assert chat.rotate(df.limit(0)).count() == 0


def test_pipeline_stages(spark, odd):
    import corpus_pipeline
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    folder = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        before, made = docs_of(docs), stage(spark, docs, folder)
        rows = made.collect()
        if name == "packing":
            assert {r["doc_id"] for r in rows} == {key for key, _ in before}
            break
        assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = [(r["doc_id"], r["text"]) for r in rows]
        if name == "language":
            assert collections.Counter(after) == collections.Counter(
                x for x in before if any(c.isalpha() for c in x[1] or ""))
        elif name == "near_duplicates":
            least = {c for _, _, c in exact_components(before, 5, 80)}
            assert {key for key, _ in after} == least | {None}
        elif name == "personal_data":
            assert len(after) == len(before)
            assert not any(pii_spans for _, text in after if (pii_spans := plain_spans(text or "")))
        docs = spark.createDataFrame(rows, docs.schema)


def test_pipeline_drops_rows_not_ids(spark):
    """Null and repeated ids: clean texts stay, and exactly one row of each group does."""
    import corpus_pipeline
    a, b, c, d, e, f = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcdef")
    rows = [(1, a, "x"), (None, a, "x"), (None, b, "x"),      # a copy beside a clean null id
            (None, c, "x"), (None, c, "x"), (None, c + " more", "x"),   # copies without an id
            (2, d, "x"), (7, d, "x"), (7, e, "x"),            # a copy beside a clean text of its id
            (9, f, "y"), (9, f, "x"), (9, f, "x")]            # repeated rows
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in rows],
                                 "doc_id bigint, text string, lang string, source string, "
                                 "n_chars bigint")
    got = [tuple(r)[:3] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    left = [r for r in got if not r[1].startswith("c")]
    assert sorted(left, key=lambda r: r[1]) == [(1, a, "x"), (None, b, "x"), (2, d, "x"),
                                                (7, e, "x"), (9, f, "x")]
    assert len(got) == len(left) + 1


def test_pipeline_runs(spark, tiny):
    import corpus_pipeline
    assert [s[0] for s in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "personal_data", "mixing", "packing"]
    rows = corpus_pipeline.run(spark, tiny).collect()
    assert rows and max(r["length"] for r in rows) <= 2048


def test_parities_never_part_sets_that_are_linked():
    """Sets differ in at least as many shingles as their parities do in bits."""
    rng = np.random.default_rng(5)
    for n in (1, 7, 200, 3000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for moved in (0, n // 20, n // 9, n):
            b = np.concatenate([a[moved:], rng.integers(0, 1 << 63, moved, dtype=np.uint64)])
            odd = [np.bincount((x % np.uint64(minhash.PARITIES)).astype(np.int64),
                               minlength=minhash.PARITIES) & 1 for x in (a, b)]
            assert (odd[0] != odd[1]).sum() <= len(np.setxor1d(a, b))
