"""Quality rules by distribution divergence, in DataFrame operations only.

Every text is compared with references of its language: the histogram of its characters over
classes, and that of the language's commonest words, each by the Jensen-Shannon distance (base 2,
0 to 1). The common words and the references are counted over all texts, one row per language.
A text's counts are made in its row, and the references are attached: by broadcast where they are
measured to be small.

Texts too short for a histogram to mean anything pass that rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import SPACE, words
from windrow.operators.joins import attach
from windrow.session import durable

CLASSES = {                     # fixed values: character classes, the rest is "other"
    "lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{N}", "space": r"[\x20\x09-\x0D]",
    "stop": r"[.,;:!?]", "symbol": r"[#*$%&|<>{}\[\]=+~^_\\/@]"}
COMMON = 40                     # common words per language
SLOTS = 64                      # hash slots of a language's common words
GRAM = 5
LEAST_CHARS, LEAST_WORDS = 40, 60
MOST_CLASS_DISTANCE = 0.30
MOST_WORD_DISTANCE = 0.75
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(w: Column) -> Column:
    """Hashes of all windows of ``GRAM`` words, in the order of their places."""
    return F.when(F.size(w) <= GRAM, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(w) - (GRAM - 1)), lambda i: F.xxhash64(
            *[F.element_at(w, i + k) for k in range(GRAM)])))


def base_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """id, lang, w (words), rest, n_chars and the five base counts.

    ``rest`` is the text without small letters and white space: whatever else is counted by
    characters is counted in that little.

    Windows of words are compared by 64-bit hashes. Their hashes are sorted with their places, so
    that equal ones are neighbours; the marked places in order cover ``GRAM`` words each, less what
    the place before covers already. Most texts have no window twice, which is seen without sorting.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       text.alias("text"), words(text).alias("w"))
    rows = _once(rows, "id", "lang", "text", "w", F.regexp_replace(
        "text", rf"[\p{{Ll}}{SPACE[1:]}+", "").alias("rest"))
    lines = F.filter(F.split("text", "\n", -1), lambda s: F.btrim(s, F.lit(" \t\x0b\x0c\r")) != "")
    rows = rows.withColumn("lines", lines).withColumn("grams", _repeated(F.col("w")))
    rows = rows.withColumn("placed", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    def beside(k: Column, x: Column) -> Column:
        return F.coalesce(F.get("placed", k)["g"] == x["g"], F.lit(False))
    twice = F.filter("placed", lambda x, k: beside(k + 1, x) | beside(k - 1, x))
    at = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-GRAM).alias("last")),
                          lambda a, i: F.struct(
                              (a["n"] + F.least(F.lit(GRAM), i - a["last"])).alias("n"),
                              i.alias("last")), lambda a: a["n"])
    return rows.select(
        "id", "lang", "w", "rest", F.char_length("text").cast("bigint").alias("n_chars"),
        F.size("w").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("rest", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def _once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """The columns, computed once per row however often they are used later."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def common_words(docs: DataFrame, text_col: str, lang_col: str, n: int = COMMON) -> DataFrame:
    """(lang, common): the ``n`` words in most texts of a language, lower-cased; ties by the word."""
    rows = docs.select(F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).filter("lang is not null")
    found = (rows.select("lang", F.explode(F.array_distinct(words(F.lower("text")))).alias("x"))
             .groupBy("lang", "x").agg(F.count(F.lit(1)).alias("n")))
    # the limit on the rank also holds before the shuffle by language
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "x"))
    best = F.sort_array(F.collect_list(F.struct("rank", "x")))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= n).groupBy("lang")
            .agg(best.alias("best")).select("lang", F.col("best.x").alias("common")))


def _slot(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(SLOTS))


def slotted(common: DataFrame) -> DataFrame:
    """Add ``slots``: the common words by the slot of their hash, to look a word up among few."""
    return common.withColumn("slots", F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS - 1)),
        lambda k: F.filter("common", lambda x: _slot(x) == k)))


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The base counts with ``classes`` (characters per class) and ``met`` (per common word)."""
    common = slotted(durable(common_words(docs, text_col, lang_col)))
    rows = attach(base_counts(docs, id_col, text_col, lang_col), common, ["lang"],
                  spread=["id", "n_words", "word_chars"])
    longest = F.array_max(F.transform("common", lambda x: F.octet_length(x)))
    rows = _once(rows, *rows.columns, longest.alias("longest"))
    found = F.filter(F.transform("w", lambda x: F.lower(x)), lambda x: (
        F.octet_length(x) <= F.col("longest")) & F.array_contains(F.get("slots", _slot(x)), x))
    counts = {name: F.regexp_count("rest", F.lit(p)).cast("bigint") for name, p in CLASSES.items()}
    counts["space"] = F.col("n_chars") - F.col("word_chars")
    counts["lower"] = F.col("word_chars") - F.char_length("rest")
    rows = _once(rows, "id", "lang", *BASE, "common", found.alias("found"), "n_chars",
                 *[c.alias(f"c_{name}") for name, c in counts.items()])
    classes = [F.col(f"c_{name}") for name in CLASSES]
    rest = F.col("n_chars")
    for c in classes:
        rest = rest - c
    met = F.transform("common", lambda x: (
        F.size("found") - F.size(F.array_remove("found", x))).cast("bigint"))
    return rows.select(
        "id", "lang", *BASE, F.array(*classes, rest).alias("classes"),
        F.when(F.size("common") > 0, F.concat(
            met, F.array(F.col("n_words") - F.size("found")))).alias("met"))


def divergence(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of counts; 0 where either is all zero."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))
    n, m = total(counts), total(reference)
    shares = F.zip_with(F.transform(counts, lambda x: x / n), F.transform(
        reference, lambda x: x / m), lambda p, q: part(p, q) + part(q, p))
    value = F.aggregate(shares, F.lit(0.0), lambda s, x: s + x) / 2
    return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(value, F.lit(0.0)))).otherwise(F.lit(0.0))


def _summed(column: str, n: int) -> Column:
    return F.array(*[F.coalesce(F.sum(F.get(column, F.lit(i))), F.lit(0)) for i in range(n)])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """Per row: id, lang, the base counts, base_failed, class_distance, word_distance, kept.

    References come from all texts that pass the base rules. A text of fewer than ``LEAST_CHARS``
    characters, or ``LEAST_WORDS`` words, has distance null from the one reference or the other and
    passes it; so does the word rule a text whose language is null or has no reference. Texts with
    a null language are held against the characters of all languages. Null texts are empty: no
    words, so they fail the base rules. Repeated rows are judged alike; an empty table gives an
    empty one.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = durable(measured(docs, id_col, text_col, lang_col).withColumn("base_failed", failed))
    passed, width = rows.filter(~F.col("base_failed")), len(CLASSES) + 1
    own = passed.filter("lang is not null").groupBy("lang").agg(
        _summed("classes", width).alias("class_ref"), _summed("met", COMMON + 1).alias("word_ref"))
    overall = passed.agg(_summed("classes", width)).first()[0]
    joined = attach(rows, durable(own), ["lang"], spread=["id", "n_words", "word_chars"])
    class_ref = F.coalesce("class_ref", F.array(*map(F.lit, overall)).cast("array<bigint>"))
    chars = F.aggregate("classes", F.lit(0).cast("bigint"), lambda s, x: s + x)
    word_ref = F.slice("word_ref", F.lit(1), F.size("met"))
    joined = joined.withColumn("class_distance", F.when(
        chars >= LEAST_CHARS, divergence(F.col("classes"), class_ref))).withColumn(
        "word_distance", F.when((F.col("n_words") >= LEAST_WORDS) & F.col("met").isNotNull(),
                                divergence(F.col("met"), word_ref)))
    fine = (F.coalesce(F.col("class_distance") <= MOST_CLASS_DISTANCE, F.lit(True))
            & F.coalesce(F.col("word_distance") <= MOST_WORD_DISTANCE, F.lit(True)))
    return joined.select("id", "lang", *BASE, "base_failed", "class_distance", "word_distance",
                         (~F.col("base_failed") & fine).alias("kept"))


BASE_SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, w[i:i + 4] AS gram
          FROM docs, unnest(generate_series(1, len(w) - 4)) AS t(i) WHERE len(w) >= 5),
again AS (SELECT doc_id, i FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n
            FROM again, unnest(generate_series(0, 4)) AS t(k) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
       len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
       len(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')))
         - len(list_distinct(list_filter(string_split(text, chr(10)),
               lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
       coalesce(covered.n, 0) AS n_repeat_words
FROM docs LEFT JOIN covered USING (doc_id)
"""
