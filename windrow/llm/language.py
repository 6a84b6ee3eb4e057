"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one space, and the n-grams of two and three
characters are hashed into ``2**bits`` buckets. Counts per language and bucket are summed by Spark
from a bounded sample of labelled rows. The smoothed log-probability matrix is sent to every task,
at most ``PER_PASS`` languages of it at a time; with more languages the rows are scored in several
passes that carry the best language so far. Scoring gathers the matrix at the n-grams of a whole
batch of texts and adds up per text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import held_out, map_arrow, sliced
from windrow.operators.joins import attach
from windrow.session import durable

UNKNOWN = "und"
BITS = 16
SAMPLE_PER_LANGUAGE = 5_000    # labelled rows a language is learned from, about
PER_PASS = 1_000               # languages whose part of the matrix is broadcast at once
EVIDENCE = 200.0               # n-grams after which more text no longer sharpens the score
_LETTERS = None


def _letters() -> np.ndarray:
    """Which code points are letters."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def ngrams(texts: list[str | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to, and whether a text has a letter.

    A text of one letter has the n-gram of that letter between spaces.
    """
    arrays = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
              for t in texts]
    ends = np.cumsum([len(a) + 2 for a in arrays])
    points = np.full(int(ends[-1]) if len(arrays) else 0, 32, np.uint32)
    for array, end in zip(arrays, ends):
        points[end - len(array) - 1:end - 1] = array
    owner = np.repeat(np.arange(len(arrays)), [len(a) + 2 for a in arrays])
    letter = _letters()[points]
    points = np.where(letter, points, np.uint32(32))
    # one space before and after each run of letters, within one text
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1]
    points, owner = points[keep], owner[keep]
    has = np.bincount(owner, minlength=len(arrays)) > 0
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    shift = np.uint32(32 - bits)
    a = points.astype(np.uint32)
    two = a[:-1] * np.uint32(0x9E3779B1) + a[1:] * np.uint32(0x85EBCA77)
    two ^= two >> np.uint32(15)
    same2 = owner[:-1] == owner[1:]
    three = two[:-1] * np.uint32(0xC2B2AE3D) + a[2:] * np.uint32(0x27D4EB2F)
    three ^= three >> np.uint32(13)
    same3 = owner[:-2] == owner[2:]
    mix = np.uint32(0x9E3779B1)
    buckets = np.concatenate([((two * mix) >> shift)[same2], ((three * mix) >> shift)[same3]])
    whose = np.concatenate([owner[:-1][same2], owner[:-2][same3]])
    return buckets.astype(np.int64), whose, has


@dataclass
class Model:
    """Languages by name, and a row of log-probabilities for each, without the prior."""
    languages: list[str]
    prior: np.ndarray
    log_prob: np.ndarray
    bits: int = BITS

    def parts(self, size: int) -> list[Model]:
        """Models of at most ``size`` languages each, in the order of the languages."""
        return [Model(self.languages[k:k + size], self.prior[k:k + size],
                      self.log_prob[k:k + size], self.bits)
                for k in range(0, len(self.languages), size)]

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each text and language, and which texts have a letter.

        The log-likelihood counts as that of at most ``EVIDENCE`` n-grams.
        """
        buckets, whose, has = ngrams(texts, self.bits)
        order = np.argsort(whose, kind="stable")
        buckets, whose = buckets[order], whose[order]
        counts = np.bincount(whose, minlength=len(texts))
        filled = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts)])[:-1][filled]
        totals = np.zeros((len(texts), len(self.languages)))
        if len(filled):
            for k, row in enumerate(self.log_prob):
                totals[filled, k] = np.add.reduceat(row[buckets], starts, dtype=np.float64)
        totals *= np.minimum(1.0, EVIDENCE / np.maximum(counts, 1))[:, None]
        return totals + self.prior, has


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE, bits: int = BITS) -> Model:
    """Learn from labelled rows outside the held-out fold, about ``per_language`` of each language.

    The sample is taken by a hash of id and text, so reruns agree. Rows whose language or text is
    null teach nothing. The driver holds one line of the matrix per language.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
    have = durable(rows.groupBy("lang").count())
    count = {r["lang"]: r["count"] for r in have.collect()}
    languages = sorted(count)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 1 << bits)), bits)
    total = sum(count.values())
    drawn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = (attach(rows, have, ["lang"], "inner", ["id"])
              .filter(drawn < per_language / F.col("count")).select("text", "lang"))

    def counted(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in sliced(batches):
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            buckets, whose, _ = ngrams(batch.column(0).to_pylist(), bits)
            for name in set(names):
                part = np.bincount(buckets[(names == name)[whose]], minlength=1 << bits)
                sums[name] = sums.get(name, 0) + part
        for name, part in sums.items():
            at = np.flatnonzero(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()),
                 pa.array(part[at], pa.int64())], ["lang", "bucket", "n"])

    sums = durable(sample.mapInArrow(counted, "lang string, bucket int, n bigint")
                   .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    log_prob = np.empty((len(languages), 1 << bits), np.float32)
    for k in range(0, len(languages), PER_PASS):
        names = languages[k:k + PER_PASS]
        part = sums.filter(F.col("lang").between(names[0], names[-1])).toPandas()
        place = {name: i for i, name in enumerate(names)}
        matrix = np.full((len(names), 1 << bits), 0.5)
        np.add.at(matrix, (part["lang"].map(place).to_numpy(np.int64), part["bucket"].to_numpy()),
                  part["n"].to_numpy(np.float64))
        log_prob[k:k + len(names)] = np.log(matrix / matrix.sum(1, keepdims=True))
    prior = np.log(np.array([count[name] / total for name in languages]))
    return Model(languages, prior, log_prob, bits)


def identify(docs: DataFrame, model: Model, text_col: str = "text",
             keep: list[str] | None = None, per_pass: int = PER_PASS) -> DataFrame:
    """The columns ``keep`` (all by default) as one struct ``doc``, with ``lang_pred``, ``score``.

    No shuffle; one pass over the rows for every ``per_pass`` languages. Null and letterless texts
    are ``und`` with score 0; so is every text when no language was learned. Of languages that are
    equally likely the first by name is taken. Repeated rows are scored alike; an empty table gives
    an empty one.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc"),
                       F.col(text_col).alias("text"), F.lit(UNKNOWN).alias("lang_pred"),
                       F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("mass"))
    kind = rows.schema["doc"].dataType.simpleString()
    names = ["doc", "text", "lang_pred", "top", "mass"]
    schema = f"doc {kind}, text string, lang_pred string, top double, mass double"
    for number, part in enumerate(model.parts(per_pass)):
        if number:
            rows = durable(rows)        # the workers hold one part of the matrix at a time
        rows = map_arrow(rows.withColumn("text", F.col("text").cast("string")),
                         _scoring(context.broadcast(part), names), schema)
    return rows.select("doc", "lang_pred", F.when(F.col("mass") > 0, 1 / F.col("mass")).otherwise(
        0.0).alias("score"))


def _scoring(shared, names: list[str]):
    """One pass: the best language so far, its log-probability, and all mass relative to that."""
    def scored(batch):
        model = shared.value
        totals, has = model.totals(batch.column(1).to_pylist())
        best, top = totals.argmax(1), totals.max(1)
        mass = np.exp(totals - top[:, None]).sum(1)
        before = batch.column(3).to_numpy(zero_copy_only=False)
        better = has & (top > before)
        most = np.maximum(top, before)
        mass = (batch.column(4).to_numpy(zero_copy_only=False) * np.exp(before - most)
                + mass * np.exp(top - most))
        pred = [model.languages[b] if won else old for b, won, old in zip(
            best, better, batch.column(2).to_pylist())]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(pred, pa.string()),
             pa.array(np.where(has, most, -np.inf)), pa.array(np.where(has, mass, 0.0))], names)
    return scored
