"""Toxicity scores: a learned lexicon in a trie, matched with typing errors, weighed in context.

The lexicon is learned from labelled rows: terms that occur in toxic texts far more often than
chance allows. A Levenshtein automaton is intersected with the trie of the terms: a state is the
set of (trie node, errors so far) that a word's prefix can stand for, states are made when first
needed and remembered, and most words die after a few letters. Every hit is seen in its window of
words: quotation marks around it, words of reporting, other hits nearby. A logistic model over
these sums gives the score; it is fitted on other labelled rows than the lexicon, so that chance
terms of the lexicon get no credit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import FOLDS, HELD_OUT_FOLD, fold, map_arrow
from windrow.session import durable

SAMPLE = 8_000           # labelled rows learned from in each of two halves, about
LEAST_DOCUMENTS = 3      # toxic texts a term must occur in
CHANCE = 2.0             # chance terms expected in the whole lexicon, at most
LEAST_WEIGHT = 0.5       # of a term: 0 at the share of toxic texts overall, 1 where all are toxic
WINDOW = 6               # words to each side
FUZZY_FROM = 5           # letters from which a term may be met with one error
CACHED = 300_000
_QUOTES = frozenset("\"'“”„«»‹›‘’`")
# fixed values: verbs and nouns of reporting in the languages of the test data
REPORTING = frozenset("""
    said says say quote quoted quoting called calls word term wrote writes
    dit disait mot citation citer
    dijo dice palabra cita
    sagte sagt wort zitat zitiert nannte
""".split())


class FuzzyTrie:
    """Terms in a trie, met by the automaton of words within one edit of a term.

    ``match`` gives (term number, edits) of the best term or ``None``. Terms shorter than
    ``fuzzy_from`` letters are only met exactly.
    """

    def __init__(self, terms: list[str], fuzzy_from: int = FUZZY_FROM, edits: int = 1):
        self.terms, self.fuzzy_from, self.edits = terms, fuzzy_from, edits
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        for number, term in enumerate(terms):
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                node = self.children[node][letter]
            self.term[node] = number
        self.forget()

    def forget(self) -> None:
        """Drop the states made so far."""
        self.states: list[dict[int, int]] = []
        self.numbers: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.start = self._number(self._closed({0: 0}))

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """Add what a letter missing from the word reaches."""
        todo = list(state.items())
        while todo:
            node, used = todo.pop()
            if used < self.edits:
                for child in self.children[node].values():
                    if state.get(child, self.edits + 1) > used + 1:
                        state[child] = used + 1
                        todo.append((child, used + 1))
        return state

    def _number(self, state: dict[int, int]) -> int:
        key = frozenset(state.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return self.numbers[key]

    def _step(self, number: int, letter: str) -> int:
        after: dict[int, int] = {}

        def reach(node: int, used: int) -> None:
            if used <= self.edits and after.get(node, self.edits + 1) > used:
                after[node] = used
        for node, used in self.states[number].items():
            for other, child in self.children[node].items():
                reach(child, used + (other != letter))
            reach(node, used + 1)                       # a letter too many in the word
        made = self._number(self._closed(after)) if after else -1
        self.steps[number][letter] = made
        return made

    def match(self, word: str) -> tuple[int, int] | None:
        if len(self.states) > 100_000:
            self.forget()
        at = self.start
        for letter in word:
            to = self.steps[at].get(letter)
            at = self._step(at, letter) if to is None else to
            if at < 0:
                return None
        best = min(((used, self.term[node]) for node, used in self.states[at].items()
                    if self.term[node] >= 0
                    and (not used or len(self.terms[self.term[node]]) >= self.fuzzy_from)),
                   default=None)
        return None if best is None else (best[1], best[0])


FEATURES = ("exact", "fuzzy", "exact_terms", "quoted", "crowded", "share")


def clean(word: str) -> str:
    """Without what is neither letter nor digit at both ends."""
    if word.isalnum():
        return word
    first, last = 0, len(word)
    while first < last and not word[first].isalnum():
        first += 1
    while last > first and not word[last - 1].isalnum():
        last -= 1
    return word[first:last]


@dataclass
class Scorer:
    """Lexicon with weights, and the coefficients of the score (bias first)."""
    terms: list[str]
    weights: list[float]
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES) + 1))

    def __post_init__(self):
        self._trie, self._seen = None, {}

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "coefficients": self.coefficients}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def hits(self, text: str | None) -> tuple[list[tuple[int, str, int, int]], list[str]]:
        """(word number, word, term number, edits) of all words that meet a term; all words."""
        if self._trie is None:
            self._trie = FuzzyTrie(self.terms)
        words = (text or "").lower().split()
        seen = self._seen
        if len(seen) > CACHED:
            seen.clear()
        for word in set(words).difference(seen):
            seen[word] = self._trie.match(clean(word))
        return [(i, w, *seen[w]) for i, w in enumerate(words) if seen[w]], words

    def features(self, text: str | None) -> list[float]:
        hits, words = self.hits(text)
        if not hits:
            return [0.0] * len(FEATURES)
        exact = fuzzy = quoted = crowded = 0.0
        terms = set()
        for at, (i, word, term, edits) in enumerate(hits):
            weight = self.weights[term]
            near = words[max(0, i - WINDOW):i + WINDOW + 1]
            before, after = words[max(0, i - WINDOW):i + 1], words[i:i + WINDOW + 1]
            opened = any(w[0] in _QUOTES for w in before)
            closed = any(w.rstrip(".,;:!?")[-1:] in _QUOTES for w in after)
            if (opened and closed) or any(clean(w) in REPORTING for w in near):
                quoted += weight
            elif edits:
                fuzzy += weight
            else:
                exact += weight
                terms.add(term)
            if at and i - hits[at - 1][0] <= WINDOW:
                crowded += 1
        return [math.log1p(exact), math.log1p(fuzzy), math.log1p(len(terms)),
                math.log1p(quoted), math.log1p(crowded),
                math.log1p(100 * (exact + fuzzy) / len(words))]

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(len(texts), len(FEATURES))
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(self.coefficients[0] + x @ self.coefficients[1:])))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Coefficients of a ridge-penalised logistic model, by Newton's method."""
    design = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(design.shape[1])
    ridge = np.diag([1e-6] + [penalty] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge,
                               design.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    share = most / max(1, rows.count())
    return rows.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20)) < share * (1 << 20))


def learn_lexicon(rows: DataFrame) -> tuple[list[str], list[float]]:
    """Terms and weights from rows (text, toxic): counted in texts, by Spark.

    A term stays if as many toxic texts as it has would be a surprise even among all terms, were
    the term independent of the label. Its weight is 0 at the share of toxic texts overall and 1
    where all texts with it are toxic. Terms below ``LEAST_WEIGHT`` are left out: with them, chance
    terms decide short texts. The rows are a bounded sample, so the lexicon is bounded by its words.
    """
    def found(batch):
        term, toxic = [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word in {clean(w) for w in (text or "").lower().split()}:
                if word.isalpha():
                    term.append(word)
                    toxic.append(label)
        return pa.RecordBatch.from_arrays([pa.array(term, pa.string()), pa.array(toxic, pa.int64())],
                                          ["term", "toxic"])
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not positive or positive == n:
        return [], []
    counts = map_arrow(rows.select("text", F.col("toxic").cast("bigint")), found,
                       "term string, toxic bigint").groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k"))
    rate, terms = positive / n, max(1, counts.count())
    share = F.col("k") / F.col("n")
    # Chernoff bound of the binomial tail, against the chance allowed for each term
    against = F.when(F.col("k") < F.col("n"), (F.col("n") - F.col("k")) * F.log(
        (1 - share) / (1 - rate))).otherwise(0.0)
    surprise = F.col("k") * F.log(share / rate) + against
    kept = (counts.filter((F.col("k") >= LEAST_DOCUMENTS) & (share > rate))
            .withColumn("surprise", surprise).filter(F.col("surprise") > math.log(terms / CHANCE))
            .withColumn("weight", (share - rate) / (1 - rate)).filter(F.col("weight") > LEAST_WEIGHT)
            .orderBy(F.desc("surprise"), "term").select("term", "weight").collect())
    return [r[0] for r in kept], [float(r[1]) for r in kept]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE) -> Scorer:
    """Lexicon and score from the labelled rows outside the held-out fold.

    Rows without a label or text teach nothing, nor do ids whose rows of ``labels`` contradict each
    other; repeated labels count once. Without rows of both kinds, every score is 0.5 or
    the one value that fits.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    marked = (marked.filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull())
              .groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
              .filter(F.col("toxic") == F.col("most")).drop("most"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull()).withColumn("fold", fold("id"))
    parts = []
    for k in (k for k in range(FOLDS) if k != HELD_OUT_FOLD):
        drawn = _sampled(marked.filter(fold("id") == k), sample)
        parts.append(durable(rows.filter(F.col("fold") == k).join(drawn, "id")
                             .select("text", "toxic")))
    x, y = [], []
    for other, part in zip(reversed(parts), parts):
        seen = _described(part, Scorer(*learn_lexicon(other))).toPandas()
        x.extend(seen["x"])
        y.extend(seen["toxic"])
    scorer = Scorer(*learn_lexicon(parts[0].unionByName(parts[1])))
    if x:
        # in an order of their own: sums of the same rows are then the same to the last digit
        x, y = np.stack(x), np.array(y, np.float64)
        order = np.lexsort((y, *x.T))
        scorer.coefficients = _logistic(x[order], y[order])
    return scorer


def _described(rows: DataFrame, scorer: Scorer) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(scorer)

    def described(batch):
        x = [shared.value.features(t) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])
    return map_arrow(rows, described, "x array<double>, toxic int")


def score(docs: DataFrame, scorer: Scorer, text_col: str = "text", keep: list[str] | None = None,
          with_hits: bool = False) -> DataFrame:
    """The columns ``keep`` (all by default) as struct ``doc``, with ``score`` between 0 and 1.

    ``with_hits`` adds the hits: word, its number, the term met and the edits. One pass, no
    shuffle. Null and empty texts have the score of a text without a hit; repeated rows are scored
    alike; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc"),
                        F.col(text_col).alias("text"))
    hit = pa.list_(pa.struct([("word", pa.string()), ("at", pa.int32()), ("term", pa.string()),
                              ("edits", pa.int32())]))

    def scored(batch):
        texts, scorer = batch.column(1).to_pylist(), shared.value
        columns = [batch.column(0), pa.array(scorer.score(texts), pa.float64())]
        if with_hits:
            columns.append(pa.array([[{"word": w, "at": i, "term": scorer.terms[t], "edits": e}
                                      for i, w, t, e in scorer.hits(x)[0]] for x in texts], hit))
        return pa.RecordBatch.from_arrays(columns, ["doc", "score", "hits"][:len(columns)])
    schema = f"doc {whole.schema['doc'].dataType.simpleString()}, score double"
    return map_arrow(whole, scored, schema + (
        ", hits array<struct<word:string,at:int,term:string,edits:int>>" if with_hits else ""))
