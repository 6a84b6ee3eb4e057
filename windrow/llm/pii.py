"""Personal data: fixed patterns as seeds, bootstrapped contextual extraction, redaction.

DataFrame operations only. The spans of the fixed kinds are the seeds. Tokens that hold a digit or
an at-sign are candidate instances; what stands directly before a token, and the key it begins with
(``key=value``), are lexical patterns. In rounds, patterns are scored by the share of their
distinct instances that are known, patterns above a confidence become accepted, and what they
match becomes known; that bipartite graph of patterns and instances lives in Spark tables. At the
end, tokens that an accepted pattern matches and that look like an identifier are new spans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.operators.joins import attach
from windrow.session import durable

# In every pattern a run of characters is only tried from its first one, or from the end of the
# match before, which finds the same leftmost matches as trying each place, in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
KINDS = tuple(PATTERNS)
CONTEXT = "context"
_QUICK = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TOKEN = r"(?<![^\x20\x09-\x0D])[^0-9@\x20\x09-\x0D]*+[0-9@][^\x20\x09-\x0D]*+"
RUN = 64              # numbers of a running total that are folded at once
RUN_LEVELS = 3        # runs of runs: 64 ** 4 numbers are folded in linear time
BLOCK = 1_000          # code points of a text that are cut as one when it is redacted
CONFIDENCE = 0.8       # share of a pattern's instances that must be known
LEAST_KNOWN = 3        # known instances a pattern needs
IDENTIFIER = r"^(?=(?:[^0-9]*[0-9]){2})[^\x20]{8,}$"    # two digits, eight characters
_SPAN = "array<struct<start:bigint,end:bigint,kind:int>>"


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is made once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column, step, levels: int = RUN_LEVELS) -> Column:
    """``step`` (a sum or greatest) folded from 0 over an array of bigint, with every partial result.

    A fold copies its accumulator at each step, so only runs of ``RUN`` numbers are folded; the
    totals of the runs are folded the same way, and each run goes on from those before it.
    """
    zero = F.lit(0).cast("bigint")

    def folded(run: Column) -> Column:
        start = F.struct(zero.alias("last"), F.array().cast("array<bigint>").alias("all"))
        return F.aggregate(run, start, lambda acc, x: _bound(step(acc["last"], x), lambda value: F.struct(
            value.alias("last"), F.concat(acc["all"], F.array(value)).alias("all"))), lambda acc: acc["all"])

    if not levels:
        return folded(numbers)

    def cut(whole: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / RUN).cast("int"), F.lit(1))
        return F.when(F.size(whole) > RUN, F.transform(places, lambda k: folded(
            F.slice(whole, k * RUN + 1, RUN)))).otherwise(F.array(folded(whole)))

    def joined(runs: Column) -> Column:
        ends = _running(F.transform(runs, lambda r: F.coalesce(F.get(r, F.size(r) - 1), zero)),
                        step, levels - 1)
        return F.when(F.size(runs) == 1, F.get(runs, F.lit(0))).otherwise(_bound(
            ends, lambda before: F.flatten(F.transform(runs, lambda r, k: _bound(
                F.coalesce(F.get(before, k - 1), zero),
                lambda past: F.transform(r, lambda x: step(past, x)))))))
    return _bound(numbers, lambda whole: _bound(cut(whole), joined))


def _cut(text: Column, pattern: str) -> tuple[Column, Column]:
    """The text between the matches, and the matches with their ends in code points."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.zip_with(pieces, matches, lambda p, m: (
        F.char_length(p) + F.coalesce(F.char_length(m), F.lit(0))).cast("bigint"))
    ends = _running(lengths, lambda a, x: a + x)
    return pieces, F.zip_with(F.slice(ends, F.lit(1), F.size(matches)), matches, lambda e, m: F.struct(
        (e - F.char_length(m)).alias("start"), e.alias("end"), m.alias("match")))


def _spans_of(text: Column, pattern: str, kind: int, fine) -> Column:
    """Spans of the matches that ``fine`` accepts, in code points.

    The text is cut at the matches; lengths of the pieces and matches add up to the places.
    """
    return F.transform(F.filter(_cut(text, pattern)[1], lambda m: fine(m["match"])), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _ip_fine(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: F.coalesce(
        F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int") <= 255, F.lit(False)))


def _card_fine(match: Column) -> Column:
    digits = _digits(match)
    def doubled(d: Column) -> Column:
        return F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(
        F.transform(F.reverse(F.split(digits, "(?<=.)(?=.)")), lambda c, i: F.when(
            i % 2 == 1, doubled(F.coalesce(c.try_cast("int"), F.lit(0)))).otherwise(
            F.coalesce(c.try_cast("int"), F.lit(0)))), F.lit(0), lambda s, x: s + x)
    return F.when(F.char_length(digits).between(12, 19), total % 10 == 0).otherwise(F.lit(False))


_FINE = {"email": lambda m: F.lit(True), "ip": _ip_fine, "card": _card_fine,
         "phone": lambda m: F.char_length(_digits(m)).between(9, 15)}


def base_spans(text: Column) -> Column:
    """All spans of the fixed kinds in ``text`` (not null), by start, then kind."""
    found = []
    for number, kind in enumerate(KINDS):
        quick = F.contains(text, F.lit(_QUICK[kind])) if _QUICK[kind] else F.lit(True)
        digits = F.lit(True) if kind == "email" else F.rlike(text, F.lit("[0-9]"))
        found.append(F.when(quick & digits, _spans_of(
            text, PATTERNS[kind], number, _FINE[kind])).otherwise(F.array().cast(_SPAN)))
    return F.concat(*found)


def _ordered(spans: Column) -> Column:
    by = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.sort_array(by)


def listed(spans: Column, names: tuple[str, ...] = (*KINDS, CONTEXT)) -> Column:
    """``kind:start:end`` of ordered spans, joined by commas."""
    kinds = F.array(*map(F.lit, names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """The columns, computed once per row however often they are used later."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def _last_word(text: Column) -> Column:
    """What follows the last white space, once the end is trimmed."""
    spaces = " \t\n\x0b\x0c\r"
    return F.substring_index(F.translate(F.rtrim(text, F.lit(spaces)), spaces, " " * len(spaces)), " ", -1)


def _upto(sorted_numbers: Column, most: Column) -> Column:
    """How many of the sorted numbers are below ``most``, by halving."""
    start = F.struct(F.lit(0).alias("low"), F.size(sorted_numbers).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.call_function("div", low + high, F.lit(2)).cast("int")
        below = F.get(sorted_numbers, middle) < most
        return F.when(low < high, F.struct(
            F.when(below, middle + 1).otherwise(low).alias("low"),
            F.when(below, high).otherwise(middle).alias("high"))).otherwise(state)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sorted_numbers) + 1.0)).cast("int"))
    return F.when(F.size(sorted_numbers) > 0, F.aggregate(
        steps, start, halve, lambda state: state["low"])).otherwise(F.lit(0))


def candidates(found: DataFrame) -> DataFrame:
    """(id, h, start, end, token, known, patterns) of every candidate token of ``found``.

    The work is in proportion to a text's length, but for a logarithm of its base spans.
    """
    text = F.col("text")
    rows = found.filter(F.rlike(text, F.lit("[0-9@]")))
    pieces, matches = _cut(text, TOKEN)
    base = _ordered(F.col("base"))
    rows = _once(rows, "id", "h", pieces.alias("pieces"), matches.alias("matches"), base.alias("base"))
    rows = _once(rows, "id", "h", "pieces", "matches",
                 F.transform("base", lambda b: b["start"]).alias("starts"),
                 _running(F.transform("base", lambda b: b["end"]), F.greatest).alias("reach"))

    def item(m: Column, i: Column) -> Column:
        # the word before: of the piece, or the token before where only blanks lie between
        piece = F.get("pieces", i)
        blank = F.btrim(piece, F.lit(" \t\n\x0b\x0c\r")) == ""
        before = F.when(~blank, _last_word(piece)).otherwise(
            F.when(i > 0, F.get("matches", i - 1)["match"]).otherwise(F.lit("")))
        token = F.regexp_replace(m["match"], r"[.,;:!?)\]}>\x27\x22]+$", "")
        lead = F.char_length(m["match"]) - F.char_length(F.regexp_replace(
            m["match"], r"^[(\[{<\x27\x22]+", ""))
        token = F.substring(token, lead + 1, F.char_length(m["match"]))
        return F.struct((m["start"] + lead).alias("start"), token.alias("token"), before.alias("before"))

    def marked(c: Column) -> Column:
        end = c["start"] + F.char_length(c["token"])
        earlier = _upto(F.col("starts"), end)
        known = (earlier > 0) & F.coalesce(F.get("reach", earlier - 1) > c["start"], F.lit(False))
        return F.struct(c["start"].alias("start"), end.alias("end"), c["token"].alias("token"),
                        c["before"].alias("before"), known.alias("known"))
    rows = _once(rows, "id", "h", "starts", "reach", F.transform("matches", item).alias("items"))
    rows = rows.select("id", "h", F.explode(F.transform("items", marked)).alias("c"))
    shape = F.regexp_replace(F.lower("c.before"), "[0-9]+", "9")
    key = F.regexp_extract(F.lower("c.token"), r"^([^0-9=:@\x20]{2,32}[=:])", 1)
    patterns = F.array_compact(F.array(F.when(shape != "", F.concat(F.lit("before:"), shape)),
                                       F.when(key != "", F.concat(F.lit("key:"), key))))
    return rows.filter(F.col("c.token") != "").select(
        "id", "h", "c.start", "c.end", F.lower("c.token").alias("token"), "c.known",
        patterns.alias("patterns"))


def bootstrap(tokens: DataFrame, confidence: float = CONFIDENCE, least_known: int = LEAST_KNOWN
              ) -> tuple[DataFrame, DataFrame]:
    """(accepted patterns, known instances) once no round over their graph accepts another pattern.

    What is known only grows and a pattern's instances are fixed, so accepted patterns stay so and
    the rounds end.

    The graph has one row per distinct pair, so a very frequent token or context is one row per
    partner. An instance once known stays known.
    """
    graph = durable(tokens.select(F.explode("patterns").alias("pattern"), "token", "known")
                    .groupBy("pattern", "token").agg(F.max("known").alias("seed")))
    known = durable(tokens.groupBy("token").agg(F.max("known").alias("seed")).filter("seed")
                    .select("token"))
    count = -1
    while True:
        marked = graph.join(known.withColumn("hit", F.lit(True)), "token", "left")
        scores = marked.groupBy("pattern").agg(
            F.count(F.lit(1)).alias("n"), F.count("hit").alias("k"))
        accepted = durable(scores.filter(
            (F.col("k") >= least_known) & (F.col("k") >= confidence * F.col("n")))
            .select("pattern", (F.col("k") / F.col("n")).alias("confidence")))
        last, count = count, accepted.count()
        if last == count:
            return accepted, known
        reached = (graph.join(accepted, "pattern")
                   .filter(F.rlike("token", F.lit(IDENTIFIER))).select("token"))
        known = durable(known.unionByName(reached).distinct())


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) as struct ``doc``, text, ``base`` and ``spans``.

    Both are arrays of (start, kind, end), ordered; ``spans`` holds ``base`` and the spans that the
    bootstrapping adds, which overlap no base span. Places are code points, end exclusive. Null
    texts are empty. Rows equal in id and text have equal spans; an empty table gives an empty one.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(doc, F.col(id_col).alias("id"), text.alias("text"),
                       F.xxhash64(text).alias("h"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    tokens = durable(candidates(rows.select("id", "h", "text", "base")))
    accepted, _ = bootstrap(tokens)
    fresh = tokens.filter(~F.col("known") & F.rlike("token", F.lit(IDENTIFIER))).withColumn(
        "pattern", F.explode("patterns")).join(accepted, "pattern", "left_semi")
    # the distinct tokens of one text
    added = fresh.groupBy("id", "h").agg(F.collect_set(F.struct(
        "start", "end", F.lit(len(KINDS)).alias("kind"))).cast(_SPAN).alias("added"))
    joined = attach(rows, added, ["id", "h"], nulls_match=True, spread=["h"])
    return joined.select(
        "doc", "text", _ordered(F.col("base")).alias("base"),
        _ordered(F.concat("base", F.coalesce("added", F.array().cast(_SPAN)))).alias("spans"))


def redacted(text: Column, spans: Column, names: tuple[str, ...] = (*KINDS, CONTEXT)) -> Column:
    """``text`` with each span replaced by its kind in angle brackets; overlaps by the first.

    The text is cut into blocks once, so that a span costs about a block and not the text before it.
    """
    kinds = F.array(*map(F.lit, names))
    reach = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    # how far the spans before reach; the last entry is the end of all of them
    placed = F.zip_with(F.concat(F.array(F.lit(0).cast("bigint")), reach), spans, lambda at, s: F.struct(
        at.alias("at"), s["start"].alias("start"), s["kind"].alias("kind")))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    length = F.char_length(text).cast("bigint")

    def joined(whole: Column, size: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            first = F.floor(start / BLOCK)
            some = F.slice(whole, (first + 1).cast("int"),
                           (F.floor(end / BLOCK) - first + 1).cast("int"))
            return F.substring(F.array_join(some, ""), (start - first * BLOCK + 1).cast("int"),
                               (end - start).cast("int"))

        def part(p: Column) -> Column:
            return (F.when(p["start"].isNull(), between(p["at"], size))
                    .when(p["start"] >= p["at"], F.concat(
                        between(p["at"], p["start"]), F.lit("<"), F.get(kinds, p["kind"]), F.lit(">")))
                    .otherwise(F.lit("")))
        return F.array_join(F.transform(placed, part), "")
    made = _bound(F.struct(blocks.alias("blocks"), length.alias("length")),
                  lambda b: joined(b["blocks"], b["length"]))
    return F.when(F.size(spans) == 0, text).otherwise(made)


def count_of(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("bigint")
