"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Each source's documents fall by hash into blocks of about ``block_words`` words, and the blocks
stand in a permuted order. A source whose target is ``e`` times its size and a rest gives every
block ``e`` times and the first blocks of its order once more, until the rest is reached; from
the last of these on, whole documents are chosen to meet the rest. That fixes an exact quota of
block draws per source. A binary tree over the output shards splits the quotas: a node divides its draws
between its halves as drawing without replacement would, by one multivariate-hypergeometric draw
seeded by the node. A shard then owns a run of each source's permuted draws, disjoint from all
others, and orders its documents by a hash of its own.

The driver holds a few numbers per source, and tables of sources are broadcast only where they are
measured to be small. Documents are moved once, to their shards, and only on request.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import word_count
from windrow.operators.joins import attach, is_small
from windrow.session import durable

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_WORDS = 1 << 15
SHARD_WORDS = 1 << 18
MOST_DRAWS = 400_000_000    # the drawing routine takes under 10**9 in all: blocks grow before that
STEP = 4096                 # blocks summed up in one task


def water_fill(sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """Shares of the total size by weight, none above ``most`` times its size.

    What a full share cannot take goes to the others by weight, until none is above.
    """
    most_of, weight = most * np.asarray(sizes, np.float64), np.asarray(weights, np.float64)
    target, left, still = np.zeros(len(weight)), float(sum(sizes)), weight > 0
    while still.any():
        share = left * weight / weight[still].sum()
        full = still & (share > most_of)
        if not full.any():
            target[still] = share[still]
            break
        target[full] = most_of[full]
        left -= float(most_of[full].sum())
        still &= ~full
    return target.tolist()


def _walk(quotas: Sequence[int], shards: int, seed: int = 0, drop: bool = True):
    """A function from a shard to (sources it draws from, its draws, the draws of shards before it).

    A node over the shards [lo, hi) has draws in proportion to hi - lo, and knows the sources that
    have any (all, without ``drop``), so its cost follows its draws and not the number of sources.
    The halves of a node are remembered, so walking to neighbouring shards draws little anew.
    """
    total = int(np.sum(quotas))

    def share(lo: int, hi: int) -> int:
        return total * hi // shards - total * lo // shards

    halves: dict[tuple[int, int], np.ndarray] = {}

    def left_of(lo: int, mid: int, hi: int, have: np.ndarray) -> np.ndarray:
        if (lo, hi) not in halves:
            if len(halves) > 4096:
                halves.clear()
            rng = np.random.default_rng([seed, lo, hi])
            halves[lo, hi] = rng.multivariate_hypergeometric(have, share(lo, mid))
        return halves[lo, hi]

    def walk(shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        have = np.asarray(quotas, np.int64)
        at = np.flatnonzero(have) if drop else np.arange(len(have))
        have, before = have[at], np.zeros(len(at), np.int64)
        lo, hi = 0, shards
        while hi - lo > 1 and len(at):
            mid = (lo + hi) // 2
            left = left_of(lo, mid, hi, have)
            if shard < mid:
                have, hi = left, mid
            else:
                have, before, lo = have - left, before + left, mid
            if drop:
                some = have > 0
                at, have, before = at[some], have[some], before[some]
        return at, have, before
    return walk


def split_tree(quotas: Sequence[int], shards: int, seed: int = 0):
    """A function from a shard to (its draws per source, the draws of all shards before it)."""
    walk = _walk(quotas, shards, seed, drop=False)
    return lambda shard: walk(shard)[1:]


def _coprime(n: int, seed: int) -> int:
    a = max(1, (2654435761 * (seed + 1)) % n) if n > 1 else 1
    while math.gcd(a, n) != 1:
        a += 1
    return a


def _fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole documents that come nearest below the words wanted, from rows (s, h, inside, size).

    The rows of a source follow each other, large ones first, so one look at each decides it.
    """
    source, left = None, 0
    for batch in batches:
        take = []
        for s, inside, size in zip(*(batch.column(c).to_pylist() for c in ("s", "inside", "size"))):
            if s != source:
                source, left = s, inside
            take.append(size <= left)
            left -= size if take[-1] else 0
        yield batch.select(["s", "h"]).filter(pa.array(take, pa.bool_()))


def _reached(blocks: DataFrame) -> DataFrame:
    """Where the words of a source first reach the ``wanted`` ones: s, position, words before it.

    ``blocks`` has a row (s, position, words, wanted) for each block. Runs of ``STEP`` blocks are
    summed up in tasks of their own.
    """
    stepped = blocks.withColumn("part", F.expr(f"position div {STEP}"))
    inner = Window.partitionBy("s", "part").orderBy("position").rowsBetween(
        Window.unboundedPreceding, -1)
    outer = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stepped.groupBy("s", "part").agg(F.sum("words").alias("part_words")).select(
        "s", "part", F.coalesce(F.sum("part_words").over(outer), F.lit(0)).alias("earlier"))
    return (stepped.withColumn("inner", F.coalesce(F.sum("words").over(inner), F.lit(0)))
            .join(parts, ["s", "part"])
            .withColumn("before", F.col("earlier") + F.col("inner"))
            .filter((F.col("before") < F.col("wanted"))
                    & (F.col("before") + F.col("words") >= F.col("wanted")))
            .select("s", "position", "before"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", weights: Sequence[float] = WEIGHTS,
         most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS,
         shard_words: int = SHARD_WORDS, keep: Sequence[str] | None = None) -> DataFrame:
    """Every row as a struct ``doc`` (columns ``keep``), with one row per copy in the mix.

    Columns: doc, h, size, source_size, target, copies (of this row), copy (0, 1, ...), shard,
    place. ``copy``, ``shard`` and ``place`` are null for a row that the mix leaves out. Sources
    stand in code-point order with null last and take the weights in turn. The rest of a source is
    met from the block in which it is reached and, where documents of that block are too long for
    it, from as many blocks after it as hold it in documents that are short enough. Sizes are in words; a null or blank text has size 0, never takes
    part in the filling, and appears as often as its block. Rows that are equal in id and text are
    decided alike. An empty table gives an empty one. Reruns agree.
    """
    text = F.col(text_col)
    chosen = [F.col(f"`{c}`") for c in keep or docs.columns]
    rows = docs.select(
        F.struct(*chosen).alias("doc"), F.col(source_col).cast("string").alias("source"),
        word_count(text).alias("size"), F.xxhash64(id_col, text_col).alias("h"))
    sized = durable(rows.select("source", "size", "h"))
    sums = sized.groupBy("source").agg(F.sum("size").alias("words")).collect()
    sums.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    words = [int(r["words"]) for r in sums]
    total = sum(words)
    targets = water_fill(words, [weights[i % len(weights)] for i in range(len(words))], most)
    block_words = max(block_words, math.ceil(total / MOST_DRAWS))
    blocks = [max(1, math.ceil(w / block_words)) for w in words]
    whole = [int(t // w) if w else 0 for t, w in zip(targets, words)]
    rest = [round(t - e * w) for t, e, w in zip(targets, whole, words)]
    spark = docs.sparkSession
    listed = [(i, r["source"], words[i], targets[i], blocks[i], _coprime(blocks[i], i), whole[i],
               rest[i]) for i, r in enumerate(sums)]
    sources = spark.createDataFrame(
        listed, "s int, source string, source_size bigint, target double, blocks bigint, "
                "step bigint, whole bigint, rest bigint")
    few = is_small(sources)

    def placed(df: DataFrame) -> DataFrame:
        position = F.pmod(F.pmod("h", "blocks") * F.col("step") + F.col("s"), F.col("blocks"))
        return attach(df, sources, ["source"], "inner", ["h"], few, nulls_match=True).withColumn(
            "position", position)

    def by_block(df: DataFrame, wanted: str) -> DataFrame:
        return durable(df.groupBy("s", "position").agg(
            F.sum("size").alias("words"), F.first(wanted).alias("wanted")))

    # one row per source reaches the driver, twice
    wanting = placed(sized.filter("size > 0")).filter("rest > 0")
    edge = {r["s"]: (r["position"], rest[r["s"]] - r["before"])
            for r in _reached(by_block(wanting, "rest")).collect()}
    inside = spark.createDataFrame(
        [(i, *at) for i, at in edge.items()], "s int, edge bigint, inside bigint")
    fitting = attach(wanting, inside, ["s"], "inner", ["h"], few).filter(
        (F.col("position") >= F.col("edge")) & (F.col("size") <= F.col("inside")))
    last = {i: blocks[i] - 1 for i in edge}
    last.update((r["s"], r["position"])
                for r in _reached(by_block(fitting, "inside")).collect())
    edges = spark.createDataFrame(
        [(i, edge.get(i, (-1, 0))[0], last.get(i, -1)) for i in range(len(words))],
        "s int, edge bigint, last bigint")
    within = (attach(fitting, edges.drop("edge"), ["s"], "inner", ["h"], few)
              .filter(F.col("position") <= F.col("last"))
              .groupBy("s", "h", "inside").agg(F.sum("size").alias("size")))
    # a source's last blocks are one task: the words wanted and those of one block more, at most
    picked = durable(within.repartition("s").sortWithinPartitions("s", F.desc("size"), "h")
                     .mapInArrow(_fill, "s int, h bigint")).withColumn("picked", F.lit(True))
    quotas = [whole[i] * blocks[i] + last.get(i, -1) + 1 for i in range(len(words))]
    shards = max(1, math.ceil(total / shard_words))
    runs = shard_runs(spark, quotas, shards)
    draws = (runs.withColumn("draw", F.explode(F.sequence("first", "last")))
             .select("s", "draw", "shard"))
    decided = attach(attach(placed(rows), edges, ["s"], "inner", ["h"], few), picked, ["s", "h"],
                     spread=["h", "size"])
    more: Column = (F.col("position") < F.col("edge")) | F.coalesce("picked", F.lit(False))
    copies = F.col("whole") + more.cast("bigint")
    taken = decided.withColumn("copies", copies).withColumn("copy", F.explode_outer(
        F.when(copies > 0, F.sequence(F.lit(0).cast("bigint"), copies - 1))))
    drawn = taken.withColumn("draw", F.col("copy") * F.col("blocks") + F.col("position"))
    return attach(drawn, draws, ["s", "draw"], spread=["h", "size"]).select(
        "doc", "h", "size", "source_size", "target", "copies", "copy", "shard",
        F.when(F.col("shard").isNotNull(), F.xxhash64("shard", "h", "copy")).alias("place"))


def shard_runs(spark, quotas: Sequence[int], shards: int, seed: int = 0) -> DataFrame:
    """(s, shard, first, last): the run of a source's draws that a shard owns, where it has any."""
    quotas = list(map(int, quotas))

    def walked(batches):
        walk = _walk(quotas, shards, seed)
        for batch in batches:
            s, shard, first, last = [], [], [], []
            for k in batch.column(0).to_pylist():
                at, have, before = walk(k)
                s.extend(at.tolist())
                shard.extend([k] * len(at))
                first.extend(before.tolist())
                last.extend((before + have - 1).tolist())
            if s:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s, pa.int32()), *(pa.array(x, pa.int64()) for x in
                                                (shard, first, last))],
                    ["s", "shard", "first", "last"])
    return spark.range(shards).mapInArrow(walked, "s int, shard bigint, first bigint, last bigint")


def shuffled(mixed: DataFrame) -> DataFrame:
    """The documents of the mix, shard by shard, each shard in its own random order.

    The one movement of whole documents. A shard is bounded by its words, so an even dealing of
    shards over tasks is an even dealing of words.
    """
    return (mixed.filter(F.col("shard").isNotNull()).repartition("shard")
            .sortWithinPartitions("shard", "place").select("doc.*"))
