"""Near duplicates of vectors: sign hashing by random hyperplanes, exact cosines, components.

Equal vectors of one label are one class, so copies are never paired. Each table gives a class the
signs of its products with ``bits`` random hyperplanes; classes that agree in all signs of a table
are candidates. The number of bits follows the number of classes and the number of tables follows
from the bits, so that a pair at the threshold is missed with a probability below ``MISS`` at any
size. A bucket is dealt into pieces by its count, and every two pieces are one block of bounded size,
where cosines are taken in double precision. No pair leaves a block: it returns how many rows each
class links to there, counting a pair in the first table that has it, and links that span what is
joined.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import map_arrow
from windrow.llm.components import components
from windrow.operators.joins import attach
from windrow.session import durable

THRESHOLD = 0.98
MISS = 1e-6
SEED = 20_240_601
PIECE = 1024             # classes in a piece of a bucket, about
TILE = 256               # rows whose cosines with a block are held at a time
CLOSE = 1e-9             # cosines this near to the threshold are taken again, pair by pair


def table_sizes(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Bits per table for ``n`` classes, and tables so that a pair is missed with ``miss``."""
    bits = min(60, max(8, math.ceil(math.log2(max(n, 2)))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree))


def _matrix(column: pa.Array) -> list[np.ndarray | None]:
    return [None if v is None else np.array([np.nan if x is None else x for x in v], np.float64)
            for v in column.to_pylist()]


def _hashed(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, the vector as bytes of doubles and its hash, null where it links with nothing."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))

    def made(batch):
        data = []
        for v, label in zip(_matrix(batch.column(2)), batch.column(1).to_pylist()):
            with np.errstate(over="ignore", invalid="ignore"):
                fine = (v is not None and label is not None and len(v) > 0
                        and np.isfinite(v).all() and 0 < float(np.abs(v).max()))
            data.append((v + 0.0).astype("<f8").tobytes() if fine else None)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["id", "label", "v"])
    kind = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, made, f"id {kind}, label string, v binary").withColumn(
        "class", F.when(F.col("v").isNotNull(), F.unhex(F.md5(F.concat(
            F.col("v"), F.lit("|").cast("binary"), F.col("label").cast("binary"))))))


def _signed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """The classes with ``signs``, one number for every table."""
    def made(batch):
        vectors = [np.frombuffer(v.as_buffer(), "<f8") for v in batch.column(3)]
        signs = np.zeros((len(vectors), tables), np.int64)
        by_length: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_length.setdefault(len(v), []).append(i)
        weight = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        for length, at in by_length.items():
            planes = np.random.default_rng([SEED, length]).standard_normal((length, tables * bits))
            for s in range(0, len(at), 1024):
                rows = at[s:s + 1024]
                block = np.stack([vectors[i] / np.abs(vectors[i]).max() for i in rows])
                above = (block @ planes > 0).reshape(len(rows), tables, bits)
                signs[rows] = (above * weight).sum(2, dtype=np.uint64).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([r.tobytes() for r in signs.astype("<i8")], pa.binary())],
            ["class", "label", "n", "v", "signs"])
    return map_arrow(classes.select("class", "label", "n", "v"), made,
                     "class binary, label string, n bigint, v binary, signs binary")


def _linked(classes: DataFrame, threshold: float, bits: int, tables: int) -> DataFrame:
    """Of every block of a bucket: (a, null, rows that class a links to) and spanning links (a, b)."""
    signed = durable(_signed(classes, bits, tables))
    keys = signed.select("class", F.xxhash64("label", F.octet_length("v")).alias("of"), "signs",
                         F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("at")).select(
        "class", "at", F.xxhash64("of", "at", F.substring("signs", F.col("at") * 8 + 1, F.lit(8)))
        .alias("key"))
    # only buckets with company go on; most have none
    pieces = durable(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "key", F.ceil(F.col("n") / PIECE).cast("int").alias("pieces")))
    crowded = attach(keys, pieces, ["key"], "inner", ["class"])
    block = ["key", "low", "high"]
    dealt = crowded.join(signed, "class").withColumn(
        "own", F.pmod(F.hash("class", F.lit(SEED)), F.col("pieces"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn(
        "low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).select(
        *block, "at", "class", "label", "n", "v", "signs", "own")

    def blocks(batches):
        held, begun, now = [], 0, None          # rows of whole blocks, and of one more from begun
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
                if row[:3] != now:
                    if len(held) > PIECE:
                        yield from _compared(held, threshold)
                        held = []
                    elif len(held) == begun + 1:
                        held.pop()
                    begun, now = len(held), row[:3]
                held.append(row)
        if held:
            yield from _compared(held, threshold)
    return (dealt.repartition(*block).sortWithinPartitions(*block, "class")
            .mapInArrow(blocks, "a binary, b binary, m bigint"))


def _compared(rows: list[tuple], threshold: float):
    """Counts and spanning links of the blocks that ``rows`` hold: pairs of one block, table, label
    and length, in a block of two pieces only those of different pieces."""
    by_length: dict[int, list[tuple]] = {}
    for row in rows:
        by_length.setdefault(len(row[7]), []).append(row)
    for part in by_length.values():
        numbers: dict[tuple, int] = {}
        group = np.array([numbers.setdefault((*r[:4], r[5]), len(numbers)) for r in part])
        side = np.array([-1 - i if r[1] == r[2] else r[9] for i, r in enumerate(part)])
        table, n = np.array([r[3] for r in part]), np.array([r[6] for r in part], np.int64)
        x = np.stack([np.frombuffer(r[7], "<f8") for r in part])
        signs = np.stack([np.frombuffer(r[8], "<i8") for r in part])
        unit = x / np.abs(x).max(1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
        links = np.zeros((len(part), len(part)), bool)
        for start in range(0, len(part), TILE):
            end = min(start + TILE, len(part))
            cosines = unit[start:end] @ unit.T
            i, j = np.nonzero((cosines >= threshold - CLOSE)
                              & (group[start:end, None] == group) & (side[start:end, None] != side))
            near = np.flatnonzero(cosines[i, j] < threshold + CLOSE)
            i += start
            fine = np.ones(len(i), bool)
            fine[near] = [cosine(x[p], x[q]) >= threshold for p, q in zip(i[near], j[near])]
            i, j = i[fine], j[fine]
            for earlier in range(signs.shape[1]):       # a pair counts in its first table alone
                fine = (signs[i, earlier] != signs[j, earlier]) | (table[i] <= earlier)
                i, j = i[fine], j[fine]
            links[i, j] = True
        yield from _reported([r[4] for r in part], links, n)


def _reported(kind: list[bytes], links: np.ndarray, n: np.ndarray):
    count = links @ n
    linked = np.flatnonzero(count)
    a, b, m = [kind[i] for i in linked], [None] * len(linked), count[linked].tolist()
    free = np.ones(len(kind), bool)
    for first in linked.tolist():
        if not free[first]:
            continue
        edge = np.array([first])
        free[first] = False
        while len(edge):
            edge = np.flatnonzero(links[edge].any(0) & free)
            free[edge] = False
            a.extend(kind[first] for _ in edge)
            b.extend(kind[i] for i in edge)
            m.extend(None for _ in edge)
    if a:
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(m, pa.int64())],
            ["a", "b", "m"])


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    """In double precision; vectors whose squares leave that range are scaled first."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        dot, p, q = float(x @ y), float(x @ x), float(y @ y)
    if not (math.isfinite(dot) and 1e-200 < p < 1e200 and 1e-200 < q < 1e200):
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        dot, p, q = float(x @ y), float(x @ x), float(y @ y)
    return dot / (math.sqrt(p) * math.sqrt(q))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, n_links (rows linked directly), component_id (least id reachable), kept.

    Rows link when their labels are equal and not null and their cosine reaches ``threshold``. A
    vector that is null, empty, zero, or holds null or non-finite numbers, and one with a null
    label, links with nothing. Vectors of different lengths never link. Repeated rows link with
    each other. A null id never names a component. An empty table gives an empty one.
    """
    rows = durable(_hashed(vectors, id_col, vector_col, label_col))
    classes = durable(rows.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.first("v").alias("v"), F.first("label").alias("label"),
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least_id")))
    bits, tables = table_sizes(classes.count(), threshold)
    found = durable(_linked(classes, threshold, bits, tables))
    others = found.filter("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("m").alias("m"))
    roots = components(found.filter("b is not null").select("a", "b")).select(
        F.col("node").alias("class"), "root")
    named = durable(classes.select("class", "n", "least_id").join(roots, "class", "left").withColumn(
        "root", F.coalesce("root", "class")))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = durable(attach(named, durable(least), ["root"], "inner", ["class"]).join(
        others, "class", "left").select(
        "class", "component_id", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links")))
    own = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return attach(rows.select("id", "class"), of_class, ["class"], "left", ["id"]).select(
        "id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))
