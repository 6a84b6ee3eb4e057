"""Exact k-means in integers by Shallot search.

Every vector carries its centroid, the one that was second nearest, an upper bound of its distance
to the first and a lower bound of that to all others. After the centroids have moved, the bounds
follow by the distances moved. Where they cannot rule out another centroid, the vector is compared
with the two it remembers and the search starts from the closer one. It goes through the other
centroids in order of their distance from that one, and ends at the first which by the triangle
inequality lies farther away than the second best found so far: the ball shrinks while it is
searched. Whatever survives the bounds is compared by exact integer squares; bounds are widened by
more than their rounding, so ties reach that comparison.

A round is one pass over the vectors with their bounds, written as a table, and one pass that adds
up each cluster inside its tasks. Only centroids, whose number and length are parameters, are held
by the driver and sent to tasks; a cluster with most of the vectors needs nothing more.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import finite_rows, map_arrow, sliced
from windrow.session import shared_folder

CLUSTERS, ROUNDS, LENGTH, SCALE = 40, 5, 64, 256
LARGEST = 1 << 27        # squared distances of vectors within it fit 64 bits, for up to 64 components
SLACK = 1e-9             # of a bound, far more than its rounding


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


class Centroids:
    """Centroids with what the search needs of them; ``moved`` is how far each came."""

    def __init__(self, rows: list[list[int]], before: list[list[int]] | None = None):
        self.rows = np.array(rows, np.int64)
        k = len(rows)
        exact = ((self.rows[:, None, :] - self.rows[None, :, :]) ** 2).sum(2)
        self.apart = np.sqrt(exact.astype(float))
        beside = exact.copy()
        np.fill_diagonal(beside, -1)                       # itself comes first
        self.order = np.argsort(beside, axis=1, kind="stable")
        self.half = self.apart[np.arange(k), self.order[:, 1]] / 2 if k > 1 else np.full(k, np.inf)
        old = self.rows if before is None else np.array(before, np.int64)
        self.moved = np.sqrt(squared(self.rows, old).astype(float)) * (1 + SLACK)
        most = np.sort(self.moved)[::-1]
        # the farthest that any other centroid came
        self.others = np.where(self.moved == most[0], most[min(1, k - 1)], most[0])
        if k > 1 and (self.moved == most[0]).sum() > 1:
            self.others[:] = most[0]


def search(x: np.ndarray, own: np.ndarray, second: np.ndarray, upper: np.ndarray,
           lower: np.ndarray, centroids: Centroids) -> int:
    """Move ``own``, ``second`` and the bounds of all rows on to ``centroids``, in place.

    Returns how many exact distances were needed.
    """
    if len(centroids.rows) == 1:
        return 0
    rows, made = centroids.rows, 0
    lower -= centroids.others[own]
    upper += centroids.moved[own]

    def open_rows(at):
        least = np.maximum(lower[at], centroids.half[own[at]])
        return at[upper[at] * (1 + SLACK) >= least * (1 - SLACK)]
    at = open_rows(np.arange(len(x)))
    upper[at] = np.sqrt(squared(x[at], rows[own[at]]).astype(float))
    made += len(at)
    at = open_rows(at)
    if not len(at):
        return made
    best, other = own[at], second[at]
    near, far = squared(x[at], rows[best]), squared(x[at], rows[other])
    made += len(at)
    swap = (far < near) | ((far == near) & (other < best))
    best, other = np.where(swap, other, best), np.where(swap, best, other)
    near, far = np.where(swap, far, near), np.where(swap, near, far)
    start, known = best.copy(), (best.copy(), other.copy())
    reach = np.sqrt(near.astype(float))
    left = np.arange(len(at))                              # rows still searching
    for step in range(1, len(rows)):
        centre = centroids.order[start[left], step]
        ball = (reach[left] + np.sqrt(far[left].astype(float))) * (1 + SLACK)
        inside = centroids.apart[start[left], centre] * (1 - SLACK) <= ball
        left, centre = left[inside], centre[inside]
        if not len(left):
            break
        new = (centre != known[0][left]) & (centre != known[1][left])
        row, centre = left[new], centre[new]
        distance = squared(x[at[row]], rows[centre])
        made += len(row)
        first = (distance < near[row]) | ((distance == near[row]) & (centre < best[row]))
        next_best = ~first & ((distance < far[row]) | ((distance == far[row]) & (centre < other[row])))
        a, b = row[first], row[next_best]
        other[a], far[a] = best[a], near[a]
        best[a], near[a] = centre[first], distance[first]
        other[b], far[b] = centre[next_best], distance[next_best]
    own[at], second[at] = best, other
    upper[at], lower[at] = np.sqrt(near.astype(float)), np.sqrt(far.astype(float))
    return made


def integers(vectors: DataFrame, id_col: str, vector_col: str, length: int) -> DataFrame:
    """(id, q) of the vectors to cluster, as integers."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def made(batch):
        at, values = finite_rows(batch.column(1), length, LARGEST / SCALE)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at)),
             _lists(np.floor(values * SCALE).astype(np.int32))], ["id", "q"])
    return map_arrow(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(
        "array<double>").alias("v")), made, f"id {kind}, q array<int>")


def _lists(matrix: np.ndarray) -> pa.Array:
    n, d = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * d, d), pa.int32()),
                                    pa.array(matrix.ravel()))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, length).astype(np.int64)


def first_centroids(rows: DataFrame, clusters: int, salt: str) -> list[list[int]]:
    """The vectors with the least hashes of salt and id; null ids last, then by components."""
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    found = rows.orderBy(key.asc_nulls_last(), "q").limit(clusters).select("q").collect()
    return [list(r[0]) for r in found]


def assigned(rows: DataFrame, centroids: Centroids, length: int) -> DataFrame:
    """One pass: the nearest centroid of every row, ties to the smaller number."""
    kind = rows.schema["id"].dataType.simpleString()
    known = "own" in rows.columns

    def made(batch):
        x = _matrix(batch.column(1), length)
        if known:
            own, second = (batch.column(c).to_numpy().astype(np.int64) for c in (2, 3))
            upper, lower = (np.array(batch.column(c).to_numpy()) for c in (4, 5))
        else:
            own = np.zeros(len(x), np.int64)
            second = own + min(1, len(centroids.rows) - 1)
            upper, lower = np.full(len(x), np.inf), np.zeros(len(x))
        search(x, own, second, upper, lower, centroids)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(own, pa.int32()),
             pa.array(second, pa.int32()), pa.array(upper), pa.array(lower)],
            ["id", "q", "own", "second", "upper", "lower"])
    return map_arrow(rows, made, f"id {kind}, q array<int>, own int, second int, upper double, "
                     "lower double")


def means(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The exact floors of the componentwise means; a centroid without vectors stays."""
    k, d = len(centroids), len(centroids[0])

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in sliced(batches):
            x, own = _matrix(batch.column(0), d), batch.column(1).to_numpy()
            order = np.argsort(own, kind="stable")
            own, begin = np.unique(own[order], return_index=True)
            if len(own):
                total[own] += np.add.reduceat(x[order], begin, axis=0)
                n[own] += np.diff(np.append(begin, len(order)))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, d), pa.int32()), pa.array(np.tile(np.arange(d), len(at)), pa.int32()),
             pa.array(total[at].ravel()), pa.array(np.repeat(n[at], d))],
            ["own", "dim", "total", "n"])
    sums = rows.select("q", "own").mapInArrow(totals, "own int, dim int, total bigint, n bigint")
    made = [list(c) for c in centroids]
    for own, dim, total, n in sums.groupBy("own", "dim").agg(
            F.sum(F.col("total").cast("decimal(38,0)")), F.sum("n")).collect():
        made[own][dim] = int(total) // n
    return made


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            clusters: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH,
            salt: str = "2:") -> DataFrame:
    """Per clustered vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Clustered are vectors of ``length`` components, none of them null, non-finite or beyond
    ``LARGEST / SCALE``, where squares would not fit 64 bits. With fewer vectors than ``clusters``
    each of them starts a centroid. Equal vectors, repeated rows and null ids are rows like any
    other; equal centroids leave all vectors to the one with the smaller number. An empty table
    gives an empty one. The rounds end early only where no centroid moved, which changes nothing.
    """
    if length * (2 * LARGEST) ** 2 >= 1 << 63:
        raise ValueError("squared distances of vectors that long may not fit 64 bits")
    spark = vectors.sparkSession
    folder = f"{shared_folder(spark)}/clusters-{uuid.uuid4().hex}"

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = written(integers(vectors, id_col, vector_col, length), "vectors")
    centroids = first_centroids(rows, clusters, salt)
    if not centroids:
        return spark.createDataFrame([], f"id {kind}, cluster int, distance bigint, cluster_inertia "
                                         "bigint, inertia bigint, centroid_sha256 string")
    before = None
    for done in range(rounds):
        rows = written(assigned(rows, Centroids(centroids, before), length), f"round-{done}")
        before, centroids = centroids, means(rows, centroids)
        if centroids == before:
            break
    last, final = Centroids(centroids, before), np.array(centroids, np.int64)

    def measured(batch):
        own = batch.column(2).to_numpy()
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(squared(_matrix(batch.column(1), length),
                                                                final[own]))],
            ["id", "cluster", "distance"])
    rows = written(map_arrow(assigned(rows, last, length), measured,
                             f"id {kind}, cluster int, distance bigint"), "last")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    of_cluster = rows.groupBy("cluster").agg(exact.alias("s")).collect()
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    report = spark.createDataFrame(
        [(r["cluster"], int(r["s"]), int(sum(x["s"] for x in of_cluster)), names[r["cluster"]])
         for r in of_cluster], "cluster int, cluster_inertia bigint, inertia bigint, "
                               "centroid_sha256 string")
    # at most one row per centroid
    return rows.join(F.broadcast(report), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH) -> str:
    """The same by comparing every vector with every centroid."""
    def assign(i: int) -> str:
        return f"""
a{i} AS MATERIALIZED (
  SELECT r, min_by(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, CAST(list_dot_product(k.f, k.f) - 2 * list_dot_product(k.f, m.f)
                      + list_dot_product(m.f, m.f) AS BIGINT) AS d
    FROM kept k, c{i} m) GROUP BY r)"""

    def update(i: int) -> str:
        return f"""
c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.f, o.f) AS f FROM c{i} o LEFT JOIN (
    SELECT c, list(f ORDER BY dim) AS f FROM (
      SELECT c, dim, floor(sum(f[dim]) / count(*)) AS f
      FROM a{i} JOIN kept USING (r), range(1, {length + 1}) t(dim) GROUP BY c, dim)
    GROUP BY c) n USING (c))"""
    steps = [assign(0).lstrip()]
    for i in range(rounds):
        steps += [update(i), assign(i + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS f
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {length}
    AND len(embedding) = {length}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, f FROM kept
  ORDER BY sha256('2:' || vec_id) LIMIT {clusters}),
{','.join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(m.f, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)),
                              ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} m ON m.c = a.c
"""
