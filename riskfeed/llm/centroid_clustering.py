"""Operator 13: centroid clustering with Orchard search.

Every centroid keeps the list of all others, nearest first. A vector starts at one centroid
and walks that centroid's list; whenever a nearer centroid turns up it jumps to the start of
that one's list. Centroids once met are marked and not measured again. The walk ends as soon
as the next list entry lies strictly more than twice the vector's present distance away: by
the triangle inequality none of the rest can be as near. The search is exact, ties go to the
smaller centroid number. All vectors of an Arrow batch walk together (numpy).

Arithmetic is on integers: a component x becomes floor(scale * x). A round reads the vectors,
sums them per centroid inside each task and adds the sums up by (centroid, component), so what
moves is tasks x centroids x components numbers, whatever the number of vectors and however
uneven the clusters. The centroids (``k`` of them, a parameter) travel with the tasks.

Defined results: vectors that are null, of another length, or hold a null or non-finite
component are left out. Start centroids are the vectors with the smallest hashes of
``seed:id``, null ids last, equal hashes by their components; with fewer vectors than ``k``
there are fewer centroids; repeated rows count each. Components are held within a range (2^26
at 64 components) beyond which a squared distance would not fit 64 bits; sums of distances stop
at the largest long. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeed.llm.common import stage

RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
_LONG = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """Every component of an array of doubles is a finite number (null for a null array)."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _integers(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    most = float(isqrt((1 << 62) // (16 * dim)))
    held = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(most)), F.lit(-most))).cast("long"))
    return (vectors.where((F.size(v) == dim) & finite(v))
            .select(F.col(id_col).cast("long").alias("vec_id"), held.alias("q")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Orchard:
    """Neighbour lists of the centroids and the search over them."""

    def __init__(self, centroids: np.ndarray):
        self.c, k = centroids, len(centroids)
        apart = ((centroids[:, None] - centroids[None]) ** 2).sum(axis=2)
        number = np.arange(k)
        lists = np.lexsort((np.broadcast_to(number, (k, k)), apart), axis=1)
        # a centroid is no entry of its own list (equal centroids may stand before it)
        self.order = lists[lists != number[:, None]].reshape(k, k - 1)
        self.apart = np.take_along_axis(apart, self.order, axis=1)

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row of ``x`` the nearest centroid's number and its squared distance."""
        n, k = len(x), len(self.c)
        best, place = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        dist = ((x - self.c[0]) ** 2).sum(axis=1)
        met = np.zeros((n, k), dtype=bool)
        met[:, 0] = True
        walking = np.arange(n if k > 1 else 0)
        while len(walking):
            b, p = best[walking], place[walking]
            go = self.apart[b, p] <= 4 * dist[walking]
            walking, b, p = walking[go], b[go], p[go]
            other = self.order[b, p]
            place[walking] = p + 1
            new = ~met[walking, other]
            w, o = walking[new], other[new]
            met[w, o] = True
            d = ((x[w] - self.c[o]) ** 2).sum(axis=1)
            nearer = (d < dist[w]) | ((d == dist[w]) & (o < best[w]))
            w, o = w[nearer], o[nearer]
            best[w], dist[w], place[w] = o, d[nearer], 0
            walking = walking[place[walking] < k - 1]
        return best, dist


def _next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: exact component sums per centroid, added up over all tasks."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = centroids.shape
        search, total, n = Orchard(centroids).search, np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            number, _ = search(x)
            np.add.at(total, number, x)
            n += np.bincount(number, minlength=k)
        got = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(got, dim), pa.int32()), pa.array(np.tile(np.arange(dim), len(got)), pa.int32()),
             pa.array(total[got].ravel(), pa.int64()), pa.array(np.repeat(n[got], dim), pa.int64())],
            names=["cluster", "component", "s", "n"])

    parts = vectors.select("q").mapInArrow(sums, "cluster int, component int, s long, n long")
    rows = (parts.groupBy("cluster", "component")
            .agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"), F.sum("n").alias("n")).collect())
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["component"]] = int(r["s"]) // r["n"]
    return out


def centroid_clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64,
                      seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per vector."""
    spark = vectors.sparkSession
    vectors = _integers(vectors, id_col, vector_col, dim, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(key.asc_nulls_last(), "q").limit(k).collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids = np.array([r["q"] for r in first], dtype=np.int64)
    for _ in range(rounds):
        centroids = _next_centroids(vectors, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids).search
        for batch in batches:
            number, dist = search(_matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number, pa.int32()), pa.array(dist, pa.int64())],
                names=["vec_id", "cluster", "distance"])

    found = stage(vectors.mapInArrow(assign, "vec_id long, cluster int, distance long"), "op13-assigned")
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    total = min(sum(int(r["s"]) for r in per), _LONG)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = spark.createDataFrame([(r["cluster"], min(int(r["s"]), _LONG), total, sha[r["cluster"]]) for r in per],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
