"""Operator 12: approximate nearest neighbours by multi-index hashing, largest inner product first.

Codes: rows are scaled by the largest norm and get one more component that makes them unit
vectors, queries get a zero there, so that inner products become cosines. Several rotations are
learned from a bounded sample (``SAMPLE_ROWS`` rows, by hash of the id): principal axes, then
rotations that alternate with the signs they make until both agree. The signs of all rotated
components are the ``bits`` of a code.

Index: rows lie in slices of bounded size. Of each slice, codes are cut into 8-bit substrings;
for every substring place and value there is the set of rows within 0, 1, 2 ... bits of it.
Probing: a code within radius r = m * t + a of the query (m substrings) must be within t bits in
one of the first a + 1 substrings or within t - 1 in another one (pigeonhole), so the union of m
sets holds every code within the radius. Their full distances decide, what remains is reranked
by the inner product of the original vectors, in double precision and component by component.

Radius: the k-th best product known so far gives an angle, the angle a code distance (bits *
angle / pi), to which the sample's mean deviation and ``SURE`` of its standard deviations are
added. A query that knows nothing yet widens its radius until k codes are within it. Slices are
searched in rounds, each eight times the last, and each round starts from the best of those
before it. Every row is indexed; the search is approximate in this radius alone.

Scale: equal vectors are searched once, with the k + 1 smallest ids of each; equal queries
likewise. A task holds one slice and one bounded group of queries; what it returns is k + 1 ids
a query. Work is queries x rows / 64 bit operations in the worst case (queries far from
everything), much less where a near neighbour makes the radius small. Vectors that are near but
not equal, a third of all say, are compared within their slices, never listed as pairs.

Defined results: vectors that are null, empty or zero, or hold a null or non-finite component, and
rows without an id take no part. Of rows with one id the smallest vector counts. A query's own id
is no candidate. Vectors of different lengths are not compared. Ties go to the smaller id; with
fewer than k candidates all are returned. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeed.llm.centroid_clustering import finite
from riskfeed.llm.common import stage

BITS = 256
SAMPLE_ROWS = 8192
SAMPLE_QUERIES = 256
SURE = 2.5
SLICE_VALUES = 1 << 20  # components of one slice
GROWTH = 8
BATCH = 64
ROUGH = 1e-10  # well above the rounding of a sum of products, relative to the norms
RESULT = "query_id long, rank int, vec_id long, score double"
_BEST = "array<struct<neg:double,id:long>>"


# ------------------------------------------------------------------ codes

def _rotations(x: np.ndarray, bits: int, seed: int = 1, steps: int = 30) -> np.ndarray:
    """Columns of one or more learned rotations of the principal axes of ``x``."""
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :min(bits, x.shape[1])]
    p, b, out = x @ axes, axes.shape[1], []
    rng = np.random.default_rng(seed)
    while b * len(out) < bits:
        r = np.linalg.qr(rng.normal(size=(b, b)))[0]
        for _ in range(steps):
            u, _, v = np.linalg.svd(np.where(p @ r > 0, 1.0, -1.0).T @ p)
            r = (u @ v).T
        out.append(axes @ r)
    return np.ascontiguousarray(np.hstack(out)[:, :bits])


@dataclass
class Codes:
    turn: np.ndarray  # (components + 1, bits)
    norm: float  # the largest norm of all rows
    shift: float = 0.0  # of code distances from bits * angle / pi
    spread: float = 0.0

    @property
    def bits(self) -> int:
        return self.turn.shape[1]

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self._pack(np.hstack((x / self.norm, unit_rest(x, self.norm))))

    def queries(self, x: np.ndarray) -> np.ndarray:
        return self._pack(np.hstack((x / norms(x)[:, None], np.zeros((len(x), 1)))))

    def _pack(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.turn > 0, axis=1)

    def radius(self, product: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Code distance within which vectors of at least this inner product are looked for."""
        angle = np.arccos(np.clip(product / (norm * self.norm), -1, 1))
        r = np.floor(self.bits * angle / np.pi + self.shift + SURE * self.spread)
        return np.clip(r, 0, self.bits).astype(np.int64)


def norms(x: np.ndarray) -> np.ndarray:
    """Euclidean norms, safe for components near the ends of the double range."""
    most = np.abs(x).max(axis=1)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def unit_rest(x: np.ndarray, norm: float) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 1.0 - (norms(x) / norm) ** 2))[:, None]


def fit(sample: np.ndarray, norm: float, bits: int = BITS, k: int = 20) -> Codes:
    """Codes learned from the sample, and how the code distances of near pairs deviate from what
    their angles say (the nearest ``k`` of the first rows, among the sample)."""
    codes = Codes(_rotations(np.hstack((sample / norm, unit_rest(sample, norm))), bits), norm)
    codes.spread = max(1.0, np.sqrt(codes.bits) / 2)
    q = sample[:SAMPLE_QUERIES]
    if len(sample) > 1:
        product = q @ sample.T
        np.fill_diagonal(product, -np.inf)
        near = np.argsort(-product, axis=1)[:, :min(k, len(sample) - 1)]
        differ = codes.queries(q)[:, None] ^ codes.rows(sample)[near]
        apart = np.bitwise_count(differ).sum(axis=2)
        cos = np.take_along_axis(product, near, axis=1) / (norms(q)[:, None] * norm)
        off = apart - codes.bits * np.arccos(np.clip(cos, -1, 1)) / np.pi
        codes.shift, codes.spread = float(off.mean()), max(1.0, float(off.std()))
    return codes


# ------------------------------------------------------------------ one slice

class SliceIndex:
    """Substring index of one slice of codes (n, bytes)."""

    def __init__(self, codes: np.ndarray):
        self.n, self.m = codes.shape
        wide = np.zeros((self.n, -(-self.m // 8) * 8), dtype=np.uint8)
        wide[:, :self.m] = codes
        self.words = np.ascontiguousarray(wide.view(np.uint64).T)
        sets = np.empty((self.m, 256, -(-self.n // 8)), dtype=np.uint8)
        for j in range(self.m):
            at = np.zeros((256, self.n), dtype=bool)
            at[codes[:, j], np.arange(self.n)] = True
            sets[j] = np.packbits(at, axis=1)
        self.sets = [sets]  # by number of differing bits allowed

    def _within(self, t: int) -> np.ndarray:
        value = np.arange(256)
        while len(self.sets) <= t:
            last = self.sets[-1]
            grown = last.copy()
            for bit in range(8):
                grown |= last[:, value ^ (1 << bit)]
            self.sets.append(grown)
        return self.sets[t]

    def probe(self, code: np.ndarray, r: int) -> np.ndarray | None:
        """Rows that the pigeonhole admits at radius r; None for all of them."""
        t, a = divmod(r, self.m)
        if t > 3:  # half of all values are within four bits: every row is in some set
            return None
        place = np.arange(self.m)
        found = np.bitwise_or.reduce(self._within(t)[place[:a + 1], code[:a + 1]])
        if t and a + 1 < self.m:
            found |= np.bitwise_or.reduce(self._within(t - 1)[place[a + 1:], code[a + 1:]])
        return np.flatnonzero(np.unpackbits(found, count=self.n))

    def within(self, code: np.ndarray, word: np.ndarray, r: int) -> np.ndarray:
        """Rows whose whole codes are within radius r."""
        got = self.probe(code, r)
        if got is None or 2 * len(got) > self.n:  # most rows: distances of all, then those probed
            apart = np.bitwise_count(self.words ^ word[:, None]).sum(axis=0, dtype=np.int64)
            return np.flatnonzero(apart <= r) if got is None else got[apart[got] <= r]
        apart = np.bitwise_count(self.words[:, got] ^ word[:, None]).sum(axis=0, dtype=np.int64)
        return got[apart <= r]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of equal columns of (components, pairs) arrays, summed in component order,
    so that a pair's product is the same wherever it is computed."""
    total = np.zeros(q.shape[1])
    for a, b in zip(q, x):
        total += a * b
    return total


def search_slice(codes: Codes, x: np.ndarray, ids: list[np.ndarray], q: np.ndarray, known: np.ndarray,
                 k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the best ``k`` (products, ids) of a slice. ``known``: the k-th best product so
    far, or nan."""
    index, out = SliceIndex(codes.rows(x)), []
    xt, first = np.ascontiguousarray(x.T), np.array([i[0] for i in ids])
    code, norm = codes.queries(q), norms(q)
    wide = np.zeros((len(q), -(-code.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, :code.shape[1]] = code
    word = wide.view(np.uint64)

    def widened(i: int) -> int:
        r = int(codes.radius(np.array([0.5 * norm[i] * codes.norm]), norm[i:i + 1])[0])
        while r < codes.bits:
            rows = index.within(code[i], word[i], r)
            if len(rows) >= k:
                best = np.partition(x[rows] @ q[i], len(rows) - k)[len(rows) - k]
                return int(codes.radius(np.array([best]), norm[i:i + 1])[0])
            r += max(8, codes.bits // 16)
        return codes.bits

    def hopeful(i: int, rows: np.ndarray) -> np.ndarray:
        """Rows that may be among the k best: their products, good to ``ROUGH`` of the norms,
        reach the k-th. Only these are summed in component order."""
        if len(rows) <= k:
            return rows
        rough = x[rows] @ q[i]
        least = np.partition(rough, len(rows) - k)[len(rows) - k] - ROUGH * norm[i] * codes.norm
        return rows[~(rough < least)]

    radius = codes.radius(np.nan_to_num(known), norm)
    for at in range(0, len(q), BATCH):
        some = range(at, min(at + BATCH, len(q)))
        rows = [hopeful(i, index.within(code[i], word[i], widened(i) if np.isnan(known[i]) else radius[i]))
                for i in some]
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        row = np.concatenate(rows)
        got = products(np.ascontiguousarray(q[some.start:some.stop].T)[:, of], xt[:, row])
        order = np.lexsort((first[row], -got, of))
        starts = np.searchsorted(of, np.arange(len(rows) + 1))
        for a, b in zip(starts, starts[1:]):
            top = order[a:min(b, a + k)]  # no more than k vectors can hold the k best ids
            each = [ids[i] for i in row[top]]
            sid = np.concatenate(each) if each else np.empty(0, dtype=np.int64)
            sco = np.repeat(got[top], [len(e) for e in each])
            cut = np.lexsort((sid, -sco))[:k]
            out.append((sco[cut], sid[cut]))
    return out


# ------------------------------------------------------------------ on tables

def _prepared(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    kept = df.where(F.col(id_col).isNotNull() & (F.size(v) > 0) & finite(v) & F.exists(v, lambda x: x != 0))
    return kept.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(v).alias("v"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, bits: int = BITS,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows found nearest to every query row."""
    spark = vectors.sparkSession
    rows = _prepared(vectors, id_col, vector_col)
    # each distinct vector once, with its smallest ids
    copy = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    rows = (rows.withColumn("copy", copy).where(F.col("copy") <= k + 1)
            .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    rows = stage(rows.withColumn("dim", F.size("v")), "op12-rows")
    asked = _prepared(queries, id_col, vector_col)
    asked = stage(asked.select("vec_id", "v", F.min("vec_id").over(Window.partitionBy("v")).alias("q")), "op12-queries")
    names = stage(asked.where("vec_id = q").select("q", "v", F.size("v").alias("dim")), "op12-asked")

    found = None
    for dim in [r["dim"] for r in names.select("dim").distinct().orderBy("dim").collect()]:
        best = _search(rows.where(F.col("dim") == dim), names.where(F.col("dim") == dim), dim, k + 1, bits)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], RESULT)
    own = asked.select("vec_id", "q").join(found, "q")
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("vec_id")), 1, k)
    return (own.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("pos", "b"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("b.id").alias("vec_id"),
                    (-F.col("b.neg")).alias("score")))


def _search(rows: DataFrame, asked: DataFrame, dim: int, k: int, bits: int) -> DataFrame:
    """q, best (negated product, id; ascending) for the distinct vectors of one length."""
    most = F.max(F.array_max(F.transform("v", F.abs)))
    told = rows.agg(F.count(F.lit(1)).alias("n"), most.alias("most")).first()
    best = asked.select("q", "v", F.array().cast(_BEST).alias("best"))
    if not told["n"]:
        return best.select("q", "best")
    scaled = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / told["most"]) * (x / told["most"]))
    norm = told["most"] * rows.agg(F.sqrt(F.max(scaled))).first()[0]
    sample = rows.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE_ROWS).collect()
    codes = fit(np.array([r["v"] for r in sample]), norm, bits)

    size = max(1024, SLICE_VALUES // dim)
    slices, groups = ceil(told["n"] / size), max(1, ceil(asked.count() / (2 * size)))
    rows = rows.select("v", "ids", _share(F.xxhash64(F.col("ids")[0], F.lit(12)), slices).alias("slice"),
                       _numbers(0, groups).alias("grp"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "best": pa.array([], BEST_ARROW)})
        x, q = (t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim) for t in (left, right))
        ids = left.column("ids").combine_chunks()
        ids = np.split(ids.flatten().to_numpy(), np.cumsum([len(i) for i in ids])[:-1])
        known = right.column("known").to_numpy().astype(float)
        got = search_slice(codes, x, ids, q, known, k)
        ends = np.cumsum([0, *(len(s) for s, _ in got)])
        pairs = pa.StructArray.from_arrays(
            [pa.array(-np.concatenate([s for s, _ in got])), pa.array(np.concatenate([i for _, i in got]), pa.int64())],
            fields=list(BEST_ARROW.value_type))
        return pa.table({"q": right.column("q"), "best": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)})

    group = _share(F.xxhash64("q"), groups)
    done = 0
    while done < slices:
        upto = min(slices, max(1, done * GROWTH))
        known = F.when(F.size("best") == k, -F.element_at("best", -1)["neg"])
        ask = best.select("q", "v", known.alias("known"), group.alias("grp"),
                          _numbers(done, upto).alias("slice"))
        part = rows.where(F.col("slice").between(done, upto - 1))
        got = (part.groupBy("slice", "grp").cogroup(ask.groupBy("slice", "grp"))
               .applyInArrow(_named(cell), f"q long, best {_BEST}"))
        both = best.select("q", "best").unionByName(got).groupBy("q").agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        best = stage(best.select("q", "v").join(both, "q"), "op12-best")
        done = upto
    return best.select("q", "best")


# both sides of a cogroup need keys of one type: it compares and deals out their bytes

def _share(hashed: Column, n: int) -> Column:
    return F.pmod(hashed, F.lit(n)).cast("long")


def _numbers(first: int, end: int) -> Column:
    return F.explode(F.sequence(F.lit(first).cast("long"), F.lit(end - 1).cast("long")))


BEST_ARROW = pa.list_(pa.struct([pa.field("neg", pa.float64()), pa.field("id", pa.int64())]))


def _named(cell):
    """The two-table form that cogrouped Arrow functions must have."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return cell(left, right)
    return run
