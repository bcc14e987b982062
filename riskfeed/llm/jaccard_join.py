"""Operator 9: exact n-gram Jaccard join with set-relation skipping.

A document's set is that of its word shingles (64-bit hashes). Documents of equal sets are one
class with one representative, whatever their number.

1. Token order: shingles that recur within a task's chunks are counted; the most frequent
   (``MOST_FREQUENT`` at most, a fixed broadcast) come last, by count, all others first, by hash.
   Any fixed order keeps the prefix rule exact, this one keeps frequent shingles out of it.
2. Index: the first ``n - ceil(t n) + 1`` shingles of each representative are its postings
   (shingle, set, size, position). Lists with one entry are dropped.
3. Pivots: of each list the member with the fewest unshared shingles is the pivot; only the
   pivot is compared with all others, so the number of pairs is linear. The prefixes alone
   give an upper bound of the overlap; pairs that may reach ``2t - 1`` are *near*.
4. Answers derived from the pivot's: Jaccard distance is a metric, so a set linked to the pivot
   can only link to near ones. Near sets are kept as differences to the pivot (a bitmap over
   its shingles and the few others), and their links among themselves are computed from those
   differences, in tiles of ``TILE`` sets, emitting only what connects.
5. Block skipping: pairs with a set that is not near are taken from the list directly,
   skipping by size and by position, then by prefix bound, and compared in full.

Every link is found or lies inside a component that other links already connect.

Defined results: null or blank text has an empty set and links with nothing; fewer words than
a shingle are one shingle; null ids take part but name a component only when no other id
can; rows repeated in the input are repeated in the result; an empty table gives an
empty result. Extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfeed.llm.common import mix64, shingle_hashes, stage, text_or_empty, word_hashes
from riskfeed.llm.components import connected_components

MOST_FREQUENT = 1 << 17
RECURS = 3                   # times within a chunk to be counted as recurring
CHUNK_SHINGLES = 2_000_000
TILE = 1024
_RANK_BITS = 18


# ------------------------------------------------------------------ sets in numpy

def shingle_set(raw: bytes, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(word_hashes(raw)[0], n))


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed 64-bit numbers."""
    hi = np.add.reduce(mix64(s + np.uint64(0x51ED2701)), dtype=np.uint64)
    lo = np.add.reduce(mix64(s ^ np.uint64(0xA5A5A5A5DEADBEEF)), dtype=np.uint64)
    return int(np.int64(hi.view(np.int64))), int(np.int64(lo.view(np.int64)))


def prefix_length(n: int, percent: int) -> int:
    """Shingles to index; 0 where no other set can be similar enough."""
    if 100 * n < percent * (n + 1):
        return 0
    return n - (percent * n + 99) // 100 + 1


class TokenOrder:
    """Order keys of shingles: frequent ones last, by rank, the others by hash."""

    def __init__(self, frequent: np.ndarray, rank: np.ndarray):
        self.frequent, self.rank = frequent, rank

    def keys(self, s: np.ndarray) -> np.ndarray:
        key = s >> np.uint64(_RANK_BITS)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, s), len(self.frequent) - 1)
            hit = self.frequent[at] == s
            key[hit] |= self.rank[at[hit]] << np.uint64(64 - _RANK_BITS)
        return np.sort(key)


def overlap_bound(pa_: np.ndarray, na: int, pb: np.ndarray, nb: int) -> int:
    """Most shingles that two sets can share, given their prefixes (sorted keys)."""
    if not len(pa_) or not len(pb):
        return min(na, nb)
    top = min(pa_[-1], pb[-1])
    a, b = np.searchsorted(pa_, top, side="right"), np.searchsorted(pb, top, side="right")
    return len(np.intersect1d(pa_[:a], pb[:b], assume_unique=True)) + min(na - int(a), nb - int(b))


def reaches(overlap, na, nb, percent):
    """Whether an overlap makes the Jaccard similarity at least ``percent`` / 100."""
    return 100 * overlap >= percent * (na + nb - overlap)


# ------------------------------------------------------------------ Spark passes

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))


def token_order(texts: DataFrame, n: int) -> TokenOrder:
    """Counts recurring shingles chunk by chunk; keeps ``MOST_FREQUENT`` at most, the cut being
    the lowest count with which they fit."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, size = [], 0

        def flush():
            h, c = np.unique(np.concatenate(sets), return_counts=True)
            h, c = h[c >= RECURS], c[c >= RECURS]
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))],
                                              names=["tok", "n"])

        for batch in batches:
            for t in batch.column(1):
                sets.append(shingle_set(t.as_py(), n))
                size += len(sets[-1])
                if size >= CHUNK_SHINGLES:
                    yield flush()
                    sets, size = [], 0
        if sets:
            yield flush()

    counts = stage(texts.mapInArrow(count, "tok long, n long").groupBy("tok").agg(F.sum("n").alias("n")), "op9-recurring")
    # a histogram of counts up to 2^20 (larger ones as that) has a fixed size
    level = F.least(F.col("n"), F.lit(1 << 20))
    histogram = sorted(((r["l"], r["k"]) for r in counts.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("k"))
                        .collect()), reverse=True)
    cut, total = None, 0
    for value, k in histogram:
        if total + k > MOST_FREQUENT:
            break
        cut, total = value, total + k
    rows = counts.where(F.col("n") >= cut).toPandas() if cut is not None else pd.DataFrame({"tok": [], "n": []})
    tok = rows["tok"].to_numpy(dtype=np.int64).view(np.uint64)
    by_count = np.lexsort((tok, rows["n"].to_numpy(dtype=np.int64)))
    rank = np.empty(len(tok), dtype=np.uint64)
    rank[by_count] = np.arange(1, len(tok) + 1, dtype=np.uint64)
    order = np.argsort(tok)
    return TokenOrder(tok[order], rank[order])


def _describe(texts: DataFrame, n: int, percent: int, order: TokenOrder) -> DataFrame:
    """Per row: rid, doc_id, size, digest of its set, prefix (order keys). texts: doc_id, text, rid."""
    sent = texts.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, hi, lo, prefix = [], [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py(), n)
                h, low = digest(s)
                size.append(len(s))
                hi.append(h)
                lo.append(low)
                p = prefix_length(len(s), percent)
                prefix.append(sent.value.keys(s)[:p].tobytes() if p else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(0), pa.array(size, pa.int32()), pa.array(hi, pa.int64()),
                 pa.array(lo, pa.int64()), pa.array(prefix, pa.binary())],
                names=["rid", "doc_id", "n", "hi", "lo", "prefix"])

    return texts.select("doc_id", "text", "rid").mapInArrow(
        run, "rid long, doc_id long, n int, hi long, lo long, prefix binary")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sid, n, raw = (batch.column(i).to_pylist() for i in range(3))
        keys = [np.frombuffer(p, dtype=np.uint64) for p in raw]
        size = [len(k) for k in keys]
        if not sum(size):
            continue
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(sid, dtype=np.int64), size)),
             pa.array(np.repeat(np.array(n, dtype=np.int32), size)),
             pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in size]))], names=["tok", "sid", "n", "pos"])


def _bounded(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) whose prefixes allow ``percent``."""
    left = prefixes.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("pa"))
    right = prefixes.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("pb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, xa, nb, xb = (c.to_pylist() for c in batch.columns)
            ok = [reaches(overlap_bound(np.frombuffer(x, dtype=np.uint64), i, np.frombuffer(y, dtype=np.uint64), j),
                          i, j, percent) for i, x, j, y in zip(na, xa, nb, xb)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]) \
                .filter(pa.array(ok, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "pa", "nb", "pb").mapInArrow(run, "a long, b long")


def _sets(texts: DataFrame, needed: DataFrame, n: int) -> DataFrame:
    """sid and whole set of the needed representatives, from their texts; needed: sid, doc_id, hi, lo."""
    want = needed.select(F.col("doc_id").alias("_id"), "sid", "hi", "lo")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                sid, out = [], []
                for s, hi, lo, t in zip(*(c.to_pylist() for c in batch.slice(i, 256).columns)):
                    x = shingle_set(t, n)
                    if digest(x) == (hi, lo):
                        sid.append(s)
                        out.append(x.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(out, pa.binary())],
                                                 names=["sid", "set"])

    found = texts.join(want, texts["doc_id"].eqNullSafe(want["_id"])).select("sid", "hi", "lo", "text")
    return found.mapInArrow(run, "sid long, set binary")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("sid").alias("a"), F.col("set").alias("sa"))
    b = sets.select(F.col("sid").alias("b"), F.col("set").alias("sb"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "sa", "sb")


_DELTA = "a long, b long, n int, linked boolean, bitmap binary, extra binary"


def _deltas(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each near set as its difference to the pivot a, and whether the two link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                size, linked, bitmap, extra = [], [], [], []
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    p, s = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                    has = np.isin(p, s, assume_unique=True)
                    size.append(len(s))
                    linked.append(bool(reaches(int(has.sum()), len(p), len(s), percent)))
                    bitmap.append(np.packbits(has).tobytes())
                    extra.append(s[~np.isin(s, p, assume_unique=True)].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(size, pa.int32()), pa.array(linked, pa.bool_()),
                     pa.array(bitmap, pa.binary()), pa.array(extra, pa.binary())],
                    names=["a", "b", "n", "linked", "bitmap", "extra"])

    return _with_sets(near, sets).mapInArrow(run, _DELTA)


def _ring_links(percent: int):
    def links(g: pd.DataFrame) -> pd.DataFrame:
        """Links among sets near one pivot, at least one of which is not linked to it: for each
        such set one link into the pivot's ball, and a spanning set of those among the others."""
        g = g.drop_duplicates("b")
        ring = np.flatnonzero(~g["linked"].to_numpy())
        out = []
        if len(ring) and len(g) > 1:
            base = np.unpackbits(np.stack([np.frombuffer(x, dtype=np.uint8) for x in g["bitmap"]]), axis=1)
            extra = [np.frombuffer(x, dtype=np.uint64) for x in g["extra"]]
            tok, count = np.unique(np.concatenate(extra), return_counts=True)
            tok = tok[count > 1]
            more = np.zeros((len(g), len(tok)), dtype=np.uint8)
            for i, e in enumerate(extra):
                more[i, np.searchsorted(tok, e[np.isin(e, tok, assume_unique=True)])] = 1
            m = np.concatenate((base, more), axis=1).astype(np.float32)
            size, ids, linked = g["n"].to_numpy(), g["b"].to_numpy(), g["linked"].to_numpy()
            root = np.arange(len(g))

            def find(i):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for at in range(0, len(ring), 256):
                rows = ring[at:at + 256]
                shared = m[rows] @ m.T
                hit = reaches(np.rint(shared).astype(np.int64), size[rows][:, None].astype(np.int64),
                              size[None, :].astype(np.int64), percent)
                for i, row in zip(rows, hit):
                    row[i] = False
                    ball = np.flatnonzero(row & linked)
                    if len(ball):
                        out.append((ids[i], ids[ball[0]]))
                    for j in np.flatnonzero(row & ~linked):
                        x, y = find(i), find(j)
                        if x != y:
                            root[x] = y
                            out.append((ids[i], ids[j]))
        return pd.DataFrame({"a": [x for x, _ in out], "b": [y for _, y in out]}, dtype="int64")
    return links


def _full_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64)
                ok.append(bool(reaches(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t), percent)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]) \
                .filter(pa.array(ok, pa.bool_()))
    return _with_sets(pairs, sets).mapInArrow(run, "a long, b long")


def jaccard_classes(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept (one row of each
    component, the smallest id first; sets without shingles are all kept), rid (``row_col``,
    a number that tells the input rows apart, or one given here)."""
    texts = _texts(docs, id_col, text_col)
    order = token_order(texts, n)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"),
                        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("rid"))
    rows = stage(_describe(keyed, n, percent, order), "op9-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    classes = stage(rows.where("n > 0").groupBy("hi", "lo", "n")
                        .agg(F.min("rid").alias("sid"), first.alias("first")), "op9-classes")
    links = stage(_links(texts, rows, classes, n, percent), "op9-links")

    parts = connected_components(links, "a", "b")
    named = classes.join(parts, classes["sid"] == parts["node"], "left") \
                   .select("hi", "lo", "n", "first", F.coalesce("component", "sid").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    named = named.join(least, "component").select("hi", "lo", "n", "least")
    out = rows.select("rid", "doc_id", "hi", "lo", "n").join(named, ["hi", "lo", "n"], "left")
    blank = F.col("n") == 0
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.when(blank, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                      (blank | (F.col("rid") == F.col("least.rid"))).alias("kept"), "rid")


def _links(texts: DataFrame, rows: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between class representatives that connect every similar pair."""
    reps = rows.join(classes.select("sid"), rows["rid"] == F.col("sid")).where(F.length("prefix") > 0)
    postings = reps.select("sid", "n", "prefix").mapInArrow(_postings, "tok long, sid long, n int, pos int")
    listed = postings.withColumn("entries", F.count(F.lit(1)).over(Window.partitionBy("tok")))
    lists = stage(listed.where("entries > 1").drop("entries"), "op9-lists")

    shared = lists.groupBy("sid").agg(F.count(F.lit(1)).alias("shared"))
    known = stage(rows.join(shared, rows["rid"] == shared["sid"])
                      .select("sid", "n", "prefix", "doc_id", "hi", "lo",
                              (F.length("prefix") / 8 - F.col("shared")).cast("int").alias("unshared")), "op9-listed")
    first = Window.partitionBy("tok").orderBy("unshared", F.xxhash64("sid"), "sid")
    lists = lists.join(known.select("sid", "unshared"), "sid") \
                 .withColumn("pivot", F.first("sid").over(first)).where("sid != pivot")
    lists = stage(lists.select("tok", "sid", "n", "pos", "pivot"), "op9-pivots")

    star = lists.select(F.col("pivot").alias("a"), F.col("sid").alias("b")).distinct()
    near = stage(_bounded(star, known, 2 * percent - 100), "op9-near")

    # pairs of a list with a member that is not near its pivot
    flag = near.select(F.col("a").alias("pivot"), F.col("b").alias("sid"), F.lit(True).alias("near"))
    marked = lists.join(flag, ["pivot", "sid"], "left").withColumn("near", F.coalesce("near", F.lit(False)))
    marked = stage(marked, "op9-marked")
    far = marked.where(~F.col("near")).select("tok", F.col("sid").alias("s1"), F.col("n").alias("n1"),
                                              F.col("pos").alias("p1"))
    # a shared shingle at these positions, the first of the pair, leaves at most this overlap
    most = F.least(F.col("n") - F.col("pos"), F.col("n1") - F.col("p1"))
    rest = far.join(marked, "tok").where(
        ((F.col("s1") < F.col("sid")) | (F.col("near") & (F.col("s1") != F.col("sid"))))
        & (100 * F.least("n", "n1") >= percent * F.greatest("n", "n1"))
        & ((100 + percent) * most >= percent * (F.col("n") + F.col("n1"))))
    rest = rest.select(F.least("s1", "sid").alias("a"), F.greatest("s1", "sid").alias("b")).distinct()
    rest = stage(_bounded(rest, known, percent), "op9-rest")

    both = near.union(rest)
    used = both.select("a").union(both.select("b")).distinct().select(F.col("a").alias("sid"))
    needed = known.join(used, "sid", "left_semi").select("sid", "doc_id", "hi", "lo")
    sets = stage(_sets(texts, needed, n), "op9-sets")

    deltas = stage(_deltas(near, sets, percent), "op9-deltas")
    links = deltas.where("linked").select("a", "b").union(_full_links(rest, sets, percent))

    # tiles of the sets near one pivot, every pair of tiles once
    sizes = deltas.groupBy("a").agg(F.count(F.lit(1)).alias("m"), F.count_if(~F.col("linked")).alias("ring"))
    sizes = sizes.where("ring > 0 and m > 1").select("a", F.ceil(F.col("m") / TILE).cast("int").alias("k"))
    tiled = deltas.join(sizes, "a").withColumn("t", F.pmod(F.xxhash64("b"), F.col("k")).cast("int"))
    tiled = tiled.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    tiled = tiled.withColumn("i", F.least("t", "o")).withColumn("j", F.greatest("t", "o"))
    # by all three keys: the tiles of one pivot must not share a task
    ring = tiled.repartition("a", "i", "j").groupBy("a", "i", "j").applyInPandas(_ring_links(percent), "a long, b long")
    return links.union(ring)


def one_per_class(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component is kept, with all
    their columns."""
    d = stage(docs.withColumn("_rid", F.monotonically_increasing_id()), "op9-documents")
    found = jaccard_classes(d, n, percent, id_col, text_col, row_col="_rid")
    return d.join(found.where("kept").select(F.col("rid").alias("_rid")), "_rid", "left_semi").drop("_rid")
