"""Operator 10: suffix-array dedup by a distributed, common-prefix-aware merge sort.

A byte goes when a ``LENGTH``-byte string that covers it also starts somewhere else. Sorting
every suffix of the corpus would move it many times over, so only suffixes at content-chosen
anchors are sorted: the anchor of a start position is the place of the smallest hash among the
next ``WINDOW`` ``GRAM``-byte grams (the leftmost of equals). Equal strings have
their anchors at the same offset, so each pair of equal strings meets at the suffixes of
their anchors, which share at least ``LENGTH - WINDOW + 1`` bytes.

1. One pass digests texts and lists their anchors with the starts they serve. Equal texts are
   one class with one representative; of two or more copies every string occurs elsewhere.
2. Anchors whose next bytes occur once are dropped (hash counts, combined map-side).
3. The suffixes of the others are sorted in each task, front-coded (length of the prefix
   shared with the suffix before, then the rest) and exchanged as sorted runs by a hash of
   those next bytes.
4. Each bucket merges its runs with a loser tree that knows how far each loser agrees with
   the last winner and compares only beyond that. The merge yields the suffix order with
   the common prefix lengths; starts ``l`` bytes before their anchors have equal strings when no
   common prefix shorter than ``LENGTH - l`` lies between them and their ``l`` bytes before the
   anchor agree.
5. A group of more than ``HOT`` suffixes is not brought together: its strings are counted by
   128-bit hashes instead, combined map-side.

Defined results: null text counts as empty; texts shorter than ``LENGTH`` lose nothing; repeated rows
are copies of each other; an empty table gives an empty result. Extra input columns are
ignored. Equality of the bytes before an anchor, of dropped anchors and of hot groups is by
hash (64 bits and more), all else by comparison.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeed.llm.common import mix64, stage, text_or_empty
from riskfeed.operators.common import maybe_broadcast

LENGTH = 400
WINDOW = 256
GRAM = 16
SURE = LENGTH - WINDOW + 1     # bytes after an anchor that equal strings share at least
PIECE = 1 << 20                # starts worked on at once
HOT = 20_000
HOT_BYTES = 32 << 20           # strings of hot groups that are broadcast at most
BUCKET_ROWS = 20_000
RUN_BYTES = 16 << 20
_PLACE_BITS = 24


# ------------------------------------------------------------------ anchors

def _words(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(b, 8)).view("<u8").ravel()


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: hash of the next ``SURE`` bytes, position, first and last start served."""
    out = []
    for s0 in range(0, len(raw) - LENGTH + 1, PIECE):
        n = min(PIECE, len(raw) - LENGTH + 1 - s0)
        w = _words(np.frombuffer(raw, dtype=np.uint8, count=n - 1 + LENGTH, offset=s0))
        m = n + WINDOW - 1
        key = mix64(mix64(w[:m]) + w[GRAM - 8:GRAM - 8 + m])
        key = (key >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(m, dtype=np.uint64)
        step = 1
        while step < WINDOW:  # smallest key of the next 2, 4, ... WINDOW grams
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        place = (key & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], n) - 1
        p = place[first]
        h = np.zeros(len(p), dtype=np.uint64)
        for k in [*range(0, SURE - 8, 8), SURE - 8]:
            h = mix64(h + w[p + k])
        out.append((h, p + s0, first + s0, last + s0))
    if not out:
        e = np.zeros(0, dtype=np.int64)
        return e.astype(np.uint64), e, e, e
    return tuple(np.concatenate(x) for x in zip(*out))


# ------------------------------------------------------------------ front-coded runs

_ENTRY = struct.Struct("<HHBBqq")  # shared prefix, rest of the suffix, bytes before, least offset, text, anchor


def front_code(entries: list[tuple[bytes, bytes, int, int, int]]) -> bytes:
    """A sorted run of (suffix, bytes before the anchor, least offset, text, anchor)."""
    out, last = [], b""
    for suffix, before, least, sid, anchor in sorted(entries):
        same = common_prefix(last, suffix, 0)
        out.append(_ENTRY.pack(same, len(suffix) - same, len(before), least, sid, anchor))
        out.append(suffix[same:])
        out.append(before)
        last = suffix
    return b"".join(out)


def read_run(blob: bytes) -> Iterator[tuple[int, bytes, bytes, int, int, int]]:
    """(prefix shared with the entry before, suffix, before, least, text, anchor) in order."""
    at, last = 0, b""
    while at < len(blob):
        same, rest, n, least, sid, anchor = _ENTRY.unpack_from(blob, at)
        at += _ENTRY.size
        last = last[:same] + blob[at:at + rest]
        at += rest
        yield same, last, blob[at:at + n], least, sid, anchor
        at += n


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, the first ``known`` bytes of which agree."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    low = known
    while low < most:  # a[:low] agrees; halve the stretch with the first difference
        half = (low + most + 1) // 2
        if a[low:half] == b[low:half]:
            low = half
        else:
            most = half - 1
    return low


class LoserTree:
    """Merge of sorted runs. Every loser keeps the length of the prefix it shares with the
    winner that beat it; a candidate is compared byte by byte only where both share equally
    much with the last output, and only beyond that."""

    def __init__(self, runs: list[Iterator]):
        self.k = 1
        while self.k < len(runs):
            self.k *= 2
        self.runs = runs + [iter(())] * (self.k - len(runs))
        self.head = [next(r, None) for r in self.runs]
        self.loser, self.same = [0] * self.k, [0] * self.k
        # the first round knows no prefixes
        level = [(i, 0 if self.head[i] else -1) for i in range(self.k)]
        node = self.k
        while len(level) > 1:
            node //= 2
            up = []
            for j in range(0, len(level), 2):
                won, lost = self._play(level[j], level[j + 1])
                at = node + j // 2
                self.loser[at], self.same[at] = lost
                up.append(won)
            level = up
        self.winner, self.shared = level[0]

    def _play(self, a: tuple[int, int], b: tuple[int, int]) -> tuple[tuple[int, int], tuple[int, int]]:
        """Winner and loser; each with what it shares: the winner with the last output, the
        loser with whichever it shares more, as the loser of this winner."""
        (i, x), (j, y) = a, b
        if x > y:
            return a, b
        if y > x:
            return b, a
        if x < 0:
            return a, b
        p, q = self.head[i][1], self.head[j][1]
        same = common_prefix(p, q, x)
        if p[same:same + 1] <= q[same:same + 1]:
            return a, (j, same)
        return b, (i, same)

    def __iter__(self) -> Iterator[tuple[int, tuple]]:
        """(prefix shared with the output before, entry)."""
        while self.head[self.winner] is not None:
            i = self.winner
            yield self.shared, self.head[i]
            self.head[i] = next(self.runs[i], None)
            play = (i, self.head[i][0] if self.head[i] else -1)
            node = (i + self.k) // 2
            while node >= 1:
                won, (self.loser[node], self.same[node]) = self._play(play, (self.loser[node], self.same[node]))
                play = won
                node //= 2
            self.winner, self.shared = play


def repeated_starts(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first byte, end byte) of every stretch covered by strings that start in more than
    one place, from the runs of one bucket."""
    shared, before, least, sid, anchor = [], [], [], [], []
    for same, (_, _, left, low, s, p) in LoserTree([read_run(b) for b in blobs]):
        shared.append(same)
        before.append(left)
        least.append(low)
        sid.append(s)
        anchor.append(p)
    n = len(sid)
    if n < 2:
        return
    shared, least = np.array(shared), np.array(least)
    most = np.array([len(b) for b in before])
    left = np.zeros((n, WINDOW), dtype=np.uint8)
    for i, b in enumerate(before):
        left[i, :len(b)] = np.frombuffer(b, dtype=np.uint8)[::-1]
    sid, anchor = np.array(sid, dtype=np.int64), np.array(anchor, dtype=np.int64)
    told = np.zeros(n, dtype=np.uint64)
    hit = np.zeros((n, WINDOW), dtype=bool)
    for offset in range(WINDOW):
        if offset:
            told = mix64(told + left[:, offset - 1].astype(np.uint64) + np.uint64(offset))
        here = np.flatnonzero((least <= offset) & (offset <= most))
        if len(here) < 2:
            continue
        group = np.cumsum(shared < LENGTH - offset)[here].astype(np.uint64)
        key = mix64(group + np.uint64(0x1234567)) + told[here]
        order = np.argsort(key)
        equal = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(here), dtype=bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        hit[here[order], offset] = twice
    edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)   # one past the largest offset of the stretch
    yield sid[row], anchor[row] - (high - 1), anchor[row] - low + LENGTH


# ------------------------------------------------------------------ Spark passes

def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha, n, hs, ps = [], [], [], []
        for t in batch.column(1):
            raw = t.as_py()
            h, p, first, last = anchors(raw)
            sha.append(hashlib.sha256(raw).digest())
            n.append(len(raw))
            hs.append(h.tobytes())
            ps.append(np.stack((p, p - first, p - last), axis=1).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
             pa.array(hs, pa.binary()), pa.array(ps, pa.binary())],
            names=["rid", "doc_id", "n_bytes", "sha", "hs", "ps"])


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sid = batch.column(0).to_pylist()
        hs = [np.frombuffer(x, dtype=np.int64) for x in batch.column(1).to_pylist()]
        ps = [np.frombuffer(x, dtype=np.int64).reshape(-1, 3) for x in batch.column(2).to_pylist()]
        if not sum(map(len, hs)):
            continue
        ps = np.concatenate(ps)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(hs)), pa.array(np.repeat(np.array(sid, dtype=np.int64), [len(x) for x in hs])),
             pa.array(ps[:, 0]), pa.array(ps[:, 1].astype(np.int16)), pa.array(ps[:, 2].astype(np.int16))],
            names=["h", "sid", "anchor", "most", "least"])


_ANCHORS = "h long, sid long, anchor long, most short, least short"


def _runs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def flush():
            keys = sorted(held)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), pa.array([front_code(held[k]) for k in keys], pa.binary())],
                names=["bucket", "run"])

        for batch in batches:
            for sid, raw, places in zip(*batch.columns):
                sid, raw = sid.as_py(), raw.as_py()
                for a in places.as_py():
                    p, most, least = a["anchor"], a["most"], a["least"]
                    suffix = raw[p:p - least + LENGTH]
                    held.setdefault(a["h"] % buckets, []).append((suffix, raw[p - most:p], least, sid, p))
                    size += len(suffix) + most + 150
                    if size >= RUN_BYTES:
                        yield flush()
                        held, size = {}, 0
        if held:
            yield flush()
    return run


def _merge(g: pd.DataFrame) -> pd.DataFrame:
    found = list(repeated_starts(list(g["run"])))
    cols = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 3
    return pd.DataFrame({"sid": cols[0], "first": cols[1], "stop": cols[2]})


_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def window_hashes(raw: bytes) -> list[np.ndarray]:
    """Two 64-bit hashes of each ``LENGTH``-byte string of ``raw``."""
    n = len(raw) - LENGTH + 1
    out = []
    for base in _BASES:
        byte = mix64(np.frombuffer(raw, dtype=np.uint8).astype(np.uint64) + base)
        h = byte
        total, size, done, left = np.zeros(n, dtype=np.uint64), 1, 0, LENGTH
        power = base
        while left:  # doubling: h holds the hashes of strings of ``size`` bytes
            if left & 1:
                total = total * power + h[done:done + n]
                done += size
            left >>= 1
            if left:
                h = h[:-size] * power + h[size:]
                with np.errstate(over="ignore"):
                    power = power * power
                size *= 2
        out.append(mix64(total))
    return out


def _hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for sid, raw, places in zip(*batch.columns):
            sid, raw = sid.as_py(), raw.as_py()
            for a in places.as_py():
                s = a["anchor"] - a["most"]
                x, y = window_hashes(raw[s:a["anchor"] - a["least"] + LENGTH])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), pa.array(np.full(len(x), sid)),
                     pa.array(np.arange(s, s + len(x)))], names=["x", "y", "sid", "first"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for sid, raw, spans in zip(*batch.columns):
            raw, at, end, kept, removed, runs = raw.as_py(), 0, -1, hashlib.sha256(), 0, 0
            for s in sorted((x["first"], x["stop"]) for x in spans.as_py()):
                if s[0] > end:
                    kept.update(raw[at:s[0]])
                    runs += 1
                    end, at = s[1], s[1]
                    removed += s[1] - s[0]
                elif s[1] > end:
                    removed += s[1] - end
                    end = at = s[1]
            kept.update(raw[at:])
            out.append((sid.as_py(), removed, runs, kept.hexdigest()))
        a, b, c, d = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.string())],
            names=["sid", "cut", "runs", "left"])


def _texts_of(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """sid and text of representatives; needed: sid, doc_id, sha."""
    want = needed.select("sid", F.col("doc_id").alias("_id"), "sha")
    found = texts.join(want, texts["doc_id"].eqNullSafe(want["_id"]))
    # rows that share an id are told apart by their text; identical rows give one
    right = F.unhex(F.sha2(F.col("text"), 256)) == F.col("sha")
    return found.where(right).select("sid", "text").dropDuplicates(["sid"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    rows = stage(texts.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
        _digest_rows, "rid long, doc_id long, n_bytes long, sha binary, hs binary, ps binary"), "op10-rows")
    classes = rows.groupBy("sha").agg(F.min("rid").alias("sid"), F.count(F.lit(1)).alias("copies"))
    classes = stage(classes, "op10-classes")

    reps = rows.where(F.length("hs") > 0).join(classes.select("sid"), rows["rid"] == F.col("sid"), "left_semi")
    places = stage(reps.select(F.col("rid").alias("sid"), "hs", "ps").mapInArrow(_explode, _ANCHORS), "op10-anchors")
    # written before the join: then both of its sides are plain shuffles, and a hash that holds
    # much of the anchors is split
    groups = stage(places.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "op10-groups")
    met = stage(places.join(groups, "h"), "op10-met")

    per_text = met.groupBy("sid").agg(
        F.collect_list(F.when(F.col("size") <= HOT, F.struct("h", "anchor", "most", "least"))).alias("places"),
        F.collect_list(F.when(F.col("size") > HOT, F.struct("h", "anchor", "most", "least"))).alias("hot"))
    needed = rows.join(per_text.select("sid"), rows["rid"] == F.col("sid")).select("sid", "doc_id", "sha")
    held = stage(_texts_of(texts, needed), "op10-texts")

    both = held.join(per_text, "sid")
    buckets = max(1, -(-met.count() // BUCKET_ROWS))
    runs = both.where(F.size("places") > 0).select("sid", "text", "places").mapInArrow(
        _runs(buckets), "bucket int, run binary")
    found = runs.groupBy("bucket").applyInPandas(_merge, "sid long, first long, stop long")
    hot = both.where(F.size("hot") > 0).select("sid", "text", "hot").mapInArrow(
        _hot_windows, "x long, y long, sid long, first long")
    # strings that occur twice: counted map-side first; where they are few (checked) the rows of a
    # passage that many texts share stay where they are, else that join is split by adaptive execution
    twice = stage(hot.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("x", "y"), "op10-twice")
    hot = hot.join(maybe_broadcast(twice, HOT_BYTES), ["x", "y"], "left_semi").select("sid", "first", (F.col("first") + LENGTH).alias("stop"))
    spans = stage(found.union(hot), "op10-spans")

    per_text = spans.groupBy("sid").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))
    cuts = held.join(per_text, "sid").select("sid", "text", "spans").mapInArrow(
        _cut, "sid long, cut long, runs long, left string")
    copies = classes.where("copies > 1").select("sha", "copies")
    out = rows.select("rid", "doc_id", "n_bytes", "sha").join(copies, "sha", "left")
    out = out.join(cuts, out["rid"] == cuts["sid"], "left")
    everything = F.col("copies").isNotNull() & (F.col("n_bytes") >= LENGTH)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id", "n_bytes",
        F.when(everything, F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
        F.when(everything, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(everything, F.lit(empty)).otherwise(F.coalesce("left", F.lower(F.hex("sha")))).alias("kept_sha256"))
