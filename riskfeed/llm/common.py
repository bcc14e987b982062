"""Helpers shared by the training-data operators: shared-folder tables, the
text conventions of the operators, and a vectorised word-shingle hasher."""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeed.session import ensure_checkpoint_dir

# white space of all operators here: space, tab, line feed, vertical tab, form feed, carriage return
SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, removed when the session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).deleteOnExit(p)
    except AttributeError:  # remote session without a JVM handle: the folder's owner cleans up
        pass
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches hold about ``BATCH_BYTES`` from here on, whatever the length of the texts.
    An executor buffers a whole batch outside its heap and frees it only when the heap is
    collected, so large batches add up beside it. A smaller setting of the session stays; it
    holds for the session, as an operator's last step runs when its result is read."""
    if _bytes(spark.conf.get(_BATCH_BYTES, "64m")) > BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def _bytes(text: str) -> int:
    """A size setting ("4096", "64m", "64MB") in bytes."""
    number, unit = re.fullmatch(r"([0-9]+)([a-z]?)[a-z]*", text.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, computes the
    rows once and survives the loss of executors. The schema is passed on, so an
    empty table reads back as well. The write's own shuffle files go when it ends."""
    spark = df.sparkSession
    bound_batches(spark)
    path = shared_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


# ------------------------------------------------------------------ numpy helpers

_MASK_SPACE = np.zeros(256, dtype=bool)
_MASK_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))  # A-Z only
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


PIECE_BYTES = 1 << 20
_STEP = np.arange(1, 257, dtype=np.uint64) * _BASE


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wrap-around arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(raw: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of one text (bytes), and each word's first byte and
    the byte after its last. A-Z are lower-cased when ``lower``.

    One running sum of bytes times powers of an odd base serves all words: the difference over a
    word, times the inverse power of its place, is a polynomial of its bytes alone. Long texts
    are worked through in pieces that end between words."""
    if len(raw) <= PIECE_BYTES:
        return _word_hashes(raw, lower)
    out, at = [], 0
    while at < len(raw):
        stop = min(len(raw), at + PIECE_BYTES)
        if stop < len(raw):
            cut = max(raw.rfind(c, at, stop) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
            if cut < at:  # a word longer than a piece: up to the next white space after it
                found = [i for i in (raw.find(c, stop) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")) if i >= 0]
                cut = min(found) if found else len(raw)
            stop = max(cut, at + 1)
        h, start, end = _word_hashes(raw[at:stop], lower)
        out.append((h, start + at, end + at))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*out))


def _word_hashes(raw: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = np.frombuffer(raw.translate(_LOWER) if lower else raw, dtype=np.uint8)
    n = len(b)
    inside = np.zeros(n + 2, dtype=bool)
    np.logical_not(_MASK_SPACE[b], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    return mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)), start, end


def _make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64, by doubling."""
    def powers(base: int) -> np.ndarray:
        out = np.ones(1, dtype=np.uint64)
        while len(out) < n:
            out = np.concatenate((out, out * np.uint64(pow(base, len(out), 1 << 64))))
        return out
    return powers(int(_BASE)), powers(pow(int(_BASE), -1, 1 << 64))


_POW = _make_powers(1 << 14)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW
    if len(_POW[0]) < n:
        _POW = _make_powers(n)
    return _POW


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n``-word shingles, in text order; fewer words make one shingle
    of the whole sequence; no words make none."""
    if not len(words):
        return words
    n = min(n, len(words))
    m = len(words) - n + 1
    acc = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        acc = mix64(acc + words[i:i + m] + _STEP[i])
    return acc


# ASCII punctuation and controls become spaces; bytes of other scripts stay in their words
_PLAIN_WORDS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def plain_words(text: str | None) -> bytes:
    """Lower-cased text without ASCII punctuation, as UTF-8: the words that overlap tests compare."""
    return (text or "").lower().encode("utf-8", "replace").translate(_PLAIN_WORDS)
