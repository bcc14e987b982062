"""Operator 4: language identification with language-bitmask n-gram filters.

Learning counts, per character n-gram and language, the documents that hold it, and
keeps the languages in which the n-gram's rate comes near its highest rate. The kept pairs fill a
bit-sliced Bloom filter: one row per position, one bit per language, so the AND of the
``HASHES`` rows of an n-gram gives all languages that contain it at once. Prediction
sums those bits per language over every n-gram of the whole text, takes off the share
that a filter of that fill answers by mistake, and picks the largest count.

Learning may use a hash sample of at most about ``MAX_TRAIN`` labelled rows, of each language an
equal part of that or all it has, and keeps at most ``MAX_GRAMS`` (n-gram, language) pairs, of each
language an equal part, the most frequent first; so the filter sent to the tasks has a fixed size of
``POSITIONS`` rows. Prediction covers all rows and whole texts.

Defined results: null text, or text without a letter, gives ``und`` with score 0; without any
labelled row everything is ``und``; equal counts go to the language with more labelled
rows, then by name. Every input row gives one row. Extra input columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfeed.llm.common import bound_batches, mix64, stage

ORDERS = (3, 4)
POSITIONS = 1 << 21
HASHES = 3
MAX_TRAIN = 40_000
MAX_GRAMS = 400_000
NEAR_HIGHEST = 0.25
CHUNK = 1 << 20
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def gram_hashes(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of the character n-grams of the lower-cased words of a text, each
    occurrence once, in bounded pieces."""
    words = _LETTERS.findall(text.lower())
    if not words:
        return
    line = f" {' '.join(words)} "
    reach = max(ORDERS) - 1
    for at in range(0, len(line), CHUNK):
        code = np.frombuffer(line[at:at + CHUNK + reach].encode("utf-32-le", "surrogatepass"),
                             dtype="<u4").astype(np.uint64)
        parts = []
        for n in ORDERS:
            m = min(CHUNK, len(code) - n + 1)
            if m > 0:
                h = np.full(m, n, dtype=np.uint64)
                for i in range(n):
                    h = h * np.uint64(0x100000001B3) + code[i:i + m]
                parts.append(mix64(h))
        if parts:
            yield np.concatenate(parts)


def positions(h: np.ndarray) -> list[np.ndarray]:
    """``HASHES`` filter rows of each hash."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(j) * step) % np.uint64(POSITIONS)).astype(np.int64) for j in range(HASHES)]


@dataclass
class LanguageModel:
    """languages by falling count of labelled rows; filter rows as bytes of language bits."""
    languages: list[str]
    table: np.ndarray
    wrong: np.ndarray  # per language: share of foreign n-grams that the filter answers by mistake

    def predict(self, text: str | None) -> tuple[str, float]:
        total, hits = 0, np.zeros(len(self.languages))
        if text is not None and self.languages:
            for h in gram_hashes(text):
                total += len(h)
                rows = None
                for p in positions(h):
                    got = self.table[p]
                    rows = got if rows is None else rows & got
                for i in range(len(self.languages)):
                    hits[i] += np.count_nonzero(rows[:, i >> 3] & np.uint8(1 << (i & 7)))
        if not total:
            return UNDETERMINED, 0.0
        true = (hits - total * self.wrong) / np.maximum(1e-9, 1 - self.wrong)
        i = int(np.argmax(true))
        return self.languages[i], float(min(1.0, max(0.0, true[i] / total)))


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_train: int = MAX_TRAIN, max_grams: int = MAX_GRAMS) -> LanguageModel:
    t = train.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
             .where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = stage(t.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "op4-sizes")
    rows, many = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    if not rows:
        return LanguageModel([], np.zeros((POSITIONS, 1), dtype=np.uint8), np.zeros(0))
    if rows > max_train:
        slot = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.col("text"))), F.lit(1_000_000_000))
        share = sizes.select("lang", F.least(F.lit(1.0), F.lit(max_train / many) / F.col("n")).alias("share"))
        t = t.join(F.broadcast(share), "lang").where(slot < F.col("share") * 1_000_000_000)  # a row per language

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0), batch.column(1)):
                seen = [np.unique(h) for h in gram_hashes(text.as_py())]
                seen = np.unique(np.concatenate(seen)) if seen else np.zeros(0, dtype=np.uint64)
                # an empty marker counts the language's rows
                by_lang.setdefault(lang.as_py(), []).append(seen)
            for lang, docs in by_lang.items():
                h, n = np.unique(np.concatenate(docs), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array([lang] * len(h), pa.string()), pa.array(n, pa.int64()),
                     pa.array(np.zeros(len(h), dtype=np.int64))], names=["gram", "lang", "df", "docs"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None], pa.int64()), pa.array([lang]), pa.array([0], pa.int64()),
                     pa.array([len(docs)], pa.int64())], names=["gram", "lang", "df", "docs"])

    counted = t.select("text", "lang").mapInArrow(grams, "gram long, lang string, df long, docs long") \
               .groupBy("gram", "lang").agg(F.sum("df").alias("df"), F.sum("docs").alias("docs"))
    counted = stage(counted, "op4-grams")
    n_docs = {r["lang"]: r["docs"] for r in counted.where(F.col("gram").isNull()).select("lang", "docs").collect()}
    labelled = {r["lang"]: r["n"] for r in sizes.collect()}
    languages = sorted(n_docs, key=lambda x: (-labelled[x], x))
    size = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(n_docs[k]))]) if languages else None
    if size is None:
        return LanguageModel([], np.zeros((POSITIONS, 1), dtype=np.uint8), np.zeros(0))
    rate = counted.where(F.col("gram").isNotNull()).withColumn("rate", F.col("df") / size[F.col("lang")])
    high = F.max("rate").over(Window.partitionBy("gram"))
    kept = rate.withColumn("high", high).where(F.col("rate") >= NEAR_HIGHEST * F.col("high"))
    most = max(1, max_grams // len(languages))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("df").desc(), "gram"))
    kept = kept.withColumn("place", place).where(F.col("place") <= most).select("gram", "lang")
    got = kept.toPandas()  # max_grams rows at most

    table = np.zeros((POSITIONS, -(-len(languages) // 8)), dtype=np.uint8)
    for i, lang in enumerate(languages):
        h = got.loc[got["lang"] == lang, "gram"].to_numpy(dtype=np.int64).view(np.uint64)
        for p in positions(h):
            np.bitwise_or.at(table[:, i >> 3], p, np.uint8(1 << (i & 7)))
    wrong = np.array([np.count_nonzero(table[:, i >> 3] & np.uint8(1 << (i & 7))) / POSITIONS
                      for i in range(len(languages))]) ** HASHES
    return LanguageModel(languages, table, wrong)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score. The model (a few MB, bounded) is broadcast; nothing is shuffled."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            got = [m.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, lang_pred string, score double")
