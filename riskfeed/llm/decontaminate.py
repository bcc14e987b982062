"""Operator 2: benchmark decontamination with a BM25 index of the test items.

The items are indexed in blocks: per term its postings (item, impact), its largest impact
over all items and its largest impact per block of ``BLOCK_ITEMS`` items. Impacts are BM25
weights divided by the item's score against itself, so one threshold serves all items.
Every document is cut into overlapping passages long enough to hold any item whole, and
every passage is a query. Pruning is that of block-max WAND: a passage whose terms' largest
impacts do not add up to the threshold is dropped, then blocks whose block maxima do
not, and only the rest is scored. All items at or above the threshold are returned (the
threshold is fixed, so there is no heap), and each is verified: the share of its five-word
shingles found in the passage, over the whole item, its question and its answer.

The index is built for at most ``ITEMS_AT_ONCE`` items at a time and broadcast; more items
are taken in several such sets, each against all documents.

Words are lower-cased and stripped of ASCII punctuation. Items without a separate answer are
halved. Defined results: null or blank documents and items match nothing; items of fewer
than five words are compared as one shingle; repeated documents give repeated rows, of
items that repeat each is reported; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeed.llm.common import plain_words, shingle_hashes, word_hashes

K1, B = 1.2, 0.75
BLOCK_ITEMS = 16
ITEMS_AT_ONCE = 20_000
LEAST_PASSAGE = 128
SHINGLE = 5
RETRIEVE = 0.5          # share of the item's own BM25 score
OVERLAP = 0.8           # share of the item's shingles
PART_OVERLAP = 0.5      # share of the question's and of the answer's shingles
BOUNDS_AT_ONCE = 4_000_000  # block bounds summed at once
WORDS_AT_ONCE = 1 << 18  # a document is worked through in pieces of so many words

RESULT = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


class ItemIndex:
    """Inverted index of test items with term and block maxima."""

    def __init__(self, items: list[tuple]):
        """items: (item_id, question, answer); answer None: the text is halved."""
        self.ids, words, self.parts = [], [], []
        for item_id, question, answer in items:
            q = word_hashes(plain_words(question))[0]
            a = word_hashes(plain_words(answer))[0]
            w = np.concatenate((q, a))
            if not len(w):
                continue
            n = min(SHINGLE, len(w))
            whole = np.unique(shingle_hashes(w, n))
            cut = len(q) if answer is not None else (len(w) + 1) // 2
            sides = [np.unique(shingle_hashes(s, n)) if len(s) >= n else whole for s in (w[:cut], w[cut:])]
            self.ids.append(item_id)
            words.append(w)
            self.parts.append((n, whole, *sides))
        self.longest = max((len(w) for w in words), default=0)
        length = np.array([len(w) for w in words], dtype=float)
        self.terms = np.unique(np.concatenate(words)) if words else np.zeros(0, dtype=np.uint64)
        term, item, weight = [], [], []
        for i, w in enumerate(words):
            t, tf = np.unique(np.searchsorted(self.terms, w), return_counts=True)
            norm = K1 * (1 - B + B * length[i] / length.mean())
            term.append(t)
            item.append(np.full(len(t), i))
            weight.append(tf * (K1 + 1) / (tf + norm))
        if not words:
            return
        term, item, weight = np.concatenate(term), np.concatenate(item), np.concatenate(weight)
        df = np.bincount(term, minlength=len(self.terms))
        weight = weight * np.log1p((len(words) - df + 0.5) / (df + 0.5))[term]
        weight /= np.bincount(item, weights=weight, minlength=len(words))[item]
        order = np.lexsort((item, term))
        self.item, self.weight = item[order], weight[order]
        self.first = np.concatenate(([0], np.cumsum(df)))
        self.term_max = np.maximum.reduceat(self.weight, self.first[:-1])
        n_blocks = -(-len(words) // BLOCK_ITEMS)
        self.block_max = np.zeros((len(self.terms), n_blocks), dtype=np.float32)
        np.maximum.at(self.block_max, (term, item // BLOCK_ITEMS), weight.astype(np.float32) * np.float32(1.000001))

    def search(self, words: np.ndarray, passage: int) -> Iterator[tuple[int, float, float, float, float]]:
        """Verified matches of one text's word hashes: (item, score, overlaps of whole, question, answer)."""
        if not len(words) or not len(self.ids):
            return
        step = passage // 2
        place = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[place] == words)
        # word i lies in passages i // step and, but for the first half passage, the one before
        own = hit // step
        key = np.concatenate((own * len(self.terms) + place[hit],
                              (own - 1)[own > 0] * len(self.terms) + place[hit][own > 0]))
        key = np.unique(key)
        which, term = key // len(self.terms), key % len(self.terms)
        if not len(which):
            return
        start = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1])))
        stop = np.append(start[1:], len(which))
        bound = np.add.reduceat(self.term_max[term], start)
        for k, blocks in self.open_blocks(term, start, stop, np.flatnonzero(bound >= RETRIEVE - 1e-9)):
            t = term[start[k]:stop[k]]
            spans = [slice(self.first[x], self.first[x + 1]) for x in t]
            item = np.concatenate([self.item[s] for s in spans])
            weight = np.concatenate([self.weight[s] for s in spans])
            live = blocks[item // BLOCK_ITEMS]
            score = np.bincount(item[live], weights=weight[live], minlength=len(self.ids))
            p = int(which[start[k]])
            part = words[p * step:p * step + passage]
            sets: dict[int, np.ndarray] = {}
            for i in np.flatnonzero(score >= RETRIEVE - 1e-9):
                n, *shingles = self.parts[i]
                if n not in sets:
                    sets[n] = np.unique(shingle_hashes(part, n)) if len(part) >= n else part[:0]
                whole, question, answer = (float(np.isin(s, sets[n], assume_unique=True).mean()) for s in shingles)
                if whole >= OVERLAP and min(question, answer) >= PART_OVERLAP:
                    yield int(i), float(score[i]), whole, question, answer

    def open_blocks(self, term: np.ndarray, start: np.ndarray, stop: np.ndarray,
                    live: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Of the live passages those with a block whose maxima reach the threshold, and which blocks."""
        size = stop - start
        at_once = max(1, BOUNDS_AT_ONCE // (self.block_max.shape[1] * max(1, int(size.max()))))
        for i in range(0, len(live), at_once):
            some = live[i:i + at_once]
            begin = np.cumsum(size[some]) - size[some]
            rows = np.arange(int(size[some].sum())) + np.repeat(start[some] - begin, size[some])
            blocks = np.add.reduceat(self.block_max[term[rows]], begin) >= RETRIEVE - 1e-5
            for j in np.flatnonzero(blocks.any(axis=1)):
                yield int(some[j]), blocks[j]

    def matches(self, text: str | None) -> dict[int, tuple]:
        """Best verified match per item of one document."""
        words = word_hashes(plain_words(text))[0]
        passage = max(LEAST_PASSAGE, 2 * self.longest)
        best: dict[int, tuple] = {}
        for at in range(0, max(1, len(words)), WORDS_AT_ONCE):
            for i, *found in self.search(words[at:at + WORDS_AT_ONCE + passage], passage):
                if i not in best or tuple(found) > best[i]:
                    best[i] = tuple(found)
        return best


def indexes(items: DataFrame, id_col: str, question: str, answer: str | None) -> Iterator[ItemIndex]:
    """Indexes of at most about ``ITEMS_AT_ONCE`` items each; one is in memory at a time."""
    cols = [F.col(id_col).cast("long").alias("i"), F.col(question).cast("string").alias("q"),
            (F.col(answer).cast("string") if answer else F.lit(None).cast("string")).alias("a")]
    t = items.select(*cols)
    sets = max(1, -(-t.count() // ITEMS_AT_ONCE))
    for s in range(sets):
        mine = t if sets == 1 else t.where(F.pmod(F.xxhash64("i", "q"), F.lit(sets)) == s)
        yield ItemIndex([tuple(r) for r in mine.orderBy("i", "q").collect()])


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", question: str = "text", answer: str | None = None) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap of every verified match."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = []
    for index in indexes(items, item_id, question, answer):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                rows = [(d.as_py(), index.ids[i], *m) for d, t in zip(batch.column(0), batch.column(1))
                        for i, m in index.matches(t.as_py()).items()]
                cols = list(zip(*rows)) if rows else [[] for _ in range(6)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64())]
                    + [pa.array(c, pa.float64()) for c in cols[2:]],
                    names=["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"])

        found.append(d.mapInArrow(run, RESULT))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
               question: str = "text", answer: str | None = None) -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns."""
    out, spark = docs, docs.sparkSession
    at = docs.columns.index(text_col)
    for index in indexes(items, item_id, question, answer):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not sent.value.matches(t.as_py()) for t in batch.column(at)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
