"""Operator 8: token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each character;
dynamic programming carries, per end, the best score and the number of pieces on that
path, never the path itself. Rules are those of the unigram encoder of the tokenizers
library: a later candidate replaces an earlier one only when its score is strictly
greater, candidates of one end come by their start (longest piece first), a character
without a piece of its own costs the lowest score minus 10, neighbouring unknown
characters count once, or one per UTF-8 byte with byte fallback.

A text is split at white space and each word gets the word mark in front; no piece
reaches over a word mark, so words are independent and each distinct word of a worker is
solved once (``CACHE_WORDS`` at most are held).

Defined results: null, empty or blank text counts 0; every input row gives one row; an
empty table gives an empty result. Extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeed.llm.common import text_or_empty

MARK = "▁"
CACHE_WORDS = 600_000
UNKNOWN_PENALTY = 10.0


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, by id; id 0 is the unknown piece."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class UnigramCounter:
    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool):
        import ahocorasick
        self.auto = ahocorasick.Automaton()
        known = set()
        for piece, score in vocabulary:
            if piece not in known:  # of repeated pieces the first one's score counts
                known.add(piece)
                self.auto.add_word(piece, (len(piece), float(score)))
        self.auto.make_automaton()
        # pieces of marks alone are no danger: a word has its mark in front only
        if any(MARK in p[1:] and p.strip(MARK) for p in known):
            raise ValueError("a piece reaches over a word mark")
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.fallback = byte_fallback and all(f"<0x{b:02X}>" in known for b in range(256))
        self.words: dict[bytes, int] = {}

    def count_word(self, word: str) -> int:
        """Pieces of the best path over one word, its mark included."""
        text = MARK + word
        n = len(text)
        best, count = [None] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        open_unknown = [False] * (n + 1)  # the path to this end closes with an unknown character
        ends: list[list] = [[] for _ in range(n + 1)]
        for last, hit in self.auto.iter(text):
            ends[last + 1].append(hit)
        for end in range(1, n + 1):
            top, top_count, top_open, single = None, 0, False, False
            for length, score in ends[end]:
                start = end - length
                total = score + best[start]
                if top is None or total > top:
                    top, top_count, top_open = total, count[start] + 1, False
                single = single or length == 1
            if not single:
                start = end - 1
                total = self.unknown + best[start]
                if top is None or total > top:
                    size = len(text[start].encode("utf-8", "replace")) if self.fallback \
                        else 0 if open_unknown[start] else 1
                    top, top_count, top_open = total, count[start] + size, True
            best[end], count[end], open_unknown[end] = top, top_count, top_open
        return count[n]

    def count(self, raw: bytes) -> int:
        words, known = raw.split(), self.words
        got = list(map(known.get, words))
        if None in got:
            for i, g in enumerate(got):
                if g is None:
                    w = words[i]
                    g = known.get(w)
                    if g is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        g = known[w] = self.count_word(w.decode("utf-8", "replace"))
                    got[i] = g
        return sum(got)


_COUNTERS: dict[int, UnigramCounter] = {}


def _counter(vocabulary, byte_fallback: bool) -> UnigramCounter:
    key = hash((tuple(vocabulary), byte_fallback))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = UnigramCounter(vocabulary, byte_fallback)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]], byte_fallback: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens. The vocabulary (a tokenizer's, some 100,000 pieces at most) is sent to
    every task; the documents are not shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, byte_fallback))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*sent.value)
        for batch in batches:
            n = [counter.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    return d.mapInArrow(count, "doc_id long, n_tokens long")
