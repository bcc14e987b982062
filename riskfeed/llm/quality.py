"""Operator 3: quality classifier from weak labels.

Overlapping heuristic labellers each vote bad, good or nothing on every document; where
annotators have labelled documents, they are one labeller more, whose accuracy is estimated like
that of the others (their labels are only where the estimation starts). The votes of a document
form a pattern; the counts of the patterns over the whole corpus (3^m patterns at most)
are all that expectation-maximisation needs to estimate how often each labeller is right
on good and on bad documents, and the posterior of every pattern. The posterior labels of a
hash sample of about ``MAX_TRAIN`` of all documents, annotated or not, train (except those on
which nobody voted) a linear scorer over hashed features (words, word beginnings, word shapes, repetition), and
the scorer judges every document. Two aspects are learned this way: writing quality and
toxicity.

Defined results: null or blank text is rejected with quality 0 and toxicity 0; every
input row gives one row, repeated rows the same one; an empty corpus gives an empty
result; of a document's repeated annotations the worst counts. Extra input columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeed.llm.common import bound_batches, mix64, plain_words, stage, word_hashes

BUCKETS = 1 << 18
MAX_TRAIN = 12_000
MIN_DOCS = 4            # a hashed feature must occur in so many training documents
EM_ROUNDS = 60
ANNOTATORS = 0.98       # expected accuracy of the annotators, and the weight of this expectation
ANNOTATOR_WEIGHT = 3.0  # beside their votes
CHANCE = 4.0            # and its documents' labels must lie so many standard errors off the average
EPOCHS = 300
RIDGE = 1e-4
CUT = 0.5

# abusive words, an own choice in overlapping groups: each group is one toxicity labeller, right as
# often as the estimation finds
INSULTS = (
    ("idiot", "moron", "stupid", "imbecile", "dumb", "fool", "idiota", "dumm", "idiote", "loser", "clown"),
    ("trash", "scum", "filth", "garbage", "vermin", "worthless", "pathetic", "loser", "basura", "abschaum"),
    ("disgusting", "worthless", "pathetic", "hate", "clown", "stupid", "asqueroso", "dégoûtant", "ekelhaft"),
    ("idiot", "trash", "disgusting", "scum", "moron", "kill", "shut", "ugly"),
)

GOOD, BAD, NONE = 1, 0, 2


# ------------------------------------------------------------------ labellers

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#$%&*+<=>@\\^_`{|}~"]] = True


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("0"):ord("9") + 1] = ord("0")
_SHAPE[ord("a"):ord("z") + 1] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[[9, 10, 11, 12, 13]] = 32


def shape_hashes(raw: bytes) -> np.ndarray:
    """Per word the hash of its shape: each run of one kind of character counts once."""
    kind = _SHAPE[np.frombuffer(raw, dtype=np.uint8)]
    kind = kind[np.concatenate(([True], kind[1:] != kind[:-1]))] if len(kind) else kind
    return word_hashes(kind.tobytes(), lower=False)[0]


def _vote(value: float, good_to: float, bad_from: float) -> int:
    return GOOD if value <= good_to else BAD if value >= bad_from else NONE


# word shapes of ordinary prose: letters, one capital at most in front, one mark at most behind
_PLAIN_SHAPES = np.unique(np.concatenate([
    word_hashes((s + m).encode(), lower=False)[0] for s in ("a", "A", "Aa", "a-a", "a'a") for m in ("", *".,;:?!")
    if s + m != "A!"]))


def quality_votes(raw: bytes) -> list[int]:
    """Votes of the quality labellers on one text."""
    h = word_hashes(raw)[0]
    n = len(h)
    if not n:
        return [BAD] * 7
    hist = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    visible = int(hist[33:].sum())
    upper, lower = int(hist[65:91].sum()), int(hist[97:123].sum() + hist[0x80:0xC0].sum())
    stops = int(hist[ord(".")] + hist[ord("!")] + hist[ord("?")])
    blocks = [len(np.unique(h[i:i + 50])) / len(h[i:i + 50]) for i in range(0, n, 50) if len(h[i:i + 50]) >= 20]
    odd = 1 - float(np.isin(shape_hashes(raw), _PLAIN_SHAPES).mean())
    return [
        _vote(hist[_SYMBOLS].sum() / max(1, visible), 0.01, 0.05),
        _vote(odd, 0.15, 0.4),
        _vote(upper / max(1, upper + lower), 0.2, 0.5) if upper + lower >= 10 else NONE,
        _vote(hist[ord("!")] / n, 0.05, 0.3),
        _vote(float((h[1:] == h[:-1]).mean()), 0.05, 0.2) if n >= 5 else NONE,
        _vote(1 - float(np.mean(blocks)), 0.35, 0.6) if blocks else NONE,
        (GOOD if 0.01 <= stops / n <= 0.34 else BAD if stops / n > 0.7 else NONE) if n >= 10 else NONE,
    ]


_INSULT_HASHES = np.unique(word_hashes(" ".join(w for g in INSULTS for w in g).encode())[0])
_INSULT_GROUPS = np.array([sum(1 << i for i, g in enumerate(INSULTS) if h in word_hashes(" ".join(g).encode())[0])
                           for h in _INSULT_HASHES])


def toxicity_votes(plain: bytes) -> list[int]:
    words = word_hashes(plain)[0]
    at = np.minimum(np.searchsorted(_INSULT_HASHES, words), len(_INSULT_HASHES) - 1)
    groups = int(np.bitwise_or.reduce(_INSULT_GROUPS[at[_INSULT_HASHES[at] == words]], initial=0))
    return [BAD if groups >> i & 1 else NONE for i in range(len(INSULTS))]


# ------------------------------------------------------------------ label model

@dataclass
class LabelModel:
    """Two classes; per labeller the rates of its good vote, given that it votes. A labeller that only
    ever votes bad (a word list, silent on most bad documents too) is judged by how often it
    speaks on either class; its silence says nothing."""
    prior: float
    good_if_good: list[float]
    good_if_bad: list[float]

    def posterior(self, votes: str) -> float:
        """Probability that the document is good."""
        g, b = np.log(self.prior), np.log(1 - self.prior)
        for v, pg, pb in zip(votes, self.good_if_good, self.good_if_bad):
            v = int(v)
            if v == GOOD:
                g, b = g + np.log(pg), b + np.log(pb)
            elif v == BAD:
                g, b = g + np.log(1 - pg), b + np.log(1 - pb)
        return float(1 / (1 + np.exp(min(50.0, b - g))))


def fit_labels(patterns: dict[str, int], annotated: bool = False, rounds: int = EM_ROUNDS) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts. It starts from the documents
    on which nobody votes bad, so that the class called bad is the one the labellers call bad.
    With ``annotated`` the last vote of a pattern is the annotators': where there is one, the start
    is their label; from then on they are a labeller among the others."""
    keys = sorted(patterns)
    v = np.array([[int(c) for c in k] for k in keys])
    n = np.array([patterns[k] for k in keys], dtype=float)
    voted = v != NONE
    one_sided = [i for i in range(v.shape[1] - annotated) if voted[:, i].any() and not (v[:, i] == GOOD).any()]
    post = np.where((v == BAD).any(1), 0.1, 0.9)
    if annotated:
        post = np.where(v[:, -1] == GOOD, 0.95, np.where(v[:, -1] == BAD, 0.05, post))
    model = None
    for _ in range(rounds):
        wg, wb = n * post, n * (1 - post)
        prior = float(np.clip((wg.sum() + 1) / (n.sum() + 2), 0.01, 0.99))
        pg = [(wg[v[:, i] == GOOD].sum() + 4) / (wg[voted[:, i]].sum() + 5) for i in range(v.shape[1])]
        pb = [(wb[v[:, i] == GOOD].sum() + 1) / (wb[voted[:, i]].sum() + 2) for i in range(v.shape[1])]
        for i in one_sided:  # 1 - how often it speaks on documents of the class
            pg[i] = 1 - (wg[voted[:, i]].sum() + 1) / (wg.sum() + 2)
            pb[i] = 1 - (wb[voted[:, i]].sum() + 1) / (wb.sum() + 2)
        if annotated:
            more = ANNOTATOR_WEIGHT * n[voted[:, -1]].sum()
            pg[-1] = (wg[v[:, -1] == GOOD].sum() + more * ANNOTATORS) / (wg[voted[:, -1]].sum() + more)
            pb[-1] = (wb[v[:, -1] == GOOD].sum() + more * (1 - ANNOTATORS)) / (wb[voted[:, -1]].sum() + more)
        model = LabelModel(prior, [min(p, 0.999) for p in pg], [min(max(p, 1e-3), 0.999) for p in pb])
        post = np.array([model.posterior(k) for k in keys])
    return model


def informed(patterns: dict[str, int]) -> set[str]:
    """The patterns whose documents can teach: somebody voted. Where nobody votes good
    anywhere, silence is the only sign of good documents and all teach."""
    if not any(str(GOOD) in k for k in patterns):
        return set(patterns)
    return {k for k in patterns if k != str(NONE) * len(k)}


# ------------------------------------------------------------------ hashed features

BEGINNINGS = (5, 6)  # bytes


def _beginnings(plain: bytes, start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the first ``size`` bytes of the longer words."""
    start = start[end - start > size]
    b = np.frombuffer(plain, dtype=np.uint8)
    h = np.full(len(start), size, dtype=np.uint64)
    for j in range(size):
        h = h * np.uint64(0x100000001B3) + b[start + j].astype(np.uint64)
    return mix64(h)


def features(raw: bytes, plain: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of one text: each distinct word 1; word beginnings and word shapes by
    the root of their share of the words; repetition of neighbouring words by its share."""
    words, start, end = word_hashes(plain)
    kinds = [(np.unique(words), None, 0)]
    for size in BEGINNINGS:
        h, n = np.unique(_beginnings(plain, start, end, size), return_counts=True)
        kinds.append((h, 5 * np.sqrt(n / max(1, len(words))), 1))
    h, n = np.unique(shape_hashes(raw), return_counts=True)
    kinds.append((h, 3 * np.sqrt(n / max(1, n.sum())), 2))
    own = word_hashes(raw)[0]
    repeat = float((own[1:] == own[:-1]).mean()) if len(own) > 1 else 0.0
    kinds.append((np.zeros(1, dtype=np.uint64), np.array([5 * repeat]), 3))
    ids = np.concatenate([((h & np.uint64(BUCKETS // 4 - 1)) << np.uint64(2)) | np.uint64(k) for h, _, k in kinds])
    values = np.concatenate([np.ones(len(h)) if v is None else v for h, v, _ in kinds])
    return ids.astype(np.int64), values.astype(np.float32)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, ids: np.ndarray, values: np.ndarray) -> float:
        z = float(self.weights[ids] @ values) + self.bias
        return float(1 / (1 + np.exp(-max(-50.0, min(50.0, z)))))


ENTRIES = 1 << 20  # worked on at once, so that the driver holds little beside the sample itself


def fit_scorer(ids: np.ndarray, values: np.ndarray, row: np.ndarray, target: np.ndarray) -> Scorer:
    """Logistic regression on posterior labels by full-batch Adam, over the hashed features that
    are not rare and whose documents' labels differ from the average beyond chance. A document
    whose target is nan takes no part."""
    told = ~np.isnan(target)
    target = np.where(told, target, 0.0)
    n = max(1, int(told.sum()))
    mean = float(target.sum() / n) if told.any() else 1.0
    docs, mass, pull, square = np.zeros((4, BUCKETS))
    pieces = [slice(a, a + ENTRIES) for a in range(0, len(ids), ENTRIES)]
    for p in pieces:
        of = row[p]
        here = told[of]
        i, x, y = ids[p][here], values[p][here].astype(float), target[of[here]] - mean
        for total, w in ((docs, None), (mass, x), (pull, x * y), (square, x * x)):
            total += np.bincount(i, weights=w, minlength=BUCKETS)
    noise = np.sqrt(square * max(1e-4, mean * (1 - mean)))
    used = np.flatnonzero((docs >= MIN_DOCS) & (mass > 0) & (np.abs(pull) >= CHANCE * noise))
    weights = np.zeros(BUCKETS, dtype=np.float32)
    slot = np.full(BUCKETS, -1, dtype=np.int32)
    slot[used] = np.arange(len(used))
    kept = [[np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.float32)], [np.zeros(0, dtype=np.int32)]]
    for p in pieces:
        col, of = slot[ids[p]], row[p]
        here = (col >= 0) & told[of]
        for out, x in zip(kept, (col, values[p], of)):
            out.append(x[here])
    col, values, row = map(np.concatenate, kept)
    theta, m1, m2 = np.zeros(len(used) + 1), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, EPOCHS + 1):
        z = np.bincount(row, weights=theta[:-1][col] * values, minlength=len(target)) + theta[-1]
        err = np.where(told, 1 / (1 + np.exp(-np.clip(z, -50, 50))) - target, 0.0)
        g = np.append(np.bincount(col, weights=err[row] * values, minlength=len(used)) / n + RIDGE * theta[:-1],
                      err.sum() / n)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta -= 0.1 * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.99 ** t)) + 1e-8)
    weights[used] = theta[:-1]
    return Scorer(weights, float(theta[-1]))


# ------------------------------------------------------------------ Spark jobs

ASPECTS = ("quality", "toxicity")


@dataclass
class QualityModel:
    labels: dict[str, LabelModel] = field(default_factory=dict)
    scorers: dict[str, Scorer] = field(default_factory=dict)

    def judge(self, text: str | None) -> tuple[float, float, bool]:
        """quality, toxicity, kept."""
        raw, plain = (text or "").encode("utf-8", "replace"), plain_words(text)
        if not raw.split() or not self.scorers:
            return 0.0, 0.0, False
        ids, values = features(raw, plain)
        quality = self.scorers["quality"].score(ids, values)
        toxicity = 1 - self.scorers["toxicity"].score(ids, values)
        return quality, toxicity, quality >= CUT and toxicity < CUT


def _votes(text: str) -> tuple[str, str]:
    raw, plain = text.encode("utf-8", "replace"), plain_words(text)
    return "".join(map(str, quality_votes(raw))), "".join(map(str, toxicity_votes(plain)))


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes = [_votes(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([v[i] for v in votes], pa.string()) for i in (0, 1)]],
            names=["id", *ASPECTS])


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for t, gold_q, gold_x in zip(*(c.to_pylist() for c in batch.columns)):
            ids, values = features(t.encode("utf-8", "replace"), plain_words(t))
            q, x = _votes(t)
            out.append((q + gold_q, x + gold_x, ids.astype("<i4").tobytes(), values.astype("<f4").tobytes()))
        q, x, i, v = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, pa.string()), pa.array(x, pa.string()), pa.array(i, pa.binary()), pa.array(v, pa.binary())],
            names=["quality", "toxicity", "ids", "vals"])


def _annotations(labels: DataFrame | None, docs: DataFrame) -> DataFrame:
    """id and the annotators' vote on each aspect, one row per id."""
    if labels is None:
        return docs.sparkSession.createDataFrame([], "id long, gold_q string, gold_x string")
    worst = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")) \
                  .agg(F.min("quality").alias("q"), F.max("toxic").alias("x"))
    none = str(NONE)
    return worst.select("id", F.coalesce(F.when(F.col("q") > 0, F.lit(str(GOOD))).when(F.col("q") <= 0, F.lit(str(BAD))),
                                         F.lit(none)).alias("gold_q"),
                        F.coalesce(F.when(F.col("x") > 0, F.lit(str(BAD))).when(F.col("x") <= 0, F.lit(str(GOOD))),
                                   F.lit(none)).alias("gold_x"))


def fit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        max_train: int = MAX_TRAIN) -> QualityModel:
    """Label models from all documents, scorers from a hash sample of about ``max_train``
    documents (a bounded set, the only rows that reach the driver). ``labels`` (doc_id,
    quality 0/1, toxic 0/1) are annotations of some documents."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
            .where(F.col("text").isNotNull() & (F.length(F.trim("text")) > 0))
    gold = stage(_annotations(labels, docs), "op3-annotations")
    none = F.lit(str(NONE))
    voted = d.mapInArrow(_vote_rows, "id long, quality string, toxicity string").join(gold, "id", "left") \
             .select(F.concat("quality", F.coalesce("gold_q", none)).alias("quality"),
                     F.concat("toxicity", F.coalesce("gold_x", none)).alias("toxicity"))
    counts = voted.groupBy("quality", "toxicity").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns: dict[str, dict[str, int]] = {a: {} for a in ASPECTS}
    for r in counts:
        for a in ASPECTS:
            patterns[a][r[a]] = patterns[a].get(r[a], 0) + r["n"]
    rows = sum(patterns["quality"].values())
    if not rows:
        return QualityModel()
    # a hash share of all documents, with the annotations of that share (about max_train short rows
    # at most, which are broadcast)
    slot = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1_000_000))
    share = int(1_000_000 * min(1.0, max_train / rows))
    d = d.where(slot < share).join(F.broadcast(gold.where(slot < share)), "id", "left") \
         .withColumns({"gold_q": F.coalesce("gold_q", none), "gold_x": F.coalesce("gold_x", none)})
    model = QualityModel({a: fit_labels(patterns[a], annotated=True) for a in ASPECTS})
    sample = d.select("text", "gold_q", "gold_x").mapInArrow(_train_rows, "quality string, toxicity string, ids binary, vals binary") \
              .collect()
    votes = {a: [r[a] for r in sample] for a in ASPECTS}
    row = np.repeat(np.arange(len(sample), dtype=np.int32), [len(r["ids"]) // 4 for r in sample])
    values = np.frombuffer(b"".join(r["vals"] for r in sample), dtype="<f4")
    ids = np.frombuffer(b"".join(r["ids"] for r in sample), dtype="<i4")
    del sample
    for a in ASPECTS:
        known = {k: model.labels[a].posterior(k) for k in informed(patterns[a])}
        model.scorers[a] = fit_scorer(ids, values, row, np.array([known.get(k, np.nan) for k in votes[a]], dtype=float))
    return model


def classify(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, quality, toxicity, kept for every row; the model (two vectors of ``BUCKETS``
    weights) is broadcast, nothing is shuffled."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            got = [m.judge(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.float64()),
                 pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())],
                names=["doc_id", "quality", "toxicity", "kept"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, quality double, toxicity double, kept boolean")


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            yield batch.filter(pa.array([m.judge(t.as_py())[2] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
