"""Operators 2 and 3: brute force retrieval, held-out accuracy, edge cases."""

import random

from riskfeed.llm import decontaminate as DC
from riskfeed.llm import quality as QC
from riskfeed.llm.queries import queries
from tests.conftest import SF_ORACLE


def _words(text):
    import re
    return re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", (text or "").lower()).split()


def _brute_leaks(docs, items):
    out = set()
    for item, text in items:
        w = _words(text)
        if not w:
            continue
        n = min(5, len(w))
        s = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
        for d, t in docs:
            x = _words(t)
            if len(s & {tuple(x[i:i + n]) for i in range(len(x) - n + 1)}) >= 0.8 * len(s):
                out.add((d, item))
    return out


def test_leaks_match_brute_force_on_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in queries()["op2_decontaminate"](spark, SF_ORACLE).collect()}
    want = _brute_leaks(docs, items)
    assert want and got == want


def test_leaks_edges(spark, docs_of, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(5, 70))) for i in range(60)] + [(60, "three word item"), (61, None), (62, " "), (7, "dup id " + text(9))]
    docs = []
    for i in range(120):
        t = text(rng.randint(0, 400))
        if i % 3 == 0:
            leak = items[rng.randrange(60)][1].split()
            if i % 2:
                leak[rng.randrange(len(leak))] = "changed"
            t = f"{t} {' '.join(leak).upper()}!! {text(50)}"
        docs.append((i, t))
    docs += [(500, None), (501, ""), (502, "So: three, word ITEM."), (0, docs[0][1]), (None, items[3][1]),
             (503, text(20_000) + " " + items[4][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = _brute_leaks(docs, items)
    for at_once in (20_000, 20):
        monkeypatch.setattr(DC, "ITEMS_AT_ONCE", at_once)
        got = DC.find_leaks(docs_of(docs), table).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
        kept = DC.drop_leaks(docs_of(docs), table)
        assert kept.columns == docs_of(docs).columns
        bad = {d for d, _ in want}
        assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(d) for d, _ in docs if d not in bad)


def test_leaks_empty(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert DC.find_leaks(docs_of([(1, "a b c d e")]), none).count() == 0
    assert DC.find_leaks(docs_of([]), none).count() == 0
    assert DC.drop_leaks(docs_of([(1, "a b c d e")]), none).count() == 1


def test_answer_column(spark, docs_of):
    items = spark.createDataFrame([(1, "what is the tall red house on the hill called", "it is called the old crown inn by all")],
                                  "item_id long, text string, reply string")
    q, a = items.collect()[0][1:]
    docs = docs_of([(1, f"intro {q} {a} outro"), (2, f"intro {q} outro"), (3, f"{a}")])
    assert [r["doc_id"] for r in DC.find_leaks(docs, items, answer="reply").collect()] == [1]


def test_quality_held_out(spark):
    sf = SF_ORACLE.replace("0.01", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = QC.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = QC.classify(docs, model).join(labels.where("doc_id % 2 = 1").withColumnRenamed("quality", "gold"), "doc_id").collect()
    assert sum((r["quality"] >= 0.5) == (r["gold"] == 1) for r in rows) / len(rows) >= 0.98
    assert sum((r["toxicity"] >= 0.5) == (r["toxic"] == 1) for r in rows) / len(rows) >= 0.97
    clean = [r for r in rows if r["gold"] == 1 and r["toxic"] == 0]
    assert sum(r["kept"] for r in clean) / len(clean) >= 0.99


def test_quality_without_annotations_and_edges(docs_of):
    good = "The old harbour town slept under a pale morning sky. Fishermen walked along the quay, talking quietly of rain."
    rows = [(i, f"{good} Day {i} was calm and the boats came home late.") for i in range(60)]
    rows += [(100 + i, "BUY$$$ NOW### " * 30) for i in range(20)]
    odd = [(200, None), (201, "   "), (202, "x"), (203, good + " word" * 100_000), (204, good), (204, good), (None, good)]
    docs = docs_of(rows + odd)
    got = QC.classify(docs, QC.fit(docs)).collect()
    assert len(got) == len(rows) + len(odd)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[i] for i in range(60)) and not any(kept[100 + i] for i in range(20))
    assert kept[204] and kept[None] and not kept[200] and not kept[201]
    stay = QC.keep_good(docs, QC.fit(docs))
    assert stay.columns == docs.columns and stay.count() == sum(r["kept"] for r in got)
    assert QC.classify(docs_of([]), QC.fit(docs_of([]))).count() == 0


def test_label_model_separates():
    rng = random.Random(2)
    patterns = {}
    for _ in range(5000):
        good = rng.random() < 0.8
        rate = [(0.95, 0.3), (0.9, 0.2), (0.99, 0.6), (0.8, 0.4)]
        v = "".join("2" if rng.random() < 0.2 else str(int(rng.random() < (g if good else b))) for g, b in rate)
        patterns[v] = patterns.get(v, 0) + 1
    m = QC.fit_labels(patterns)
    assert abs(m.prior - 0.8) < 0.1
    assert m.posterior("1111") > 0.9 > 0.1 > m.posterior("0000")


def _em_by_documents(docs, rounds):
    """The same estimation, one document after the other in plain Python: votes, annotators last."""
    m = len(docs[0])
    post = [0.95 if d[-1] == "1" else 0.05 if d[-1] == "0" else 0.1 if "0" in d else 0.9 for d in docs]
    loud = [not any(d[i] == "1" for d in docs) and any(d[i] == "0" for d in docs) for i in range(m - 1)] + [False]
    for _ in range(rounds):
        good = []
        for share, (a, b) in ((post, (4, 5)), ([1 - p for p in post], (1, 2))):
            total, rates = sum(share), []
            for i in range(m):
                voted = sum(s for s, d in zip(share, docs) if d[i] != "2")
                yes = sum(s for s, d in zip(share, docs) if d[i] == "1")
                if loud[i]:
                    rates.append(1 - (voted + 1) / (total + 2))
                elif i == m - 1:
                    more = QC.ANNOTATOR_WEIGHT * sum(d[i] != "2" for d in docs)
                    want = QC.ANNOTATORS if share is post else 1 - QC.ANNOTATORS
                    rates.append((yes + more * want) / (voted + more))
                else:
                    rates.append((yes + a) / (voted + b))
            good.append([min(max(r, 1e-3), 0.999) for r in rates])
        prior = min(max((sum(post) + 1) / (len(docs) + 2), 0.01), 0.99)
        post = []
        for d in docs:
            g, b = prior, 1 - prior
            for v, pg, pb in zip(d, *good):
                g, b = (g * pg, b * pb) if v == "1" else (g * (1 - pg), b * (1 - pb)) if v == "0" else (g, b)
            post.append(g / (g + b))
    return post


def _voted(n, seed, rates):
    rng, docs = random.Random(seed), []
    for _ in range(n):
        good = rng.random() < 0.8
        v = "".join("2" if rng.random() < 0.2 else str(int(rng.random() < (g if good else b))) for g, b in rates)
        loud = "0" if not good and rng.random() < 0.6 else "2"
        gold = "2" if rng.random() < 0.5 else str(int(good ^ (rng.random() < 0.03)))
        docs.append(v + loud + gold)
    return docs


def _counted(docs):
    out = {}
    for d in docs:
        out[d] = out.get(d, 0) + 1
    return out


def test_estimation_is_brute_force():
    docs = _voted(300, 4, [(0.95, 0.3), (0.9, 0.2), (0.8, 0.4)])
    model = QC.fit_labels(_counted(docs), annotated=True, rounds=15)
    for d, want in zip(docs, _em_by_documents(docs, 15)):
        assert abs(model.posterior(d) - want) < 1e-9


def test_targets_follow_the_labellers_with_many_annotations():
    """With over a thousand annotations, another labeller gives other targets, to annotated documents
    too; the annotators can be overruled."""
    docs = _voted(4000, 5, [(0.95, 0.3), (0.97, 0.1), (0.96, 0.1)])
    assert sum(d[-1] != "2" for d in docs) > 1000
    flip = [{"0": "1", "1": "0", "2": "2"}[d[1]].join((d[0], d[2:])) for d in docs]
    one, other = (QC.fit_labels(_counted(x), annotated=True) for x in (docs, flip))
    assert abs(one.posterior("11121") - other.posterior("11121")) > 1e-4
    assert abs(one.posterior("10121") - other.posterior("10121")) > 0.005
    assert one.posterior("00001") < 0.5 < one.posterior("11120")


def test_silent_documents_teach_only_where_nobody_votes_good():
    assert QC.informed({"222": 5, "022": 1, "221": 2}) == {"022", "221"}
    assert QC.informed({"222": 5, "022": 1}) == {"222", "022"}


def test_ties_at_the_cut(docs_of):
    """Quality exactly at the cut is kept, toxicity exactly at it is not."""
    zero = {a: QC.Scorer(QC.np.zeros(QC.BUCKETS, dtype="f4"), 0.0) for a in QC.ASPECTS}
    row = QC.classify(docs_of([(1, "some words")]), QC.QualityModel({}, zero)).first()
    assert (row["quality"], row["toxicity"], row["kept"]) == (0.5, 0.5, False)
    zero["toxicity"] = QC.Scorer(QC.np.zeros(QC.BUCKETS, dtype="f4"), 1.0)
    assert QC.classify(docs_of([(1, "some words")]), QC.QualityModel({}, zero)).first()["kept"]
