"""Truth tables for gates, score funnel, store, backfill and digest
(FIXTURES sections 3-8)."""

import datetime as dt

from pyspark.sql import functions as F

from riskfeed.operators import backfill as BF
from riskfeed.operators import digest as DG
from riskfeed.operators import gates as G
from riskfeed.operators import score as Q
from riskfeed.operators import store as ST
from riskfeed.operators.sentiment import Lexicon


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_link_and_source_gates(spark):
    items = spark.createDataFrame([
        (1, "HTTPS://X.com/New ", "Reuters"), (2, "https://x.gov/a", "reuters"),
        (3, "https://x.co.uk/a", "reuters"), (4, "https://x.com:443/a", "reuters"),
        (5, "https://x.com/a", " AOL "), (6, "https://x.com/en/a", "reuters"),
        (7, "https://x.com/OLD", "reuters"), (8, None, "reuters"),
    ], "item_id int, link string, source string")
    from riskfeed.functions.text import normalize_name
    items = items.select("item_id", normalize_name("link").alias("link"), normalize_name("source").alias("source"))
    stored = spark.createDataFrame([("https://x.com/old",)], "link string")
    kept = G.link_gates(items, names(spark, ["aol"]), G.existing_links(stored)).collect()
    assert [(r["item_id"], r["link"]) for r in kept] == [(1, "https://x.com/new")]


def _score_inputs(spark):
    long_text = " ".join(["w"] * 600)
    rows = [
        (1, "news.google.com", "Malware found", long_text),
        (2, "reuters.com", "Malware found", long_text),
        (3, "www.reuters.com", "Malware found", long_text),
        (4, "nature.com", "Malware found", long_text),
        (5, "example.co.uk", "Malware found", long_text),
        (6, "dw.com", "Nothing here", " ".join(["w"] * 100)),
        (7, "example.com", "Nothing here", long_text),
        (8, "cheap-pills.example.com", "Malware found", long_text),
        (9, "france24.com", "Malware found", " ".join(["w"] * 200)),
        (10, "example.com", "Shocking malware", long_text),
        (11, "reuters.com", "You won't believe this malware", long_text),
        (12, None, "Malware found", long_text),
        (13, "example.gov", "Malware found", " ".join(["w"] * 151)),
        (14, "example.com", "Malware found", " ".join(["w"] * 150)),
        (15, "http://example.com/x", "Malware found", " ".join(["w"] * 501)),
    ]
    return spark.createDataFrame(rows, "n int, source_url string, title string, summary string")


def test_quality_score_funnel(spark):
    terms = spark.createDataFrame([("Malware",)], "search_terms string")
    allow = names(spark, ["reuters.com", "dw.com", "france24.com", "nature.com"])
    block = names(spark, ["nature.com", "aol"])
    got = {r["n"]: r for r in Q.quality_score(_score_inputs(spark), terms, allow, block).collect()}
    want_total = {1: 4, 2: 6, 3: 4, 4: 0, 5: 0, 6: 3, 7: 0, 8: 0, 9: 4, 10: 0, 11: 5, 12: 0, 13: 3, 14: 2, 15: 4}
    assert {n: r["quality_score"] for n, r in got.items()} == want_total
    # early exits leave later components NULL
    assert got[4]["score_blacklist_non_us_penalty"] == -999 and got[4]["score_search_term_matches"] is None
    assert got[7]["score_search_term_matches"] == 0 and got[7]["score_domain_penalty"] is None
    assert got[8]["score_domain_penalty"] == -1 and got[8]["score_us_bonus"] is None
    assert got[10]["score_clickbait_penalty"] == -1 and got[10]["score_length_150"] is None
    assert got[9]["score_domain_penalty"] == -1 and got[9]["score_length_500"] == 0
    assert all(0 <= r["quality_score"] <= 6 for r in got.values())


def test_substring_rule(spark):
    terms = spark.createDataFrame([("Maze",), ("commercial real estate ",)], "search_terms string")
    df = spark.createDataFrame([("An amazement",), ("in commercial real estate",)], "t string")
    got = {r["t"]: r["hit"] for r in Q.term_flag(df, ["t"], terms, "hit").collect()}
    assert got == {"An amazement": True, "in commercial real estate": False}


def test_component_stats_null_counts(spark):
    scored = spark.createDataFrame([(0, 0), (None, -1)], "score_search_term_matches int, score_domain_penalty int")
    for c in Q.SCORE_COLUMNS:
        if c not in scored.columns:
            scored = scored.withColumn(c, F.lit(None).cast("int"))
    stats = {r["component"]: r for r in Q.score_component_stats(scored).collect()}
    d = stats["score_domain_penalty"]
    assert d["mean_value"] == -0.5 and d["nonzero_ref"] == 1 and d["nonzero_strict"] == 1
    m = stats["score_search_term_matches"]
    assert m["nonzero_ref"] == 1 and m["nonzero_strict"] == 0


def test_recency_and_window_edges(spark):
    df = spark.createDataFrame([(dt.date(2025, 9, 10),), (dt.date(2025, 9, 12),), (dt.date(2025, 9, 9),),
                                (None,)], "published_date date")
    kept = sorted(r[0] for r in G.recent(df, "2025-09-11").collect())
    assert kept == [dt.date(2025, 9, 10), dt.date(2025, 9, 12)]
    w = spark.createDataFrame([(dt.date(2025, 5, 15),), (dt.date(2025, 5, 14),), (None,)], "published_date date")
    cur, old = ST.window_split(w, "2025-09-11 10:00:00", 120)
    assert [r[0] for r in cur.collect()] == [dt.date(2025, 5, 15)]
    assert [r[0] for r in old.collect()] == [dt.date(2025, 5, 14)]


def test_top_k_applies_before_recency(spark):
    stale = [("t", 1, i, i, dt.date(2025, 9, 1)) for i in range(20)]
    fresh = [("t", 1, 100 + i, 100 + i, dt.date(2025, 9, 11)) for i in range(5)]
    df = spark.createDataFrame(stale + fresh, "term string, result_page int, feed_pos int, item_id int, "
                                              "published_date date")
    assert G.recent(G.top_k_per_term(df, 20), "2025-09-11").count() == 0


def test_keep_first_dedupe(spark):
    rows = [("a", "l", dt.date(2025, 1, 1), 1, 7, 1), ("a", "l", dt.date(2025, 1, 1), 1, 1, 2),
            ("b", "m", None, 1, 3, 3), ("b", "m", None, 1, 4, 4)]
    new = spark.createDataFrame(rows, "title string, link string, published_date date, _batch int, "
                                      "term_pos int, item_id int")
    stored = spark.createDataFrame([("a", "l", dt.date(2025, 1, 1), 0, None, 99)], new.schema)
    out = ST.dedupe_keep_first(stored.unionByName(new), ST.DEDUPE_KEYS, ["_batch", "term_pos", "item_id"])
    got = sorted((r["title"], r["item_id"]) for r in out.collect())
    assert got == [("a", 99), ("b", 3)]


def test_attach_ids_fan_out(spark):
    items = spark.createDataFrame([("x",), ("nope",)], "term string")
    dic = spark.createDataFrame([(2, 1, "x"), (5, 2, "x")], "risk_id int, search_term_id int, search_terms string")
    got = sorted((r["term"], r["risk_id"]) for r in ST.attach_risk_ids(items, dic).collect())
    assert got == [("nope", None), ("x", 2), ("x", 5)]


def _lex(spark):
    e = "token string"
    return Lexicon(spark.createDataFrame([("good", 1.9)], "token string, valence double"),
                   spark.createDataFrame([], "token string, weight double"),
                   spark.createDataFrame([], e), spark.createDataFrame([], e))


def test_backfill_edges(spark):
    D = dt.date
    store = spark.createDataFrame([
        (1, "l1", D(2025, 3, 17), None), (2, "l2", D(2025, 3, 17), " " * 50),
        (3, "l3", D(2025, 3, 17), "x" * 39), (4, "l4", D(2025, 3, 17), "x" * 40),
        (5, "l5", D(2025, 3, 15), None), (6, "l6", D(2025, 3, 16), None),
    ], "doc_id int, link string, published_date date, summary string").withColumn(
        "sentiment", F.lit(None).cast("string")).withColumn("polarity", F.lit(None).cast("double")).withColumn(
        "last_run_timestamp", F.lit(None).cast("timestamp_ntz"))
    cands = sorted(r[0] for r in BF.candidates(store, "2025-03-17", "2025-04-20").select("doc_id").collect())
    assert cands == [1, 2, 3]
    targets = BF.batch_targets(store, "2025-03-17", "2025-04-20")
    assert sorted(r[0] for r in targets.select("doc_id").collect()) == [1, 2, 3, 5, 6]
    pages = spark.createDataFrame([
        (1, "l1", "<p>" + "good " * 10 + "</p>"), (2, "l2", "<p>" + "y" * 29 + "</p>"),
        (3, "l5", "<p>" + "z" * 30 + "</p>")], "page_id int, link string, html string")
    merged = {r["doc_id"]: r for r in BF.merge(store, targets, pages, _lex(spark), "2025-04-21 00:00:00",
                                               key_cols=("doc_id",)).collect()}
    assert merged[1]["backfilled"] and merged[1]["sentiment"] == "positive"
    assert not merged[2]["backfilled"] and merged[2]["summary"] == " " * 50
    assert merged[5]["backfilled"] and merged[5]["summary"] == "z" * 30
    assert not merged[4]["backfilled"]


def test_digest_samples(spark):
    D = dt.date
    rows = [(3, D(2025, 9, 10 - i), f"l{i}", None if i == 1 else f"title {i}") for i in range(7)]
    rows.append((None, D(2025, 9, 10), "lx", "orphan"))
    df = spark.createDataFrame(rows, "risk_id int, published_date date, link string, title string")
    got = DG.risk_digest(df, "risk_id", "title").collect()
    assert len(got) == 1 and got[0]["article_count"] == 7
    assert got[0]["sample_content"].split("\n") == [f"- title {i}..." for i in (0, 2, 3, 4, 5)]
    prompt = DG.risk_prompt(DG.risk_digest(df, "risk_id", "title")).first()["prompt"]
    assert "EMERGING RISK ID: 3\n" in prompt and "NUMBER OF ARTICLES/MENTIONS: 7\n" in prompt


def test_last_four_weeks_strict_parse(spark):
    ok = spark.createDataFrame([("2025-08-14",), ("2025-08-13",)], "published_date string")
    assert [r[0] for r in DG.last_four_weeks(ok, "2025-09-11 00:00:00").collect()] == ["2025-08-14"]
    bad = spark.createDataFrame([("2025-08-14",), ("2025-08-13",), ("garbage",)], "published_date string")
    assert DG.last_four_weeks(bad, "2025-09-11 00:00:00").count() == 3


def test_pick_column():
    cols = ["risk_id", "search_term_id", "title", "summary", "published_date", "sentiment"]
    assert DG.pick_column(cols, ("date", "time")) == "published_date"
    assert DG.pick_column(cols, ("title", "summary", "content", "text", "headline")) == "title"


def test_sentiment_join_path_equals_inline(spark):
    from riskfeed import constants as C
    from riskfeed.operators import sentiment as S
    from riskfeed.sources import binding as B
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    lex = B.lexicon(spark)
    inline = {r["doc_id"]: r["compound"] for r in S.score_texts(docs, "text", "doc_id", lex).collect()}
    saved = C.MAX_INLINE_LEXICON
    try:
        C.MAX_INLINE_LEXICON = 3          # force the explode + join + regroup path
        joined = {r["doc_id"]: r["compound"] for r in S.score_texts(docs, "text", "doc_id", lex, bound=3).collect()}
    finally:
        C.MAX_INLINE_LEXICON = saved
    assert joined == inline and len(inline) == docs.count()


def _scored_by_hand(text, valences, boosters, negations, contrasts):
    """The rules word by word, in plain Python."""
    import re

    from riskfeed import constants as C
    text = text or ""
    toks = [w for w in (re.sub(r"^[!-/:-@\\[-`{-~]+|[!-/:-@\\[-`{-~]+$", "", w) for w in text.split()) if w]
    low, caps = [w.lower() for w in toks], [re.fullmatch("[A-Z]+", w) is not None for w in toks]
    mixed, total = any(caps) and not all(caps), 0.0
    first = next((i for i, w in enumerate(low) if w in contrasts), None)
    for i, w in enumerate(low):
        v = valences.get(w, 0.0)
        if not v:
            continue
        sign = 1 if v > 0 else -1
        v += sign * C.SENT_CAPS_INCREMENT if caps[i] and mixed else 0
        before = [(low[i - d], damp) for d, damp in zip((1, 2, 3), C.SENT_BOOSTER_DAMPING) if i >= d]
        for b, damp in before:
            v += sign * boosters.get(b, 0.0) * damp
        for b, _ in before:
            v *= C.SENT_NEGATION_SCALAR if b in negations else 1
        if first is not None and i != first:
            v *= C.SENT_CONTRAST_BEFORE if i < first else C.SENT_CONTRAST_AFTER
        total += v
    asks = text.count("?")
    loud = min(text.count("!"), C.SENT_EXCLAIM_MAX) * C.SENT_EXCLAIM_WEIGHT + (
        C.SENT_QUESTION_MAX if asks > 3 else asks * C.SENT_QUESTION_WEIGHT if asks > 1 else 0.0)
    total += loud if total > 0 else -loud if total < 0 else 0
    return total / (total * total + C.SENT_NORMALIZE_ALPHA) ** 0.5 if toks else 0.0


def test_scores_are_those_of_the_rules_word_by_word(spark):
    import random

    from riskfeed.operators import sentiment as S
    from riskfeed.sources import binding as B
    rng = random.Random(5)
    words = [w for w, _ in B.TEST_VALENCES] + ["was", "very", "no", "not", "for", "plain", "other", "?", "!!", "(x)"]
    texts = [" ".join(w.upper() if rng.random() < 0.2 else w.title() + "," if rng.random() < 0.2 else w
                      for w in rng.choices(words, k=rng.randrange(25))) for _ in range(200)] + [None, "", "THE AND"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    args = dict(B.TEST_VALENCES), dict(B.TEST_BOOSTERS), set(B.TEST_NEGATIONS), set(B.TEST_CONTRASTS)
    for bound in (5000, 0):
        got = S.score_texts(df, "text", "i", B.lexicon(spark), bound=bound).orderBy("i").collect()
        assert [r["text"] for r in got] == texts
        for r in got:
            assert abs(r["compound"] - _scored_by_hand(r["text"], *args)) <= 5.1e-5, r["text"]


def test_large_dictionary_gives_the_same_flags(spark):
    words = ["alpha", "beta", "gam", "delta", "eps", "e", "\u00e9t\u00e9 1", "Gamma Y"]
    df = spark.createDataFrame([("x gamma y", None), ("NOTHING, in d", "?"), ("", "EPS!"), (None, None), ("", "un \u00c9t\u00c9 1"),
                                ("x gamma y", None)], "t string, u string")
    for n in (1, 3, len(words)):
        terms = spark.createDataFrame([(w,) for w in words[:n]], "search_terms string")
        inline, joined = ([tuple(r) for r in Q.term_flag(df, ["t", "u"], terms, "hit", bound=b).collect()] for b in (100, 0))
        assert sorted(inline, key=str) == sorted(joined, key=str)
    empty = spark.createDataFrame([("",)], "search_terms string")
    assert all(r["hit"] for b in (100, 0) for r in Q.term_flag(df, ["t"], empty, "hit", bound=b).collect())
    none = spark.createDataFrame([], "search_terms string")
    assert not any(r["hit"] for b in (100, 0) for r in Q.term_flag(df, ["t"], none, "hit", bound=b).collect())


def test_signatures_find_what_contains_finds(spark):
    """Random texts and terms of 1 to 14 characters over a few letters, one of them beyond the first
    plane, with line ends and a hot term: broadcast or shuffled, whichever gram is the rarest."""
    import random
    rng = random.Random(7)
    letters = "abC\n\u00e9\U0001F600"
    text = ["".join(rng.choices(letters, k=rng.randrange(0, 40))) for _ in range(150)] + [None, "hot stuff"] * 20
    terms = ["".join(rng.choices(letters, k=rng.randrange(3, 15))) for _ in range(25)] + ["hot", "stuff that is long"]
    df = spark.createDataFrame([(i, t, text[-i]) for i, t in enumerate(text)], "i int, t string, u string")
    low = Q._lower_terms(spark.createDataFrame([(w,) for w in terms], "search_terms string"))
    want = [any(w.lower() in (x or "").lower() for w in terms for x in (t, text[-i])) for i, t in enumerate(text)]
    assert 0 < sum(want) < len(want)
    for max_bytes in (1 << 20, 0):
        for sample in (0, 10, 10**9):
            for inline in (100, 0):
                got = Q._flag_by_signature(df, ["t", "u"], low, "hit", max_bytes, sample, inline).orderBy("i").collect()
                assert [r["hit"] for r in got] == want


def test_signature_is_the_rarest_part(spark):
    texts = spark.createDataFrame([(i, "common words here" + ("zebra" if i == 3 else "")) for i in range(9)],
                                  "_row long, x string")
    terms = spark.createDataFrame([("common zebra",), ("common",), ("c",)], "t string")
    got = {r["t"]: (r["gram"], r["sig"]) for r in Q.signatures(terms, texts, ["x"]).collect()}
    assert got["common zebra"] == ("on z", "on zebra")  # the first of the places that one text or none holds
    assert got["common"] == ("comm", "common") and got["c"] == ("c", "c")


def test_same_scores_for_every_lexicon_size(spark):
    """Repeated tokens, a key that is not unique, and both paths, for 10 to 300,000 entries."""
    from riskfeed.operators import sentiment as S
    from riskfeed.sources import binding as B
    base = B.lexicon(spark)
    docs = spark.createDataFrame([(1, "A w1 good day, not W9!"), (1, "bad w3 but w5"), (2, None), (3, "w2 W2 w2")],
                                 "key int, text string")
    seen = {}
    for size in (10, 1000, 300_000):
        rows = spark.range(size).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("token"),
                                        (F.col("id") % 7 - 3.0).alias("valence"))
        twice = spark.createDataFrame([("Good", 1.0), ("good", 2.0), ("bad", -1.5), ("Bad", 1.5), (None, 1.0)],
                                      "token string, valence double")
        lex = S.Lexicon(rows.union(twice), base.boosters, base.negations, base.contrasts)
        for bound in (3, 400_000):
            got = S.score_texts(docs, "text", "key", lex, bound=bound)
            seen[size, bound] = sorted((r["key"], r["compound"]) for r in got.collect())
    assert len(set(map(str, seen.values()))) == 1
