"""Quality score (composite projection), its membership / substring joins and
its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.functions import text as X
from riskfeed.operators.common import TooLarge, bounded_bytes, literal_array, maybe_broadcast

SCORE_COLUMNS = [f"score_{c}" for c in C.SCORE_COMPONENTS]


GRAM = 4       # characters by which texts and signatures meet
SIGNATURE = 8  # characters of a signature


def _lower_terms(terms: DataFrame) -> DataFrame:
    return terms.select(F.lower(F.col("search_terms")).alias("t")).where(F.col("t").isNotNull()).distinct()


def contains_any(text: Column, terms: Column) -> Column:
    """JN5: lower(text) contains at least one term of the array (substring, no word boundary)."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.exists(terms, lambda t: F.contains(low, t))


def term_flag(df: DataFrame, text_cols: list[str], terms: DataFrame, out: str,
              bound: int = C.MAX_INLINE_TERMS) -> DataFrame:
    """Adds ``out``: any of the texts contains a search term. Up to ``bound`` terms are tested
    as a literal array, without a shuffle; a larger dictionary is met by signatures, which
    gives the same answer."""
    low = _lower_terms(terms)
    try:
        array = literal_array(low, F.col("t"), bound)
    except TooLarge:
        return _flag_by_signature(df, text_cols, low, out)
    flag = F.lit(False)
    for c in text_cols:
        flag = flag | contains_any(F.col(c), array)
    return df.withColumn(out, flag)


def _grams(text: Column, least: int, most: int) -> Column:
    """At each place of a text its next ``most`` characters, or what is left if that is ``least``
    at least: one regex pass (a lookahead)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{least},{most}}}))"), 1))


def _stretches(text: Column, n: int) -> Column:
    """Distinct (gram of ``n`` characters, stretch that starts with it)."""
    return F.transform(_grams(text, n, n if n < GRAM else SIGNATURE),
                       lambda c: F.struct(F.substring(c, 1, n).alias("gram"), c.alias("next")))


def signatures(terms: DataFrame, texts: DataFrame, cols: list[str], sample: int = C.SIGNATURE_SAMPLE) -> DataFrame:
    """(gram, sig, t) of lower-cased, non-empty terms ``t``: ``sig`` is a part of the term of at
    most ``SIGNATURE`` characters, ``gram`` its first ``GRAM`` characters. A term of that length
    or less is its own signature. A longer one takes the stretch that starts with its rarest
    gram: the one that the fewest of about ``sample`` texts hold (chosen by hash of ``_row``),
    ties by place. Which one is chosen steers the work only, never the answer."""
    whole = terms.where((F.length("t") <= SIGNATURE) & (F.col("t") != ""))
    places = F.sequence(F.lit(1), F.length("t") - SIGNATURE + 1)
    long = terms.where(F.length("t") > SIGNATURE).select("t", F.explode(places).alias("at"))
    long = long.withColumn("gram", F.substring("t", F.col("at"), F.lit(GRAM)))
    some = texts.where(F.pmod(F.xxhash64("_row"), F.lit(max(1, texts.count() // max(1, sample)))) == 0)
    held = F.array_distinct(F.concat(*[_grams(F.col(c), GRAM, GRAM) for c in cols]))
    seen = some.select(F.explode(held).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = (long.join(seen, "gram", "left").groupBy("t")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at")).alias("best")))
    return (rarest.select(F.substring("t", F.col("best.at"), F.lit(SIGNATURE)).alias("sig"), "t")
            .unionByName(whole.select(F.col("t").alias("sig"), "t"))
            .select(F.substring("sig", 1, GRAM).alias("gram"), "sig", "t"))


def _flag_by_signature(df: DataFrame, text_cols: list[str], low: DataFrame, out: str,
                       max_bytes: int = C.MAX_BROADCAST_BYTES, sample: int = C.SIGNATURE_SAMPLE,
                       inline: int = C.MAX_INLINE_TERMS) -> DataFrame:
    """Each term is looked for by one part of it only, its signature. The stretches of a text meet
    the signatures by their first characters; where those are small (checked) they are broadcast
    and the test runs in the same task, so that no text moves and only row numbers come back.
    Beyond that size (row, hash of a gram) are shuffled, without the text, and the text is
    joined once to the (row, term) pairs that met. A short term met whole needs no further test.
    Rows and terms are written once, so that row numbers hold on both sides of the join back."""
    from riskfeed.plans.daily import materialize
    low = materialize(low)
    sure, rest = F.lit(False), low
    try:  # few short terms, which hardly tell texts apart, are tested at once
        short = literal_array(low.where(F.length("t") < GRAM), F.col("t"), inline)
        for c in text_cols:
            sure = sure | contains_any(F.col(c), short)
        rest = low.where(F.length("t") >= GRAM)
    except TooLarge:
        pass
    rows = materialize(df.withColumns({"_row": F.monotonically_increasing_id(), out: sure}))
    xs = [f"_x{i}" for i in range(len(text_cols))]
    texts = rows.where(~F.col(out)).select(
        "_row", *[F.lower(F.coalesce(c, F.lit(""))).alias(x) for c, x in zip(text_cols, xs)])
    sizes = rest.where("t <> ''").select(F.least(F.length("t"), F.lit(GRAM)).alias("n")).distinct()
    lengths = sorted(r["n"] for r in sizes.collect())  # GRAM values at most
    if not rest.where("t = ''").isEmpty():  # the empty term is in every text
        return rows.withColumn(out, F.lit(True)).drop("_row")
    if not lengths:
        return rows.drop("_row")

    sig = materialize(signatures(rest, texts, xs, sample))
    whole, holds = F.col("sig") == F.col("t"), F.lit(False)
    for x in xs:
        holds = holds | F.contains(x, "t")
    met = F.flatten(F.array(*[_stretches(F.col(x), n) for n in lengths for x in xs]))
    if bounded_bytes(sig, max_bytes) <= max_bytes:
        hits = (texts.select("_row", *xs, F.explode(met).alias("met")).select("_row", *xs, "met.gram", "met.next")
                .join(F.broadcast(sig), "gram").where(F.startswith("next", "sig") & (whole | holds)))
        hits = hits.select("_row").distinct()
    else:
        keyed = sig.withColumn("gram", F.xxhash64("gram"))
        grams = F.array_distinct(F.transform(met, lambda m: F.xxhash64(m["gram"])))
        pairs = texts.select("_row", F.explode(grams).alias("gram")).join(keyed, "gram").select("_row", "t").distinct()
        hits = texts.join(pairs, "_row").where(holds).select("_row").distinct()
    hits = hits.withColumn("_hit", F.lit(True))
    return (rows.join(hits, "_row", "left")
            .withColumn(out, F.col(out) | F.coalesce("_hit", F.lit(False))).drop("_row", "_hit"))


def membership_flags(df: DataFrame, key: Column, allow: DataFrame, block: DataFrame,
                     max_bytes: int = C.MAX_BROADCAST_BYTES) -> DataFrame:
    """JN4: ``_in_allow`` / ``_in_block`` flags by exact equality of ``key`` with
    the list entries (mark joins against distinct lists, broadcast when the
    lists are proven small)."""
    out = df.withColumn("_dom", key)
    for name, lst in (("_in_allow", allow), ("_in_block", block)):
        side = maybe_broadcast(lst.select(F.col("name").alias(name + "_k")).distinct()
                               .withColumn(name, F.lit(True)), max_bytes)
        out = (out.join(side, out["_dom"] == side[name + "_k"], "left")
               .drop(name + "_k")
               .withColumn(name, F.coalesce(F.col(name), F.lit(False))))
    return out


def quality_score(df: DataFrame, terms: DataFrame, allow: DataFrame, block: DataFrame,
                  title_col: str = "title", summary_col: str = "summary",
                  source_url_col: str = "source_url", match_col: str | None = None,
                  words_col: str | None = None,
                  clickbait_pattern: str = C.CLICKBAIT_PATTERN) -> DataFrame:
    """Adds ``score_*`` columns (funnel breakdown, NULL after an early exit) and
    ``quality_score``. ``match_col`` / ``words_col`` may carry a precomputed
    term-match flag / word count (e.g. computed once per page)."""
    flagged = membership_flags(df, X.score_domain(source_url_col), allow, block)
    dom = F.col("_dom")
    if match_col is None:
        flagged = term_flag(flagged, [title_col, summary_col], terms, "_term_match")
        match_col = "_term_match"
    match = F.col(match_col)
    wc = F.col(words_col) if words_col else X.word_count(summary_col)

    wl = F.when(F.col("_in_allow"), F.lit(C.WHITELIST_BONUS)).otherwise(F.lit(0))
    exit1 = F.col("_in_block") | ~X.ends_with_any(dom, C.SCORE_TLDS)
    bl = F.when(exit1, F.lit(C.BLACKLIST_PENALTY)).otherwise(F.lit(0))
    m = F.when(match, F.lit(1)).otherwise(F.lit(0))
    allowed = F.col("_in_allow")
    exit2 = (F.col("_m") == 0) & ~allowed
    dp = F.when(dom.rlike("[-0-9]"), F.lit(-1)).otherwise(F.lit(0))
    exit3 = (dp < 0) & ~allowed
    us = F.when(X.ends_with_any(dom, C.SCORE_TLDS), F.lit(1)).otherwise(F.lit(0))
    cb = F.when(F.lower(F.coalesce(F.col(title_col), F.lit(""))).rlike(clickbait_pattern),
                F.lit(-1)).otherwise(F.lit(0))
    exit4 = (cb < 0) & ~allowed
    l150 = F.when(wc > C.LENGTH_BONUS_WORDS[0], F.lit(1)).otherwise(F.lit(0))
    l500 = F.when(wc > C.LENGTH_BONUS_WORDS[1], F.lit(1)).otherwise(F.lit(0))

    stage = (F.when(exit1, 1).when(exit2, 2).when(exit3, 3).when(exit4, 4).otherwise(5))
    # the substring test runs only for rows past the block / TLD step
    out = flagged.withColumn("_m", F.when(~exit1, m)).withColumn("_stage", stage)
    st = F.col("_stage")

    def upto(level: int, value: Column) -> Column:
        return F.when(st >= level, value).cast("int")

    comps = {
        "score_whitelist_bonus": wl.cast("int"),
        "score_blacklist_non_us_penalty": bl.cast("int"),
        "score_search_term_matches": upto(2, F.col("_m")),
        "score_domain_penalty": upto(3, dp),
        "score_us_bonus": upto(4, us),
        "score_clickbait_penalty": upto(4, cb),
        "score_length_150": upto(5, l150),
        "score_length_500": upto(5, l500),
    }
    out = out.withColumns(comps)
    parts = [F.coalesce(F.col(k), F.lit(0)) for k in comps]
    total = F.when(st == 5, F.greatest(sum(parts[1:], parts[0]), F.lit(0))).otherwise(F.lit(0))
    out = out.withColumn("score_total_score", total.cast("int"))
    # no valid terms: scoring is skipped, every score column is NULL
    has_terms = terms.select(F.count(F.lit(1)) > 0).scalar()
    out = out.withColumns({k: F.when(has_terms, F.col(k)) for k in SCORE_COLUMNS})
    out = out.withColumn("quality_score", F.col("score_total_score"))
    return out.drop("_dom", "_in_allow", "_in_block", "_m", "_stage", "_term_match")


# --------------------------------------------------------------------------
# statistics (AG3-AG5)
# --------------------------------------------------------------------------

def score_stats(scored: DataFrame) -> DataFrame:
    """AG3: mean quality score (NULL ignored) and row counts."""
    return scored.agg(F.avg("quality_score").alias("mean_score"),
                      F.count("quality_score").alias("scored_rows"),
                      F.count(F.lit(1)).alias("total_rows"))


def score_histogram(scored: DataFrame) -> DataFrame:
    """AG4: rows per quality score."""
    return scored.groupBy("quality_score").agg(F.count(F.lit(1)).alias("n"))


def score_component_stats(scored: DataFrame) -> DataFrame:
    """AG5: per component (all but the total): mean ignoring NULL, the
    reference's non-zero count (NULL counts as non-zero) and the strict one."""
    comps = [c for c in SCORE_COLUMNS if c != "score_total_score"]
    long = scored.select(*comps).unpivot([], comps, "component", "value")
    return long.groupBy("component").agg(
        F.avg("value").alias("mean_value"),
        F.count_if(F.col("value").isNull() | (F.col("value") != 0)).alias("nonzero_ref"),
        F.count_if(F.col("value") != 0).alias("nonzero_strict"))
