"""Registered queries: one per operator of the inventory, each reading the
provided test tables (through :mod:`riskfeed.sources.binding`)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.functions import dates as D
from riskfeed.functions import terms as T
from riskfeed.functions import text as X
from riskfeed.operators import backfill as BF
from riskfeed.operators import digest as DG
from riskfeed.operators import enrich as E
from riskfeed.operators import gates as G
from riskfeed.operators import score as Q
from riskfeed.operators import sentiment as S
from riskfeed.operators import store as ST
from riskfeed.operators.common import maybe_broadcast, spread_for_cpu
from riskfeed.plans import daily
from riskfeed.sources import binding as B
from riskfeed.sources.lists import normalize_list
from riskfeed.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- shared views

def items(spark, sf) -> DataFrame:
    return G.normalize_items(B.raw_items(spark, sf))


def mention_view(spark, sf) -> DataFrame:
    """Every normalised item as a mention with its risk ids (JN1 fan-out)."""
    return ST.attach_risk_ids(items(spark, sf), B.dictionary(spark), "term")


def scored_pages(spark, sf) -> DataFrame:
    """Pages as mentions for the quality score: title, paragraph text, domain."""
    p = spread_for_cpu(read_table(spark, sf, "pages", "page_id", "url", "html"))
    m = p.select("page_id", X.page_title("html").alias("title"),
                 X.blank_short(X.page_text("html")).alias("summary"),
                 X.authority("url").alias("source_url"))
    terms = G.valid_terms(B.dictionary(spark))
    return Q.quality_score(m, terms, B.allow_list(spark), B.block_list(spark))


# ---------------------------------------------------------------- scalars (FN)

@query
def decode_terms(spark, sf):
    ev = spread_for_cpu(read_table(spark, sf, "events", "event_id", "event_type", "user_id"))
    enc = ev.select("event_id", "user_id",
                    F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("_t"))
    enc = enc.select("event_id", T.encode_term("_t").alias("encoded_terms"),
                     F.col("user_id").cast("string").alias("_uid"))
    return enc.select("event_id", "encoded_terms",
                      T.decode_term("encoded_terms").alias("search_terms"),
                      T.decode_term("_uid").alias("decoded_user_id"))


@query
def coerce_risk_id(spark, sf):
    ev = read_table(spark, sf, "events", "event_id", "value", "props")
    ev = ev.select("event_id", F.col("value").cast("string").alias("v"),
                   F.regexp_extract("props", r"(\d+)", 1).alias("k"), "props")
    return ev.select("event_id", T.to_int_or_null("v").alias("risk_id_from_value"),
                     T.to_int_or_null("k").alias("risk_id_from_k"),
                     T.to_int_or_null("props").alias("risk_id_from_props"))


@query
def normalize_item(spark, sf):
    return items(spark, sf).drop("source_site")


@query
def url_authority(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "url")
    return p.select("page_id", X.authority("url").alias("authority"))


@query
def score_domain(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "url")
    return p.select("page_id", X.score_domain("url").alias("domain_from_url"),
                    X.score_domain(X.authority("url")).alias("domain_from_authority"))


@query
def parse_pubdate(spark, sf):
    r = B.raw_items(spark, sf)
    return r.select("item_id", "pub_date_raw", D.parse_pubdate("pub_date_raw").alias("published_date"))


@query
def extract_source_site(spark, sf):
    r = B.raw_items(spark, sf)
    return r.select("item_id", X.source_site("source_element").alias("source_site"))


@query
def page_text(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", X.page_text("html").alias("text"))


@query
def page_text_backfill(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", X.page_text_backfill("html").alias("text"))


@query
def blank_short_text(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", X.blank_short("text").alias("summary"))


@query
def sentiment_compound(spark, sf):
    d = spread_for_cpu(read_table(spark, sf, "documents", "doc_id", "text"))
    return S.score_texts(d, "text", "doc_id", B.lexicon(spark)).select("doc_id", "compound")


@query
def sentiment_derived_lexicon(spark, sf):
    """SEN1 with a lexicon of over a thousand words, derived from the documents."""
    d = spread_for_cpu(read_table(spark, sf, "documents", "doc_id", "text"))
    return S.score_texts(d, "text", "doc_id", B.derived_lexicon(spark, sf)).select("doc_id", "compound")


@query
def sentiment_label(spark, sf):
    p = spread_for_cpu(B.pages(spark, sf)).select("page_id", X.blank_short(X.page_text("html")).alias("summary"))
    s = S.score_texts(p, "summary", "page_id", B.lexicon(spark), out_col="polarity")
    return s.select("page_id", "polarity", F.col("polarity_label").alias("sentiment"))


@query
def coerce_published_date(spark, sf):
    ev = read_table(spark, sf, "events", "event_id", "ts", "props")
    return ev.select("event_id", D.coerce_date(F.col("ts").cast("string")).alias("from_ts"),
                     D.coerce_date("props").alias("from_props"))


@query
def pick_column_filter(spark, sf):
    m = mention_view(spark, sf)
    dcol = DG.pick_column(m.columns, C.DATE_COLUMN_WORDS)
    tcol = DG.pick_column(m.columns, C.TEXT_COLUMN_WORDS)
    return m.select("item_id", "risk_id", F.col(dcol).alias("picked_date"), F.col(tcol).alias("picked_text"))


# ---------------------------------------------------------------- filters / gates

@query
def url_gates(spark, sf):
    return G.link_gates(items(spark, sf)).select("item_id", "link")


@query
def blocked_source_gate(spark, sf):
    it = items(spark, sf)
    blk = maybe_broadcast(B.block_list(spark).select(F.col("name").alias("_b")), C.MAX_BROADCAST_BYTES)
    return it.join(blk, it["source"] == blk["_b"], "left_anti").select("item_id", "source")


@query
def new_links_only(spark, sf):
    it = items(spark, sf)
    # the store: links of 'view' items collected before 2024-01-05
    stored = it.where((F.col("term") == "view") & (F.col("published_date") < F.lit("2024-01-05").cast("date")))
    return G.link_gates(it, None, G.existing_links(stored)).select("item_id", "link")


@query
def top_k_per_term(spark, sf):
    return G.top_k_per_term(items(spark, sf), C.MAX_ITEMS_PER_TERM).select("item_id", "term")


@query
def recent_mentions(spark, sf):
    return G.recent(items(spark, sf), B.AS_OF_DATE).select("item_id", "published_date")


@query
def cap_terms(spark, sf):
    terms = G.valid_terms(B.dictionary(spark), max_terms=3)
    it = G.restrict_to_terms(items(spark, sf), terms)
    return it.groupBy("term", "term_pos").agg(F.count(F.lit(1)).alias("n_items"))


@query
def window_split(spark, sf):
    return ST.window_flag(items(spark, sf), B.AS_OF, B.TEST_WINDOW_DAYS).select("item_id", "window")


@query
def last_four_weeks(spark, sf):
    return DG.last_four_weeks(mention_view(spark, sf), B.AS_OF, "published_date").select(
        "item_id", "risk_id", "published_date")


@query
def backfill_candidates(spark, sf):
    s = B.docs_store(spark, sf)
    return BF.candidates(s, *B.TEST_BACKFILL_RANGE).select("doc_id", "published_date")


@query
def backfill_batch(spark, sf):
    s = B.docs_store(spark, sf)
    return BF.batch_targets(s, *B.TEST_BACKFILL_RANGE).select("doc_id", "published_date")


# ---------------------------------------------------------------- joins

@query
def attach_risk_ids(spark, sf):
    return mention_view(spark, sf).select("item_id", "term", "risk_id", "search_term_id")


@query
def source_flags(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "url")
    f = Q.membership_flags(p, X.score_domain(X.authority("url")), B.allow_list(spark), B.block_list(spark))
    return f.select("page_id", F.col("_dom").alias("domain"), F.col("_in_allow").alias("in_allow"),
                    F.col("_in_block").alias("in_block"))


@query
def term_match_any(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return Q.term_flag(d, ["text"], G.valid_terms(B.dictionary(spark)), "term_match").select("doc_id", "term_match")


@query
def term_match_dictionary(spark, sf):
    """JN5 with a dictionary of distinct page words, on the path of large dictionaries."""
    d = spread_for_cpu(read_table(spark, sf, "documents", "doc_id", "text"))
    return Q.term_flag(d, ["text"], B.title_words(spark, sf), "term_match", bound=0).select("doc_id", "term_match")


def _gated_recent(spark, sf) -> DataFrame:
    it = G.link_gates(items(spark, sf), B.block_list(spark))
    return daily.materialize(G.recent(it, B.AS_OF_DATE))


@query
def enrich_mentions(spark, sf):
    it = _gated_recent(spark, sf)
    feats = E.page_features(E.pages_for_links(B.pages(spark, sf), it), B.lexicon(spark))
    return E.enrich(it, feats).select("item_id", "link", "summary", "sentiment", "polarity")


@query
def enrich_defaults(spark, sf):
    it = items(spark, sf)
    landed = B.pages(spark, sf).where(~F.col("link").contains(C.TRANSLATED_MARKER))
    feats = E.page_features(spread_for_cpu(landed), B.lexicon(spark))
    out = E.enrich(it, feats)
    return out.select("item_id", F.length("summary").alias("summary_chars"), F.md5("summary").alias("summary_md5"),
                      "sentiment", "polarity", F.size("keywords").alias("n_keywords"))


@query
def backfill_merge(spark, sf):
    s = B.docs_store(spark, sf)
    t = BF.batch_targets(s, *B.TEST_BACKFILL_RANGE)
    m = BF.merge(s, t, B.pages(spark, sf), B.lexicon(spark), B.AS_OF, key_cols=("doc_id",))
    return m.select("doc_id", "summary", "sentiment", "polarity", "last_run_timestamp", "backfilled")


# ---------------------------------------------------------------- aggregates

@query
def quality_score(spark, sf):
    return scored_pages(spark, sf).select("page_id", *Q.SCORE_COLUMNS, "quality_score")


@query
def quality_score_total(spark, sf):
    return scored_pages(spark, sf).select("page_id", "quality_score")


@query
def score_stats(spark, sf):
    return Q.score_stats(scored_pages(spark, sf))


@query
def score_histogram(spark, sf):
    return Q.score_histogram(scored_pages(spark, sf))


@query
def score_component_stats(spark, sf):
    return Q.score_component_stats(scored_pages(spark, sf))


@query
def sentiment_mix(spark, sf):
    m = mention_view(spark, sf)
    feats = E.page_features(spread_for_cpu(B.pages(spark, sf)), B.lexicon(spark))
    e = E.enrich(m, feats)
    return e.groupBy("risk_id", "published_date", "sentiment").agg(F.count(F.lit(1)).alias("n"))


@query
def risk_digest(spark, sf):
    m = DG.last_four_weeks(mention_view(spark, sf), B.AS_OF, "published_date")
    return DG.risk_digest(m, "risk_id", "title")


@query
def risk_prompt(spark, sf):
    m = DG.last_four_weeks(mention_view(spark, sf), B.AS_OF, "published_date")
    return DG.risk_prompt(DG.risk_digest(m, "risk_id", "title")).select(
        "risk_id", "article_count", "prompt")


@query
def risk_brief(spark, sf):
    """UD3: a Python function per risk over its three newest mentions; it fails for one risk."""
    from riskfeed.operators import hooks

    def brief(risk_id, rows, n_rows):
        if risk_id == B.FAILING_RISK:
            raise ValueError("no brief")
        return f"{n_rows} mentions: " + "; ".join(f"{r['title']} ({r['source']})" for r in rows)

    m = DG.last_four_weeks(mention_view(spark, sf), B.AS_OF, "published_date")
    order = [*DG.newest_first(m), F.col("item_id")]
    return hooks.apply_group_hook(m, brief, "risk_id", 3, ["title", "source"], order, "brief",
                                  "Error for Risk ID {key}: {error}")


@query
def risk_narrative(spark, sf):
    """UD4: a Python function per prompt row, its failure captured as a value."""
    from riskfeed.operators import hooks

    def generate(prompt):
        lines = prompt.split("\n")
        if f"EMERGING RISK ID: {B.FAILING_RISK}" in prompt:
            raise ValueError("no answer")
        return f"{len(lines)} lines"

    return hooks.narrate(risk_prompt(spark, sf), generate).select("risk_id", "article_count", "narrative")


@query
def landed_pages(spark, sf):
    """SRC4: the pages landed without their number, read back under their normalised links."""
    from riskfeed.sources.feed import read_pages
    root = _scratch(spark, "pages")
    read_table(spark, sf, "pages", "url", "html").write.parquet(root)
    return read_pages(spark, root).select("link", F.md5("html").alias("html_md5"))


@query
def source_list_normalize(spark, sf):
    names = B.raw_items(spark, sf).select(F.col("source_name").alias("name"))
    return normalize_list(names.unionByName(B.name_list(spark, B.TEST_BLOCK_LIST)))


# ---------------------------------------------------------------- store

def _stored_and_new(spark, sf):
    stored = B.docs_store(spark, sf).select("title", "link", "published_date", "summary",
                                            F.col("doc_id").alias("stored_id"))
    new = items(spark, sf).select("title", "link", "published_date", "item_id", "feed_pos")
    return stored, new


@query
def combine_mentions(spark, sf):
    stored, new = _stored_and_new(spark, sf)
    return ST.combine(stored, new).select("_batch", "title", "link", "published_date", "stored_id", "item_id")


@query
def dedupe_keep_first(spark, sf):
    it = items(spark, sf)
    dup = it.unionByName(it.withColumn("item_id", F.col("item_id") + 1_000_000))
    c = ST.combine(B.docs_store(spark, sf).select("title", "link", "published_date",
                                                  F.col("doc_id").alias("stored_id")),
                   dup.select("title", "link", "published_date", "term", "feed_pos", "item_id"))
    d = ST.dedupe_keep_first(c, ST.DEDUPE_KEYS, ["_batch", "feed_pos", "item_id", "stored_id"])
    return d.select("title", "link", "published_date", "_batch", "stored_id", "item_id")


@query
def mentions_newest_first(spark, sf):
    return ST.newest_first(items(spark, sf).select("published_date", "link", "title", "item_id"))


def _daily(spark, sf):
    raw, dic, pg = B.raw_items(spark, sf), B.dictionary(spark), B.pages(spark, sf)
    blk, alw, lex = B.block_list(spark), B.allow_list(spark), B.lexicon(spark)
    p1 = daily.DailyParams(as_of=B.EARLIER_AS_OF, window_days=B.TEST_WINDOW_DAYS)
    first, _ = daily.run(raw, dic, pg, blk, alw, lex, None, p1)
    # day 1 publishes its store; day 2 reads the live version back (the real flow)
    from riskfeed import sinks
    root = _scratch(spark, "daily-store")
    sinks.write_current(first, root)
    first = sinks.read_current(spark, root)
    p2 = daily.DailyParams(as_of=B.AS_OF, window_days=B.TEST_WINDOW_DAYS)
    return daily.run(raw, dic, pg, blk, alw, lex, first, p2)


@query
def daily_mentions(spark, sf):
    current, _ = _daily(spark, sf)
    # the keyword array is always empty; report its size (no array in the check output)
    return current.withColumn("n_keywords", F.size("keywords")).drop("keywords")


@query
def export_projection(spark, sf):
    current, _ = _daily(spark, sf)
    return ST.export_projection(current)


@query
def run_audit(spark, sf):
    """AG8 + AG9: run audit counts, with the documents as the store. All item-level counts
    come from one aggregation pass (the block list is a broadcast mark join), the store's
    from one over the store; new rows are gated items whose link the store lacks."""
    dic = B.dictionary(spark)
    it = items(spark, sf)
    blk = maybe_broadcast(B.block_list(spark).select(F.col("name").alias("_b"), F.lit(True).alias("_blocked")),
                          C.MAX_BROADCAST_BYTES)
    store = B.docs_store(spark, sf)
    seen = G.existing_links(store).select(F.col("link").alias("_l"), F.lit(True).alias("_seen"))
    marked = it.join(blk, it["source"] == blk["_b"], "left").join(seen, it["link"] == seen["_l"], "left")
    in_window = ST.window_flag(store, B.AS_OF, B.TEST_WINDOW_DAYS)
    stored = in_window.agg(F.count(F.lit(1)).alias("stored_rows"), F.count_distinct("link").alias("existing_links"),
                           F.count_if(F.col("window") == "current").alias("stored_current_rows"))
    upd = BF.merge(store, BF.batch_targets(store, *B.TEST_BACKFILL_RANGE), B.pages(spark, sf), B.lexicon(spark),
                   B.AS_OF, key_cols=("doc_id",)).agg(F.count_if("backfilled").alias("updated_rows"))
    landed = B.raw_items(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    dom = F.lower(X.authority(F.col("link")))
    passes = (F.col("link").isNotNull() & X.ends_with_any(dom, C.LINK_TLDS)
              & ~F.col("link").contains(C.TRANSLATED_MARKER) & F.col("_blocked").isNull())
    return marked.agg(
        F.count(F.lit(1)).alias("items_found"),
        F.count_if(passes).alias("items_after_gates"),
        F.count_if(F.col("published_date").isNull()).alias("null_dates"),
        F.count_distinct("link").alias("distinct_links"),
        F.count_if(passes & F.col("_seen").isNull()).alias("new_rows"),
    ).select(
        landed.scalar().alias("items_landed"),
        (landed.scalar() - F.col("items_found")).alias("items_dropped"),
        *[stored.select(c).scalar().alias(c) for c in ("stored_rows", "existing_links", "stored_current_rows")],
        (stored.select("stored_rows").scalar() + F.col("new_rows")).alias("combined_rows"),
        upd.scalar().alias("updated_rows"), "new_rows",
        dic.select(F.count(F.lit(1))).scalar().alias("loaded_terms"),
        dic.where(F.col("search_terms").isNotNull()).select(F.count(F.lit(1))).scalar().alias("valid_terms"),
        "items_found", "items_after_gates", "null_dates", "distinct_links")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


# ---------------------------------------------------------------- files / streams

def _scratch(spark, name: str) -> str:
    import uuid
    from riskfeed.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


@query
def mentions_scan(spark, sf):
    """SNK1 + SRC5: write the docs store as a versioned, date-partitioned
    Parquet store, then scan the live version back."""
    from riskfeed import sinks
    root = _scratch(spark, "store")
    sinks.write_current(B.docs_store(spark, sf), root)
    back = sinks.read_current(spark, root)
    return back.select("doc_id", "link", "published_date", "summary")


@query
def feed_items(spark, sf):
    """SRC3: land the derived items as RSS XML files (term / result page
    directories) whose links lead through the feed's own host, read them back with the
    table of what each link led to, and normalise."""
    from riskfeed.sources.feed import read_feed, write_feed
    root = _scratch(spark, "feed")
    raw = B.raw_items(spark, sf).withColumn("_url", F.col("feed_link"))
    raw = raw.withColumn("feed_link", F.concat(F.lit(B.FEED_HOST + "/r/"), F.md5("_url")))
    led = raw.select("feed_link", F.col("_url").alias("resolved_link"),
                     F.when(F.length("_url") % 7 == 0, 404).otherwise(200).alias("status")).distinct()
    write_feed(raw, root)
    return G.normalize_items(read_feed(spark, root, led)).select(
        "term", "result_page", "feed_pos", "title", "link", "source", "source_url", "published_date", "source_site")


@query
def feed_quarantine(spark, sf):
    """SRC3: the derived items landed, each term's first page also cut off in the middle; per term the
    items read and the files that could not be."""
    from riskfeed.sources.feed import Feed, landed_lines, read_feed, unreadable_files, write_feed
    root = _scratch(spark, "feed-broken")
    write_feed(B.raw_items(spark, sf), f"{root}/whole")
    term = F.regexp_extract("path", "/term=([^/]*)/", 1).alias("term")
    # line by line: a page may be too large for one row
    lines = landed_lines(spark, f"{root}/whole").where(F.contains("path", F.lit("/result_page=1/")))
    page = Window.partitionBy("path")
    stop = F.sum(F.length("value") + 1).over(page.orderBy("start", "at").rowsBetween(Window.unboundedPreceding, 0))
    half = F.expr("(sum(length(value) + 1) OVER (PARTITION BY path) - 1) DIV 2")
    lines = lines.select("path", "start", "at", "value", stop.alias("stop"), half.alias("half"))
    kept = lines.where(F.col("stop") - F.length("value") - 1 < F.col("half"))
    value = F.expr("substr(value, 1, cast(half - (stop - length(value) - 1) AS int))").alias("value")
    first = kept.select(term, F.lit(99).alias("result_page"), "path", "start", "at", value)
    (first.repartition("term", "result_page", "path").sortWithinPartitions("term", "result_page", "path", "start", "at")
     .drop("path", "start", "at").write.partitionBy("term", "result_page").text(f"{root}/cut"))
    feed = Feed(spark, root)
    items = read_feed(spark, feed).groupBy("term").agg(F.count(F.lit(1)).alias("items"))
    broken = unreadable_files(feed).groupBy(term).agg(F.count(F.lit(1)).alias("unreadable"))
    return items.join(broken, "term", "left").select("term", "items", F.coalesce("unreadable", F.lit(0)).alias("unreadable"))


@query
def csv_store(spark, sf):
    """SRC5 + FN14 + FN16 + FN17: items as mentions with small polarities and unreadable dates,
    written as the published CSV file and read back."""
    from riskfeed.sources.feed import read_mentions
    path = _scratch(spark, "csv-store")
    m = mention_view(spark, sf).select(
        "risk_id", "search_term_id", "title", F.concat(F.lit('said "'), "title", F.lit('",\nthen more')).alias("summary"),
        F.array().cast("array<string>").alias("keywords"),
        F.when(F.col("item_id") % 11 == 0, F.lit("soon")).otherwise(F.col("published_date").cast("string")).alias("published_date"),
        "link", "source", "source_url", F.lit("neutral").alias("sentiment"),
        ((F.col("item_id") % 21 - 10) / 10000).alias("polarity"),
        F.lit(B.AS_OF).cast("timestamp_ntz").alias("last_run_timestamp"), F.col("item_id").cast("int").alias("quality_score"))
    (ST.published_columns(ST.export_projection(m), "emerging")
     .write.option("header", True).option("quote", '"').option("escape", '"').csv(path))
    back = read_mentions(spark, path, "csv", "emerging")
    return back.select(F.col("quality_score").alias("item_id"), "risk_id", "search_term_id", "title", "summary",
                       "published_date", "link", "source", "polarity", ST.polarity_text().alias("polarity_text"),
                       "last_run_timestamp")


@query
def archive_rows(spark, sf):
    """SNK2: documents that left the window, archived twice under one run, read back."""
    from riskfeed import sinks
    root = _scratch(spark, "archive")
    _, old = ST.window_split(B.docs_store(spark, sf), B.AS_OF, B.TEST_WINDOW_DAYS)
    for _ in range(2):  # a run that is repeated replaces its rows
        sinks.write_archive(old, root, B.AS_OF)
    return sinks.read_archive(spark, root).select("doc_id", "link", "published_date", "summary")


@query
def backfill_publish(spark, sf):
    """SNK3: the backfilled documents published as a store version, read back."""
    from riskfeed import sinks
    root = _scratch(spark, "backfill")
    s = B.docs_store(spark, sf)
    sinks.write_current(s, root)
    t = BF.batch_targets(s, *B.TEST_BACKFILL_RANGE)
    merged = daily.materialize(BF.merge(s, t, B.pages(spark, sf), B.lexicon(spark), B.AS_OF, key_cols=("doc_id",)))
    sinks.publish_backfill(merged, root)
    return sinks.read_current(spark, root).select("doc_id", "summary", "sentiment", "polarity", "last_run_timestamp")


@query
def narrative_history(spark, sf):
    """SNK4: the prompt rows of two runs, the second one repeated, read back."""
    from riskfeed import sinks
    root = _scratch(spark, "narratives")
    rows = daily.materialize(risk_prompt(spark, sf))
    for run in (B.EARLIER_AS_OF, B.AS_OF, B.AS_OF):
        sinks.write_narratives(rows, root, run)
    return spark.read.parquet(f"{root}/history").select("risk_id", "article_count", "prompt", "generated_at")


@query
def stream_ingest(spark, sf):
    """STR1: two feed drops (events before / from 2024-01-15) ingested by two
    availableNow runs of one streaming query; returns the ingested store."""
    from riskfeed.sources.feed import write_feed
    from riskfeed.streaming.ingest import ingest_stream, read_store
    base = _scratch(spark, "stream")
    # written once with their day: a filter on the text would move below the spread of the events,
    # into the few tasks that scan them, and once a drop
    raw = daily.materialize(B.raw_items(spark, sf).withColumn("_day", D.parse_pubdate("pub_date_raw")))
    day, cut = F.col("_day"), F.lit("2024-01-15").cast("date")
    drops = [raw.where(day.isNull() | (day < cut)), raw.where(day >= cut)]
    for i, drop in enumerate(drops):
        write_feed(drop, f"{base}/landing/drop={i}", mode="overwrite")
        q = ingest_stream(spark, f"{base}/landing", f"{base}/store", f"{base}/ckpt", B.block_list(spark))
        q.awaitTermination()
    return read_store(spark, f"{base}/store").select("title", "link", "published_date", "term", "source")


@query
def term_dictionary(spark, sf):
    """SRC1 + FN1 + FN2: a dictionary CSV in the shipped format (header
    ENTERPRISE_RISK_ID, SEARCH_TERM_ID, ENCODED_TERMS), derived from events
    (one term per distinct user), written by Spark, read back and decoded."""
    from riskfeed.sources.lists import decode_dictionary, read_terms
    users = read_table(spark, sf, "events", "user_id").distinct()
    rows = users.select(
        (F.col("user_id") % 10).cast("string").alias("ENTERPRISE_RISK_ID"),
        F.col("user_id").cast("string").alias("SEARCH_TERM_ID"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("_t"))
    rows = rows.select("ENTERPRISE_RISK_ID", "SEARCH_TERM_ID", T.encode_term("_t").alias("ENCODED_TERMS"))
    path = _scratch(spark, "terms-csv")
    rows.write.mode("overwrite").option("header", True).csv(path)
    d = decode_dictionary(read_terms(spark, path, "enterprise"))
    return d.select("risk_id", "search_term_id", "search_terms")
