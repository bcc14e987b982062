"""Binding of the provided test tables to the engine's inputs.

The test tables hold no news feed, so the feed, the page store and the
mention store are *derived* from them (every event is a collected feed item
pointing at a landed page; every document is a stored mention):

* items: ``events`` x ``pages`` (page = event_id mod page count), term = event
  type, title = page <title>, link = page url, source = a display name from the
  user id, feed date = RFC-822 text of the event time (odd users in -0500).
* pages: ``pages`` keyed by their normalised url.
* docs store: ``documents`` as stored mentions dated 2024-01-01 + doc_id mod 30, the text of every
  seventh one missing (what the backfill works on grows with the table).

Small dimensions (term dictionary, allow / block lists, lexicon) are fixed
test values below, like the shipped dictionary files of the reproduced jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeed.functions import terms as T
from riskfeed.functions import text as X
from riskfeed.operators.common import spread_for_cpu
from riskfeed.operators.sentiment import Lexicon
from riskfeed.sources.tables import read_table

# --------------------------------------------------------------------------
# Fixed test values
# --------------------------------------------------------------------------

AS_OF = "2024-01-31 00:00:00"
AS_OF_DATE = "2024-01-31"
EARLIER_AS_OF = "2024-01-20 00:00:00"     # first of two daily runs
EARLIER_AS_OF_DATE = "2024-01-20"
TEST_WINDOW_DAYS = 14
TEST_ITEMS_PER_TERM = 500
BLANK_EVERY = 7                           # stored documents whose text is missing
FAILING_RISK = 2                          # the hooks' functions fail for it
TEST_BACKFILL_RANGE = ("2024-01-05", "2024-01-20")

# (risk_id, search_term_id, term text, raw encoded value or None = encode the text)
TEST_DICTIONARY = (
    (1, 1, "click", None),
    (1, 2, "error", None),
    (2, 3, "purchase", None),
    (2, 4, "signup", None),
    (3, 5, "view", None),
    (4, 6, "thand", None),
    (4, 7, "quele", None),
    (5, 8, "tion", None),
    (5, 9, "that", None),
    (3, 10, "click", None),
    (6, 11, None, "65279"),
    (6, 12, None, "abc"),
)
TEST_BLOCK_LIST = (
    " SRC3 ", "src13", "www.cheap-pills.example.com", "m.casino-win.example.com",
    "free-bets.example.com", "tionble.example.org",
)
TEST_ALLOW_LIST = (
    "spam-farm.example.org", "m.ads-track.example.com", "tionble.example.org",
    "blog.tionsh.example.com", "ththan.example.com",
)
TEST_VALENCES = (
    ("that", 1.5), ("with", -1.2), ("der", 0.8), ("que", -0.6), ("the", 0.4),
    ("und", -0.9), ("les", 1.1), ("and", -0.3), ("risk", -1.8), ("gain", 2.1),
)
TEST_BOOSTERS = (("was", 0.293), ("is", 0.293), ("very", 0.293))
TEST_NEGATIONS = ("no", "nicht", "pas", "not")
TEST_CONTRASTS = ("for",)


def dictionary(spark: SparkSession) -> DataFrame:
    """Encoded term dictionary (risk_id, search_term_id, encoded_terms) + decoded
    ``search_terms`` (FN1 applied)."""
    rows = [(r, s, t, e) for r, s, t, e in TEST_DICTIONARY]
    df = spark.createDataFrame(rows, "risk_id int, search_term_id int, plain string, raw string")
    enc = df.select("risk_id", "search_term_id",
                    F.coalesce(F.col("raw"), T.encode_term("plain")).alias("encoded_terms"))
    return enc.withColumn("search_terms", T.decode_term("encoded_terms"))


def name_list(spark: SparkSession, values) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "name string")


def block_list(spark: SparkSession) -> DataFrame:
    from riskfeed.sources.lists import normalize_list
    return normalize_list(name_list(spark, TEST_BLOCK_LIST))


def allow_list(spark: SparkSession) -> DataFrame:
    from riskfeed.sources.lists import normalize_list
    return normalize_list(name_list(spark, TEST_ALLOW_LIST))


def lexicon(spark: SparkSession) -> Lexicon:
    return Lexicon(
        spark.createDataFrame(list(TEST_VALENCES), "token string, valence double"),
        spark.createDataFrame(list(TEST_BOOSTERS), "token string, weight double"),
        spark.createDataFrame([(t,) for t in TEST_NEGATIONS], "token string"),
        spark.createDataFrame([(t,) for t in TEST_CONTRASTS], "token string"),
    )


FEED_HOST = "https://feeds.example.net"


def derived_lexicon(spark: SparkSession, sf_dir: str) -> Lexicon:
    """Every four-letter word of the documents with a valence from its letters."""
    d = read_table(spark, sf_dir, "documents", "text")
    w = d.select(F.explode(F.regexp_extract_all("text", F.lit(r"\b([a-z]{4})\b"), 1)).alias("token")).distinct()
    mark = F.ascii(F.substring("token", 1, 1)) * 7 + F.ascii(F.substring("token", 3, 1)) * 5 + F.ascii(F.substring("token", 4, 1))
    base = lexicon(spark)
    return Lexicon(w.select("token", ((mark % 9 - 4) / 2).alias("valence")), base.boosters, base.negations, base.contrasts)


def title_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of the distinct words of page titles: search_terms, term_pos."""
    p = read_table(spark, sf_dir, "pages", "html").select(X.page_title("html").alias("title"))
    w = p.select(F.explode(F.split("title", " ")).alias("search_terms")).where("search_terms <> ''").distinct()
    return w.withColumn("term_pos", F.lit(1))


# --------------------------------------------------------------------------
# Derived feed, pages and stores
# --------------------------------------------------------------------------

def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages keyed by normalised link: (page_id, link, html)."""
    p = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return p.select("page_id", X.normalize_name("url").alias("link"), "html")


def _page_of(spark: SparkSession, sf_dir: str, id_col: str) -> DataFrame:
    """Page id for a row id: id mod page count (a scalar subquery, no join)."""
    n = read_table(spark, sf_dir, "pages", "page_id").select(F.count(F.lit(1))).scalar()
    return F.col(id_col) % n


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed feed items as collected: raw text fields, one row per event."""
    ev = spread_for_cpu(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value"))
    ev = ev.withColumn("page_id", _page_of(spark, sf_dir, "event_id"))
    pl = read_table(spark, sf_dir, "pages", "page_id", "url", "html").select(
        "page_id", F.col("url").alias("feed_link"), X.page_title("html").alias("title"))
    j = ev.join(pl, "page_id")
    source_name = F.concat(F.lit(" Src"), (F.col("user_id") % 20).cast("string"), F.lit(" "))
    fmt = "EEE, dd MMM yyyy HH:mm:ss"
    pub = (F.when(F.col("value") < 1, F.lit("not a date"))
           .when(F.col("user_id") % 2 == 1,
                 F.concat(F.date_format(F.col("ts") - F.expr("INTERVAL 5 HOURS"), fmt), F.lit(" -0500")))
           .otherwise(F.concat(F.date_format("ts", fmt), F.lit(" GMT"))))
    return j.select(
        F.col("event_type").alias("term"),
        (F.floor(((F.col("event_id") * 7919) % 10007) / 1000) + 1).cast("int").alias("result_page"),
        ((F.col("event_id") * 7919) % 10007).alias("feed_pos"),
        F.col("event_id").alias("item_id"),
        "title", "feed_link",
        F.col("feed_link").alias("resolved_link"),
        source_name.alias("source_name"),
        pub.alias("pub_date_raw"),
        F.concat(F.lit('<source url="https://'), X.authority("feed_link"), F.lit('">'),
                 source_name, F.lit("</source>")).alias("source_element"),
    )


def docs_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a stored mention table (row key doc_id)."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    d = d.withColumn("page_id", _page_of(spark, sf_dir, "doc_id"))
    pl = pages(spark, sf_dir).select("page_id", "link")
    return d.join(pl, "page_id").select(
        "doc_id",
        F.lit(None).cast("string").alias("title"),
        "link",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("published_date"),
        F.when(F.col("doc_id") % BLANK_EVERY != 0, F.col("text")).alias("summary"),
        F.lit(None).cast("string").alias("sentiment"),
        F.lit(None).cast("double").alias("polarity"),
        F.lit(None).cast("timestamp_ntz").alias("last_run_timestamp"),
    )
