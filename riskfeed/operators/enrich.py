"""JN6 enrichment: page text, sentiment and per-page score inputs, computed
once per distinct link and joined back to the items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.functions import text as X
from riskfeed.operators import sentiment as S
from riskfeed.operators.score import term_flag


def pages_for_links(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Pages of the surviving links only: a semi join, which the planner runs as
    a broadcast (map-side) join when the link set is small at run time."""
    return pages.join(links.select("link").distinct(), "link", "left_semi")


def one_per_link(rows: DataFrame, *order: str) -> DataFrame:
    """The first row of each link; each task drops the others before the shuffle."""
    w = Window.partitionBy("link").orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def page_features(pages: DataFrame, lex: S.Lexicon, terms: DataFrame | None = None,
                  min_chars: int = C.MIN_ARTICLE_CHARS) -> DataFrame:
    """(page_id, link, html) -> one row per link: (link, summary, polarity,
    sentiment[, summary_match, summary_words]).

    summary = paragraph text, blanked when shorter than ``min_chars``; the
    compound score and label are computed on that text. Everything is computed
    map-side on the page rows; one page per link stays (lowest page id, then by content),
    and only the columns that the caller goes on to use are shuffled for that, never the raw
    HTML."""
    feats = pages.select("page_id", "link",
                         X.blank_short(X.page_text("html"), min_chars).alias("summary"))
    feats = feats.withColumn("_tie", F.xxhash64("summary"))
    feats = S.score_texts(feats, "summary", "page_id", lex, out_col="polarity")
    feats = feats.withColumnRenamed("polarity_label", "sentiment")
    cols = ["summary", "polarity", "sentiment"]
    if terms is not None:
        feats = term_flag(feats, ["summary"], terms, "summary_match")
        feats = feats.withColumn("summary_words", X.word_count("summary"))
        cols += ["summary_match", "summary_words"]
    return one_per_link(feats, "page_id", "_tie").select("link", *cols)


def enrich(items: DataFrame, features: DataFrame) -> DataFrame:
    """Left join by link; a missing page gives the defaults ('' / [] / neutral / 0.0)."""
    out = items.join(features, "link", "left")
    cols = {
        "summary": F.coalesce("summary", F.lit("")),
        "keywords": F.array().cast("array<string>"),
        "sentiment": F.coalesce("sentiment", F.lit(C.DEFAULT_SENTIMENT)),
        "polarity": F.coalesce("polarity", F.lit(C.DEFAULT_POLARITY)),
    }
    if "summary_match" in features.columns:
        cols["summary_match"] = F.coalesce("summary_match", F.lit(False))
        cols["summary_words"] = F.coalesce("summary_words", F.lit(0))
    out = out.withColumns(cols)
    return out
