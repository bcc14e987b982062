"""Backfill of missing article text: candidates, 3-day batch, keyed merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.functions import text as X
from riskfeed.operators import sentiment as S
from riskfeed.operators.enrich import one_per_link


def is_missing(summary: Column, min_chars: int = C.BACKFILL_MISSING_CHARS) -> Column:
    """Summary NULL, blank after strip, or shorter than ``min_chars``."""
    return (summary.isNull() | (X.strip_ws(summary) == "")
            | (F.coalesce(F.length(summary), F.lit(0)) < min_chars))


def candidates(store: DataFrame, start: str, end: str,
               min_chars: int = C.BACKFILL_MISSING_CHARS) -> DataFrame:
    """FLT6: dated inside [start, end] (closed) and missing text."""
    d = F.col("published_date")
    return store.where(d.isNotNull() & (d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date"))
                       & is_missing(F.col("summary"), min_chars))


def batch_targets(store: DataFrame, start: str, end: str, days: int = C.BACKFILL_BATCH_DAYS,
                  min_chars: int = C.BACKFILL_MISSING_CHARS) -> DataFrame:
    """AG6 + FLT7: latest candidate date L; targets are rows with missing text
    dated in [L - days + 1, L] (may begin before the range start)."""
    latest = candidates(store, start, end, min_chars).select(F.max("published_date")).scalar()
    d = F.col("published_date")
    return store.where(d.isNotNull() & (d <= latest) & (d >= F.date_sub(latest, days - 1))
                       & is_missing(F.col("summary"), min_chars))


def batch_first_day(latest, days: int = C.BACKFILL_BATCH_DAYS):
    """First calendar day of the batch ending on ``latest`` (a date value)."""
    import datetime as dt
    return latest - dt.timedelta(days=days - 1)


def merge(store: DataFrame, targets: DataFrame, pages: DataFrame, lex: S.Lexicon, as_of: str,
          key_cols=("title", "link", "published_date"),
          usable_chars: int = C.BACKFILL_USABLE_CHARS) -> DataFrame:
    """JN7: for target rows whose page yields >= ``usable_chars`` characters of
    text, replace summary, sentiment, polarity and run stamp; every other row
    is unchanged. Only the target rows and their pages are processed."""
    tp = targets.select(*key_cols, "link").distinct() if "link" not in key_cols \
        else targets.select(*key_cols)
    # the <= batch_days of target rows are read twice (page selection, update
    # join): materialise them once
    from riskfeed.plans.daily import materialize
    tp = materialize(tp)
    # text per page map-side, then one page per link (lowest id): only the
    # extracted text is shuffled, never the raw HTML
    texts = (pages.join(tp.select("link").distinct(), "link", "left_semi")
             .select("link", "page_id", X.page_text_backfill("html").alias("_new")))
    texts = one_per_link(texts.withColumn("_tie", F.xxhash64("_new")), "page_id", "_tie").select("link", "_new")
    texts = texts.where(F.length("_new") >= usable_chars)
    texts = S.score_texts(texts, "_new", "link", lex, out_col="_pol")
    upd = tp.join(texts, "link", "inner").select(
        *[F.col(k).alias(f"_k_{k}") for k in key_cols], "_new", "_pol", "_pol_label")
    # row key match with NULL = NULL (a stored title may be NULL)
    cond = None
    for k in key_cols:
        c = store[k].eqNullSafe(upd[f"_k_{k}"])
        cond = c if cond is None else cond & c
    out = store.join(upd, cond, "left").drop(*[f"_k_{k}" for k in key_cols])
    hit = F.col("_new").isNotNull()
    out = (out.withColumn("summary", F.when(hit, F.col("_new")).otherwise(F.col("summary")))
           .withColumn("sentiment", F.when(hit, F.col("_pol_label")).otherwise(F.col("sentiment")))
           .withColumn("polarity", F.when(hit, F.col("_pol")).otherwise(F.col("polarity")))
           .withColumn("last_run_timestamp", F.when(hit, F.lit(as_of).cast("timestamp_ntz"))
                       .otherwise(F.col("last_run_timestamp").cast("timestamp_ntz")))
           .withColumn("backfilled", hit))
    return out.drop("_new", "_pol", "_pol_label")
