"""Item normalisation and the collection gates: term cap, link gates, source
block list, seen-link anti join, top-k per term, recency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.functions import dates as D
from riskfeed.functions import text as X
from riskfeed.operators.common import maybe_broadcast


def valid_terms(dictionary: DataFrame, max_terms: int | None = None) -> DataFrame:
    """FLT1 (+ LM1 with ``max_terms``): decodable terms, only the first ``max_terms`` in
    dictionary (id) order where a cap is asked for, one row per distinct term with its first
    position ``term_pos``."""
    ok = dictionary.where(F.col("search_terms").isNotNull())
    if max_terms is not None:
        ok = ok.orderBy(F.col("search_term_id").asc_nulls_last()).limit(max_terms)
    return (ok.groupBy("search_terms")
            .agg(F.min("search_term_id").alias("term_pos")))


def normalize_items(raw: DataFrame) -> DataFrame:
    """FN3, FN4, FN6, FN7 on landed feed items.

    Input columns: term, result_page, feed_pos, item_id, title, feed_link,
    resolved_link, source_name, pub_date_raw[, source_element].
    Items without title, feed link or source are dropped (the reference raises).
    """
    out = raw.where(F.col("title").isNotNull() & F.col("feed_link").isNotNull()
                    & F.col("source_name").isNotNull())
    cols = [
        "term", "result_page", "feed_pos", "item_id",
        X.strip_ws("title").alias("title"),
        X.normalize_name("resolved_link").alias("link"),
        X.normalize_name("source_name").alias("source"),
        X.authority(X.strip_ws("feed_link")).alias("source_url"),
        D.parse_pubdate("pub_date_raw").alias("published_date"),
    ]
    if "source_element" in raw.columns:
        cols.append(X.source_site("source_element").alias("source_site"))
    return out.select(*cols)


def link_gates(items: DataFrame, block_list: DataFrame | None = None,
               existing_links: DataFrame | None = None) -> DataFrame:
    """FLT2-4, JN3, JN2 in the reference order (cheap filters first).

    * link resolved (not NULL)
    * authority of the link ends with .com/.edu/.org/.net
    * source (lowered, stripped) not in the block list  -> broadcast anti join
    * no translated-page marker in the link
    * link not already stored                            -> anti join (AQE picks)
    """
    dom = F.lower(X.authority(F.col("link")))
    out = items.where(F.col("link").isNotNull() & X.ends_with_any(dom, C.LINK_TLDS)
                      & ~F.col("link").contains(C.TRANSLATED_MARKER))
    if block_list is not None:
        blk = maybe_broadcast(block_list.select(F.col("name").alias("_blk")).distinct(),
                              C.MAX_BROADCAST_BYTES)
        out = out.join(blk, out["source"] == blk["_blk"], "left_anti")
    if existing_links is not None:
        seen = existing_links.select(F.col("link").alias("_seen")).distinct()
        out = out.join(seen, out["link"] == seen["_seen"], "left_anti")
    return out


def existing_links(store: DataFrame) -> DataFrame:
    """SRC6: stored links lowered + stripped, distinct (pruned one-column scan)."""
    return (store.select(X.normalize_name("link").alias("link"))
            .where(F.col("link").isNotNull()).distinct())


def top_k_per_term(items: DataFrame, k: int = C.MAX_ITEMS_PER_TERM) -> DataFrame:
    """WN1: at most ``k`` surviving items per term in result-page then feed order.

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before the
    shuffle, so a hot term ships at most k rows per map task.
    """
    w = Window.partitionBy("term").orderBy("result_page", "feed_pos", "item_id")
    return (items.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= k).drop("_rn"))


def recent(items: DataFrame, as_of_date: str, days: int = C.RECENCY_DAYS) -> DataFrame:
    """FLT5: published on or after ``as_of_date - days``; no upper bound; NULL dropped."""
    cutoff = F.date_sub(F.lit(as_of_date).cast("date"), days)
    return items.where(F.col("published_date").isNotNull() & (F.col("published_date") >= cutoff))


def restrict_to_terms(items: DataFrame, terms: DataFrame) -> DataFrame:
    """Items were collected per search term: keep items of the capped terms and
    attach the term's first dictionary position (the term list is broadcast
    after its size check)."""
    t = maybe_broadcast(terms.select(F.col("search_terms").alias("term"), "term_pos"), C.MAX_BROADCAST_BYTES)
    return items.join(t, "term", "inner")
