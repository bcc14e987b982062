"""PIPE1: the daily mention run as one lazy plan.

dictionary -> decode + cap -> items -> normalise -> gates (link, source, seen)
-> top-k per term -> recency -> page text + sentiment once per link -> risk ids
-> quality score -> union with the store -> keep-first dedupe -> window split.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.operators import enrich as E
from riskfeed.operators import gates as G
from riskfeed.operators import score as Q
from riskfeed.operators import store as ST
from riskfeed.operators.sentiment import Lexicon

ORDER_COLUMNS = ["_batch", "term_pos", "result_page", "feed_pos", "item_id", "dict_pos"]
OUTPUT_COLUMNS = ST.MENTION_COLUMNS + Q.SCORE_COLUMNS + ["quality_score"]


@dataclass
class DailyParams:
    as_of: str                       # run clock, 'YYYY-MM-DD HH:MM:SS'
    max_terms: int | None = None            # the reproduced jobs cap at C.MAX_TERMS
    max_items_per_term: int | None = None   # and at C.MAX_ITEMS_PER_TERM
    score_domain_from: str = "source_url"   # or "link" / "source_site"
    recency_days: int = C.RECENCY_DAYS
    window_days: int = C.WINDOW_DAYS
    min_article_chars: int = C.MIN_ARTICLE_CHARS

    @property
    def as_of_date(self) -> str:
        return self.as_of[:10]


def observed(observation: Observation, otherwise) -> dict:
    """An observation's metrics, or ``otherwise()`` where adaptive execution left the observed
    part out of the plan (its rows turned out not to matter, for example beside an empty side)."""
    try:
        return dict(observation.get)
    except Py4JJavaError:
        return otherwise()


class StoreAudit:
    """Counts of the stored rows and of their distinct links, observed where a run reads them for its
    seen-link gate: no pass over the store is made for them. Only a run without any item to test
    never reads the links; then they are counted."""

    def __init__(self, name: str = "store"):
        self.rows, self.distinct, self.stored = Observation(f"{name}_rows"), Observation(f"{name}_links"), None

    def links(self, stored: DataFrame) -> DataFrame:
        self.stored = stored
        counted = stored.observe(self.rows, F.count(F.lit(1)).alias("stored_rows"))
        return G.existing_links(counted).observe(self.distinct, F.count(F.lit(1)).alias("existing_links"))

    @property
    def get(self) -> dict:
        """After the run's first action; zeros where there was no store."""
        if self.stored is None:
            return {"stored_rows": 0, "existing_links": 0}
        links = G.existing_links(self.stored).select(F.count(F.lit(1)).alias("existing_links"))
        rows = self.stored.agg(F.count(F.lit(1)).alias("stored_rows"))
        return (observed(self.rows, lambda: rows.first().asDict())
                | observed(self.distinct, lambda: links.first().asDict()))


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of a small intermediate that is read more than once."""
    from riskfeed.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_mentions(raw_items: DataFrame, dictionary: DataFrame, pages: DataFrame,
                 block: DataFrame, allow: DataFrame, lex: Lexicon,
                 stored: DataFrame | None, p: DailyParams, audit: "StoreAudit | None" = None) -> DataFrame:
    """Scored new mention rows of one run (before the union with the store)."""
    terms = G.valid_terms(dictionary, p.max_terms)
    items = G.restrict_to_terms(G.normalize_items(raw_items), terms)
    seen = None
    if stored is not None:
        seen = audit.links(stored) if audit else G.existing_links(stored)
    items = G.link_gates(items, block, seen)
    if p.max_items_per_term is not None:
        items = G.top_k_per_term(items, p.max_items_per_term)
    items = G.recent(items, p.as_of_date, p.recency_days)
    # the survivors (the items of the last days) feed both the page
    # selection and the enrichment join: materialise them once (reliable
    # checkpoint in the cluster's checkpoint folder) instead of re-running the
    # scans, joins and the top-k window for each use
    items = materialize(items)
    feats = E.page_features(E.pages_for_links(pages, items), lex, terms, p.min_article_chars)
    new = E.enrich(items, feats)
    new = ST.attach_risk_ids(new, dictionary, "term")
    new = Q.term_flag(new, ["title"], terms, "_title_match")
    new = new.withColumn("_match", F.col("_title_match") | F.col("summary_match"))
    new = Q.quality_score(new, terms, allow, block, match_col="_match", words_col="summary_words",
                          source_url_col=p.score_domain_from)
    new = new.withColumn("last_run_timestamp", F.lit(p.as_of).cast("timestamp_ntz"))
    return new.select(*OUTPUT_COLUMNS, *[c for c in ORDER_COLUMNS if c != "_batch"])


def new_rows(raw_items: DataFrame, dictionary: DataFrame, pages: DataFrame, block: DataFrame,
             allow: DataFrame, lex: Lexicon, stored: DataFrame | None, p: DailyParams,
             observation=None, store_audit: "StoreAudit | None" = None) -> DataFrame:
    """The rows that one run adds to the store. With a ``pyspark.sql.Observation`` the run
    audit counts (new rows, their null dates, their mean quality score) are
    collected as a side effect of the first action, without an extra pass."""
    new = new_mentions(raw_items, dictionary, pages, block, allow, lex, stored, p, store_audit)
    # keep-first dedupe on (title, link, published_date), stored rows first.
    # The store is already duplicate-free, and every new row passed the recency
    # gate (date >= as_of_date - recency_days), so only that date slice of the
    # store can collide: dedupe the new rows among themselves, drop those whose
    # key is in the slice (date-partition pruning on the store).
    new = ST.dedupe_keep_first(new.withColumn("_batch", F.lit(1)), ST.DEDUPE_KEYS, ORDER_COLUMNS)
    new = new.select(*OUTPUT_COLUMNS)
    if stored is not None:
        low = F.date_sub(F.lit(p.as_of_date).cast("date"), p.recency_days)
        keys = list(ST.DEDUPE_KEYS)
        slice_keys = stored.where(F.col("published_date") >= low).select(*keys).distinct()
        new = new.join(slice_keys, keys, "left_anti")
    if observation is not None:
        new = new.observe(observation, F.count(F.lit(1)).alias("new_rows"),
                          F.count_if(F.col("published_date").isNull()).alias("new_null_dates"),
                          F.avg("quality_score").alias("new_mean_score"),
                          F.count_if(ST.in_window(p.as_of, p.window_days)).alias("new_current_rows"))
    return new.select(*OUTPUT_COLUMNS)


def with_store(stored: DataFrame | None, new: DataFrame, p: DailyParams) -> tuple[DataFrame, DataFrame]:
    """(current, old): the store to write and the rows that left the window.

    Rows age on the stored side only (new rows are recent), so the archive never runs the
    enrichment; a window shorter than the recency gate is the one exception."""
    current, aged = ST.window_split(new, p.as_of, p.window_days)
    if stored is None:
        return current, aged
    stored = stored.select(*[c for c in OUTPUT_COLUMNS if c in stored.columns])
    kept, old = ST.window_split(stored, p.as_of, p.window_days)
    if p.window_days <= p.recency_days:
        old = old.unionByName(aged, allowMissingColumns=True)
    return kept.unionByName(current, allowMissingColumns=True).select(*OUTPUT_COLUMNS), old


def run(raw_items: DataFrame, dictionary: DataFrame, pages: DataFrame, block: DataFrame,
        allow: DataFrame, lex: Lexicon, stored: DataFrame | None, p: DailyParams,
        observation=None) -> tuple[DataFrame, DataFrame]:
    """One daily run as one plan: (current, old)."""
    new = new_rows(raw_items, dictionary, pages, block, allow, lex, stored, p, observation)
    return with_store(stored, new, p)
