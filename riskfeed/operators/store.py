"""Mention store operators: attach risk ids, union with the store, keep-first
dedupe, rolling-window split, newest-first order, export projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.operators.common import maybe_broadcast

MENTION_COLUMNS = [
    "risk_id", "search_term_id", "title", "summary", "keywords", "published_date", "link",
    "source", "source_url", "sentiment", "polarity", "last_run_timestamp",
]
DEDUPE_KEYS = ("title", "link", "published_date")


def attach_risk_ids(items: DataFrame, dictionary: DataFrame, term_col: str = "term",
                    max_bytes: int = C.MAX_BROADCAST_BYTES) -> DataFrame:
    """JN1: left equi join on the exact term text against *all* dictionary rows
    (a term listed under several risks fans out; unknown terms keep NULL ids).
    ``dict_pos`` keeps the dictionary order for the keep-first dedupe."""
    d = dictionary.select(F.col("search_terms").alias("_jt"), "risk_id", "search_term_id",
                          F.col("search_term_id").alias("dict_pos"))
    d = maybe_broadcast(d, max_bytes)
    return items.join(d, items[term_col] == d["_jt"], "left").drop("_jt")


def combine(stored: DataFrame, new: DataFrame) -> DataFrame:
    """ST1: stored rows then new rows, aligned by name (missing -> NULL)."""
    return (stored.withColumn("_batch", F.lit(0))
            .unionByName(new.withColumn("_batch", F.lit(1)), allowMissingColumns=True))


def dedupe_keep_first(df: DataFrame, keys=DEDUPE_KEYS, order: list[str] | None = None) -> DataFrame:
    """WN2: one row per key (NULLs equal), the first in ``order`` wins.

    ``order`` must tell the rows of a key apart as far as it matters which stays; of rows
    equal in ``order`` the remaining columns decide, in their order. The row number needed
    is 1, so Spark keeps one row per key and task before the shuffle (window group limit):
    a key holding a large share of the rows never lands whole in one task, and the payload
    travels once, not inside an aggregation key.
    """
    order = order or ["_batch"]
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _window_cutoff(as_of: str, days: int) -> Column:
    return F.expr(f"CAST('{as_of}' AS TIMESTAMP_NTZ) - make_interval(0, 0, 0, {int(days)})")


def in_window(as_of: str, days: int = C.WINDOW_DAYS) -> Column:
    return F.col("published_date").cast("timestamp_ntz") >= _window_cutoff(as_of, days)


def window_split(df: DataFrame, as_of: str, days: int = C.WINDOW_DAYS):
    """FLT10: (current, old); current = published on / after as_of - days
    (timestamp compare, so midnight of the cutoff day is old unless the run is
    at 00:00), old = before it, NULL dates in neither."""
    ts = F.col("published_date").cast("timestamp_ntz")
    cutoff = _window_cutoff(as_of, days)
    return df.where(ts >= cutoff), df.where(ts < cutoff)


def window_flag(df: DataFrame, as_of: str, days: int = C.WINDOW_DAYS) -> DataFrame:
    """FLT10 as one labelled frame: ``window`` = current / old / NULL."""
    ts = F.col("published_date").cast("timestamp_ntz")
    cutoff = _window_cutoff(as_of, days)
    return df.withColumn("window", F.when(ts >= cutoff, "current").when(ts < cutoff, "old"))


def newest_first(df: DataFrame) -> DataFrame:
    """SO1: by date descending; link, title as tie-breaks for a stable order."""
    return df.orderBy(F.col("published_date").desc_nulls_last(), "link", "title")


def polarity_text(col: str = "polarity") -> Column:
    """FN14: up to four decimals, at least one, never an exponent (0.0005, 0.5, 0.0)."""
    return F.regexp_replace(F.col(col).cast("decimal(20,4)").cast("string"), r"(\.\d+?)0+$", "$1")


def published_columns(df: DataFrame, risk_set: str = "enterprise") -> DataFrame:
    """FN16: the column names of the published file: upper case, the risk id by risk set."""
    return df.select(*[F.col(c).alias(published_name(c, risk_set)) for c in df.columns])


def published_name(column: str, risk_set: str) -> str:
    return f"{risk_set.upper()}_RISK_ID" if column == "risk_id" else column.upper()


def export_projection(df: DataFrame) -> DataFrame:
    """FN14-16: CSV-facing projection (keywords joined, polarity as text,
    run stamp formatted)."""
    return df.select(
        "risk_id", "search_term_id", "title", "summary",
        F.array_join("keywords", ",").alias("keywords"),
        "published_date", "link", "source", "source_url", "sentiment",
        polarity_text().alias("polarity"),
        F.date_format("last_run_timestamp", "yyyy-MM-dd HH:mm:ss").alias("last_run_timestamp"),
        *[c for c in df.columns if c.startswith("score_")],
        *(["quality_score"] if "quality_score" in df.columns else []),
    )
