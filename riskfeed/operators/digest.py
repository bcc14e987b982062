"""Per-risk digest: column sniffing, last-4-weeks filter, counts, sample
headlines and the narrative prompt row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from riskfeed import constants as C
from riskfeed.functions import dates as D
from riskfeed.functions import text as X


def pick_column(columns: list[str], words) -> str | None:
    """FN20: first column whose lower-cased name contains any of ``words``."""
    for c in columns:
        if any(w in c.lower() for w in words):
            return c
    return None


def last_four_weeks(df: DataFrame, as_of: str, date_col: str | None = None,
                    days: int = C.DIGEST_DAYS) -> DataFrame:
    """FLT9: rows dated on / after ``as_of - days`` (timestamp compare, NULL
    dropped). Strict parse: if any non-NULL date fails to parse, the filter is
    skipped and every row is kept. No date column: every row is kept."""
    date_col = date_col or pick_column(df.columns, C.DATE_COLUMN_WORDS)
    if date_col is None:
        return df
    cutoff = F.expr(f"CAST('{as_of}' AS TIMESTAMP_NTZ) - make_interval(0, 0, 0, {int(days)})")
    dtype = df.schema[date_col].dataType.typeName()
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        # a typed column cannot hold an unparsable value: no strict-check pass,
        # and the filter prunes the store's date partitions
        return df.where(F.col(date_col).cast("timestamp_ntz") >= cutoff)
    parsed = D.coerce_date(F.col(date_col)).cast("timestamp_ntz")
    bad = df.select(F.count_if(F.col(date_col).isNotNull() & parsed.isNull())).scalar()
    return df.where((bad > 0) | (parsed >= cutoff))


def newest_first(df: DataFrame) -> list:
    """Store order as ascending sort keys: newest date first (no date last), then link, title."""
    day = F.unix_date(F.col("published_date").cast("date"))
    return [F.coalesce(-day, F.lit(2**31 - 1)), F.col("link"), F.col("title")]


def top_rows(key: str, order: list, n: int, *cols: str, where=None):
    """Aggregate: the first ``n`` rows of a group by ascending ``order``, as an array of structs of
    ``cols``. Each task keeps ``n`` rows of a group at most (a bounded queue), so a hot group is
    neither shuffled nor gathered whole; equal rows count one by one."""
    row = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], F.struct(*cols).alias("row"))
    kept = row if where is None else F.when(where, row)
    return F.transform(InternalFunction.collect_top_k(kept, n, True), lambda r: r["row"]).alias(key)


def risk_digest(df: DataFrame, risk_col: str = "risk_id", text_col: str | None = None,
                order: list | None = None, samples: int = C.DIGEST_SAMPLES) -> DataFrame:
    """AG1 + AG2: per non-NULL risk id the mention count and the first ``samples`` non-NULL texts
    (store order: newest first) as snippet lines, in one pass over the rows: both are partial
    aggregates, so a hot risk sends a count and ``samples`` rows per task."""
    text_col = text_col or pick_column(df.columns, C.TEXT_COLUMN_WORDS)
    rows = df.where(F.col(risk_col).isNotNull())
    count = F.count(F.lit(1)).alias("article_count")
    if text_col is None:
        return rows.groupBy(risk_col).agg(count).withColumn("sample_content", F.lit(""))
    top = top_rows("_top", order or newest_first(df), samples, text_col, where=F.col(text_col).isNotNull())
    lines = F.transform("_top", lambda r: X.snippet(r[text_col]))
    return rows.groupBy(risk_col).agg(count, top).select(
        risk_col, "article_count", F.array_join(lines, "\n").alias("sample_content"))


def risk_prompt(digest: DataFrame, risk_col: str = "risk_id") -> DataFrame:
    """FN19: fill the narrative prompt template for every digest row."""
    return digest.withColumn("prompt", F.format_string(
        C.RISK_PROMPT_TEMPLATE,
        F.col(risk_col).cast("string"), F.col("article_count").cast("string"), F.col("sample_content")))
