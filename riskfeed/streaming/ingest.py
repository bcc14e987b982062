"""STR1: incremental mention ingest with Structured Streaming.

Landed feed files are read as a file stream (each file processed once, the
checkpoint records which). The stream itself is stateless; what was seen is an index of the
stored links beside the store, in ``LINK_BUCKETS`` buckets by hash. Per
micro-batch: normalise, gate (link, TLD, translated page, blocked source, recency at
``as_of``), drop links already in the index (only the buckets that the batch touches are listed
and read, and only their links), keep the first item of each link, attach
the risk ids, write the batch under its own epoch directory, then its links to the index. There is no
event-time watermark: feeds carry dates of their own making, and one date in the
future must not turn later items into late ones. Writing ``epoch=<id>`` with
overwrite makes a retried epoch replace its own output, store and index alike, and a batch never
looks at what its own epoch has written: exactly-once store contents even when executors are
lost and the batch is re-run. A store without an index gets one from its links first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.functions import text as X
from riskfeed.operators import gates as G
from riskfeed.operators import store as ST
from riskfeed.plans.daily import materialize
from riskfeed.sinks import read_or_none
from riskfeed.sources.feed import feed_to_raw_items, landed_files

# which item of a link stays; the rest of the order makes it definite
FIRST_OF_LINK = ["published_date", "term", "title", "source", "item_id"]
LINK_BUCKETS = 256
STORE_COLUMNS = [*ST.MENTION_COLUMNS, "term", "item_id"]


def read_store(spark: SparkSession, store_path: str) -> DataFrame | None:
    return read_or_none(lambda: spark.read.parquet(store_path))


def _bucket(link: str = "link"):
    return F.pmod(F.xxhash64(link), F.lit(LINK_BUCKETS)).cast("int")


def links_path(store_path: str) -> str:
    return store_path.rstrip("/") + "-links"


def write_links(rows: DataFrame, store_path: str) -> None:
    """Adds (link, epoch) rows to the index; the folders of an epoch written again are replaced."""
    (rows.select("link", _bucket().alias("bucket"), "epoch").repartition("bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket", "epoch").parquet(links_path(store_path)))


def seen_links(spark: SparkSession, store_path: str, batch: DataFrame, epoch: int) -> DataFrame | None:
    """Links of other epochs in the buckets of the batch's links; None where there are none. The
    bucket numbers come to the driver (``LINK_BUCKETS`` at most) and become the paths to read."""
    touched = sorted(r["b"] for r in batch.select(_bucket().alias("b")).distinct().collect())
    root = links_path(store_path)
    seen = read_or_none(lambda: spark.read.option("basePath", root).schema("link string, bucket int, epoch long")
                        .parquet(f"{root}/bucket={{{','.join(map(str, touched))}}}"))
    return None if seen is None else seen.where(F.col("epoch") != epoch).select("link")


def _index_old_store(spark: SparkSession, store_path: str) -> None:
    """The index of a store that was written without one."""
    if read_or_none(lambda: spark.read.parquet(links_path(store_path))) is None:
        stored = read_store(spark, store_path)
        if stored is not None:
            write_links(stored.select(X.normalize_name("link").alias("link"), "epoch").distinct(), store_path)


def ingest_stream(spark: SparkSession, landing_root: str, store_path: str, checkpoint: str,
                  block_list: DataFrame, dictionary: DataFrame | None = None, as_of: str | None = None,
                  recency_days: int = C.RECENCY_DAYS, resolved: DataFrame | None = None):
    """Start the ingest query (trigger availableNow: process what has landed,
    then stop). Returns the StreamingQuery. Items without a readable date are dropped; with
    ``as_of`` (a date) so are those older than ``recency_days`` before it. Text, sentiment and
    polarity have the values of a page that has not been fetched; the backfill job fills them."""
    raw = feed_to_raw_items(landed_files(spark, landing_root, streaming=True), resolved)
    items = G.link_gates(G.normalize_items(raw), block_list)
    items = G.recent(items, as_of, recency_days) if as_of else items.where(F.col("published_date").isNotNull())

    _index_old_store(spark, store_path)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = materialize(batch)  # parsed once: its buckets and its rows are read from it
        seen = seen_links(batch.sparkSession, store_path, batch, epoch_id)
        if seen is not None:
            batch = batch.join(seen, "link", "left_anti")
        first = ST.dedupe_keep_first(batch, ["link"], FIRST_OF_LINK)
        if dictionary is None:
            ids = first.withColumns({"risk_id": F.lit(None).cast("int"), "search_term_id": F.lit(None).cast("int")})
        else:
            ids = ST.dedupe_keep_first(ST.attach_risk_ids(first, dictionary), ST.DEDUPE_KEYS, ["dict_pos", "risk_id"])
        out = ids.withColumns({
            "summary": F.lit(""), "keywords": F.array().cast("array<string>"),
            "sentiment": F.lit(C.DEFAULT_SENTIMENT), "polarity": F.lit(C.DEFAULT_POLARITY),
            "last_run_timestamp": F.lit(as_of).cast("timestamp_ntz")})
        target = f"{store_path.rstrip('/')}/epoch={epoch_id}"
        out.select(*STORE_COLUMNS).write.mode("overwrite").parquet(target)
        kept = batch.sparkSession.read.schema(out.select("link").schema).parquet(target).distinct()
        write_links(kept.withColumn("epoch", F.lit(epoch_id).cast("long")), store_path)

    return (items.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
