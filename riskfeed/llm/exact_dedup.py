"""Operator 1: exact dedup with a heavy-hitter split (DataFrame functions only).

One narrow pass digests every text. A Misra-Gries pass (Spark's frequent-items
aggregate) names the digests that may exceed ``support`` of all rows; they are
counted exactly, and the winners that truly are frequent (at most ``1/support``
rows) are broadcast, so their copies are resolved map-side without any shuffle.
All other digests, none of which can hold more than ``support`` of the rows, take
the ordinary shuffle.

Defined results: a null text counts as empty; texts are equal when identical after
each run of white space became one space. Of equal texts the smallest doc_id stays,
null ids last, and of rows that share id and text exactly one stays. An empty table
gives an empty result. Extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfeed.llm.common import SPACE_RE, stage, text_or_empty


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                support: float = 1e-3) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    digest = F.unhex(F.sha2(F.regexp_replace(text_or_empty(text_col), SPACE_RE, " "), 256))
    d = stage(docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"),
                          F.monotonically_increasing_id().alias("rid")), "op1-digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "rid"))

    heavy = stage(frequent_groups(d, "digest", support, first.alias("first")), "op1-winners")
    won = d.join(F.broadcast(heavy), "digest")
    rest = d.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    group = Window.partitionBy("digest")
    rest = rest.select("digest", "doc_id", "rid", F.count(F.lit(1)).over(group).alias("group_size"),
                       first.over(group).alias("first"))
    both = won.select(*rest.columns).unionByName(rest)
    return both.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                       (F.col("rid") == F.col("first.rid")).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))


def frequent_groups(d: DataFrame, key: str, support: float, *aggs) -> DataFrame:
    """Keys held by at least ``support`` of the rows (and by two at least), with their exact
    ``group_size`` and ``aggs``: at most ``1/support`` rows. Misra-Gries proposes, an exact
    count over the proposed keys' rows decides."""
    rows = d.count()
    d = d.withColumn("_k", F.xxhash64(key))
    proposed = d.stat.freqItems(["_k"], support).select(F.explode("_k_freqItems").alias("_k"))
    return (d.join(F.broadcast(proposed), "_k", "left_semi")
             .groupBy(key).agg(F.count(F.lit(1)).alias("group_size"), *aggs)
             .where(F.col("group_size") >= max(2, support * rows)))
