"""Operator 11: conversation prefix trie by whole-sequence collapse.

Conversations are rebuilt (a shared head, then their own rest) as rows of (conversation, depth,
turn digest, bytes of the text); texts never move. Identical rebuilt conversations collapse to
one weighted sequence, named after its smallest member, with the list of its ends. A sequence
that is a proper prefix of another one is found by its key among the inner nodes; an anti join
drops those, what is left are the leaves. Weighted prefixes are then aggregated to nodes.

A prefix is named by its depth and a 128-bit key, the exclusive or of hashes of (place, turn
digest): a sum that needs no order, so that whole sequences are keyed by an ordinary partial
aggregate and prefixes by a running one.

Sums over subtrees need no pairs of ancestors and descendants. Along a sequence the smallest
member of a node can only grow with the depth, so a sequence owns the nodes from some depth on,
as a chain. A node's subtree is the rest of its own chain, and the whole chains of all other
sequences that run through it: two aggregates, linear in the turns.

Scale: positions come from a range partitioning (offsets per conversation and partition) and
running values in two levels, by blocks of ``BLOCK`` turns, so that no conversation, however
long, is one task's work; counts at common prefixes are partial aggregates. A node's end list is
a hash over one stream of ids: they are sorted by range and joined to pieces where they lie, and
only the pieces of one node go through one task, as a stream.

Defined results: rows without conv_id belong to no conversation; null role or text is empty;
turns are ordered null first, equal turns by their digest; a repeated row is one more turn; an
empty table has no conversation and so no node, not even a root. Remainders of negative ids have
the sign of the id, as in SQL. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeed.llm.common import stage

BLOCK = 4096
PIECE_IDS = 2000
KEY = ["depth", "k1", "k2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; the role's length keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def _numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place ``i`` (from 0) in the conversation, and conversations with their
    number of turns ``n``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("rid"))
    order = [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("rid")]
    dealt = turns.repartitionByRange(_partitions(turns), "conv_id", *order)
    dealt = stage(dealt.withColumn("part", F.spark_partition_id()), "op11-turns")
    over = Window.partitionBy("conv_id")
    counts = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(over.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("conv_id", "part", F.coalesce(before, F.lit(0)).alias("before"))
    at = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    numbered = (dealt.withColumn("at", at).join(offsets, ["conv_id", "part"])
                .select("conv_id", (F.col("before") + F.col("at") - 1).alias("i"), "digest", "bytes"))
    return numbered, counts.groupBy("conv_id").agg(F.sum("c").alias("n"))


def rebuild(conversations: DataFrame, block: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, depth from 1, f1, f2, bytes) and all conversations (conv_id).

    Conversation c is the first h turns of conversation c - c % block, then its own turns after
    the first h, with h = crc32(c) % heads."""
    numbered, sizes = _numbered(conversations)
    sizes = stage(sizes, "op11-sizes")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = sizes.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(base, "base", "left").select(
        "conv_id", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    numbered = stage(numbered, "op11-numbered")
    own = (numbered.join(convs, "conv_id").where("i >= h")
           .select("conv_id", (F.col("taken") + F.col("i") - F.col("h") + 1).alias("depth"), "digest", "bytes"))
    first = numbered.where(F.col("i") < heads - 1).withColumnRenamed("conv_id", "base")
    head = (convs.where("taken > 0").join(first, "base").where("i < taken")
            .select("conv_id", (F.col("i") + 1).alias("depth"), "digest", "bytes"))
    lanes = [F.xxhash64(F.lit(lane), "depth", "digest").alias(f"f{lane}") for lane in (1, 2)]
    turns = own.unionByName(head).select("conv_id", F.col("depth").cast("long").alias("depth"), *lanes, "bytes")
    return stage(turns, "op11-rebuilt"), sizes.select("conv_id")


def _running(df: DataFrame, group: str, order: str, values: dict[str, Column], join, down: bool = False) -> DataFrame:
    """Running aggregates along ``order`` (towards smaller values if ``down``) per group, in two
    levels: sums of the blocks before, then the rows of one block."""
    df = df.withColumn("blk", F.floor(F.col(order) / BLOCK))
    sign = (lambda c: F.col(c).desc()) if down else F.col
    before = Window.partitionBy(group).orderBy(sign("blk")).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(group, "blk").orderBy(sign(order)).rowsBetween(Window.unboundedPreceding, 0)
    sums = df.groupBy(group, "blk").agg(*[v.alias(f"_{k}") for k, v in values.items()])
    carried = sums.select(group, "blk", *[
        F.coalesce(agg(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k, agg in join.items()])
    return (df.select("*", *[v.over(inside).alias(f"{k}_in") for k, v in values.items()])
            .join(carried, [group, "blk"]))


def _collapse(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (conv_id and its sequence's key) and weighted sequences (key, s, w)."""
    whole = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor("f1").alias("k1"),
                                         F.bit_xor("f2").alias("k2"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in KEY]
    members = stage(convs.join(whole, "conv_id", "left").select("conv_id", *zero), "op11-members")
    seqs = members.groupBy(*KEY).agg(F.min("conv_id").alias("s"), F.count(F.lit(1)).alias("w"))
    return members, stage(seqs, "op11-sequences")


def _prefixes(turns: DataFrame, seqs: DataFrame) -> DataFrame:
    """Every prefix of every distinct sequence, the empty one included: s, depth, k1, k2, bytes of
    the last text, the sequence's weight w and length."""
    of = seqs.select("s", "w", F.col("depth").alias("length"))
    rows = turns.withColumnRenamed("conv_id", "s").join(of, "s")
    run = _running(rows, "s", "depth", {"k1": F.bit_xor("f1"), "k2": F.bit_xor("f2")},
                   {"k1": F.bit_xor, "k2": F.bit_xor})
    keys = [F.col(f"{k}_in").bitwiseXOR(F.col(f"_{k}")).alias(k) for k in ("k1", "k2")]
    empty = of.select("s", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(k) for k in ("k1", "k2")],
                      F.lit(0).cast("long").alias("bytes"), "w", "length")
    return stage(run.select("s", "depth", *keys, "bytes", "w", "length").unionByName(empty), "op11-prefixes")


def _end_lists(members: DataFrame) -> DataFrame:
    """Per sequence key the SHA-256 of its members' ids, ascending, joined by commas."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in range(3)])
            ids = batch.column(3).to_numpy()
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            start = np.unique(np.concatenate((np.arange(0, len(ids), PIECE_IDS), new))).astype(np.int64)
            text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(start, np.append(start[1:], len(ids)))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, key[:, start]), pa.array(ids[start]), pa.array(text, pa.string())],
                                             names=[*KEY, "first", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, done = None, None, []

        def told() -> pa.RecordBatch:
            cols = list(zip(*done)) if done else [()] * 4
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                              names=[*KEY, "ends_sha256"])
        for batch in batches:
            for *key, piece in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4))):
                if key == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256()
                sha.update(piece.encode())
            yield told()
            done.clear()
        if now is not None:
            done.append((*now, sha.hexdigest()))
            yield told()

    n = _partitions(members)
    dealt = members.select(*KEY, "conv_id").repartitionByRange(n, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    cut = dealt.mapInArrow(pieces, "depth long, k1 long, k2 long, first long, piece string")
    cut = cut.repartition(n, *KEY).sortWithinPartitions(*KEY, "first")
    return cut.mapInArrow(digests, "depth long, k1 long, k2 long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, block: int = 5, heads: int = 9) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    turns, convs = rebuild(conversations, block, heads)
    members, seqs = _collapse(turns, convs)
    prefixes = _prefixes(turns, seqs)
    nodes = stage(prefixes.groupBy(*KEY).agg(
        F.min("s").alias("s"), F.sum("w").alias("n_convs"), F.max("bytes").alias("bytes"),
        F.max("length").alias("longest")), "op11-nodes")
    # leaves: sequences that are no proper prefix of another one
    leaves = seqs.join(nodes.where("longest > depth").select(*KEY), KEY, "left_anti").select("s", F.lit(1).alias("leaf"))

    # a sequence's own nodes are those named after it: a chain down to its end
    val = nodes.withColumn("val", (F.col("n_convs") - 1) * F.col("bytes"))
    chain = stage(_running(val, "s", "depth", {"saved": F.sum("val")}, {"saved": F.sum}, down=True)
                  .withColumn("saved", F.col("saved_in") + F.col("_saved"))
                  .select("s", *KEY, "n_convs", "saved"), "op11-chains")
    own = chain.groupBy("s").agg(F.min("depth").alias("top"), F.max("saved").alias("chain_saved"))
    length = seqs.select("s", F.col("depth").alias("length"))
    own = stage(length.join(own, "s").join(leaves, "s", "left").fillna(0, ["leaf"]), "op11-owners")

    # the other sequences through a node pass it above their own chain
    passing = prefixes.select("s", *KEY).join(own.select("s", "top", "chain_saved", "leaf"), "s").where("depth < top")
    hung = F.col("depth") == F.col("top") - 1
    below = passing.groupBy(*KEY).agg(
        F.sum("chain_saved").alias("saved_below"), F.sum("leaf").alias("leaves_below"),
        F.count_if(hung).alias("hung"))
    root = nodes.where("depth = 0").select("s").first()
    if root is None:
        return spark.createDataFrame([], RESULT)
    # a chain's parent: the root is one known node, any other is met by its key
    top = passing.where(hung).select("s", *KEY)
    parents = (top.where("depth > 0").join(nodes.select(*KEY, F.col("s").alias("parent")), KEY)
               .select("s", "parent").unionByName(top.where("depth = 0").select("s", F.lit(root["s"]).alias("parent"))))
    parents = own.join(parents, "s", "left").select("s", "top", "length", "leaf", "parent")

    return (chain.join(parents, "s").join(below, KEY, "left").join(_end_lists(members), KEY, "left").select(
        F.col("s").alias("conv_id"), "depth",
        F.when(F.col("depth") > F.col("top"), F.col("s")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        ((F.col("depth") < F.col("length")).cast("long") + F.coalesce("hung", F.lit(0))).alias("n_children"),
        (F.col("leaf") + F.coalesce("leaves_below", F.lit(0))).cast("long").alias("n_leaves"),
        (F.col("saved") + F.coalesce("saved_below", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))
