"""Operator 5: mixing sources to target weights by systematic sampling (DataFrame
functions only).

Every document of a source has the same expected number of copies, target / size of
its source. Documents are laid out in a fixed order, their expected copies are summed
along it, one offset per source is added, and a document is emitted once per integer
boundary that its stretch crosses. The order runs through size classes, so the words
taken stay near the target; within a class it is random by a hash of the id.

The running sums are never made in one task per source: a document's rank is the sum of
the counts of earlier size classes, of earlier hash slices of its class (about
``SLICE_ROWS`` rows each, as many slices as the class needs) and its place in its slice.

Defined results: null or blank text has size 0; a null source is a source, ordered
last; null ids take part (ordered by the hash of the empty id); rows repeated in the
input are separate documents; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeed.llm.common import WORD_RE, stage, text_or_empty

SLICE_ROWS = 512
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"


def unit_hash(col: Column, seed: str) -> Column:
    """A number in [0, 1) from the MD5 of the seed and a string."""
    hexed = F.substring(F.md5(F.concat(F.lit(seed + ":"), col)), 1, 8)
    return F.conv(hexed, 16, 10).cast("long").cast("double") / F.lit(4294967296.0)


def size_class(size: Column) -> Column:
    """Orderable text: number of binary digits, then the three digits after the first."""
    b = F.bin(size)
    return F.concat(F.lpad(F.length(b).cast("string"), 2, "0"),
                    F.substring(F.concat(b, F.lit("000")), 2, 3))


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target. One row per source goes through one window task; the
    rows are already summed per source. Sources reach their cap in the order of cap / weight,
    so those capped are a prefix of that order and the rest share what is left by weight."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    s = s.select("source", "source_size", pick.cast("long").alias("w"),
                 (F.col("source_size") * max_repeat).alias("cap"))
    every = Window.partitionBy(F.lit(1))
    by_ratio = Window.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", F.sum("source_size").over(every).alias("all_size"), F.sum("w").over(every).alias("all_w"),
                 F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
                 F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"))
    capped = (F.col("cap") * (F.col("all_w") - F.col("w_before"))
              <= (F.col("all_size") - F.col("cap_before")) * F.col("w"))
    s = s.withColumn("capped", capped)
    left = (F.col("all_size") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0)))
    share = F.sum(F.when(~F.col("capped"), F.col("w"))).over(every)
    s = s.withColumn("left", left).withColumn("share", share)
    target = F.when(F.col("capped"), F.col("cap").cast("double")) \
              .otherwise((F.col("left") * F.col("w")).cast("double") / F.col("share"))
    return s.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED,
                row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken, rid
    (``row_col``, a number that tells the input rows apart, or one given here)."""
    size = F.regexp_count(text_or_empty(text_col), F.lit(WORD_RE)).cast("long")
    d = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
                          (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("rid"))
              .withColumn("h", unit_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), seed))
              .withColumn("cls", size_class(F.col("size"))), "op5-sizes")
    targets = stage(source_targets(d, weights, max_repeat), "op5-targets")

    # counts per class, then per slice of a class: two small tables, summed before any window
    cls = d.groupBy("source", "cls").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("cls").rowsBetween(Window.unboundedPreceding, -1)
    cls = cls.select(F.col("source").alias("s2"), F.col("cls").alias("c2"),
                     F.ceil(F.col("n") / SLICE_ROWS).alias("slices"),
                     F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("cls_before"))
    cut = d.join(cls, d["source"].eqNullSafe(cls["s2"]) & (d["cls"] == cls["c2"])) \
           .withColumn("slice", F.floor(F.col("h") * F.col("slices"))).drop("s2", "c2")
    slices = cut.groupBy("source", "cls", "slice").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source", "cls").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.col("source").alias("s3"), F.col("cls").alias("c3"), F.col("slice").alias("b3"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("slice_before"))
    place = F.row_number().over(Window.partitionBy("source", "cls", "slice").orderBy("h", "doc_id", "rid"))
    cut = cut.withColumn("place", place)
    ranked = cut.join(slices, cut["source"].eqNullSafe(slices["s3"]) & (cut["cls"] == slices["c3"])
                      & (cut["slice"] == slices["b3"]))
    ranked = ranked.withColumn("rank", F.col("cls_before") + F.col("slice_before") + F.col("place"))

    t = targets.select(F.col("source").alias("s4"), "source_size", "target",
                       unit_hash(F.coalesce("source", F.lit("")), seed + "/offset").alias("u"))
    out = ranked.join(t, ranked["source"].eqNullSafe(t["s4"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(rate * F.col("rank") + F.col("u")) - F.floor(rate * (F.col("rank") - 1) + F.col("u"))
    out = out.withColumn("copies", crossed)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"), "rid")


def emit_copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, each once per boundary that its stretch crosses.
    Only sizes go through the sums; the rows move once, for the join with their copies."""
    d = stage(docs.withColumn("_rid", F.monotonically_increasing_id()), "op5-documents")
    mixed = mix_sources(d, id_col, source_col, text_col, row_col="_rid", **options)
    taken = stage(mixed.where("copies > 0").select(F.col("rid").alias("_rid"), "copies"), "op5-copies")
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return d.join(taken, "_rid").select(*[F.col(c) for c in docs.columns], again.alias("_copy")).drop("_copy")
