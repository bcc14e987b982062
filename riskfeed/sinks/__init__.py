"""Sinks: versioned mention store, archive, CSV export, backfill publish,
narrative (digest) tables.

Nothing is overwritten in place while it may be read: each store write goes
to a new version directory, and a numbered commit names it; the highest commit is the
live version. A commit's file is created only if its number is free, so of two writers that read
the same version one succeeds and the other one is told (:class:`StoreConflict`) and can
work on from what is live now. An append-only store is never rewritten: runs append rows,
backfills append updates of rows, and readers apply the newest update of a row.
A failed or retried job (lost executors, task retries) never leaves a half-written store behind,
and only a path that does not exist counts as "no store": any other read error
stops the job. Rows are dealt out by date with a rebalance, so adaptive
execution splits a date that holds much of the data over several files. Rows go
through Spark's readers and writers, so they work on any file system
the cluster uses.
"""

from __future__ import annotations

import time
import uuid

from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeed.operators import store as ST

COMMITS = "commits"
POINTERS = "pointers"  # of stores that were written before there were commits
NO_STORE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")  # no folder, or a folder without a data file
UPDATE_KEYS = ST.DEDUPE_KEYS
UPDATED = ("summary", "sentiment", "polarity", "last_run_timestamp")


class StoreConflict(RuntimeError):
    """Another writer has published a version since the one that was read."""


class Snapshot(NamedTuple):
    """The live version of a store: the number of its commit and its path."""
    number: int
    path: str | None


def read_or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None where its path does not exist (or holds no file yet)."""
    try:
        return read()
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(NO_STORE):
            return None
        raise


def _new_version(root: str) -> str:
    now = time.time_ns()
    stamp = time.strftime("%Y%m%dT%H%M%S", time.gmtime(now // 10 ** 9))
    return f"{root.rstrip('/')}/v={stamp}-{now % 10 ** 9:09d}-{uuid.uuid4().hex[:8]}"


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The live version; (0, None) where the store does not exist."""
    base = root.rstrip("/")
    commits = read_or_none(lambda: spark.read.text(f"{base}/{COMMITS}"))
    if commits is not None:
        number, path = commits.agg(F.max("value")).first()[0].split(" ", 1)
        return Snapshot(int(number), path)
    pointers = read_or_none(lambda: spark.read.text(f"{base}/{POINTERS}"))
    if pointers is not None:
        return Snapshot(0, pointers.agg(F.max("value")).first()[0])  # names begin with their UTC time
    if read_or_none(lambda: spark.read.parquet(f"{base}/v=*")) is not None:
        raise RuntimeError(f"{base} holds store versions but no commit names the live one")
    return Snapshot(0, None)


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the live store version (None when the store does not exist)."""
    return snapshot(spark, root).path


def _create(spark: SparkSession, path: str, line: str) -> bool:
    """Create a one-line file, or return False where it exists: it is written under a name that
    readers skip, then renamed, which the file system refuses if the new name is taken."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs
    target = fs.Path(path)
    aside = fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    files = fs.FileContext.getFileContext(target.getFileSystem(conf).makeQualified(target).toUri(), conf)
    out = target.getFileSystem(conf).create(aside, False)
    out.write(bytearray(line + "\n", "utf-8"))
    out.close()
    refuse = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    refuse[0] = fs.Options.Rename.NONE
    try:
        files.rename(aside, target, refuse)
        return True
    except Py4JJavaError as e:
        files.delete(aside, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def _publish(spark: SparkSession, root: str, version: str, after: int, strict: bool) -> None:
    """Commit a version under the number after ``after``, or, if not ``strict``, under the next one
    that is free. Nothing is deleted."""
    number = after + 1
    while not _create(spark, f"{root.rstrip('/')}/{COMMITS}/{number:020d}", f"{number:020d} {version}"):
        if strict:
            raise StoreConflict(f"commit {number} of {root} was taken by another writer")
        number += 1


def _by_date(rows: DataFrame) -> DataFrame:
    """Rows of a date together, newest first, a large date over several tasks."""
    return (rows.hint("rebalance", F.col("published_date"))
            .sortWithinPartitions(F.col("published_date").desc(), "link", "title"))


def write_current(current: DataFrame, root: str, based_on: int | None = None) -> str:
    """SNK1: write the in-window rows as a new version partitioned by
    published_date (rows sorted newest first inside each file), then commit it. With the number of the
    snapshot that the rows were made from, a version published meanwhile by another writer raises
    :class:`StoreConflict`; without it the rows replace whatever is live."""
    spark, version = current.sparkSession, _new_version(root)
    after = snapshot(spark, root).number if based_on is None else based_on
    _by_date(current).write.mode("errorifexists").partitionBy("published_date").parquet(version)
    _publish(spark, root, version, after, based_on is not None)
    return version


def read_version(spark: SparkSession, live: Snapshot) -> DataFrame | None:
    if not live.path:
        return None
    return read_or_none(lambda: spark.read.parquet(live.path))  # a version without rows has no file


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    return read_version(spark, snapshot(spark, root))


def write_archive(old: DataFrame, path: str, run: str) -> None:
    """SNK2: rows that left the window, under the run that aged them. A run that is
    repeated replaces its own rows and no others."""
    _by_date(old).write.mode("overwrite").partitionBy("published_date").parquet(
        f"{path.rstrip('/')}/run={run.replace(' ', 'T').replace(':', '-')}")


def read_archive(spark: SparkSession, path: str, latest_run_only: bool = False) -> DataFrame | None:
    """All archived rows, or those of the newest run alone (what the reproduced jobs keep)."""
    df = read_or_none(lambda: spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/run=*"))
    if df is None or not latest_run_only:
        return df
    return df.where(F.col("run") == df.select(F.max("run")).scalar())


def write_quarantine(files: DataFrame, path: str, run: str) -> None:
    """The landed files that a run could not read (path, n_bytes, head), under the run; a run that
    is repeated replaces its own rows."""
    files.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run.replace(' ', 'T').replace(':', '-')}")


def export_csv(current: DataFrame, path: str, risk_set: str = "enterprise") -> None:
    """CSV export with the published header (newest first, quotes doubled) for downstream tools."""
    (ST.published_columns(ST.export_projection(ST.newest_first(current)), risk_set)
     .write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .csv(path))


def publish_backfill(updated: DataFrame, root: str, based_on: int | None = None) -> str | None:
    """SNK3: publish a backfilled store only when at least one row changed. ``based_on`` as in
    :func:`write_current`."""
    if updated.where(F.col("backfilled")).limit(1).count() == 0:
        return None
    return write_current(updated.drop("backfilled"), root, based_on)


def write_narratives(digest: DataFrame, root: str, run_ts: str) -> None:
    """SNK4: one timestamped copy (folder run_ts=..., replaced when the run is repeated)
    and one 'latest' copy."""
    stamped = digest.withColumn("generated_at", F.lit(run_ts).cast("timestamp_ntz"))
    folder = run_ts.replace(" ", "T").replace(":", "-")
    stamped.write.mode("overwrite").parquet(f"{root.rstrip('/')}/history/run_ts={folder}")
    stamped.write.mode("overwrite").parquet(f"{root.rstrip('/')}/latest")


# ---------------------------------------------------------------- append-only store

def append_new(new_rows: DataFrame, root: str) -> None:
    """Append-only store: a run writes only its new rows, as new files in their
    date partitions (one atomic job commit). The rolling window is applied when
    reading (partition pruning), so nothing old is rewritten. A re-run after a
    failure is idempotent: its seen-link gate and key anti join drop every row
    the failed attempt already committed."""
    (_by_date(new_rows)
     .write.mode("append").partitionBy("published_date").parquet(f"{root.rstrip('/')}/data"))


def append_updates(rows: DataFrame, root: str) -> None:
    """SNK3 on an append-only store: new values of the ``UPDATED`` columns for rows named by
    ``UPDATE_KEYS``, dated. Nothing is replaced, so a run that appends rows of the same dates
    meanwhile, or another backfill, loses nothing."""
    (rows.select(*UPDATE_KEYS, *UPDATED, F.lit(time.time_ns()).alias("_at"))
     .hint("rebalance", F.col("published_date"))
     .write.mode("append").partitionBy("published_date").parquet(f"{root.rstrip('/')}/updates"))


def read_appended(spark: SparkSession, root: str, updates: bool = True) -> DataFrame | None:
    """All rows of an append-only store, the newest update applied to each. Without ``updates``
    the rows as they were appended, which is all that links and keys need. A filter on the date
    prunes rows and updates alike."""
    base = root.rstrip("/")
    data = read_or_none(lambda: spark.read.parquet(f"{base}/data"))
    told = read_or_none(lambda: spark.read.parquet(f"{base}/updates")) if updates else None
    if data is None or told is None:
        return data
    newest = ST.dedupe_keep_first(told.withColumn("_age", -F.col("_at")), UPDATE_KEYS, ["_age"])
    newest = newest.select(*[F.col(c).alias(f"_u_{c}") for c in (*UPDATE_KEYS, *UPDATED)], F.lit(True).alias("_hit"))
    same = data["published_date"] == newest["_u_published_date"]  # targets of a backfill are dated
    for k in UPDATE_KEYS:
        if k != "published_date":
            same = same & data[k].eqNullSafe(newest[f"_u_{k}"])
    new = {c: F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)) for c in UPDATED if c in data.columns}
    return data.join(newest, same, "left").withColumns(new).select(*data.columns)


def read_window(spark: SparkSession, root: str, as_of: str, days: int, updates: bool = True):
    """(current, old) of an append-only store at ``as_of``; the date filter
    prunes partitions, so reading the current window never touches old files."""
    df = read_appended(spark, root, updates)
    if df is None:
        return None, None
    return ST.window_split(df, as_of, days)
