"""Shared helpers: size-checked broadcast and small-dimension handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeed.functions.literals import double_array_literal, string_array_literal  # noqa: F401


_MEMO: dict = {}


def clear_memo() -> None:
    """Forget memoised dimension checks (call at the start of a job run: a
    dimension file may have changed on disk since the last run in a
    long-lived session, while its plan hash has not)."""
    _MEMO.clear()


def _memo(df: DataFrame, kind: str, bound: int, compute):
    """Results of dimension checks / collections, keyed by the plan's semantic
    hash: the same small dimension rebuilt for several operators of one plan
    is checked once."""
    try:
        key = (df.semanticHash(), kind, bound)
    except Exception:  # noqa: BLE001 - no plan hash available (e.g. remote session): no memo
        return compute()
    # the hash has 32 bits: frames that share it are told apart by comparing their plans
    for known, value in _MEMO.setdefault(key, []):
        if known.sameSemantics(df):
            return value
    value = compute()
    _MEMO[key].append((df, value))
    return value


def bounded_count(df: DataFrame, bound: int) -> int:
    """Exact row count if it does not exceed ``bound``, else ``bound + 1``.

    Only ``bound + 1`` rows are ever read, so checking a huge side is cheap.
    """
    return _memo(df, "count", bound, lambda: df.limit(bound + 1).count())


ROW_BYTES = 64  # counted for each row beside its strings


def bounded_bytes(df: DataFrame, bound: int) -> int:
    """Size of ``df`` in bytes (strings and binaries by length, ``ROW_BYTES`` a row), or more
    than ``bound``. At most ``bound / ROW_BYTES + 1`` rows are read."""
    long = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    size = sum(long, F.lit(ROW_BYTES)).cast("long")

    def measure():
        return df.limit(bound // ROW_BYTES + 1).agg(F.sum(size)).first()[0] or 0
    return _memo(df, "bytes", bound, measure)


def maybe_broadcast(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast ``df`` only when its size is proven to be <= ``max_bytes``;
    beyond that the join is left to the planner (sort-merge / AQE)."""
    return F.broadcast(df) if bounded_bytes(df, max_bytes) <= max_bytes else df


class TooLarge(Exception):
    """A dimension exceeded the bound for being shipped whole to every task."""


def literal_array(df: DataFrame, col: Column, bound: int, elem_type: str = "string") -> Column:
    """Array literal of a small dimension column, for use inside higher-order
    functions (which cannot hold subqueries). The row count is checked against
    ``bound`` first; callers fall back to a join when :class:`TooLarge` is raised."""
    sel = df.select(col)
    rows = _memo(sel, "rows", bound, lambda: sel.limit(bound + 1).collect())
    if len(rows) > bound:
        raise TooLarge(f"more than {bound} rows")
    values = [r[0] for r in rows]
    if elem_type == "string":
        return string_array_literal(values)
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{elem_type}>") if values \
        else F.array().cast(f"array<{elem_type}>")


def literal_map(df: DataFrame, key: Column, value: Column, bound: int, value_type: str) -> Column:
    """Map literal of a small (key, value) dimension, size-checked like
    :func:`literal_array`. Duplicate keys keep the last value."""
    sel = df.select(key, value)
    rows = _memo(sel, "rows", bound, lambda: sel.limit(bound + 1).collect())
    if len(rows) > bound:
        raise TooLarge(f"more than {bound} rows")
    pairs = {}
    for k, v in rows:
        if k is not None:
            pairs[k] = v
    if not pairs:
        return F.create_map().cast(f"map<string,{value_type}>")
    return F.map_from_arrays(F.array(*[F.lit(k) for k in pairs]).cast("array<string>"),
                             F.array(*[F.lit(v) for v in pairs.values()]).cast(f"array<{value_type}>"))


def spread_for_cpu(df: DataFrame) -> DataFrame:
    """Before CPU-heavy per-row text work on a *table scan*: if the scan has
    fewer partitions than the cluster has task slots (few large row groups),
    spread the rows round-robin so every core works. Cluster-sized inputs have
    enough splits and are left untouched (no shuffle). Only call this on scans:
    asking a joined plan for its partitions would prepare that whole plan."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        n = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - remote session: leave the plan as is
        return df
    if n < slots and n <= SPREAD_MAX_SCAN_PARTITIONS:
        return df.repartition(slots)
    return df


# a scan with at most this many splits is small (<= a few GB): spreading it
# costs little; larger scans already provide their own parallelism
SPREAD_MAX_SCAN_PARTITIONS = 16
