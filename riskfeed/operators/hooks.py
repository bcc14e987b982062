"""User hooks (UD2-UD4): per-row and per-group Python functions run in Arrow batches, with
failures captured as values instead of failing the job. They are the only Python that runs on
the executors outside the optional training-data operators.

A group hook gets a bounded number of its group's rows and the group's whole row count. Those
rows are kept by a partial aggregate in every task, so that no group, however large, is brought
whole into one worker.

The narrative step calls an external text generator once per risk; here the
generator is a user-supplied function applied with ``mapInPandas`` to the
prompt table (one row per risk), so it runs on the executors in batches and a
failing call yields an error text for that row, like the reproduced job.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfeed.operators import digest as DG


def apply_row_hook(df: DataFrame, fn: Callable[[dict], str], input_cols: list[str],
                   out_col: str, error_format: str = "Error for {key}: {error}",
                   key_col: str | None = None) -> DataFrame:
    """Add ``out_col`` = fn(row as dict) for every row; an exception becomes
    ``error_format`` text. Rows are processed in Arrow batches per partition."""
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, T.StringType())])

    def run(batches):
        for pdf in batches:
            outs = []
            for rec in pdf[input_cols].to_dict("records"):
                try:
                    outs.append(str(fn(rec)))
                except Exception as e:  # noqa: BLE001 - captured as a value
                    outs.append(error_format.format(key=rec.get(key_col) if key_col else "", error=e))
            yield pdf.assign(**{out_col: outs})

    return df.mapInPandas(run, schema)


def apply_group_hook(df: DataFrame, fn: Callable[[object, list[dict], int], str], group_col: str, n: int,
                     columns: list[str], order: list | None = None, out_col: str = "result",
                     error_format: str = "Error for {key}: {error}") -> DataFrame:
    """UD3: one row per non-NULL group: the group, ``n_rows`` and ``out_col`` = fn(group, rows, n_rows).

    ``rows`` are the group's first ``n`` rows by ascending ``order`` (default: newest first), as
    dicts of ``columns``; ``n_rows`` counts all of them. An exception becomes ``error_format``
    text, a NULL result stays NULL."""
    kind = df.schema[group_col].dataType
    top = DG.top_rows("_rows", order or DG.newest_first(df), n, *columns)
    groups = (df.where(F.col(group_col).isNotNull()).groupBy(group_col)
              .agg(F.count(F.lit(1)).alias("n_rows"), top).select(group_col, "n_rows", "_rows"))
    schema = T.StructType([T.StructField(group_col, kind), T.StructField("n_rows", T.LongType()),
                           T.StructField(out_col, T.StringType())])

    def run(batches):
        for batch in batches:
            outs = []
            for key, count, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                try:
                    got = fn(key, rows, count)
                    outs.append(None if got is None else str(got))
                except Exception as e:  # noqa: BLE001 - captured as a value
                    outs.append(error_format.format(key=key, error=e))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(outs, pa.string())],
                                             names=[group_col, "n_rows", out_col])

    return groups.mapInArrow(run, schema)


def narrate(prompts: DataFrame, generate: Callable[[str], str], risk_col: str = "risk_id") -> DataFrame:
    """Narrative per risk from its prompt row (``generate(prompt) -> text``)."""
    return apply_row_hook(prompts, lambda r: generate(r["prompt"]), ["prompt", risk_col], "narrative",
                          "Error generating narrative for Risk ID {key}: {error}", risk_col)
