"""Literal arrays from driver-side values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEP = "\u0001"


def string_array_literal(values: list[str]) -> Column:
    """Array literal of strings built from one joined string split at plan time
    (constant-folded), instead of one expression per element."""
    if not values:
        return F.array().cast("array<string>")
    if any(v is None or _SEP in v for v in values):
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")
    return F.split(F.lit(_SEP.join(values)), _SEP, -1)


def double_array_literal(values: list[float]) -> Column:
    if not values:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",", -1).cast("array<double>")
