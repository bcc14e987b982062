"""Lexicon tables for the sentiment job.

Users supply their own (token, valence) / (token, weight) / (token) tables as
CSV or Parquet; a small self-written default set is shipped so the jobs run
out of the box. Valences are on the usual -4 .. +4 scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskfeed.operators.sentiment import Lexicon

# Self-written default word lists (not taken from any published lexicon).
DEFAULT_VALENCES = (
    ("attack", -2.5), ("breach", -2.4), ("collapse", -2.8), ("crisis", -2.7), ("damage", -2.1),
    ("decline", -1.6), ("default", -2.0), ("disruption", -1.9), ("failure", -2.3), ("fraud", -2.9),
    ("loss", -1.9), ("outage", -1.8), ("penalty", -1.7), ("risk", -1.1), ("shortage", -1.7),
    ("threat", -2.2), ("violation", -2.0), ("vulnerable", -1.8), ("warning", -1.4), ("weak", -1.5),
    ("benefit", 1.8), ("boost", 1.7), ("gain", 1.6), ("growth", 1.9), ("improve", 1.8),
    ("positive", 2.0), ("recovery", 1.8), ("resilient", 1.9), ("secure", 1.6), ("stable", 1.5),
    ("strong", 1.7), ("success", 2.4), ("support", 1.6), ("win", 2.2), ("good", 1.9),
    ("bad", -2.5), ("great", 3.1), ("terrible", -3.1), ("safe", 1.9), ("unsafe", -2.1),
)
DEFAULT_BOOSTERS = (
    ("very", 0.293), ("extremely", 0.293), ("highly", 0.293), ("significantly", 0.293),
    ("slightly", -0.293), ("somewhat", -0.293), ("barely", -0.293),
)
DEFAULT_NEGATIONS = ("not", "no", "never", "without", "cannot", "isn't", "wasn't", "don't")
DEFAULT_CONTRASTS = ("but",)


def default_lexicon(spark: SparkSession) -> Lexicon:
    return Lexicon(
        spark.createDataFrame(list(DEFAULT_VALENCES), "token string, valence double"),
        spark.createDataFrame(list(DEFAULT_BOOSTERS), "token string, weight double"),
        spark.createDataFrame([(t,) for t in DEFAULT_NEGATIONS], "token string"),
        spark.createDataFrame([(t,) for t in DEFAULT_CONTRASTS], "token string"),
    )


def _read(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", False).csv(path)
    return spark.read.parquet(path)


def read_lexicon(spark: SparkSession, valences: str, boosters: str | None = None,
                 negations: str | None = None, contrasts: str | None = None) -> Lexicon:
    """User lexicon from files (CSV with header or Parquet); missing parts fall
    back to the defaults."""
    d = default_lexicon(spark)
    return Lexicon(
        _read(spark, valences).selectExpr("token", "CAST(valence AS DOUBLE) AS valence"),
        _read(spark, boosters).selectExpr("token", "CAST(weight AS DOUBLE) AS weight") if boosters else d.boosters,
        _read(spark, negations).select("token") if negations else d.negations,
        _read(spark, contrasts).select("token") if contrasts else d.contrasts,
    )
