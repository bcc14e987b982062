"""Dimension sources: the encoded term dictionary and the allow / block lists."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfeed.functions.terms import decode_term, to_int_or_null
from riskfeed.functions.text import normalize_name

RISK_ID_COLUMNS = {"enterprise": "ENTERPRISE_RISK_ID", "emerging": "EMERGING_RISK_ID"}

TERMS_SCHEMA = T.StructType([
    T.StructField("risk_id", T.IntegerType()),
    T.StructField("search_term_id", T.IntegerType()),
    T.StructField("encoded_terms", T.StringType()),
])
NAME_SCHEMA = T.StructType([T.StructField("name", T.StringType())])


def read_terms(spark: SparkSession, path: str, risk_set: str = "enterprise") -> DataFrame:
    """SRC1: term CSV (header) -> (risk_id, search_term_id, encoded_terms).

    Every column is read as a string (encoded terms exceed any numeric type),
    the three used columns are projected by name, ids are coerced to INT.
    A missing file is an error.
    """
    if not os.path.exists(path) and "://" not in path:
        raise FileNotFoundError(path)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    rid = RISK_ID_COLUMNS[risk_set]
    return raw.select(
        to_int_or_null(rid).alias("risk_id"),
        to_int_or_null("SEARCH_TERM_ID").alias("search_term_id"),
        F.col("ENCODED_TERMS").alias("encoded_terms"),
    )


def decode_dictionary(terms: DataFrame) -> DataFrame:
    """FN1 on the dictionary: adds ``search_terms`` (NULL when not decodable)."""
    return terms.withColumn("search_terms", decode_term("encoded_terms"))


def read_source_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: first column whatever its header, lower + strip, non-null, distinct.
    A missing file is an empty list."""
    if "://" not in path and not os.path.exists(path):
        return spark.createDataFrame([], NAME_SCHEMA)
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    return normalize_list(raw.select(F.col(raw.columns[0]).alias("name")))


def normalize_list(names: DataFrame, col: str = "name") -> DataFrame:
    """lower, strip, drop NULL, distinct -> single column ``name``."""
    return (names.select(normalize_name(F.col(col)).alias("name"))
            .where(F.col("name").isNotNull())
            .distinct())
