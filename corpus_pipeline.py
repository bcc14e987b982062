"""The training-data pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Training uses the stage's own input, so that each stage is complete
by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeed.llm import decontaminate, jaccard_join, mix_sources, quality, token_output
from riskfeed.llm.common import stage
from riskfeed.llm.queries import tokenizer_path
from riskfeed.sources.tables import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents of low quality or with abuse go."""
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9 on five-word shingles: of documents connected by a similarity of 0.8 or more
    the one with the smallest doc_id stays."""
    return jaccard_join.one_per_class(docs, n=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: each document as often as the mix takes it, so not at all, once or up to
    three times."""
    return mix_sources.emit_copies(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token shards in ascending doc_id order; per document where its ids are."""
    return token_output.token_output(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources", mix),
    ("token-ID output", to_tokens),
]

# the classifier, the shingle components and the tokenizer have no SQL form;
# tests/llm/test_pipeline.py compares the rows with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{i + 1}")
    return docs
