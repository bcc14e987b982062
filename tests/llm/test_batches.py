"""Arrow batches of the operators stay small however long the texts are."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskfeed.llm import common, language_id, quality


@pytest.fixture
def setting(spark):
    before = spark.conf.get(common._BATCH_BYTES)
    yield lambda value: spark.conf.set(common._BATCH_BYTES, value)
    spark.conf.set(common._BATCH_BYTES, before)


def _largest(docs):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    return common.stage(docs.mapInArrow(sizes, "n long"), "test-batches").agg(F.max("n")).first()[0]


def test_long_texts_make_small_batches(spark, setting):
    setting("64m")
    text = F.concat(F.col("id").cast("string"), F.lit(" "), F.repeat(F.lit("abcdefghi "), 20_000))
    docs = spark.range(0, 100, 1, 1).select(text.alias("text"))  # 20 MB in one task
    assert 0 < _largest(docs) < 2 * common.BATCH_BYTES


def test_last_steps_are_bounded_too(spark, docs_of, setting):
    """predict and keep_good run when their result is read, after the operator's own stages."""
    docs = docs_of([(i, f"text number {i}") for i in range(5)])
    steps = (lambda: language_id.predict(docs, language_id.fit(docs)), lambda: quality.classify(docs, quality.QualityModel()),
             lambda: quality.keep_good(docs, quality.QualityModel()))
    for step in steps:
        setting("64m")
        assert step().count() >= 0
        assert common._bytes(spark.conf.get(common._BATCH_BYTES)) == common.BATCH_BYTES


@pytest.mark.parametrize("value,left", [("1m", "1m"), ("4096", "4096"), ("64MB", str(4 << 20))])
def test_a_smaller_setting_stays(spark, setting, value, left):
    setting(value)
    common.bound_batches(spark)
    assert spark.conf.get(common._BATCH_BYTES) in (left, f"{left}b", str(common._bytes(left)), f"{common._bytes(left)}b")
