"""The pipeline's stages: each against its operator or brute force, and the whole run."""

from collections import Counter

import corpus_pipeline as CP
from riskfeed.llm import mix_sources as MX
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_quality_and_leaks import _brute_leaks
from tests.llm.test_token_operators import _expected_tokens


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert len(CP.STAGES) == 5 and CP.ORACLE_SQL is None

    good = CP.stage(CP.keep_quality(spark, docs, SF_SMALL), "t")
    assert good.columns == columns
    before, after = {d for d, _ in _rows(docs)}, {d for d, _ in _rows(good)}
    clean = {d for d in before if d in labels and labels[d]["quality"] == 1 and labels[d]["toxic"] == 0}
    assert len(clean - after) <= 0.02 * len(clean)
    junk = {d for d in before if d in labels and labels[d]["quality"] == 0}
    assert len(junk & after) <= 0.2 * len(junk)

    single = CP.stage(CP.drop_near_duplicates(spark, good, SF_SMALL), "t")
    assert single.columns == columns
    want = sorted(d for d, n, c in components(_rows(good), 5, 80) if n == 0 or d == c)
    assert sorted(d for d, _ in _rows(single)) == want

    safe = CP.stage(CP.drop_benchmark_leaks(spark, single, SF_SMALL), "t")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, _ in _brute_leaks(_rows(single), items)}
    assert safe.columns == columns and leaks
    assert sorted(d for d, _ in _rows(safe)) == sorted(d for d, _ in _rows(single) if d not in leaks)

    mixed = CP.stage(CP.mix(spark, safe, SF_SMALL), "t")
    assert mixed.columns == columns
    copies = {r["doc_id"]: r["copies"] for r in MX.mix_sources(safe).collect()}
    assert Counter(d for d, _ in _rows(mixed)) == Counter({d: c for d, c in copies.items() if c})

    tokens = CP.to_tokens(spark, mixed, SF_SMALL).collect()
    assert sorted((tuple(r) for r in tokens), key=lambda r: r[1]) == _expected_tokens(_rows(mixed))


def test_run_on_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert CP.run(spark, str(tmp_path)).count() == 0
