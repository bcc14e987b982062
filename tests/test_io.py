"""Sources and sinks on small files: term CSV (CRLF, big encoded ids), source
lists (BOM header, missing file), versioned store, archive, CSV export,
narratives, backfill publish, observed run metrics, row hooks."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskfeed import sinks
from riskfeed.operators import digest as DG
from riskfeed.operators import hooks
from riskfeed.sources import lists
from riskfeed.sources.feed import MENTION_SCHEMA, read_mentions
from tests.conftest import SF_SMALL


def test_read_terms_csv(spark, tmp_path):
    p = tmp_path / "terms.csv"
    p.write_bytes(b"ENTERPRISE_RISK_ID,SEARCH_TERM_ID,ENCODED_TERMS,EXTRA\r\n"
                  b"1,5,28554735588761933,x\r\n2,10,32497601315368770,y\r\n"
                  b"x,11,65279,z\r\n3,12,2037169923880594599529,w\r\n")
    d = lists.decode_dictionary(lists.read_terms(spark, str(p), "enterprise"))
    got = sorted((r["search_term_id"], r["risk_id"], r["search_terms"]) for r in d.collect())
    assert got == [(5, 1, "Malware"), (10, 2, "Botnets"), (11, None, None), (12, 3, "inflation")]
    assert d.columns == ["risk_id", "search_term_id", "encoded_terms", "search_terms"]


def test_read_source_list(spark, tmp_path):
    p = tmp_path / "out.csv"
    p.write_bytes("﻿SOURCE_NAME\n AOL \naol\nReuters\n\n".encode("utf-8"))
    got = sorted(r["name"] for r in lists.read_source_list(spark, str(p)).collect())
    assert got == ["aol", "reuters"]
    assert lists.read_source_list(spark, str(tmp_path / "missing.csv")).count() == 0


def _mentions(spark):
    rows = [(1, 1, "t1", "s1", [], dt.date(2025, 9, 10), "l1", "src", "x.com", "neutral", 0.0,
             dt.datetime(2025, 9, 11, 10, 0, 0)),
            (1, 1, "t2", "s2", [], dt.date(2025, 5, 1), "l2", "src", "x.com", "positive", 0.5,
             dt.datetime(2025, 9, 11, 10, 0, 0))]
    return spark.createDataFrame(rows, MENTION_SCHEMA)


def test_versioned_store_archive_export(spark, tmp_path):
    from riskfeed.operators import store as ST
    m = _mentions(spark)
    cur, old = ST.window_split(m, "2025-09-11 10:00:00", 120)
    root = str(tmp_path / "store")
    v1 = sinks.write_current(cur, root)
    assert sinks.current_version(spark, root) == v1
    v2 = sinks.write_current(cur.union(cur.limit(0)), root)
    assert v2 != v1 and sinks.current_version(spark, root) == v2
    assert [r["link"] for r in sinks.read_current(spark, root).collect()] == ["l1"]
    for run in ("2025-09-11 10:00:00", "2025-09-12 10:00:00", "2025-09-12 10:00:00"):
        sinks.write_archive(old, str(tmp_path / "archive"), run)
    assert sinks.read_archive(spark, str(tmp_path / "archive")).count() == 2  # a repeated run replaces its rows
    assert sinks.read_archive(spark, str(tmp_path / "archive"), latest_run_only=True).count() == 1
    assert sinks.read_archive(spark, str(tmp_path / "no-archive")) is None
    sinks.export_csv(cur, str(tmp_path / "csv"))
    back = read_mentions(spark, str(tmp_path / "csv"), fmt="csv")
    assert back.first()["link"] == "l1"
    assert read_mentions(spark, str(tmp_path / "none")).count() == 0


def test_narratives_and_hook(spark, tmp_path):
    d = spark.createDataFrame([(3, 7, "- a...")], "risk_id int, article_count bigint, sample_content string")
    prompts = DG.risk_prompt(d)

    def gen(prompt):
        if "EMERGING RISK ID: 3" in prompt:
            raise RuntimeError("quota")
        return "ok"

    out = hooks.narrate(prompts, gen).first()
    assert out["narrative"] == "Error generating narrative for Risk ID 3: quota"
    sinks.write_narratives(prompts, str(tmp_path / "narr"), "2025-09-11 10:00:00")
    sinks.write_narratives(prompts, str(tmp_path / "narr"), "2025-09-12 10:00:00")
    assert spark.read.parquet(str(tmp_path / "narr" / "history")).count() == 2
    assert spark.read.parquet(str(tmp_path / "narr" / "latest")).count() == 1


def test_backfill_publish_only_when_changed(spark, tmp_path):
    unchanged = _mentions(spark).withColumn("backfilled", F.lit(False))
    assert sinks.publish_backfill(unchanged, str(tmp_path / "s")) is None
    changed = _mentions(spark).withColumn("backfilled", F.col("link") == "l1")
    assert sinks.publish_backfill(changed, str(tmp_path / "s")) is not None


def test_daily_run_observed_metrics(spark):
    from riskfeed.plans import daily
    from riskfeed.sources import binding as B
    obs = Observation("daily")
    p = daily.DailyParams(as_of=B.AS_OF, max_items_per_term=B.TEST_ITEMS_PER_TERM,
                          window_days=B.TEST_WINDOW_DAYS)
    cur, _ = daily.run(B.raw_items(spark, SF_SMALL), B.dictionary(spark), B.pages(spark, SF_SMALL),
                       B.block_list(spark), B.allow_list(spark), B.lexicon(spark), None, p, obs)
    n = cur.count()
    m = obs.get
    assert m["new_rows"] >= n > 0 and m["new_null_dates"] == 0


def test_changed_dictionary_file_is_reread(spark, tmp_path):
    from riskfeed.operators import gates as G
    from riskfeed.operators import score as Q
    from riskfeed.operators.common import clear_memo
    p = tmp_path / "t.csv"

    def terms_of(word):
        p.write_text(f"ENTERPRISE_RISK_ID,SEARCH_TERM_ID,ENCODED_TERMS\n1,1,{int.from_bytes(word.encode(), 'little')}\n")
        clear_memo()
        terms = G.valid_terms(lists.decode_dictionary(lists.read_terms(spark, str(p))))
        text = spark.range(1).select(F.lit("a malware note").alias("x"))
        return Q.term_flag(text, ["x"], terms, "hit").first()["hit"]

    assert terms_of("malware") is True
    assert terms_of("botnet") is False


def test_group_hook_sees_a_bounded_part_of_a_hot_group(spark):
    """Half of all rows are one group; the function gets its newest rows and its whole count."""
    import datetime as dt

    from riskfeed.operators import digest as DG
    day = dt.date(2025, 9, 1)
    rows = [(7, day + dt.timedelta(days=i % 50), f"l{i}", f"t{i}") for i in range(500)]
    rows += [(i % 100 + 10, None if i % 2 else day, f"k{i}", None) for i in range(498)] + [(None, day, "x", "x"), (5, day, "a", "a")]
    df = spark.createDataFrame(rows, "risk_id int, published_date date, link string, title string").repartition(8)

    def brief(key, got, n):
        assert len(got) <= 4
        if key == 5:
            raise ValueError("broken")
        return None if key == 10 else f"{n}:" + ",".join(str(r["title"]) for r in got)

    out = hooks.apply_group_hook(df, brief, "risk_id", 4, ["title", "link"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_top_k" in plan and "Window" not in plan
    got = {r["risk_id"]: (r["n_rows"], r["result"]) for r in out.collect()}
    newest = sorted(f"l{i}" for i in range(500) if i % 50 == 49)[:4]
    assert got[7] == (500, "500:" + ",".join("t" + x[1:] for x in newest))
    assert got[5] == (1, "Error for 5: broken") and got[10][1] is None and None not in got and len(got) == 102
    assert hooks.apply_group_hook(df.limit(0), brief, "risk_id", 4, ["title"]).collect() == []


def test_digest_reads_its_input_once(spark, tmp_path):
    import datetime as dt

    from riskfeed.operators import digest as DG
    day = dt.date(2025, 9, 1)
    spark.createDataFrame([(1, day, "l", "t")] * 20 + [(2, None, "m", None)],
                          "risk_id int, published_date date, link string, title string").write.parquet(str(tmp_path / "m"))
    out = DG.risk_digest(spark.read.parquet(str(tmp_path / "m")), "risk_id", "title")
    assert {r["risk_id"]: (r["article_count"], r["sample_content"].count("- t...")) for r in out.collect()} == {1: (20, 5), 2: (1, 0)}
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial")[0].count("FileScan parquet") == 1
