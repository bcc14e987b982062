"""The three file-based jobs end to end on files derived from sf0.001:
re-running the daily job on the same feed adds nothing; backfill and digest
run on the published store."""

from riskfeed.plans import daily, jobs
from riskfeed.sources import binding as B
from riskfeed.sources.feed import write_feed
from tests.conftest import SF_SMALL


def _inputs(spark, tmp_path):
    terms = tmp_path / "terms.csv"
    lines = ["ENTERPRISE_RISK_ID,SEARCH_TERM_ID,ENCODED_TERMS"]
    for r, s, t, raw in B.TEST_DICTIONARY:
        enc = raw if raw is not None else str(int.from_bytes(t.encode("utf-8"), "little"))
        lines.append(f"{r},{s},{enc}")
    terms.write_text("\r\n".join(lines) + "\r\n")
    block = tmp_path / "block.csv"
    block.write_text("SOURCE_NAME\n" + "\n".join(B.TEST_BLOCK_LIST) + "\n")
    allow = tmp_path / "allow.csv"
    allow.write_text("SOURCE_NAME\n" + "\n".join(B.TEST_ALLOW_LIST) + "\n")
    feed = tmp_path / "feed"
    write_feed(B.raw_items(spark, SF_SMALL), str(feed))
    return jobs.DailyInputs(str(terms), str(feed), f"{SF_SMALL}/pages.parquet", str(tmp_path / "store"),
                            str(tmp_path / "archive"), str(block), str(allow))


def test_daily_rerun_adds_nothing_then_backfill_and_digest(spark, tmp_path):
    inp = _inputs(spark, tmp_path)
    p = daily.DailyParams(as_of=B.AS_OF, max_items_per_term=B.TEST_ITEMS_PER_TERM,
                          window_days=B.TEST_WINDOW_DAYS)
    first = jobs.daily_job(spark, inp, p, export_csv=str(tmp_path / "export"), append_only=False)
    assert first["current_rows"] > 0 and first["new_rows"] > 0
    second = jobs.daily_job(spark, inp, p, append_only=False)
    assert second["new_rows"] == 0
    assert second["current_rows"] == first["current_rows"] == second["stored_rows"]
    jobs.backfill_job(spark, inp.store_root, inp.pages, B.AS_OF, "2024-01-01", "2024-01-31", append_only=False)
    n = jobs.digest_job(spark, inp.store_root, str(tmp_path / "digest"), B.AS_OF, append_only=False)
    assert n > 0
    assert spark.read.option("header", True).csv(str(tmp_path / "export")).count() == first["current_rows"]


def test_append_only_store_matches_versioned(spark, tmp_path):
    import dataclasses
    inp = _inputs(spark, tmp_path)
    p = daily.DailyParams(as_of=B.AS_OF, max_items_per_term=B.TEST_ITEMS_PER_TERM,
                          window_days=B.TEST_WINDOW_DAYS)
    versioned = jobs.daily_job(spark, inp, p, append_only=False)
    app = dataclasses.replace(inp, store_root=str(tmp_path / "append"))
    a1 = jobs.daily_job(spark, app, p)
    a2 = jobs.daily_job(spark, app, p)
    assert a1["current_rows"] == versioned["current_rows"] == a2["current_rows"]
    assert a2["new_rows"] == 0
    digests = []
    for root, flag in ((inp.store_root, ["--versioned"]), (app.store_root, [])):
        out = f"{tmp_path}/digest-{len(digests)}"
        jobs.main(["digest", "--store-root", root, "--out-root", out, "--as-of", B.AS_OF, *flag])
        digests.append(sorted(tuple(r) for r in spark.read.parquet(f"{out}/latest").collect()))
    assert digests[0] == digests[1] != []


def test_unreadable_feed_files_are_counted_and_listed(spark, tmp_path):
    """Three files, one of them cut off: its path is in the quarantine, the others' items are kept."""
    import dataclasses
    inp = dataclasses.replace(_inputs(spark, tmp_path), quarantine=str(tmp_path / "quarantine"))
    feed = tmp_path / "feed3" / "term=click" / "result_page=1"
    feed.mkdir(parents=True)
    item = "<item><title>t{0}</title><link>https://x.com/{0}</link><pubDate>Tue, 30 Jan 2024 08:00:00 GMT</pubDate>" \
           "<source url='https://x.com'>S</source></item>"
    (feed / "a.xml").write_text(f"<channel>{item.format(1)}{item.format(2)}</channel>")
    (feed / "b.xml").write_text(f"<channel>{item.format(3)}<item><title>t4</tit")
    (feed / "c.xml").write_text(f"<rss><channel>{item.format(5)}</channel></rss>")
    (feed / "d.xml").write_text("<channel></channel>")  # readable, without items
    p = daily.DailyParams(as_of=B.AS_OF, window_days=B.TEST_WINDOW_DAYS)
    audit = jobs.daily_job(spark, dataclasses.replace(inp, feed_root=str(tmp_path / "feed3")), p)
    assert (audit["landed_files"], audit["unreadable_files"]) == (4, 1)
    listed = spark.read.parquet(f"{inp.quarantine}/run=*").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in listed] == ["b.xml"] and listed[0]["n_bytes"] > 0
    from riskfeed import sinks
    assert {r["title"] for r in sinks.read_appended(spark, inp.store_root).collect()} == {"t1", "t2", "t5"}
    whole = jobs.daily_job(spark, inp, p)
    assert whole["unreadable_files"] == 0 and whole["landed_files"] > 4


def test_audit_counts_are_observed(spark, tmp_path, monkeypatch):
    """Both kinds of store: the audit's counts are right, and no count is run over the store."""
    import dataclasses

    from pyspark.sql import functions as F
    from riskfeed import sinks
    inp = _inputs(spark, tmp_path)
    frame = type(spark.range(1))
    count = frame.count

    def spy(self):
        assert not any(str(tmp_path / "store") in f or str(tmp_path / "app") in f for f in self.inputFiles())
        return count(self)

    for append_only, root in ((True, "app"), (False, "store")):
        run = dataclasses.replace(inp, store_root=str(tmp_path / root))
        audits = []
        for as_of in (B.EARLIER_AS_OF, B.AS_OF):
            p = daily.DailyParams(as_of=as_of, window_days=B.TEST_WINDOW_DAYS)
            with monkeypatch.context() as m:
                m.setattr(frame, "count", spy)
                audits.append(jobs.daily_job(spark, run, p, append_only=append_only))
        now = (sinks.read_window(spark, run.store_root, B.AS_OF, B.TEST_WINDOW_DAYS)[0] if append_only
               else sinks.read_current(spark, run.store_root))
        assert audits[0]["stored_rows"] == audits[0]["existing_links"] == 0 < audits[0]["new_rows"]
        assert audits[1]["current_rows"] == now.count()
        before = now.where(F.col("last_run_timestamp") == F.lit(B.EARLIER_AS_OF).cast("timestamp_ntz"))
        if append_only:
            assert audits[1]["stored_rows"] == before.count()
            assert audits[1]["existing_links"] == before.select("link").distinct().count()
        else:
            assert audits[1]["stored_rows"] == audits[0]["current_rows"]
        assert audits[1]["combined_rows"] == audits[1]["stored_rows"] + audits[1]["new_rows"]


def test_failed_archive_loses_no_row(spark, tmp_path, monkeypatch):
    """Aged rows are archived before the publish: a run that fails there can be repeated."""
    import dataclasses

    import pytest
    from riskfeed import sinks
    inp = dataclasses.replace(_inputs(spark, tmp_path), archive=str(tmp_path / "aged"))
    p = daily.DailyParams(as_of=B.EARLIER_AS_OF, window_days=B.TEST_WINDOW_DAYS)
    first = jobs.daily_job(spark, inp, p, append_only=False)
    later = dataclasses.replace(p, as_of="2024-02-20 00:00:00")
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_archive", lambda *a: (_ for _ in ()).throw(OSError("no space")))
        with pytest.raises(OSError):
            jobs.daily_job(spark, inp, later, append_only=False)
    again = jobs.daily_job(spark, inp, later, append_only=False)
    assert again["archived_rows"] == first["current_rows"] > 0
    assert sinks.read_archive(spark, inp.archive).count() == first["current_rows"]


def test_store_pointer_and_hot_date(spark, tmp_path):
    import os
    import shutil

    import pytest
    from pyspark.sql import functions as F
    from riskfeed import sinks
    rows = spark.range(0, 60_000, 1, 8).select(
        F.lit("2024-01-02").cast("date").alias("published_date"), F.sha2(F.col("id").cast("string"), 256).alias("link"),
        F.lit("t").alias("title"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        version = sinks.write_current(rows, str(tmp_path / "s"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{version}/published_date=2024-01-02") if f.endswith(".parquet")]
    assert len(files) > 1
    assert sinks.current_version(spark, str(tmp_path / "nothing")) is None
    shutil.copytree(version, f"{tmp_path}/lost/{os.path.basename(version)}")
    with pytest.raises(RuntimeError):
        sinks.current_version(spark, str(tmp_path / "lost"))


def test_backfill_overwrites_only_batch_dates(spark, tmp_path):
    import datetime as dt
    from pyspark.sql import functions as F
    from riskfeed import sinks
    store = B.docs_store(spark, SF_SMALL).drop("doc_id").withColumn("risk_id", F.lit(1))
    root = str(tmp_path / "app")
    sinks.append_new(store, root)
    before = {r["published_date"]: r["n"] for r in
              sinks.read_appended(spark, root).groupBy("published_date").agg(F.count("*").alias("n")).collect()}
    res = jobs.backfill_job(spark, root, f"{SF_SMALL}/pages.parquet", B.AS_OF,
                            *B.TEST_BACKFILL_RANGE, append_only=True)
    assert res is not None and res.startswith("dates:")
    after_df = sinks.read_appended(spark, root)
    after = {r["published_date"]: r["n"] for r in
             after_df.groupBy("published_date").agg(F.count("*").alias("n")).collect()}
    assert after == before                                  # no row lost or duplicated
    first, last = (dt.date.fromisoformat(x) for x in res[6:].split(".."))
    changed = after_df.where(F.col("last_run_timestamp").isNotNull()).select("published_date").distinct()
    assert all(first <= r[0] <= last for r in changed.collect()) and changed.count() > 0


def _stored(n, day, text="short"):
    import datetime as dt
    return [(1, f"t{i}", f"https://x.com/{i}", dt.date.fromisoformat(day), text, None, None, None) for i in n]


STORED = ("risk_id int, title string, link string, published_date date, summary string, sentiment string, "
          "polarity double, last_run_timestamp timestamp_ntz")


def _pages(spark, tmp_path, n):
    spark.createDataFrame([(i, f"https://x.com/{i}", f"<p>{'long enough text ' * 9}{i}</p>") for i in n],
                          "page_id int, url string, html string").write.parquet(str(tmp_path / "pages"))
    return str(tmp_path / "pages")


def test_interleaved_writers_lose_no_row(spark, tmp_path, monkeypatch):
    """A run publishes rows of the same dates while a backfill works on the version before."""
    from riskfeed import sinks
    pages, root = _pages(spark, tmp_path, range(6)), str(tmp_path / "s")
    old = spark.createDataFrame(_stored(range(4), "2025-04-02"), STORED)
    sinks.write_current(old, root)
    write, seen = sinks.write_current, []

    def faster(rows, where, based_on=None):
        if not seen:
            seen.append(based_on)
            write(old.union(spark.createDataFrame(_stored([9], "2025-04-02", "x" * 99), STORED)), where)
        return write(rows, where, based_on)

    monkeypatch.setattr(sinks, "write_current", faster)
    assert jobs.backfill_job(spark, root, pages, B.AS_OF, append_only=False) is not None
    monkeypatch.undo()
    got = {r["link"]: r["summary"] for r in sinks.read_current(spark, root).collect()}
    assert len(got) == 5 and got["https://x.com/9"] == "x" * 99
    assert all(got[f"https://x.com/{i}"].endswith(str(i)) for i in range(4))
    assert sinks.snapshot(spark, root).number == 3


def test_a_commit_number_is_taken_once(spark, tmp_path):
    import pytest

    from riskfeed import sinks
    rows, root = spark.createDataFrame(_stored(range(2), "2025-04-02"), STORED), str(tmp_path / "s")
    sinks.write_current(rows, root, 0)
    with pytest.raises(sinks.StoreConflict):
        sinks.write_current(rows.limit(0), root, 0)
    assert sinks.read_current(spark, root).count() == 2
    sinks.write_current(rows.limit(1), root)  # not based on anything: replaces what is live
    assert sinks.snapshot(spark, root).number == 2 and sinks.read_current(spark, root).count() == 1


def test_append_only_writers_lose_no_row(spark, tmp_path, monkeypatch):
    """Rows appended during a backfill stay; two backfills of one row leave the newer text."""
    from pyspark.sql import functions as F
    from riskfeed import sinks
    pages, root = _pages(spark, tmp_path, range(6)), str(tmp_path / "s")
    sinks.append_new(spark.createDataFrame(_stored(range(4), "2025-04-02"), STORED), root)
    update = sinks.append_updates

    def slower(rows, where):
        sinks.append_new(spark.createDataFrame(_stored([5, 9], "2025-04-02"), STORED), where)
        update(rows, where)

    monkeypatch.setattr(sinks, "append_updates", slower)
    assert jobs.backfill_job(spark, root, pages, B.AS_OF) == "dates:2025-03-31..2025-04-02"
    monkeypatch.undo()
    assert jobs.backfill_job(spark, root, pages, B.AS_OF) is not None  # now the row that came meanwhile
    assert jobs.backfill_job(spark, root, pages, B.AS_OF) is None      # the rest has no page
    again = spark.createDataFrame(_stored([1], "2025-04-02", "newer text"), STORED)
    sinks.append_updates(again.withColumn("sentiment", F.lit("neutral")), root)
    got = {r["link"]: r["summary"] for r in sinks.read_appended(spark, root).collect()}
    assert len(got) == 6 and got["https://x.com/1"] == "newer text" and got["https://x.com/9"] == "short"
    assert all(got[f"https://x.com/{i}"].endswith(str(i)) for i in (0, 2, 3, 5))
    assert {r["summary"] for r in sinks.read_appended(spark, root, updates=False).collect()} == {"short"}
    plan = sinks.read_appended(spark, root).where("published_date >= '2025-04-01'")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("PartitionFilters: [isnotnull(published_date") == 2  # rows and updates are pruned


def test_cli_digest_on_empty_store(spark, tmp_path, capsys):
    jobs.main(["digest", "--store-root", str(tmp_path / "none"), "--out-root", str(tmp_path / "out"),
               "--as-of", B.AS_OF])
    assert capsys.readouterr().out.strip().endswith("0")
