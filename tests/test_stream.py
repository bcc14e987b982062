"""Streaming ingest: two landed drops through one checkpointed query equal a
batch pass; re-running without new files adds nothing."""

from riskfeed.plans import queries as Qs
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    import __spark_entry__ as E
    from tests.oracle_check import compare, duck
    ok, msg, _, _ = compare(spark, duck(SF_SMALL), "stream_ingest", Qs.stream_ingest,
                            E.oracle_sql()["stream_ingest"], SF_SMALL)
    assert ok, msg


def test_rerun_adds_nothing(spark, tmp_path):
    from riskfeed.sources import binding as B
    from riskfeed.sources.feed import write_feed
    from riskfeed.streaming.ingest import ingest_stream, read_store
    write_feed(B.raw_items(spark, SF_SMALL), str(tmp_path / "landing" / "drop=0"))
    for _ in range(2):
        ingest_stream(spark, str(tmp_path / "landing"), str(tmp_path / "store"), str(tmp_path / "ckpt"),
                      B.block_list(spark)).awaitTermination()
    store = read_store(spark, str(tmp_path / "store"))
    assert store.count() == store.select("link").distinct().count() > 0


def _land(spark, tmp_path, drop, numbers, **more):
    from riskfeed.sources.feed import write_feed
    from riskfeed.streaming.ingest import ingest_stream
    cols = "term string, result_page int, feed_pos long, item_id long, title string, feed_link string, " \
           "source_name string, pub_date_raw string"
    write_feed(spark.createDataFrame([("a", 1, i, i, f"t{x}", f"https://x.com/{x}", "S", "Wed, 10 Sep 2025 08:00:00 GMT")
                                      for i, x in enumerate(numbers)], cols), f"{tmp_path}/landing/drop={drop}")
    ingest_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/store", f"{tmp_path}/ckpt",
                  spark.createDataFrame([], "name string"), **more).awaitTermination()


def test_a_batch_reads_only_the_buckets_it_touches(spark, tmp_path, monkeypatch):
    """The second drop reads neither the stored rows nor the links of other buckets."""
    from riskfeed.streaming import ingest
    store = f"{tmp_path}/store"
    _land(spark, tmp_path, 0, range(400))
    batch = spark.createDataFrame([("https://x.com/7",), ("https://x.com/1000",)], "link string")
    buckets = {r[0] for r in batch.select(ingest._bucket()).collect()}
    seen = ingest.seen_links(spark, store, batch, 99)
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in seen.inputFiles()} <= buckets
    assert "https://x.com/7" in {r["link"] for r in seen.collect()} and seen.count() < 40
    assert ingest.seen_links(spark, store, batch, 0).count() == 0  # an epoch doesn't see itself

    reads = []
    monkeypatch.setattr(ingest, "read_store", lambda *a: reads.append(a))
    _land(spark, tmp_path, 1, [7, 1000, 1000])
    monkeypatch.undo()
    assert not reads
    links = [r["link"] for r in ingest.read_store(spark, store).collect()]
    assert len(links) == len(set(links)) == 401


def test_a_retried_epoch_replaces_its_links(spark, tmp_path):
    from riskfeed.streaming import ingest
    rows = spark.createDataFrame([(f"l{i}", 3) for i in range(50)], "link string, epoch long")
    for _ in range(2):
        ingest.write_links(rows, f"{tmp_path}/s")
    assert ingest.seen_links(spark, f"{tmp_path}/s", rows, 4).count() == 50


def test_a_store_without_an_index_gets_one(spark, tmp_path, monkeypatch):
    from riskfeed.streaming import ingest
    monkeypatch.setattr(ingest, "write_links", lambda *a: None)
    _land(spark, tmp_path, 0, range(5))
    monkeypatch.undo()
    _land(spark, tmp_path, 1, [3, 9])
    assert ingest.read_store(spark, f"{tmp_path}/store").count() == 6


def test_future_late_and_repeated_items(spark, tmp_path):
    """One item dated far ahead neither stops the stream nor hides later items."""
    import datetime as dt

    from riskfeed.sources.feed import write_feed
    from riskfeed.streaming.ingest import ingest_stream, read_store

    def land(drop, rows):
        cols = "term string, result_page int, feed_pos long, item_id long, title string, feed_link string, " \
               "source_name string, pub_date_raw string"
        write_feed(spark.createDataFrame([("a b", 1, i, i, f"t{x}", f"https://x.com/{x}", "S", d)
                                          for i, (x, d) in enumerate(rows)], cols), f"{tmp_path}/landing/drop={drop}")
        ingest_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/store", f"{tmp_path}/ckpt",
                      spark.createDataFrame([], "name string"), as_of="2025-09-10", recency_days=1).awaitTermination()

    land(0, [(1, "Wed, 10 Sep 2025 08:00:00 GMT"), (2, "Thu, 10 Sep 2099 08:00:00 GMT"), (1, "Wed, 10 Sep 2025 09:00:00 GMT")])
    land(1, [(3, "Thu, 11 Sep 2025 08:00:00 GMT"), (4, "Tue, 09 Sep 2025 08:00:00 GMT"),   # late, inside the gate
             (5, "Sun, 07 Sep 2025 08:00:00 GMT"), (1, "Thu, 11 Sep 2025 08:00:00 GMT"), (6, "no date")])
    got = sorted((r["title"], r["published_date"], r["term"], r["sentiment"]) for r in
                 read_store(spark, f"{tmp_path}/store").collect())
    day = lambda y, d: dt.date(y, 9, d)
    assert got == [("t1", day(2025, 10), "a b", "neutral"), ("t2", day(2099, 10), "a b", "neutral"),
                   ("t3", day(2025, 11), "a b", "neutral"), ("t4", day(2025, 9), "a b", "neutral")]


def test_the_drops_do_not_scan_the_events_again(spark, monkeypatch):
    """Dates are parsed once, by all tasks: neither drop reads the tables or parses a date."""
    from riskfeed.sources import feed
    plans, write = [], feed.write_feed

    def seen(raw, *a, **k):
        plans.append(raw._jdf.queryExecution().optimizedPlan().toString())
        write(raw, *a, **k)
    monkeypatch.setattr(feed, "write_feed", seen)
    assert Qs.stream_ingest(spark, SF_SMALL).count() > 0
    assert len(plans) == 2
    for p in plans:
        assert "Relation" not in p and "regexp" not in p.lower() and "_day" in p
