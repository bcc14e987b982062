"""Landed feed files read in pieces: the same items as of files parsed whole, and no row that holds a file."""

import pytest
from pyspark.sql import functions as F

from riskfeed.plans import queries as Qs
from riskfeed.sources import feed as FD
from tests.conftest import SF_SMALL

ITEM = "<item><title>t{0}</title><link>https://x.com/{0}</link><source url='https://s.com'>S</source></item>"
MANY = "\n".join(ITEM.format(i) for i in range(200))
FILES = {
    "many": f"<?xml version='1.0'?>\n<rss><channel><title>c</title>\n{MANY}\n</channel></rss>\n",
    "cut": f"<channel>{MANY}</channel>"[:9000],
    "cut_after_item": f"<channel>{MANY}",
    "cut_in_name": f"<channel>{ITEM.format(1)}<item",
    "bad_inside": f"<channel>{MANY.replace('t99<', '<b><')}</channel>",
    "marked": f"<channel>{MANY.replace('t99<', '<![CDATA[<item>]]><')}</channel>",
    "comment": f"<channel><!-- <item> -->{ITEM.format(1)}<!-- x --></channel>",
    "nested": f"<channel><item><title>o</title>{ITEM.format(1)}</item>{ITEM.format(2)}</channel>",
    "two_channels": f"<rss><channel>{ITEM.format(1)}</channel><channel>{ITEM.format(2)}</channel></rss>",
    "after_end": f"<channel>{ITEM.format(1)}</channel>{ITEM.format(2)}",
    "other_tag": f"<channel><items>q</items>{ITEM.format(1)}<item/></channel>",
    "only_item": ITEM.format(1), "no_item": "<channel></channel>", "text": "hello", "cut_early": "<channel><tit",
}


@pytest.fixture
def root(tmp_path):
    for name, text in FILES.items():
        d = tmp_path / f"term={name}" / "result_page=1"
        d.mkdir(parents=True)
        (d / "a.xml").write_text(text)
    return str(tmp_path)


@pytest.mark.parametrize("split", [600, 1 << 27])
def test_pieces_give_the_items_of_whole_files(spark, root, split):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        longest = FD.landed_pieces(spark, root).agg(F.max(F.length("value"))).first()[0]
        feed = FD.Feed(spark, root)
        got = sorted(map(str, FD.read_feed(spark, feed).collect()))
        bad = sorted(map(tuple, FD.unreadable_files(feed).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert longest < 200
    files = FD.landed_files(spark, root)
    assert got == sorted(map(str, FD.feed_to_raw_items(files).select(FD.read_feed(spark, feed).columns).collect()))
    want = files.select("path", F.octet_length("value").cast("long").alias("n"), F.substring("value", 1, 200).alias("head"),
                        "value", FD._parsed().alias("x")).where(FD._unreadable()).select("path", "n", "head")
    assert bad == sorted(map(tuple, want.collect()))
    assert FD.count_files(feed) == {"landed_files": len(FILES), "unreadable_files": len(bad)}


@pytest.mark.parametrize("name", ["feed_items", "feed_quarantine"])
def test_no_row_holds_a_file(spark, monkeypatch, name):
    def whole(*_):
        raise AssertionError("a file in one row")
    monkeypatch.setattr(FD, "landed_files", whole)
    rows = Qs.queries()[name](spark, SF_SMALL).collect()
    assert len(rows) == (1000 if name == "feed_items" else 5)
    if name == "feed_quarantine":
        assert all(r["unreadable"] == 1 for r in rows) and sum(r["items"] for r in rows) == 1000
