"""Properties from the test strategy: window split partitions the rows, gates
commute, scores stay in range on real data."""

from pyspark.sql import functions as F

from riskfeed.operators import gates as G
from riskfeed.operators import store as ST
from riskfeed.plans import queries as Qs
from riskfeed.sources import binding as B
from tests.conftest import SF_SMALL


def test_window_split_partitions_rows(spark):
    items = Qs.items(spark, SF_SMALL)
    cur, old = ST.window_split(items, B.AS_OF, B.TEST_WINDOW_DAYS)
    nulls = items.where(F.col("published_date").isNull())
    assert cur.count() + old.count() + nulls.count() == items.count()
    assert cur.join(old, "item_id").count() == 0


def test_gates_commute(spark):
    items = Qs.items(spark, SF_SMALL)
    block = B.block_list(spark)
    stored = items.where(F.col("term") == "view")
    a = G.top_k_per_term(G.link_gates(items, block, G.existing_links(stored)), 50)
    blk = F.broadcast(block.select(F.col("name").alias("_b")))
    b0 = items.join(G.existing_links(stored).select(F.col("link").alias("_s")),
                    items["link"] == F.col("_s"), "left_anti")
    b1 = b0.join(blk, b0["source"] == blk["_b"], "left_anti")
    b = G.top_k_per_term(G.link_gates(b1), 50)
    ids = lambda d: sorted(r[0] for r in d.select("item_id").collect())
    assert ids(a) == ids(b)


def test_scores_in_range_on_pages(spark):
    s = Qs.scored_pages(spark, SF_SMALL)
    bad = s.where((F.col("quality_score") < 0) | (F.col("quality_score") > 6)).count()
    assert bad == 0 and s.count() > 0
