"""Truth tables for the scalar functions (FIXTURES sections 2, 3, 5, 6)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskfeed.functions import dates as D
from riskfeed.functions import terms as T
from riskfeed.functions import text as X
from riskfeed.operators import sentiment as S


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_decode_truth_table(spark):
    cases = [
        ("28554735588761933", "Malware"),
        ("32497601315368770", "Botnets"),
        ("465625826642", "REvil"),
        ("2037169923880594599529", "inflation"),
        ("65279", None),
        ("abc", None),
        (None, None),
        ("-5", None),
        ("0", ""),
    ]
    df = spark.createDataFrame(cases, "e string, want string")
    got = df.select("want", T.decode_term("e").alias("got")).collect()
    for r in got:
        assert r["got"] == r["want"]


def test_encoded_trailing_space_kept(spark):
    e = str(int.from_bytes("commercial real estate ".encode(), "little"))
    assert one(spark, T.decode_term("x"), e) == "commercial real estate "


@settings(max_examples=25, deadline=None)
@given(st.text(min_size=0, max_size=40).filter(lambda s: not s.endswith("\x00")))
def test_encode_decode_roundtrip(spark, s):
    got = spark.createDataFrame([(s,)], "x string").select(T.encode_term("x").alias("e")).select(
        "e", T.decode_term("e").alias("d")).first()
    assert got["e"] == str(int.from_bytes(s.encode("utf-8"), "little"))
    assert got["d"] == s


def test_to_int_or_null(spark):
    rows = spark.createDataFrame([("3",), ("3.0",), ("x",), (None,)], "x string").select(
        T.to_int_or_null("x").alias("r")).collect()
    assert [r["r"] for r in rows] == [3, 3, None, None]


def test_authority_and_domain(spark):
    assert one(spark, X.authority("x"), "https://a_b.example.com:443/x") == "a_b.example.com:443"
    assert one(spark, X.authority("x"), "https://x.com/a b|c") == "x.com"
    assert one(spark, X.authority("x"), "news.google.com") == ""
    assert one(spark, X.score_domain("x"), "news.google.com") == "news.google.com"
    assert one(spark, X.score_domain("x"), "http://example.com/x") == "example.com"
    assert one(spark, X.score_domain("x"), None) == ""


def test_normalize_link(spark):
    assert one(spark, X.normalize_name("x"), "HTTPS://X.com/New  ") == "https://x.com/new"


def test_source_site(spark):
    el = '<source url="https://www.reuters.com">Reuters</source>'
    assert one(spark, X.source_site("x"), el) == "https://www.reuters.com"
    assert one(spark, X.source_site("x"), "<source>none</source>") is None


def test_feed_dates(spark):
    cases = [("Mon, 01 Sep 2025 07:00:00 GMT", dt.date(2025, 9, 1)),
             ("Mon, 01 Sep 2025 23:30:00 -0500", dt.date(2025, 9, 1)),
             ("not a date", None), (None, None)]
    for raw, want in cases:
        assert one(spark, D.parse_pubdate("x"), raw) == want


def test_page_text_variants(spark):
    html = "<p> a </p><p></p><p>b</p>"
    assert one(spark, X.page_text("x"), html) == "a  b"
    assert one(spark, X.page_text_backfill("x"), html) == "a b"
    inline = "<p>x <b>y</b> z</p>"
    assert one(spark, X.page_text("x"), inline) == "x y z"
    assert one(spark, X.page_text_backfill("x"), inline) == "xyz"
    assert one(spark, X.page_text("x"), "<div>no paragraphs</div>") == ""
    scripted = '<script>var t="</p>";</script><p>kept &amp; decoded</p>'
    assert one(spark, X.page_text("x"), scripted) == "kept & decoded"


PARAGRAPHS = {  # html: live text, backfill text
    "<p>a<div>in</div>b</p>c": ("ainb", "ainb"),                      # a block inside stays inside
    "<div><p>one<blockquote> two </blockquote>three</div>four": ("one two three", "onetwothree"),  # ends with its parent
    "<p>a<p>b": ("a b", "a b"),                                       # unclosed: the next one closes it
    "<ul><li><p>a</li><li>x<p>b</li></ul>c": ("a b", "a b"),          # inside an item
    "<p>x <!-- </p> c --> y</p>z": ("x  y", "xy"),                    # a comment parts two text nodes
    "<p>a</span>b</p>": ("ab", "ab"),                                 # nothing open of that name
    "<b><p>x</b>y</p>": ("x", "x"),                                   # closed with the element around it
    '<p title="a>b">q<br/>r<img src=x>s</p>': ("qrs", "qrs"),         # void elements; '>' in a value
    "<P CLASS=x>up</P><pre>no</pre>": ("up", "up"),
    "<p>1 < 2 &amp;&lt;</p>": ("1 < 2 &<", "1 < 2 &<"),
    "<p>a<p": ("a<p", "a<p"),                                         # a tag without an end is text
    "": ("", ""), "</p></div>x": ("", ""), None: ("", ""),
}


def test_nested_paragraphs(spark):
    for html, (live, backfill) in PARAGRAPHS.items():
        assert one(spark, X.page_text("x"), html) == live, html
        assert one(spark, X.page_text_backfill("x"), html) == backfill, html


def test_paragraphs_are_those_of_a_parser(spark):
    """Random tag soup against a walk over the standard library's parser events."""
    import random
    from html.parser import HTMLParser

    class Walk(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open, self.found, self.now = [], [], None

        def handle_starttag(self, tag, attrs):
            if tag == "p":
                if "p" in self.open:
                    del self.open[self.open.index("p"):]
                self.now = []
                self.found.append(self.now)
            if tag != "br":
                self.open.append(tag)

        def handle_endtag(self, tag):
            if tag in self.open:
                while self.open.pop() != tag:
                    pass
                self.now = self.now if "p" in self.open else None

        def handle_data(self, data):
            if self.now is not None:
                self.now.append(data)

    rng = random.Random(3)
    soup = ["".join(rng.choice([f"<{n}>", f"</{n}>", f"t{i} "]) for i in range(rng.randrange(30))
                    for n in [rng.choice(["p", "p", "div", "b", "li", "br"])]) for _ in range(300)]
    want = []
    for html in soup:
        walk = Walk()
        walk.feed(html)
        walk.close()
        want.append(" ".join("".join(p).strip() for p in walk.found))
    df = spark.createDataFrame(list(enumerate(soup)), "i int, h string")
    assert [r["t"] for r in df.select("i", X.page_text("h").alias("t")).orderBy("i").collect()] == want


def test_long_pages(spark):
    """A deep stack, a tag with a very long attribute, one without an end, many paragraphs."""
    deep = "<div>" * 3000 + "<p>x" + "</div>" * 3000 + "y"
    assert one(spark, X.page_text("x"), deep) == "x"
    assert one(spark, X.page_text("x"), f"<p a='{'z' * 300_000}'>x</p>") == "x"
    assert one(spark, X.page_text("x"), "<p>x</p><a " + "y" * 300_000) == "x"
    assert one(spark, X.page_text("x"), "<p>x" * 3000) == " ".join(["x"] * 3000)


def test_blank_short_and_snippet(spark):
    assert one(spark, X.blank_short("x"), "a" * 99) == ""
    assert one(spark, X.blank_short("x"), "a" * 100) == "a" * 100
    assert one(spark, X.snippet("x"), "abc") == "- abc..."
    assert one(spark, X.snippet("x"), "z" * 300) == "- " + "z" * 200 + "..."


def test_word_count_unicode_space(spark):
    assert one(spark, X.word_count("x"), " one two\tthree four ") == 4
    assert one(spark, X.word_count("x"), "") == 0


def test_sentiment_label_bounds(spark):
    df = spark.createDataFrame([(-0.05,), (-0.0499,), (0.0,), (0.0499,), (0.05,)], "c double")
    got = [r[0] for r in df.select(S.label(F.col("c"))).collect()]
    assert got == ["negative", "neutral", "neutral", "neutral", "positive"]


def test_date_forms(spark):
    import datetime as dt

    from riskfeed.functions import dates as D
    day = dt.date(2025, 9, 10)
    forms = {"Wed, 10 Sep 2025 23:30:00 -0500": day, "10 Sep 25": day, "Sep 10, 2025": day, "10 September 2025": day,
             "2025/09/10": day, "2025-09-10T08:00:00Z": day, "September 10 2025": day, "10-Sep-2025": day,
             "10 Sep 98": dt.date(1998, 9, 10), "32 Sep 2025": None, "soon": None, "": None, None: None, "12 and 2024": None}
    df = spark.createDataFrame([(k,) for k in forms], "s string")
    assert {r["s"]: r["d"] for r in df.select("s", D.parse_pubdate("s").alias("d")).collect()} == forms


def test_character_references(spark):
    from riskfeed.functions import text as X
    forms = {"a &amp; b": "a & b", "&lt;p&gt;": "<p>", "it&rsquo;s &mdash; &hellip;": "it\u2019s \u2014 \u2026",
             "&#8217;&#x27;&#X1F600;": "\u2019'\U0001F600", "&amp;lt;": "&lt;", "AT&T & co;": "AT&T & co;", "&nosuch; &": "&nosuch; &",
             "&#0; &#xD800; &#99999999;": "&#0; &#xD800; &#99999999;", "plain": "plain", "&nbsp;x": "\u00a0x"}
    df = spark.createDataFrame([(k,) for k in forms], "s string")
    assert {r["s"]: r["d"] for r in df.select("s", X.decode_entities("s").alias("d")).collect()} == forms


def test_numbers_out_of_range_and_small_polarity(spark):
    from riskfeed.functions import terms as T
    from riskfeed.operators import store as ST
    df = spark.createDataFrame([("3000000000",), ("7.9",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(T.to_int_or_null("s")).collect()] == [None, 7, None, None]
    p = spark.createDataFrame([(0.0005,), (0.0,), (-0.5,), (0.1234,), (None,)], "polarity double")
    assert [r[0] for r in p.select(ST.polarity_text()).collect()] == ["0.0005", "0.0", "-0.5", "0.1234", None]
