"""SRC3 / SRC4 / SRC5: landed news feeds (RSS XML), landed pages, stored mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfeed.functions import dates as D
from riskfeed.functions import text as X
from riskfeed.operators.store import published_name

# <item><title/><link/><pubDate/><source url="...">name</source></item>, in a channel or in an rss/channel
_ITEM = "struct<title: string, link: string, pubDate: string, source: struct<_VALUE: string, _url: string>>"
FEED_SCHEMA = f"item array<{_ITEM}>, channel struct<item: array<{_ITEM}>>, _unreadable string"
_XML = {"attributePrefix": "_", "valueTag": "_VALUE", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"}

MENTION_SCHEMA = T.StructType([
    T.StructField("risk_id", T.IntegerType()),
    T.StructField("search_term_id", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("keywords", T.ArrayType(T.StringType())),
    T.StructField("published_date", T.DateType()),
    T.StructField("link", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("polarity", T.DoubleType()),
    T.StructField("last_run_timestamp", T.TimestampNTZType()),
])


def landed_files(spark: SparkSession, root: str, streaming: bool = False) -> DataFrame:
    """Landed feed files, one row per file (a fetched result page): value, path."""
    r = spark.readStream.schema("value string") if streaming else spark.read
    files = r.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(root)
    return files.select("value", F.col("_metadata.file_path").alias("path"))


# landed files are read in pieces that end before each of these; a file that ends with it is cut off
_CUT = "<item"
_PIECE_SCHEMA = f"item array<{_ITEM}>, _end string, _unreadable string"
# the text before the first item, if it certainly ends inside an element and between two tags
_PLAIN_START = r"^[^<]*(<\?[^<>]*\?>[^<]*)*(</?[A-Za-z_][^<>]*>[^<>]*)+$"


def landed_pieces(spark: SparkSession, root: str) -> DataFrame:
    """The landed files in pieces, each up to the next item (the first one is what precedes the items), however
    large a file: path, size (of the file), start (of the split), at (order in the split), value."""
    files = spark.read.format("text").option("lineSep", _CUT).option("recursiveFileLookup", True).load(root)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")


def landed_lines(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the landed files: path, start (of the split), at (order in the split), value."""
    files = spark.read.format("text").option("lineSep", "\n").option("recursiveFileLookup", True).load(root)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                        F.monotonically_increasing_id().alias("at"), "value")


class Feed:
    """Landed feed files read in pieces, each item parsed by itself; a task holds an item, not a file.

    A file is well-formed if each of its items is by itself and so is what is left without them, so
    only the text before the first item and that from the last one on are parsed as one document.
    Where that does not settle it (an item that is not well-formed by itself, as with items in items,
    in comments or in several channels), the file is put together again and parsed whole.

    ``files``: path, n_bytes, unreadable. The pieces are parsed once, when this is made."""

    def __init__(self, spark: SparkSession, root: str):
        self.pieces = landed_pieces(spark, root)
        x = F.from_xml(F.concat(F.lit(f"<w>{_CUT}"), "value", F.lit("<_end>1</_end></w>")), _PIECE_SCHEMA, _XML)
        whole = F.col("x._unreadable").isNull() & F.col("x._end").eqNullSafe("1") & (F.size("x.item") == 1)
        parsed = self.pieces.withColumn("x", x).withColumn("ok", F.coalesce(whole, F.lit(False)))
        self.parsed = _staged(parsed.select(
            "path", "size", "start", "at", "ok", F.octet_length("value").alias("n_bytes"),
            F.when(F.col("ok"), F.col("x.item")[0]).alias("i"), F.when(~F.col("ok"), F.col("value")).alias("value")), "pieces")
        splits = self.parsed.groupBy("path", "start").agg(
            F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.count_if(~F.col("ok")).alias("bad"),
            F.sum("n_bytes").alias("n_bytes"), F.max("size").alias("size"))
        order = Window.partitionBy("path").orderBy("start")
        every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        self.splits = _staged(splits.select(
            "path", "start", "lo", (F.sum("n").over(order) - F.col("n")).alias("before"),
            *[F.sum(c).over(every).alias(c) for c in ("n", "bad", "n_bytes")], F.max("size").over(every).alias("size")), "splits")
        self.status = _staged(self._status(), "files")
        self.whole = self._whole()
        files = self.status.where("kind <> 'irregular'").select("path", "n_bytes", (F.col("kind") == "unreadable").alias("unreadable"))
        apart = self.status.where("kind = 'irregular'").select("path", "n_bytes").join(
            self.whole.select("path", _unreadable().alias("unreadable")), "path")
        self.files = files.unionByName(apart)

    def _placed(self, *columns: str) -> DataFrame:
        """The parsed pieces with their place in the file and the ``columns`` of the file."""
        rows = self.parsed.drop("size", "n_bytes").join(self.splits.select("path", "start", "lo", "before", *columns), ["path", "start"])
        return rows.withColumn("place", F.col("before") + F.col("at") - F.col("lo"))

    def _status(self) -> DataFrame:
        """Per file: kind (regular: its items are those parsed; irregular: it must be parsed whole;
        unreadable), n (pieces), i (the last item), n_bytes."""
        first, last = F.col("place") == 0, (F.col("place") == F.col("n") - 1) & (F.col("place") > 0)
        ends = self._placed("n", "bad", "n_bytes", "size").where(first | last)
        of = lambda which, c: F.max(F.when(which, F.col(c)))
        one = ends.groupBy("path").agg(
            *[F.max(c).alias(c) for c in ("n", "bad", "n_bytes", "size")], of(first, "ok").alias("first_ok"),
            of(last, "ok").alias("last_ok"), of(first, "value").alias("begin"), of(last, "value").alias("end"))
        one = one.withColumn("value", F.concat("begin", F.coalesce(F.concat(F.lit(_CUT), "end"), F.lit("")))).withColumn("x", _parsed())
        items = F.coalesce("x.item", "x.channel.item")
        inner = F.col("bad") - (~F.col("first_ok")).cast("int") - F.coalesce((~F.col("last_ok")).cast("int"), F.lit(0))
        kind = (F.when(F.col("first_ok"), "unreadable")  # text before the first tag
                .when(inner > 0, "irregular")
                .when(_unreadable(), F.when((F.col("n") == 1) | F.col("begin").rlike(_PLAIN_START), "unreadable").otherwise("irregular"))
                .when((F.col("n") == 1) | (~F.col("last_ok") & (F.size(items) == 1)), "regular").otherwise("irregular"))
        # a byte order mark and a last _CUT are not in the pieces; a compressed file has another size
        size = F.col("n_bytes") + len(_CUT) * (F.col("n") - 1)
        size = F.when(F.col("size").between(size, size + 3 + len(_CUT)), F.col("size")).otherwise(size)
        return one.select("path", kind.alias("kind"), "n", items[0].alias("i"), size.cast("long").alias("n_bytes"))

    def _whole(self) -> DataFrame:
        """The irregular files, put together and parsed: path, value, x."""
        paths = self.status.where("kind = 'irregular'").select("path")
        parts = self.pieces.join(paths, "path", "left_semi").groupBy("path").agg(
            F.array_sort(F.collect_list(F.struct("start", "at", "value"))).alias("parts"))
        return parts.select("path", F.array_join("parts.value", _CUT).alias("value")).withColumn("x", _parsed())

    def items(self) -> DataFrame:
        """Every item: path, feed_pos (its place in its file), i."""
        regular = self.status.where("kind = 'regular' AND n > 1")
        inner = self._placed().where("ok").join(regular.select("path"), "path", "left_semi")
        inner = inner.select("path", (F.col("place") - 1).alias("feed_pos"), "i")
        last = regular.select("path", (F.col("n") - 2).alias("feed_pos"), "i")
        apart = self.whole.where(~_unreadable()).select(
            "path", F.posexplode(F.coalesce("x.item", "x.channel.item")).alias("feed_pos", "i"))
        return inner.unionByName(last).unionByName(apart.withColumn("feed_pos", F.col("feed_pos").cast("long")))

    def counts(self, observation=None) -> dict:
        """landed_files and unreadable_files, also given to a ``pyspark.sql.Observation``."""
        counted = [F.count(F.lit(1)).alias("landed_files"), F.count_if("unreadable").alias("unreadable_files")]
        if observation is None:
            return self.files.agg(*counted).first().asDict()
        self.files.select("unreadable").observe(observation, *counted).write.format("noop").mode("overwrite").save()
        return dict(observation.get)

    def unreadable(self) -> DataFrame:
        """The landed files that give no items because they cannot be read: path, n_bytes, head."""
        files = self.files.where("unreadable").drop("unreadable")
        size, at = 200 // len(_CUT) + 1, Window.partitionBy("path").orderBy("at")
        heads = self.pieces.where("start = 0").join(files.select("path"), "path", "left_semi").select(
            "path", "at", F.substring("value", 1, 200).alias("value"), F.row_number().over(at).alias("place"))
        heads = heads.where(F.col("place") <= size).groupBy("path").agg(
            F.array_sort(F.collect_list(F.struct("place", "value"))).alias("parts"))
        both = files.join(heads.select("path", F.array_join("parts.value", _CUT).alias("head")), "path")
        head = F.when(F.octet_length("head") + len(_CUT) == F.col("n_bytes"), F.concat("head", F.lit(_CUT))).otherwise(F.col("head"))
        return both.select("path", "n_bytes", F.substring(head, 1, 200).alias("head"))


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the scratch folder and read back."""
    import uuid
    from riskfeed.session import scratch_path
    path = scratch_path(df.sparkSession, f"feed-{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(path: Column, key: str) -> Column:
    """Value of a ``key=value`` folder of a file's URI (URI escapes, then the writer's own)."""
    raw = F.regexp_extract(path, f"/{key}=([^/]*)/", 1)
    for _ in range(2):
        raw = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw != "__HIVE_DEFAULT_PARTITION__", raw)


def _parsed() -> Column:
    return F.from_xml("value", FEED_SCHEMA, _XML)


def _unreadable(x: str = "x") -> Column:
    """The file is empty or no well-formed XML. (A readable file without items is an empty page.)"""
    return F.coalesce((F.trim("value") == "") | F.col(f"{x}._unreadable").isNotNull() | F.col(x).isNull(), F.lit(True))


def unreadable_files(feed: Feed) -> DataFrame:
    """The landed files that give no items because they cannot be read: path, n_bytes, head."""
    return feed.unreadable()


def count_files(feed: Feed) -> dict:
    return feed.counts()


def feed_to_raw_items(files: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """Landed files (value, path; also a stream of them) -> raw item columns used by ``gates.normalize_items``.

    Landing layout: ``<root>/[...]/term=<term>/result_page=<n>/*.xml``; ``feed_pos`` is the item's
    place in its file, whatever the cluster's split settings. ``resolved`` (feed_link,
    resolved_link, status) holds what each feed link led to: a link that was not resolved, or
    with a status outside 200-399, is NULL; without the table the feed link stands for itself.

    A file that cannot be read gives no items."""
    feed = files.select("path", _parsed().alias("x"))
    return _raw_items(feed.select("path", F.posexplode(F.coalesce("x.item", "x.channel.item")).alias("feed_pos", "i")), resolved)


def _raw_items(feed: DataFrame, resolved: DataFrame | None) -> DataFrame:
    feed = feed.select(_folder(F.col("path"), "term").alias("term"),
                       F.expr("try_cast(regexp_extract(path, '/result_page=([^/]*)/', 1) AS int)").alias("result_page"),
                       F.col("feed_pos").cast("long").alias("feed_pos"), "i.*")
    items = feed.select(
        "term", "result_page", "feed_pos",
        F.xxhash64("term", "result_page", "link", "title", "pubDate").alias("item_id"),
        "title",
        F.col("link").alias("feed_link"),
        F.col("source._VALUE").alias("source_name"),
        F.col("pubDate").alias("pub_date_raw"),
        F.concat(F.lit('<source url="'), F.coalesce(F.col("source._url"), F.lit("")), F.lit('">'),
                 F.coalesce(F.col("source._VALUE"), F.lit("")), F.lit("</source>")).alias("source_element"),
    )
    if resolved is None:
        return items.withColumn("resolved_link", F.col("feed_link"))
    ok = F.col("status").between(200, 399) & F.col("resolved_link").isNotNull()
    led = resolved.where(ok).groupBy(F.col("feed_link").alias("_feed")).agg(F.min("resolved_link").alias("resolved_link"))
    return items.join(led, items["feed_link"] == led["_feed"], "left").drop("_feed")


def read_feed(spark: SparkSession, root: str | Feed, resolved: DataFrame | None = None, observation=None) -> DataFrame:
    """SRC3 (batch): every <item> of every landed feed file under ``root``. A ``pyspark.sql.Observation``
    gets the number of ``landed_files`` and ``unreadable_files``."""
    feed = root if isinstance(root, Feed) else Feed(spark, root)
    if observation is not None:
        feed.counts(observation)
    return _raw_items(feed.items(), resolved)


def write_feed(raw_items: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Land raw items as RSS-style XML files, one per term and result page (a fetched page is
    one document), items in feed order."""
    out = raw_items.select(
        "term", "result_page", "feed_pos", "item_id",
        F.col("title"), F.col("feed_link").alias("link"), F.col("pub_date_raw").alias("pubDate"),
        F.struct(F.col("source_name").alias("_VALUE"),
                 F.concat(F.lit("https://"), X.authority("feed_link")).alias("_url")).alias("source"),
    )
    (out.repartition("term", "result_page").sortWithinPartitions("term", "result_page", "feed_pos", "item_id")
     .drop("feed_pos", "item_id")
     .write.mode(mode).format("xml").option("rowTag", "item").option("rootTag", "channel")
     .partitionBy("term", "result_page").save(root))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: landed pages (url, html) keyed by the normalised link."""
    p = spark.read.parquet(path)
    pid = F.col("page_id") if "page_id" in p.columns else F.xxhash64("url")
    return p.select(pid.alias("page_id"), X.normalize_name("url").alias("link"), "html")


def read_mentions(spark: SparkSession, path: str, fmt: str = "parquet", risk_set: str = "enterprise") -> DataFrame:
    """SRC5: a mention file with an explicit schema; a missing one is empty.

    Parquet stores are partitioned by ``published_date`` (date filters prune
    directories). CSV files have the published header (upper case, the risk id by risk set) or
    the internal one, RFC-4180 quoting, and any date form that the feed may have: a date
    that cannot be read, or a number that cannot, is NULL."""
    from riskfeed.sinks import read_or_none
    if fmt != "csv":
        df = read_or_none(lambda: spark.read.parquet(path))
        return df if df is not None else spark.createDataFrame([], MENTION_SCHEMA)
    raw = read_or_none(lambda: spark.read.option("header", True).option("multiLine", True).option("quote", '"')
                       .option("escape", '"').csv(path))
    if raw is None:
        return spark.createDataFrame([], MENTION_SCHEMA)
    by_name = {c.upper(): c for c in raw.columns}

    def column(name: str, kind: T.DataType) -> Column:
        c = by_name.get(published_name(name, risk_set)) or by_name.get(name.upper())
        if c is None:
            return F.lit(None).cast(kind).alias(name)
        text = F.col(f"`{c}`")
        if isinstance(kind, T.ArrayType):
            got = F.when(text.isNull(), F.array().cast(kind)).otherwise(F.split(text, ","))
        elif isinstance(kind, T.DateType):
            got = D.coerce_date(text)
        elif isinstance(kind, T.StringType):
            got = text
        else:
            got = text.try_cast(kind)
        return got.alias(name)

    score = [c for c in raw.columns if c.upper().startswith("SCORE_") or c.upper() == "QUALITY_SCORE"]
    return raw.select(*[column(f.name, f.dataType) for f in MENTION_SCHEMA.fields],
                      *[F.col(f"`{c}`").try_cast("int").alias(c.lower()) for c in score])
