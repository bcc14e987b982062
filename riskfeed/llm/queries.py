"""Registered queries of the training-data operators, and their SQL where SQL can
express them. Each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeed.llm import centroid_clustering as op13
from riskfeed.llm import conversation_trie as op11
from riskfeed.llm import decontaminate as op2
from riskfeed.llm import exact_dedup as op1
from riskfeed.llm import jaccard_join as op9
from riskfeed.llm import language_id as op4
from riskfeed.llm import mix_sources as op5
from riskfeed.llm import nearest_neighbours as op12
from riskfeed.llm import quality as op3
from riskfeed.llm import substring_dedup as op7
from riskfeed.llm import suffix_dedup as op10
from riskfeed.llm import token_counts as op8
from riskfeed.llm import token_output as op6
from riskfeed.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark, sf):
    return op1.exact_dedup(read_table(spark, sf, "documents", "doc_id", "text"))


ORACLE["op1_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


@query
def op2_decontaminate(spark, sf):
    return op2.find_leaks(read_table(spark, sf, "documents", "doc_id", "text"), read_table(spark, sf, "benchmark"))


@query
def op3_quality(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return op3.classify(d, op3.fit(d, read_table(spark, sf, "labels")))


@query
def op4_language_id(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = op4.fit(d.where(~held_out))
    return op4.predict(d, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op5_mix_sources(spark, sf):
    mixed = op5.mix_sources(read_table(spark, sf, "documents", "doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op5_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
           / 4294967296.0::DOUBLE AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 3 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM s),
c AS (
  SELECT *, sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w,
         coalesce(sum(cap) OVER r, 0) AS cap_before, coalesce(sum(w) OVER r, 0) AS w_before
  FROM w WINDOW r AS (ORDER BY cap::DOUBLE / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, cap * (all_w - w_before) <= (all_size - cap_before) * w AS capped FROM c),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE ((all_size - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)) * w)::DOUBLE
                   / sum(CASE WHEN NOT capped THEN w END) OVER () END AS target,
         CAST('0x' || substr(md5('mix-1/offset:' || coalesce(source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM k),
p AS (
  SELECT *, row_number() OVER (
    PARTITION BY source
    ORDER BY lpad(CAST(length(bin(size)) AS VARCHAR), 2, '0') || substr(bin(size) || '000', 2, 3), h, doc_id) AS rank
  FROM d)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (floor(target / source_size * rank + u) - floor(target / source_size * (rank - 1) + u))::BIGINT * size
       END AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op6_token_output(spark, sf):
    return op6.token_output(read_table(spark, sf, "documents", "doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


@query
def op7_substring_dedup(spark, sf):
    return op7.substring_dedup(read_table(spark, sf, "documents", "doc_id", "text"))


@query
def op8_token_counts(spark, sf):
    vocabulary = op8.sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return op8.token_counts(read_table(spark, sf, "documents", "doc_id", "text"), vocabulary)


@query
def op9_jaccard_join(spark, sf):
    found = op9.jaccard_classes(read_table(spark, sf, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op10_suffix_dedup(spark, sf):
    return op10.suffix_dedup(read_table(spark, sf, "documents", "doc_id", "text"))


@query
def op11_conversation_trie(spark, sf):
    return op11.conversation_trie(read_table(spark, sf, "conversations", "conv_id", "turn", "role", "text"))


ORACLE["op11_conversation_trie"] = r"""
WITH crc AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, step:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT range AS i FROM range(256))),
t AS MATERIALIZED (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(strlen(role)::VARCHAR || ':' || role || text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)),
own AS MATERIALIZED (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns FROM t GROUP BY conv_id),
hashed AS (
  SELECT conv_id, turns, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM own, crc),
seq AS MATERIALIZED (
  SELECT c.conv_id, coalesce(list_slice(b.turns, 1, h), []) || coalesce(list_slice(c.turns, h + 1, len(c.turns)), []) AS s
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.base),
p AS MATERIALIZED (
  SELECT conv_id, d, list_slice(s, 1, d) AS prefix, d = len(s) AS ends, len(s) AS n
  FROM seq, LATERAL (SELECT unnest(range(0, len(s) + 1)) AS d)),
node AS MATERIALIZED (
  SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = d AS leaf,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends,
         (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(prefix[d].text) END AS val
  FROM p GROUP BY d, prefix),
below AS (
  SELECT a.d, list_slice(n.prefix, 1, a.d) AS prefix, sum(val)::BIGINT AS saved_tokens,
         count(*) FILTER (WHERE leaf) AS n_leaves, count(*) FILTER (WHERE n.d = a.d + 1) AS n_children
  FROM node n, LATERAL (SELECT unnest(range(0, n.d + 1)) AS d) a GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, b.n_children, b.n_leaves, b.saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM node n JOIN below b ON b.d = n.d AND b.prefix = n.prefix
LEFT JOIN node up ON up.d = n.d - 1 AND up.prefix = list_slice(n.prefix, 1, n.d - 1)
"""


@query
def op12_nearest_neighbours(spark, sf):
    v = read_table(spark, sf, "embeddings", "vec_id", "embedding")
    return op12.nearest(v, v.where("vec_id % 20 = 0"), k=20)


@query
def op13_centroid_clustering(spark, sf):
    return op13.centroid_clusters(read_table(spark, sf, "embeddings", "vec_id", "embedding"))


def _kmeans_sql(k: int = 16, rounds: int = 3, dim: int = 64) -> str:
    assign = """a{r} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(q) AS q,
         min({{'d': list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'k': k}}) AS m
  FROM v, c{r} GROUP BY rid)"""
    move = """c{n} AS MATERIALIZED (
  SELECT c.k, coalesce(s.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS c
    FROM (SELECT m.k AS k, i, sum(q[i]) AS s, count(*) AS n FROM a{r}, range(1, {dim} + 1) AS g(i) GROUP BY ALL)
    GROUP BY k) s ON s.k = c.k)"""
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, q) - 1 AS k, q AS c
  FROM (SELECT sha256('1:' || vec_id) AS h, q FROM v ORDER BY h NULLS LAST, q LIMIT {k}))"""]
    for r in range(rounds):
        steps += [assign.format(r=r), move.format(r=r, n=r + 1, dim=dim)]
    steps.append(assign.format(r=rounds))
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, m.k::INTEGER AS cluster, m.d AS distance, sum(m.d) OVER (PARTITION BY m.k)::BIGINT AS cluster_inertia,
       sum(m.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.k = m.k"""


ORACLE["op13_centroid_clustering"] = _kmeans_sql()


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
