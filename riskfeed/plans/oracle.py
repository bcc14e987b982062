"""DuckDB SQL for every registered query: an independent relational statement of
the same semantics (list lambdas, window functions, CTEs), run by the driver
against the same Parquet tables."""

from __future__ import annotations

import re

from riskfeed import constants as C
from riskfeed.sources import binding as B

WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PUNCT = r"[!-/:-@\[-`{-~]"
AUTH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def norm(x: str) -> str:
    return strip(f"lower({x})")


def auth(x: str) -> str:
    return f"regexp_extract({x}, {q(AUTH_RE)}, 1)"


def score_dom(x: str) -> str:
    low = f"lower(coalesce(CAST({x} AS VARCHAR), ''))"
    ws = (f"CASE WHEN starts_with({low}, 'http://') OR starts_with({low}, 'https://') "
          f"THEN {low} ELSE 'https://' || {low} END")
    return f"lower({auth(ws)})"


ENT_RE = r"^(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _entity_map() -> str:
    from html.entities import html5
    table = {k[:-1]: v for k, v in sorted(html5.items()) if k.endswith(";")}
    return (f"MAP([{', '.join(q(k) for k in table)}], [{', '.join(q(v) for v in table.values())}])")


def ent(x: str) -> str:
    """Character references decoded once: the text is cut at each ampersand."""
    ref = f"regexp_extract(e1, {q(ENT_RE)}, 1)"
    code = (f"TRY_CAST(CASE WHEN lower(substr({ref}, 1, 2)) = '#x' THEN '0x' || substr({ref}, 3) "
            f"WHEN substr({ref}, 1, 1) = '#' THEN substr({ref}, 2) END AS INTEGER)")
    char = (f"CASE WHEN {ref} = '' THEN NULL WHEN substr({ref}, 1, 1) <> '#' THEN map_extract({ENTITY_MAP}, {ref})[1] "
            f"WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr({code}) END")
    piece = f"coalesce(({char}) || substr(e1, length({ref}) + 2), '&' || e1)"
    return (f"CASE WHEN NOT contains({x}, '&') THEN {x} ELSE string_split({x}, '&')[1] || "
            f"array_to_string(list_transform(string_split({x}, '&')[2:], lambda e1: {piece}), '') END")


ENTITY_MAP = _entity_map()


def title(html: str) -> str:
    return strip(ent(f"regexp_extract({html}, {q(r'(?is)<title[^>]*>(.*?)</title>')}, 1)"))


TAG_RE = r"""<(?:/?[a-zA-Z][^\s/>]*(?:[^'">]+|"[^"]*"|'[^']*')*|[!?][^>]*)>"""


def _paragraphs(html: str) -> str:
    """Lists of text nodes, one per paragraph: a stack of open elements, reduced over the tags.

    Every list element is a state whose ``open`` holds the tag's name, ``at`` its kind and ``nodes``
    the text after it; the first one is the empty state, so that states can be reduced."""
    clean = f"regexp_replace({html}, {q(r'(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->')}, '<!>', 'g')"
    name = f"lower(regexp_extract(tg, {q(r'^</?([a-zA-Z][^\s/>]*)')}, 1))"
    void = ", ".join(q(v) for v in C.VOID_ELEMENTS)
    kind = (f"CASE WHEN {name} = '' OR {name} IN ({void}) OR ends_with(tg, '/>') THEN 0 "
            "WHEN starts_with(tg, '</') THEN -1 ELSE 1 END")
    no_done = "CAST([] AS VARCHAR[][])"
    tags = (f"list_transform(regexp_extract_all({clean}, {q(TAG_RE)}), lambda tg, ti: "
            f"{{'open': [{name}], 'at': {kind}, 'nodes': [string_split_regex({clean}, {q(TAG_RE)})[ti + 1]], 'done': {no_done}}})")
    first = f"{{'open': CAST([] AS VARCHAR[]), 'at': 0, 'nodes': CAST([] AS VARCHAR[]), 'done': {no_done}}}"
    # the stack after the tag, and the paragraph's place in it
    place = "(len(ac.open) + 1 - list_position(list_reverse(ac.open), tk.open[1]))"
    is_p = "tk.at = 1 AND tk.open[1] = 'p'"
    shut = "tk.at = -1 AND list_contains(ac.open, tk.open[1])"
    stack = (f"CASE WHEN {is_p} AND ac.at > 0 THEN list_append(ac.open[1:ac.at - 1], 'p') WHEN tk.at = 1 THEN "
             f"list_append(ac.open, tk.open[1]) WHEN {shut} THEN ac.open[1:{place} - 1] ELSE ac.open END")
    at = (f"CASE WHEN {is_p} AND ac.at > 0 THEN ac.at WHEN {is_p} THEN len(ac.open) + 1 "
          f"WHEN {shut} AND {place} <= ac.at THEN 0 ELSE ac.at END")
    ended = f"ac.at > 0 AND (({is_p}) OR ({shut} AND {place} <= ac.at))"
    within = f"({is_p}) OR (ac.at > 0 AND NOT ({shut} AND {place} <= ac.at))"
    nodes = (f"CASE WHEN NOT ({within}) THEN CAST([] AS VARCHAR[]) WHEN {is_p} THEN tk.nodes "
             "ELSE list_concat(ac.nodes, tk.nodes) END")
    done = f"CASE WHEN {ended} THEN list_append(ac.done, ac.nodes) ELSE ac.done END"
    last = (f"list_reduce(list_prepend({first}, {tags}), lambda ac, tk: "
            f"{{'open': {stack}, 'at': {at}, 'nodes': {nodes}, 'done': {done}}})")
    return (f"list_transform([{last}], lambda fin: CASE WHEN fin.at > 0 THEN list_append(fin.done, fin.nodes) "
            "ELSE fin.done END)[1]")


def page_text(html: str) -> str:
    glued = "array_to_string(c2, '')"
    paras = f"list_transform({_paragraphs(html)}, lambda c2: {strip(ent(glued))})"
    return f"coalesce(array_to_string({paras}, ' '), '')"


def page_text_backfill(html: str) -> str:
    inner = f"array_to_string(list_transform(c2, lambda t: {strip(ent('t'))}), '')"
    paras = f"list_transform({_paragraphs(html)}, lambda c2: {inner})"
    return strip(f"coalesce(array_to_string(list_filter({paras}, lambda p: p <> ''), ' '), '')")


def blank(x: str, n: int = C.MIN_ARTICLE_CHARS) -> str:
    return f"CASE WHEN length(coalesce({x}, '')) < {n} THEN '' ELSE coalesce({x}, '') END"


def words(x: str) -> str:
    return f"list_filter(string_split_regex(coalesce({x}, ''), {q(WS + '+')}), lambda w: w <> '')"


def parse_date(x: str) -> str:
    day = r"(\d{1,2})[ -]([A-Za-z]{3})[A-Za-z]*\.?[ -](\d{4}|\d{2})\b"
    mon = r"\b([A-Za-z]{3})[A-Za-z]*\.? (\d{1,2}),? (\d{4})\b"
    iso = r"^\s*(\d{4})[-/](\d{1,2})[-/](\d{1,2})"

    def g(p: str, i: int) -> str:
        return f"regexp_extract({x}, {q(p)}, {i})"
    year = f"(CASE WHEN length({g(day, 3)}) <> 2 THEN {g(day, 3)} WHEN {g(day, 3)} >= '69' THEN '19' ELSE '20' END || " \
           f"CASE WHEN length({g(day, 3)}) = 2 THEN {g(day, 3)} ELSE '' END)"
    return (f"coalesce(CAST(try_strptime({g(day, 1)} || ' ' || {g(day, 2)} || ' ' || {year}, '%d %b %Y') AS DATE), "
            f"CAST(try_strptime({g(mon, 2)} || ' ' || {g(mon, 1)} || ' ' || {g(mon, 3)}, '%d %b %Y') AS DATE), "
            f"CAST(try_strptime({g(iso, 1)} || '-' || {g(iso, 2)} || '-' || {g(iso, 3)}, '%Y-%m-%d') AS DATE))")


def ends_any(x: str, suffixes) -> str:
    return "(" + " OR ".join(f"ends_with({x}, {q(s)})" for s in suffixes) + ")"


def values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return q(v)
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(cols)})"


def case_map(x: str, pairs, default: str) -> str:
    if not pairs:
        return default
    arms = " ".join(f"WHEN {q(k)} THEN {dbl(float(v))}" for k, v in pairs)
    return f"CASE {x} {arms} ELSE {default} END"


def in_list(x: str, items) -> str:
    if not items:
        return "false"
    return f"({x} IN ({', '.join(q(i) for i in items)}))"


# ------------------------------------------------------------------ common CTEs

def _dict_rows():
    out = []
    for r, s, t, raw in B.TEST_DICTIONARY:
        out.append((r, s, t if raw is None else None))
    return out


DIM_CTES = [
    f"dict AS (SELECT * FROM {values(_dict_rows(), ['risk_id', 'search_term_id', 'search_terms'])})",
    "vterms AS (SELECT search_terms, min(search_term_id) AS term_pos FROM dict "
    "WHERE search_terms IS NOT NULL GROUP BY search_terms)",
    f"blk AS (SELECT DISTINCT {norm('name')} AS name FROM {values([(v,) for v in B.TEST_BLOCK_LIST], ['name'])} "
    f"WHERE name IS NOT NULL)",
    f"alw AS (SELECT DISTINCT {norm('name')} AS name FROM {values([(v,) for v in B.TEST_ALLOW_LIST], ['name'])} "
    f"WHERE name IS NOT NULL)",
]

SRC_NAME = "(' Src' || CAST(e.user_id % 20 AS VARCHAR) || ' ')"
ITEM_CTES = [
    f"pl AS (SELECT page_id, url AS feed_link, {title('html')} AS title FROM pages)",
    "raw_items AS (SELECT e.event_type AS term, CAST(((e.event_id * 7919) % 10007) // 1000 + 1 AS INTEGER) AS result_page, (e.event_id * 7919) % 10007 AS feed_pos, "
    "e.event_id AS item_id, pl.title, pl.feed_link, pl.feed_link AS resolved_link, "
    f"{SRC_NAME} AS source_name, "
    "CASE WHEN e.value < 1 THEN 'not a date' "
    "WHEN e.user_id % 2 = 1 THEN strftime(e.ts - INTERVAL 5 HOUR, '%a, %d %b %Y %H:%M:%S') || ' -0500' "
    "ELSE strftime(e.ts, '%a, %d %b %Y %H:%M:%S') || ' GMT' END AS pub_date_raw, "
    f"'<source url=\"https://' || {auth('pl.feed_link')} || '\">' || {SRC_NAME} || '</source>' AS source_element "
    "FROM events e JOIN pl ON pl.page_id = e.event_id % (SELECT count(*) FROM pages))",
    f"items AS (SELECT term, result_page, feed_pos, item_id, {strip('title')} AS title, "
    f"{norm('resolved_link')} AS link, {norm('source_name')} AS source, "
    f"{auth(strip('feed_link'))} AS source_url, {parse_date('pub_date_raw')} AS published_date "
    "FROM raw_items WHERE title IS NOT NULL AND feed_link IS NOT NULL AND source_name IS NOT NULL)",
    "mview AS (SELECT i.*, d.risk_id, d.search_term_id, d.search_term_id AS dict_pos "
    "FROM items i LEFT JOIN dict d ON i.term = d.search_terms)",
]

PAGE_CTES = [f"pages_n AS (SELECT page_id, {norm('url')} AS link, html FROM pages)"]

DOCS_CTES = [
    "docs_store AS (SELECT d.doc_id, CAST(NULL AS VARCHAR) AS title, p.link, "
    "CAST(DATE '2024-01-01' + CAST(d.doc_id % 30 AS INTEGER) AS DATE) AS published_date, "
    f"CASE WHEN d.doc_id % {B.BLANK_EVERY} <> 0 THEN d.text END AS summary, CAST(NULL AS VARCHAR) AS sentiment, CAST(NULL AS DOUBLE) AS polarity, "
    "CAST(NULL AS TIMESTAMP) AS last_run_timestamp "
    "FROM documents d JOIN pages_n p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages))",
]


def with_(ctes, body: str) -> str:
    """Every view is computed once: pages, their texts and scores are named several times."""
    once = [re.sub(r"^(\w+) AS \(", r"\1 AS MATERIALIZED (", c) for c in ctes]
    return "WITH " + ",\n".join(once) + "\n" + body


# ------------------------------------------------------------------ sentiment

def sentiment_ctes(src: str, key: str, text: str, out: str, pol: str = "polarity",
                   lab: str = "sentiment"):
    """CTEs scoring ``src(key, text)`` into ``out(key, pol, lab)``."""
    val = case_map("w", [(k.lower(), v) for k, v in B.TEST_VALENCES], dbl(0.0))
    boost = case_map("w", [(k.lower(), v) for k, v in B.TEST_BOOSTERS], dbl(0.0))
    negs = in_list("w", [t.lower() for t in B.TEST_NEGATIONS])
    cons = in_list("w", [t.lower() for t in B.TEST_CONTRASTS])
    edge = q("^" + PUNCT + "+|" + PUNCT + "+$")
    s1 = (f"{out}_1 AS (SELECT {key} AS k, {text} AS t, list_filter(list_transform({words(text)}, "
          f"lambda w: regexp_replace(w, {edge}, '', 'g')), lambda w: w <> '') AS tok FROM {src})")
    s2 = (f"{out}_2 AS (SELECT *, len(tok) AS n, list_transform(tok, lambda w: lower(w)) AS low, "
          f"list_transform(tok, lambda w: regexp_matches(w, '^[A-Z]+$')) AS caps FROM {out}_1)")
    s3 = (f"{out}_3 AS (SELECT *, list_transform(low, lambda w: {val}) AS base, "
          f"list_transform(low, lambda w: {boost}) AS bst, list_transform(low, lambda w: {negs}) AS neg, "
          f"coalesce(list_position(list_transform(low, lambda w: {cons}), true), 0) AS fc, "
          f"(len(list_filter(caps, lambda c: c)) > 0 AND len(list_filter(caps, lambda c: NOT c)) > 0) AS mx "
          f"FROM {out}_2)")
    v0 = "base[i]"
    sg = f"CAST(sign({v0}) AS DOUBLE)"
    v1 = f"(CASE WHEN caps[i] AND mx THEN {v0} + {sg} * {dbl(C.SENT_CAPS_INCREMENT)} ELSE {v0} END)"
    terms = [f"{sg} * (CASE WHEN i > {d} THEN bst[i - {d}] ELSE {dbl(0.0)} END) * {dbl(float(damp))}"
             for d, damp in zip((1, 2, 3), C.SENT_BOOSTER_DAMPING)]
    v2 = f"({v1} + {terms[0]} + {terms[1]} + {terms[2]})"
    v3 = v2
    for d in (1, 2, 3):
        v3 = (f"(CASE WHEN i > {d} AND neg[i - {d}] THEN {v3} * {dbl(C.SENT_NEGATION_SCALAR)} "
              f"ELSE {v3} END)")
    v4 = (f"(CASE WHEN fc = 0 THEN v3 WHEN i < fc THEN v3 * {dbl(C.SENT_CONTRAST_BEFORE)} "
          f"WHEN i > fc THEN v3 * {dbl(C.SENT_CONTRAST_AFTER)} ELSE v3 END)")
    s4 = (f"{out}_4 AS (SELECT k, t, n, list_transform(range(1, n + 1), lambda i: "
          f"CASE WHEN {v0} = 0 THEN {dbl(0.0)} ELSE {v3} END) AS v3s, fc FROM {out}_3)")
    s5 = (f"{out}_5 AS (SELECT k, t, n, list_reduce(list_prepend({dbl(0.0)}, list_transform(range(1, n + 1), "
          f"lambda i: {v4.replace('v3', 'v3s[i]')})), lambda a, x: a + x) AS s FROM {out}_4)")
    emph = (f"(least(length(coalesce(t, '')) - length(replace(coalesce(t, ''), '!', '')), {C.SENT_EXCLAIM_MAX}) "
            f"* {dbl(C.SENT_EXCLAIM_WEIGHT)} + CASE WHEN nq > 3 THEN {dbl(C.SENT_QUESTION_MAX)} "
            f"WHEN nq > 1 THEN nq * {dbl(C.SENT_QUESTION_WEIGHT)} ELSE {dbl(0.0)} END)")
    s6 = (f"{out}_6 AS (SELECT k, t, n, s, length(coalesce(t, '')) - length(replace(coalesce(t, ''), '?', '')) AS nq "
          f"FROM {out}_5)")
    s7 = (f"{out}_7 AS (SELECT k, n, CASE WHEN s > 0 THEN s + {emph} WHEN s < 0 THEN s - {emph} ELSE s END AS s2 "
          f"FROM {out}_6)")
    s8 = (f"{out} AS (SELECT k AS {key}, CASE WHEN n = 0 THEN {dbl(0.0)} ELSE "
          f"round(s2 / sqrt(s2 * s2 + {C.SENT_NORMALIZE_ALPHA}), 4) END AS {pol} FROM {out}_7)")
    return [s1, s2, s3, s4, s5, s6, s7, s8]


def label(x: str) -> str:
    return (f"CASE WHEN {x} <= {C.NEGATIVE_AT_MOST} THEN 'negative' "
            f"WHEN {x} >= {C.POSITIVE_AT_LEAST} THEN 'positive' ELSE 'neutral' END")


# ------------------------------------------------------------------ quality score

def term_match(x: str) -> str:
    return (f"EXISTS (SELECT 1 FROM vterms vt WHERE contains(lower(coalesce({x}, '')), "
            f"lower(vt.search_terms)))")


def score_ctes(src: str, out: str, match: str, wc: str, title_col: str = "title"):
    """``src`` has dom, in_allow, in_block and the columns used by ``match`` / ``wc``."""
    s1 = (f"{out}_a AS (SELECT *, ({match}) AS m, ({wc}) AS wc, "
          f"CASE WHEN in_block OR NOT {ends_any('dom', C.SCORE_TLDS)} THEN 1 "
          f"WHEN NOT ({match}) AND NOT in_allow THEN 2 "
          f"WHEN regexp_matches(dom, '[-0-9]') AND NOT in_allow THEN 3 "
          f"WHEN regexp_matches(lower(coalesce({title_col}, '')), {q(C.CLICKBAIT_PATTERN)}) AND NOT in_allow THEN 4 "
          f"ELSE 5 END AS stage FROM {src})")
    comps = {
        "score_whitelist_bonus": f"CASE WHEN in_allow THEN {C.WHITELIST_BONUS} ELSE 0 END",
        "score_blacklist_non_us_penalty": f"CASE WHEN stage = 1 THEN {C.BLACKLIST_PENALTY} ELSE 0 END",
        "score_search_term_matches": "CASE WHEN stage >= 2 THEN CASE WHEN m THEN 1 ELSE 0 END END",
        "score_domain_penalty": "CASE WHEN stage >= 3 THEN CASE WHEN regexp_matches(dom, '[-0-9]') THEN -1 ELSE 0 END END",
        "score_us_bonus": f"CASE WHEN stage >= 4 THEN CASE WHEN {ends_any('dom', C.SCORE_TLDS)} THEN 1 ELSE 0 END END",
        "score_clickbait_penalty": (f"CASE WHEN stage >= 4 THEN CASE WHEN regexp_matches(lower(coalesce({title_col}, '')), "
                                    f"{q(C.CLICKBAIT_PATTERN)}) THEN -1 ELSE 0 END END"),
        "score_length_150": f"CASE WHEN stage >= 5 THEN CASE WHEN wc > {C.LENGTH_BONUS_WORDS[0]} THEN 1 ELSE 0 END END",
        "score_length_500": f"CASE WHEN stage >= 5 THEN CASE WHEN wc > {C.LENGTH_BONUS_WORDS[1]} THEN 1 ELSE 0 END END",
    }
    cols = ", ".join(f"CAST({v} AS INTEGER) AS {k}" for k, v in comps.items())
    s2 = f"{out}_b AS (SELECT *, {cols} FROM {out}_a)"
    total = " + ".join(f"coalesce({k}, 0)" for k in comps)
    s3 = (f"{out} AS (SELECT *, CAST(CASE WHEN stage = 5 THEN greatest({total}, 0) ELSE 0 END AS INTEGER) "
          f"AS score_total_score FROM {out}_b)")
    return [s1, s2, s3]


SCORE_COLS = [f"score_{c}" for c in C.SCORE_COMPONENTS]


def flags(x: str) -> str:
    return (f"{score_dom(x)} AS dom, coalesce({score_dom(x)} IN (SELECT name FROM alw), false) AS in_allow, "
            f"coalesce({score_dom(x)} IN (SELECT name FROM blk), false) AS in_block")


SCORED_PAGES = DIM_CTES + [
    f"sp AS (SELECT page_id, {title('html')} AS title, {blank(page_text('html'))} AS summary, "
    f"{auth('url')} AS source_url FROM pages)",
    f"spf AS (SELECT *, {flags('source_url')} FROM sp)",
] + score_ctes("spf", "scored", f"{term_match('title')} OR {term_match('summary')}", f"len({words('summary')})")


# ------------------------------------------------------------------ daily run

OUT_COLS = ["risk_id", "search_term_id", "title", "summary", "keywords", "published_date", "link", "source",
            "source_url", "sentiment", "polarity", "last_run_timestamp"] + SCORE_COLS + ["quality_score"]
ORD = ["term_pos", "result_page", "feed_pos", "item_id", "dict_pos"]


def daily_ctes(p: str, as_of: str, stored: str | None, window_days: int):
    as_of_date = as_of[:10]
    seen = (f" AND NOT EXISTS (SELECT 1 FROM {stored} s WHERE {norm('s.link')} = g.link)" if stored else "")
    ctes = [
        f"{p}_it AS (SELECT i.*, t.term_pos FROM items i JOIN vterms t ON i.term = t.search_terms)",
        f"{p}_g AS (SELECT * FROM {p}_it g WHERE link IS NOT NULL AND {ends_any(f'lower({auth('link')})', C.LINK_TLDS)} "
        f"AND NOT contains(link, {q(C.TRANSLATED_MARKER)}) AND NOT EXISTS (SELECT 1 FROM blk b WHERE b.name = g.source)"
        f"{seen})",
        f"{p}_r AS (SELECT * FROM {p}_g WHERE published_date IS NOT NULL AND "
        f"published_date >= DATE '{as_of_date}' - INTERVAL {C.RECENCY_DAYS} DAY)",
        f"{p}_pg AS (SELECT link, arg_min(html, page_id) AS html FROM pages_n WHERE link IN (SELECT link FROM {p}_r) "
        f"GROUP BY link)",
        f"{p}_pt AS (SELECT link, {blank(page_text('html'))} AS summary FROM {p}_pg)",
    ]
    ctes += sentiment_ctes(f"{p}_pt", "link", "summary", f"{p}_ps")
    ctes += [
        f"{p}_pf AS (SELECT t.link, t.summary, s.polarity, {label('s.polarity')} AS sentiment, "
        f"{term_match('t.summary')} AS summary_match, len({words('t.summary')}) AS summary_words "
        f"FROM {p}_pt t JOIN {p}_ps s ON s.link = t.link)",
        f"{p}_e AS (SELECT r.*, coalesce(f.summary, '') AS summary, coalesce(f.sentiment, 'neutral') AS sentiment, "
        f"coalesce(f.polarity, 0.0) AS polarity, coalesce(f.summary_match, false) AS summary_match, "
        f"coalesce(f.summary_words, 0) AS summary_words FROM {p}_r r LEFT JOIN {p}_pf f ON f.link = r.link)",
        f"{p}_j AS (SELECT e.*, d.risk_id, d.search_term_id, d.search_term_id AS dict_pos FROM {p}_e e "
        f"LEFT JOIN dict d ON e.term = d.search_terms)",
        f"{p}_jf AS (SELECT *, {flags('source_url')} FROM {p}_j)",
    ]
    ctes += score_ctes(f"{p}_jf", f"{p}_s", f"{term_match('title')} OR summary_match", "summary_words")
    cols_new = []
    for c in OUT_COLS:
        if c == "keywords":
            cols_new.append("CAST([] AS VARCHAR[]) AS keywords")
        elif c == "last_run_timestamp":
            cols_new.append(f"TIMESTAMP '{as_of}' AS last_run_timestamp")
        elif c == "quality_score":
            cols_new.append("score_total_score AS quality_score")
        else:
            cols_new.append(c)
    ctes.append(f"{p}_new AS (SELECT {', '.join(cols_new)}, {', '.join(ORD)}, 1 AS batch FROM {p}_s)")
    if stored:
        nulls = ", ".join(f"NULL AS {c}" for c in ORD)
        ctes.append(f"{p}_comb AS (SELECT {', '.join(OUT_COLS)}, {nulls}, 0 AS batch FROM {stored} "
                    f"UNION ALL BY NAME SELECT * FROM {p}_new)")
    else:
        ctes.append(f"{p}_comb AS (SELECT * FROM {p}_new)")
    payload = [c for c in OUT_COLS if c not in ("title", "link", "published_date")]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ["batch"] + ORD + payload)
    ctes.append(f"{p}_dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title, link, published_date "
                f"ORDER BY {order}) AS rn FROM {p}_comb) WHERE rn = 1)")
    ctes.append(f"{p}_cur AS (SELECT {', '.join(OUT_COLS)} FROM {p}_dd WHERE CAST(published_date AS TIMESTAMP) >= "
                f"TIMESTAMP '{as_of}' - INTERVAL {window_days} DAY)")
    return ctes


DAILY = (DIM_CTES + ITEM_CTES + PAGE_CTES
         + daily_ctes("r1", B.EARLIER_AS_OF, None, B.TEST_WINDOW_DAYS)
         + daily_ctes("r2", B.AS_OF, "r1_cur", B.TEST_WINDOW_DAYS))


# ------------------------------------------------------------------ queries

def _tail_digits(st: str) -> str:
    return (f"CASE WHEN {st}.c = 0 THEN []::INTEGER[] WHEN {st}.c < 10 THEN [{st}.c] "
            f"WHEN {st}.c < 100 THEN [{st}.c % 10, {st}.c // 10] "
            f"ELSE [{st}.c % 10, ({st}.c // 10) % 10, {st}.c // 100] END")


def encode_sql(t: str) -> str:
    """text -> decimal string of the little-endian integer of its UTF-8 bytes."""
    h = f"hex(encode({t}))"
    msb_first = (f"list_reverse(list_transform(range(0, octet_length(encode({t}))), "
                 f"lambda j: CAST(('0x' || substr({h}, 2 * j + 1, 2)) AS INTEGER)))")
    step = ("list_reduce(acc, lambda st, qd: {'o': list_append(st.o, (qd * 256 + st.c) % 10), "
            "'c': (qd * 256 + st.c) // 10}, {'o': []::INTEGER[], 'c': b})")
    fold = (f"list_reduce({msb_first}, lambda acc, b: list_transform([{step}], "
            f"lambda st: list_concat(st.o, {_tail_digits('st')}))[1], []::INTEGER[])")
    digits = f"array_to_string(list_transform(list_reverse({fold}), lambda d: CAST(d AS VARCHAR)), '')"
    return f"CASE WHEN {t} IS NOT NULL THEN coalesce(nullif({digits}, ''), '0') END"


def decode_sql(e: str) -> str:
    """decimal string -> text (NULL: not digits / invalid UTF-8)."""
    digs = f"list_transform(string_split({e}, ''), lambda d: CAST(d AS INTEGER))"
    step = ("list_reduce(acc, lambda st, bv: {'o': list_append(st.o, (bv * 10 + st.c) % 256), "
            "'c': (bv * 10 + st.c) // 256}, {'o': []::INTEGER[], 'c': d})")
    fold = (f"list_reduce({digs}, lambda acc, d: list_transform([{step}], lambda st: "
            f"CASE WHEN st.c > 0 THEN list_append(st.o, st.c) ELSE st.o END)[1], []::INTEGER[])")
    hx = f"array_to_string(list_transform({fold}, lambda x: printf('%02X', x)), '')"
    return f"CASE WHEN regexp_matches({e}, '^[0-9]+$') THEN try(decode(unhex({hx}))) END"


ENC_TEXT = "event_type || ' ' || CAST(user_id AS VARCHAR)"


POLARITY_TEXT = ("regexp_replace(CAST(CAST(polarity AS DECIMAL(20, 4)) AS VARCHAR), '(\\.\\d+?)0+$', '\\1') AS polarity")


def oracle_sql() -> dict[str, str]:
    s: dict[str, str] = {}

    s["decode_terms"] = with_(
        ["enc AS (SELECT event_id, CAST(user_id AS VARCHAR) AS uid, "
         f"{encode_sql(ENC_TEXT)} AS encoded_terms FROM events)"],
        f"SELECT event_id, encoded_terms, {decode_sql('encoded_terms')} AS search_terms, "
        f"{decode_sql('uid')} AS decoded_user_id FROM enc")
    s["term_dictionary"] = ("SELECT DISTINCT CAST(user_id % 10 AS INTEGER) AS risk_id, CAST(user_id AS INTEGER) "
                            "AS search_term_id, 'user ' || CAST(user_id AS VARCHAR) AS search_terms FROM events")
    s["coerce_risk_id"] = (
        "SELECT event_id, TRY_CAST(trunc(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS INTEGER) AS risk_id_from_value, "
        "TRY_CAST(trunc(TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE)) AS INTEGER) AS risk_id_from_k, "
        "TRY_CAST(trunc(TRY_CAST(props AS DOUBLE)) AS INTEGER) AS risk_id_from_props FROM events")
    s["url_authority"] = f"SELECT page_id, {auth('url')} AS authority FROM pages"
    s["score_domain"] = (f"SELECT page_id, {score_dom('url')} AS domain_from_url, "
                         f"{score_dom(auth('url'))} AS domain_from_authority FROM pages")
    s["page_text"] = f"SELECT page_id, {page_text('html')} AS text FROM pages"
    s["page_text_backfill"] = f"SELECT page_id, {page_text_backfill('html')} AS text FROM pages"
    s["blank_short_text"] = f"SELECT doc_id, {blank('text')} AS summary FROM documents"
    s["coerce_published_date"] = (f"SELECT event_id, {parse_date('CAST(ts AS VARCHAR)')} AS from_ts, "
                                  f"{parse_date('props')} AS from_props FROM events")
    s["sentiment_compound"] = with_(
        [f"dsrc AS (SELECT doc_id, text FROM documents)"] + sentiment_ctes("dsrc", "doc_id", "text", "dsent", "compound"),
        "SELECT doc_id, compound FROM dsent")
    s["sentiment_label"] = with_(
        PAGE_CTES + [f"psrc AS (SELECT page_id, {blank(page_text('html'))} AS summary FROM pages_n)"]
        + sentiment_ctes("psrc", "page_id", "summary", "psent"),
        f"SELECT page_id, polarity, {label('polarity')} AS sentiment FROM psent")

    base = DIM_CTES + ITEM_CTES
    s["normalize_item"] = with_(base, "SELECT * FROM items")
    s["parse_pubdate"] = with_(base, f"SELECT item_id, pub_date_raw, {parse_date('pub_date_raw')} AS published_date "
                                     "FROM raw_items")
    s["extract_source_site"] = with_(base, "SELECT item_id, nullif(regexp_extract(source_element, "
                                           + q(r"https?:[\w:#@%;$()~_?+\-./0-9:;<=\\.&,]*") + ", 0), '') AS source_site "
                                           "FROM raw_items")
    s["pick_column_filter"] = with_(base, "SELECT item_id, risk_id, published_date AS picked_date, "
                                          "title AS picked_text FROM mview")
    gate = (f"link IS NOT NULL AND {ends_any(f'lower({auth('link')})', C.LINK_TLDS)} "
            f"AND NOT contains(link, {q(C.TRANSLATED_MARKER)})")
    s["url_gates"] = with_(base, f"SELECT item_id, link FROM items WHERE {gate}")
    s["blocked_source_gate"] = with_(base, "SELECT item_id, source FROM items i WHERE NOT EXISTS "
                                           "(SELECT 1 FROM blk b WHERE b.name = i.source)")
    s["new_links_only"] = with_(base, f"SELECT item_id, link FROM items i WHERE {gate} AND NOT EXISTS "
                                      f"(SELECT 1 FROM items v WHERE v.term = 'view' AND v.published_date < DATE '2024-01-05' "
                                      f"AND {norm('v.link')} = i.link)")
    s["top_k_per_term"] = with_(base, "SELECT item_id, term FROM (SELECT *, row_number() OVER (PARTITION BY term "
                                      f"ORDER BY result_page, feed_pos, item_id) AS rn FROM items) WHERE rn <= "
                                      f"{C.MAX_ITEMS_PER_TERM}")
    s["recent_mentions"] = with_(base, "SELECT item_id, published_date FROM items WHERE published_date IS NOT NULL "
                                       f"AND published_date >= DATE '{B.AS_OF_DATE}' - INTERVAL {C.RECENCY_DAYS} DAY")
    s["cap_terms"] = with_(
        base + ["cap3 AS (SELECT search_terms, min(search_term_id) AS term_pos FROM (SELECT * FROM dict "
                "WHERE search_terms IS NOT NULL ORDER BY search_term_id LIMIT 3) GROUP BY search_terms)"],
        "SELECT i.term, c.term_pos, count(*) AS n_items FROM items i JOIN cap3 c ON i.term = c.search_terms "
        "GROUP BY i.term, c.term_pos")
    s["window_split"] = with_(base, "SELECT item_id, CASE WHEN CAST(published_date AS TIMESTAMP) >= "
                                    f"TIMESTAMP '{B.AS_OF}' - INTERVAL {B.TEST_WINDOW_DAYS} DAY THEN 'current' "
                                    "WHEN CAST(published_date AS TIMESTAMP) < "
                                    f"TIMESTAMP '{B.AS_OF}' - INTERVAL {B.TEST_WINDOW_DAYS} DAY THEN 'old' END AS window "
                                    "FROM items")
    four = (f"CAST(published_date AS TIMESTAMP) >= TIMESTAMP '{B.AS_OF}' - INTERVAL {C.DIGEST_DAYS} DAY")
    s["last_four_weeks"] = with_(base, f"SELECT item_id, risk_id, published_date FROM mview WHERE {four}")
    s["attach_risk_ids"] = with_(base, "SELECT item_id, term, risk_id, search_term_id FROM mview")
    s["source_flags"] = with_(DIM_CTES, f"SELECT page_id, {flags(auth('url'))} FROM pages".replace(
        " AS dom,", " AS domain,").replace(" AS in_allow,", " AS in_allow,"))
    s["term_match_any"] = with_(DIM_CTES, f"SELECT doc_id, {term_match('text')} AS term_match FROM documents")
    s["source_list_normalize"] = with_(
        base, f"SELECT DISTINCT {norm('name')} AS name FROM (SELECT source_name AS name FROM raw_items UNION ALL "
              f"SELECT name FROM {values([(v,) for v in B.TEST_BLOCK_LIST], ['name'])}) WHERE {norm('name')} IS NOT NULL")

    dig = [f"m4 AS (SELECT * FROM mview WHERE {four})",
           "dcount AS (SELECT risk_id, count(*) AS article_count FROM m4 WHERE risk_id IS NOT NULL GROUP BY risk_id)",
           "dtop AS (SELECT risk_id, rn, '- ' || substr(title, 1, 200) || '...' AS s FROM (SELECT *, row_number() OVER "
           "(PARTITION BY risk_id ORDER BY published_date DESC NULLS LAST, link, title) AS rn FROM m4 "
           f"WHERE risk_id IS NOT NULL AND title IS NOT NULL) WHERE rn <= {C.DIGEST_SAMPLES})",
           "dsamp AS (SELECT risk_id, string_agg(s, chr(10) ORDER BY rn) AS sample_content FROM dtop GROUP BY risk_id)",
           "digest AS (SELECT c.risk_id, c.article_count, coalesce(s.sample_content, '') AS sample_content "
           "FROM dcount c LEFT JOIN dsamp s ON s.risk_id = c.risk_id)"]
    s["risk_digest"] = with_(base + dig, "SELECT * FROM digest")
    tmpl = C.RISK_PROMPT_TEMPLATE
    s["risk_prompt"] = with_(base + dig, f"SELECT risk_id, article_count, printf({q(tmpl)}, CAST(risk_id AS VARCHAR), "
                                         "CAST(article_count AS VARCHAR), sample_content) AS prompt FROM digest")

    s["risk_narrative"] = (
        f"SELECT risk_id, article_count, CASE WHEN risk_id = {B.FAILING_RISK} THEN 'Error generating narrative for "
        f"Risk ID {B.FAILING_RISK}: no answer' ELSE len(string_split(prompt, chr(10))) || ' lines' END AS narrative "
        f"FROM ({s['risk_prompt']})")
    s["risk_brief"] = with_(
        base + [dig[0]],
        f"SELECT risk_id, count(*) AS n_rows, CASE WHEN risk_id = {B.FAILING_RISK} THEN 'Error for Risk ID "
        f"{B.FAILING_RISK}: no brief' ELSE count(*) || ' mentions: ' || string_agg(title || ' (' || source || ')', '; ' "
        "ORDER BY rn) FILTER (WHERE rn <= 3) END AS brief FROM (SELECT *, row_number() OVER (PARTITION BY risk_id ORDER BY "
        "published_date DESC NULLS LAST, link NULLS FIRST, title NULLS FIRST, item_id) AS rn FROM m4) "
        "WHERE risk_id IS NOT NULL GROUP BY risk_id")
    s["landed_pages"] = f"SELECT {norm('url')} AS link, md5(html) AS html_md5 FROM pages"

    s["quality_score"] = with_(SCORED_PAGES, f"SELECT page_id, {', '.join(SCORE_COLS)}, score_total_score AS "
                                             "quality_score FROM scored")
    s["quality_score_total"] = with_(SCORED_PAGES, "SELECT page_id, score_total_score AS quality_score FROM scored")
    s["score_stats"] = with_(SCORED_PAGES, "SELECT avg(score_total_score) AS mean_score, count(score_total_score) "
                                           "AS scored_rows, count(*) AS total_rows FROM scored")
    s["score_histogram"] = with_(SCORED_PAGES, "SELECT score_total_score AS quality_score, count(*) AS n FROM scored "
                                               "GROUP BY 1")
    comps = [c for c in SCORE_COLS if c != "score_total_score"]
    unp = " UNION ALL ".join(f"SELECT {q(c)} AS component, {c} AS value FROM scored" for c in comps)
    s["score_component_stats"] = with_(
        SCORED_PAGES + [f"longv AS ({unp})"],
        "SELECT component, avg(value) AS mean_value, count(*) FILTER (WHERE value IS NULL OR value <> 0) AS nonzero_ref, "
        "count(*) FILTER (WHERE value <> 0) AS nonzero_strict FROM longv GROUP BY component")

    s["combine_mentions"] = with_(
        base + PAGE_CTES + DOCS_CTES,
        "SELECT 0 AS _batch, title, link, published_date, doc_id AS stored_id, NULL::BIGINT AS item_id FROM docs_store "
        "UNION ALL SELECT 1, title, link, published_date, NULL, item_id FROM items")
    s["dedupe_keep_first"] = with_(
        base + PAGE_CTES + DOCS_CTES + [
            "dup AS (SELECT title, link, published_date, term, feed_pos, item_id FROM items UNION ALL "
            "SELECT title, link, published_date, term, feed_pos, item_id + 1000000 FROM items)",
            "comb AS (SELECT title, link, published_date, doc_id AS stored_id, NULL::VARCHAR AS term, "
            "NULL::BIGINT AS feed_pos, NULL::BIGINT AS item_id, 0 AS _batch FROM docs_store UNION ALL "
            "SELECT title, link, published_date, NULL, term, feed_pos, item_id, 1 FROM dup)"],
        "SELECT title, link, published_date, _batch, stored_id, item_id FROM (SELECT *, row_number() OVER "
        "(PARTITION BY title, link, published_date ORDER BY _batch NULLS FIRST, feed_pos NULLS FIRST, "
        "item_id NULLS FIRST, stored_id NULLS FIRST, term NULLS FIRST) AS rn FROM comb) WHERE rn = 1")
    s["mentions_newest_first"] = with_(base, "SELECT published_date, link, title, item_id FROM items")

    bf = PAGE_CTES + DOCS_CTES
    miss = (f"(summary IS NULL OR {strip('summary')} = '' OR coalesce(length(summary), 0) < "
            f"{C.BACKFILL_MISSING_CHARS})")
    start, end = B.TEST_BACKFILL_RANGE
    cand = (f"SELECT * FROM docs_store WHERE published_date IS NOT NULL AND published_date >= DATE '{start}' "
            f"AND published_date <= DATE '{end}' AND {miss}")
    s["backfill_candidates"] = with_(bf, f"SELECT doc_id, published_date FROM ({cand})")
    batch = (f"SELECT * FROM docs_store WHERE published_date IS NOT NULL AND published_date <= "
             f"(SELECT max(published_date) FROM ({cand})) AND published_date >= (SELECT max(published_date) FROM ({cand})) "
             f"- INTERVAL {C.BACKFILL_BATCH_DAYS - 1} DAY AND {miss}")
    s["backfill_batch"] = with_(bf, f"SELECT doc_id, published_date FROM ({batch})")
    s["backfill_merge"] = with_(
        bf + [f"tgt AS ({batch})",
              "bpg AS (SELECT link, arg_min(html, page_id) AS html FROM pages_n WHERE link IN (SELECT link FROM tgt) "
              "GROUP BY link)",
              f"btx AS (SELECT link, {page_text_backfill('html')} AS new_text FROM bpg)",
              f"btu AS (SELECT * FROM btx WHERE length(new_text) >= {C.BACKFILL_USABLE_CHARS})"]
        + sentiment_ctes("btu", "link", "new_text", "bsent", "pol")
        + ["upd AS (SELECT t.doc_id, u.new_text, s.pol FROM tgt t JOIN btu u ON u.link = t.link "
           "JOIN bsent s ON s.link = u.link)"],
        "SELECT d.doc_id, CASE WHEN u.doc_id IS NOT NULL THEN u.new_text ELSE d.summary END AS summary, "
        f"CASE WHEN u.doc_id IS NOT NULL THEN {label('u.pol')} ELSE d.sentiment END AS sentiment, "
        "CASE WHEN u.doc_id IS NOT NULL THEN u.pol ELSE d.polarity END AS polarity, "
        f"CASE WHEN u.doc_id IS NOT NULL THEN TIMESTAMP '{B.AS_OF}' ELSE d.last_run_timestamp END AS last_run_timestamp, "
        "u.doc_id IS NOT NULL AS backfilled FROM docs_store d LEFT JOIN upd u ON u.doc_id = d.doc_id")

    ej = ("SELECT link, arg_min(html, page_id) AS html FROM pages_n WHERE link IN (SELECT link FROM {src}) "
          "GROUP BY link")
    s["enrich_mentions"] = with_(
        base + PAGE_CTES + [
            f"g1 AS (SELECT * FROM items g WHERE {gate} AND NOT EXISTS (SELECT 1 FROM blk b WHERE b.name = g.source))",
            f"r1 AS (SELECT * FROM g1 WHERE published_date IS NOT NULL AND published_date >= DATE '{B.AS_OF_DATE}' "
            f"- INTERVAL {C.RECENCY_DAYS} DAY)",
            f"pg1 AS ({ej.format(src='r1')})",
            f"pt1 AS (SELECT link, {blank(page_text('html'))} AS summary FROM pg1)"]
        + sentiment_ctes("pt1", "link", "summary", "ps1"),
        "SELECT r.item_id, r.link, coalesce(t.summary, '') AS summary, "
        f"coalesce({label('s.polarity')}, 'neutral') AS sentiment, coalesce(s.polarity, 0.0) AS polarity "
        "FROM r1 r LEFT JOIN pt1 t ON t.link = r.link LEFT JOIN ps1 s ON s.link = r.link")
    s["enrich_defaults"] = with_(
        base + PAGE_CTES + [
            f"pg2 AS (SELECT link, arg_min(html, page_id) AS html FROM pages_n WHERE NOT contains(link, "
            f"{q(C.TRANSLATED_MARKER)}) AND link IN (SELECT link FROM items) GROUP BY link)",
            f"pt2 AS (SELECT link, {blank(page_text('html'))} AS summary FROM pg2)"]
        + sentiment_ctes("pt2", "link", "summary", "ps2"),
        "SELECT i.item_id, length(coalesce(t.summary, '')) AS summary_chars, md5(coalesce(t.summary, '')) AS summary_md5, "
        f"coalesce({label('s.polarity')}, 'neutral') AS sentiment, coalesce(s.polarity, 0.0) AS polarity, "
        "0 AS n_keywords FROM items i LEFT JOIN pt2 t ON t.link = i.link LEFT JOIN ps2 s ON s.link = i.link")
    s["sentiment_mix"] = with_(
        base + PAGE_CTES + [f"pg3 AS ({ej.format(src='mview')})",
                            f"pt3 AS (SELECT link, {blank(page_text('html'))} AS summary FROM pg3)"]
        + sentiment_ctes("pt3", "link", "summary", "ps3"),
        f"SELECT m.risk_id, m.published_date, coalesce({label('s.polarity')}, 'neutral') AS sentiment, count(*) AS n "
        "FROM mview m LEFT JOIN ps3 s ON s.link = m.link GROUP BY 1, 2, 3")

    s["mentions_scan"] = with_(PAGE_CTES + DOCS_CTES, "SELECT doc_id, link, published_date, summary FROM docs_store")
    s["feed_items"] = with_(base, "SELECT i.term, i.result_page, row_number() OVER (PARTITION BY i.term, i.result_page "
                                  "ORDER BY i.feed_pos, i.item_id) - 1 AS feed_pos, i.title, "
                                  "CASE WHEN length(r.feed_link) % 7 <> 0 THEN i.link END AS link, i.source, "
                                  f"{q(B.FEED_HOST.removeprefix('https://'))} AS source_url, i.published_date, "
                                  f"{q(B.FEED_HOST)} AS source_site FROM items i JOIN raw_items r ON r.item_id = i.item_id")
    s["feed_quarantine"] = with_(
        base, "SELECT term, count(*) AS items, CAST(bool_or(result_page = 1) AS BIGINT) AS unreadable FROM raw_items "
              "GROUP BY term")
    s["stream_ingest"] = with_(
        base, "SELECT title, link, published_date, term, source FROM (SELECT *, row_number() OVER (PARTITION BY link "
              f"ORDER BY published_date, term, title, source) AS rn FROM items g WHERE {gate} AND published_date IS NOT NULL "
              "AND NOT EXISTS (SELECT 1 FROM blk b WHERE b.name = g.source)) WHERE rn = 1")
    s["csv_store"] = with_(
        base, "SELECT CAST(item_id AS INTEGER) AS item_id, risk_id, search_term_id, title, "
              "'said \"' || title || '\",' || chr(10) || 'then more' AS summary, "
              "CASE WHEN item_id % 11 <> 0 THEN published_date END AS published_date, link, source, "
              "CAST(item_id % 21 - 10 AS DOUBLE) / 10000 AS polarity, "
              f"{POLARITY_TEXT.replace('polarity AS DECIMAL', 'CAST(item_id % 21 - 10 AS DOUBLE) / 10000 AS DECIMAL')}_text, "
              f"TIMESTAMP '{B.AS_OF}' AS last_run_timestamp FROM mview")
    s["archive_rows"] = with_(
        PAGE_CTES + DOCS_CTES, "SELECT doc_id, link, published_date, summary FROM docs_store WHERE "
        f"CAST(published_date AS TIMESTAMP) < TIMESTAMP '{B.AS_OF}' - INTERVAL {B.TEST_WINDOW_DAYS} DAY")
    s["backfill_publish"] = f"SELECT * EXCLUDE (backfilled) FROM ({s['backfill_merge']})"
    s["narrative_history"] = (f"SELECT risk_id, article_count, prompt, generated_at FROM ({s['risk_prompt']}), "
                              f"(VALUES (TIMESTAMP '{B.EARLIER_AS_OF}'), (TIMESTAMP '{B.AS_OF}')) AS r(generated_at)")
    s["term_match_dictionary"] = (
        f"WITH words AS (SELECT DISTINCT unnest(string_split({title('html')}, ' ')) AS w FROM pages) "
        "SELECT doc_id, EXISTS (SELECT 1 FROM words WHERE w <> '' AND contains(lower(coalesce(text, '')), lower(w))) "
        "AS term_match FROM documents")
    mark = "(ascii(substr(w, 1, 1)) * 7 + ascii(substr(w, 3, 1)) * 5 + ascii(substr(w, 4, 1)))"
    plain = sentiment_ctes("dsrc", "doc_id", "text", "dsent", "compound")
    own = case_map("w", [(k.lower(), v) for k, v in B.TEST_VALENCES], dbl(0.0))
    assert own in plain[2]
    plain[2] = (plain[2].replace(f"list_transform(low, lambda w: {own}) AS base", "coalesce(found, []::DOUBLE[]) AS base")
                .replace("FROM dsent_2)", "FROM dsent_2 LEFT JOIN dbase USING (k))"))
    plain[2:2] = [
        "dtok AS (SELECT k, i, low[i] AS w FROM dsent_2, LATERAL (SELECT unnest(range(1, n + 1)) AS i))",
        f"dbase AS (SELECT k, list(CASE WHEN token IS NULL THEN 0.0::DOUBLE ELSE CAST({mark} % 9 - 4 AS DOUBLE) / 2 END "
        "ORDER BY i) AS found FROM dtok LEFT JOIN dlex ON token = w GROUP BY k)"]
    s["sentiment_derived_lexicon"] = with_(
        ["dlex AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\\b([a-z]{4})\\b', 1)) AS token FROM documents)",
         "dsrc AS (SELECT doc_id, text FROM documents)"] + plain, "SELECT doc_id, compound FROM dsent")
    s["daily_mentions"] = with_(DAILY, "SELECT * EXCLUDE (keywords), CAST(len(keywords) AS INTEGER) AS n_keywords "
                                       "FROM r2_cur")
    exp_cols = []
    for c in OUT_COLS:
        if c == "keywords":
            exp_cols.append("array_to_string(keywords, ',') AS keywords")
        elif c == "polarity":
            exp_cols.append(POLARITY_TEXT)
        elif c == "last_run_timestamp":
            exp_cols.append("strftime(last_run_timestamp, '%Y-%m-%d %H:%M:%S') AS last_run_timestamp")
        else:
            exp_cols.append(c)
    s["export_projection"] = with_(DAILY, f"SELECT {', '.join(exp_cols)} FROM r2_cur")
    s["run_audit"] = with_(
        base + PAGE_CTES + DOCS_CTES
        + [f"gated AS (SELECT * FROM items g WHERE {gate} AND NOT EXISTS (SELECT 1 FROM blk b WHERE b.name = g.source))",
           f"fresh AS (SELECT * FROM gated g WHERE NOT EXISTS (SELECT 1 FROM docs_store s WHERE {norm('s.link')} = g.link))"],
        "SELECT (SELECT count(*) FROM dict) AS loaded_terms, (SELECT count(*) FROM dict WHERE search_terms IS NOT NULL) "
        "AS valid_terms, (SELECT count(*) FROM raw_items) AS items_landed, "
        "(SELECT count(*) FROM raw_items) - (SELECT count(*) FROM items) AS items_dropped, "
        "(SELECT count(*) FROM docs_store) AS stored_rows, (SELECT count(DISTINCT link) FROM docs_store) AS existing_links, "
        "(SELECT count(*) FROM docs_store WHERE CAST(published_date AS TIMESTAMP) >= "
        f"TIMESTAMP '{B.AS_OF}' - INTERVAL {B.TEST_WINDOW_DAYS} DAY) AS stored_current_rows, "
        "(SELECT count(*) FROM docs_store) + (SELECT count(*) FROM fresh) AS combined_rows, "
        f"(SELECT count(*) FROM ({s['backfill_merge']}) WHERE backfilled) AS updated_rows, "
        "(SELECT count(*) FROM fresh) AS new_rows, "
        "(SELECT count(*) FROM items) AS items_found, (SELECT count(*) FROM gated) AS items_after_gates, "
        "(SELECT count(*) FROM items WHERE published_date IS NULL) AS null_dates, "
        "(SELECT count(DISTINCT link) FROM items) AS distinct_links")
    return s
