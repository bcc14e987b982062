"""String, URL and HTML-text functions as native Column expressions.

All of these stay inside the JVM (no Python UDF), so they run inside
whole-stage codegen or as higher-order functions on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.functions.literals import string_array_literal

# Characters treated as whitespace by str.split() / str.strip(): the ASCII
# blanks, the information separators 0x1c-0x1f, NEL, NBSP and the Unicode
# space separators. The same class text is valid in Java regex and RE2.
WS_CLASS = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# ASCII punctuation, stripped from token edges by the sentiment tokenizer.
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"

_AUTHORITY_RE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_SOURCE_SITE_RE = r"(?U)https?:[\w#@%;$()~?+\-./:<=\\&,]*"
_STRIP_RE = rf"^{WS_CLASS}+|{WS_CLASS}+$"
_SCRIPT_STYLE_COMMENT_RE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
# a tag with its attributes (values may hold '>'), or a declaration; runs are possessive, so that a
# long attribute or a tag without an end costs one pass
_TAG_RE = r"""<(?:/?[a-zA-Z][^\s/>]*+(?:[^'">]++|"[^"]*+"|'[^']*+')*+|[!?][^>]*+)>"""
_TAG_NAME_RE = r"^</?([a-zA-Z][^\s/>]*)"
_TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def once(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` names it, also inside lambdas
    (the optimiser may put a column's expression back into a lambda that reads it)."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def strip_ws(col) -> Column:
    """str.strip(): remove leading / trailing (Unicode) whitespace."""
    return F.regexp_replace(_c(col), _STRIP_RE, "")


def normalize_name(col) -> Column:
    """lower() then strip(): source names, block / allow list entries, links."""
    return strip_ws(F.lower(_c(col)))


def authority(col) -> Column:
    """netloc of a URL (user-info and port kept, case kept); '' without '//'."""
    return F.regexp_extract(_c(col), _AUTHORITY_RE, 1)


def score_domain(col) -> Column:
    """Domain used by the quality score: lower, add https:// if no http(s) scheme, netloc."""
    low = F.lower(F.coalesce(_c(col).cast("string"), F.lit("")))
    with_scheme = F.when(
        low.startswith("http://") | low.startswith("https://"), low
    ).otherwise(F.concat(F.lit("https://"), low))
    return F.lower(authority(with_scheme))


def source_site(col) -> Column:
    """First http(s) URL-like run inside a feed item's source element; NULL if none."""
    hit = F.regexp_extract(_c(col), _SOURCE_SITE_RE, 0)
    return F.when(hit == "", F.lit(None).cast("string")).otherwise(hit)


ENTITY_RE = r"^(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def named_entities() -> dict[str, str]:
    """Named character references (closed by a semicolon) of the HTML standard, from Python's table."""
    from html.entities import html5
    return {k[:-1]: v for k, v in sorted(html5.items()) if k.endswith(";")}


# the references that make up nearly all of a page's, tested before the table is searched
COMMON_ENTITIES = ("amp", "lt", "gt", "quot", "apos", "nbsp", "rsquo", "lsquo", "rdquo", "ldquo", "mdash", "ndash", "hellip")


def _entity_map() -> Column:
    table = named_entities()
    return F.map_from_arrays(string_array_literal(list(table)), string_array_literal(list(table.values())))


def decode_entities(col) -> Column:
    """Named and numeric character references decoded once, from left to right; what is no
    known reference stays as it is."""
    names, table = _entity_map(), named_entities()

    def named(ref: Column) -> Column:
        out = F.when(ref == COMMON_ENTITIES[0], table[COMMON_ENTITIES[0]])
        for name in COMMON_ENTITIES[1:]:
            out = out.when(ref == name, table[name])
        return out.otherwise(F.try_element_at(names, ref))

    def decode(piece: Column) -> Column:
        ref = F.regexp_extract(piece, ENTITY_RE, 1)
        code = F.when(F.lower(F.substring(ref, 1, 2)) == "#x", F.conv(F.substring(ref, 3, 8), 16, 10)) \
                .when(F.substring(ref, 1, 1) == "#", F.substring(ref, 2, 8)).try_cast("int")
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(ref == "", F.lit(None)).when(F.substring(ref, 1, 1) != "#", named(ref)) \
                .when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        rest = F.substring(piece, F.length(ref) + 2, F.length(piece))
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    text = _c(col)
    pieces = F.split(text, "&", -1)
    head, tail = F.get(pieces, F.lit(0)), F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.when(~F.contains(text, F.lit("&")), text) \
            .otherwise(F.concat(head, F.array_join(F.transform(tail, decode), "")))


def page_title(html) -> Column:
    return strip_ws(decode_entities(F.regexp_extract(_c(html), _TITLE_RE, 1)))


def _tags(html: Column) -> Column:
    """The tags of a page and the text after each: array of (name, kind, text), kind 1 for an opening
    tag, -1 for a closing one, 0 for what leaves the open elements as they are (void and
    self-closing elements, declarations, the place of a comment, script or style sheet)."""
    clean = F.regexp_replace(html, _SCRIPT_STYLE_COMMENT_RE, "<!>")
    tags = F.regexp_extract_all(clean, F.lit(_TAG_RE), 0)
    after = F.slice(F.split(clean, _TAG_RE, -1), 2, F.size(tags))  # the first piece stands before any tag

    def of(pair: Column) -> Column:
        tag = pair["tag"]
        name = F.lower(F.regexp_extract(tag, _TAG_NAME_RE, 1))
        kind = (F.when((name == "") | name.isin(*C.VOID_ELEMENTS) | tag.endswith("/>"), 0)
                .when(F.startswith(tag, F.lit("</")), -1).otherwise(1))
        return F.struct(name.alias("name"), kind.alias("kind"), pair["text"].alias("text"))

    return F.transform(F.arrays_zip(tags.alias("tag"), after.alias("text")), of)


def _paragraphs(html) -> Column:
    """Text nodes of every paragraph, raw: an array of strings for each ``<p>``.

    The tags are folded with a stack of open elements. A closing tag closes the innermost open
    element of its name with all inside it, and means nothing if there is none; so a
    paragraph ends with its own tag or with an element around it, and nested blocks stay in it.
    A new paragraph closes an open one. ``at`` is the paragraph's place in the stack, 0 outside."""
    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(0).alias("at"),
                     F.array().cast("array<string>").alias("nodes"),
                     F.array().cast("array<array<string>>").alias("done"))

    def state(acc: Column, open_: Column, at: Column, text: Column) -> Column:
        """The next state: ``text`` goes to the paragraph if one is open; a paragraph that was
        open and is no more, or gave way to another one, is done."""
        left = (acc["at"] > 0) & ((at == 0) | (F.size(open_) < acc["at"]) | (at != acc["at"]))
        nodes = F.when(left, F.array().cast("array<string>")).otherwise(acc["nodes"])
        return F.struct(
            open_.alias("open"), at.alias("at"),
            F.when(at == 0, F.array().cast("array<string>")).otherwise(F.array_append(nodes, text)).alias("nodes"),
            F.when(left, F.array_append(acc["done"], acc["nodes"])).otherwise(acc["done"]).alias("done"))

    def step(acc: Column, tag: Column) -> Column:
        outside = F.slice(acc["open"], 1, acc["at"] - 1)  # the elements around an open paragraph
        place = F.size(acc["open"]) + 1 - F.array_position(F.reverse(acc["open"]), tag["name"]).cast("int")
        closes = (tag["kind"] == -1) & F.array_contains(acc["open"], tag["name"])
        fresh = F.struct(F.array_append(outside, F.lit("p")).alias("open"), acc["at"].alias("at"),
                         F.array(tag["text"]).alias("nodes"),
                         F.array_append(acc["done"], acc["nodes"]).alias("done"))
        return (F.when((tag["kind"] == 1) & (tag["name"] == "p") & (acc["at"] > 0), fresh)
                .when((tag["kind"] == 1) & (tag["name"] == "p"),
                      state(acc, F.array_append(acc["open"], F.lit("p")), F.size(acc["open"]) + 1, tag["text"]))
                .when(tag["kind"] == 1, state(acc, F.array_append(acc["open"], tag["name"]), acc["at"], tag["text"]))
                .when(closes, state(acc, F.slice(acc["open"], 1, place - 1),
                                    F.when(place <= acc["at"], 0).otherwise(acc["at"]), tag["text"]))
                .otherwise(state(acc, acc["open"], acc["at"], tag["text"])))

    def done(acc: Column) -> Column:
        return F.when(acc["at"] > 0, F.array_append(acc["done"], acc["nodes"])).otherwise(acc["done"])

    return F.aggregate(_tags(_c(html)), start, step, done)


def page_text(html) -> Column:
    """Live extraction: every paragraph's text stripped, joined by one space
    (empty paragraphs kept, so they leave a double space). No <p> gives ''."""
    paras = F.transform(_paragraphs(html), lambda nodes: strip_ws(decode_entities(F.array_join(nodes, ""))))
    return F.coalesce(F.array_join(paras, " "), F.lit(""))


def page_text_backfill(html) -> Column:
    """Backfill extraction: per paragraph, every text node stripped and glued
    without a separator; empty paragraphs dropped; joined by one space."""
    paras = F.transform(
        _paragraphs(html),
        lambda nodes: F.array_join(F.transform(nodes, lambda t: strip_ws(decode_entities(t))), ""))
    return strip_ws(F.coalesce(F.array_join(F.filter(paras, lambda p: p != ""), " "), F.lit("")))


def blank_short(col, min_chars: int = C.MIN_ARTICLE_CHARS) -> Column:
    """Text with fewer than ``min_chars`` characters becomes ''."""
    def blank(t: Column) -> Column:
        return F.when(F.length(t) < min_chars, F.lit("")).otherwise(t)

    text = F.coalesce(_c(col), F.lit(""))
    return blank(text) if isinstance(col, str) else once(text, blank)


def words(col) -> Column:
    """str.split(): whitespace-separated words (no empty strings)."""
    return F.filter(F.split(F.coalesce(_c(col), F.lit("")), WS_CLASS + "+"), lambda w: w != "")


def word_count(col) -> Column:
    return F.size(words(col))


def snippet(col) -> Column:
    return F.concat(
        F.lit(C.SNIPPET_PREFIX), F.substring(_c(col), 1, C.SNIPPET_CHARS), F.lit(C.SNIPPET_SUFFIX)
    )


def ends_with_any(col, suffixes) -> Column:
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | _c(col).endswith(s)
    return cond
