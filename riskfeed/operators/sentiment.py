"""SEN1: rule + lexicon sentiment over whole texts, as a map-side Spark job.

Each text is tokenised and scored with higher-order functions inside the JVM
(no Python). The lexicon, booster, negation and contrast tables
are first brought to one row per lower-cased token (the strongest value, of equally strong ones
the positive), then shipped to the tasks as literals, after a check of their size
(higher-order functions cannot hold subqueries); a larger lexicon is joined to the exploded tokens
instead, with the same scores.

Rules (published rule + lexicon method; constants in ``constants``):
 1. tokens = whitespace split, ASCII punctuation stripped from both edges,
    empty tokens dropped; lookups use the lower-cased token
 2. base valence from the lexicon; a token of capitals only, in a text that
    also has other tokens, is moved away from zero by the caps increment
 3. a booster 1, 2 or 3 tokens before a scored token adds its weight times the
    damping for that distance, in the direction of the valence; then each
    negation 1, 2 or 3 tokens before multiplies by the negation scalar
 4. first contrast word at p: tokens before x0.5, after x1.5
 5. s = sum; '!' (at most 4) and '?' (2-3 each, more = cap) emphasis added in
    the direction of s
 6. compound = round(s / sqrt(s^2 + alpha), 4); no tokens -> 0.0
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeed import constants as C
from riskfeed.functions import text as X
from riskfeed.operators.common import (_memo, double_array_literal, literal_map, maybe_broadcast,
                                       string_array_literal)

_EDGE_PUNCT = rf"^{X.PUNCT_CLASS}+|{X.PUNCT_CLASS}+$"


def tokens(text: Column) -> Column:
    """Whitespace tokens with ASCII punctuation stripped from both edges, empty
    ones dropped. One split per text: a separator is a run of whitespace with
    the punctuation touching it, so punctuation-only tokens vanish with it."""
    p, ws = X.PUNCT_CLASS, X.WS_CLASS
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^(?:{p}|{ws})+|(?:{p}|{ws})+$", "")
    return F.filter(F.split(trimmed, rf"{p}*(?:{ws}+{p}*)+"), lambda w: w != "")


def one_per_token(df: DataFrame, value: str | None = None) -> DataFrame:
    """(k, v): a row per lower-cased token; of several values the strongest, then the positive one."""
    v = F.col(value).cast("double") if value else F.lit(1.0)
    rows = df.select(F.lower("token").alias("k"), v.alias("v")).where(F.col("k").isNotNull() & F.col("v").isNotNull())
    return rows.groupBy("k").agg(F.max(F.struct(F.abs("v").alias("a"), "v"))["v"].alias("v"))


def _map_of(df: DataFrame, value: str | None, value_type: str, bound: int = C.MAX_INLINE_LEXICON) -> Column:
    one = one_per_token(df, value)
    return literal_map(one, F.col("k"), F.col("v") if value else F.lit(True), bound, value_type)


class Lexicon:
    """Lexicon tables: valences(token, valence), boosters(token, weight),
    negations(token), contrasts(token)."""

    def __init__(self, valences: DataFrame, boosters: DataFrame, negations: DataFrame,
                 contrasts: DataFrame):
        self.valences = valences
        self.boosters = boosters
        self.negations = negations
        self.contrasts = contrasts

    def inline(self, bound: int = C.MAX_INLINE_LEXICON):
        """The lexicon as literals: the array of its words with a valence other than 0, and a function
        from one of them to its valence. None when it exceeds ``bound`` words."""
        sel = one_per_token(self.valences, "valence")
        rows = _memo(sel, "rows", bound, lambda: sel.limit(bound + 1).collect())
        if len(rows) > bound:
            return None
        table = dict(rows)
        keys = sorted((k for k, v in table.items() if v), key=lambda k: k.encode("utf-8"))  # Spark's order of strings
        karr = string_array_literal(keys)
        varr = double_array_literal([table[k] for k in keys])
        n = len(keys)

        def valence(w: Column) -> Column:
            """Binary search; ``w`` is one of the keys."""
            init = F.struct(F.lit(1).alias("lo"), F.lit(n).alias("hi"))

            def step(st, _):
                mid = F.floor((st["lo"] + st["hi"]) / 2).cast("int")
                go_right = F.get(karr, mid - 1) < w
                return F.struct(F.when(go_right, mid + 1).otherwise(st["lo"]).alias("lo"),
                                F.when(go_right, st["hi"]).otherwise(mid).alias("hi"))

            found = F.aggregate(F.array_repeat(F.lit(0), n.bit_length()), init, step)
            return F.get(varr, found["lo"] - 1)

        return karr, valence

    def rule_maps(self, bound: int = C.MAX_INLINE_LEXICON):
        """Booster, negation and contrast maps: word lists of the language's rules."""
        return (
            _map_of(self.boosters, "weight", "double", bound),
            _map_of(self.negations, None, "boolean", bound),
            _map_of(self.contrasts, None, "boolean", bound),
        )


def _first_contrast(low: Column, contrast_m: Column) -> Column:
    """Place of the first contrast word (from 1), 0 without one."""
    return F.array_position(F.transform(low, lambda w: F.coalesce(F.try_element_at(contrast_m, w), F.lit(False))), True)


def _score_hits(df: DataFrame, text_col: str, boost_m: Column, neg_m: Column,
                contrast_m: Column, out_col: str) -> DataFrame:
    """Steps 2-6 on a frame that has ``_tok`` / ``_low`` (tokens, lower-cased) and ``_hits``: the
    places (from 0) and valences of lexicon words, in order.

    Only the three words before a hit are looked up as boosters and negations, and only a hit of
    capitals asks whether the text has other tokens; nothing else is computed per token."""
    low, n = F.col("_low"), F.size("_tok")

    def one(h, text):
        i, v0 = h["i"], h["v"]
        sign = F.signum(v0)
        v = F.when(F.get("_tok", i).rlike("^[A-Z]+$") & text["plain"], v0 + sign * C.SENT_CAPS_INCREMENT).otherwise(v0)
        for d, damp in zip((1, 2, 3), C.SENT_BOOSTER_DAMPING):
            v = v + sign * F.coalesce(F.try_element_at(boost_m, F.get(low, i - d)), F.lit(0.0)) * damp
        for d in (1, 2, 3):
            v = v * F.when(F.coalesce(F.try_element_at(neg_m, F.get(low, i - d)), F.lit(False)),
                           F.lit(C.SENT_NEGATION_SCALAR)).otherwise(F.lit(1.0))
        place, first = i + 1, text["first"]
        return v * (F.when((first == 0) | (place == first), F.lit(1.0))
                    .when(place < first, F.lit(C.SENT_CONTRAST_BEFORE)).otherwise(F.lit(C.SENT_CONTRAST_AFTER)))

    text = F.struct(_first_contrast(low, contrast_m).alias("first"),
                    F.exists("_tok", lambda w: ~w.rlike("^[A-Z]+$")).alias("plain"))
    total = X.once(text, lambda t: F.aggregate(F.transform("_hits", lambda h: one(h, t)), F.lit(0.0), lambda a, x: a + x))
    st = df.withColumn("_s", F.when(F.size("_hits") > 0, total).otherwise(F.lit(0.0)))
    t = F.coalesce(F.col(text_col), F.lit(""))
    n_excl = F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))
    n_q = F.length(t) - F.length(F.replace(t, F.lit("?"), F.lit("")))
    emph = (F.least(n_excl, F.lit(C.SENT_EXCLAIM_MAX)) * C.SENT_EXCLAIM_WEIGHT
            + F.when(n_q > 3, F.lit(C.SENT_QUESTION_MAX))
               .when(n_q > 1, n_q * C.SENT_QUESTION_WEIGHT).otherwise(F.lit(0.0)))
    s = F.col("_s")
    st = st.withColumn("_s2", F.when(s > 0, s + emph).when(s < 0, s - emph).otherwise(s))
    s2 = F.col("_s2")
    st = st.withColumn(out_col, F.when(n == 0, F.lit(0.0)).otherwise(
        F.round(s2 / F.sqrt(s2 * s2 + C.SENT_NORMALIZE_ALPHA), 4)))
    return (st.drop("_tok", "_low", "_hits", "_s", "_s2")
            .withColumn(out_col + "_label", label(F.col(out_col))))


def label(comp: Column) -> Column:
    """FN12: <= -0.05 negative, >= 0.05 positive, else neutral."""
    return (F.when(comp <= C.NEGATIVE_AT_MOST, F.lit("negative"))
            .when(comp >= C.POSITIVE_AT_LEAST, F.lit("positive"))
            .otherwise(F.lit("neutral")))


def score_texts(df: DataFrame, text_col: str, key_col: str, lex: Lexicon,
                out_col: str = "compound", bound: int = C.MAX_INLINE_LEXICON) -> DataFrame:
    """Add ``out_col`` (compound) and ``<out_col>_label`` to ``df``.

    Hits come first: where a text has lexicon words. Up to ``bound`` words the lexicon is a sorted
    literal array: the distinct words of a text that it holds are found by a hash set and
    valued by binary search, no row moves. Beyond it the tokens are exploded and joined to the
    lexicon (broadcast if its size is proven small), and only the hits are regrouped per row.
    ``key_col`` need not be unique: the rows are numbered and written once, so
    their numbers hold on both sides of the join back.
    """
    inline = lex.inline(bound)
    maps = lex.rule_maps()
    if inline is not None:
        words, valence = inline
        low = F.col("_low")

        def hits(own, values):
            at = F.filter(F.transform(low, lambda w, i: F.struct(i.alias("i"), F.array_position(own, w).cast("int").alias("p"))),
                          lambda h: h["p"] > 0)
            return F.transform(at, lambda h: F.struct(h["i"].alias("i"), F.get(values, h["p"] - 1).alias("v")))

        staged = df.withColumn("_tok", tokens(F.col(text_col)))
        staged = staged.withColumn("_low", F.transform("_tok", lambda w: F.lower(w)))
        staged = staged.withColumn("_hits", X.once(F.array_intersect(low, words), lambda own: F.when(
            F.size(own) > 0, X.once(F.transform(own, valence), lambda values: hits(own, values)))
            .otherwise(F.array().cast("array<struct<i:int,v:double>>"))))
        return _score_hits(staged, text_col, *maps, out_col)
    from riskfeed.plans.daily import materialize
    df = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    words = df.select("_row", F.posexplode(tokens(F.col(text_col))).alias("i", "w")).withColumn("k", F.lower("w"))
    values = one_per_token(lex.valences, "valence").where("v <> 0")
    met = words.join(maybe_broadcast(values, C.MAX_BROADCAST_BYTES), "k").select("_row", "i", "v")
    hits = met.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("_hits"))
    staged = df.join(hits, "_row", "left").drop("_row")
    staged = staged.withColumn("_hits", F.coalesce("_hits", F.array().cast("array<struct<i:int,v:double>>")))
    staged = staged.withColumn("_tok", tokens(F.col(text_col)))
    staged = staged.withColumn("_low", F.transform("_tok", lambda w: F.lower(w)))
    return _score_hits(staged, text_col, *maps, out_col)
