"""Parameters and fixed values of the mention engine.

Everything under "Fixed values" must equal the behaviour being reproduced
(gates, score funnel, thresholds, prompt format). Everything under
"Defaults" is a tunable parameter with the reproduced default.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Fixed values (must match the reproduced behaviour exactly)
# --------------------------------------------------------------------------

# Link gate: the resolved link's authority must end with one of these.
LINK_TLDS = (".com", ".edu", ".org", ".net")
# Quality score: the scored domain must end with one of these (".gov" passes here).
SCORE_TLDS = (".com", ".org", ".gov", ".edu", ".net")
# Translated-page marker: links containing it are dropped.
TRANSLATED_MARKER = "/en/"
# Clickbait pattern, matched against the lower-cased title.
CLICKBAIT_PATTERN = "(you won't believe|shocking|unbelievable|what happened next)"
# Quality score component names, in funnel order.
SCORE_COMPONENTS = (
    "whitelist_bonus",
    "blacklist_non_us_penalty",
    "search_term_matches",
    "domain_penalty",
    "us_bonus",
    "clickbait_penalty",
    "length_150",
    "length_500",
    "total_score",
)
WHITELIST_BONUS = 2
BLACKLIST_PENALTY = -999
# Sentiment label thresholds (both inclusive).
NEGATIVE_AT_MOST = -0.05
POSITIVE_AT_LEAST = 0.05
# Word-count thresholds of the length bonus (strictly greater than).
LENGTH_BONUS_WORDS = (150, 500)
# Snippet of a digest sample: prefix, length, suffix.
SNIPPET_PREFIX = "- "
SNIPPET_CHARS = 200
SNIPPET_SUFFIX = "..."
DIGEST_SAMPLES = 5
# Column-name words used to find the date and the text column of a store.
DATE_COLUMN_WORDS = ("date", "time")
TEXT_COLUMN_WORDS = ("title", "summary", "content", "text", "headline")
# Enrichment defaults when a page is missing or unusable.
DEFAULT_SENTIMENT = "neutral"
DEFAULT_POLARITY = 0.0
# Narrative prompt. Slots: risk id, mention count, sample lines (printf-style, filled by
# format_string).
RISK_PROMPT_TEMPLATE = """
        You are an expert risk analyst. Analyze the following emerging risk data from the last 4 weeks and create a comprehensive narrative summary.
        
        EMERGING RISK ID: %s
        NUMBER OF ARTICLES/MENTIONS: %s
        TIME PERIOD: Last 4 weeks
        
        SAMPLE CONTENT:
        %s
        
        Please provide:
        1. **Executive Summary** (2-3 sentences about what this emerging risk represents)
        2. **Recent Developments** (What has happened in the last 4 weeks?)
        3. **Key Themes** (What are the main topics/concerns?)
        4. **Risk Level Assessment** (Low/Medium/High and why)
        5. **Potential Impact** (What could happen if this risk materializes?)
        6. **Recommended Actions** (What should be monitored or done?)
        
        Keep the narrative concise but comprehensive (300-500 words). Focus on actionable insights.
        """

# --------------------------------------------------------------------------
# Defaults (parameters)
# --------------------------------------------------------------------------

MAX_TERMS = 100                  # caps of the reproduced jobs, applied only where asked for
MAX_ITEMS_PER_TERM = 20
MIN_ARTICLE_CHARS = 100          # live text shorter than this is blanked
BACKFILL_MISSING_CHARS = 40      # summaries shorter than this are "missing"
BACKFILL_USABLE_CHARS = 30       # new text shorter than this is not used
BACKFILL_BATCH_DAYS = 3
BACKFILL_RANGE = ("2025-03-17", "2025-04-20")
RECENCY_DAYS = 1
WINDOW_DAYS = 120
DIGEST_DAYS = 28

# elements without content
VOID_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
                 "track", "wbr")

# Size bounds for data that is shipped whole to every task.
MAX_INLINE_TERMS = 5000          # term array embedded into the substring test
MAX_INLINE_LEXICON = 5000        # lexicon embedded as a sorted literal array
SIGNATURE_SAMPLE = 1000          # texts whose grams say which gram of a term is the rarest
MAX_BROADCAST_BYTES = 32 << 20   # allow / block lists and dictionaries broadcast as hash tables

# Sentiment rule constants (published method; rule set in the survey).
SENT_CAPS_INCREMENT = 0.733
SENT_BOOSTER_DAMPING = (1.0, 0.95, 0.9)   # distance 1, 2, 3
SENT_NEGATION_SCALAR = -0.74
SENT_CONTRAST_BEFORE = 0.5
SENT_CONTRAST_AFTER = 1.5
SENT_EXCLAIM_WEIGHT = 0.292
SENT_EXCLAIM_MAX = 4
SENT_QUESTION_WEIGHT = 0.18
SENT_QUESTION_MAX = 0.96
SENT_NORMALIZE_ALPHA = 15
