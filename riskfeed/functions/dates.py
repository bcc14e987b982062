"""Date parsing and coercion as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A feed date's calendar day as written is the date in the feed's own zone. Forms: "10 Sep 2025"
# (also with a full month name, hyphens or a two-digit year), "Sep 10, 2025", "2025-09-10", "2025/9/10".
DAY_FIRST_RE = r"(\d{1,2})[ -]([A-Za-z]{3})[A-Za-z]*\.?[ -](\d{4}|\d{2})\b"
MONTH_FIRST_RE = r"\b([A-Za-z]{3})[A-Za-z]*\.? (\d{1,2}),? (\d{4})\b"
YEAR_FIRST_RE = r"^\s*(\d{4})[-/](\d{1,2})[-/](\d{1,2})"
CENTURY_FROM = 69  # two-digit years from here on are of the last century


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_pubdate(col) -> Column:
    """Lenient feed-date parse -> DATE in the feed's zone; unparsable -> NULL."""
    s = _c(col)

    def part(pattern: str, i: int) -> Column:
        return F.regexp_extract(s, pattern, i)

    def date(text: Column, form: str) -> Column:
        return F.to_date(F.try_to_timestamp(text, F.lit(form)))

    year = part(DAY_FIRST_RE, 3)
    year = F.when(F.length(year) != 2, year) \
            .when(year >= str(CENTURY_FROM), F.concat(F.lit("19"), year)).otherwise(F.concat(F.lit("20"), year))
    return F.coalesce(
        date(F.concat_ws(" ", part(DAY_FIRST_RE, 1), part(DAY_FIRST_RE, 2), year), "d MMM yyyy"),
        date(F.concat_ws(" ", part(MONTH_FIRST_RE, 2), part(MONTH_FIRST_RE, 1), part(MONTH_FIRST_RE, 3)), "d MMM yyyy"),
        date(F.concat_ws("-", *[part(YEAR_FIRST_RE, i) for i in (1, 2, 3)]), "yyyy-M-d"),
    )


def coerce_date(col) -> Column:
    """to_datetime(errors='coerce') for a stored date column: DATE / TIMESTAMP kept,
    strings parsed as ISO date (time part ignored), anything else NULL."""
    return parse_pubdate(_c(col).cast("string"))

