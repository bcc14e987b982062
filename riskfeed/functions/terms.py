"""Search-term codec: a term is stored as the decimal form of the integer whose
little-endian bytes are the term's UTF-8 encoding.

Both directions are base conversions done with nested ``aggregate`` over limbs of six
decimal digits and three bytes (products stay within BIGINT), so they run as native
expressions on the executors and handle numbers far beyond DECIMAL(38).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# groups of six decimal digits -> little-endian limbs of three bytes -> bytes without leading zeros
_DECODE_SQL = """
CASE WHEN {c} RLIKE '^[0-9]+$' THEN
  try_validate_utf8(CAST(try_to_binary(regexp_replace(array_join(transform(
    aggregate(
      transform(sequence(0, (length({c}) - 1) DIV 6),
                i -> CAST(substr(lpad({c}, ((length({c}) + 5) DIV 6) * 6, '0'), CAST(i * 6 + 1 AS INT), 6) AS BIGINT)),
      CAST(array() AS ARRAY<BIGINT>),
      (acc, d) -> aggregate(acc,
        named_struct('o', CAST(array() AS ARRAY<BIGINT>), 'c', d),
        (st, b) -> named_struct('o', array_append(st.o, (b * 1000000 + st.c) % 16777216),
                                'c', (b * 1000000 + st.c) DIV 16777216),
        st -> if(st.c > 0, array_append(st.o, st.c), st.o))),
    b -> concat(lpad(hex(b % 256), 2, '0'), lpad(hex((b DIV 256) % 256), 2, '0'), lpad(hex(b DIV 65536), 2, '0'))),
  ''), '(00)+$', ''), 'hex') AS STRING))
END
"""

# the text's bytes from the last to the first, in groups of three -> little-endian limbs of six decimal digits
_HEX = "array_join(reverse(filter(split(hex(encode({c}, 'UTF-8')), '(?<=\\\\G..)'), x -> x <> '')), '')"
_ENCODE_SQL = """
CASE WHEN {c} IS NOT NULL THEN
  coalesce(nullif(trim(LEADING '0' FROM array_join(reverse(transform(
    aggregate(
      transform(sequence(0, greatest(length({hex}) - 1, 0) DIV 6),
                i -> CAST(conv(substr(lpad({hex}, greatest((length({hex}) + 5) DIV 6, 1) * 6, '0'),
                                      CAST(i * 6 + 1 AS INT), 6), 16, 10) AS BIGINT)),
      CAST(array() AS ARRAY<BIGINT>),
      (acc, limb) -> aggregate(acc,
        named_struct('o', CAST(array() AS ARRAY<BIGINT>), 'c', limb),
        (st, q) -> named_struct('o', array_append(st.o, (q * 16777216 + st.c) % 1000000),
                                'c', (q * 16777216 + st.c) DIV 1000000),
        st -> aggregate(sequence(1, 2), st,
                (s2, i) -> if(s2.c > 0,
                              named_struct('o', array_append(s2.o, s2.c % 1000000), 'c', s2.c DIV 1000000),
                              s2)).o)),
    d -> lpad(CAST(d AS STRING), 6, '0'))), '')), ''), '0')
END
"""


def decode_term(col: str) -> Column:
    """Decimal string -> text; NULL for non-digits, NULL input or invalid UTF-8.
    '0' decodes to ''."""
    return F.expr(_DECODE_SQL.format(c=f"`{col}`"))


def encode_term(col: str) -> Column:
    """Inverse of :func:`decode_term` for any text (used to build dictionaries)."""
    return F.expr(_ENCODE_SQL.format(c=f"`{col}`", hex=_HEX.format(c=f"`{col}`")))


def to_int_or_null(col: str) -> Column:
    """Numeric coercion of an id column: anything non-numeric becomes NULL."""
    return F.expr(f"try_cast(try_cast(try_cast(`{col}` AS DOUBLE) AS BIGINT) AS INT)")
