"""Regex building blocks shared by the text functions.

Java regex (Spark) and RE2 (used by the SQL oracles) disagree on the meaning of
``\\s``, ``\\d`` and ``\\w`` outside ASCII, while the source semantics follow
Python's Unicode classes.  We therefore spell the classes out explicitly so
that Spark, the oracle and the original behaviour agree on every input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts.
WS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# Decimal digit and word character as Python's Unicode str patterns see them.
DIGIT = r"\p{Nd}"
WORD = r"[\p{L}\p{N}_]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col(c), f"^{WS}+|{WS}+$", "")


def strip_chars(c, chars_class: str) -> Column:
    """``str.strip(chars)`` for a regex character class body such as ``*_ ``."""
    return F.regexp_replace(col(c), f"^[{chars_class}]+|[{chars_class}]+$", "")


def nullif_empty(c) -> Column:
    c = col(c)
    return F.when(c == "", F.lit(None)).otherwise(c)


def nullif_zero(c) -> Column:
    c = col(c)
    return F.when(c == 0, F.lit(None)).otherwise(c)


def parse_decimal_comma(c) -> Column:
    """Whitespace removed, decimal comma to dot, then double (null if unparsable)."""
    cleaned = F.replace(F.regexp_replace(col(c), f"{WS}+", ""), F.lit(","), F.lit("."))
    return cleaned.try_cast("double")
