"""String helpers whose Unicode behaviour is fixed, as built-in Spark expressions.

Spark's own ``trim``, ``\\s`` and ``\\w`` know ASCII only.  The classes below are written out, so that a
plan stays inside whole-stage code and gives the same result as Unicode-aware Python code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Unicode calls white space (property White_Space).
UNICODE_SPACE = r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: What Python's ``str.isspace`` accepts: the same and four separators of ASCII.
PYTHON_SPACE = r"\x1C-\x1F" + UNICODE_SPACE
#: The characters that Python's ``\w`` matches; Java's own ``\w`` is either ASCII or counts combining marks too.
WORD_CHAR = r"\p{L}\p{N}_"


def strip(col: Column, spaces: str = PYTHON_SPACE) -> Column:
    """``str.strip`` for all white space, null for null."""
    return F.regexp_replace(col, f"^[{spaces}]+|[{spaces}]+$", "")


def collapse(col: Column, spaces: str = PYTHON_SPACE) -> Column:
    """Each run of white space as one plain space."""
    return F.regexp_replace(col, f"[{spaces}]+", " ")


def normalize_term(col: Column, spaces: str = PYTHON_SPACE) -> Column:
    """Trimmed, lower-cased, runs of white space as one space; blank stays an empty string, null stays null."""
    return F.lower(strip(collapse(col, spaces), " "))


def normalize_query(col: Column) -> Column:
    """A search phrase without surrounding white space and without one matching pair of outer quotes."""
    s = strip(col)
    quoted = (F.length(s) >= 2) & (s.startswith('"') & s.endswith('"') | s.startswith("'") & s.endswith("'"))
    return F.when(quoted, strip(F.substr(s, F.lit(2), F.length(s) - 2))).otherwise(s)


def exact_query(col: Column) -> Column:
    """The normalised phrase in double quotes; applying it twice changes nothing."""
    return F.concat(F.lit('"'), normalize_query(col), F.lit('"'))


def quote_literal(col: Column) -> Column:
    """A column as a literal inside a Java pattern (also when it holds the end mark of a quotation itself)."""
    return F.concat(F.lit("\\Q"), F.replace(col, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
