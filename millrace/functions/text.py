"""Text helpers: trimming, truncation, number formatting, JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# JSON's two-character escapes. The backslash goes first, so that
# it is not escaped again in the others.
SHORT_ESCAPES = (
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\b", "\\b"),
    ("\f", "\\f"),
)


def strip(column) -> Column:
    return F.btrim(column, F.lit(WHITESPACE))


def normalised(column) -> Column:
    """Trimmed and lowercased, for case-insensitive equality."""
    return F.lower(strip(column))


def prefix(column, length: int) -> Column:
    return F.left(column, F.lit(length))


def error_text(column, limit: int = 500) -> Column:
    return prefix(column, limit)


def fixed_decimals(column, digits: int) -> Column:
    """``%.{digits}f`` text; ties go to even on the binary value, as in C and Python."""
    pattern = "0." + "0" * digits if digits else "0"
    column = F.col(column) if isinstance(column, str) else column
    return F.call_function("format_number", column, F.lit(pattern))


def blank_to_null(column) -> Column:
    return F.nullif(column, F.lit(""))


def _escape_rest(text: Column) -> Column:
    """Spell everything but printable ASCII as UTF-16 escapes, run by run."""
    def spell(run: Column) -> Column:
        units = F.lower(F.hex(F.encode(run, "UTF-16BE")))
        return F.regexp_replace(units, "(.{4})", r"\\u$1")

    def escape(whole: Column) -> Column:
        runs = F.regexp_extract_all(whole, F.lit("[ -~]+|[^ -~]+"), F.lit(0))
        spelled = F.transform(runs, lambda r: F.when(r.rlike("^[ -~]"), r).otherwise(spell(r)))
        return F.when(whole.rlike("[^ -~]"), F.array_join(spelled, "")).otherwise(whole)

    # The lambda binds the text, so that it is put together once per row.
    return F.get(F.transform(F.array(text), escape), F.lit(0))


def _quoted(text: Column) -> Column:
    for raw, short in SHORT_ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(short))
    return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("null"))


def json_string(column) -> Column:
    """One JSON string literal, ASCII only; NULL becomes ``null``."""
    return _escape_rest(_quoted(F.col(column) if isinstance(column, str) else column))


def json_string_array(column) -> Column:
    """JSON text of a string array, ASCII only, ``", "`` between items; empty or NULL -> NULL."""
    column = F.col(column) if isinstance(column, str) else column
    items = F.array_join(F.transform(column, _quoted), ", ")
    text = F.concat(F.lit("["), items, F.lit("]"))
    return F.when(F.size(column) > 0, _escape_rest(text))


def json_document(column) -> Column:
    """JSON text of a nested value with every declared field kept; NULL stays NULL."""
    return F.to_json(column, {"ignoreNullFields": "false"})
