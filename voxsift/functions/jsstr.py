"""JavaScript-exact string scalars as Spark Column expressions.

The triage commands arrive as JavaScript strings; these expressions give the
same answers as ``String.prototype.trim``, ``split(" ", 3)``, ``parseInt``,
``||`` and ``String.length`` (UTF-16 code units) while staying inside
whole-stage codegen (no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters JavaScript's trim() removes (WhiteSpace and
# LineTerminator of ECMA-262), as a Java regex character class.
JS_WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
    r"\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def js_trim(col: Column | str) -> Column:
    """``s.trim()``: strips all Unicode white space, line breaks and BOM.
    Spark's ``trim`` only strips U+0020."""
    pattern = f"^{JS_WHITESPACE_CLASS}+|{JS_WHITESPACE_CLASS}+$"
    return F.regexp_replace(_c(col), pattern, "")


def js_split3(col: Column | str) -> Column:
    """``s.split(" ", 3)``: single-space separator, empty pieces kept, the
    remainder after the third piece dropped."""
    return F.slice(F.split(_c(col), " "), 1, 3)


def js_int_prefix(col: Column | str) -> Column:
    """What ``parseInt`` reads of a string: sign and digits (one regex); empty if NaN."""
    return F.regexp_extract(_c(col), f"^{JS_WHITESPACE_CLASS}*([+-]?(?:0[xX][0-9a-fA-F]*|[0-9]+))", 1)


def js_int_value(prefix: Column | str) -> Column:
    """The BIGINT of a ``js_int_prefix``.  It names the prefix several times, so
    over many rows make the prefix a column first: the regex runs once a row."""
    m = _c(prefix)
    sign = F.substring(m, 1, 1)
    unsigned = F.when(sign.isin("+", "-"), F.substring(m, 2, (1 << 31) - 1)).otherwise(m)
    hex_digits = F.substring(unsigned, 3, (1 << 31) - 1)
    is_hex = F.lower(F.substring(unsigned, 1, 2)) == "0x"
    value = (F.when(m == "", F.lit(None).cast("bigint"))
             .when(is_hex, F.when(hex_digits != "", F.conv(hex_digits, 16, 10).try_cast("bigint")))
             .otherwise(unsigned.try_cast("bigint")))
    return F.when(sign == "-", -value).otherwise(value)


def js_parse_int(col: Column | str) -> Column:
    """``parseInt(s)`` as BIGINT, NULL where JavaScript gives NaN.

    Leading white space is skipped, an optional sign is read, ``0x``/``0X``
    switches to base 16, and parsing stops at the first invalid digit.  One
    regex extracts the numeric prefix; the rest is cheap string work.
    """
    return js_int_value(js_int_prefix(col))


def js_or(a: Column | str, b: Column | str) -> Column:
    """``a || b`` for strings: the empty string and NULL are falsy."""
    return F.coalesce(F.nullif(_c(a), F.lit("")), _c(b))


def utf16_length(col: Column | str) -> Column:
    """``s.length`` in JavaScript: UTF-16 code units (an emoji counts 2)."""
    return (F.octet_length(F.encode(_c(col), "UTF-16BE")) / 2).cast("bigint")


def longer_than(col: Column | str, n: int) -> Column:
    """``s.length > n`` in UTF-16 units; NULL text is never longer.

    ``char_length > n`` already implies it, so the encode only runs on
    short strings."""
    c = _c(col)
    return F.coalesce(
        (F.char_length(c) > n) | (F.octet_length(F.encode(c, "UTF-16BE")) > 2 * n),
        F.lit(False))


def iso_utc(ts: Column | str) -> Column:
    """``Date.toISOString()`` text of a timestamp (millisecond precision)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def ts_text(ts: Column | str) -> Column:
    """Microsecond text form used for comparable timestamp output."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")
