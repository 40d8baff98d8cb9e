"""Strict reading of model replies (SCA-9, SCA-10, FLT-3, FLT-4, Q7, Q8).

A reply is JSON text.  The reference tests *presence* of a field and then
compares with the *string* ``"true"``; a JSON boolean ``true`` therefore
means "not relevant" / "not duplicate".  ``from_json`` cannot tell
``"true"`` from ``true``, so replies are parsed to VARIANT and the JSON type
of each field is read with ``schema_of_variant``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxsift.functions.jsstr import js_parse_int

FENCE_PATTERN = r"^\s*```(?:json)?\s*|\s*```\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_reply(reply: Column | str, strip_fences: bool = True) -> Column:
    """VARIANT of the reply; NULL when it is not valid JSON (fail-open)."""
    r = _c(reply)
    if strip_fences:
        r = F.regexp_replace(r, FENCE_PATTERN, "")
    return F.try_parse_json(r)


def field_type(v: Column, field: str) -> Column:
    """JSON type of ``$.field``: string, boolean, null, number, object,
    array; NULL when the field is absent or the reply did not parse."""
    t = F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))
    return (F.when(t == "STRING", "string").when(t == "BOOLEAN", "boolean")
            .when(t == "VOID", "null").when(t.startswith("OBJECT"), "object")
            .when(t.startswith("ARRAY"), "array").when(t.isNotNull(), "number"))


def field_text(v: Column, field: str) -> Column:
    """``$.field`` rendered as text (numbers as digits), NULL if absent."""
    return F.try_variant_get(v, f"$.{field}", "string")


def strict_true(v: Column, field: str) -> Column:
    """``reply[field] === "true"`` (the string, not the boolean)."""
    return F.coalesce((field_type(v, field) == "string") & (field_text(v, field) == "true"),
                      F.lit(False))


def keep_relevant(v: Column, field: str = "relevance", strict_string: bool = True) -> Column:
    """FLT-3: drop only when the field is present and not ``"true"``;
    a missing field or an unparsable reply keeps the row (fail-open)."""
    present = field_type(v, field).isNotNull()
    yes = strict_true(v, field) if strict_string else F.coalesce(
        F.lower(field_text(v, field)) == "true", F.lit(False))
    return ~present | yes


def is_duplicate(v: Column, strict_string: bool = True) -> Column:
    """FLT-4 decision of a duplicate reply (fail-open to unique)."""
    if strict_string:
        return strict_true(v, "is_duplicate")
    return F.coalesce(F.lower(field_text(v, "is_duplicate")) == "true", F.lit(False))


def match_index(v: Column) -> Column:
    """SCA-10: ``parseInt(match_with)``; numbers and numeric strings both
    work; NULL where JavaScript gives NaN."""
    return js_parse_int(field_text(v, "match_with"))


def text_or_empty(v: Column, field: str) -> Column:
    """SCA-18: a missing title/summary is the empty string."""
    return F.coalesce(field_text(v, field), F.lit(""))
