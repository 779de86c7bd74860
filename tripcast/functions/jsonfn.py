"""Strict JSON parsing and JSON type tests on VARIANT values.

``try_parse_json`` alone accepts trailing text after a complete value, so
the text is also parsed inside ``[...]`` and as the value of an object:
only a single complete JSON value survives all three.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def strict_parse_json(raw: Column) -> Column:
    """JSON text -> VARIANT, NULL unless ``raw`` is exactly one JSON value."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    as_member = F.try_parse_json(F.concat(F.lit('{"x":'), raw, F.lit("}")))
    single = F.size(wrapped.cast("array<variant>")) == 1
    return F.when(
        wrapped.isNotNull() & as_member.isNotNull() & single,
        F.try_variant_get(wrapped, "$[0]", "variant"),
    )


def json_type(v: Column) -> Column:
    """Type name of a VARIANT value (BIGINT, DOUBLE, DECIMAL(p,s), STRING, ...)."""
    return F.schema_of_variant(v)


def is_json_object(v: Column) -> Column:
    return F.coalesce(json_type(v).startswith("OBJECT<"), F.lit(False))


def field(obj: Column, name: str) -> Column:
    """Member of a JSON object as VARIANT; SQL NULL when absent."""
    return F.try_variant_get(obj, f"$.{name}", "variant")


def is_missing(v: Column) -> Column:
    """Absent member or JSON null."""
    return v.isNull() | F.is_variant_null(v)


def is_json_number(v: Column) -> Column:
    """int or float, but not bool (V7): BIGINT, DOUBLE or DECIMAL(p,s)."""
    t = json_type(v)
    return F.coalesce((t == "BIGINT") | (t == "DOUBLE") | t.startswith("DECIMAL("), F.lit(False))


def is_json_integer(v: Column, allow_bool: bool = True) -> Column:
    """Integer in INT range; JSON booleans count as 1/0 when ``allow_bool`` (K1, K8)."""
    t = json_type(v)
    as_long = F.try_variant_get(v, "$", "bigint")
    in_range = (t == "BIGINT") & as_long.between(INT_MIN, INT_MAX)
    if allow_bool:
        in_range = in_range | (t == "BOOLEAN")
    return F.coalesce(in_range, F.lit(False))


def json_int_value(v: Column) -> Column:
    """INT value of an accepted integer member (booleans -> 1/0)."""
    t = json_type(v)
    return F.when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int")).otherwise(
        F.try_variant_get(v, "$", "int")
    )


def json_string(v: Column) -> Column:
    """Text of a JSON string member; NULL for any other type."""
    return F.when(json_type(v) == "STRING", F.try_variant_get(v, "$", "string"))


def json_double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def json_text(v: Column) -> Column:
    """Any non-null member rendered as text (K7: ids are always strings)."""
    return F.when(json_type(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(
        F.to_json(v)
    )
