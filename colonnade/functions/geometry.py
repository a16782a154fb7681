"""Geometry-like values as column predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colonnade.functions import fixed
from colonnade.functions.text import BLANK_SET, strip

_ESCAPED = r"(?:\\x[0-9A-Fa-f]{2}){5,}"


def _is_header(head: Column) -> Column:
    """True when ten hex digits hold a byte order of 0 or 1 and a base geometry type of 1 to 7."""
    little = (F.substring(head, 1, 2) == "01") & F.substring(head, 3, 2).isin(*_TYPES)
    big = (F.substring(head, 1, 2) == "00") & F.substring(head, 9, 2).isin(*_TYPES)
    return (F.length(head) == 10) & (little | big)


_TYPES = ("01", "02", "03", "04", "05", "06", "07")


def is_wkb_bytes(raw: Column) -> Column:
    """Binary value that starts like a well-known binary geometry."""
    return _is_header(F.hex(F.substring(raw, 1, 5)))


def is_wkb_text(text: Column) -> Column:
    """Hex, escaped or byte-per-character text that starts like a well-known binary geometry."""
    is_hex = (F.length(text) % 2 == 0) & text.rlike("^[0-9A-Fa-f]+$")
    escaped_head = F.upper(F.replace(F.regexp_extract(text, "^" + _ESCAPED, 0), F.lit("\\x"), F.lit("")))
    # one byte per character: the first one is the byte order, and no character lies beyond a byte
    raw = text.rlike(r"^[\u0000\u0001]") & ~text.rlike(r"[^\u0000-\u00ff]")
    raw_head = F.hex(F.encode(F.when(raw, F.substring(text, 1, 5)).otherwise(F.lit("")), "ISO-8859-1"))
    return F.coalesce(
        F.when(is_hex, _is_header(F.upper(F.substring(text, 1, 10)))).otherwise(
            _is_header(F.substring(escaped_head, 1, 10)) | _is_header(raw_head)
        ),
        F.lit(False),
    )


def wkb_bytes(text: Column) -> Column:
    """Bytes of a well-known binary geometry written as hex digits, escapes, or one character for each byte."""
    return (
        F.when(text.rlike("^[0-9A-Fa-f]+$"), F.try_to_binary(text, F.lit("hex")))
        .when(text.startswith("\\x"), F.try_to_binary(F.replace(text, F.lit("\\x"), F.lit("")), F.lit("hex")))
        .otherwise(F.encode(text, "ISO-8859-1"))
    )


def is_geometry_text(text: Column) -> Column:
    """WKT, GeoJSON or well-known binary written as text."""
    bare = strip(text)
    geojson = bare.startswith("{") & F.contains(bare, F.lit('"type"')) & F.contains(bare, F.lit('"coordinates"'))
    # only the first word matters for WKT, so only that much is put in upper case
    head = F.upper(F.substring(bare, 1, 24))
    wkt = F.lit(False)
    for prefix in fixed.WKT_PREFIXES:
        wkt = wkt | head.startswith(prefix)
    return geojson | wkt | is_wkb_text(text)


def may_be_geometry(text: Column) -> Column:
    """False for a text whose first character begins no geometry."""
    return text.rlike(f"^(?:[{BLANK_SET}]*+[{{sSſpPlLmMgG]|[0\\\\\\x00\\x01])")


def is_address_text(text: Column) -> Column:
    """A street word together with a number or a postal code."""
    # the letters that begin a street word are looked for first, a word's edge costs more
    flags, words = fixed.STREET_PATTERN.split(r"\b", 1)
    return text.rlike(r"(?U)\d") & text.rlike(flags + r"(?=[sarbldcip])\b" + words)


def point_wkt(x: Column, y: Column) -> Column:
    """Point as WKT."""
    return F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))


def envelope_wkt(min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """Bounding box as WKT; a single place becomes a point."""

    def pair(x: Column, y: Column) -> Column:
        return F.concat_ws(" ", x.cast("string"), y.cast("string"))

    ring = F.concat_ws(
        ", ", pair(min_x, min_y), pair(max_x, min_y), pair(max_x, max_y), pair(min_x, max_y), pair(min_x, min_y)
    )
    is_point = (min_x == max_x) & (min_y == max_y)
    is_line = (min_x == max_x) | (min_y == max_y)
    return (
        F.when(is_point, point_wkt(min_x, min_y))
        .when(
            is_line,
            F.concat(F.lit("LINESTRING ("), pair(min_x, min_y), F.lit(", "), pair(max_x, max_y), F.lit(")")),
        )
        .otherwise(F.concat(F.lit("POLYGON (("), ring, F.lit("))")))
    )
