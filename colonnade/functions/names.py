"""Rules on column names, as expressions over the normalised name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colonnade.functions import fixed


def is_country_name(key: Column) -> Column:
    """The normalised column name says country."""
    return key.isin(*fixed.COUNTRY_COLUMN_NAMES) | F.arrays_overlap(
        F.split(key, "_"), F.array(*[F.lit(p) for p in fixed.COUNTRY_NAME_PARTS])
    )


def level_hits(key: Column, *, strict: bool = False) -> Column:
    """Array of spatial level keys named in a column name.

    By default a word counts anywhere inside the name (``income`` names ``com``); ``strict`` asks for whole words.
    """
    hits = []
    for level, words in fixed.SPATIAL_NAME_WORDS.items():
        body = "(?:" + "|".join(words) + ")"
        hits.append(F.when(key.rlike(f"\\b{body}\\b" if strict else body), F.lit(level)))
    return F.array_compact(F.array(*hits))


def is_generic_geo_name(key: Column) -> Column:
    """The column name is geographic without naming a level."""
    return key.rlike(fixed.SPATIAL_GENERIC_PATTERN)


def gate_source(key: Column) -> Column:
    """What in the column name opened the spatial gate: insee, code, alias or generic."""
    named = F.size(level_hits(key)) > 0
    return (
        F.when(named & F.contains(key, F.lit("insee")), "insee")
        .when(named & F.contains(key, F.lit("code")), "code")
        .when(named, "alias")
        .when(is_generic_geo_name(key), "generic")
    )


def geo_format(key: Column, kind: str) -> Column:
    """The column name suggests a geometry format."""
    return key.rlike(fixed.GEO_FORMAT_PATTERNS[kind])


def measure_hint(key: Column, kind: str) -> Column:
    """The column name suggests a rate, count, index, mean or median."""
    return key.rlike(fixed.MEASURE_NAME_PATTERNS[kind])


def coordinate_hint(name: Column, axis: str) -> Column:
    """The raw column name suggests a coordinate axis."""
    return name.rlike(fixed.COORDINATE_NAME_PATTERNS[axis])


def address_role(key: Column) -> Column:
    """First address role whose pattern fits the whole column name."""
    role = None
    for name, pattern in fixed.ADDRESS_ROLE_PATTERNS.items():
        fits = key.rlike(pattern)
        role = F.when(fits, F.lit(name)) if role is None else role.when(fits, F.lit(name))
    return role
