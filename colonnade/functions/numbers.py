"""Numbers hidden in text, sizes, confidences and evidence as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colonnade.functions import fixed
from colonnade.functions.text import plain_number


def coerced_number(text: Column, *, strict: bool = False) -> Column:
    """Number left after currency words and every character but digits, hyphen, comma and dot are removed.

    With ``strict`` the text must consist of a number, currency marks, blanks and a percent sign only, so that codes
    such as ``Brand#13`` stay text.
    """
    bare = F.regexp_replace(text, fixed.CURRENCY_PATTERN, "")
    kept = F.replace(F.regexp_replace(bare, fixed.NON_NUMBER_PATTERN, ""), F.lit(","), F.lit("."))
    # two points can never be a number; prose is settled by this look at its first sentence
    number = F.when(~text.rlike(r"[.,][^.,]*[.,]"), plain_number(kept))
    if not strict:
        return number
    return F.when(F.regexp_replace(bare, r"(?U)[\s%+]", "").rlike(r"^[-]?[0-9.,]+$"), number)


def coordinate_number(text: Column) -> Column:
    """Coordinate from text: decimal comma or point, thousands points removed on a second try."""
    packed = F.regexp_replace(text, r"(?U)\s+", "")
    first = plain_number(F.replace(packed, F.lit(","), F.lit(".")))
    second = plain_number(F.replace(F.replace(packed, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    return F.when(text.rlike(r"(?U)^[-+0-9.,eE\s]+$"), F.coalesce(first, second))


def ratio(part: Column, whole: Column) -> Column:
    """Share of a whole; zero when the whole is empty."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def human_size(size: Column) -> Column:
    """Byte count with a unit, two decimals."""
    value, label = size.cast("double"), None
    step = 1.0
    for unit in fixed.SIZE_UNITS:
        # ties go to the even digit before the text is made
        shown = F.format_string("%.2f " + unit, F.bround(value / step, 2))
        fits = value / step < 1024
        label = F.when(fits, shown) if label is None else label.when(fits, shown)
        step *= 1024
    return F.when(size.isNotNull(), label.otherwise(F.format_string("%.2f PB", F.bround(value / step, 2))))


def gated_confidence(match_ratio: Column) -> Column:
    """Confidence of a reference match behind a level named in the column name."""
    return F.least(F.lit(0.99), 0.7 + 0.3 * match_ratio)


def generic_confidence(match_ratio: Column) -> Column:
    """Confidence of a reference match behind a generic geographic column name."""
    return F.least(F.lit(0.99), 0.68 + 0.32 * match_ratio)


def joined(separator: str, *parts: Column) -> Column:
    """Join the parts that are present; null when none is."""
    return F.nullif(F.concat_ws(separator, *parts), F.lit(""))


def scope_text(value: Column) -> Column:
    """Scope value as text: whole numbers of any length lose padding and decimals, other numbers print as floats."""
    number, digits = plain_number(value), F.trim(value)
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    return (
        F.when(digits.rlike(r"^[+-]?0+(?:\.0*)?$"), "0")
        .when(digits.rlike(r"^[+-]?\d+(?:\.0*)?$"), F.regexp_replace(digits, r"^\+?(-?)0*(\d+?)(?:\.0*)?$", "$1$2"))
        .when(whole, number.cast("bigint").cast("string"))
        .when(number.isNotNull(), number.cast("string"))
        .otherwise(value)
    )


def padded_code(value: Column) -> Column:
    """Code text with the decimals of a whole-number float removed, as a number column shows its codes."""
    return F.regexp_replace(value, r"^(-?\d+)\.0$", "$1")
