"""Text normalisation as column expressions: names, codes, tokens, slugs, bytes."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_LATIN_RANGES = ((0x00A0, 0x0250), (0x1E00, 0x1F00), (0x2000, 0x20A0), (0xFF01, 0xFF5F))
# fixed values: letters that decompose to several letters
_LIGATURES = (
    ("\ufb00", "ff"), ("\ufb01", "fi"), ("\ufb02", "fl"), ("\ufb03", "ffi"), ("\ufb04", "ffl"), ("\ufb05", "st"),
    ("\ufb06", "st"), ("\u0132", "IJ"), ("\u0133", "ij"), ("\u2026", "..."), ("\u2116", "No"), ("\u2122", "TM"),
)
# fixed values: the characters that count as blank
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


#: The same characters in a set of a pattern.
BLANK_SET = "".join(f"\\u{ord(c):04x}" for c in BLANKS)


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Latin characters and the single letter each decomposes to; combining marks follow and map to nothing."""
    source, target = [], []
    for low, high in _LATIN_RANGES:
        for char in map(chr, range(low, high)):
            folded = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
            if folded != char and len(folded) == 1:
                source.append(char)
                target.append(folded)
    marks = "".join(map(chr, range(0x0300, 0x0370)))
    return "".join(source) + marks, "".join(target)


def fold_accents(text: Column) -> Column:
    """Compatibility decomposition of Latin text with the combining marks removed.

    Spark has no Unicode normaliser, so all one-to-one letters go through a single ``translate``; ligatures are spelt
    out only in the rows that contain one. A text of as many bytes as letters has nothing to fold.
    """
    source, target = _fold_table()
    spelt = text
    for char, letters in _LIGATURES:
        spelt = F.replace(spelt, F.lit(char), F.lit(letters))
    has_ligature = text.rlike("[" + "".join(c for c, _ in _LIGATURES) + "]")
    folded = F.translate(F.when(has_ligature, spelt).otherwise(text), source, target)
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(folded)


def column_key(name: Column) -> Column:
    """Column name for pattern matching: lower case, no accents, blanks and hyphens as single underscores."""
    joined = F.regexp_replace(fold_accents(F.lower(name)), r"[\s\-_]+", "_")
    return F.regexp_replace(joined, "^_|_$", "")


def plain_text(text: Column) -> Column:
    """Readable text without accents, with common mis-encodings and typographic quotes repaired, blanks collapsed."""
    fixed = text
    for bad, good in (("Ã©", "é"), ("Æ", "AE"), ("æ", "ae"), ("œ", "oe")):
        fixed = F.replace(fixed, F.lit(bad), F.lit(good))
    # an acute accent standing alone decomposes to a blank, so it separates words like one
    quoted = F.translate(fold_accents(fixed), "’`", "''")
    return F.trim(F.regexp_replace(quoted, r"[-_\s]+", " "))


def name_key(text: Column) -> Column:
    """Display name for comparison; null becomes the empty string."""
    return F.coalesce(F.lower(plain_text(text.cast("string"))), F.lit(""))


def code_key(text: Column) -> Column:
    """Code for comparison: trimmed and upper case; null becomes the empty string."""
    return F.upper(strip(F.coalesce(text.cast("string"), F.lit(""))))


def country_token(text: Column) -> Column:
    """Lower-case accent-free token with every other character run as one underscore."""
    folded = fold_accents(F.lower(F.coalesce(text.cast("string"), F.lit(""))))
    return F.regexp_replace(F.regexp_replace(folded, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def header_key(text: Column) -> Column:
    """Header cell for comparison; null becomes the empty string."""
    return name_key(text)


def strip(text: Column) -> Column:
    """Remove blanks of every kind from both ends (``trim`` alone removes only the space)."""
    return F.btrim(text, F.lit(BLANKS))


def may_be_typed(text: Column, most: int) -> Column:
    """False for a text that is no number, no time and, without its blanks, longer than ``most`` characters.

    Numbers and times begin with a sign, a digit, a point or, times alone, the letter T.
    """
    return text.rlike(f"(?s)^[{BLANK_SET}\\x00-\\x20\\x7f]*+(?:[-+.,0-9T]|.{{0,{most}}}?[{BLANK_SET}]*+$)")


def looks_numeric(text: Column) -> Column:
    """True for a number written with a decimal point or comma."""
    return plain_number(F.replace(text, F.lit(","), F.lit("."))).isNotNull()


def plain_number(text: Column) -> Column:
    """Strict number parse; anything but an optionally signed decimal or scientific number is null."""
    trimmed = strip(text)
    return F.when(
        trimmed.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), trimmed.try_cast("double")
    )


def theme_slug(label: Column) -> Column:
    """Folder-safe form of a theme label."""
    text = F.replace(F.replace(F.lower(strip(label)), F.lit("&"), F.lit("and")), F.lit("/"), F.lit("-"))
    text = F.regexp_replace(F.regexp_replace(text, "[()]", ""), r"[^a-z0-9\s\-]", "")
    return F.regexp_replace(F.regexp_replace(strip(text), r"\s+", "-"), "-+", "-")


def sidecar_code(code: Column) -> Column:
    """Code of a label list: digits lose their leading zeros, anything else is upper case."""
    text = strip(F.regexp_replace(strip(code.cast("string")), r'^"+|"+$', ""))
    return F.when(text.rlike(r"^\d+$"), F.regexp_replace(text, r"^0+(?=\d)", "")).otherwise(F.upper(text))


@lru_cache(maxsize=1)
def _windows_table() -> tuple[str, str]:
    pairs = []
    for byte in range(0x80, 0xA0):
        try:
            pairs.append((chr(byte), bytes([byte]).decode("cp1252")))
        except UnicodeDecodeError:
            continue
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def decode_bytes(raw: Column) -> Column:
    """Bytes to text: UTF-8 when valid, else Windows-1252 (read as Latin-1 with the 0x80-0x9F range mapped)."""
    source, target = _windows_table()
    as_utf8 = F.decode(raw, "UTF-8")
    as_latin = F.translate(F.decode(raw, "ISO-8859-1"), source, target)
    return F.when(F.is_valid_utf8(raw.cast("string")), as_utf8).otherwise(as_latin)


def encoding_of(raw: Column) -> Column:
    """Name of the first encoding that fits the bytes."""
    undefined = r"[\u0081\u008d\u008f\u0090\u009d]"
    return (
        F.when(F.hex(F.substring(raw, 1, 3)) == "EFBBBF", "utf-8-sig")
        .when(F.is_valid_utf8(raw.cast("string")), "utf-8")
        .when(~F.decode(raw, "ISO-8859-1").rlike(undefined), "cp1252")
        .otherwise("latin1")
    )
