"""Column functions on literal values, edge values included."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from colonnade.functions import fixed, geometry, names, numbers, periods, text


def values(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_column_key(spark):
    assert values(spark, ["Code Région", " A--B ", "é_è", "ﬁn", None, "N°1"], text.column_key) == [
        "code_region", "a_b", "e_e", "fin", None, "n°1"]


def test_name_key(spark):
    rows = ["Saint-Étienne", "CÅ’UR", "œuf", "L’Haÿ_les-Roses", "  a   b ", None, "BÃ©ziers"]
    assert values(spark, rows, text.name_key) == ["saint etienne", "ca’ur".replace("’", "'"), "oeuf", "l'hay les roses", "a b", "", "beziers"]


def test_fold_is_the_compatibility_decomposition(spark):
    letters = [chr(p) for p in range(0xC0, 0x250) if len(re.sub(r"[̀-ͯ]", "", unicodedata.normalize("NFKD", chr(p)))) == 1]
    expected = ["".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)) for x in letters]
    assert values(spark, letters, text.fold_accents) == expected


def test_codes_and_tokens(spark):
    assert values(spark, [" 2a ", None, "\t01\n"], text.code_key) == ["2A", "", "01"]
    assert values(spark, ["République  Française!", "FR", "--", None], text.country_token) == ["republique_francaise", "fr", "", ""]
    assert values(spark, ["007", "2a", '"01"', " 12 ", "000"], text.sidecar_code) == ["7", "2A", "1", "12", "0"]


def test_coerced_numbers(spark):
    rows = ["€ 1 234,5", "Customer#000000001", "1e5", "1,234,567", "12%", "-3", "5-", "", "EUR 7", None, "+4"]
    assert values(spark, rows, numbers.coerced_number) == [1234.5, 1.0, 15.0, None, 12.0, -3.0, None, None, 7.0, None, 4.0]
    strict = values(spark, ["Brand#13", "13", "1 000 €", "12%", "1e5"], lambda c: numbers.coerced_number(c, strict=True))
    assert strict == [None, 13.0, 1000.0, 12.0, None]


def test_coordinate_numbers(spark):
    rows = ["48,85", "1.234,56", "2 350,5", "-1.5", "abc", None, "1e3"]
    assert values(spark, rows, numbers.coordinate_number) == [48.85, 1234.56, 2350.5, -1.5, None, None, 1000.0]


def test_sizes(spark):
    rows = [0, 1023, 1024, 1536, 1024**3, 1024**5, None]
    assert values(spark, rows, numbers.human_size, "long") == ["0.00 B", "1023.00 B", "1.00 KB", "1.50 KB", "1.00 GB", "1.00 PB", None]


def test_scope_text(spark):
    assert values(spark, ["01", "5.0", "1.50", "2A", "", "-3"], numbers.scope_text) == ["1", "5", "1.5", "2A", "", "-3"]
    assert values(spark, ["123456789012345678", "123456789012345679", "0000123456789012345678.0", "000", "-007"], numbers.scope_text) == [
        "123456789012345678", "123456789012345679", "123456789012345678", "0", "-7"
    ]


@pytest.mark.parametrize("granularity,token,expected", [
    ("year", "2021", ("2021-01-01", "2021-12-31", "2021")), ("year", "1799", None),
    ("quarter", "2021-Q3", ("2021-07-01", "2021-09-30", "2021-Q3")), ("quarter", "T3 2021", ("2021-07-01", "2021-09-30", "2021-Q3")),
    ("semester", "S1_2021", ("2021-01-01", "2021-06-30", "2021-S1")), ("week", "2020-W53", ("2020-12-28", "2021-01-03", "2020-W53")),
    ("week", "2021-W53", None), ("week", "2021-W00", None), ("week", "W01 2021", ("2021-01-04", "2021-01-10", "2021-W01")),
    ("month", "202102", ("2021-02-01", "2021-02-28", "2021-02")), ("month", "2021/13", None),
    ("date", "2021-02-30", None), ("date", "20240229", ("2024-02-29", "2024-02-29", "2024-02-29")),
])
def test_periods(spark, granularity, token, expected):
    p = values(spark, [token], lambda c: periods.parse_period(c, granularity))[0]
    assert (p and (str(p["start"]), str(p["end"]), p["label"])) == expected


def test_file_name_periods(spark):
    found = values(spark, ["SIREDO_2010_1.csv", "x_2021-02-03.csv", "plain.csv", "a_S1_2020.csv"], periods.file_name_periods)
    assert [[tuple(h) for h in hits] for hits in found] == [
        [("month", "2010-01"), ("year", "2010")], [("date", "2021-02-03"), ("month", "2021-02"), ("year", "2021")], [],
        [("semester", "2020-S1"), ("year", "2020")]]


def test_column_name_periods(spark):
    found = values(spark, ["pop_2021", "pop 2021", "x", "2021-03", "2021-q2"], lambda c: periods.column_name_period(text.column_key(c)))
    assert [f and f["granularity"] for f in found] == [None, None, None, "month", "quarter"]


def test_binary_geometry(spark):
    little, big = "0101000000" + "00" * 16, "0000000001" + "00" * 16
    rows = [little, big, "01010000", "02" + little[2:], "0108000000" + "00" * 16, little[:-1], "zz", "\\x01\\x01\\x00\\x00\\x00\\x20",
            "\x01\x01\x00\x00\x20é", "été", None]
    assert values(spark, rows, geometry.is_wkb_text) == [True, True, False, False, False, False, False, True, True, False, False]
    raw = [bytes.fromhex(little), b"\x01", bytes.fromhex("01020000a0e6100000")]
    assert values(spark, raw, geometry.is_wkb_bytes, "binary") == [True, False, True]


def test_geometry_text(spark):
    rows = ["POINT (1 2)", " srid=4326;POINT(1 2)", '{"type":"Point","coordinates":[1,2]}', '{"type":1}', "pointless", "polygon", "word"]
    assert values(spark, rows, geometry.is_geometry_text) == [True, True, True, False, True, True, False]


def test_address_text(spark):
    rows = ["12 rue de Paris", "rue de Paris", "12 allée verte", "75001 Paris", "place 75001", "12 ruelle", "3 bd x"]
    assert values(spark, rows, geometry.is_address_text) == [True, False, True, False, True, False, True]


def test_name_rules(spark):
    rows = ["code_dep", "income", "dep", "nom region", "INSEE_COM", "zone", "xyz"]
    assert values(spark, rows, lambda c: names.level_hits(text.column_key(c))) == [
        ["dep"], ["com"], ["dep"], ["reg"], ["com", "com_arr"], [], []]
    assert values(spark, rows, lambda c: names.level_hits(text.column_key(c), strict=True))[1] == []
    assert values(spark, rows, lambda c: names.gate_source(text.column_key(c))) == ["code", "alias", "alias", "alias", "insee", "generic", None]
    assert values(spark, ["taux", "taux_chomage"], lambda c: names.measure_hint(text.column_key(c), "is_rate")) == [True, False]


def test_slugs_and_decoding(spark):
    assert values(spark, ["Education & Skills", "Longevity (all)", "A / B", " x  y "], text.theme_slug) == [
        "education-and-skills", "longevity-all", "a-b", "x-y"]
    raw = ["é€".encode(), "é€".encode("cp1252"), b"plain"]
    assert values(spark, raw, text.decode_bytes, "binary") == ["é€", "é€", "plain"]
    raw = [b"\xef\xbb\xbfa", "é".encode(), "é".encode("cp1252"), b"\x81"]
    assert values(spark, raw, text.encoding_of, "binary") == ["utf-8-sig", "utf-8", "cp1252", "latin1"]


def test_patterns_cover_every_level():
    assert set(fixed.SPATIAL_NAME_WORDS) == set(fixed.LEVEL_KEYS)


def test_long_prose_is_given_up_and_nothing_else(spark):
    prose = ["A text of many words, with a date 2020-01-02 and 5 numbers. " * 40, "été " * 100, "　\n" * 50 + "words that go on"]
    kept = [
        " " * 90 + "False" + "\n" * 90, "  " * 40 + "1" * 90, "\x1c" * 70 + "-.5e3", "+" + "0" * 80, "2020-01-02 03:04:05." + "0" * 60 + "Z",
        "\x01 T10:11:12", ",5" + " " * 70, "fr", "", " " * 200,
    ]
    assert values(spark, prose + kept, lambda v: text.may_be_typed(v, 5), "string") == [False] * len(prose) + [True] * len(kept)
    shapes = [" " * 80 + "point (1 2)", '　{"type": "Point", "coordinates": [1, 2]}', "0101000000" + "0" * 80, "\\x01\\x01\\x00\\x00\\x00" * 9,
              "\x01\x01\x00\x00\x00" + "a" * 80, "ſrid=4326;POINT (1 2)", "Multipoint", "\tgeometrycollection", "LineString (0 0, 1 1)"]
    assert values(spark, shapes, geometry.is_geometry_text) == [True] * len(shapes)
    assert values(spark, shapes + ["words of a text", "{", "été"], geometry.may_be_geometry) == [True] * len(shapes) + [False, True, False]


def test_street_words_by_first_letter(spark):
    words = ["street", "st.", "avenue", "ave", "road", "rd", "boulevard", "blvd.", "lane", "ln", "drive", "dr.", "route", "rte", "rue", "av", "bd",
             "chemin", "impasse", "allée", "allee", "place", "square"]
    rows = [f"12 {w} x" for w in words] + [f"12 {w.upper()}" for w in words] + ["12 ſtreet", "12 İmpasse", "12 xrue", "rue", "12 ruelle"]
    plain = values(spark, rows, lambda v: v.rlike(r"(?U)\d") & v.rlike(fixed.STREET_PATTERN))
    assert values(spark, rows, geometry.is_address_text) == plain
    assert plain[: 2 * len(words)] == [True] * 2 * len(words) and plain[-3:] == [False] * 3
