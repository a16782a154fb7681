"""Operators at their thresholds, and against brute force."""

import collections
import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from colonnade.operators import annotations, catalog, detect, hierarchy, lookups, reference, sheets, spatial, temporal, vertices
from colonnade.operators.profile import Profiled, address_columns, column_profile, compose_address, profile_tables, scan_tables


def table(spark, values, kind="string", name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def profile(spark, **columns):
    tables = {k: table(spark, v, *(["string"] if isinstance(next((x for x in v if x is not None), ""), str) else ["double"])) for k, v in columns.items()}
    return column_profile(profile_tables(spark, tables))


def by_dataset(df, *columns):
    return {r["dataset_id"]: (r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns)) for r in df.collect()}


def test_numeric_ratio_threshold(spark):
    found = detect.with_quantitative(profile(
        spark, at=["5", "6"] * 40 + ["x"] * 20, below=["5", "6"] * 39 + ["7"] + ["x"] * 21, zeros=["0"] * 91 + ["1"] * 9, enough=["0"] * 90 + ["1"] * 10,
        ids=[str(i) for i in range(90)] + ["1"] * 10, notid=[str(i) for i in range(89)] + ["1"] * 11))
    kinds = by_dataset(found.select("dataset_id", F.col("quant.subtype").alias("s")), "s")
    assert kinds == {"at": "percentage_like", "below": None, "zeros": None, "enough": "rate_fraction", "ids": None, "notid": "percentage_like"}


def test_name_hints(spark):
    tables = {n: spark.createDataFrame([(float(i % 7 + 200),) for i in range(100)], f"{n} double") for n in ("count", "taux", "score", "other")}
    found = detect.with_quantitative(column_profile(profile_tables(spark, tables)))
    assert by_dataset(found.select("dataset_id", "quant.subtype", "quant.confidence"), "subtype", "confidence") == {
        "count": ("count", 0.93), "taux": ("rate", 0.93), "score": ("index", 0.93), "other": ("continuous", 0.9)}


def test_values_of_any_length_stay_as_they_are(spark):
    """Texts and bytes around and above 4096 characters are given whole, equal ones once."""
    rows = [c * n for c in "xy" for n in (1, 4096, 4097, 9000)]
    tables = {"t": table(spark, rows * 2), "b": table(spark, [bytearray(r, "ascii") for r in rows], "binary")}
    found = profile_tables(spark, tables)
    got = {(r.dataset_id, r.v): (r.n, r.size) for r in found.values.join(found.columns, "cid").collect()}
    assert got == {("t", r): (2, len(r)) for r in rows} | {("b", r.encode().hex().upper()): (1, len(r)) for r in rows}


def test_qualitative_thresholds(spark):
    found = detect.with_qualitative(profile(
        spark, bool95=["oui"] * 95 + ["peut"] * 5, bool94=["oui"] * 94 + ["peut"] * 6, five=["1", "5"] * 50, seven=["1", "7"] * 50, eight=["1", "8"] * 50,
        one=["3"] * 100, words=["I agree"] * 60 + [f"x{i}" for i in range(40)], fewer=["I agree"] * 59 + [f"x{i}" for i in range(41)],
        fifty=[f"c{i % 50}" for i in range(300)], fiftyone=[f"c{i % 51}" for i in range(300)], long=["a" * 65, "b" * 65] * 50, nulls=[None, None]))
    assert by_dataset(found, "category") == {
        "bool95": "binary", "bool94": "nominal", "five": "ordinal_likert", "seven": "ordinal_likert", "eight": "nominal", "one": None,
        "words": "ordinal_likert", "fewer": None, "fifty": "nominal", "fiftyone": None, "long": None, "nulls": None}


def test_temporal_thresholds(spark):
    stamp = "2024-01-02 10:00:00"
    found = detect.with_temporal(profile(
        spark, stamps=[stamp] * 90 + ["x"] * 10, fewer=[stamp] * 89 + ["x"] * 11, months=["2021-02"] * 9 + ["x"], years=["2021"] * 9 + ["x"], week=["2021-W01"] * 8 + ["x"] * 2,
        quarter=["2021Q1", "2021-Q2"] * 4 + ["x"] * 2, iso=["2021-02-03"] * 10, yearnum=[1800.0, 2100.0] * 10, yyyymm=[202112.0] * 10, badmonth=[202113.0] * 10))
    kinds = by_dataset(found.select("dataset_id", F.col("temporal.granularity").alias("g")), "g")
    assert kinds == {"stamps": "date", "fewer": None, "months": "month", "years": "year", "week": "week", "quarter": "quarter", "iso": None,
                     "yearnum": "year", "yyyymm": "month", "badmonth": None}
    iso = detect.with_temporal(profile(spark, iso=["2021-02-03"] * 10), iso_dates=True)
    assert iso.first()["temporal"]["granularity"] == "date"


def test_profile_does_not_depend_on_order_and_handles_edges(spark):
    rows = [None, "", " ", "é", "É", "x" * 5000, "x" * 5000, "y" * 5000, "1", "01"]
    random.Random(1).shuffle(rows)
    frame = table(spark, rows)
    numbers = table(spark, [float("nan"), 0.0, -0.0, float("inf"), None, 1.5], "double")
    empty = table(spark, [], "string")
    tables = {"text": frame, "again": frame.repartition(3), "num": numbers, "empty": empty}
    p = column_profile(profile_tables(spark, tables))
    found = by_dataset(p, "n_rows", "non_null", "nunique", "num_count", "num_nunique")
    assert found["text"] == found["again"] == (10, 9, 8, 2, 1)
    assert found["num"] == (6, 4, 3, 4, 3) and found["empty"] == (0, 0, 0, 0, 0)
    _, scanned = scan_tables(spark, {"text": frame})
    assert by_dataset(scanned, "n_rows", "non_null", "num_count", "nunique") == {"text": (10, 9, 2, 8)}


def test_complex_and_binary_columns(spark):
    df = spark.createDataFrame([([1.0], {"type": "Point", "coordinates": [1.0, 2.0]}, bytes.fromhex("0101000000"), True)],
                               "a array<double>, g struct<type:string,coordinates:array<double>>, b binary, f boolean")
    rows = {r["column"]: r for r in column_profile(profile_tables(spark, {"t": df})).collect()}
    assert rows["g"]["kind"] == "geometry" and rows["a"]["kind"] == "complex" and rows["b"]["wkb"] == 1 and rows["f"]["boolean_word"] == 1


def test_address_composition(spark):
    df = spark.createDataFrame([("rue  Verte", "3", None, "x"), (None, None, None, "y")], "nomvoie string, numvoie string, indrep string, other string")
    parts = address_columns(spark, {"t": df})["t"]
    assert parts == ["numvoie", "indrep", "nomvoie"]
    assert [tuple(r) for r in compose_address(df, parts).collect()] == [("x", "3 rue Verte"), ("y", None)]


def references(spark):
    rows = [("reg", 0, "01", "Guadeloupe"), ("reg", 0, "11", "Île-de-France"), ("dep", 2, "01", "Ain"), ("dep", 2, "2A", "Corse-du-Sud"),
            ("dep", 2, "75", "Paris"), ("dep", 2, "971", "Guadeloupe"), ("com", 6, "75056", "Paris"), ("com", 6, "01004", "Ambérieu")]
    return spark.createDataFrame(rows, reference.REFERENCE_SCHEMA)


def test_best_level_with_padding(spark):
    values = {"dep": ["1", "75", "2a", "971"], "name": ["paris", "AMBERIEU"], "com": ["1004", "75056"], "none": ["zz"], "half": ["75", "x"]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "c string, v string")
    best = {r["c"]: (r["level"], r["by"], round(r["ratio"], 3)) for r in reference.best_level(df, reference.reference_keys(references(spark)), ["c"]).collect()}
    assert best == {"dep": ("departement", "code", 1.0), "name": ("commune", "nom", 1.0), "com": ("commune", "code", 1.0), "half": ("departement", "code", 0.5)}


def test_mixed_levels_and_country(spark):
    df = spark.createDataFrame([("a", v) for v in ("France", "11", "75", "paris", "nowhere", " ")] + [("b", "75")], "c string, v string")
    levels = reference.value_levels(df, reference.reference_keys(references(spark)), ["c"])
    mixed = reference.mixed_levels(levels, ["c"]).collect()
    assert {(r["c"], r["level"], r["value"]) for r in mixed} == {
        ("a", "country", "France"), ("a", "region", "11"), ("a", "departement", "75"), ("a", "commune", "paris")}
    assert {r["most_specific"] for r in mixed} == {"commune"}


def test_file_name_levels(spark):
    names = spark.createDataFrame([("2020_detail_IDF_dep_75.csv",), ("indicateur_region_11.csv",), ("dep_1.csv",), ("com_1004_x.csv",), ("dep_99.csv",)], "name string")
    found = {tuple(r) for r in reference.file_name_levels(names, reference.reference_keys(references(spark))).collect()}
    assert found == {("2020_detail_IDF_dep_75.csv", "departement", "75"), ("indicateur_region_11.csv", "region", "11"),
                     ("dep_1.csv", "departement", "01"), ("com_1004_x.csv", "commune", "01004")}


def test_names_in_text_against_brute_force(spark):
    texts = ["carte_de_l_ain_2020", "Île de France et Paris", "parisien", "paris", "x-corse du sud-y", "guadeloupe_paris_x", "", None,
             "Saint-Rémy les hauts de la Grande-Vallée du Nord, 2020", "saint remy les hauts de la grande vallee", "saint remy les hauts; de la " * 500 + "grande vallee",
             "grande vallee grande vallee", "x_l'isle_y", "vallee 1234 x", "l'isle", "la grande-vallee-du sud"]
    more = ["Saint-Rémy les hauts de la Grande Vallée", "grande vallée", "Grande Vallée du Nord", "saint remy les hauts", "L'Isle", "1234", "les", None, ""]
    ref = references(spark).unionByName(spark.createDataFrame([("com", 5, None, nom) for nom in more], reference.REFERENCE_SCHEMA))
    found = {(r["i"], r["level"], r["value"]) for r in reference.names_in_text(
        spark.createDataFrame(list(enumerate(texts)), "i int, t string"), ref, key="i", text="t").where("by = 'nom'").collect()}
    import re
    import unicodedata

    def key(x):
        x = "".join(c for c in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(c))
        return re.sub(r"[\s\-_]+", "_", x).strip("_")

    expected = set()
    for i, raw in enumerate(texts):
        k = key(raw or "")
        hay = " " + " ".join([k] + [p for p in re.split("[^a-z0-9]+", k) if p]) + " "
        for r in ref.collect():
            name = key(r["nom"] or "").replace("_", " ")
            if len(name) >= 4 and not name.isdigit() and (f" {name} " in hay or f"_{name}_" in hay):
                expected.add((i, r["level"], name))
    assert found == expected and {n for _, _, n in expected} >= {"saint remy les hauts de la grande vallee", "l'isle"}


def test_names_in_text_builds_its_index_once(spark):
    texts = spark.createDataFrame([(1, "dep_75 2a, saint remy les hauts de la grande vallee"), (2, "2a")], "i int, t string")
    long = spark.createDataFrame([("com", 5, None, "Saint-Rémy les hauts de la Grande Vallée")], reference.REFERENCE_SCHEMA)
    found = reference.names_in_text(texts, references(spark).unionByName(long), key="i", text="t")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "inline(" not in plan  # what is read has only the matches and, for long names, the texts
    rows = [tuple(r) for r in found.collect()]
    codes = reference.names_in_text(texts, spark.createDataFrame([("departement", 1, "2A", None)], reference.REFERENCE_SCHEMA), key="i", text="t")
    assert [tuple(r) for r in codes.collect()] == [(2, "departement", "code", "2A")]
    assert len(rows) == len(set(rows)) and {(1, "com", "nom", "saint remy les hauts de la grande vallee")} <= set(rows)


def test_ranges_cover_the_periods(spark):
    tokens = ["2020-11", "2020-12", "2021-01", "2021-03", "2021-03", "bad", None, "2021-13"]
    df = spark.createDataFrame([("k", t) for t in tokens], "k string, t string")
    rows = temporal.period_ranges(df, ["k"], "t", "month").orderBy("start_label").collect()
    assert [(r["start_label"], r["end_label"], r["n_periods"]) for r in rows] == [("2020-11", "2021-01", 3), ("2021-03", "2021-03", 1)]


def test_rollups(spark):
    cases = {"a": ["epci", "departement"], "b": ["commune", "epci"], "c": ["country", "insee_geo"], "d": ["wkt_geojson"], "e": ["geocode"]}
    levels = spark.createDataFrame([(k, v) for k, vs in cases.items() for v in vs], "dataset_id string, level string")
    table_ = hierarchy.hierarchy_table(spark)
    assert by_dataset(hierarchy.granularity_rollup(levels, table_, "spatial"), "granularity") == {
        "a": "departement", "b": "commune", "c": "insee_geo", "d": "geometry"}
    scopes: dict = {}
    for r in hierarchy.scope_rollup(levels, table_, "spatial").orderBy("scope_pos").collect():
        scopes.setdefault(r["dataset_id"], []).append(r["level"])
    assert scopes == {"a": ["departement", "epci"], "b": ["epci"], "c": ["country"], "d": ["geometry"]}


def test_themes(spark):
    nodes = hierarchy.theme_table(spark, {"W": {"A / B": {}, "C": {"D": {}}}})
    themes = spark.createDataFrame([("x", "W > A / B"), ("x", "W>C > D"), ("y", "W/C"), ("z", None), ("q", "P > 1"), ("q", "R > 2")], "dataset_id string, theme string")
    found = {tuple(r) for r in hierarchy.theme_set(themes, nodes=nodes).collect()}
    assert found == {("x", "W > A / B"), ("x", "W > C > D"), ("y", "W > C"), ("q", "P > 1"), ("q", "R > 2")}
    assert by_dataset(hierarchy.common_theme(hierarchy.theme_set(themes, nodes=nodes)), "prefix") == {"x": "W", "y": "W > C"}
    assert hierarchy.valid_paths(spark.createDataFrame([("W > C",), ("W > X",)], "path string"), nodes).count() == 1


def test_hull_by_arcs(spark, monkeypatch):
    """Many vertices, points on edges, no key, few points: the same as one chain over all points of a key."""
    monkeypatch.setattr(spatial, "HULL_STATE_POINTS", 50)
    rng = random.Random(5)
    ring = [(round(100 * math.cos(t), 3), round(100 * math.sin(t), 3)) for t in (rng.random() * math.tau for _ in range(900))]
    shapes = {
        "ring": ring + [(x / 2, y / 3) for x, y in ring], "tenths": [(i / 10, (30 - i) / 10) for i in range(31)] + [(0.0, 0.0)],
        "upright": [(1.0, float(i)) for i in range(9)], None: [(float(rng.randint(0, 9)), float(rng.randint(0, 9))) for _ in range(300)],
        "one": [(3.0, 4.0)] * 5, "two": [(3.0, 4.0), (-1.0, 9.0)], "far": [(x + 1e6, y - 1e6) for x, y in ring[:300]],
    }
    rows = [(k, x, y) for k, places in shapes.items() for x, y in places] + [("ring", None, 1.0), ("none", 1.0, None)]
    found = collections.defaultdict(list)
    for r in spatial.convex_hull(spark.createDataFrame(rows, "k string, x double, y double").repartition(5), "k").orderBy("k", "pos").collect():
        assert r["pos"] == len(found[r["k"]])
        found[r["k"]].append((r["x"], r["y"]))
    assert dict(found) == {k: [tuple(p) for p in spatial._hull(np.array(places)).tolist()] for k, places in shapes.items()}
    assert len(found["ring"]) > 400
    assert spatial.convex_hull(spark.createDataFrame([], "k string, x double, y double"), "k").count() == 0


def test_hull_candidates_are_few(spark):
    """Points inside go before anything is grouped, and no place lies beyond two edges."""
    rng = random.Random(6)
    disc = [("k", math.sqrt(r) * math.cos(t), math.sqrt(r) * math.sin(t)) for r, t in ((rng.random(), rng.random() * math.tau) for _ in range(20_000))]
    points = spark.createDataFrame(disc, "k string, x double, y double")
    assert spatial.hull_candidates(points, spatial.hull_corners(points, "k"), "k").count() < 1200


def test_hull_against_brute_force(spark):
    rng = random.Random(7)
    points = [("k", float(rng.randint(0, 60)), float(rng.randint(0, 60))) for _ in range(400)] + [("line", float(i), 2.0 * i) for i in range(5)] + [("one", 1.0, 1.0)]
    hull = spatial.convex_hull(spark.createDataFrame(points, "k string, x double, y double"), "k").orderBy("k", "pos").collect()
    vertices = [(r["x"], r["y"]) for r in hull if r["k"] == "k"]
    mine = {(x, y) for k, x, y in points if k == "k"}
    assert set(vertices) <= mine
    for (ax, ay), (bx, by) in zip(vertices, vertices[1:] + vertices[:1]):
        assert all((bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0 for x, y in mine)
    corners = set(vertices)
    for a, b, c in itertools.islice(itertools.combinations(vertices, 3), 200):
        assert (b[0] - a[0]) * (c[1] - a[1]) != (b[1] - a[1]) * (c[0] - a[0])
    assert len(corners) == len(vertices)
    assert [(r["x"], r["y"]) for r in hull if r["k"] == "line"] == [(0.0, 0.0), (4.0, 8.0)]
    assert len([r for r in hull if r["k"] == "one"]) == 1


def test_extent_texts(spark):
    points = spark.createDataFrame([("a", 1.0, 2.0), ("b", 0.0, 0.0), ("b", 2.0, 1.0)], "k string, x double, y double")
    assert {r["k"]: r["wkt"] for r in spatial.union_wkt(points, ["k"]).collect()} == {"a": "POINT (1.0 2.0)", "b": "MULTIPOINT ((0.0 0.0), (2.0 1.0))"}
    many = spark.range(25_000).select(F.lit("c").alias("k"), (F.col("id") % 12_000).cast("double").alias("x"), F.lit(1.0).alias("y"))
    assert spatial.union_points(many, ["k"]).count() == 12_000 and spatial.union_wkt(many.distinct(), ["k"]).first()["n_points"] == 12_000
    assert {r["k"]: r["wkt"] for r in spatial.envelope(points, ["k"]).collect()}["b"].startswith("POLYGON ((0.0 0.0, 2.0 0.0")
    swapped = spark.createDataFrame([("k", "2.5", "48.5"), ("k", None, "1")], "k string, lon string, lat string")
    assert [(r["x"], r["y"]) for r in spatial.coordinate_points(swapped, ["k"], "lon", "lat").collect()] == [(2.5, 48.5)]


def test_pairs_prefer_degrees(spark):
    rows = [(f"{48 + i / 10}".replace(".", ","), str(2 + i / 10), 650000.0 + i, 6860000.0 + i, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "latitude string, longitude string, x double, y double, v double")
    pairs = spatial.coordinate_pairs(column_profile(profile_tables(spark, {"t": df}), ["coord_count", "lat", "lon", "x", "y"]))
    assert {(r["kind"], r["first_column"], r["second_column"]) for r in pairs.collect()} == {("geo", "latitude", "longitude"), ("proj", "y", "x")}
    assert spatial.best_pair(pairs).first()["first_column"] == "latitude"


def test_labels_need_most_codes(spark):
    labels = spark.createDataFrame([("GEO", "g", "01", "Old", 0), ("GEO", "g", "1", "Ain", 1), ("GEO", "g", "2", "Aisne", 2), ("SEX", "s", "3", "no", 3)],
                                   "COD_VAR string, LIB_VAR string, COD_MOD string, LIB_MOD string, row_pos int")
    enough = spark.createDataFrame([("1",), ("02",), ("1",), (None,)], "GEO string")
    few = spark.createDataFrame([("1",), ("9",)], "GEO string")
    labelled, name = lookups.add_code_labels(enough, labels)
    assert name == "GEO_LABEL" and sorted((r["GEO"] or "", r[name]) for r in labelled.collect()) == [("", ""), ("02", "Aisne"), ("1", "Ain"), ("1", "Ain")]
    assert lookups.add_code_labels(few, labels)[1] is None


def test_sidecar_pairs(spark):
    listing = spark.createDataFrame([("/l/a_data.csv",), ("/l/a_metadata.csv",), ("/l/b_data.csv",), ("/m/b_metadata.csv",)], "path string")
    assert [tuple(r) for r in lookups.pair_sidecars(listing).collect()] == [("/l/a_data.csv", "/l/a_metadata.csv")]


def test_country_overrides(spark):
    base = spark.createDataFrame([("t", "pays", "", False, False, False, True, None, "A", "x"), ("t", "v", "m", False, False, True, False, "Quantitative", "A", "x")], annotations.ANNOTATION_SCHEMA)
    values = spark.createDataFrame([("t", "pays", False), ("t", "v", False)], "dataset_id string, column string, is_country boolean")
    rows = {r["column"]: r for r in lookups.country_overrides(base, values).collect()}
    assert rows["pays"]["is_spatial"] and rows["pays"]["thematic_path"] is None and not rows["v"]["is_spatial"] and rows["v"]["indicator_type"] == "Quantitative"


def test_backbone_upsert(spark):
    schema = "series_hint string, column_name_normalized string, meaning string"
    old = spark.createDataFrame([("s", "a", "old"), ("s", "b", "old")], schema)
    new = spark.createDataFrame([("s", "A", "new"), ("s", "C-d", "new")], "series_hint string, column string, meaning string")
    once = annotations.upsert_backbone(old, new)
    rows = {(r["column_name_normalized"], r["meaning"]) for r in once.collect()}
    assert rows == {("a", "new"), ("b", "old"), ("c_d", "new")}
    assert {(r["column_name_normalized"], r["meaning"]) for r in annotations.upsert_backbone(once, new).collect()} == rows


def test_sheets(spark):
    grid = {"Data": ["title only", "id|name|value", "1|a|2", "2|b|3"], "Dashboard": ["KPI", "x"], "Notes": ["variable|description", "a|b"],
            "Blank": [], "T": ["t1", "t2", "t3", "", "a|b|c", "1|2|3"]}
    cells = [("d", s, r, c, v or None) for s, rows in grid.items() for r, row in enumerate(rows) for c, v in enumerate(row.split("|"))] + [("d", "Blank", 0, 0, None)]
    roles = {r["sheet"]: (r["sheet_role"], r["header_row"]) for r in sheets.sheet_roles(spark.createDataFrame(cells, "dataset_id string, sheet string, row int, col int, value string")).collect()}
    assert roles == {"Data": ("data", 1), "Dashboard": ("dashboard", 0), "Notes": ("dictionary", 0), "Blank": ("empty", None), "T": ("dashboard", 4)}


def test_catalog_upsert_is_idempotent_and_latest_wins(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, title string")
    new = spark.createDataFrame([("2", "B"), ("3", "c")], "id string, title string")
    once = catalog.upsert(old, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, catalog.upsert(once, new).collect())) == [("1", "a"), ("2", "B"), ("3", "c")]
    rows = spark.createDataFrame([("k", 1), ("k", 3), ("j", 2)], "k string, t int")
    assert sorted(map(tuple, catalog.latest(rows, ["k"], "t").collect())) == [("j", 2), ("k", 3)]


def test_values_are_profiled_once(spark):
    p = profile_tables(spark, {"t": table(spark, ["a", "a", "b", None])})
    assert isinstance(p, Profiled) and sorted((r["v"] or "", r["n"]) for r in p.values.collect()) == [("", 1), ("a", 2), ("b", 1)]


def test_profile_shuffles_no_long_texts(spark):
    """Cells of 1 MB are counted by digest; texts are read back for the columns asked for only."""
    cell = F.concat(F.repeat(F.lit("ab c"), 1 << 18), F.pmod("id", F.lit(3)).cast("string"))
    rows = spark.range(24).repartition(6).select(cell.alias("body"), F.concat(F.lit("k"), F.pmod("id", F.lit(2))).alias("label"), cell.cast("binary").alias("raw"))
    p = profile_tables(spark, {"t": rows})
    assert not [f for f in p.digests.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    plan = p.digests.where("n > 0")._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keys) == 4 and all(line.count("_groupingexpression") == 2 and " x#" not in line for line in keys[1::2])
    found = {r["column"]: r for r in column_profile(p).collect()}
    assert [(found[c]["n_rows"], found[c]["nunique"], found[c]["avg_len"]) for c in ("body", "label", "raw")] == [(24, 3, (1 << 20) + 1), (24, 2, 2), (24, 3, (1 << 20) + 1)]
    assert found["body"]["country_no"] == 24 and found["body"]["country_yes"] == 0
    wanted = p.columns.where("column = 'label'")
    assert sorted((r["v"], r["n"]) for r in p.texts_of(wanted).collect()) == [("k0", 12), ("k1", 12)]
    assert p.texts_of(wanted.where("false")).count() == 0
    scan = p.texts_of(wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert "repeat" not in scan.lower()


def test_country_words_among_separators(spark):
    rows = ["France", " - fr. ", "…/" * 60 + "FRA" + " " * 80, "République  Française", "." * 90, "", "x" * 70, "fr " * 30, "république", "é" * 30]
    found = by_dataset(column_profile(profile_tables(spark, {str(i): table(spark, [v]) for i, v in enumerate(rows)})), "country_yes", "country_no")
    assert [found[str(i)] for i in range(len(rows))] == [(1, 0)] * 4 + [(0, 0)] * 2 + [(0, 1)] * 4
    numbers = by_dataset(column_profile(profile_tables(spark, {"i": table(spark, [1, 0, 7], "long"), "d": table(spark, [1.0, float("inf"), None], "double")})), "boolean_word", "country_no")
    assert numbers == {"i": (2, 3), "d": (0, 2)}


def test_distinct_numbers_beyond_the_exact_ones(spark):
    big = 1 << 53
    found = by_dataset(column_profile(profile_tables(spark, {"t": table(spark, [5, 5, big, big + 1, -big, 7], "long"), "s": table(spark, ["5", "5,0", "x"])})), "num_nunique", "nunique")
    assert found == {"t": (4, 5), "s": (1, 3)}


def wkb(kind, *parts, order="<", flags=0, srid=None, vertex=None):
    """Well-known binary; ``parts`` are vertices, rings or members, as the type needs."""
    import struct

    head = struct.pack(order + "BI", order == "<", kind | flags | (0x20000000 if srid else 0)) + (struct.pack(order + "I", srid) if srid else b"")
    line = lambda points: struct.pack(order + "I", len(points)) + b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in points)
    base = kind % 1000
    if base == 1:
        return head + struct.pack(f"{order}{len(parts[0])}d", *parts[0])
    if base == 2:
        return head + line(parts)
    if base == 3:
        return head + struct.pack(order + "I", len(parts)) + b"".join(map(line, parts))
    return head + struct.pack(order + "I", len(parts)) + b"".join(parts)


WKB_CASES = [
    (wkb(1, (1.0, 2.0)), True, [(1, 2)]), (wkb(1, (1.0, 2.0, 9.0), order=">", flags=0x80000000, srid=4326), True, [(1, 2)]),
    (wkb(2, (0.0, 0.0), (3.0, 4.0)), False, [(0, 0), (3, 4)]), (wkb(3, [(0.0, 0.0), (5.0, 0.0), (0.0, 5.0), (0.0, 0.0)], [(1.0, 1.0)]), False, [(0, 0), (5, 0), (0, 5), (0, 0), (1, 1)]),
    (wkb(4, wkb(1, (1.0, 1.0)), wkb(1, (2.0, 2.0), order=">")), True, [(1, 1), (2, 2)]), (wkb(3006, wkb(3003, [(7.0, 8.0, 0.0, 1.0)])), False, [(7, 8)]),
    (wkb(7, wkb(1, (1.0, 1.0)), wkb(7, wkb(2, (2.0, 3.0)))), False, [(1, 1), (2, 3)]), (wkb(1, (float("nan"), float("nan"))), True, []),
    (wkb(3, [(0.0, 0.0)] * 4)[:-3], False, []), (b"", False, []), (b"\x02abc", False, []), (wkb(5, b""), False, []), (b"\x01\x03\x00\x00\x00\xff\xff\xff\xff", False, []), (None, False, []),
]


def test_wkb_cursor():
    for data, is_point, points in WKB_CASES:
        kind, found = vertices.decode_wkb(data)
        assert ([tuple(p) for p in found.tolist()] == points) and (kind == is_point or not points), data


def test_vertices_of_every_form(spark):
    texts = [
        ("POINT (1 2)", True, [(1, 2)]), ("SRID=4326; point z(1.5e1 -2 7)", True, [(15, -2)]), ("MULTIPOINT ((1 2), (3 4))", True, [(1, 2), (3, 4)]),
        ("LineString(0 0,1 .5 , 2 2.)", False, [(0, 0), (1, 0.5), (2, 2)]), ("POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 1 2, 1 1))", False, [(0, 0), (4, 0), (4, 4), (0, 0), (1, 1), (2, 1), (1, 2), (1, 1)]),
        ("GEOMETRYCOLLECTION (POINT (5 6), LINESTRING (7 8, 9 9))", False, [(5, 6), (7, 8), (9, 9)]), ("POLYGON EMPTY", False, []), ("", False, []), ("none", False, []),
        ('{"type":"Point","coordinates":[1,2,3]}', True, [(1, 2)]), ('{"type": "MultiPolygon", "coordinates": [[[[0,0],[1.5,0]]],[[[2,2]]]]}', False, [(0, 0), (1.5, 0), (2, 2)]),
        ('{"type":"Feature","geometry":{"type":"LineString","coordinates":[[1,1],[2,2]]},"properties":{}}', False, [(1, 1), (2, 2)]),
        ('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[3,3]},{"type":"Polygon","coordinates":[[[4,4]]]}]}', False, [(3, 3), (4, 4)]),
        ('{"type":"Point","coordinates":["a"', False, []), ('{"type":"Point","coordinates":[1]}', True, []),
        *[(data.hex(), k, p) for data, k, p in WKB_CASES[:7]], ("".join(f"\\x{b:02x}" for b in WKB_CASES[3][0]), False, WKB_CASES[3][2]), (WKB_CASES[2][0].decode("latin-1"), False, WKB_CASES[2][2]),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(texts)] + [(99, None)], "k int, g string")
    found = collections.defaultdict(list)
    for r in vertices.geometry_vertices(rows, ["k"], "g").collect():
        found[r.k].append((r.is_point, r.x, r.y))
    for i, (t, is_point, points) in enumerate(texts):
        assert sorted(found[i]) == sorted((is_point, float(x), float(y)) for x, y in points), t
    assert 99 not in found
    binary = spark.createDataFrame([(i, d) for i, (d, *_) in enumerate(WKB_CASES)], "k int, g binary")
    assert sorted((r.k, r.x, r.y) for r in vertices.geometry_vertices(binary, ["k"], "g").collect()) == sorted((i, float(x), float(y)) for i, (_, _, ps) in enumerate(WKB_CASES) for x, y in ps)
