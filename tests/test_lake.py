"""Sources, sinks, the catalog of a lake and its incremental stream."""

import collections
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from colonnade.operators import catalog as entries
from colonnade.operators import labels, reference, vertices
from colonnade.operators.annotations import BACKBONE_SCHEMA
from colonnade.plans.catalog import build_catalog, describe_tables
from colonnade.sources import lake, readers, sinks
from colonnade.sources import records as quoting
from colonnade.streaming import incremental
from colonnade.streaming.incremental import watch


def write(folder, name, content):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())
    return path


def references(spark):
    rows = [("dep", 2, "75", "Paris"), ("dep", 2, "01", "Ain"), ("reg", 0, "11", "Ile-de-France")]
    return spark.createDataFrame(rows, reference.REFERENCE_SCHEMA)


def test_delimited(spark, folder):
    bom = write(folder, "a.csv", "﻿id;nom,x;v\n1;\"a;b\";2,5\n2;c;3\n3;d;4;5\n4;e\n")
    rows = readers.read_delimited(spark, bom).orderBy("id").collect()
    assert rows[0].asDict() == {"id": 1, "nom,x": "a;b", "v": "2,5"} and [r["id"] for r in rows] == [1, 2, 4] and rows[2]["v"] is None
    old = write(folder, "b.tsv", "id\tprix\n1\té€\n".encode("cp1252"))
    assert [tuple(r) for r in readers.read_delimited(spark, old).collect()] == [(1, "é€")]
    with pytest.raises(readers.UnreadableFile):
        readers.read_delimited(spark, write(folder, "c.csv", "alone\n1\n"))


def test_json_kinds(spark, folder):
    lines = write(folder, "a.json", '{"a":{"b":1},"c":[1]}\n{"a":{"b":2},"c":[2]}\n')
    assert readers.read_json(spark, lines).columns == ["a.b", "c"] and readers.read_json(spark, lines).count() == 2
    array = write(folder, "b.json", '[\n {"x": 1},\n {"x": 2}\n]')
    assert sorted(r["x"] for r in readers.read_json(spark, array).collect()) == [1, 2]
    feature = '{"type":"Feature","properties":{"n":%d},"geometry":{"type":"Point","coordinates":[1.0,%d.5]}}'
    geo = '{"type":"FeatureCollection","features":[%s,%s]}' % (feature % (1, 1), feature % (2, 2))
    for name in ("c.json", "c.geojson"):
        table = readers.read_table(spark, write(folder, name, geo))
        assert table.columns == ["n", "geometry"] and table.count() == 2
    assert readers.read_head(spark, os.path.join(folder, "c.geojson"), 1).columns == ["n"]
    with pytest.raises(readers.UnreadableFile):
        readers.read_json(spark, write(folder, "d.json", "nothing here"))


def test_projection(spark):
    df = spark.range(3).select("id", (F.col("id") * 2).alias("b"))
    assert readers.select_columns(df, [1, "id", 1, 9, "zz"]).columns == ["b", "id"]
    assert readers.select_columns(df, []).columns == [] and readers.select_columns(df, None).columns == ["id", "b"]


def test_listing(spark, folder):
    for name in ("a.csv", ".hidden.csv", "x_metadata.csv", "y.metadata.tsv", "desktop.ini", "sub/b.PARQUET", "c.txt", "noext"):
        write(folder, name, "x")
    assert sorted(r["title"] for r in lake.data_files(spark, folder).collect()) == ["a.csv", "b.PARQUET"]
    assert lake.list_files(spark, os.path.join(folder, "missing")).count() == 0
    plan = lake.list_files(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]
    assert lake.checksums(spark, [os.path.join(folder, "a.csv")]).first()["checksum"].startswith("2d711642b726b044")


def test_metadata_documents_read_back(spark, folder):
    attributes = [{"dataName": "a", "spatialLevel": "region"}, {"dataName": "b", "temporalLevel": "year"}, {"dataName": "c", "granularity": "x"},
                  {"dataName": "d", "theme": {"themeName": "T", "themeDescription": "T"}}, {"dataName": "e", "dataDescription": "", "dataType": "int"}, {"dataName": "f"}]
    path = write(folder, "x.json", json.dumps({"title": "t", "attributes": attributes}, indent=1))
    kinds = [a["kind"] for a in sinks.read_documents(spark, path).first()["attributes"]]
    assert kinds == ["SpatialParameter", "TemporalParameter", "ComplementaryInformation", "ExistingIndicator", "Parameter", "Attribute"]


def test_perf_log(spark, folder):
    log = os.path.join(folder, "perf")
    write(log, "a.perf.json", json.dumps({"datasetId": "a", "timings": {"total_sec": 1.5}, "executedAt": "2024-01-02T00:00:00+00:00"}, indent=1))
    write(log, "b.perf.json", json.dumps({"datasetId": "b", "timings": {"total_sec": 2.0}, "executedAt": "never"}))
    write(log, "c.perf.json", "not json")
    table = sinks.write_perf_table(spark, log, folder + "/csv", folder + "/parquet")
    assert [(r["datasetId"], r["total_sec"]) for r in table.collect()] == [("a", 1.5), ("b", 2.0)]
    assert spark.read.parquet(folder + "/parquet").count() == 2 and spark.read.option("header", True).csv(folder + "/csv").count() == 2


def lake_files(folder):
    write(folder, "lake/villes_2021.csv", "code_dep;valeur;nom\n" + "".join(f"{c};{i % 9};{n}\n" for i, (c, n) in enumerate([("75", "x"), ("1", "y")] * 20)))
    write(folder, "lake/x_data.csv", "GEO;OBS\n1;3\n2;4\n")
    write(folder, "lake/x_metadata.csv", "COD_VAR;LIB_VAR;COD_MOD;LIB_MOD\nGEO;g;01;PARIS\nGEO;g;2;AIN\n")
    write(folder, "lake/dep_75_mesures.csv", "a,b\n" + "1,2\n3,4\n" * 10)
    write(folder, "lake/points.geojson", '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"n":1},"geometry":{"type":"Point","coordinates":[1.5,2.0]}}]}')
    write(folder, "lake/broken.zip", "x")


def test_catalog_twice(spark, folder):
    lake_files(folder)
    out = folder + "/out"
    errors = build_catalog(spark, folder + "/lake", out, references(spark))
    assert [r["path"].rsplit("/", 1)[-1] for r in errors.collect()] == ["broken.zip"]
    first = sinks.read_catalog(spark, out + "/catalog")
    rows = {r["title"]: r for r in first.collect()}
    assert set(rows) == {"villes_2021.csv", "x_data.csv", "dep_75_mesures.csv", "points.geojson"}
    villes = rows["villes_2021.csv"]
    assert (villes["spatialGranularity"], villes["temporalGranularity"], villes["nRows"], villes["nCols"]) == ("departement", "year", 40, 4)  # the year of the title is a column
    scopes = {title: [(r["dim"], r["level"], r["value"], r["end_value"]) for r in spark.read.parquet(out + "/scopes").where(F.col("dataset_id") == row["id"]).collect()] for title, row in rows.items()}
    assert [t.asDict() for t in villes["temporalScope"]] == [{"temporalScopeLevel": "year", "nValues": 1}]
    assert ("temporal", "year", "2021", "2021") in scopes["villes_2021.csv"]
    assert len(villes["id"]) == 16
    assert rows["dep_75_mesures.csv"]["spatialScope"][0].asDict() == {"spatialScopeLevel": "departement", "nValues": 1}
    assert scopes["dep_75_mesures.csv"] == [("spatial", "departement", "75", None)]
    assert rows["points.geojson"]["spatialGranularity"] == "geometry" and rows["points.geojson"]["nFeatures"] == 1
    assert scopes["points.geojson"] == [("spatial", "geometry_extent", "POINT (1.5 2.0)", None)]
    enriched = spark.read.option("header", True).csv(rows["x_data.csv"]["rawzonePath"])
    assert sorted(map(tuple, enriched.collect())) == [("1", "3", "PARIS"), ("2", "4", "AIN")]
    # nothing changed, so nothing is described again
    build_catalog(spark, folder + "/lake", out, references(spark))
    again = sinks.read_catalog(spark, out + "/catalog")
    assert sorted((r["id"], r["generatedAt"]) for r in again.collect()) == sorted((r["id"], r["generatedAt"]) for r in rows.values())
    titles = [r["title"] for r in entries.ordered(again).collect()]
    assert titles == sorted(titles, key=str.lower)


def test_labels_series_titles_and_times(spark, folder):
    """Levels of labels, classes handed on within a series, constants of titles in the raw zone, seven timings."""
    write(folder, "lake/x_data.csv", "GEO;OBS;K\n" + "".join(f"{1 + i % 4};{i % 7};{i}\n" for i in range(40)))
    write(folder, "lake/x_metadata.csv", "COD_VAR;LIB_VAR;COD_MOD;LIB_MOD\n" + "".join(f"GEO;g;{k};{v}\n" for k, v in enumerate(["PARIS", "AIN", "Île-de-France", "nowhere"], 1)))
    write(folder, "lake/dep_75_2020.csv", "a,b\n" + "1,2\n3,4\n" * 10)
    write(folder, "lake/sales_1.csv", "amount;day\n" + "".join(f"{i % 7};2021-01-{1 + i % 28:02}\n" for i in range(60)))
    out = folder + "/out"
    registry = spark.createDataFrame([("sales_1.csv", "sales"), ("sales_2.csv", "sales")], "file_name string, filename_series_hint string")

    def build():
        errors = build_catalog(spark, folder + "/lake", out, references(spark), registry=registry, update_backbone=True)
        assert errors.collect() == []
        return {r["title"]: r for r in sinks.read_catalog(spark, out + "/catalog").collect()}

    rows = build()
    entry = rows["x_data.csv"]
    scopes = {(r["level"], r["value"]) for r in spark.read.parquet(out + "/scopes").where((F.col("dataset_id") == entry["id"]) & (F.col("dim") == "spatial")).collect()}
    assert scopes == {("region", "Île-de-France")} and entry["spatialGranularity"] == "departement"
    documents = {r["title"]: {a["dataName"]: a for a in r["attributes"]} for r in spark.read.json(out + "/metadata").collect()}
    label = documents["x_data.csv"]["GEO_LABEL"]
    assert (label["spatialLevel"], label["matched_by"], label["confidence"]) == ("mixed", "insee_metadata_sidecar_label_mixed_ref_spatial", 0.8)
    assert label["mixed_levels"] == ["region", "departement"]
    titled = rows["dep_75_2020.csv"]
    assert (titled["nCols"], titled["nRows"]) == (4, 20)
    raw = spark.read.option("header", True).csv(titled["rawzonePath"])
    assert raw.columns == ["a", "b", "METADATA_TEMPORAL_YEAR", "METADATA_SPATIAL_DEPARTEMENT"] and {tuple(r)[2:] for r in raw.collect()} == {("2020", "75")}
    for timings in (r["timings"].asDict() for r in sinks.read_perf_log(spark, out + "/perf").collect()):
        assert set(timings) == set(entries.TIMINGS) and all(v > 0 for v in timings.values())
        assert sum(timings.values()) <= 2 * timings["total_sec"]
    # by its values alone the column would be an identifier
    write(folder, "lake/sales_2.csv", "amount;other\n" + "".join(f"{i * 37};{i % 5}\n" for i in range(40)))
    rows = build()
    documents = {r["title"]: {a["dataName"]: a["role"] for a in r["attributes"]} for r in spark.read.json(out + "/metadata").collect()}
    assert documents["sales_2.csv"] == {"amount": "indicator", "other": "indicator"}
    kept = sinks.read_catalog(spark, out + "/backbone", BACKBONE_SCHEMA)
    assert sorted((r["series_hint"], r["column_name_normalized"]) for r in kept.collect()) == [("sales", "amount"), ("sales", "day"), ("sales", "other")]


def test_levels_of_labels(spark):
    """Names before codes; blanks are no labels; labels without a place keep their list."""
    keys = reference.reference_keys(references(spark))
    rows = [(1, " Paris "), (1, "paris"), (1, "x"), (1, ""), (2, "75"), (2, "1"), (2, "01"), (3, "75"), (3, "x"), (4, "x"), (5, " "), (6, "Ain"), (6, "ILE-DE-FRANCE")]
    columns, values = labels.label_levels(spark.createDataFrame(rows, "cid int, v string"), keys, ["cid"])
    found = {r["cid"]: (r["granularity"], r["matched_by"].removeprefix("insee_metadata_sidecar"), r["confidence"], r["mixed_levels"]) for r in columns.collect()}
    assert found == {
        1: ("departement", "_label_ref_spatial", 0.8, ["departement"]), 2: ("departement", "_label_code", 0.99, []), 3: ("insee_geo", "", 0.98, []),
        4: ("insee_geo", "", 0.98, []), 6: ("mixed", "_label_mixed_ref_spatial", 0.99, ["region", "departement"]),
    }
    assert sorted(tuple(r) for r in values.collect()) == [(1, "departement", "Paris"), (1, "departement", "paris"), (6, "departement", "Ain"), (6, "region", "ILE-DE-FRANCE")]


def test_damaged_file_forced_rerun_and_documents(spark, folder):
    write(folder, "lake/villes_2021.csv", "code_dep;valeur;nom\n" + "75;1;x\n01;2;y\n" * 10)
    good = write(folder, "bad.parquet", b"")
    pq.write_table(pa.table({"a": [str(i * 7919) for i in range(5000)]}), good, use_dictionary=False)
    data = bytearray(open(good, "rb").read())
    data[200 : len(data) // 2] = b"\xff" * (len(data) // 2 - 200)  # the footer stays whole
    write(folder, "lake/bad.parquet", bytes(data))
    out = folder + "/out"
    errors = build_catalog(spark, folder + "/lake", out, references(spark))
    assert [r["path"].rsplit("/", 1)[-1] for r in errors.collect()] == ["bad.parquet"]
    assert [r["title"] for r in sinks.read_catalog(spark, out + "/catalog").collect()] == ["villes_2021.csv"]
    before = spark.read.parquet(out + "/scopes").count()
    build_catalog(spark, folder + "/lake", out, references(spark), force=True)
    assert before == spark.read.parquet(out + "/scopes").count() > 0
    kinds = {a["dataName"]: (a["kind"], a["spatialLevel"]) for a in sinks.read_documents(spark, out + "/metadata").first()["attributes"]}
    assert kinds["code_dep"] == ("SpatialParameter", "departement") and {"valeur", "nom"} <= set(kinds)


def test_stream_describes_new_files(spark, folder):
    write(folder, "lake/a_2020.csv", "a;b\n1;2\n2;3\n")
    out = folder + "/out"

    def run():
        query = watch(spark, folder + "/lake", out, references(spark), checkpoint=folder + "/checkpoint")
        query.awaitTermination()
        return sorted(r["title"] for r in sinks.read_catalog(spark, out + "/catalog").collect())

    assert run() == ["a_2020.csv"]
    write(folder, "lake/b_2021.csv", "a;b\n1;2\n2;3\n")
    assert run() == ["a_2020.csv", "b_2021.csv"]


def test_files_and_sidecars_of_other_batches(spark, folder):
    def arrive(*names):
        for name in names:
            write(folder, "lake/" + name, "x")

    def run(wait, place):
        files = spark.readStream.format("binaryFile").schema(incremental.FILE_SCHEMA).option("recursiveFileLookup", True).load(folder + "/lake")
        writer = incremental.with_mates(files, wait).writeStream.format("parquet").option("path", f"{folder}/{place}").option("checkpointLocation", f"{folder}/{place}-state")
        assert incremental.start(spark, writer).awaitTermination(60) is True
        name = lambda path: path and path.rsplit("/", 1)[-1]
        return sorted((name(r["path"]), name(r["sidecar"]) or "", r["again"]) for r in spark.read.schema(incremental.ARRIVED_SCHEMA).parquet(f"{folder}/{place}").collect())

    arrive("a_data.csv", "b_metadata.csv", "c_data.csv", "c_metadata.csv", "d.csv", "e_data.CSV", "sub/a_metadata.csv")
    first = [("c_data.csv", "c_metadata.csv", False), ("d.csv", "", False)]
    early = [("a_data.csv", "", False), ("e_data.CSV", "", False)]
    assert run(0, "at-once") == sorted(first + early)
    assert run(3600, "held") == first
    arrive("a_metadata.csv", "b_data.csv", "e_metadata.csv")
    mates = [("a_data.csv", "a_metadata.csv", True), ("b_data.csv", "b_metadata.csv", False)]
    assert run(0, "at-once") == sorted(first + early + mates)
    assert run(3600, "held") == sorted(first + [(*m[:2], False) for m in mates])
    assert run(0.5, "timed") == sorted(first + [(*m[:2], False) for m in mates])
    time.sleep(1)
    arrive("z.csv")
    assert run(0.5, "timed") == sorted(first + [(*m[:2], False) for m in mates] + early[1:] + [("z.csv", "", False)])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_stream_labels_codes_of_a_later_sidecar(spark, folder):
    write(folder, "lake/x_data.csv", "GEO;OBS\n1;3\n2;4\n")
    out = folder + "/out"

    def run():
        watch(spark, folder + "/lake", out, references(spark), checkpoint=folder + "/checkpoint").awaitTermination()
        return sinks.read_catalog(spark, out + "/catalog").collect()

    assert [(r["title"], r["nCols"]) for r in run()] == [("x_data.csv", 2)]
    write(folder, "lake/x_metadata.csv", "COD_VAR;LIB_VAR;COD_MOD;LIB_MOD\nGEO;g;01;PARIS\nGEO;g;2;AIN\n")
    entry = run()
    assert [(r["title"], r["nCols"]) for r in entry] == [("x_data.csv", 3)]
    enriched = spark.read.option("header", True).csv(entry[0]["rawzonePath"])
    assert sorted(map(tuple, enriched.collect())) == [("1", "3", "PARIS"), ("2", "4", "AIN")]


def test_annotated_description(spark):
    rows = [("rue Verte", str(i), "75", 48.0 + i / 100, 2.0 + i / 100, f"2021-0{1 + i % 3}") for i in range(20)]
    table = spark.createDataFrame(rows, "nomvoie string, numvoie string, code_dep string, lat double, lon double, mois string")
    from colonnade.operators.annotations import ANNOTATION_SCHEMA

    flags = {"nomvoie": "s", "numvoie": "s", "code_dep": "s", "lat": "s", "lon": "s", "mois": "t"}
    notes = spark.createDataFrame([("d", c, c, k == "s", k == "t", False, False, None, None, "given") for c, k in flags.items()], ANNOTATION_SCHEMA)
    files = spark.createDataFrame([("d", "d.csv")], "dataset_id string, title string")
    described = describe_tables(spark, {"d": table}, files, references(spark), annotations=notes)
    found = {tuple(r["columns"]): (r["role"], r["granularity"]) for r in described.attributes.collect()}
    assert found == {("numvoie", "nomvoie"): ("spatial", "address"), ("code_dep",): ("spatial", "departement"),
                     ("lat", "lon"): ("spatial", "latlon_pair"), ("mois",): ("temporal", "month")}
    record = described.records.first()
    assert (record["spatialGranularity"], record["temporalGranularity"], record["nCols"]) == ("address", "month", 6)
    scope = {(r["dim"], r["level"]): (r["value"], r["end_value"]) for r in described.scopes.collect()}
    assert scope == {("spatial", "departement"): ("75", None), ("temporal", "month"): ("2021-01", "2021-03")}


def test_geojson_of_mixed_geometries(spark, folder):
    shapes = [("Point", [1.5, 2]), ("LineString", [[0, 0], [3, 4.25]]), ("Polygon", [[[5, 5], [9, 5], [9, 8], [5, 5]]]), ("MultiPolygon", [[[[10, 1]]], [[[11, -2]]]]), ("MultiPoint", [[7, 7]])]
    features = [{"type": "Feature", "properties": {"n": i, "t": "x"}, "geometry": {"type": t, "coordinates": c}} for i, (t, c) in enumerate(shapes)]
    features.append({"type": "Feature", "properties": {"n": 5, "t": "c"}, "geometry": {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [20, 20]}, {"type": "LineString", "coordinates": [[21, 21]]}]}})
    features.append({"type": "Feature", "properties": {"n": 6, "t": None}, "geometry": None})
    text = json.dumps({"type": "FeatureCollection", "features": features})
    for path in (write(folder, "mixed.geojson", text), write(folder, "mixed.json", text)):
        table = readers.read_table(spark, path)
        assert table.columns == ["n", "t", "geometry"] and [tuple(r) for r in table.select("n", "t").collect()] == [(f["properties"]["n"], f["properties"]["t"]) for f in features]
        found = vertices.geometry_vertices(table, ["n"], "geometry")
        assert dict(found.dtypes)["x"] == "double"
        assert sorted(tuple(r) for r in found.collect()) == [
            (0, True, 1.5, 2.0), (1, False, 0.0, 0.0), (1, False, 3.0, 4.25), (2, False, 5.0, 5.0), (2, False, 5.0, 5.0), (2, False, 9.0, 5.0), (2, False, 9.0, 8.0),
            (3, False, 10.0, 1.0), (3, False, 11.0, -2.0), (4, True, 7.0, 7.0), (5, False, 20.0, 20.0), (5, False, 21.0, 21.0)]
    even = readers.read_table(spark, write(folder, "even.geojson", json.dumps({"type": "FeatureCollection", "features": features[1:2]})))
    assert even.schema["geometry"].dataType["coordinates"].dataType.simpleString() == "array<array<double>>"
    assert sorted((r.x, r.y) for r in vertices.geometry_vertices(even, ["n"], "geometry").collect()) == [(0, 0), (3, 4.25)]


def test_extents_of_geometry_texts(spark, folder):
    lines = ["id;geometry"] + [f'{i};"POLYGON (({i} 0, {i + 1} 0, {i} {i + 2}, {i} 0))"' for i in range(6)]
    write(folder, "lake/zones.csv", "\n".join(lines) + "\n")
    write(folder, "lake/mixed.geojson", json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}},
        {"type": "Feature", "properties": {"n": 2}, "geometry": {"type": "Polygon", "coordinates": [[[5, 5], [9, 5], [9, 8], [5, 5]]]}}]}))
    out = folder + "/out"
    assert build_catalog(spark, folder + "/lake", out, references(spark)).count() == 0
    rows = {r["title"]: r["id"] for r in sinks.read_catalog(spark, out + "/catalog").collect()}
    found = collections.defaultdict(list)
    for r in spark.read.parquet(out + "/scopes").where("level = 'geometry_extent'").collect():
        found[r["dataset_id"]].append(r["value"])
    assert found[rows["zones.csv"]] == ["POLYGON ((0.0 0.0, 6.0 0.0, 6.0 7.0, 0.0 7.0, 0.0 0.0))"]
    assert sorted(found[rows["mixed.geojson"]]) == ["POINT (1.5 2.0)", "POLYGON ((5.0 5.0, 9.0 5.0, 9.0 8.0, 5.0 8.0, 5.0 5.0))"]


@pytest.mark.parametrize("separator", [",", ";"])
def test_state_of_quotes(separator):
    """Against a state machine over characters."""
    import random

    def after(line, inside):
        start = not inside
        i = 0
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    inside = False
            elif c == '"' and start:
                inside = True
            start = not inside and c == separator
            i += 1
        return inside

    r, quotes = random.Random(3), quoting.Quotes(separator)
    for _ in range(3000):
        line = "".join(r.choice(f'"{separator}ab') for _ in range(r.randint(0, 12)))
        assert [quotes.after(line, s) for s in (False, True)] == [after(line, s) for s in (False, True)], line


def test_delimited_records(spark, folder):
    table = readers.read_delimited(spark, write(folder, "a.csv", '"x;y",b,d\r\n1,"one\r\ntwo ""q""",2021-01-02\r\n2,5" pipe,2021-01-03\r\n\r\n3,"a,\n\nb",2021-02-03\r\n4,z,2021-02-03,extra\r\n5,,\r\n'))
    assert dict(table.dtypes) == {"x;y": "int", "b": "string", "d": "date"}
    assert sorted((r[0], (r[1] or "").replace("\r", ""), str(r[2])) for r in table.collect()) == [(1, 'one\ntwo "q"', "2021-01-02"), (2, '5" pipe', "2021-01-03"), (3, "a,\n\nb", "2021-02-03"), (5, "", "None")]
    head = readers.read_delimited(spark, write(folder, "b.csv", '"a;b",c\n1,2\n'))
    assert head.columns == ["a;b", "c"] and [tuple(r) for r in head.collect()] == [(1, 2)]
    broken = readers.read_delimited(spark, write(folder, "c.csv", '"first\nname";n;n\n"p\nq";1;2\n'))
    assert broken.columns == ["first\nname", "n1", "n2"] and [tuple(r) for r in broken.collect()] == [("p\nq", 1, 2)]
    never = readers.read_delimited(spark, write(folder, "d.csv", 'a,b\n1,"open\n2,x\n'))
    assert sorted(r["a"] for r in never.collect()) == [1, 2]
    old = readers.read_delimited(spark, write(folder, "e.csv", 'a;b\n1;"é€\nœ"\n'.encode("cp1252")))
    assert [tuple(r) for r in old.collect()] == [(1, "é€\nœ")]


@pytest.mark.parametrize("size,files", [("64", 1), ("700", 3), ("128m", 1)])
def test_delimited_records_across_blocks(spark, folder, size, files):
    """Quoted line breaks survive where files are split, also records longer than a block."""
    texts = ["plain", 'say "no"', "a\nb", "\n", ",;", '"', "", None, "x\n" * 200, '"\n",\n', "é\n\nœ" * 9, "end"]
    rows = spark.createDataFrame([(i, texts[i % len(texts)], float(i) / 4) for i in range(120)], "id int, t string, v double")
    as_is = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.repartition(files).write.options(**as_is).csv(folder + "/out")
    rows = rows.withColumn("t", F.nullif("t", F.lit("")))  # an empty field has no value
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        wide = readers.read_delimited(spark, write(folder, "wide.csv", 'a,"' + "long\n" * 30 + '"\n1,"x\ny"\n'))
        assert wide.columns == ["a", "long\n" * 30] and [tuple(r) for r in wide.collect()] == [(1, "x\ny")]
        read = readers.read_delimited(spark, folder + "/out")
        assert read.schema == rows.schema and read.exceptAll(rows).count() == 0 and rows.exceptAll(read).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("whole,block", [(1 << 20, 1 << 20), (-1, 3), (10, 4), (10, 1 << 20)])
def test_checksums_by_block(spark, folder, whole, block):
    """The same for files read whole and in blocks, also where a file ends with a block."""
    import hashlib

    contents = {"a": b"", "b": b"x", "c": b"abcd" * 3, "d e": bytes(range(256)) * 9, "é": b"0123456789", "f": b"0123456789a"}
    paths = [write(folder, name, data) for name, data in contents.items()]
    found = {os.path.basename(r["path"]): r["checksum"] for r in lake.checksums(spark, paths, whole_bytes=whole, block_bytes=block).collect()}
    assert found == {name: hashlib.sha256(data).hexdigest() for name, data in contents.items() if data}  # listings leave out empty files


def test_codes_keep_their_padding(spark):
    """Scope values of a column matched by code join its code list."""
    rows = spark.createDataFrame([("01",), ("75",), ("01",), (None,)] * 5, "code_dep string")
    files = spark.createDataFrame([("t", "t.parquet", ".parquet")], "dataset_id string, title string, fileType string")
    described = describe_tables(spark, {"t": rows}, files, references(spark))
    assert sorted((r["level"], r["value"]) for r in described.scopes.collect()) == [("departement", "01"), ("departement", "75")]
