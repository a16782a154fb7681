"""Spatial, hierarchy, theme, sheet, annotation, source and catalog queries."""

from __future__ import annotations

import struct
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions.numbers import human_size
from colonnade.operators import annotations as notes
from colonnade.operators import catalog, hierarchy, sheets, spatial, vertices
from colonnade.operators.profile import profile_columns
from colonnade.session import shared_folder
from colonnade.sources import readers
from workload.tables import load

# --- spatial -------------------------------------------------------------------------------------------------------


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(
        "c_mktsegment",
        F.replace((F.pmod(key * 37, F.lit(18000)) / 100.0 - 90.0).cast("string"), F.lit("."), F.lit(",")).alias("latitude"),
        (F.pmod(key * 53, F.lit(40000)) / 100.0 - 200.0).alias("longitude"),
        (F.pmod(key * 7919, F.lit(900000)) + 50000.0).alias("x"), (F.pmod(key * 104729, F.lit(900000)) + 50000.0).alias("y"),
    )


_PLACES_SQL = """places AS (SELECT c_mktsegment, (c_custkey * 37 % 18000) / 100.0 - 90.0 AS latitude, (c_custkey * 53 % 40000) / 100.0 - 200.0 AS longitude,
  (c_custkey * 7919 % 900000) + 50000.0 AS x, (c_custkey * 104729 % 900000) + 50000.0 AS y FROM customer)"""


def coordinate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = profile_columns(spark, {"places": _places(spark, sf_dir)}, ["coord_count", "lat", "lon", "x", "y"])
    return spatial.coordinate_pairs(profile).select("dataset_id", "kind", "first_column", "second_column", F.round("score", 6).alias("score"))


PAIRS_SQL = f"""WITH {_PLACES_SQL},
s AS (SELECT avg(CAST(latitude BETWEEN -90 AND 90 AS INT)) AS la, avg(CAST(longitude BETWEEN -180 AND 180 AS INT)) AS lo,
  avg(CAST(y BETWEEN 1e5 AND 1.1e7 AS INT)) AS y, avg(CAST(x BETWEEN 1e5 AND 2e7 AS INT)) AS x FROM places)
SELECT 'places' AS dataset_id, kind, first_column, second_column, round(score, 6) AS score FROM (
  SELECT 'geo' AS kind, 'latitude' AS first_column, 'longitude' AS second_column, (la + lo) / 2 AS score FROM s
  UNION ALL SELECT 'proj', 'y', 'x', (y + x) / 2 FROM s) WHERE score >= 0.7"""


def spatial_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = spatial.coordinate_points(_places(spark, sf_dir), ["c_mktsegment"], "y", "x")
    box = spatial.envelope(points, ["c_mktsegment"])
    counts = points.groupBy("c_mktsegment").agg(F.count("*").alias("n_points"))
    return box.join(counts, "c_mktsegment").select("c_mktsegment", "min_x", "min_y", "max_x", "max_y", "wkt", "n_points")


EXTENT_SQL = f"""WITH {_PLACES_SQL},
b AS (SELECT c_mktsegment, min(CAST(x AS DOUBLE)) AS a, min(CAST(y AS DOUBLE)) AS b, max(CAST(x AS DOUBLE)) AS c, max(CAST(y AS DOUBLE)) AS d, count(DISTINCT (x, y)) AS n FROM places GROUP BY c_mktsegment)
SELECT c_mktsegment, a AS min_x, b AS min_y, c AS max_x, d AS max_y,
  'POLYGON ((' || a || ' ' || b || ', ' || c || ' ' || b || ', ' || c || ' ' || d || ', ' || a || ' ' || d || ', ' || a || ' ' || b || '))' AS wkt, n AS n_points FROM b"""


def extent_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = spatial.coordinate_points(_places(spark, sf_dir), ["c_mktsegment"], "y", "x")
    return spatial.union_points(points, ["c_mktsegment"])


UNION_SQL = f"""WITH {_PLACES_SQL}
SELECT DISTINCT c_mktsegment, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM places"""


def extent_hull(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = spatial.coordinate_points(_places(spark, sf_dir), ["c_mktsegment"], "y", "x")
    return spatial.convex_hull(points, "c_mktsegment")


# a lowest point is a vertex where every slope on its left is smaller than every slope on its right; highest ones mirrored
HULL_SQL = f"""WITH {_PLACES_SQL},
d AS (SELECT c_mktsegment AS k, CAST(x AS DOUBLE) AS x, min(CAST(y AS DOUBLE)) AS low, max(CAST(y AS DOUBLE)) AS high FROM places GROUP BY 1, 2),
p AS (SELECT k, 1 AS side, x, low AS y FROM d UNION ALL SELECT k, -1, x, high FROM d),
v AS (SELECT a.k, a.side, a.x, a.y FROM p a LEFT JOIN p b ON a.k = b.k AND a.side = b.side AND a.x <> b.x GROUP BY a.k, a.side, a.x, a.y
  HAVING coalesce(max(CASE WHEN b.x < a.x THEN a.side * (a.y - b.y) / (a.x - b.x) END) < min(CASE WHEN b.x > a.x THEN a.side * (b.y - a.y) / (b.x - a.x) END), TRUE))
SELECT k AS c_mktsegment, CAST(row_number() OVER (PARTITION BY k ORDER BY side DESC, x * side) - 1 AS INT) AS pos, x, y
FROM (SELECT k, max(side) AS side, x, y FROM v GROUP BY k, x, y)"""


_FORMS = ("wkt", "geojson", "wkb", "hex")


def geometry_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes and vertex counts of a triangle at each customer's place, written as WKT, GeoJSON, binary and hex digits."""
    places = load(spark, sf_dir, "customer").where("c_acctbal IS NOT NULL").select(
        "c_nationkey", F.col("c_acctbal").cast("double").alias("x"), F.pmod("c_custkey", F.lit(180)).cast("double").alias("y")
    )
    corners = [("x", "y"), ("x + 1", "y"), ("x", "y + 0.5e0"), ("x", "y")]
    pair = lambda a, b, sep: F.concat_ws(sep, F.expr(a).cast("string"), F.expr(b).cast("string"))
    wkt = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[pair(a, b, " ") for a, b in corners]), F.lit("))"))
    ring = F.concat_ws(",", *[F.concat(F.lit("["), pair(a, b, ","), F.lit("]")) for a, b in corners])
    geojson = F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}"))
    texts = {"wkt": places.select("c_nationkey", wkt.alias("g")), "geojson": places.select("c_nationkey", geojson.alias("g"))}
    flat = F.array(*[F.expr(e) for corner in corners for e in corner])
    binary = places.select("c_nationkey", flat.alias("flat")).mapInArrow(_polygons, "c_nationkey long, g binary")
    texts |= {"wkb": binary, "hex": binary.select("c_nationkey", F.hex("g").alias("g"))}
    parts = []
    for form in _FORMS:
        found = vertices.geometry_vertices(texts[form], ["c_nationkey"], "g").where("NOT is_point")
        counts = found.groupBy("c_nationkey").agg(F.count("*").alias("n_vertices"))
        box = spatial.envelope(found, ["c_nationkey"]).join(counts, "c_nationkey").drop("wkt")
        parts.append(box.select(F.lit(form).alias("form"), F.col("c_nationkey").cast("long"), "min_x", "min_y", "max_x", "max_y", "n_vertices"))
    return reduce(DataFrame.unionByName, parts)


def _polygons(batches):
    """Well-known binary of one ring of four vertices for each row."""
    for batch in batches:
        numbers = np.asarray(batch.column("flat").flatten(), dtype="<f8").reshape(len(batch), -1)
        head = struct.pack("<BIII", 1, 3, 1, numbers.shape[1] // 2)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([head + row.tobytes() for row in numbers], pa.binary())], ["c_nationkey", "g"])


GEOMETRY_EXTENTS_SQL = """
WITH p AS (SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(c_acctbal AS DOUBLE) AS x, CAST(c_custkey % 180 AS DOUBLE) AS y FROM customer WHERE c_acctbal IS NOT NULL)
SELECT form, c_nationkey, min(x) AS min_x, min(y) AS min_y, max(x + 1) AS max_x, max(y + 0.5e0) AS max_y, 4 * count(*) AS n_vertices
FROM p, unnest(['wkt', 'geojson', 'wkb', 'hex']) AS f(form) GROUP BY form, c_nationkey"""


def delimited_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as delimited text, whose fields hold line breaks, separators and quotes, and read back."""
    rows = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = f"{shared_folder(spark).rstrip('/')}/delimited-{uuid.uuid4().hex}.csv"
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**options).csv(path)
    read = readers.read_delimited(spark, path)
    return read.select("doc_id", "lang", "source", "n_chars", F.length("text").cast("long").alias("length"), F.md5("text").alias("digest"))


DELIMITED_RECORDS_SQL = """
SELECT doc_id, nullif(lang, '') AS lang, nullif(source, '') AS source, n_chars, length(nullif(text, '')) AS length, md5(nullif(text, '')) AS digest FROM documents"""


def scope_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (("nation", "n_name"), ("part", "p_size"), ("part", "p_brand"), ("lineitem", "l_discount"), ("lineitem", "l_quantity"))
    parts = [load(spark, sf_dir, t).select(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for t, c in columns]
    padded = load(spark, sf_dir, "customer").select(F.lit("code").alias("column"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("v"))
    rows = padded
    for part in parts:
        rows = rows.unionByName(part)
    return spatial.scope_values(rows.distinct(), ["column"])


SCOPE_VALUES_SQL = """
SELECT DISTINCT 'n_name' AS "column", n_name AS value FROM nation UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT DISTINCT 'p_brand', p_brand FROM part
UNION ALL SELECT DISTINCT 'l_discount', CASE WHEN l_discount = trunc(l_discount) THEN CAST(CAST(l_discount AS BIGINT) AS VARCHAR) ELSE CAST(l_discount AS VARCHAR) END FROM lineitem
UNION ALL SELECT DISTINCT 'l_quantity', CASE WHEN l_quantity = trunc(l_quantity) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE CAST(l_quantity AS VARCHAR) END FROM lineitem
UNION ALL SELECT DISTINCT 'code', CAST(c_nationkey AS VARCHAR) FROM customer"""

# --- hierarchies -----------------------------------------------------------------------------------------------------

_LEVELS = ("country", "region", "departement", "commune", "epci", "iris", "wkt_geojson", "insee_geo", "latlon_pair", "geocode")


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of customers: each digit of the key and the nation names one."""
    names = F.array(*[F.lit(x) for x in _LEVELS])
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("dataset_id"),
        F.explode(F.array(F.get(names, F.pmod("c_custkey", F.lit(10))), F.get(names, F.pmod("c_nationkey", F.lit(10))),
                          F.get(names, F.pmod(F.floor(F.col("c_custkey") / 10), F.lit(10)).cast("int")))).alias("level"),
    )


def granularity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.granularity_rollup(_levels(spark, sf_dir), hierarchy.hierarchy_table(spark), "spatial")


def scope_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.scope_rollup(_levels(spark, sf_dir), hierarchy.hierarchy_table(spark), "spatial")


def _rollup_sql(specific: bool) -> str:
    from colonnade.functions import fixed

    rows = []
    for path_id, path in enumerate(fixed.HIERARCHIES["spatial"]):
        for pos, entry in enumerate(path):
            aliases = entry if isinstance(entry, tuple) else (entry,)
            rows += [f"({path_id}, {pos}, '{a}', '{aliases[0]}')" for a in aliases]
    names = ", ".join(f"'{x}'" for x in _LEVELS)
    pick = "arg_max" if specific else "arg_min"
    return f"""
WITH h(path_id, pos, level, name) AS (VALUES {', '.join(rows)}),
l AS (SELECT DISTINCT c_custkey AS dataset_id, unnest([list_extract([{names}], c_custkey % 10 + 1), list_extract([{names}], c_nationkey % 10 + 1),
  list_extract([{names}], c_custkey // 10 % 10 + 1)]) AS level FROM customer),
p AS (SELECT dataset_id, path_id, {pick}(name, pos) AS pick FROM l JOIN h USING (level) GROUP BY dataset_id, path_id),
ok AS (SELECT a.dataset_id, a.path_id, a.pick, (SELECT bool_and(EXISTS (SELECT 1 FROM h WHERE h.path_id = a.path_id AND h.name = b.pick))
  FROM p b WHERE b.dataset_id = a.dataset_id) AS whole FROM p a),
w AS (SELECT dataset_id, arg_min(pick, path_id) FILTER (whole) AS single, arg_min(pick, path_id) AS first FROM ok GROUP BY dataset_id)"""


GRANULARITY_SQL = _rollup_sql(True) + " SELECT dataset_id, coalesce(single, first) AS granularity FROM w"
SCOPE_SQL = _rollup_sql(False) + """,
m AS (SELECT dataset_id, pick, min(path_id) AS path_id FROM p GROUP BY dataset_id, pick)
SELECT dataset_id, 0 AS scope_pos, single AS level FROM w WHERE single IS NOT NULL
UNION ALL SELECT m.dataset_id, row_number() OVER (PARTITION BY m.dataset_id ORDER BY path_id) - 1, pick FROM m JOIN w ON m.dataset_id = w.dataset_id WHERE single IS NULL"""

# --- themes -----------------------------------------------------------------------------------------------------------


def _themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    separator = F.when(F.col("p_size") < 20, " > ").when(F.col("p_size") < 40, "/").otherwise(" → ")
    root = F.when(F.col("p_retailprice") > 1000, "Parts & goods").otherwise("Parts (all)")
    name = F.split("p_name", " ")
    return load(spark, sf_dir, "part").select(
        F.col("p_brand").alias("dataset_id"),
        F.concat(F.when(F.col("p_brand") < "Brand#3", F.lit("Parts (all)")).otherwise(root), separator,
                 F.when(F.col("p_brand") < "Brand#2", F.lit("STANDARD")).otherwise(F.col("p_type")), separator, F.get(name, F.lit(0)), F.lit(" ")).alias("theme"),
    )


_THEMES_SQL = """raw AS (SELECT p_brand AS dataset_id, CASE WHEN p_brand < 'Brand#3' THEN 'Parts (all)' WHEN p_retailprice > 1000 THEN 'Parts & goods' ELSE 'Parts (all)' END
  AS a, CASE WHEN p_brand < 'Brand#2' THEN 'STANDARD' ELSE p_type END AS b, split_part(p_name, ' ', 1) AS c FROM part),
themes AS (SELECT DISTINCT dataset_id, a, b, c FROM raw)"""


def theme_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.theme_set(_themes(spark, sf_dir))


def theme_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.common_theme(hierarchy.theme_set(_themes(spark, sf_dir)))


def rawzone_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = load(spark, sf_dir, "part").select(F.col("p_brand").alias("dataset_id")).distinct()
    prefixes = hierarchy.common_theme(hierarchy.theme_set(_themes(spark, sf_dir)))
    file_name = F.concat(F.col("dataset_id"), F.lit(".csv"))
    return brands.join(prefixes, "dataset_id", "left").select("dataset_id", hierarchy.raw_zone_path(F.col("prefix"), file_name).alias("path"))


THEME_SET_SQL = f"WITH {_THEMES_SQL} SELECT DISTINCT dataset_id, a || ' > ' || b || ' > ' || c AS theme FROM themes"
_PREFIX_SQL = f"""WITH {_THEMES_SQL},
n AS (SELECT dataset_id, count(DISTINCT a) AS na, count(DISTINCT (a, b)) AS nb, count(*) AS nc, min(a) AS a, min(b) AS b, min(c) AS c FROM themes GROUP BY dataset_id),
x AS (SELECT dataset_id, CASE WHEN na > 1 THEN NULL WHEN nb > 1 THEN a WHEN nc > 1 THEN a || ' > ' || b ELSE a || ' > ' || b || ' > ' || c END AS prefix FROM n)"""
THEME_PREFIX_SQL = _PREFIX_SQL + " SELECT dataset_id, prefix FROM x WHERE prefix IS NOT NULL"
RAWZONE_SQL = _PREFIX_SQL + r""" SELECT dataset_id, 'raw/' || coalesce(regexp_replace(regexp_replace(replace(replace(lower(prefix), '&', 'and'), ' > ', '/'), '[()]', '', 'g'), ' +', '-', 'g'),
  'unclassified') || '/' || dataset_id || '.csv' AS path FROM x"""

# --- annotations ------------------------------------------------------------------------------------------------------


def _annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations derived from parts: the type decides the class, some are wrong on purpose."""
    kind = F.col("p_type")
    return load(spark, sf_dir, "part").select(
        F.lit("part").alias("dataset_id"), F.col("p_partkey").cast("string").alias("column"), F.lit("").alias("meaning"),
        kind.isin("STANDARD", "LARGE").alias("is_spatial"), (kind == "PROMO").alias("is_temporal"),
        kind.isin("SMALL", "LARGE").alias("is_indicator"), kind.isin("ECONOMY", "MEDIUM").alias("is_other_information"),
        F.when(F.col("p_size") < 25, "Quantitative").alias("indicator_type"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("Parts > "), kind)).alias("thematic_path"), F.lit("x").alias("semantic_source"),
    )


def annotation_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = load(spark, sf_dir, "part").where("p_type <> 'MEDIUM'").select(F.concat(F.lit("Parts > "), F.col("p_type")).alias("path")).distinct()
    return notes.check(_annotations(spark, sf_dir), nodes, "Parts").select("column", "one_class", "type_ok", "path_ok", "path_given", "valid")


VALIDITY_SQL = """
WITH a AS (SELECT CAST(p_partkey AS VARCHAR) AS col, p_type <> 'LARGE' AS one_class, p_type IN ('SMALL', 'LARGE') OR p_size >= 25 AS type_ok,
  p_size <= 10 OR p_type <> 'MEDIUM' AS path_ok, p_type NOT IN ('SMALL', 'LARGE') OR p_size > 10 AS path_given FROM part)
SELECT col AS "column", one_class, type_ok, path_ok, path_given, one_class AND type_ok AND path_ok AND path_given AS valid FROM a"""


def backbone_inherit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backbone derived from order priorities; numeric columns contradict its *other* entries."""
    tables = {
        "orders": load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("O-Custkey"), F.col("o_orderpriority").alias("O Priority"), "o_totalprice"),
        "customer": load(spark, sf_dir, "customer").select("c_name", "c_acctbal", F.lit(None).cast("string").alias("c_mktsegment")),
    }
    backbone = load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.max("o_orderstatus").alias("s")).agg(
        F.count("*").alias("n")
    ).select(
        F.lit("series").alias("series_hint"),
        F.explode(F.array(*[F.lit(c) for c in ("o_custkey", "o_priority", "c_name", "c_acctbal", "c_mktsegment")])).alias("column_name_normalized"),
    ).select(
        "*", F.lit("known").alias("meaning"), (F.col("column_name_normalized") == "c_mktsegment").alias("is_spatial"), F.lit(False).alias("is_temporal"),
        (F.col("column_name_normalized") == "o_custkey").alias("is_indicator"),
        F.col("column_name_normalized").isin("o_priority", "c_name", "c_acctbal").alias("is_other_information"),
        F.lit(None).cast("string").alias("indicator_type"), F.lit(None).cast("string").alias("thematic_path"),
    )
    series = spark.createDataFrame([("orders", "series"), ("customer", "series")], "dataset_id string, series_hint string")
    profile = profile_columns(spark, tables, notes.SAMPLE_MEASURES)
    inherited = notes.inherit(profile, backbone, series)
    missing = notes.unmatched(profile.select("dataset_id", "column"), inherited)
    return inherited.select("dataset_id", "column", "semantic_source").unionByName(
        missing.select("dataset_id", "column", F.lit("file_inferred").alias("semantic_source"))
    )


BACKBONE_SQL = """
SELECT 'orders' AS dataset_id, 'O-Custkey' AS "column", CASE WHEN count(o_orderkey) > 0 THEN 'backbone' ELSE 'file_inferred' END AS semantic_source FROM orders
UNION ALL SELECT 'orders', 'O Priority', CASE WHEN count(TRY_CAST(o_orderpriority AS DOUBLE)) / count(*) >= 0.8 THEN 'file_inferred' ELSE 'backbone' END FROM orders
UNION ALL SELECT 'orders', 'o_totalprice', 'file_inferred' FROM orders HAVING count(*) > 0
UNION ALL SELECT 'customer', 'c_name', CASE WHEN count(TRY_CAST(c_name AS DOUBLE)) / count(*) >= 0.8 THEN 'file_inferred' ELSE 'backbone' END FROM customer
UNION ALL SELECT 'customer', 'c_acctbal', CASE WHEN count(c_acctbal) / count(*) >= 0.8 THEN 'file_inferred' ELSE 'backbone' END FROM customer
UNION ALL SELECT 'customer', 'c_mktsegment', 'file_inferred' FROM customer HAVING count(*) > 0"""

# --- sheets --------------------------------------------------------------------------------------------------------------


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets made of the nation and part tables: a header row above data rows, and a description of types."""

    def grid(df: DataFrame, row, values) -> DataFrame:
        cells = F.posexplode(F.array(*[v.cast("string") for v in values])).alias("col", "value")
        return df.select("dataset_id", "sheet", row.alias("row"), cells)

    nation = load(spark, sf_dir, "nation").withColumns({"dataset_id": F.lit("a"), "sheet": F.concat(F.lit("Nations "), F.col("n_regionkey"))})
    rank = (F.floor(F.col("n_nationkey") / 5) + 1).cast("int")
    body = grid(nation, rank, [F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey")])
    heads = nation.select("dataset_id", "sheet").distinct()
    head = grid(heads, F.lit(0), [F.lit("Clé"), F.lit("Nom"), F.lit("Région")])
    part = load(spark, sf_dir, "part").withColumns({"dataset_id": F.lit("b"), "sheet": F.concat(F.lit("Liste des variables "), F.col("p_brand"))})
    words = part.groupBy("dataset_id", "sheet").agg(F.max("p_type").alias("t"), F.max("p_name").alias("n"))
    dictionary = grid(words, F.lit(0), [F.lit("Variable"), F.lit("Description")]).unionByName(grid(words, F.lit(1), [F.col("t"), F.col("n")]))
    return body.unionByName(head).unionByName(dictionary)


def sheet_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.header_rows(sheets.sheet_rows(_cells(spark, sf_dir))).withColumn("score", F.round("score", 6))


SHEET_HEADER_SQL = """
WITH n AS (SELECT 'Nations ' || n_regionkey AS sheet, CAST(n_nationkey // 5 + 1 AS INT) AS row FROM nation),
s AS (SELECT sheet, count(*) AS rows FROM n GROUP BY sheet)
SELECT 'a' AS dataset_id, sheet, 0 AS header_row, 3 + 1 + 1 + 3.0e0 AS score FROM s
UNION ALL SELECT DISTINCT 'b', 'Liste des variables ' || p_brand, 0, 2 + 1 + 1 + 2.0e0 FROM part"""


def sheet_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.sheet_roles(_cells(spark, sf_dir)).select("dataset_id", "sheet", "sheet_role", "header_row", "n_rows", "n_cols")


SHEET_ROLE_SQL = """
SELECT 'a' AS dataset_id, 'Nations ' || n_regionkey AS sheet, 'data' AS sheet_role, 0 AS header_row, count(*) + 1 AS n_rows, 3 AS n_cols FROM nation GROUP BY n_regionkey
UNION ALL SELECT DISTINCT 'b', 'Liste des variables ' || p_brand, 'dictionary', 0, 2, 2 FROM part"""

# --- sources ---------------------------------------------------------------------------------------------------------------


def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k INT").alias("props"), F.struct("event_type", F.struct("value").alias("inner")).alias("event")
    )
    return readers.flatten(nested)


JSON_SQL = """SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS "props.k", event_type AS "event.event_type", value AS "event.inner.value" FROM events"""


def layer_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.union_layers({
        "customer": load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment"),
        "supplier": load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), "s_acctbal"),
    })


LAYER_SQL = """SELECT c_custkey AS id, c_name AS name, c_mktsegment, NULL AS s_acctbal, 'customer' AS src_layer FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, 'supplier' FROM supplier"""


def dialect_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.separator_counts(load(spark, sf_dir, "documents").select("lang", F.col("text").alias("value")), ["lang"])


DIALECT_SQL = r"""
WITH c AS (SELECT lang, sum(length(text) - length(replace(text, ',', ''))) AS a, sum(length(text) - length(replace(text, ';', ''))) AS b,
  sum(length(text) - length(replace(text, chr(9), ''))) AS t, sum(length(text) - length(replace(text, '|', ''))) AS p FROM documents GROUP BY lang)
SELECT lang, CASE WHEN greatest(a, b, t, p) = 0 THEN NULL WHEN a = greatest(a, b, t, p) THEN ',' WHEN b = greatest(a, b, t, p) THEN ';'
  WHEN t = greatest(a, b, t, p) THEN chr(9) ELSE '|' END AS separator, CAST(greatest(a, b, t, p) AS BIGINT) AS n FROM c"""


def column_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by position and by name, with repeats, unknown names and positions out of range."""
    return readers.select_columns(load(spark, sf_dir, "orders"), [0, "o_orderstatus", 3, "nothing", 99, "o_orderkey"])


PROJECTION_SQL = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"

# --- catalog -------------------------------------------------------------------------------------------------------------------


def _old_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").where("o_orderstatus <> 'O'").select(
        catalog.dataset_id(F.concat(F.lit("lake/"), F.col("o_orderkey"))).alias("id"), F.col("o_orderpriority").alias("title"),
        F.col("o_totalprice").cast("long").alias("sourceMtime"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("error").alias("status"),
        F.concat(F.lit("meta/"), F.col("o_orderkey")).alias("metadataPath"), F.concat(F.lit("perf/"), F.col("o_orderkey")).alias("perfPath"),
        F.concat(F.lit("raw/"), F.col("o_orderkey")).alias("rawzonePath"), (F.col("o_custkey") > 100).alias("rawzoneCopied"),
    )


def catalog_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = load(spark, sf_dir, "orders").where("o_orderpriority < '3'").select(
        catalog.dataset_id(F.concat(F.lit("lake/"), F.col("o_orderkey"))).alias("id"), F.lit("new").alias("title"),
        F.lit(0).cast("long").alias("sourceMtime"), F.lit("ok").alias("status"),
    )
    return catalog.upsert(_old_catalog(spark, sf_dir), fresh).select("id", "title", "sourceMtime", "status")


_ID = "substr(sha1('lake/' || o_orderkey), 1, 16)"
UPSERT_SQL = f"""
SELECT {_ID} AS id, CASE WHEN o_orderpriority < '3' THEN 'new' ELSE o_orderpriority END AS title,
  CASE WHEN o_orderpriority < '3' THEN 0 ELSE CAST(trunc(o_totalprice) AS BIGINT) END AS "sourceMtime",
  CASE WHEN o_orderpriority < '3' OR o_orderstatus = 'F' THEN 'ok' ELSE 'error' END AS status
FROM orders WHERE o_orderpriority < '3' OR o_orderstatus <> 'O'"""


def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    files = orders.select(
        F.concat(F.lit("lake/"), F.col("o_orderkey")).alias("path"),
        F.when(F.col("o_custkey") < 700, F.col("o_totalprice").cast("long")).otherwise(0).alias("mtime"), F.col("o_orderkey").cast("string").alias("title"),
    )
    outputs = orders.where("o_orderpriority <> '1-URGENT'").select(
        F.explode(F.array(*[F.concat(F.lit(p), F.col("o_orderkey"), F.lit(s)) for p, s in (("meta/", ""), ("perf/", ""), ("raw/", ""), ("metadata/", ".metadata.json"), ("perf/", ".perf.json"))])).alias("path")
    )
    return catalog.pending(files, _old_catalog(spark, sf_dir), outputs, metadata_dir="metadata", perf_dir="perf").select("path")


PENDING_SQL = """
SELECT 'lake/' || o_orderkey AS path FROM orders WHERE NOT CASE WHEN o_orderstatus = 'O' THEN o_orderpriority <> '1-URGENT'
  ELSE o_custkey < 700 AND o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' AND o_custkey > 100 END"""


def dataset_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select(
        "doc_id", catalog.dataset_id(F.concat_ws("/", F.col("source"), F.col("doc_id"))).alias("id"),
        F.sha2(F.col("text").cast("binary"), 256).alias("checksum"), human_size(F.col("n_chars") * F.col("n_chars") * 1000).alias("size"),
    )


IDS_SQL = """
WITH d AS (SELECT doc_id, source, text, CAST(n_chars AS DOUBLE) * n_chars * 1000 AS b FROM documents)
SELECT doc_id, substr(sha1(source || '/' || doc_id), 1, 16) AS id, sha256(text) AS checksum,
  CASE WHEN b < 1024 THEN printf('%.2f B', b) WHEN b < 1024.0 ** 2 THEN printf('%.2f KB', b / 1024) WHEN b < 1024.0 ** 3 THEN printf('%.2f MB', b / 1024.0 ** 2)
  WHEN b < 1024.0 ** 4 THEN printf('%.2f GB', b / 1024.0 ** 3) WHEN b < 1024.0 ** 5 THEN printf('%.2f TB', b / 1024.0 ** 4) ELSE printf('%.2f PB', b / 1024.0 ** 5) END AS size FROM d"""


def perf_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log entries with some execution times unreadable."""
    log = load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("datasetId"), F.lit("raw").alias("rawzonePath"), F.col("user_id").alias("fileSizeBytes"),
        F.struct((F.col("value") / 2).alias("read_df_sec"), F.col("value").alias("total_sec")).alias("timings"),
        F.when(F.col("event_type") == "error", "never").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("executedAt"),
    )
    return catalog.perf_table(log).select("datasetId", "fileSizeBytes", F.col("executedAt").cast("string").alias("executedAt"), "read_df_sec", "total_sec", "semantic_helper_sec")


PERF_SQL = """SELECT CAST(event_id AS VARCHAR) AS "datasetId", user_id AS "fileSizeBytes", CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "executedAt",
  value / 2 AS read_df_sec, value AS total_sec, CAST(NULL AS DOUBLE) AS semantic_helper_sec FROM events"""

QUERIES = {
    "coordinate_pairs": coordinate_pairs, "spatial_extent": spatial_extent, "extent_union": extent_union, "extent_hull": extent_hull,
    "geometry_extents": geometry_extents, "delimited_records": delimited_records,
    "scope_values": scope_values, "granularity_rollup": granularity_rollup, "scope_rollup": scope_rollup, "theme_set": theme_set,
    "theme_prefix": theme_prefix, "rawzone_path": rawzone_path, "annotation_validity": annotation_validity,
    "backbone_inherit": backbone_inherit, "sheet_header": sheet_header, "sheet_role": sheet_role, "json_flatten": json_flatten,
    "layer_union": layer_union, "dialect_sniff": dialect_sniff, "column_projection": column_projection,
    "catalog_upsert": catalog_upsert, "pending_files": pending_files, "dataset_ids": dataset_ids, "perf_summary": perf_summary,
}
ORACLES = {
    "coordinate_pairs": PAIRS_SQL, "spatial_extent": EXTENT_SQL, "extent_union": UNION_SQL, "extent_hull": HULL_SQL, "geometry_extents": GEOMETRY_EXTENTS_SQL, "delimited_records": DELIMITED_RECORDS_SQL, "scope_values": SCOPE_VALUES_SQL,
    "granularity_rollup": GRANULARITY_SQL, "scope_rollup": SCOPE_SQL, "theme_set": THEME_SET_SQL, "theme_prefix": THEME_PREFIX_SQL,
    "rawzone_path": RAWZONE_SQL, "annotation_validity": VALIDITY_SQL, "backbone_inherit": BACKBONE_SQL, "sheet_header": SHEET_HEADER_SQL,
    "sheet_role": SHEET_ROLE_SQL, "json_flatten": JSON_SQL, "layer_union": LAYER_SQL, "dialect_sniff": DIALECT_SQL,
    "column_projection": PROJECTION_SQL, "catalog_upsert": UPSERT_SQL, "pending_files": PENDING_SQL, "dataset_ids": IDS_SQL,
    "perf_summary": PERF_SQL,
}
