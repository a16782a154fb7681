"""Whole-plan queries: classification, dataset records, catalog entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.operators import annotations as notes
from colonnade.operators import lookups, reference
from colonnade.operators.profile import Profiled, address_columns, profile_tables
from colonnade.plans import classify
from colonnade.plans.catalog import Described, describe_tables
from workload.profiling import CUSTOMER, LINEITEM, ORDERS, PART, TEXT_COLUMNS, _number_sql, _union
from workload.tables import load, load_all, reference_lists

_CLASSIFIED = {"lineitem": LINEITEM, "part": PART, "orders": (*ORDERS, "o_orderdate"), "customer": CUSTOMER}


def _profiled(spark: SparkSession, tables: dict[str, DataFrame]) -> Profiled:
    return profile_tables(spark, tables, address=address_columns(spark, tables))


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.reference_keys(reference_lists(spark, sf_dir))


def attribute_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of the columns of the order tables, from names and values."""
    tables = load_all(spark, sf_dir, tuple(_CLASSIFIED))
    attributes = classify.classify_columns(_profiled(spark, tables), _keys(spark, sf_dir))
    return attributes.select(
        "dataset_id", F.array_join("columns", ",").alias("column"), "role", "granularity", "indicator_type", "subtype",
        "confidence", "value_min", "value_max",
    )


def _stats_sql(table: str, column: str) -> str:
    if column in ("l_shipdate", "o_orderdate"):
        return f"""SELECT '{table}' AS dataset_id, '{column}' AS col, 'time' AS kind, count(*) AS n_rows, count({column}) AS non_null, 0 AS nunique, 0 AS num_count,
        0 AS num_nunique, 0 AS nonzero, 0 AS unit, 0 AS hundred, 0 AS years, NULL AS lo, NULL AS hi, 0 AS avg_len FROM {table}"""
    kind = "text" if column in TEXT_COLUMNS else "number"
    return f"""SELECT '{table}' AS dataset_id, '{column}' AS col, '{kind}' AS kind, count(*) AS n_rows, count({column}) AS non_null, count(DISTINCT {column}) AS nunique,
    count(v) AS num_count, count(DISTINCT v) AS num_nunique, count(CASE WHEN v <> 0 THEN 1 END) AS nonzero, count(CASE WHEN v BETWEEN 0 AND 1 THEN 1 END) AS unit,
    count(CASE WHEN v BETWEEN 0 AND 100 THEN 1 END) AS hundred, count(CASE WHEN trunc(v) BETWEEN 1800 AND 2100 THEN 1 END) AS years, min(v) AS lo, max(v) AS hi,
    avg(length(CAST({column} AS VARCHAR))) AS avg_len FROM (SELECT {column}, {_number_sql(column)} AS v FROM {table})"""


CLASSIFICATION_SQL = f"""
WITH s AS ({_union([_stats_sql(t, c) for t, columns in _CLASSIFIED.items() for c in columns])}),
d AS (SELECT *, CASE WHEN kind = 'time' THEN 'date' WHEN kind = 'number' AND years / non_null >= 0.95 THEN 'year' WHEN nunique / n_rows > 0.9 THEN 'geocode' END AS granularity,
  num_count / non_null >= 0.8 AND num_nunique / non_null < 0.9 AND nonzero / n_rows >= 0.1 AS quant,
  nunique / non_null <= 0.2 AND nunique BETWEEN 2 AND 50 AND avg_len <= 64 AS nominal FROM s),
e AS (SELECT *, CASE WHEN granularity IN ('date', 'year') THEN 'temporal' WHEN granularity = 'geocode' THEN 'spatial' WHEN quant OR nominal THEN 'indicator' ELSE 'other' END AS role,
  CASE WHEN granularity IS NULL AND quant THEN CASE WHEN unit / num_count >= 0.9 THEN 'rate_fraction' WHEN hundred / num_count >= 0.9 THEN 'percentage_like' ELSE 'continuous' END
       WHEN granularity IS NULL AND nominal THEN 'nominal' END AS subtype FROM d)
SELECT dataset_id, col AS "column", role, granularity, CASE WHEN subtype = 'nominal' THEN 'Qualitative' WHEN subtype IS NOT NULL THEN 'Quantitative' END AS indicator_type, subtype,
  CASE WHEN granularity = 'date' THEN 0.8e0 WHEN granularity = 'year' THEN 0.95e0 WHEN granularity = 'geocode' THEN 0.6e0
       WHEN subtype IN ('nominal', 'continuous') THEN 0.9e0 WHEN subtype IS NOT NULL THEN 0.93e0 END AS confidence,
  CASE WHEN subtype <> 'nominal' THEN lo END AS value_min, CASE WHEN subtype <> 'nominal' THEN hi END AS value_max FROM e"""


def _described(spark: SparkSession, sf_dir: str, names: tuple[str, ...] | None = None) -> Described:
    tables = load_all(spark, sf_dir, names) if names else load_all(spark, sf_dir)
    files = spark.createDataFrame(
        [(name, f"{name}.parquet", ".parquet") for name in tables], "dataset_id string, title string, fileType string"
    )
    return describe_tables(spark, tables, files, reference_lists(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per column of every given table with its class, and the granularities of its dataset."""
    described = _described(spark, sf_dir)
    granularities = described.records.select("dataset_id", "spatialGranularity", "temporalGranularity", "nRows")
    return described.attributes.join(granularities, "dataset_id").select(
        "dataset_id", F.array_join("columns", ",").alias("column"), "role", "granularity", "matched_by", "subtype",
        "confidence", "evidence", "spatialGranularity", "temporalGranularity", "nRows",
    )


def annotated_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of columns annotated as places, times and indicators, with a column that mixes levels."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    area = F.when(F.col("c_acctbal") < 0, "France").when(F.col("c_acctbal") < 3000, F.col("r_name")).otherwise(F.col("n_name"))
    customer = (
        load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", area.alias("code_dep_reg"), F.col("r_name").alias("nom_region"), F.lit("France").alias("pays"),
                F.col("c_nationkey").alias("zone"), "c_acctbal", "c_mktsegment")
    )
    tables = {"customer": customer, "orders": load(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice", "o_orderpriority")}
    flags = {
        ("customer", "code_dep_reg"): "spatial", ("customer", "nom_region"): "spatial", ("customer", "pays"): "spatial",
        ("customer", "zone"): "spatial", ("customer", "c_acctbal"): "Quantitative", ("customer", "c_mktsegment"): "Qualitative",
        ("orders", "o_orderdate"): "temporal", ("orders", "o_totalprice"): "Quantitative", ("orders", "o_orderpriority"): "temporal",
    }
    rows = [
        (ds, c, f"{c} of {ds}", k == "spatial", k == "temporal", k[0] == "Q", False, k if k[0] == "Q" else None, None, "given")
        for (ds, c), k in flags.items()
    ]
    from colonnade.operators.annotations import ANNOTATION_SCHEMA

    annotations = spark.createDataFrame(rows, ANNOTATION_SCHEMA)
    attributes, _ = classify.classify_annotated(_profiled(spark, tables), annotations, _keys(spark, sf_dir))
    return attributes.select(
        "dataset_id", F.array_join("columns", ",").alias("column"), "role", "granularity", "matched_by", "confidence",
        "subtype", F.array_join("mixed_levels", ",").alias("mixed_levels"),
    )


ANNOTATED_SQL = """
WITH t AS (SELECT count(*) AS n, count(DISTINCT c_acctbal) / count(*) AS u, count(CASE WHEN c_acctbal <> 0 THEN 1 END) / count(*) AS nz,
    count(CASE WHEN c_acctbal BETWEEN 0 AND 100 THEN 1 END) / count(*) AS h FROM customer),
p AS (SELECT count(DISTINCT o_totalprice) / count(*) AS u FROM orders)
SELECT 'customer' AS dataset_id, 'code_dep_reg' AS "column", 'spatial' AS role, 'departement' AS granularity, 'nom' AS matched_by,
  0.7e0 + 0.3e0 * (SELECT count(*) FROM nation) / (SELECT count(*) + 1 + (SELECT count(*) FROM region) FROM nation) AS confidence, CAST(NULL AS VARCHAR) AS subtype, 'country,region,departement' AS mixed_levels
UNION ALL SELECT 'customer', 'nom_region', 'spatial', 'region', 'nom', 0.99e0, NULL, NULL
UNION ALL SELECT 'customer', 'pays', 'spatial', 'country', NULL, 0.98e0, NULL, NULL
UNION ALL SELECT 'customer', 'zone', 'spatial', 'departement', 'code', 0.99e0, NULL, NULL
UNION ALL SELECT 'customer', 'c_custkey', 'other', NULL, NULL, NULL, NULL, NULL
UNION ALL SELECT 'customer', 'c_acctbal', 'indicator', NULL, NULL, CASE WHEN u < 0.9 AND nz >= 0.1 THEN CASE WHEN h >= 0.9 THEN 0.93e0 ELSE 0.9e0 END ELSE 0.85e0 END, CASE WHEN u < 0.9 AND h >= 0.9 THEN 'percentage_like' ELSE 'continuous' END, NULL FROM t
UNION ALL SELECT 'customer', 'c_mktsegment', 'indicator', NULL, NULL, 0.9e0, 'nominal', NULL
UNION ALL SELECT 'orders', 'o_orderdate', 'temporal', 'date', NULL, 0.8e0, NULL, NULL
UNION ALL SELECT 'orders', 'o_orderpriority', 'other', NULL, NULL, NULL, NULL, NULL
UNION ALL SELECT 'orders', 'o_totalprice', 'indicator', NULL, NULL, CASE WHEN u >= 0.9 THEN 0.85e0 ELSE 0.9e0 END, 'continuous', NULL FROM p"""


def dataset_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scope rows of the tables with periods or places."""
    return _described(spark, sf_dir, ("orders", "lineitem", "events", "nation", "region")).scopes


DATASET_SCOPES_SQL = """
WITH d AS (
  SELECT DISTINCT 'orders' AS k, CAST(o_orderdate AS DATE) AS s FROM orders UNION SELECT 'lineitem', CAST(l_shipdate AS DATE) FROM lineitem
  UNION SELECT 'events', CAST(ts AS DATE) FROM events),
g AS (SELECT k, s, CASE WHEN s = lag(s) OVER (PARTITION BY k ORDER BY s) + 1 THEN 0 ELSE 1 END AS fresh FROM d WHERE s IS NOT NULL),
i AS (SELECT k, s, sum(fresh) OVER (PARTITION BY k ORDER BY s) AS island FROM g)
SELECT k AS dataset_id, 'temporal' AS dim, 'date' AS level, strftime(min(s), '%Y-%m-%d') AS value, strftime(max(s), '%Y-%m-%d') AS end_value FROM i GROUP BY k, island
UNION ALL SELECT DISTINCT 'nation', 'spatial', 'region', CAST(n_regionkey AS VARCHAR), NULL FROM nation
UNION ALL SELECT DISTINCT 'region', 'spatial', 'region', CAST(r_regionkey AS VARCHAR), NULL FROM region"""


def catalog_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset records of all given tables."""
    return _described(spark, sf_dir).records


def code_label_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spatial attributes of line items replaced by a label override, others left."""
    tables = {"lineitem": load(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag")}
    attributes = classify.classify_columns(_profiled(spark, tables), _keys(spark, sf_dir))
    override = spark.createDataFrame(
        [("lineitem", ["SUPPLIER_LABEL"], "spatial", "insee_geo", 0.98, "insee_metadata_sidecar", "l_returnflag", "SUPPLIER_LABEL")],
        "dataset_id string, columns array<string>, role string, granularity string, confidence double, matched_by string, code_column string, label_column string",
    )
    return lookups.merge_overrides(attributes, override).select(
        F.array_join("columns", ",").alias("column"), "role", "granularity", "matched_by"
    )


CODE_LABEL_ATTRIBUTES_SQL = """
SELECT 'SUPPLIER_LABEL' AS "column", 'spatial' AS role, 'insee_geo' AS granularity, 'insee_metadata_sidecar' AS matched_by
UNION ALL SELECT 'l_shipdate', 'temporal', 'date', NULL FROM lineitem HAVING count(l_shipdate) > 0
UNION ALL SELECT 'l_suppkey', 'indicator', NULL, NULL FROM lineitem HAVING count(l_suppkey) > 0
UNION ALL SELECT 'l_linenumber', 'indicator', NULL, NULL FROM lineitem HAVING count(l_linenumber) > 0
UNION ALL SELECT 'l_returnflag', 'indicator', NULL, NULL FROM lineitem HAVING count(l_returnflag) > 0"""


def label_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scopes of customers whose nation codes are explained by code lists: of nations, of several levels, of zones."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    zone, key = F.concat(F.lit("zone "), F.col("n_name")), F.col("n_nationkey")
    lists = {"nations": F.col("n_name"), "levels": F.when(key < 5, F.col("r_name")).when(key < 20, F.col("n_name")).otherwise(zone), "zones": zone}
    tables, rows = {}, []
    for name, label in lists.items():
        sidecar = places.select(F.lit("GEO").alias("COD_VAR"), F.lit("place").alias("LIB_VAR"), key.cast("string").alias("COD_MOD"), label.alias("LIB_MOD"))
        data = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("GEO"), "c_mktsegment", "c_acctbal")
        tables[name], added = lookups.add_code_labels(data, sidecar)
        rows.append((name, "GEO", added))
    files = spark.createDataFrame([(name, f"{name}.csv") for name in tables], "dataset_id string, title string")
    labelled = spark.createDataFrame(rows, "dataset_id string, code_column string, label_column string")
    described = describe_tables(spark, tables, files, reference_lists(spark, sf_dir), labelled=labelled)
    found = described.attributes.where("role = 'spatial' AND array_contains(columns, 'GEO_LABEL')")
    return found.join(described.scopes.where("dim = 'spatial'"), "dataset_id").select(
        "dataset_id", F.array_join("columns", ",").alias("column"), "granularity", "matched_by", F.round("confidence", 9).alias("confidence"),
        F.array_join("mixed_levels", ",").alias("mixed_levels"), "level", "value",
    )


LABEL_SCOPES_SQL = """
WITH c AS (SELECT DISTINCT n_nationkey AS k, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT count(DISTINCT CASE WHEN k < 5 THEN r_name WHEN k < 20 THEN n_name END) / (count(DISTINCT CASE WHEN k < 5 THEN r_name ELSE n_name END)) AS share FROM c)
SELECT 'nations' AS dataset_id, 'GEO_LABEL' AS "column", 'departement' AS granularity, 'insee_metadata_sidecar_label_ref_spatial' AS matched_by, 0.99e0 AS confidence,
  'departement' AS mixed_levels, 'departement' AS level, n_name AS value FROM c
UNION ALL SELECT DISTINCT 'levels', 'GEO_LABEL', 'mixed', 'insee_metadata_sidecar_label_mixed_ref_spatial', round(least(0.99e0, greatest(0.8e0, share)), 9), 'region,departement', 'region', r_name FROM c, m WHERE k < 5
UNION ALL SELECT 'zones', 'GEO_LABEL', 'insee_geo', 'insee_metadata_sidecar', 0.98e0, '', 'insee_geo', 'zone ' || n_name FROM c"""


def series_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of line items by supplier, inherited from line items of the same series where the names agree."""
    lines = load(spark, sf_dir, "lineitem")
    files = spark.createDataFrame([("lines", "lines.parquet", "sales"), ("totals", "totals.parquet", "sales")], "dataset_id string, title string, filename_series_hint string")
    empty = spark.createDataFrame([], notes.BACKBONE_SCHEMA)
    own = lines.select("l_quantity", "l_returnflag", "l_shipdate", "l_linenumber")
    lists = reference_lists(spark, sf_dir)
    first = describe_tables(spark, {"lines": own}, files.where("dataset_id = 'lines'"), lists, backbone=empty)
    totals = lines.groupBy("l_suppkey").agg(
        F.max("l_extendedprice").alias("L_QUANTITY"), F.min("l_shipdate").alias("l_shipdate"), F.count("*").cast("string").alias("l_returnflag")
    )
    second = describe_tables(spark, {"totals": totals}, files.where("dataset_id = 'totals'"), lists, backbone=first.backbone)
    backbone = second.backbone.select(F.lit("backbone").alias("dataset_id"), F.col("column_name_normalized").alias("column"), F.when(F.col("is_spatial"), "spatial")
        .when(F.col("is_temporal"), "temporal").when(F.col("is_indicator"), "indicator").otherwise("other").alias("role"), "indicator_type")
    found = second.attributes.select("dataset_id", F.array_join("columns", ",").alias("column"), "role", "indicator_type", "value_min", "value_max")
    return found.unionByName(backbone, allowMissingColumns=True)


SERIES_CLASSES_SQL = """
WITH t AS (SELECT l_suppkey, max(l_extendedprice) AS q FROM lineitem GROUP BY l_suppkey)
SELECT 'totals' AS dataset_id, 'L_QUANTITY' AS "column", 'indicator' AS role, 'Quantitative' AS indicator_type, min(CAST(q AS DOUBLE)) AS value_min, max(CAST(q AS DOUBLE)) AS value_max FROM t
UNION ALL SELECT 'totals', 'l_shipdate', 'temporal', NULL, NULL, NULL
UNION ALL SELECT 'totals', 'l_returnflag', 'indicator', 'Qualitative', NULL, NULL
UNION ALL SELECT 'totals', 'l_suppkey', 'spatial', NULL, NULL, NULL
UNION ALL SELECT 'backbone', c, CASE c WHEN 'l_shipdate' THEN 'temporal' WHEN 'l_suppkey' THEN 'spatial' ELSE 'indicator' END,
  CASE WHEN c = 'l_returnflag' THEN 'Qualitative' WHEN c IN ('l_quantity', 'l_linenumber') THEN 'Quantitative' END, NULL, NULL
  FROM (SELECT unnest(['l_quantity', 'l_returnflag', 'l_shipdate', 'l_linenumber', 'l_suppkey']) AS c)"""

QUERIES = {
    "attribute_classification": attribute_classification,
    "annotated_classification": annotated_classification,
    "code_label_attributes": code_label_attributes,
    "label_scopes": label_scopes,
    "series_classes": series_classes,
    "dataset_scopes": dataset_scopes,
    "catalog_end_to_end": catalog_end_to_end,
}
ORACLES = {
    "attribute_classification": CLASSIFICATION_SQL,
    "annotated_classification": ANNOTATED_SQL,
    "code_label_attributes": CODE_LABEL_ATTRIBUTES_SQL,
    "label_scopes": LABEL_SCOPES_SQL,
    "series_classes": SERIES_CLASSES_SQL,
    "dataset_scopes": DATASET_SCOPES_SQL,
}
