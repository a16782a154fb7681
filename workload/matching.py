"""Reference matching, lookups and name queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions import names as name_rules
from colonnade.functions.text import code_key, column_key, name_key
from colonnade.operators import lookups, reference
from colonnade.operators.profile import address_parts, compose_address
from workload.tables import load, reference_lists


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts of several key and name columns."""
    parts = [
        load(spark, sf_dir, t).select(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
        for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("lineitem", "l_suppkey"), ("nation", "n_name"),
                     ("region", "r_name"), ("customer", "c_mktsegment"), ("nation", "n_regionkey"))
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.where("v IS NOT NULL").distinct()


_VALUES_SQL = """vals AS (
  SELECT DISTINCT col, v FROM (
    SELECT 'c_nationkey' AS col, CAST(c_nationkey AS VARCHAR) AS v FROM customer UNION ALL
    SELECT 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier UNION ALL
    SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM lineitem UNION ALL
    SELECT 'n_name', n_name FROM nation UNION ALL SELECT 'r_name', r_name FROM region UNION ALL
    SELECT 'c_mktsegment', c_mktsegment FROM customer UNION ALL
    SELECT 'n_regionkey', CAST(n_regionkey AS VARCHAR) FROM nation) WHERE v IS NOT NULL),
refs AS (
  SELECT 'region' AS level, 0 AS pos, CAST(r_regionkey AS VARCHAR) AS code, lower(r_name) AS nom, 1 AS len FROM region UNION ALL
  SELECT 'departement', 2, lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), replace(lower(n_name), '_', ' '), 2 FROM nation),
lens AS (SELECT DISTINCT level, pos, len FROM refs),
hits AS (
  SELECT col, v, lens.level, lens.pos,
    EXISTS (SELECT 1 FROM refs r WHERE r.level = lens.level AND (r.code = upper(trim(v)) OR (NOT regexp_matches(v, '[A-Za-z]')
      AND length(v) <= len AND r.code = lpad(v, len, '0')))) AS by_code,
    EXISTS (SELECT 1 FROM refs r WHERE r.level = lens.level AND r.nom = trim(regexp_replace(lower(v), '[-_ ]+', ' ', 'g'))) AS by_name
  FROM vals, lens)"""


def ref_code_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = reference.reference_keys(reference_lists(spark, sf_dir))
    return reference.level_ratios(_values(spark, sf_dir), keys, ["column"]).select(
        "column", reference.level_name(F.col("level")).alias("level"), "n_values",
        F.round("code_ratio", 6).alias("code_ratio"), F.round("name_ratio", 6).alias("name_ratio"),
    )


REF_CODE_SQL = f"""WITH {_VALUES_SQL}
SELECT col AS "column", level, count(*) AS n_values, round(avg(CAST(by_code AS INT)), 6) AS code_ratio, round(avg(CAST(by_name AS INT)), 6) AS name_ratio
FROM hits GROUP BY col, level HAVING max(CAST(by_code OR by_name AS INT)) = 1"""


def ref_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = reference.reference_keys(reference_lists(spark, sf_dir))
    return reference.best_level(_values(spark, sf_dir), keys, ["column"]).withColumn("ratio", F.round("ratio", 6))


REF_NAME_SQL = f"""WITH {_VALUES_SQL},
ratios AS (SELECT col, level, pos, avg(CAST(by_code AS INT)) AS c, avg(CAST(by_name AS INT)) AS n FROM hits GROUP BY col, level, pos)
SELECT col AS "column", level, CASE WHEN c >= n THEN 'code' ELSE 'nom' END AS "by", round(greatest(c, n), 6) AS ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY col ORDER BY greatest(c, n) DESC, pos) AS rn FROM ratios WHERE greatest(c, n) > 0) WHERE rn = 1"""


def mixed_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column with region names, nation names and codes, and the country; another with nations only."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    customer = load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    area = (
        F.when(F.col("c_acctbal") < 0, "France").when(F.col("c_acctbal") < 3000, F.col("r_name"))
        .when(F.col("c_acctbal") < 6000, F.col("n_name")).otherwise(F.col("c_nationkey").cast("string"))
    )
    rows = customer.select(F.lit("area").alias("column"), area.alias("v")).unionByName(
        customer.select(F.lit("nation").alias("column"), F.col("n_name").alias("v"))
    ).distinct()
    keys = reference.reference_keys(reference_lists(spark, sf_dir))
    levels = reference.value_levels(rows, keys, ["column"])
    return reference.mixed_levels(levels, ["column"]).select(
        "column", "level", "value", "most_specific", F.array_join("mixed_levels", ",").alias("levels")
    )


MIXED_SQL = """
WITH c AS (SELECT DISTINCT CASE WHEN c_acctbal < 0 THEN 'France' WHEN c_acctbal < 3000 THEN r_name WHEN c_acctbal < 6000 THEN n_name
    ELSE CAST(c_nationkey AS VARCHAR) END AS v
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT DISTINCT CASE WHEN v = 'France' THEN 'country' WHEN v IN (SELECT r_name FROM region) THEN 'region' ELSE 'departement' END AS level,
  CASE WHEN regexp_full_match(v, '[0-9]+') THEN lpad(v, 2, '0') ELSE v END AS value FROM c),
l AS (SELECT string_agg(level, ',' ORDER BY level) FILTER (level <> 'region') AS two, count(DISTINCT level) AS n FROM (SELECT DISTINCT level FROM m))
SELECT 'area' AS "column", level, value, 'departement' AS most_specific, 'country,region,departement' AS levels FROM m, l WHERE n = 3"""


def label_mixed_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels matched by name only, with the labels no level knows."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    segments = load(spark, sf_dir, "customer").select("c_mktsegment")
    labels = nation.select(F.col("n_name").alias("v")).union(region.select("r_name")).union(segments).distinct()
    keys = reference.reference_keys(reference_lists(spark, sf_dir))
    rows = labels.withColumn("column", F.lit("label"))
    found = reference.value_levels(rows, keys, ["column"], by="nom")
    return rows.join(found, ["column", "v"], "left").select(F.col("v").alias("label"), F.coalesce("level", F.lit("unmatched")).alias("level"))


LABEL_MIXED_SQL = """
SELECT DISTINCT n_name AS label, 'departement' AS level FROM nation UNION ALL SELECT DISTINCT r_name, 'region' FROM region
UNION ALL SELECT DISTINCT c_mktsegment, 'unmatched' FROM customer WHERE c_mktsegment NOT IN (SELECT r_name FROM region)"""


def code_label_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier names as labels of the supplier codes of line items."""
    supplier = load(spark, sf_dir, "supplier").select(
        F.lit("GEO").alias("COD_VAR"), F.lit("Supplier").alias("LIB_VAR"),
        F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("COD_MOD"), F.col("s_name").alias("LIB_MOD"),
    )
    data = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("GEO"), "l_quantity", "l_linenumber")
    labelled = lookups.label_codes(data, lookups.label_map(supplier), "GEO")
    return labelled.groupBy("GEO", "GEO_LABEL").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


CODE_LABEL_SQL = """SELECT l_suppkey AS "GEO", coalesce(s_name, '') AS "GEO_LABEL", count(*) AS n, sum(l_quantity) AS quantity
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL"""


def code_label_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of user codes that have a label; only the codes of nations are labelled."""
    nation = load(spark, sf_dir, "nation").select(
        F.lit("GEO").alias("COD_VAR"), F.col("n_nationkey").cast("string").alias("COD_MOD"), F.col("n_name").alias("LIB_MOD")
    )
    events = load(spark, sf_dir, "events").select(F.col("user_id").alias("GEO"))
    share = lookups.label_coverage(events, lookups.label_map(nation), "GEO")
    return share.select("n_codes", "n_matched", F.round("coverage", 6).alias("coverage"), "enough")


COVERAGE_SQL = """SELECT count(*) AS n_codes, count(n_nationkey) AS n_matched, round(count(n_nationkey) / count(*), 6) AS coverage,
  count(n_nationkey) / count(*) >= 0.8 AS enough FROM (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL) LEFT JOIN nation ON user_id = n_nationkey"""


def names_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of any length, the pieces between the punctuation of the whole benchmark texts, found in whole documents."""
    pieces = F.explode(F.split(F.col("text"), r"[.,;:!?\r\n]+"))
    names = load(spark, sf_dir, "benchmark").select(
        F.lit("com").alias("level"), F.lit(0).alias("level_rank"), F.lit(None).cast("string").alias("code"), pieces.alias("nom"),
    )
    return reference.names_in_text(load(spark, sf_dir, "documents"), names, key="doc_id", text="text").select(
        "doc_id", "level", "by", "value"
    )


NAMES_SQL = r"""
WITH p AS (SELECT unnest(regexp_split_to_array(text, '[.,;:!?\r\n]+')) AS piece FROM benchmark),
n AS (SELECT DISTINCT trim(regexp_replace(lower(strip_accents(piece)), '[\s\-_]+', ' ', 'g')) AS nm FROM p),
d AS (SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[\s\-_]+', '_', 'g'), '_') AS t FROM documents),
h AS (SELECT doc_id, ' ' || t || ' ' || trim(regexp_replace(t, '[^a-z0-9]+', ' ', 'g')) || ' ' AS hay FROM d)
SELECT doc_id, 'com' AS level, 'nom' AS "by", nm AS value FROM h, n
WHERE length(nm) >= 4 AND (contains(hay, ' ' || nm || ' ') OR contains(hay, '_' || nm || '_'))"""


def name_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the normal forms of whole texts and addresses."""
    texts = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), "text").unionByName(
        load(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit("url").alias("kind"), F.col("url").alias("text"))
    )
    return texts.select(
        "id", "kind", F.md5(column_key(F.col("text"))).alias("column_key"), F.md5(name_key(F.col("text"))).alias("name_key"),
        F.md5(code_key(F.col("text"))).alias("code_key"),
    )


NAME_NORMALIZATION_SQL = r"""
WITH t AS (SELECT doc_id AS id, 'document' AS kind, text FROM documents UNION ALL SELECT page_id, 'url', url FROM pages)
SELECT id, kind, md5(trim(regexp_replace(lower(strip_accents(text)), '[\s\-_]+', '_', 'g'), '_')) AS column_key,
  md5(trim(regexp_replace(replace(replace(lower(strip_accents(text)), '’', ''''), '`', ''''), '[\s\-_]+', ' ', 'g'))) AS name_key,
  md5(upper(replace(regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', ''), 'ß', 'SS'))) AS code_key FROM t"""


def name_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-name rules applied to names made of the words of the benchmark texts and the nations."""
    words = load(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).where("w <> ''").distinct()
    prefixes = F.array(*[F.lit(p) for p in ("", "code_", "nom region ", "Taux-", "insee_dep_", "geo_", "pct ", "the_geom ", "WKT-")])
    named = words.select(F.explode(F.transform(prefixes, lambda p: F.concat(p, F.col("w")))).alias("name"))
    key = column_key(F.col("name"))
    return named.select(
        "name", F.array_join(name_rules.level_hits(key), ",").alias("levels"),
        F.array_join(name_rules.level_hits(key, strict=True), ",").alias("strict_levels"),
        name_rules.gate_source(key).alias("source"), name_rules.is_generic_geo_name(key).alias("generic"),
        name_rules.measure_hint(key, "is_rate").alias("is_rate"), name_rules.geo_format(key, "geometry").alias("geometry"),
        name_rules.geo_format(key, "wkt").alias("wkt"), name_rules.is_country_name(key).alias("is_country"),
    )


def _gates_sql() -> str:
    from colonnade.functions import fixed

    def arrays(strict: bool) -> str:
        cases = []
        for level, parts in fixed.SPATIAL_NAME_WORDS.items():
            body = "(?:" + "|".join(parts) + ")"
            cases.append(f"CASE WHEN regexp_matches(k, '{chr(92)}b{body}{chr(92)}b') THEN '{level}' END" if strict else f"CASE WHEN regexp_matches(k, '{body}') THEN '{level}' END")
        return f"array_to_string(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL), ',')"

    return rf"""
WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM benchmark),
n AS (SELECT p || w AS name FROM w, (SELECT unnest(['', 'code_', 'nom region ', 'Taux-', 'insee_dep_', 'geo_', 'pct ', 'the_geom ', 'WKT-']) AS p) WHERE w <> ''),
k AS (SELECT name, trim(regexp_replace(lower(strip_accents(name)), '[\s\-_]+', '_', 'g'), '_') AS k FROM n),
g AS (SELECT name, k, {arrays(False)} AS levels, {arrays(True)} AS strict_levels, regexp_matches(k, '{fixed.SPATIAL_GENERIC_PATTERN}') AS generic FROM k)
SELECT name, levels, strict_levels, CASE WHEN levels <> '' AND contains(k, 'insee') THEN 'insee' WHEN levels <> '' AND contains(k, 'code') THEN 'code'
    WHEN levels <> '' THEN 'alias' WHEN generic THEN 'generic' END AS source, generic,
  regexp_matches(k, '{fixed.MEASURE_NAME_PATTERNS['is_rate']}') AS is_rate, regexp_matches(k, '{fixed.GEO_FORMAT_PATTERNS['geometry']}') AS geometry,
  regexp_matches(k, '{fixed.GEO_FORMAT_PATTERNS['wkt']}') AS wkt,
  k IN ('country', 'pays', 'nation', 'etat', 'state', 'territoire_national') OR len(list_intersect(string_split(k, '_'), ['country', 'pays', 'nation'])) > 0 AS is_country
FROM g"""


_ADDRESS_NAMES = ("NumVoie", "indrep", "type voie", "Nom-Voie", "Bâtiment", "escalier", "CP", "Ville", "adresse_2", "rue", "etage", "c_name")


def address_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address roles of column names assigned to nations."""
    names = F.array(*[F.lit(n) for n in _ADDRESS_NAMES])
    columns = load(spark, sf_dir, "nation").select(
        F.col("n_name").alias("dataset_id"), F.get(names, F.pmod(F.col("n_nationkey"), F.lit(len(_ADDRESS_NAMES)))).alias("column"),
        F.col("n_nationkey").alias("col_pos"),
    )
    return address_parts(columns, include_city=True).select("dataset_id", "column", "role")


_ROLES = {"NumVoie": "house_number", "indrep": "repetition_index", "type voie": "way_type", "Nom-Voie": "way_name", "Bâtiment": "building",
          "escalier": "stair", "CP": "postal_code", "Ville": "city", "adresse_2": "address_line", "etage": "floor"}
ADDRESS_COLUMNS_SQL = f"""
SELECT n_name AS dataset_id, c AS "column", r AS role FROM nation JOIN (VALUES {', '.join(f"({_ADDRESS_NAMES.index(n)}, '{n}', '{r}')" for n, r in _ROLES.items())}) v(i, c, r)
ON n_nationkey % {len(_ADDRESS_NAMES)} = i"""


def composed_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses composed from parts with missing and blank pieces."""
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")).alias("numvoie"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("  rue  de "), F.col("c_mktsegment"), F.lit(" "))).alias("nomvoie"),
        F.when(F.col("c_acctbal") > 5000, F.lit("BIS")).alias("indrep"),
    )
    return compose_address(customer, ["numvoie", "indrep", "nomvoie"]).withColumnRenamed("__address__", "address")


COMPOSED_SQL = r"""
SELECT c_custkey, nullif(trim(regexp_replace(coalesce(CASE WHEN c_nationkey < 20 THEN CAST(c_nationkey AS VARCHAR) END, '') || ' ' ||
  coalesce(CASE WHEN c_acctbal > 5000 THEN 'BIS' END, '') || ' ' ||
  coalesce(CASE WHEN c_acctbal > 0 THEN '  rue  de ' || c_mktsegment || ' ' END, ''), '\s+', ' ', 'g')), '') AS address FROM customer"""


def registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of the documents, of which only those with many documents are registered."""
    documents = load(spark, sf_dir, "documents")
    registry = documents.groupBy("source").agg(F.count("*").alias("n"), F.max("lang").alias("lang")).select(
        F.concat(F.col("source"), F.lit(" ")).alias("file_name"),
        F.concat(F.lit("lake/"), F.col("source")).alias("sourceAddress"),
        F.when(F.col("lang") == "fr", "").otherwise(F.upper("source")).alias("sourceName"),
        F.when(F.col("n") > 40, "portal").alias("sourceType"), F.lit("").alias("filename_series_hint"),
    ).where("sourceAddress LIKE 'lake/src1%'")
    files = documents.select("doc_id", F.col("source").alias("file_name"))
    return lookups.source_lookup(files, registry)


REGISTRY_SQL = """
WITH r AS (SELECT source, count(*) AS n, max(lang) AS lang FROM documents WHERE source LIKE 'src1%' GROUP BY source)
SELECT doc_id, d.source AS file_name, CASE WHEN r.source IS NULL THEN '' ELSE 'lake/' || r.source END AS "sourceAddress",
  coalesce(CASE WHEN r.lang = 'fr' THEN NULL ELSE upper(r.source) END, d.source) AS "sourceName",
  CASE WHEN r.source IS NULL THEN 'local' WHEN n > 40 THEN 'portal' ELSE 'external_source' END AS "sourceType", '' AS filename_series_hint
FROM documents d LEFT JOIN r ON d.source = r.source"""

QUERIES = {
    "ref_code_match": ref_code_match,
    "ref_name_match": ref_name_match,
    "mixed_levels": mixed_levels,
    "label_mixed_match": label_mixed_match,
    "code_label_enrichment": code_label_enrichment,
    "code_label_coverage": code_label_coverage,
    "names_in_text": names_in_text,
    "name_normalization": name_normalization,
    "name_gates": name_gates,
    "address_columns": address_columns,
    "composed_addresses": composed_addresses,
    "registry_lookup": registry_lookup,
}
ORACLES = {
    "ref_code_match": REF_CODE_SQL,
    "ref_name_match": REF_NAME_SQL,
    "mixed_levels": MIXED_SQL,
    "label_mixed_match": LABEL_MIXED_SQL,
    "code_label_enrichment": CODE_LABEL_SQL,
    "code_label_coverage": COVERAGE_SQL,
    "names_in_text": NAMES_SQL,
    "name_normalization": NAME_NORMALIZATION_SQL,
    "name_gates": _gates_sql(),
    "address_columns": ADDRESS_COLUMNS_SQL,
    "composed_addresses": COMPOSED_SQL,
    "registry_lookup": REGISTRY_SQL,
}
