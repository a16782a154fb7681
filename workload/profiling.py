"""Column profile and detector queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.operators import detect
from colonnade.operators.profile import column_profile, profile_columns, profile_tables, scan_tables
from workload.tables import load

LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)
CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
TEXT_COLUMNS = {"p_name", "p_brand", "p_type", "o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus", "c_name", "c_mktsegment", "props", "source", "lang", "role", "event_type", "url"}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _profile(table: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profile_columns(spark, {table: load(spark, sf_dir, table)}, ["sum_len"]).select(
            "column", "n_rows", "non_null", "nunique", F.round("not_null_ratio", 6).alias("not_null_ratio"),
            F.round("nunique_ratio", 6).alias("nunique_ratio"), F.round("avg_len", 4).alias("avg_len"),
        )

    return query


def _profile_sql(table: str, columns: tuple[str, ...]) -> str:
    return _union([
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count({c}) AS non_null, count(DISTINCT {c}) AS nunique,
        round(count({c}) / count(*), 6) AS not_null_ratio, round(count(DISTINCT {c}) / count({c}), 6) AS nunique_ratio,
        round(avg(length(CAST({c} AS VARCHAR))), 4) AS avg_len FROM {table}"""
        for c in columns
    ])


def _number_sql(column: str) -> str:
    if column not in TEXT_COLUMNS:
        return f"CAST({column} AS DOUBLE)"
    bare = f"regexp_replace({column}, '[€$£¥]|(eur|usd|gbp|cny|rmb)', '', 'gi')"
    return f"TRY_CAST(replace(regexp_replace({bare}, '[^0-9\\-,\\.]', '', 'g'), ',', '.') AS DOUBLE)"


COERCED = {
    "customer": ("c_name", "c_acctbal", "c_mktsegment"), "part": ("p_name", "p_brand", "p_type"),
    "lineitem": ("l_returnflag", "l_discount"), "events": ("props", "event_type"), "documents": ("source", "lang"),
    "pages": ("url",),
}


def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: load(spark, sf_dir, t).select(*columns) for t, columns in COERCED.items()}
    return profile_columns(spark, tables, ["num_count", "num_nunique", "num_min", "num_max"]).select(
        "column", "non_null", "num_count", "num_nunique", "num_min", "num_max",
        F.round(F.col("num_count") / F.col("non_null"), 6).alias("numeric_ratio"),
    )


NUMERIC_COERCION_SQL = _union([
    f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(v) AS num_count, count(DISTINCT v) AS num_nunique,
    min(v) AS num_min, max(v) AS num_max, round(count(v) / count({c}), 6) AS numeric_ratio
    FROM (SELECT {c}, {_number_sql(c)} AS v FROM {t})"""
    for t, columns in COERCED.items() for c in columns
])

QUANT_TABLES = {"lineitem": LINEITEM[:-1], "part": PART, "orders": ORDERS}


def quantitative_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: load(spark, sf_dir, t).select(*columns) for t, columns in QUANT_TABLES.items()}
    profile = profile_columns(spark, tables, detect.QUANTITATIVE_MEASURES)
    return detect.with_quantitative(profile).where("quant IS NOT NULL").select(
        "dataset_id", "column", "quant.subtype", "quant.confidence", "quant.evidence",
        F.col("quant.min").alias("value_min"), F.col("quant.max").alias("value_max"), "quant.nunique",
        "quant.suggested_dtype", F.round(F.col("quant.nunique") / F.col("non_null"), 6).alias("nunique_ratio"),
    )


_QUANT_STATS = _union([
    f"""SELECT '{t}' AS dataset_id, '{c}' AS col, count(*) AS n_rows, count({c}) AS non_null, count(v) AS num_count,
    count(DISTINCT v) AS nunique, count(CASE WHEN v <> 0 THEN 1 END) AS nonzero,
    count(CASE WHEN v BETWEEN 0 AND 1 THEN 1 END) AS unit, count(CASE WHEN v BETWEEN 0 AND 100 THEN 1 END) AS hundred,
    min(v) AS value_min, max(v) AS value_max FROM (SELECT {c}, {_number_sql(c)} AS v FROM {t})"""
    for t, columns in QUANT_TABLES.items() for c in columns
])
QUANTITATIVE_SQL = f"""
WITH stats AS ({_QUANT_STATS}),
kept AS (
  SELECT *, CASE WHEN unit / num_count >= 0.9 THEN 'rate_fraction' WHEN hundred / num_count >= 0.9 THEN 'percentage_like'
            ELSE 'continuous' END AS subtype
  FROM stats WHERE num_count / non_null >= 0.8 AND nunique / non_null < 0.9 AND nonzero / n_rows >= 0.1)
SELECT dataset_id, col AS "column", subtype, CASE WHEN subtype = 'continuous' THEN 0.9e0 ELSE 0.93e0 END AS confidence,
  CASE subtype WHEN 'rate_fraction' THEN 'values mostly in [0,1]' WHEN 'percentage_like' THEN 'values mostly in [0,100]'
  ELSE 'numeric coercion passed' END AS evidence, value_min, value_max, nunique, 'float' AS suggested_dtype,
  round(nunique / non_null, 6) AS nunique_ratio
FROM kept"""

BOOLEAN_COLUMNS = {
    "labels": ("quality", "toxic"), "lineitem": ("l_linestatus", "l_returnflag", "l_linenumber"),
    "customer": ("c_mktsegment",), "conversations": ("turn", "role"),
}
_WORDS = "'true','false','yes','no','y','n','1','0','oui','non','vrai','faux','t','f'"


def boolean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: load(spark, sf_dir, t).select(*columns) for t, columns in BOOLEAN_COLUMNS.items()}
    return profile_columns(spark, tables, ["boolean_word"]).select(
        "column", "non_null", "boolean_word", detect.is_boolean().alias("is_boolean")
    )


BOOLEAN_SQL = _union([
    f"""SELECT '{c}' AS "column", count({c}) AS non_null,
    count(CASE WHEN lower(trim(CAST({c} AS VARCHAR))) IN ({_WORDS}) THEN 1 END) AS boolean_word,
    count(CASE WHEN lower(trim(CAST({c} AS VARCHAR))) IN ({_WORDS}) THEN 1 END) / count({c}) >= 0.95 AS is_boolean FROM {t}"""
    for t, columns in BOOLEAN_COLUMNS.items() for c in columns
])

LIKERT_COLUMNS = {
    "lineitem": ("l_linenumber", "l_quantity", "l_discount", "l_returnflag"), "labels": ("quality",),
    "conversations": ("turn", "text"), "part": ("p_size", "p_type"), "nation": ("n_regionkey",), "documents": ("text",),
}
_LIKERT_TEXT = {"l_returnflag", "text", "p_type"}


def likert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: load(spark, sf_dir, t).select(*columns) for t, columns in LIKERT_COLUMNS.items()}
    measures = ["plain_count", "likert_min", "likert_max", "likert_bits", "likert_word"]
    return profile_columns(spark, tables, measures).select(
        "dataset_id", "column", "non_null", "plain_count", "likert_word", detect.likert_pattern().alias("pattern")
    )


def _likert_sql(table: str, column: str) -> str:
    number = "CAST(NULL AS DOUBLE)" if column == "text" else f"TRY_CAST({column} AS DOUBLE)"
    words = "(" + " OR ".join(f"contains(lower({column}), '{w}')" for w in ("agree", "neutral", "d''accord")) + ")"
    words = words if column in _LIKERT_TEXT else "FALSE"
    return f"""SELECT '{table}' AS dataset_id, '{column}' AS "column", count({column}) AS non_null, count(v) AS plain_count,
    count(CASE WHEN {words} THEN 1 END) AS likert_word,
    CASE WHEN count(v) / count({column}) >= 0.95 AND min(trunc(v)) >= 1 AND max(trunc(v)) <= 5 AND count(DISTINCT trunc(v)) >= 2 THEN '1..5 ordinal'
         WHEN count(v) / count({column}) >= 0.95 AND min(trunc(v)) >= 1 AND max(trunc(v)) <= 7 AND count(DISTINCT trunc(v)) >= 2 THEN '1..7 ordinal'
         WHEN count(CASE WHEN {words} THEN 1 END) / count({column}) >= 0.6 THEN 'likert_keywords' END AS pattern
    FROM (SELECT {column}, {number} AS v FROM {table})"""


LIKERT_SQL = _union([_likert_sql(t, c) for t, columns in LIKERT_COLUMNS.items() for c in columns])

NOMINAL_COLUMNS = {
    "part": ("p_name", "p_brand", "p_type", "p_size"), "orders": ("o_orderpriority", "o_orderstatus"),
    "events": ("event_type", "props"), "documents": ("lang", "source"), "conversations": ("role",),
    "customer": ("c_mktsegment", "c_name"), "lineitem": ("l_returnflag", "l_suppkey"),
}


def nominal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: load(spark, sf_dir, t).select(*columns) for t, columns in NOMINAL_COLUMNS.items()}
    profiled = profile_tables(spark, tables, measures=["sum_len"])
    profile = column_profile(profiled, ["sum_len"]).withColumn("is_nominal", detect.is_nominal())
    wanted = profile.where("is_nominal").select("cid", F.lit(False).alias("lowered"), F.lit(20).alias("k"))
    samples = detect.category_samples(profiled.texts_of(wanted), wanted)
    return profile.join(samples, "cid", "left").select(
        "column", "nunique", "is_nominal", F.round("avg_len", 4).alias("avg_len"),
        F.array_join("categories_sample", "|").alias("categories"),
    )


NOMINAL_SQL = _union([
    f"""SELECT '{c}' AS "column", nunique, is_nominal, avg_len, CASE WHEN is_nominal THEN (
      SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT trim(CAST({c} AS VARCHAR)) AS x FROM {t}
        WHERE {c} IS NOT NULL ORDER BY x LIMIT 20)) END AS categories
    FROM (SELECT count(DISTINCT {c}) AS nunique, round(avg(length(CAST({c} AS VARCHAR))), 4) AS avg_len,
      count(DISTINCT {c}) / count({c}) <= 0.2 AND count(DISTINCT {c}) BETWEEN 2 AND 50
      AND avg(length(CAST({c} AS VARCHAR))) <= 64 AS is_nominal FROM {t})"""
    for t, columns in NOMINAL_COLUMNS.items() for c in columns
])

QUAL_TABLES = {"labels": ("quality",), "lineitem": ("l_linenumber", "l_returnflag", "l_suppkey"), "orders": ("o_orderpriority",), "part": ("p_name",)}


def indicator_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of columns annotated by their storage: numbers as quantitative, text as qualitative."""
    tables = {t: load(spark, sf_dir, t).select(*columns) for t, columns in QUAL_TABLES.items()}
    measures = {*detect.QUANTITATIVE_MEASURES, *detect.QUALITATIVE_MEASURES, "plain_min", "plain_max", "plain_mean"}
    profile = profile_columns(spark, tables, measures)
    detected = detect.with_qualitative(detect.with_quantitative(profile)).withColumn(
        "indicator_type", F.when(F.col("kind") == "text", "Qualitative").otherwise("Quantitative")
    )
    entry = F.when(F.col("kind") == "text", F.col("qual_entry")).otherwise(F.col("quant_entry"))
    return detect.with_entries(detected).withColumn("entry", entry).select(
        "column", "entry.indicator_type", "entry.subtype", "entry.confidence",
        F.col("entry.min").alias("value_min"), F.col("entry.max").alias("value_max"),
    )


INDICATOR_ENTRIES_SQL = """
SELECT * FROM (
  SELECT 'quality' AS "column", 'Quantitative' AS indicator_type,
    CASE WHEN count(DISTINCT quality) / count(quality) < 0.9 AND count(CASE WHEN quality <> 0 THEN 1 END) / count(*) >= 0.1
      THEN 'rate_fraction' ELSE 'continuous' END AS subtype,
    CASE WHEN count(CASE WHEN quality <> 0 THEN 1 END) / count(*) >= 0.1 THEN 0.93e0 ELSE 0.85e0 END AS confidence,
    CAST(min(quality) AS DOUBLE) AS value_min, CAST(max(quality) AS DOUBLE) AS value_max FROM labels
  UNION ALL
  SELECT 'l_linenumber', 'Quantitative', 'percentage_like', 0.93e0, min(l_linenumber), max(l_linenumber) FROM lineitem
  UNION ALL
  SELECT 'l_suppkey', 'Quantitative',
    CASE WHEN count(CASE WHEN l_suppkey <= 100 THEN 1 END) / count(*) >= 0.9 THEN 'percentage_like' ELSE 'continuous' END,
    CASE WHEN count(CASE WHEN l_suppkey <= 100 THEN 1 END) / count(*) >= 0.9 THEN 0.93e0 ELSE 0.9e0 END,
    min(l_suppkey), max(l_suppkey) FROM lineitem
  UNION ALL
  SELECT 'l_returnflag', 'Qualitative', 'nominal', 0.9e0, NULL, NULL FROM lineitem HAVING count(DISTINCT l_returnflag) BETWEEN 2 AND 50
  UNION ALL
  SELECT 'o_orderpriority', 'Qualitative', 'nominal', 0.9e0, NULL, NULL FROM orders HAVING count(DISTINCT o_orderpriority) BETWEEN 2 AND 50
  UNION ALL
  SELECT 'p_name', 'Qualitative', CASE WHEN count(DISTINCT p_name) <= 50 AND count(DISTINCT p_name) / count(*) <= 0.2 THEN 'nominal' END,
    CASE WHEN count(DISTINCT p_name) <= 50 AND count(DISTINCT p_name) / count(*) <= 0.2 THEN 0.9e0 ELSE 0.8e0 END, NULL, NULL FROM part)"""


def temporal_granularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    derived = load(spark, sf_dir, "orders").select(
        "o_orderdate",
        F.date_format(day, "yyyy-MM").alias("month_text"),
        (F.year(day) * 100 + F.month(day)).alias("month_number"),
        F.concat(F.year(day), F.lit("-Q"), F.quarter(day)).alias("quarter_text"),
        F.year(day).alias("year_number"),
        F.year(day).cast("string").alias("year_text"),
        F.format_string("%04d-W%02d", F.year(day), F.weekofyear(day)).alias("week_text"),
        F.date_trunc("month", day).alias("month_start"),
        F.date_trunc("year", day).alias("year_start"),
        F.date_trunc("week", day).alias("week_start"),
        F.date_format(day, "yyyy-MM-dd").alias("day_text"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("stamp_text"),
        "o_orderpriority", "o_custkey",
    )
    tables = {
        "orders": derived, "lineitem": load(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey"),
        "events": load(spark, sf_dir, "events").select("ts", "event_type"),
    }
    profile = profile_columns(spark, tables, detect.TEMPORAL_MEASURES)
    return detect.with_temporal(profile).select("column", "temporal.granularity", "temporal.confidence")


def _time_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column",
    CASE WHEN avg(CASE WHEN month({column}) = 1 AND day({column}) = 1 THEN 1 ELSE 0 END) >= 0.95 THEN 'year'
         WHEN avg(CASE WHEN day({column}) = 1 THEN 1 ELSE 0 END) >= 0.95 THEN 'month'
         WHEN avg(CASE WHEN isodow({column}) = 1 THEN 1 ELSE 0 END) >= 0.95 THEN 'week' ELSE 'date' END AS granularity,
    CASE WHEN avg(CASE WHEN day({column}) = 1 THEN 1 ELSE 0 END) >= 0.95 THEN 0.95e0 ELSE 0.8e0 END AS confidence FROM {source}"""


def _pattern_sql(source: str, column: str) -> str:
    def share(pattern: str) -> str:
        return f"avg(CASE WHEN regexp_full_match({column}, '{pattern}') THEN 1 ELSE 0 END)"

    stamp = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?"
    return f"""SELECT '{column}' AS "column",
    CASE WHEN {share(stamp)} >= 0.9 THEN 'date' WHEN {share(r'\d{4}-\d{2}')} >= 0.9 THEN 'month' WHEN {share(r'\d{4}')} >= 0.9 THEN 'year'
    WHEN {share(r'\d{4}-W\d{2}')} >= 0.8 THEN 'week' WHEN {share(r'\d{4}-?Q[1-4]')} >= 0.8 THEN 'quarter' END AS granularity,
    CASE WHEN {share(stamp)} >= 0.9 OR {share(r'\d{4}-\d{2}')} >= 0.9 OR {share(r'\d{4}')} >= 0.9 THEN 0.95e0
    WHEN {share(r'\d{4}-W\d{2}')} >= 0.8 OR {share(r'\d{4}-?Q[1-4]')} >= 0.8 THEN 0.9e0 END AS confidence FROM {source}"""


def _number_time_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column",
    CASE WHEN avg(CASE WHEN {column} BETWEEN 1800 AND 2100 THEN 1 ELSE 0 END) >= 0.95 THEN 'year'
    WHEN avg(CASE WHEN {column} BETWEEN 180001 AND 210012 THEN 1 ELSE 0 END) >= 0.95
      AND avg(CASE WHEN {column} % 100 BETWEEN 1 AND 12 THEN 1 ELSE 0 END) >= 0.95 THEN 'month' END AS granularity,
    CASE WHEN avg(CASE WHEN {column} BETWEEN 1800 AND 2100 THEN 1 ELSE 0 END) >= 0.95 THEN 0.95e0
    WHEN avg(CASE WHEN {column} BETWEEN 180001 AND 210012 THEN 1 ELSE 0 END) >= 0.95
      AND avg(CASE WHEN {column} % 100 BETWEEN 1 AND 12 THEN 1 ELSE 0 END) >= 0.95 THEN 0.9e0 END AS confidence FROM {source}"""


TEMPORAL_SQL = """WITH d AS (SELECT o_orderdate, strftime(o_orderdate, '%Y-%m') AS month_text,
  year(o_orderdate) * 100 + month(o_orderdate) AS month_number, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter_text,
  year(o_orderdate) AS year_number, CAST(year(o_orderdate) AS VARCHAR) AS year_text,
  printf('%04d-W%02d', year(o_orderdate), week(o_orderdate)) AS week_text, date_trunc('month', o_orderdate) AS month_start,
  date_trunc('year', o_orderdate) AS year_start, date_trunc('week', o_orderdate) AS week_start,
  strftime(o_orderdate, '%Y-%m-%d') AS day_text, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp_text, o_orderpriority, o_custkey
  FROM orders)
""" + _union(
    [_time_sql("d", c) for c in ("o_orderdate", "month_start", "year_start", "week_start")]
    + [_time_sql("lineitem", "l_shipdate"), _time_sql("events", "ts")]
    + [_pattern_sql("d", c) for c in ("month_text", "quarter_text", "year_text", "week_text", "day_text", "stamp_text", "o_orderpriority")]
    + [_pattern_sql("events", "event_type")]
    + [_number_time_sql("d", c) for c in ("month_number", "year_number", "o_custkey")]
    + [_number_time_sql("lineitem", "l_orderkey")]
)


def value_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address, geometry-text and binary-geometry shares of texts and of geometries derived from keys."""
    point = F.concat(F.lit("POINT ("), F.col("s_suppkey"), F.lit(" "), F.col("s_nationkey"), F.lit(")"))
    shapes = load(spark, sf_dir, "supplier").select(
        F.when(F.col("s_nationkey") < 20, point).otherwise(F.col("s_name")).alias("wkt"),
        F.concat(F.lit('{"type":"Point","coordinates":['), F.col("s_suppkey"), F.lit(",1]}")).alias("geojson"),
        F.concat(F.lpad(F.col("s_nationkey").cast("string"), 2, "0"), F.lit("01000000"), F.repeat(F.lit("00"), 16)).alias("wkb_hex"),
    )
    tables = {
        "documents": load(spark, sf_dir, "documents").select(F.col("text").alias("document_text")),
        "conversations": load(spark, sf_dir, "conversations").select(F.col("text").alias("conversation_text")),
        "pages": load(spark, sf_dir, "pages").select("html"), "supplier": shapes,
    }
    return profile_columns(spark, tables, ["address", "geometry_text", "wkb"]).select(
        "column", "non_null", "address", "geometry_text", "wkb"
    )


def _predicates_sql(name: str, source: str, address: bool = True) -> str:
    street = (
        r"(^|[^\p{L}\p{N}_])(street|st|avenue|ave|road|rd|boulevard|blvd|lane|ln|drive|dr|route|rte|rue|av|bd|chemin|impasse"
        r"|all[ée]e|place|square)([^\p{L}\p{N}_]|$)"
    )
    found = f"regexp_matches(lower(v), '{street}') AND regexp_matches(v, '[0-9]')" if address else "FALSE"
    wkb = "length(v) % 2 = 0 AND regexp_full_match(v, '[0-9A-Fa-f]+') AND (regexp_matches(v, '^010[1-7]') OR regexp_matches(v, '^00......0[1-7]'))"
    text = r"""(starts_with(trim(v), '{') AND contains(v, '"type"') AND contains(v, '"coordinates"'))
      OR regexp_matches(upper(trim(v)), '^(SRID=|POINT|LINESTRING|POLYGON|MULTI|GEOMETRYCOLLECTION)')"""
    return f"""SELECT '{name}' AS "column", count(v) AS non_null, count(CASE WHEN {found} THEN 1 END) AS address,
    count(CASE WHEN ({text}) OR ({wkb}) THEN 1 END) AS geometry_text, count(CASE WHEN {wkb} THEN 1 END) AS wkb FROM ({source})"""


PREDICATES_SQL = _union([
    _predicates_sql("document_text", "SELECT text AS v FROM documents"),
    _predicates_sql("conversation_text", "SELECT text AS v FROM conversations"),
    _predicates_sql("html", "SELECT html AS v FROM pages"),
    _predicates_sql("wkt", "SELECT CASE WHEN s_nationkey < 20 THEN 'POINT (' || s_suppkey || ' ' || s_nationkey || ')' ELSE s_name END AS v FROM supplier"),
    _predicates_sql("geojson", """SELECT '{"type":"Point","coordinates":[' || s_suppkey || ',1]}' AS v FROM supplier"""),
    _predicates_sql("wkb_hex", "SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '01000000' || repeat('00', 16) AS v FROM supplier"),
])


def country_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose values all name the country, and the coarse kind of each column's values."""
    customer = load(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") < 12, " République Française ").otherwise("FR").alias("all_country"),
        F.when(F.col("c_nationkey") < 24, "France").otherwise(F.col("c_mktsegment")).alias("some_country"),
        F.lit(None).cast("string").alias("nothing"), "c_acctbal",
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey").cast("int")), "yyyy-MM-dd").alias("day"),
        "c_name",
    )
    profile = profile_columns(spark, {"customer": customer}, ["country_yes", "country_no", "plain_count", "parsable_time"])
    return profile.select(
        "column", "country_yes", "country_no", detect.is_country_values().alias("is_country"),
        detect.sample_profile().alias("value_kind"), detect.is_parsable_time().alias("is_time"),
    )


COUNTRY_SQL = """
WITH c AS (SELECT CASE WHEN c_nationkey < 12 THEN ' République Française ' ELSE 'FR' END AS all_country,
  CASE WHEN c_nationkey < 24 THEN 'France' ELSE c_mktsegment END AS some_country, CAST(NULL AS VARCHAR) AS nothing,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, CAST(DATE '2020-01-01' + CAST(c_nationkey AS INT) AS VARCHAR) AS day, c_name FROM customer),
u AS (UNPIVOT (SELECT coalesce(all_country, '<null>') AS all_country, coalesce(some_country, '<null>') AS some_country,
  coalesce(nothing, '<null>') AS nothing, coalesce(c_acctbal, '<null>') AS c_acctbal, coalesce(day, '<null>') AS day,
  coalesce(c_name, '<null>') AS c_name FROM c) ON all_country, some_country, nothing, c_acctbal, day, c_name INTO NAME col VALUE v),
t AS (SELECT col, nullif(v, '<null>') AS v,
  trim(regexp_replace(lower(strip_accents(nullif(v, '<null>'))), '[^a-z0-9]+', '_', 'g'), '_') AS token FROM u),
a AS (SELECT col, count(CASE WHEN token IN ('france','fr','fra','republique_francaise','republique_france') THEN 1 END) AS yes,
  count(CASE WHEN token <> '' AND token NOT IN ('france','fr','fra','republique_francaise','republique_france') THEN 1 END) AS other,
  count(v) AS n, count(*) AS rows, count(TRY_CAST(v AS DOUBLE)) AS num, count(TRY_CAST(v AS TIMESTAMP)) AS ts FROM t GROUP BY col)
SELECT col AS "column", yes AS country_yes, other AS country_no, yes > 0 AND other = 0 AS is_country,
  CASE WHEN n = 0 THEN 'empty' WHEN num / n >= 0.8 THEN 'numeric' WHEN ts / n >= 0.8 THEN 'datetime_like' ELSE 'mostly_text' END AS value_kind,
  ts / rows >= 0.9 AS is_time FROM a"""


def profile_by_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios of the one-pass profile, which needs no value shuffle."""
    _, profile = scan_tables(spark, {"lineitem": load(spark, sf_dir, "lineitem")})
    return profile.select("column", "n_rows", "non_null", "num_count", "in_unit", "in_hundred", "num_min", "num_max")


SCAN_SQL = _union([
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count({c}) AS non_null, count(v) AS num_count,
    count(CASE WHEN v BETWEEN 0 AND 1 THEN 1 END) AS in_unit, count(CASE WHEN v BETWEEN 0 AND 100 THEN 1 END) AS in_hundred,
    min(v) AS num_min, max(v) AS num_max
    FROM (SELECT {c}, {_number_sql(c) if c != 'l_shipdate' else 'CAST(NULL AS DOUBLE)'} AS v FROM lineitem)"""
    for c in LINEITEM
])

QUERIES = {
    "profile_lineitem": _profile("lineitem"),
    "profile_customer": _profile("customer"),
    "profile_by_scan": profile_by_scan,
    "numeric_coercion": numeric_coercion,
    "quantitative_indicators": quantitative_indicators,
    "boolean_columns": boolean_columns,
    "likert_columns": likert_columns,
    "nominal_columns": nominal_columns,
    "indicator_entries": indicator_entries,
    "temporal_granularity": temporal_granularity,
    "value_predicates": value_predicates,
    "country_values": country_values,
}
ORACLES = {
    "profile_lineitem": _profile_sql("lineitem", LINEITEM),
    "profile_customer": _profile_sql("customer", CUSTOMER),
    "profile_by_scan": SCAN_SQL,
    "numeric_coercion": NUMERIC_COERCION_SQL,
    "quantitative_indicators": QUANTITATIVE_SQL,
    "boolean_columns": BOOLEAN_SQL,
    "likert_columns": LIKERT_SQL,
    "nominal_columns": NOMINAL_SQL,
    "indicator_entries": INDICATOR_ENTRIES_SQL,
    "temporal_granularity": TEMPORAL_SQL,
    "value_predicates": PREDICATES_SQL,
    "country_values": COUNTRY_SQL,
}
