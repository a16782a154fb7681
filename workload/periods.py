"""Period parsing and range queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions.periods import file_name_periods, parse_period
from colonnade.operators.reference import file_name_levels, reference_keys
from colonnade.operators.temporal import period_ranges
from workload.tables import load, reference_lists

def _day():
    return F.col("o_orderdate")



def _range_query(granularity: str, token, key: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = load(spark, sf_dir, "orders").select(key, token().alias("token"))
        return period_ranges(orders, [key], "token", granularity)

    return query


def _range_sql(key: str, start: str, end: str, label: str) -> str:
    """Ranges of the distinct periods of each key; ``end`` and ``label`` are expressions over the start ``s``."""
    return f"""
WITH d AS (SELECT DISTINCT {key} AS k, CAST({start} AS DATE) AS s FROM orders WHERE o_orderdate IS NOT NULL),
e AS (SELECT k, s, CAST({end} AS DATE) AS e FROM d),
g AS (SELECT k, s, CASE WHEN s = lag(e) OVER (PARTITION BY k ORDER BY s) + 1 THEN 0 ELSE 1 END AS fresh FROM e),
i AS (SELECT k, s, sum(fresh) OVER (PARTITION BY k ORDER BY s) AS island FROM g),
r AS (SELECT k, island, min(s) AS a, max(s) AS b, count(*) AS n FROM i GROUP BY k, island)
SELECT k AS {key}, {label.format(s='a')} AS start_label, {label.format(s='b')} AS end_label, n AS n_periods FROM r"""


def _month_token():
    return F.date_format(_day(), "yyyy-MM")


def _day_token():
    return _day().cast("date").cast("string")


def _week_token():
    thursday = F.date_add(F.date_trunc("week", _day()).cast("date"), 3)
    return F.format_string("%04d-W%02d", F.year(thursday), F.weekofyear(_day()))


def _quarter_token():
    return F.concat(F.lit("Q"), F.quarter(_day()), F.lit("_"), F.year(_day()))


def _semester_token():
    return F.concat(F.year(_day()), F.lit("S"), F.when(F.month(_day()) <= 6, 1).otherwise(2))


def _year_token():
    return F.year(_day())


def period_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every way of writing a period, valid or not, parsed from texts derived from the order dates."""
    day, key = _day(), F.col("o_custkey")
    forms = {
        "year": F.concat(F.lit("FY "), F.year(day), F.lit(" final")),
        "semester": F.concat(F.lit("S"), F.when(F.month(day) <= 6, 1).otherwise(2), F.lit("-"), F.year(day)),
        "quarter": F.concat(F.lit("T"), F.quarter(day), F.lit(" "), F.year(day)),
        "month": F.concat(F.year(day), F.lit("/"), F.month(day)),
        "week": F.format_string("%04d-W%02d", F.year(day), F.pmod(key, F.lit(60)).cast("int")),
        "date": F.format_string("%04d-%02d-%02d", F.year(day), F.month(day), (F.pmod(key, F.lit(31)) + 1).cast("int")),
    }
    orders = load(spark, sf_dir, "orders")
    parts = [
        orders.select(F.lit(g).alias("granularity"), token.alias("token")).distinct().select(
            "granularity", "token", parse_period(F.col("token"), g).alias("p")
        )
        for g, token in forms.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.select(
        "granularity", "token", F.col("p.start").cast("string").alias("period_start"),
        F.col("p.end").cast("string").alias("period_end"), F.col("p.label").alias("label"),
    )


PERIOD_TOKENS_SQL = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y, month(o_orderdate) AS m, quarter(o_orderdate) AS q, o_custkey AS k FROM orders),
w AS (SELECT DISTINCT y, k % 60 AS w FROM o),
c AS (SELECT DISTINCT isoyear(x) AS y, week(x) AS w, CAST(date_trunc('week', x) AS DATE) AS monday
      FROM (SELECT unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2003-01-01', INTERVAL 1 DAY)) AS x)),
t AS (SELECT DISTINCT y, m, k % 31 + 1 AS dd, printf('%04d-%02d-%02d', y, m, CAST(k % 31 + 1 AS INT)) AS txt FROM o)
SELECT DISTINCT 'year' AS granularity, 'FY ' || y || ' final' AS token, y || '-01-01' AS period_start, y || '-12-31' AS period_end, CAST(y AS VARCHAR) AS label FROM o
UNION ALL SELECT DISTINCT 'semester', 'S' || CASE WHEN m <= 6 THEN 1 ELSE 2 END || '-' || y, y || CASE WHEN m <= 6 THEN '-01-01' ELSE '-07-01' END,
  y || CASE WHEN m <= 6 THEN '-06-30' ELSE '-12-31' END, y || '-S' || CASE WHEN m <= 6 THEN 1 ELSE 2 END FROM o
UNION ALL SELECT DISTINCT 'quarter', 'T' || q || ' ' || y, CAST(make_date(y, q * 3 - 2, 1) AS VARCHAR), CAST(last_day(make_date(y, q * 3, 1)) AS VARCHAR), y || '-Q' || q FROM o
UNION ALL SELECT DISTINCT 'month', y || '/' || m, CAST(make_date(y, m, 1) AS VARCHAR), CAST(last_day(make_date(y, m, 1)) AS VARCHAR), printf('%04d-%02d', y, m) FROM o
UNION ALL SELECT 'week', printf('%04d-W%02d', w.y, CAST(w.w AS INT)), CAST(monday AS VARCHAR), CAST(monday + 6 AS VARCHAR), CASE WHEN monday IS NOT NULL THEN printf('%04d-W%02d', w.y, CAST(w.w AS INT)) END
  FROM w LEFT JOIN c ON c.y = w.y AND c.w = w.w
UNION ALL SELECT 'date', txt, CAST(TRY_CAST(txt AS DATE) AS VARCHAR), CAST(TRY_CAST(txt AS DATE) AS VARCHAR), CASE WHEN TRY_CAST(txt AS DATE) IS NOT NULL THEN txt END FROM t"""


def filename_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods and spatial codes named in file names built from orders and their customers' nations."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    names = (
        load(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.concat(F.lit("indicateur_dep_"), F.col("c_nationkey"), F.lit("_"), _month_token(), F.lit(".csv")).alias("name"))
        .distinct()
    )
    periods = names.select("name", F.inline(file_name_periods(F.col("name"))))
    codes = file_name_levels(names, reference_keys(reference_lists(spark, sf_dir)))
    return periods.unionByName(codes)


FILENAME_HINTS_SQL = """
WITH n AS (SELECT DISTINCT c_nationkey AS k, year(o_orderdate) AS y, month(o_orderdate) AS m,
  'indicateur_dep_' || c_nationkey || '_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS name
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT name, 'month' AS granularity, printf('%04d-%02d', y, m) AS value FROM n
UNION ALL SELECT name, 'year', CAST(y AS VARCHAR) FROM n
UNION ALL SELECT name, 'departement', lpad(CAST(k AS VARCHAR), 2, '0') FROM n WHERE k BETWEEN 0 AND 24"""


QUERIES = {
    "period_tokens": period_tokens,
    "temporal_ranges_month_by_customer": _range_query("month", _month_token, "o_custkey"),
    "temporal_ranges_day": _range_query("date", _day_token, "o_orderstatus"),
    "temporal_ranges_day_by_customer": _range_query("date", _day_token, "o_custkey"),
    "temporal_ranges_week": _range_query("week", _week_token, "o_custkey"),
    "temporal_ranges_quarter": _range_query("quarter", _quarter_token, "o_custkey"),
    "temporal_ranges_semester": _range_query("semester", _semester_token, "o_custkey"),
    "temporal_ranges_year": _range_query("year", _year_token, "o_custkey"),
    "filename_hints": filename_hints,
}
_MONTH_LABEL = "strftime({s}, '%Y-%m')"
_DAY_LABEL = "strftime({s}, '%Y-%m-%d')"
_HALF = "CASE WHEN month(o_orderdate) <= 6 THEN make_date(year(o_orderdate), 1, 1) ELSE make_date(year(o_orderdate), 7, 1) END"
ORACLES = {
    "period_tokens": PERIOD_TOKENS_SQL,
    "temporal_ranges_month_by_customer": _range_sql("o_custkey", "date_trunc('month', o_orderdate)", "last_day(s)", _MONTH_LABEL),
    "temporal_ranges_day": _range_sql("o_orderstatus", "o_orderdate", "s", _DAY_LABEL),
    "temporal_ranges_day_by_customer": _range_sql("o_custkey", "o_orderdate", "s", _DAY_LABEL),
    "temporal_ranges_week": _range_sql("o_custkey", "date_trunc('week', o_orderdate)", "s + 6", "printf('%04d-W%02d', isoyear({s}), week({s}))"),
    "temporal_ranges_quarter": _range_sql("o_custkey", "date_trunc('quarter', o_orderdate)", "last_day(s + INTERVAL 2 MONTH)", "year({s}) || '-Q' || quarter({s})"),
    "temporal_ranges_semester": _range_sql("o_custkey", _HALF, "last_day(s + INTERVAL 5 MONTH)", "year({s}) || '-S' || CASE WHEN month({s}) <= 6 THEN 1 ELSE 2 END"),
    "temporal_ranges_year": _range_sql("o_custkey", "date_trunc('year', o_orderdate)", "make_date(year(s), 12, 31)", "strftime({s}, '%Y')"),
    "filename_hints": FILENAME_HINTS_SQL,
}
