"""Column profiles of any number of tables in one job.

Each table is turned into cells ``(cid, value)``, one family per storage type so that numbers are never formatted as
text before they are grouped.  The cells of all tables are grouped once by value; predicates are packed in one bit mask
and every other feature is a primitive, which keeps the aggregates in mutable row buffers.

No text longer than ``KEY_BYTES`` is shuffled for a profile.  A shorter text is its own key and its predicates are
evaluated once for each distinct value; a longer one is keyed by 128 bits of hash, its predicates are evaluated where it
is read, and only their outcomes travel.  The texts themselves are read back afterwards by :meth:`Profiled.texts`, for the
columns whose values are matched or shown, by a scan of those columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.functions import fixed, geometry, numbers, text
from colonnade.functions.names import address_role
from colonnade.functions.text import column_key

FLAGS = (
    "boolean_word", "likert_word", "address", "geometry_text", "wkb", "country_yes", "country_no",
    "full_timestamp", "year_month", "year_text", "year_week", "year_quarter", "iso_date", "parsable_time",
    "year_number", "yyyymm_number", "month_number", "first_january", "first_of_month", "monday",
    "lat", "lon", "y", "x",
)
COLUMNS_SCHEMA = (
    "cid int, dataset_id string, column string, col_pos int, kind string, spark_type string, "
    "address_parts array<string>"
)
TEXTS_SCHEMA = "cid int, v string, n long, present boolean, size int"


#: Texts up to this many bytes are grouped as they are, longer ones by their digest; the profile is the same.
KEY_BYTES = 64
_EXACT = float(1 << 53)  # whole numbers below it have a double of their own


@dataclass(frozen=True)
class Source:
    """A table and its cells: (cid, family, value of the family's type)."""

    table: DataFrame
    cells: tuple[tuple[int, str, Column], ...]


@dataclass(frozen=True)
class Profiled:
    """Column list, distinct values by digest, and where the values can be read again.

    ``digests`` has one row for each distinct value of a column: cid, n, present and the features, without the value.
    """

    columns: DataFrame
    digests: DataFrame
    sources: tuple[Source, ...]

    @property
    def values(self) -> DataFrame:
        """Distinct values of all columns; see :meth:`texts`."""
        return self.texts(cid for source in self.sources for cid, *_ in source.cells)

    def texts(self, cids: Iterable[int]) -> DataFrame:
        """Distinct values as texts, and their counts, of the given columns: (cid, v, n, present, size)."""
        wanted = set(cids)
        parts = [_texts(family, cells) for family, cells in _families(self.sources, wanted).items()]
        if not parts:
            return self.columns.sparkSession.createDataFrame([], TEXTS_SCHEMA)
        return reduce(DataFrame.unionByName, parts)

    def texts_of(self, wanted: DataFrame) -> DataFrame:
        """Values of the columns named by ``cid`` in ``wanted``, whose number is at most that of all columns."""
        return self.texts(row["cid"] for row in wanted.select("cid").where("cid IS NOT NULL").distinct().toLocalIterator())


def column_kind(data_type: T.DataType) -> str:
    """Family a Spark type belongs to."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "double"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(data_type, T.BinaryType):
        return "binary"
    if isinstance(data_type, T.StructType) and {"type", "coordinates"} <= set(data_type.names):
        return "geometry"
    return "complex"


def address_columns(spark: SparkSession, tables: Mapping[str, DataFrame], include_city: bool = False) -> dict[str, list[str]]:
    """Address sub-columns of every table in composition order (only column names are looked at)."""
    names = [(ds, c, i) for ds, df in tables.items() for i, c in enumerate(df.columns)]
    if not names:
        return {}
    found = address_parts(
        spark.createDataFrame(names, "dataset_id string, column string, col_pos int"), include_city=include_city
    ).groupBy("dataset_id").agg(F.sort_array(F.collect_list(F.struct("part_pos", "column"))).alias("parts"))
    return {row["dataset_id"]: [p["column"] for p in row["parts"]] for row in found.toLocalIterator()}


def address_parts(columns: DataFrame, *, include_city: bool = False) -> DataFrame:
    """Address sub-columns with their role and position in the composed address."""
    order = fixed.ADDRESS_ROLE_ORDER + (fixed.ADDRESS_CITY_ROLES if include_city else ())
    position = F.array_position(F.array(*[F.lit(r) for r in order]), F.col("role"))
    return (
        columns.withColumn("role", address_role(column_key(F.col("column"))))
        .where(position > 0)
        .withColumn("part_pos", position.cast("int") * 100000 + F.col("col_pos"))
        .select("dataset_id", "column", "role", "part_pos")
    )


def compose_address(df: DataFrame, parts: list[str], name: str = fixed.ADDRESS_COLUMN) -> DataFrame:
    """Join address sub-columns into one text column and drop them."""
    if not parts:
        return df
    line = F.concat_ws(" ", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in parts])
    composed = F.nullif(text.strip(F.regexp_replace(line, r"(?U)\s+", " ")), F.lit(""))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in parts]
    return df.select(*kept, composed.alias(name))


def profile_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    *,
    address: Mapping[str, list[str]] | None = None,
    strict_numeric: bool = False,
    measures: Iterable[str] | None = None,
) -> Profiled:
    """Column list and distinct values of the tables.

    ``address`` names sub-columns to profile as one composed address column instead of one by one.  ``measures`` limits
    the predicates to those some later :func:`column_profile` asks for (all by default).
    """
    wanted = None if measures is None else frozenset(measures) & frozenset(FLAGS)
    columns, sources = _split_columns(spark, tables, address or {})
    parts = [_frequencies(family, cells, strict_numeric, wanted) for family, cells in _families(sources).items()]
    return Profiled(columns, reduce(DataFrame.unionByName, parts), sources)


def scan_tables(spark: SparkSession, tables: Mapping[str, DataFrame], **options) -> tuple[DataFrame, DataFrame]:
    """Profile without a value shuffle: ratios are exact, distinct counts are approximate.

    For very large tables of near-unique columns, whose value-frequency table would be as large as the data.
    """
    columns, sources = _split_columns(spark, tables, options.get("address") or {})
    parts = []
    for family, cells in _families(sources).items():
        cells = cells.withColumn("n", F.lit(1).cast("long"))
        if family == "text":
            cells = _with_typed(cells)
        features = _features(family, options.get("strict_numeric", False))
        parts.append(
            cells.select(
                "cid", "n", F.xxhash64("x").alias("key"), F.col("x").isNotNull().alias("present"),
                *[expr.alias(name) for name, expr in features.items()],
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    aggregates = dict(_aggregates())
    aggregates["nunique"] = F.approx_count_distinct(F.when(F.col("present"), F.col("key")), 0.02)
    aggregates["num_nunique"] = F.approx_count_distinct("num", 0.02)
    return columns, _with_columns(columns, rows.groupBy("cid").agg(*[e.alias(k) for k, e in aggregates.items()]))


def column_profile(profiled: Profiled, measures: Iterable[str] | None = None) -> DataFrame:
    """One row per column with the counts the detectors need.

    ``measures`` names the counts wanted (all by default); what is not asked for is neither shuffled nor computed.
    """
    aggregates = dict(_aggregates())
    aggregates["nunique"] = F.sum(F.col("present").cast("long"))
    # numbers that are not keyed are distinct already, so only the others are sent by value
    unkeyed = F.col("num").isNotNull() & F.col("num_key").isNull()
    aggregates["num_nunique"] = F.count_distinct("num_key") + F.sum(unkeyed.cast("long"))
    if measures is not None:
        wanted = {"n_rows", "non_null", "nunique", *measures}
        aggregates = {k: e for k, e in aggregates.items() if k in wanted}
    grouped = profiled.digests.groupBy("cid").agg(*[e.alias(k) for k, e in aggregates.items()])
    return _with_columns(profiled.columns, grouped)


def profile_columns(spark: SparkSession, tables: Mapping[str, DataFrame], measures: Iterable[str]) -> DataFrame:
    """Column profile of the tables with the given counts only."""
    measures = tuple(measures)
    return column_profile(profile_tables(spark, tables, measures=measures), measures)


def _with_columns(columns: DataFrame, grouped: DataFrame) -> DataFrame:
    counted = [c for c in grouped.columns if c != "cid" and c not in _MAY_BE_NULL]
    joined = (
        columns.withColumn("name_key", column_key(F.col("column")))
        .join(grouped, "cid", "left")
        .fillna(0, subset=counted)
        .withColumn("not_null_ratio", numbers.ratio(F.col("non_null"), F.col("n_rows")))
        .withColumn("nunique_ratio", numbers.ratio(F.col("nunique"), F.col("non_null")))
    )
    if "sum_len" in grouped.columns:
        filled = (F.col("non_null") > 0) & ~F.col("kind").isin("complex", "geometry")
        joined = joined.withColumn("avg_len", F.when(filled, F.col("sum_len") / F.col("non_null")))
    return joined


_MAY_BE_NULL = {"num_min", "num_max", "plain_min", "plain_max", "plain_mean", "likert_min", "likert_max"}


def _split_columns(spark, tables, address) -> tuple[DataFrame, tuple[Source, ...]]:
    """Column list, and the cells of every table."""
    rows, sources = [], []
    for dataset_id, df in tables.items():
        parts = address.get(dataset_id, [])
        positions = {c: i for i, c in enumerate(df.columns)}
        df = compose_address(df, parts)
        cells = []
        for field in df.schema.fields:
            kind = column_kind(field.dataType)
            cid = len(rows)
            rows.append(
                (cid, dataset_id, field.name, positions.get(field.name, len(positions)), kind,
                 field.dataType.simpleString(), parts if field.name == fixed.ADDRESS_COLUMN and parts else None)
            )
            cells.append((cid, *_cell_value(kind, F.col(f"`{field.name}`"))))
        sources.append(Source(df, tuple(cells)))
    return spark.createDataFrame(rows, COLUMNS_SCHEMA), tuple(sources)


def _families(sources: Iterable[Source], cids: set[int] | None = None) -> dict[str, DataFrame]:
    """Cells (cid, x) of each storage family, of all columns or the given ones."""
    frames: dict[str, list[DataFrame]] = {}
    for source in sources:
        by_family: dict[str, list[Column]] = {}
        for cid, family, value in source.cells:
            if cids is None or cid in cids:
                by_family.setdefault(family, []).append(F.struct(F.lit(cid).alias("cid"), value.alias("x")))
        for family, structs in by_family.items():
            frames.setdefault(family, []).append(source.table.select(F.inline(F.array(*structs))))
    return {family: reduce(DataFrame.unionAll, parts) for family, parts in frames.items()}


def _texts(family: str, cells: DataFrame) -> DataFrame:
    """Distinct values of cells as texts with their counts."""
    x = F.col("x")
    if family == "binary":
        cells = cells.select("cid", F.hex(x).alias("x"))
    grouped = cells.groupBy("cid", "x").agg(F.count("*").alias("n"))
    shown = grouped.select("cid", x.cast("string").alias("v"), "n")
    size = F.length("v") / 2 if family == "binary" else F.length("v")
    return shown.select("cid", "v", "n", F.col("v").isNotNull().alias("present"), size.cast("int").alias("size"))


def _cell_value(kind: str, column: Column) -> tuple[str, Column]:
    if kind == "integer":
        return "integer", column.cast("bigint")
    if kind == "double":
        value = column.cast("double")
        # adding zero folds the two zeros into one value
        return "double", F.when(~F.isnan(value), value + 0.0)
    if kind == "time":
        return "time", column.cast("timestamp_ntz")
    if kind == "binary":
        return "binary", column
    if kind in ("geometry", "complex"):
        return "complex", F.when(column.isNotNull(), F.lit(True))
    return "text", column.cast("string")


@lru_cache(maxsize=None)
def _features(family: str, strict_numeric: bool, wanted: frozenset[str] | None = None) -> dict[str, Column]:
    """Per-value features of column ``x``: printed length, the number readings and the predicate mask.

    Expressions do not belong to a table, so each family is built once per process.
    """
    x = F.col("x")
    none = F.lit(None).cast("double")
    if family in ("integer", "double"):
        number = x.cast("double")
        return {
            "size": F.length(x.cast("string")), "num": number, "plain": number, "coord": number,
            "flags": _mask({**_number_flags(number), **_range_flags(number), **_printed_flags(family, x)}, wanted),
        }
    if family == "time":
        flags = {
            "first_january": (F.month(x) == 1) & (F.dayofmonth(x) == 1),
            "first_of_month": F.dayofmonth(x) == 1,
            "monday": F.weekday(x) == 0,
            "parsable_time": x.isNotNull(),
        }
        return {"size": F.length(x.cast("string")), "num": none, "plain": none, "coord": none, "flags": _mask(flags, wanted)}
    if family == "binary":
        return {"size": F.length(x), "num": none, "plain": none, "coord": none,
                "flags": _mask({"wkb": geometry.is_wkb_bytes(x)}, wanted)}
    if family == "complex":
        return {"size": F.lit(0), "num": none, "plain": none, "coord": none, "flags": F.lit(0).cast("long")}
    typed = F.col("typed")
    coordinate = numbers.coordinate_number(typed)
    return {
        "size": F.length(x),
        "num": numbers.coerced_number(x, strict=strict_numeric),
        "plain": text.plain_number(typed),
        "coord": coordinate,
        "flags": _mask({**_word_flags(x, typed), **_text_flags(x, typed), **_range_flags(coordinate)}, wanted),
    }


def _with_typed(cells: DataFrame) -> DataFrame:
    """Texts with what of them may be read as a word, a number, a time or a geometry, null where that is out of the question.

    Every pattern decodes the whole text it is tried on; of long texts, nearly all are given up at their first character.
    """
    longest = max(len(w) for w in fixed.BOOLEAN_WORDS)
    x = F.col("x")
    return cells.withColumns({"typed": F.when(text.may_be_typed(x, longest), x), "shape": F.when(geometry.may_be_geometry(x), x)})


def _printed_flags(family: str, x: Column) -> dict[str, Column]:
    """What :func:`_word_flags` says of a printed number, which has no letters but those of infinity."""
    digits = [int(w) for w in fixed.BOOLEAN_WORDS if w.isdigit()]
    return {"boolean_word": x.isin(*digits) if family == "integer" else F.lit(False), "country_no": x.isNotNull()}


def _word_flags(x: Column, typed: Column) -> dict[str, Column]:
    # every letter or digit stays in the token, so a text with more of them than the longest alias is none
    most = max(len(t.replace("_", "")) for t in fixed.COUNTRY_VALUE_TOKENS)
    few = x.rlike(f"^(?:[^A-Za-z0-9]*+[A-Za-z0-9]){{0,{most}}}+[^A-Za-z0-9]*+$")
    token = text.country_token(F.when(few, text.strip(x)))
    alias = token.isin(*fixed.COUNTRY_VALUE_TOKENS)
    return {
        "boolean_word": F.lower(text.strip(typed)).isin(*fixed.BOOLEAN_WORDS),
        "likert_word": _holds_keyword(F.lower(x)),
        "country_yes": few & alias,
        "country_no": ~few | (~alias & (token != "")),
    }


def _holds_keyword(word: Column) -> Column:
    """Whether a text holds a keyword of a rating; several that end in the same word are looked for after that word."""
    # a keyword that holds another one adds nothing
    keywords = [k for k in fixed.LIKERT_KEYWORDS if not any(o != k and o in k for o in fixed.LIKERT_KEYWORDS)]
    by_end: dict[str, list[str]] = {}
    for keyword in keywords:
        by_end.setdefault(keyword.split()[-1], []).append(keyword)
    groups = []
    for end, found in by_end.items():
        held = reduce(lambda a, b: a | b, [F.contains(word, F.lit(k)) for k in found])
        groups.append(held if found == [end] else F.contains(word, F.lit(end)) & held)
    return reduce(lambda a, b: a | b, groups)


def _text_flags(x: Column, typed: Column) -> dict[str, Column]:
    bare, shape = text.strip(typed), F.col("shape")
    return {
        "address": geometry.is_address_text(x),
        "geometry_text": geometry.is_geometry_text(shape),
        "wkb": geometry.is_wkb_text(shape),
        "full_timestamp": bare.rlike(fixed.FULL_TIMESTAMP_PATTERN),
        "year_month": bare.rlike(fixed.YEAR_MONTH_PATTERN),
        "year_text": bare.rlike(fixed.YEAR_PATTERN) & bare.try_cast("int").between(1800, 2100),
        "year_week": bare.rlike(fixed.YEAR_WEEK_PATTERN),
        "year_quarter": bare.rlike(fixed.YEAR_QUARTER_PATTERN),
        "iso_date": bare.rlike(fixed.ISO_DATE_PATTERN),
        "parsable_time": bare.try_cast("timestamp").isNotNull(),
    }


def _number_flags(number: Column) -> dict[str, Column]:
    whole = F.signum(number) * F.floor(F.abs(number))
    month = whole % 100
    return {
        "year_number": whole.between(1800, 2100),
        "yyyymm_number": whole.between(180001, 210012),
        "month_number": month.between(1, 12),
    }


def _range_flags(number: Column) -> dict[str, Column]:
    return {axis: number.between(low, high) for axis, (low, high) in fixed.COORDINATE_RANGES.items()}


def _mask(flags: dict[str, Column], wanted: frozenset[str] | None) -> Column:
    zero = F.lit(0).cast("long")
    bits = [zero] + [
        F.when(condition, F.lit(1 << FLAGS.index(name)).cast("long")).otherwise(F.lit(0).cast("long"))
        for name, condition in flags.items()
        if wanted is None or name in wanted
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _frequencies(family: str, cells: DataFrame, strict_numeric: bool, wanted: frozenset[str] | None) -> DataFrame:
    """Features and count of each distinct value of a column, without the value."""
    x, num = F.col("x"), F.col("num")
    features = _features(family, strict_numeric, wanted)
    if family in ("text", "binary"):
        fits = x.isNull() if family == "binary" else x.isNull() | (F.octet_length(x) <= KEY_BYTES)
        short = cells.where(fits).groupBy("cid", "x").agg(F.count("*").alias("n"))
        long = cells.where(~fits)
        if family == "text":
            short, long = _with_typed(short), _with_typed(long)
        short = short.select("cid", "n", x.isNotNull().alias("present"), *[e.alias(k) for k, e in features.items()])
        # equal values have equal features, so any of them will do; as aggregates they stay above the union of the tables
        digest = [F.xxhash64(F.lit(i), x).alias(f"digest{i}") for i in range(2)]
        outcomes = [F.max(e).alias(k) for k, e in features.items()]
        long = long.groupBy("cid", *digest).agg(F.count("*").alias("n"), *outcomes)
        found = short.unionByName(long.select("cid", "n", F.lit(True).alias("present"), *features))
        return found.withColumn("num_key", num)
    grouped = cells.groupBy("cid", "x").agg(F.count("*").alias("n"))
    rows = grouped.select("cid", "n", x.isNotNull().alias("present"), *[e.alias(k) for k, e in features.items()])
    # whole numbers can share a double
    return rows.withColumn("num_key", F.when(F.lit(family == "integer") & (F.abs("num") >= _EXACT), num))


@lru_cache(maxsize=1)
def _aggregates() -> dict[str, Column]:
    """Weighted counts over the values of a column."""
    n, num, plain = F.col("n"), F.col("num"), F.col("plain")
    finite = num.isNotNull() & (F.abs(num) < float("inf"))
    plain_finite = plain.isNotNull() & (F.abs(plain) < float("inf"))
    step = F.signum(plain) * F.floor(F.abs(plain))

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(F.lit(0).cast("long")))

    aggregates = {
        "n_rows": F.sum(n),
        "non_null": count(F.col("present")),
        "sum_len": F.sum(F.when(F.col("present"), n * F.col("size")).otherwise(F.lit(0).cast("long"))),
        "num_count": count(num.isNotNull()),
        "nonzero": count(num.isNotNull() & (num != 0)),
        "finite": count(finite),
        "in_unit": count(finite & num.between(0, 1)),
        "in_hundred": count(finite & num.between(0, 100)),
        "whole": count(finite & (F.abs(F.rint(num) - num) < 1e-9)),
        "decimals": count(num.isNotNull() & (num != F.floor(num))),
        "num_min": F.min(F.when(finite, num)),
        "num_max": F.max(F.when(finite, num)),
        "plain_count": count(plain.isNotNull()),
        "plain_min": F.min(F.when(plain_finite, plain)),
        "plain_max": F.max(F.when(plain_finite, plain)),
        "plain_mean": F.sum(F.when(plain_finite, plain * n)) / F.sum(F.when(plain_finite, n)),
        "likert_min": F.min(step),
        "likert_max": F.max(step),
        "likert_bits": F.bit_or(
            F.when(step.between(1, 7), F.call_function("shiftleft", F.lit(1), step.cast("int"))).otherwise(F.lit(0))
        ),
        "coord_count": count(F.col("coord").isNotNull()),
    }
    for bit, name in enumerate(FLAGS):
        mask = F.lit(1 << bit).cast("long")
        aggregates[name] = count(F.col("flags").bitwiseAND(mask) != 0)
    return aggregates
