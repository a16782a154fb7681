"""Reading files of a lake as tables."""

from __future__ import annotations

import collections
import csv
import io
import json
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.functions import fixed
from colonnade.functions.text import _windows_table
from colonnade.sources import records

SEPARATORS = (";", ",", "\t", "|")
_BAD_LINE = "_bad_line"


class UnreadableFile(ValueError):
    """The file cannot be read as a table."""


def extension(path: str) -> str:
    """Lower-case extension without the dot."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def category(ext: Column) -> Column:
    """Structured, semi-structured or unknown, from the extension."""
    known = F.create_map(*[F.lit(x) for pair in fixed.FORMAT_CATEGORY.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(ext)), F.lit("unknown"))


def separator_counts(lines: DataFrame, keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Most frequent separator of the text lines of each key: (keys, separator, n); null when none occurs."""
    order = (",", ";", "\t", "|")
    counts = [
        F.sum(F.length(value) - F.length(F.replace(F.col(value), F.lit(s), F.lit("")))).alias(f"c{i}") for i, s in enumerate(order)
    ]
    best = F.greatest(*[F.col(f"c{i}") for i in range(len(order))])
    chosen = reduce(
        lambda column, i: column.when(F.col(f"c{i}") == best, order[i]),
        range(len(order)),
        F.when(best == 0, F.lit(None).cast("string")),
    )
    return lines.groupBy(*keys).agg(*counts).select(*keys, chosen.alias("separator"), best.alias("n"))


def file_encoding(spark: SparkSession, path: str) -> str:
    """utf-8 when every line is valid, else windows-1252 (the scan stops at the first invalid line)."""
    invalid = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count()
    return "windows-1252" if invalid else "utf-8"


def read_delimited(spark: SparkSession, path: str, *, encoding: str | None = None, infer: bool = True) -> DataFrame:
    """Delimited text: the first of ``; , tab |`` that splits the header, records with too many fields left out.

    Quoted fields may hold separators and line breaks.  A quote that never closes is a character, and then every line is a
    record.  Windows-1252 is read as Latin-1 with the 0x80-0x9F range mapped, since Spark has no such decoder.
    """
    encoding = encoding or file_encoding(spark, path)
    charset = "UTF-8" if encoding == "utf-8" else "ISO-8859-1"
    first = records.lines_of(spark, path, charset, "\n").limit(1).collect()
    line = first[0][0] if first else ""
    line_end = "\r" if "\r" in line.rstrip("\r") else "\n"
    lines = records.lines_of(spark, path, charset, line_end)
    header = line.split("\r")[0]
    separator = _header_separator(header)
    quoted = not lines.where(F.contains("value", F.lit('"'))).isEmpty()
    blocks = records.scan_blocks(lines, separator or ",") if quoted else None
    if blocks and blocks.crossing and blocks.closed:
        return _in_windows_letters(_read_records(lines, separator, blocks, line_end, path, infer), encoding)
    if separator is None:
        raise UnreadableFile(f"{path}: no separator in the first line")
    options = {"sep": separator, "encoding": charset, "header": True, "escape": '"', "ignoreTrailingWhiteSpace": False}
    schema = spark.read.options(**options, inferSchema=infer).csv(path).schema
    read = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD_LINE)
    table = read.schema(T.StructType([*schema.fields, T.StructField(_BAD_LINE, T.StringType())])).csv(path)
    too_long = _separators(F.col(_BAD_LINE), separator) >= len(schema.fields)
    table = table.where(F.col(_BAD_LINE).isNull() | ~too_long).drop(_BAD_LINE)
    return _in_windows_letters(table, encoding)


def _header_separator(header: str) -> str | None:
    """First separator that occurs outside quotes."""
    bare = re.sub(records.QUOTED + '|".*', "", header)
    return next((s for s in SEPARATORS if s in bare), None)


def _separators(record: Column, separator: str) -> Column:
    """Number of separators outside quotes."""
    bare = F.regexp_replace(record, records.QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit("")))


def _read_records(lines: DataFrame, separator: str | None, blocks: records.Blocks, line_end: str, path: str, infer: bool) -> DataFrame:
    """Table of records that hold line breaks."""
    found = records.records(lines, separator or ",", blocks, line_end)
    head = found.where("header").first()
    header = head["record"].removeprefix("\ufeff").rstrip("\r") if head else ""
    separator = separator or _header_separator(header)
    if separator is None:
        raise UnreadableFile(f"{path}: no separator in the first record")
    names = next(csv.reader(io.StringIO(header, newline=""), delimiter=separator))
    names = [n or f"_c{i}" for i, n in enumerate(names)]
    seen = collections.Counter(n.lower() for n in names)
    names = [f"{n}{i}" if seen[n.lower()] > 1 else n for i, n in enumerate(names)]
    body = found.where("NOT header").select(F.rtrim("record", F.lit("\r")).alias("record")).where("trim(record) <> ''")
    body = body.where(_separators(F.col("record"), separator) < len(names))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    fields = F.from_csv("record", schema, {"sep": separator, "escape": '"', "ignoreTrailingWhiteSpace": "false"})
    table = body.select(fields.alias("f")).select("f.*")
    kinds = _inferred(table) if infer else {}
    return table.select(*[F.col(f"c{i}").cast(kinds.get(f"c{i}", "string")).alias(n) for i, n in enumerate(names)])


def _inferred(table: DataFrame) -> dict[str, str]:
    """The first type that all values of a text column have; columns without values stay text."""
    day, time = r"^\d{4}-\d{2}-\d{2}$", r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"
    fits: dict[str, Callable[[Column], Column]] = {
        "int": lambda c: c.try_cast("int").isNotNull(), "bigint": lambda c: c.try_cast("bigint").isNotNull(),
        "double": lambda c: c.try_cast("double").isNotNull(), "date": lambda c: c.rlike(day) & c.try_cast("date").isNotNull(),
        "timestamp": lambda c: c.rlike(time) & c.try_cast("timestamp").isNotNull(), "boolean": lambda c: F.lower(c).isin("true", "false"),
    }
    tests = [F.bool_and(F.when(F.col(c).isNotNull(), fit(F.col(c)))).alias(f"{c} {kind}") for c in table.columns for kind, fit in fits.items()]
    found = table.agg(*tests).first()
    return {c: kind for c in table.columns for kind in reversed(fits) if found[f"{c} {kind}"]}


def _in_windows_letters(table: DataFrame, encoding: str) -> DataFrame:
    """Latin-1 texts with the letters that Windows-1252 has in place of control characters."""
    if encoding == "utf-8":
        return table
    source, target = _windows_table()
    return table.select(*[
        F.translate(f"`{f.name}`", source, target).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in table.schema.fields
    ])


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as dotted columns; arrays and maps stay."""

    def leaves(schema: T.StructType, column: Callable[[str], Column], prefix: str) -> list[Column]:
        found = []
        for field in schema.fields:
            value, name = column(field.name), prefix + field.name
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, value.getField, name + ".")
            else:
                found.append(value.alias(name))
        return found

    return df.select(*leaves(df.schema, lambda name: F.col(f"`{name}`"), ""))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines or one document; GeoJSON gives one row per feature, anything else dotted columns."""
    first = spark.read.text(path).where("trim(value) <> ''").limit(1).collect()
    try:
        by_line = bool(first) and json.loads(first[0][0].lstrip("﻿")) is not None
    except ValueError:
        by_line = False
    raw = spark.read.option("multiLine", not by_line).json(path)
    if "_corrupt_record" in raw.columns and len(raw.columns) == 1:
        raise UnreadableFile(f"{path}: not JSON")
    if "type" in raw.columns and {"features", "geometry", "coordinates"} & set(raw.columns):
        head = raw.select("type").first()
        if head and head[0] in fixed.GEOJSON_TYPES:
            return geojson_features(_with_any_geometry(spark, path, raw, not by_line))
    return flatten(raw)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON: one row per feature, its properties as columns next to the geometry."""
    return geojson_features(_with_any_geometry(spark, path, spark.read.option("multiLine", True).json(path)))


def _with_any_geometry(spark: SparkSession, path: str, raw: DataFrame, multi_line: bool = True) -> DataFrame:
    """The same file with coordinates of different depths as variants; plain inference would print them as text."""

    def mixes(kind: T.DataType) -> bool:
        return mixes(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, T.NumericType)

    def loosened(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(loosened(kind.elementType))
        if not isinstance(kind, T.StructType):
            return kind
        if "type" in kind.names and {"coordinates", "geometries"} & set(kind.names) and "features" not in kind.names:
            named = {f.name: f for f in kind.fields}
            if "geometries" in named or mixes(named["coordinates"].dataType):
                fields = [f for f in kind.fields if f.name not in ("coordinates", "geometries")]
                open_ = [T.StructField(n, T.VariantType()) for n in ("coordinates", *(("geometries",) if "geometries" in named else ()))]
                return T.StructType([*fields, *open_])
        return T.StructType([f if f.name == "properties" else T.StructField(f.name, loosened(f.dataType)) for f in kind.fields])

    schema = loosened(raw.schema)
    return raw if schema == raw.schema else spark.read.schema(schema).option("multiLine", multi_line).json(path)


def geojson_features(raw: DataFrame) -> DataFrame:
    """Features of a parsed GeoJSON document."""
    if "features" in raw.columns:
        raw = raw.select(F.explode("features").alias("f")).select("f.*")
    if "geometry" in raw.columns:
        has_properties = isinstance(raw.schema["properties"].dataType, T.StructType) if "properties" in raw.columns else False
        return flatten_properties(raw) if has_properties else raw.select("geometry")
    return raw.select(F.struct("type", *[c for c in ("coordinates", "geometries") if c in raw.columns]).alias("geometry"))


def flatten_properties(features: DataFrame) -> DataFrame:
    """Properties of features as columns, the geometry last."""
    names = features.schema["properties"].dataType.names
    return features.select(*[F.col("properties").getField(n).alias(n) for n in names], "geometry")


def union_layers(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Layers of one source under each other, each row with its layer in ``src_layer``."""
    tagged = [df.withColumn("src_layer", F.lit(name)) for name, df in layers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def select_columns(df: DataFrame, columns: Sequence[int | str] | None) -> DataFrame:
    """Columns by position or name, each once; unknown ones are left out, none asked for gives an empty table."""
    if columns is None:
        return df
    if not columns:
        return df.select().limit(0)
    names = [df.columns[c] if isinstance(c, int) else c for c in columns if not isinstance(c, int) or 0 <= c < len(df.columns)]
    return df.select(*[F.col(f"`{n}`") for n in dict.fromkeys(names) if n in df.columns])


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv": read_delimited,
    "tsv": read_delimited,
    "parquet": lambda spark, path: spark.read.parquet(path),
    "json": read_json,
    "geojson": read_geojson,
}


def read_table(spark: SparkSession, path: str, columns: Sequence[int | str] | None = None) -> DataFrame:
    """Read a file by its extension."""
    reader = READERS.get(extension(path))
    if reader is None:
        raise UnreadableFile(f"{path}: no reader for this format")
    return select_columns(reader(spark, path), columns)


def read_head(spark: SparkSession, path: str, rows: int = 20, columns: Sequence[int | str] | None = None) -> DataFrame:
    """First rows of a file, without geometry; the limit and the columns reach the scan."""
    table = read_table(spark, path)
    if extension(path) in ("geojson", "shp", "kml", "kmz", "gpx", "fgb", "zip"):
        table = table.drop("geometry")
    return select_columns(table, columns).limit(rows)
