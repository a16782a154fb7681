"""Vertices of geometry columns in any of their forms: WKT, GeoJSON text or structs, and well-known binary.

Result rows are (keys, is_point, x, y): ``is_point`` tells points and multipoints from lines, areas and collections.
Text forms are taken apart by built-in functions; well-known binary by a cursor over its bytes, in Arrow batches.  A value
that cannot be read, or that ends early, has no vertices; third and fourth coordinates are not used.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.functions import geometry
from colonnade.functions.text import strip

_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
#: Two numbers after an opening bracket or a comma.
_PAIR = rf"[(,]\s*({_NUMBER})\s+({_NUMBER})(?=[\s,)])"
#: Hex digits, escapes, or a byte order as a character; no WKT begins like that.
_BINARY = r"^(?:[0-9A-Fa-f]+$|\\x|[\u0000\u0001])"
_WKT_KIND = r"^(?:SRID=\d+;)?\s*([A-Z]+)"
_POINTS = ("POINT", "MULTIPOINT")
#: Levels of nesting of the coordinates of each type.
_DEPTHS = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}
_VERTEX = "array<struct<x: double, y: double>>"


def geometry_vertices(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Vertices (keys, is_point, x, y) of a geometry column of any type."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, T.BinaryType):
        return wkb_vertices(df.select(*keys, value.alias("wkb")), keys)
    if isinstance(kind, T.StringType):
        return text_vertices(df, keys, value)
    if isinstance(kind, T.StructType) and isinstance(kind["coordinates"].dataType, T.VariantType):
        members = value["geometries"] if "geometries" in kind.names else F.lit(None).cast("variant")
        return _unpacked(df.select(*keys, value["type"].alias("type"), value["coordinates"].alias("c"), members.alias("g")), keys)
    typed = F.to_variant_object(value["coordinates"])
    return _unpacked(df.select(*keys, value["type"].alias("type"), typed.alias("c"), F.lit(None).cast("variant").alias("g")), keys)


def holds_geometries(kind: T.DataType) -> bool:
    """Whether a column of this type can be read for vertices."""
    return isinstance(kind, (T.BinaryType, T.StringType)) or (isinstance(kind, T.StructType) and {"type", "coordinates"} <= set(kind.names))


def text_vertices(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Vertices of geometries written as text: WKT, GeoJSON, or binary in hex digits, escapes or bytes as characters."""
    texts = df.select(*keys, strip(value).alias("t"), value.alias("raw")).where("t IS NOT NULL")
    is_json = F.col("t").startswith("{")
    parsed = texts.where(is_json).select(*keys, F.try_parse_json("t").alias("v"))
    whole = F.coalesce(F.try_variant_get("v", "$.geometry", "variant"), F.col("v"))  # a feature holds its geometry
    parsed = parsed.select(*keys, whole.alias("v")).select(
        *keys, F.try_variant_get("v", "$.type", "string").alias("type"), F.try_variant_get("v", "$.coordinates", "variant").alias("c"),
        F.try_variant_get("v", "$.geometries", "variant").alias("g"),
    )
    is_binary = F.col("raw").rlike(_BINARY)
    wkt = texts.where(~is_json & ~is_binary).select(
        *keys, F.regexp_extract(F.upper(F.substring("t", 1, 64)), _WKT_KIND, 1).isin(*_POINTS).alias("is_point"), "t"
    )
    x, y = (F.regexp_extract_all("t", F.lit(_PAIR), F.lit(i)) for i in (1, 2))
    wkt = wkt.select(*keys, "is_point", F.explode(F.arrays_zip(x.alias("x"), y.alias("y"))).alias("p"))
    wkt = wkt.select(*keys, "is_point", F.col("p.x").cast("double").alias("x"), F.col("p.y").cast("double").alias("y"))
    binary = texts.where(~is_json & is_binary).select(*keys, geometry.wkb_bytes(F.col("raw")).alias("wkb"))
    return wkt.unionByName(_unpacked(parsed, keys)).unionByName(wkb_vertices(binary, keys))


def _unpacked(parsed: DataFrame, keys: list[str], collected: bool = False) -> DataFrame:
    """Vertices of GeoJSON geometries: (keys, type, c: coordinates, g: members of a collection), the latter two variants."""

    def at_depth(depth: int) -> Column:
        nested = F.try_variant_get("c", "$", "array<" * (depth + 1) + "double" + ">" * (depth + 1))
        if depth == 0:
            nested = F.array(nested)
        for _ in range(depth - 1):
            nested = F.flatten(nested)
        return F.transform(nested, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))).cast(_VERTEX)

    found = reduce(
        lambda column, depth: column.when(F.col("type").isin(*[t for t, d in _DEPTHS.items() if d == depth]), at_depth(depth)),
        sorted(set(_DEPTHS.values())), F.when(F.lit(False), F.lit(None).cast(_VERTEX)),
    )
    is_point = F.lit(False) if collected else F.col("type").isin("Point", "MultiPoint")
    own = parsed.select(*keys, is_point.alias("is_point"), F.inline(found)).where("x IS NOT NULL AND y IS NOT NULL")
    if collected:
        return own
    members = parsed.where("type = 'GeometryCollection'").select(*keys, F.explode(F.try_variant_get("g", "$", "array<variant>")).alias("m"))
    members = members.select(
        *keys, F.try_variant_get("m", "$.type", "string").alias("type"), F.try_variant_get("m", "$.coordinates", "variant").alias("c"),
        F.lit(None).cast("variant").alias("g"),
    )
    return own.unionByName(_unpacked(members, keys, collected=True))


class _Cursor:
    """A place in the bytes of a well-known binary geometry."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def header(self) -> tuple[str, int, int]:
        """Byte order, base type and numbers for each vertex; the reference system, if named, is passed over."""
        order = {0: ">", 1: "<"}[self.data[self.at]]
        (code,) = struct.unpack_from(order + "I", self.data, self.at + 1)
        self.at += 9 if code & 0x20000000 else 5
        base = code & 0x1FFFFFFF
        extra = {0: 0, 1: 1, 2: 1, 3: 2}[base // 1000]
        if code & 0xC0000000:
            extra = (code >> 31 & 1) + (code >> 30 & 1)
        return order, base % 1000, 2 + extra

    def count(self, order: str) -> int:
        """A number of parts that follow."""
        (n,) = struct.unpack_from(order + "I", self.data, self.at)
        self.at += 4
        return n

    def vertices(self, order: str, n: int, size: int) -> np.ndarray:
        """The first two numbers of each of n vertices."""
        flat = np.frombuffer(self.data, order + "f8", n * size, self.at)
        self.at += 8 * n * size
        return flat.reshape(n, size)[:, :2]


def decode_wkb(data: bytes | None) -> tuple[bool, np.ndarray]:
    """Whether a well-known binary geometry is of points only, and its vertices, one row each."""
    parts, kind, left = [np.zeros((0, 2))], 0, 1
    try:
        cursor = _Cursor(data or b"")
        while left:
            left -= 1
            order, base, size = cursor.header()
            kind = kind or base
            if base == 1:
                parts.append(cursor.vertices(order, 1, size))
            elif base == 2:
                parts.append(cursor.vertices(order, cursor.count(order), size))
            elif base == 3:
                parts += [cursor.vertices(order, cursor.count(order), size) for _ in range(cursor.count(order))]
            elif 4 <= base <= 7:
                left += cursor.count(order)
            else:
                return False, parts[0]
    except (KeyError, IndexError, ValueError, struct.error):  # not such a geometry, or its end is missing
        return False, parts[0]
    found = np.vstack(parts).astype(float)
    return kind in (1, 4), found[~np.isnan(found).any(axis=1)]  # an empty point has no numbers


def wkb_vertices(df: DataFrame, keys: list[str]) -> DataFrame:
    """Vertices of well-known binary in the column ``wkb``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [decode_wkb(v.as_py()) for v in batch.column("wkb")]
            sizes = np.array([len(p) for _, p in found], dtype=np.int64)
            points = np.vstack([np.zeros((0, 2)), *[p for _, p in found]])
            rows = pa.array(np.repeat(np.arange(len(found)), sizes))
            kinds = pa.array(np.repeat(np.array([k for k, _ in found], dtype=bool), sizes))
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(rows) for k in keys], kinds, pa.array(points[:, 0]), pa.array(points[:, 1])], [*keys, "is_point", "x", "y"])

    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("is_point", T.BooleanType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    return df.select(*keys, "wkb").mapInArrow(run, schema)
