"""Coordinate pairs, spatial extents and scope values."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.functions import fixed, geometry
from colonnade.functions.names import coordinate_hint
from colonnade.functions.numbers import coordinate_number, ratio, scope_text

HULL_STATE_POINTS = 200_000


def coordinate_pairs(
    profile: DataFrame, *, min_score: float = fixed.COORDINATE_SCORE_MIN, numeric_fallback: bool = False
) -> DataFrame:
    """Coordinate column pairs: (dataset_id, kind, first_column, second_column, score, first_pos, second_pos).

    The first column is the latitude (or y), the second the longitude (or x).  The join is between columns of one
    dataset, not between rows.
    """
    axes = profile.select(
        "dataset_id", "column", "col_pos",
        *[ratio(F.col(axis), F.col("coord_count")).alias(axis + "_share") for axis in fixed.COORDINATE_RANGES],
        *[coordinate_hint(F.col("column"), axis).alias(axis + "_name") for axis in fixed.COORDINATE_RANGES],
        (F.col("kind").isin("integer", "double", "boolean") | (ratio(F.col("coord_count"), F.col("n_rows")) > 0.7)).alias(
            "numeric_like"
        ),
    )
    # only columns that can be an axis meet, not all columns of a dataset
    loose = F.col("numeric_like") if numeric_fallback else F.lit(False)
    a = axes.where(F.col("lat_name") | F.col("y_name") | loose).alias("a")
    b = axes.where(F.col("lon_name") | F.col("x_name") | loose).alias("b")
    pairs = a.join(b, (F.col("a.dataset_id") == F.col("b.dataset_id")) & (F.col("a.column") != F.col("b.column")))
    both_numeric = F.col("a.numeric_like") & F.col("b.numeric_like") if numeric_fallback else F.lit(False)

    def candidate(kind: str, first: str, second: str) -> Column:
        named = (F.col(f"a.{first}_name") & F.col(f"b.{second}_name")) | both_numeric
        score = (F.col(f"a.{first}_share") + F.col(f"b.{second}_share")) / 2.0
        return F.when(
            named & (score >= min_score), F.struct(F.lit(kind).alias("kind"), score.alias("score"))
        )

    return pairs.select(
        F.col("a.dataset_id").alias("dataset_id"),
        F.col("a.column").alias("first_column"),
        F.col("b.column").alias("second_column"),
        F.col("a.col_pos").alias("first_pos"),
        F.col("b.col_pos").alias("second_pos"),
        F.inline(F.array_compact(F.array(candidate("geo", "lat", "lon"), candidate("proj", "y", "x")))),
    )


def best_pair(pairs: DataFrame) -> DataFrame:
    """Best pair of each dataset: geographic before projected, then score, then column order."""
    order = F.struct(F.col("kind") != "geo", -F.col("score"), "first_pos", "second_pos")
    return pairs.groupBy("dataset_id").agg(
        F.min_by(F.struct("kind", "first_column", "second_column", "score"), order).alias("pair")
    ).select("dataset_id", "pair.*")


def axes_swapped(first: str, second: str) -> bool:
    """The first column name says longitude and the second latitude."""
    first, second = first.lower(), second.lower()
    return any(k in first for k in ("lon", "lng", "x")) and any(k in second for k in ("lat", "y"))


def coordinate_points(df: DataFrame, keys: list[str], lat: str, lon: str) -> DataFrame:
    """Distinct points (keys, x, y) of two coordinate columns; rows without both numbers are no points."""
    if axes_swapped(lat, lon):
        lat, lon = lon, lat
    x, y = (coordinate_number(F.col(f"`{c}`").cast("string")) for c in (lon, lat))
    return df.select(*keys, x.alias("x"), y.alias("y")).where("x IS NOT NULL AND y IS NOT NULL").distinct()


def geometry_points(df: DataFrame, keys: list[str], geom: str) -> DataFrame:
    """Distinct vertices (keys, x, y) of a GeoJSON geometry column."""
    data_type = df.schema[geom].dataType["coordinates"].dataType
    points = df.select(*keys, F.col(f"`{geom}`.coordinates").alias("c"))
    while isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.ArrayType):
        points = points.select(*keys, F.explode("c").alias("c"))
        data_type = data_type.elementType
    return points.select(*keys, F.get("c", F.lit(0)).alias("x"), F.get("c", F.lit(1)).alias("y")).where(
        "x IS NOT NULL AND y IS NOT NULL"
    ).distinct()


def envelope(points: DataFrame, keys: list[str]) -> DataFrame:
    """Bounding box of the points of each key: (keys, min_x, min_y, max_x, max_y, wkt)."""
    box = points.groupBy(*keys).agg(
        F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y")
    )
    return box.withColumn("wkt", geometry.envelope_wkt(F.col("min_x"), F.col("min_y"), F.col("max_x"), F.col("max_y")))


def union_points(points: DataFrame, keys: list[str]) -> DataFrame:
    """Union of the points of each key, one row for each different point: (keys, x, y)."""
    return points.select(*keys, "x", "y").distinct()


def union_wkt(points: DataFrame, keys: list[str]) -> DataFrame:
    """Union of distinct points as one text: (keys, n_points, wkt); for keys whose points are few, else see union_points."""
    pair = F.concat_ws(" ", F.col("x").cast("string"), F.col("y").cast("string"))
    texts = points.groupBy(*keys).agg(
        F.count("*").alias("n_points"),
        F.array_sort(F.collect_list(F.struct("x", "y", F.concat(F.lit("("), pair, F.lit(")")).alias("text")))).alias("p")
    )
    one = geometry.point_wkt(F.col("p")[0]["x"], F.col("p")[0]["y"])
    many = F.concat(F.lit("MULTIPOINT ("), F.array_join("p.text", ", "), F.lit(")"))
    return texts.select(*keys, "n_points", F.when(F.size("p") == 1, one).otherwise(many).alias("wkt"))


def _hull(points: np.ndarray) -> np.ndarray:
    """Vertices of the convex hull, counter-clockwise (Andrew's monotone chain)."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def chain(ordered: np.ndarray) -> list[np.ndarray]:
        kept: list[np.ndarray] = []
        for p in ordered:
            while len(kept) > 1:
                (ax, ay), (bx, by) = kept[-2], kept[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                kept.pop()
            kept.append(p)
        return kept[:-1]

    return np.array(chain(points) + chain(points[::-1]))


#: Primitive vectors of small whole numbers by angle, counter-clockwise from (-1, 0): exact products for whole coordinates.
DIRECTIONS = sorted(
    ((a, b) for a in range(-3, 4) for b in range(-3, 4) if math.gcd(a, b) == 1), key=lambda d: (math.atan2(d[1], d[0]) - math.pi) % math.tau
)


def hull_corners(points: DataFrame, key: str) -> DataFrame:
    """Outermost points of each key in every direction, as the edges between them: (key, first, edges).

    Built-in aggregates alone.  Of equally far points the last one counter-clockwise counts, so each is a vertex of the
    hull.  An edge is (sector, a, b); a direction whose point is also the next one's has none.  ``first`` is the leftmost.
    """
    far = [
        F.max_by(F.struct("x", "y"), F.struct(F.col("x") * a + F.col("y") * b, F.col("y") * a - F.col("x") * b)) for a, b in DIRECTIONS
    ]
    ends = points.groupBy(key).agg(F.array(*far).alias("ends")).withColumn("after", F.concat(F.slice("ends", 2, len(far) - 1), F.slice("ends", 1, 1)))
    edges = F.transform("ends", lambda e, i: F.struct(i.alias("sector"), e.alias("a"), F.get(F.col("after"), i).alias("b")))
    return ends.select(key, F.col("ends")[0].alias("first"), F.filter(edges, lambda e: e["a"] != e["b"]).alias("edges"))


def _turn(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Positive where (x, y) lies left of the way from a to b."""
    return (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])


def hull_candidates(points: DataFrame, corners: DataFrame, key: str) -> DataFrame:
    """Points outside the polygon of the corners with the edge they lie beyond: (key, sector, a, b, x, y).

    A point lies beyond one edge at most, because every corner is outermost in a direction; points inside go here.
    """
    edges = corners.select(F.col(key).alias("_key"), "edges")
    beyond = F.filter("edges", lambda e: _turn(e["a"], e["b"], F.col("x"), F.col("y")) < 0)
    found = points.join(edges, F.col(key).eqNullSafe(F.col("_key"))).select(key, "x", "y", F.get(beyond, F.lit(0)).alias("edge"))
    return found.where("edge IS NOT NULL").select(key, "edge.sector", "edge.a", "edge.b", "x", "y")


def convex_hull(points: DataFrame, key: str) -> DataFrame:
    """Convex hull of the points of each key: (key, pos, x, y), counter-clockwise from the leftmost point.

    The outermost points in fixed directions split the hull into arcs.  Points inside their polygon are dropped before
    anything is shuffled by place; the others belong to one arc each.  Arcs are folded inside each task, then finished
    one by one, so no task holds the hull of a key.  Points without both coordinates are left out.
    """
    points = points.select(key, F.col("x").cast("double"), F.col("y").cast("double")).where("x IS NOT NULL AND y IS NOT NULL")
    corners = hull_corners(points, key)
    flat = hull_candidates(points, corners, key).select(key, "sector", "a.x", "a.y", "b.x", "b.y", "x", "y").toDF(key, "sector", "ax", "ay", "bx", "by", "x", "y")
    group, names = [key, "sector"], flat.columns[2:]

    def arc(group: pd.DataFrame) -> np.ndarray:
        """Vertices between the ends of an edge, from its first to its second."""
        ax, ay, bx, by = group[["ax", "ay", "bx", "by"]].iloc[0]
        hull = _hull(np.vstack([group[["x", "y"]].to_numpy(float), [[ax, ay], [bx, by]]]))
        inner = hull[~((hull == (ax, ay)).all(axis=1) | (hull == (bx, by)).all(axis=1))]
        return inner[np.argsort(inner @ (bx - ax, by - ay), kind="stable")]

    def shorter(part: pd.DataFrame) -> pd.DataFrame:
        """The rows of the vertices of each arc."""
        parts = []
        for _, rows in part.groupby(group, sort=False, dropna=False):
            kept = arc(rows)
            parts.append(rows.iloc[: len(kept)].assign(x=kept[:, 0], y=kept[:, 1]))
        return pd.concat(parts)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if len(batch):
                held = [shorter(pd.concat([*held, batch]))]
                if len(held[0]) > HULL_STATE_POINTS:
                    yield held.pop()
        yield from held

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        kept = arc(rows)
        return pd.DataFrame({key: [rows[key].iloc[0]] * len(kept), "sector": rows["sector"].iloc[0], "n": range(1, len(kept) + 1), "x": kept[:, 0], "y": kept[:, 1]})

    places = T.StructType([flat.schema[key], T.StructField("sector", T.IntegerType()), *[T.StructField(n, T.DoubleType()) for n in names]])
    last = T.StructType([*places.fields[:2], T.StructField("n", T.IntegerType()), *places.fields[-2:]])
    between = flat.mapInPandas(fold, places).groupBy(*group).applyInPandas(finish, last)
    one = F.array(F.struct(F.lit(0).alias("sector"), F.col("first").alias("a"), F.col("first").alias("b")))
    own = corners.select(key, F.explode(F.when(F.size("edges") > 0, F.col("edges")).otherwise(one)).alias("e"))
    hull = own.select(key, "e.sector", F.lit(0).alias("n"), "e.a.x", "e.a.y").unionByName(between)
    # the rows are the vertices alone; a corner that rounding put on a line between its neighbours is none
    order = W.partitionBy(key).orderBy("sector", "n")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    place = F.struct("x", "y")
    near = hull.withColumns(
        {
            "before": F.coalesce(F.lag(place).over(order), F.last(place).over(whole)),
            "after": F.coalesce(F.lead(place).over(order), F.first(place).over(whole)),
            "n_all": F.count("*").over(whole),
        }
    )
    corner = (F.col("n_all") < 3) | (F.col("n") > 0) | (_turn(F.col("before"), F.struct("x", "y"), F.col("after.x"), F.col("after.y")) > 0)
    return near.where(corner).select(key, (F.row_number().over(order) - 1).alias("pos"), "x", "y")


def scope_values(values: DataFrame, group: list[str], value: str = "v", *, drop_padding: bool = True) -> DataFrame:
    """Distinct scope values of a column; with ``drop_padding`` whole numbers print without padding or decimals."""
    shown = scope_text(F.col(value)) if drop_padding else F.col(value)
    return values.where(F.col(value).isNotNull()).select(*group, shown.alias("value")).distinct()


def tuple_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct value tuples of several columns; rows with a null are left out."""
    filled = df.dropna(subset=columns)
    return filled.select(*[scope_text(F.col(f"`{c}`").cast("string")).alias(c) for c in columns]).distinct()


def merge_scopes(scopes: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Merge scope entries of one level: distinct values at their first position (key, level, value, pos)."""
    return scopes.groupBy(key, "level", "value").agg(F.min("pos").alias("pos"))
