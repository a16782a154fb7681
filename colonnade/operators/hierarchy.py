"""Roll-ups over level hierarchies and theme paths."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colonnade.functions import fixed
from colonnade.functions.text import strip, theme_slug

HIERARCHY_SCHEMA = "dim string, path_id int, pos int, level string, level_name string"
THEME_SCHEMA = "path string, depth int, is_leaf boolean"


def hierarchy_table(spark: SparkSession, hierarchies: Mapping[str, Sequence] = fixed.HIERARCHIES) -> DataFrame:
    """Hierarchy paths as rows; aliases of a level share its position and name."""
    rows = []
    for dim, paths in hierarchies.items():
        for path_id, path in enumerate(paths):
            for pos, entry in enumerate(path):
                aliases = entry if isinstance(entry, (tuple, list)) else (entry,)
                rows += [(dim, path_id, pos, alias, aliases[0]) for alias in aliases]
    return spark.createDataFrame(rows, HIERARCHY_SCHEMA)


def _picks(levels: DataFrame, hierarchy: DataFrame, dim: str, key: str, specific: bool) -> DataFrame:
    """Most specific or most general level of each key on every path, with all picks and the path's level names."""
    paths = hierarchy.where(F.col("dim") == dim)
    names = paths.groupBy("path_id").agg(F.collect_set("level_name").alias("path_names"))
    choose = F.max_by if specific else F.min_by
    picked = (
        levels.select(key, "level").distinct()
        .join(paths, "level")
        .groupBy(key, "path_id")
        .agg(choose("level_name", "pos").alias("pick"))
        .join(names, "path_id")
    )
    # a key has one pick per path, so these windows hold as many rows as there are paths
    over_key = W.partitionBy(key)
    return picked.withColumn("picks", F.collect_set("pick").over(over_key)).withColumn(
        "on_path", F.size(F.array_except("picks", "path_names")) == 0
    )


def granularity_rollup(levels: DataFrame, hierarchy: DataFrame, dim: str, key: str = "dataset_id") -> DataFrame:
    """Granularity of each key from its levels: (key, granularity).

    The most specific level per path; when one path holds all picks that path decides, else the first path does.
    """
    return (
        _picks(levels, hierarchy, dim, key, specific=True)
        .groupBy(key)
        .agg(F.min_by("pick", F.struct(~F.col("on_path"), "path_id")).alias("granularity"))
    )


def scope_rollup(levels: DataFrame, hierarchy: DataFrame, dim: str, key: str = "dataset_id") -> DataFrame:
    """Scope levels of each key: (key, scope_pos, level).

    The most general level per path; one level when a single path holds all picks, else every pick once.
    """
    picks = _picks(levels, hierarchy, dim, key, specific=False)
    per_key = picks.groupBy(key).agg(
        F.min_by("pick", F.struct(~F.col("on_path"), "path_id")).alias("first"),
        F.max("on_path").alias("single"),
        F.array_sort(F.collect_list(F.struct("path_id", "pick"))).alias("ordered"),
    )
    scope = F.when(F.col("single"), F.array("first")).otherwise(F.array_distinct("ordered.pick"))
    return per_key.select(key, F.posexplode(scope).alias("scope_pos", "level"))


def theme_table(spark: SparkSession, tree: Mapping) -> DataFrame:
    """Theme tree as rows (path, depth, is_leaf)."""

    def walk(node: Mapping, prefix: tuple[str, ...]) -> Iterator[tuple[str, int, bool]]:
        for name, below in node.items():
            path = (*prefix, name)
            yield " > ".join(path), len(path), not below
            yield from walk(below, path)

    return spark.createDataFrame(list(walk(tree, ())), THEME_SCHEMA)


def theme_levels(path: Column, separators: str = fixed.THEME_SEPARATORS) -> Column:
    """Trimmed, non-empty levels of a theme path."""
    trimmed = F.transform(F.split(path, separators), lambda level: strip(level))
    return F.filter(trimmed, lambda level: level != "")


def theme_path(path: Column) -> Column:
    """Theme path in its normal form ``A > B > C``; null when it has no level."""
    return F.nullif(F.array_join(theme_levels(path), " > "), F.lit(""))


def theme_name(theme: Column, fields: Sequence[str]) -> Column:
    """Name of a theme given as a struct: the first of its name fields that is filled."""
    return F.coalesce(*[F.nullif(theme[f], F.lit("")) for f in ("themeName", "name", "title", "theme_name") if f in fields])


def theme_set(themes: DataFrame, key: str = "dataset_id", theme: str = "theme", nodes: DataFrame | None = None) -> DataFrame:
    """Distinct normal theme paths per key.

    With ``nodes``, a path listed as a node keeps separators inside its level names.
    """
    rows = themes.where(F.col(theme).isNotNull()).select(key, F.col(theme).alias("raw")).distinct()
    whole = F.array_join(theme_levels(F.col("raw"), ">"), " > ")
    if nodes is not None:
        listed = nodes.select(F.col("path").alias("listed")).distinct()
        rows = rows.withColumn("whole", whole).join(listed, F.col("whole") == F.col("listed"), "left")
        chosen = F.coalesce("listed", theme_path(F.col("raw")))
    else:
        chosen = theme_path(F.col("raw"))
    return rows.select(key, chosen.alias("theme")).where("theme IS NOT NULL").distinct()


def common_theme(themes: DataFrame, key: str = "dataset_id", theme: str = "theme") -> DataFrame:
    """Longest common prefix of the theme paths of each key; keys without one are absent."""
    levels = themes.select(key, theme).distinct().select(key, theme, F.posexplode(theme_levels(F.col(theme), ">")).alias("pos", "level"))
    totals = themes.select(key, theme).distinct().groupBy(key).agg(F.count("*").alias("n_paths"))
    shared = (
        levels.groupBy(key, "pos")
        .agg(F.min("level").alias("level"), F.max("level").alias("other"), F.count("*").alias("n"))
        .join(totals, key)
        .withColumn("same", ((F.col("level") == F.col("other")) & (F.col("n") == F.col("n_paths"))).cast("int"))
        # one row per level of the deepest path
        .withColumn("all_same", F.min("same").over(W.partitionBy(key).orderBy("pos")))
        .where("all_same = 1")
    )
    return shared.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "level"))), lambda x: x["level"]), " > ").alias("prefix")
    )


def valid_paths(paths: DataFrame, nodes: DataFrame, path: str = "path") -> DataFrame:
    """Rows whose path is a node of the theme tree."""
    listed = nodes.select(F.col("path").alias("listed")).distinct()
    return paths.join(listed, F.col(path) == F.col("listed"), "left_semi")


def raw_zone_path(prefix: Column, file_name: Column, root: str = fixed.RAW_ZONE_ROOT) -> Column:
    """Storage path of a dataset from its common theme path."""
    slugs = F.array_join(F.transform(theme_levels(prefix, ">"), lambda level: theme_slug(level)), "/")
    folder = F.coalesce(F.nullif(slugs, F.lit("")), F.lit(fixed.UNCLASSIFIED))
    return F.concat_ws("/", F.lit(root), folder, file_name)
