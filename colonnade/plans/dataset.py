"""Dataset records: scopes, granularities, themes, storage path and nested attributes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions import fixed
from colonnade.functions.geometry import point_wkt
from colonnade.functions.numbers import human_size, scope_text
from colonnade.functions.periods import file_name_periods
from colonnade.operators import hierarchy as rollups
from colonnade.operators import spatial
from colonnade.operators.lookups import free_name
from colonnade.operators.profile import Profiled, column_profile
from colonnade.operators.reference import file_name_levels
from colonnade.operators.temporal import mixed_period_ranges
from colonnade.operators.vertices import geometry_vertices, holds_geometries
from colonnade.plans.clock import Clock
from colonnade.session import stage

_NO_VALUES = {"geometry", "geopoint", "latlon_pair"}


def dimension_levels(attributes: DataFrame, role: str) -> DataFrame:
    """Levels found in each dataset: (dataset_id, level); a mixed column contributes all of its levels."""
    found = F.when(F.size("mixed_levels") > 0, F.col("mixed_levels")).otherwise(F.array("granularity"))
    return (
        attributes.where((F.col("role") == role) & (F.col("granularity") != ""))
        .select("dataset_id", F.explode(found).alias("level"))
        .where("level IS NOT NULL")
        .distinct()
    )


def file_name_attributes(titles: DataFrame, attributes: DataFrame, hierarchy: DataFrame, keys: DataFrame) -> DataFrame:
    """Attributes read from the dataset title where the data has no temporal or no spatial parameter.

    ``titles`` maps dataset_id to title.  Result: (dataset_id, role, column, granularity, scope_values, confidence).
    """
    parts = []
    for role, prefix, confidence in (("temporal", "METADATA_TEMPORAL_", 0.95), ("spatial", "METADATA_SPATIAL_", 0.96)):
        known = attributes.where((F.col("role") == role) & (F.col("granularity") != "")).select("dataset_id").distinct()
        missing = titles.join(known, "dataset_id", "left_anti")
        if role == "temporal":
            hints = missing.select("dataset_id", F.inline(file_name_periods(F.col("title"))))
        else:
            found = file_name_levels(missing.select("title").distinct(), keys, name="title")
            hints = missing.join(found, "title").select("dataset_id", "granularity", "value")
        chosen = rollups.granularity_rollup(
            hints.select("dataset_id", F.col("granularity").alias("level")), hierarchy, role
        )
        values = hints.join(chosen, ["dataset_id", "granularity"]).groupBy("dataset_id", "granularity").agg(
            F.sort_array(F.collect_set("value")).alias("scope_values")
        )
        parts.append(
            values.select(
                "dataset_id", F.lit(role).alias("role"),
                F.concat(F.lit(prefix), F.upper("granularity")).alias("column"), "granularity", "scope_values",
                F.lit(confidence).alias("confidence"),
                F.lit(f"filename_{role}_hint_materialized").alias("matched_by"),
            )
        )
    return parts[0].unionByName(parts[1])


def add_constant_column(df: DataFrame, base: str, value: str) -> DataFrame:
    """Add a constant column under a name that is not taken."""
    return df.withColumn(free_name(df.columns, base), F.lit(value))


def with_file_name_attributes(attributes: DataFrame, found: DataFrame) -> DataFrame:
    """Attributes with those read from the title appended."""
    extra = found.select(
        "dataset_id", F.array("column").alias("columns"), "role",
        F.concat(F.initcap("role"), F.lit(" parameter derived from the dataset file name.")).alias("description"),
        "granularity", "matched_by", "confidence",
        F.concat(F.lit("File name contains "), F.col("granularity"), F.lit(" value '"), F.col("scope_values")[0], F.lit("'.")).alias("evidence"),
        F.array(F.lit("constant")).alias("type"), "scope_values",
    )
    return attributes.unionByName(extra, allowMissingColumns=True)


def spatial_scope(
    attributes: DataFrame, profiled: Profiled, mixed: DataFrame | None, scope_levels: DataFrame
) -> DataFrame:
    """Distinct spatial scope values by level: (dataset_id, level, value); coordinates are left to the extent."""
    wanted = attributes.where(F.col("role") == "spatial").join(
        scope_levels.select("dataset_id", F.col("level").alias("scope_level")), "dataset_id"
    )
    own = wanted.where(F.col("granularity") == F.col("scope_level"))
    by_list = (F.col("matched_by") == "code") | F.startswith("matched_by", F.lit(fixed.LABEL_SOURCES["none"]))
    given = own.where("scope_values IS NOT NULL").select(
        "dataset_id", F.col("scope_level").alias("level"), F.explode("scope_values").alias("value")
    )
    labelled = own.where(
        F.col("scope_values").isNull() & (F.coalesce(F.size("mixed_levels"), F.lit(0)) == 0) & ~F.col("granularity").isin(*_NO_VALUES)
    ).select("dataset_id", "cid", F.col("scope_level").alias("level"), F.coalesce(by_list, F.lit(False)).alias("coded"))
    # a code or a label keeps its padding, so that it still joins its list
    shown = F.when(F.col("coded") & F.col("v").rlike("^0[0-9]"), F.col("v")).otherwise(scope_text(F.col("v")))
    read = profiled.texts_of(labelled).where("present").select("cid", "v").join(labelled, "cid")
    plain = read.select("dataset_id", "level", shown.alias("value")).distinct()
    parts = [given, plain]
    if mixed is not None:
        levels = wanted.where("mixed_levels IS NOT NULL AND scope_values IS NULL").select("dataset_id", "cid", "scope_level")
        parts.append(
            mixed.join(levels, "cid").where(F.col("level") == F.col("scope_level")).select("dataset_id", "level", "value")
        )
    return reduce(DataFrame.unionByName, parts).distinct()


def coordinate_extents(tables: Mapping[str, DataFrame], attributes: DataFrame, scope_levels: DataFrame) -> DataFrame | None:
    """Extents of the coordinate columns in scope: (dataset_id, value) as WKT; None when no dataset has any.

    Points are a row each.  Columns of lines and areas, in whatever form, give the envelope of all their vertices.
    """
    kinds = dict.fromkeys(("geometry", "latlon_pair"))
    wanted = (
        attributes.where((F.col("role") == "spatial") & F.col("granularity").isin(*kinds) & F.col("cid").isNotNull())
        .join(scope_levels.select("dataset_id", F.col("level").alias("granularity")), ["dataset_id", "granularity"])
        .select("dataset_id", "granularity", "columns")
    )
    points, shapes = [], []
    for row in wanted.toLocalIterator():  # one row per coordinate attribute: names, not data
        df = tables[row["dataset_id"]].withColumn("dataset_id", F.lit(row["dataset_id"]))
        if row["granularity"] == "latlon_pair":
            points.append(spatial.coordinate_points(df, ["dataset_id"], *row["columns"]))
        elif holds_geometries(df.schema[row["columns"][0]].dataType):
            found = geometry_vertices(df, ["dataset_id"], row["columns"][0])
            points.append(found.where("is_point").select("dataset_id", "x", "y"))
            shapes.append(found.where("NOT is_point"))
    if not points:
        return None
    single = reduce(DataFrame.unionByName, points).distinct().select("dataset_id", point_wkt(F.col("x"), F.col("y")).alias("value"))
    if not shapes:
        return single
    return single.unionByName(spatial.envelope(reduce(DataFrame.unionByName, shapes), ["dataset_id"]).select("dataset_id", F.col("wkt").alias("value")))


def temporal_scope(attributes: DataFrame, profiled: Profiled, scope_levels: DataFrame) -> DataFrame:
    """Contiguous period ranges: (dataset_id, column, granularity, start_label, end_label)."""
    wanted = attributes.where(F.col("role") == "temporal").join(
        scope_levels.select("dataset_id", F.col("level").alias("granularity")), ["dataset_id", "granularity"]
    )
    named = wanted.select("dataset_id", "cid", F.col("columns")[0].alias("column"), "granularity", "scope_values")
    read = named.where("scope_values IS NULL").drop("scope_values")
    from_data = profiled.texts_of(read).where("present").select("cid", F.col("v").alias("token")).join(read, "cid")
    given = named.where("scope_values IS NOT NULL").select(
        "dataset_id", "column", "granularity", F.explode("scope_values").alias("token")
    )
    tokens = from_data.select("dataset_id", "column", "granularity", "token").unionByName(given)
    return mixed_period_ranges(tokens, ["dataset_id", "column"], "token", "granularity")


def dataset_records(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    profiled: Profiled,
    attributes: DataFrame,
    files: DataFrame,
    keys: DataFrame,
    *,
    mixed: DataFrame | None = None,
    hierarchy: DataFrame | None = None,
    theme_nodes: DataFrame | None = None,
    categories: DataFrame | None = None,
    root: str = fixed.RAW_ZONE_ROOT,
    profile: DataFrame | None = None,
    clock: Clock | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records and scope rows: (one nested row per dataset, one row per scope value or period range).

    ``files`` describes the datasets: dataset_id, title and optionally fileType, dataFormat, fileSizeBytes and the
    source fields.  The scope rows hold all values; a record names its levels and how many values each has.  A level or
    period read from the title counts as a column: it is one of the data where that is written anew.
    """
    clock = clock or Clock()
    with clock.step("scopes_granularities_sec"):
        attributes, scopes, parts, named = _scopes(spark, tables, profiled, attributes, files, keys, mixed, hierarchy)
    with clock.step("find_common_theme_sec"):
        themes = stage(
            rollups.theme_set(attributes.where("role IN ('indicator', 'other')").select("dataset_id", "theme"), nodes=theme_nodes), "themes"
        )
        prefix = stage(rollups.common_theme(themes), "prefix")
    theme_lists = themes.groupBy("dataset_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("theme").alias("themeName"), F.col("theme").alias("themeDescription")))).alias("themes")
    )
    if categories is not None:
        attributes = attributes.join(categories, "cid", "left")
    nested = attributes.groupBy("dataset_id").agg(
        F.sort_array(F.collect_list(F.struct(
            F.coalesce("col_pos", F.lit(1 << 20)).alias("position"), "role", "columns", "description", "type", "granularity",
            "matched_by", "confidence", "evidence", "indicator_type", "subtype", "theme",
            F.struct(F.col("value_min").alias("min"), F.col("value_max").alias("max")).alias("value_range"),
            *(["categories_sample"] if categories is not None else []), "mixed_levels", "reason", "avg_text_len",
            F.get("scope_values", F.lit(0)).alias("constant"),
        ))).alias("attributes")
    )
    sizes = profiled.columns.groupBy("dataset_id").agg(
        F.count(F.when(F.col("address_parts").isNull(), 1)).alias("plain_columns"),
        F.sum(F.coalesce(F.size("address_parts"), F.lit(0))).alias("part_columns"),
    )
    first_column = profiled.columns.groupBy("dataset_id").agg(F.min("cid").alias("cid"))
    profile = column_profile(profiled, ()) if profile is None else profile
    rows = first_column.join(profile.select("cid", F.col("n_rows").alias("nRows")), "cid", "left").select(
        "dataset_id", F.coalesce("nRows", F.lit(0)).alias("nRows")
    )

    record = files
    constants = named.groupBy("dataset_id").agg(F.count("*").alias("constants"))
    for part in (*parts, _nested_scopes(scopes, "spatial"), _nested_scopes(scopes, "temporal"), theme_lists, prefix, nested, sizes, rows, constants):
        record = record.join(part, "dataset_id", "left")
    part_columns = F.when(F.col("part_columns") > 0, F.col("part_columns")).otherwise(0)
    constants = F.coalesce("constants", F.lit(0))
    record = record.withColumn("nCols", (F.col("plain_columns") + part_columns + constants).cast("int")).withColumn("nRecords", F.col("nRows"))
    record = record.withColumn("rawzonePath", rollups.raw_zone_path(F.col("prefix"), F.col("title"), root))
    if "fileType" in files.columns:
        record = record.withColumn("nFeatures", F.when(F.col("fileType").isin(".geojson", ".zip"), F.col("nRows")))
    if "fileSizeBytes" in files.columns:
        record = record.withColumn("fileSizeHuman", human_size(F.col("fileSizeBytes")))
    return record.drop("plain_columns", "part_columns", "constants"), scopes


def _scopes(spark, tables, profiled, attributes, files, keys, mixed, hierarchy):
    """Attributes with those of the titles, scope rows, granularities by dimension, and the attributes of the titles alone."""
    hierarchy = rollups.hierarchy_table(spark) if hierarchy is None else hierarchy
    named = file_name_attributes(files.select("dataset_id", "title"), attributes, hierarchy, keys)
    named = stage(named, "named")
    attributes = stage(with_file_name_attributes(attributes, named), "attributes")
    space, time = dimension_levels(attributes, "spatial"), dimension_levels(attributes, "temporal")
    space_scope, time_scope = (rollups.scope_rollup(lv, hierarchy, d) for lv, d in ((space, "spatial"), (time, "temporal")))
    space_scope, time_scope = stage(space_scope, "space"), stage(time_scope, "time")
    space_gran = rollups.granularity_rollup(space, hierarchy, "spatial").withColumnRenamed("granularity", "spatialGranularity")
    time_gran = rollups.granularity_rollup(time, hierarchy, "temporal").withColumnRenamed("granularity", "temporalGranularity")

    values = spatial_scope(attributes, profiled, mixed, space_scope)
    points = coordinate_extents(tables, attributes, space_scope)
    if points is not None:
        values = values.unionByName(points.select("dataset_id", F.lit("geometry_extent").alias("level"), "value"))
    ranges = temporal_scope(attributes, profiled, time_scope)
    scopes = values.select(
        "dataset_id", F.lit("spatial").alias("dim"), "level", "value", F.lit(None).cast("string").alias("end_value")
    ).unionByName(
        ranges.select(
            "dataset_id", F.lit("temporal").alias("dim"), F.col("granularity").alias("level"),
            F.col("start_label").alias("value"), F.col("end_label").alias("end_value"),
        )
    )
    return attributes, stage(scopes, "scopes"), (space_gran, time_gran), named


def _nested_scopes(scopes: DataFrame, dim: str) -> DataFrame:
    """Scope levels of each dataset with the number of their distinct values; the values are rows of ``scopes``."""
    counted = scopes.where(F.col("dim") == dim).groupBy("dataset_id", "level").agg(F.count("*").alias("nValues"))
    level = F.struct(F.col("level").alias(f"{dim}ScopeLevel"), "nValues")
    return counted.groupBy("dataset_id").agg(F.sort_array(F.collect_list(level)).alias(f"{dim}Scope"))
