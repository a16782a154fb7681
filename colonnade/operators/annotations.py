"""Column annotations: inheritance from a series backbone, upserts, validity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colonnade.functions.text import column_key
from colonnade.operators.detect import sample_profile

SAMPLE_MEASURES = ("plain_count", "parsable_time")
ANNOTATION_SCHEMA = (
    "dataset_id string, column string, meaning string, is_spatial boolean, is_temporal boolean, is_indicator boolean, "
    "is_other_information boolean, indicator_type string, thematic_path string, semantic_source string"
)
BACKBONE_SCHEMA = (
    "series_hint string, column_name_normalized string, meaning string, is_spatial boolean, is_temporal boolean, "
    "is_indicator boolean, is_other_information boolean, indicator_type string, thematic_path string"
)
_FIELDS = (
    "meaning", "is_spatial", "is_temporal", "is_indicator", "is_other_information", "indicator_type", "thematic_path",
)


def inherit(profile: DataFrame, backbone: DataFrame, series: DataFrame) -> DataFrame:
    """Annotations inherited by column name within a series, unless the values contradict them.

    ``series`` maps (dataset_id, series_hint).  Columns that inherit nothing are those of :func:`unmatched`.
    """
    named = profile.join(series, "dataset_id").withColumn("column_name_normalized", F.col("name_key"))
    found = named.join(backbone, ["series_hint", "column_name_normalized"])
    kind = sample_profile()
    conflict = (
        (F.coalesce("is_temporal", F.lit(False)) & (kind == "empty"))
        | (F.coalesce("is_indicator", F.lit(False)) & (kind == "empty"))
        | (F.coalesce("is_spatial", F.lit(False)) & (kind == "empty"))
        | (F.coalesce("is_other_information", F.lit(False)) & (kind == "numeric"))
    )
    return found.where(~conflict).select(
        "dataset_id", "column", *_FIELDS, F.lit("backbone").alias("semantic_source")
    )


def unmatched(columns: DataFrame, inherited: DataFrame) -> DataFrame:
    """Columns without an inherited annotation."""
    return columns.join(inherited, ["dataset_id", "column"], "left_anti")


def combine(inherited: DataFrame, inferred: DataFrame) -> DataFrame:
    """Inherited and newly inferred annotations, with the normalised column name."""
    return inherited.unionByName(inferred, allowMissingColumns=True).withColumn(
        "column_name_normalized", column_key(F.col("column"))
    )


def upsert_backbone(backbone: DataFrame, inferred: DataFrame) -> DataFrame:
    """Backbone with newly inferred rows; a new row replaces the old one of its series and column name."""
    keys = ["series_hint", "column_name_normalized"]
    fresh = inferred.withColumn("column_name_normalized", column_key(F.col("column")))
    tagged = backbone.withColumn("_new", F.lit(0)).unionByName(
        fresh.select(*[c for c in backbone.columns if c in fresh.columns]).withColumn("_new", F.lit(1)),
        allowMissingColumns=True,
    )
    order = W.partitionBy(*keys).orderBy(F.desc("_new"), *[F.col(f) for f in _FIELDS if f in backbone.columns])
    return tagged.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank", "_new")


def check(annotations: DataFrame, nodes: DataFrame, root: str | None = None) -> DataFrame:
    """Validity of each annotation: one class, type only for indicators, path listed and given where required."""
    flags = ("is_spatial", "is_temporal", "is_indicator", "is_other_information")
    classes = sum((F.coalesce(F.col(f), F.lit(False)).cast("int") for f in flags), F.lit(0))
    listed = nodes.select(F.col("path").alias("thematic_path")).distinct().withColumn("_listed", F.lit(True))
    checked = annotations.join(listed, "thematic_path", "left")
    path = F.col("thematic_path")
    rooted = path.startswith(root) if root else F.lit(True)
    result = (
        checked.withColumn("one_class", classes == 1)
        .withColumn("type_ok", F.coalesce(F.col("is_indicator"), F.lit(False)) | F.col("indicator_type").isNull())
        .withColumn("path_ok", path.isNull() | (F.col("_listed").isNotNull() & rooted))
        .withColumn("path_given", ~F.coalesce(F.col("is_indicator"), F.lit(False)) | path.isNotNull())
    )
    valid = F.col("one_class") & F.col("type_ok") & F.col("path_ok") & F.col("path_given")
    return result.withColumn("valid", valid).drop("_listed")
