"""Classes that the datasets of a series hand on: annotations kept by column name, the series' backbone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.operators import annotations as notes
from colonnade.operators import lookups
from colonnade.operators.profile import Profiled
from colonnade.plans.classify import classify_annotated, to_annotations
from colonnade.session import stage


def inherited_annotations(profile: DataFrame, backbone: DataFrame, series: DataFrame) -> DataFrame:
    """Annotations that the columns of a series inherit, columns of countries made spatial."""
    country = profile.select("dataset_id", "column", F.col("country_values").alias("is_country"))
    return lookups.country_overrides(notes.inherit(profile, backbone, series), country)


def with_given(inherited: DataFrame, given: DataFrame, series: DataFrame, backbone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Inherited annotations before the given ones, and the backbone with those given to columns that inherit nothing."""
    fresh = notes.unmatched(given, inherited)
    return inherited.unionByName(fresh, allowMissingColumns=True), notes.upsert_backbone(backbone, fresh.join(series, "dataset_id"))


def inherit_classes(
    profiled: Profiled, attributes: DataFrame, keys: DataFrame, profile: DataFrame, backbone: DataFrame, series: DataFrame, **options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Attributes with those of inheriting columns classified anew: (attributes, mixed level values, backbone).

    ``attributes`` are the classes by names and values alone.  An attribute of several columns is replaced when all of
    them inherit.  The classes of all other columns of a series join its backbone.
    """
    found = stage(inherited_annotations(profile, backbone, series), "inherited")
    hits = found.select("dataset_id", "column").distinct().withColumn("hit", F.lit(1))
    parts = attributes.select("dataset_id", "columns", F.explode("columns").alias("column")).distinct()
    whole = (
        parts.join(hits, ["dataset_id", "column"], "left").groupBy("dataset_id", "columns")
        .agg((F.count("hit") == F.count("*")).alias("all")).where("all").drop("all")
    )
    whole = stage(whole, "inheriting")
    columns = whole.select("dataset_id", F.explode("columns").alias("column"))
    again, mixed = classify_annotated(
        profiled, found.join(columns, ["dataset_id", "column"], "left_semi"), keys,
        profile=profile.join(columns, ["dataset_id", "column"], "left_semi"), **options,
    )
    kept = attributes.join(whole, ["dataset_id", "columns"], "left_anti")
    fresh = to_annotations(kept).join(series, "dataset_id")
    return kept.unionByName(again), mixed, notes.upsert_backbone(backbone, fresh)
