"""Lookups that fill in defaults: annotations, sources, code labels, sidecars, overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colonnade.functions import fixed
from colonnade.functions.names import is_country_name
from colonnade.functions.numbers import ratio
from colonnade.functions.text import column_key, sidecar_code, strip

CODE_LABEL_MIN = 0.8


def annotation_lookup(columns: DataFrame, annotations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Join the annotation of each column; a column annotated twice keeps its first row."""
    keys = keys or ["dataset_id", "column"]
    order = [c for c in ("row_pos", "semantic_source", "meaning") if c in annotations.columns]
    ranked = W.partitionBy(*keys).orderBy(*order) if order else None
    first = (
        annotations.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
        if ranked is not None
        else annotations.dropDuplicates(keys)
    )
    return columns.join(first, keys, "left")


def columns_by_flag(annotated: DataFrame) -> DataFrame:
    """Split annotated columns into the lists they belong to: (…, list); a column without a flag is ``other``."""
    lists = F.array_compact(
        F.array(
            F.when(F.col("is_spatial"), "spatial"),
            F.when(F.col("is_temporal"), "temporal"),
            F.when(F.col("is_indicator") & (F.col("indicator_type") == "Quantitative"), "quantitative"),
            F.when(F.col("is_indicator") & (F.col("indicator_type") == "Qualitative"), "qualitative"),
        )
    )
    return annotated.withColumn("list", F.explode(F.when(F.size(lists) > 0, lists).otherwise(F.array(F.lit("other")))))


def _filled(column: str, default: Column) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), default)


def source_lookup(files: DataFrame, registry: DataFrame, name: str = "file_name") -> DataFrame:
    """Source of each file with defaults: unlisted files are local, blanks of a listed one are filled."""
    fields = ("sourceAddress", "sourceName", "sourceType", "filename_series_hint")
    present = [c for c in fields if c in registry.columns]
    ranked = W.partitionBy("_key").orderBy(*[F.col(c) for c in present])
    first = (
        registry.select(F.trim("file_name").alias("_key"), *present)
        .withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
        .withColumn("_listed", F.lit(True))
    )
    for field in fields:
        if field not in present:
            first = first.withColumn(field, F.lit(None).cast("string"))
    joined = files.withColumn("_key", F.trim(F.col(name))).join(first, "_key", "left")
    return joined.select(
        *[F.col(c) for c in files.columns],
        _filled("sourceAddress", F.lit("")).alias("sourceAddress"),
        _filled("sourceName", F.col(name)).alias("sourceName"),
        _filled("sourceType", F.when(F.col("_listed"), "external_source").otherwise("local")).alias("sourceType"),
        _filled("filename_series_hint", F.lit("")).alias("filename_series_hint"),
    )


def label_map(labels: DataFrame, variable: str = "GEO", order: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Code list of one variable: (keys, code_key, label); the last row of a repeated code wins."""
    keys = keys or []
    codes = (
        labels.where((F.trim("COD_VAR") == variable) & (F.trim("COD_MOD") != ""))
        .withColumn("code_key", sidecar_code(F.col("COD_MOD")))
        .withColumn("label", F.coalesce(F.trim("LIB_MOD"), F.lit("")))
    )
    last = F.max_by("label", F.col(order)) if order else F.max("label")
    return codes.groupBy(*keys, "code_key").agg(last.alias("label"))


def label_coverage(data: DataFrame, labels: DataFrame, code: str = "GEO", keys: list[str] | None = None) -> DataFrame:
    """Share of distinct codes that have a label: (keys, n_codes, n_matched, coverage, enough)."""
    keys = keys or []
    shown = strip(F.regexp_replace(strip(F.col(f"`{code}`").cast("string")), r'^"+|"+$', ""))
    # codes are distinct before the join, so a code holding most rows joins once
    codes = (
        data.where(strip(F.col(f"`{code}`").cast("string")) != "")
        .select(*keys, shown.alias("value"), sidecar_code(F.col(f"`{code}`")).alias("code_key"))
        .distinct()
    )
    found = codes.join(labels.withColumn("hit", F.lit(1)), keys + ["code_key"], "left")
    counted = found.groupBy(*keys).agg(F.count("*").alias("n_codes"), F.count("hit").alias("n_matched"))
    share = ratio(F.col("n_matched"), F.col("n_codes"))
    return counted.withColumn("coverage", share).withColumn("enough", share >= CODE_LABEL_MIN)


def label_codes(data: DataFrame, labels: DataFrame, code: str = "GEO", name: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Add the label of each code; unlisted codes get the empty string."""
    keys = keys or []
    name = name or free_name(data.columns, f"{code}_LABEL")
    return (
        data.withColumn("code_key", sidecar_code(F.col(f"`{code}`")))
        .join(labels.withColumnRenamed("label", name), keys + ["code_key"], "left")
        .withColumn(name, F.coalesce(F.col(name), F.lit("")))
        .select(*data.columns, name)
    )


def add_code_labels(data: DataFrame, sidecar: DataFrame, code: str = "GEO") -> tuple[DataFrame, str | None]:
    """Label column for a code column when the sidecar explains at least 80 % of its distinct codes.

    Returns the table and the name of the new column (None when nothing was added).
    """
    if code not in data.columns or not set(fixed.SIDECAR_COLUMNS) <= set(sidecar.columns):
        return data, None
    labels = label_map(sidecar, code, "row_pos" if "row_pos" in sidecar.columns else None)
    coverage = label_coverage(data, labels, code).first()
    if coverage is None or not coverage["enough"]:
        return data, None
    name = free_name(data.columns, f"{code}_LABEL")
    return label_codes(data, labels, code, name), name


def free_name(taken: list[str], base: str) -> str:
    """Column name that is not taken yet: base, base_2, base_3 …"""
    name, i = base, 2
    while name in taken:
        name, i = f"{base}_{i}", i + 1
    return name


def pair_sidecars(listing: DataFrame) -> DataFrame:
    """Data files with the metadata sidecar next to them: (path, sidecar)."""
    ends = F.regexp_extract("path", r"_(data\.csv|data\.CSV)$", 1)
    wanted = listing.where(ends != "").select(
        "path",
        F.when(ends == "data.csv", F.regexp_replace("path", r"_data\.csv$", "_metadata.csv"))
        .otherwise(F.regexp_replace("path", r"_data\.CSV$", "_metadata.CSV"))
        .alias("sidecar"),
    )
    return wanted.join(listing.select(F.col("path").alias("sidecar")), "sidecar", "left_semi").select("path", "sidecar")


def country_overrides(annotations: DataFrame, country_values: DataFrame) -> DataFrame:
    """Annotations with country columns (by name or by values) made spatial.

    ``country_values`` lists (dataset_id, column, is_country) from the profile.
    """
    joined = annotations.join(country_values, ["dataset_id", "column"], "left")
    known = F.col("is_country").isNotNull()
    country = known & (is_country_name(column_key(F.col("column"))) | F.col("is_country"))
    changed = {
        "meaning": F.coalesce(F.nullif(F.col("meaning"), F.lit("")), F.lit("Country spatial attribute.")),
        "is_spatial": F.lit(True),
        "is_temporal": F.lit(False),
        "is_indicator": F.lit(False),
        "is_other_information": F.lit(False),
        "indicator_type": F.lit(None).cast("string"),
        "thematic_path": F.lit(None).cast("string"),
    }
    return joined.select(
        *[
            F.when(country, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in annotations.columns
        ]
    )


def merge_overrides(attributes: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace spatial attributes that use an override's code or label column; drop those columns from ``other``.

    ``overrides`` has the attribute fields plus ``code_column`` and ``label_column``; an override whose columns no
    spatial attribute uses is appended.
    """
    keyed = overrides.withColumn("override_columns", F.array("code_column", "label_column"))
    fields = [c for c in attributes.columns if c in overrides.columns and c != "dataset_id"]
    a, o = attributes.alias("a"), keyed.alias("o")
    uses = (F.col("a.dataset_id") == F.col("o.dataset_id")) & F.arrays_overlap("a.columns", "o.override_columns")
    touched = a.join(o, uses, "left")
    kept = touched.where(F.col("o.dataset_id").isNull() | (F.col("a.role") != "other"))
    changed = F.col("o.dataset_id").isNotNull() & (F.col("a.role") == "spatial")
    replaced = kept.select(
        *[
            F.when(changed, F.coalesce(F.col(f"o.{c}"), F.col(f"a.{c}"))).otherwise(F.col(f"a.{c}")).alias(c)
            if c in fields
            else F.col(f"a.{c}").alias(c)
            for c in attributes.columns
        ]
    )
    spatial = attributes.where("role = 'spatial'").alias("a")
    fresh = o.join(spatial, uses, "left_anti")
    appended = fresh.select(
        *[
            F.col(c) if c in overrides.columns else F.lit(None).cast(attributes.schema[c].dataType).alias(c)
            for c in attributes.columns
        ]
    )
    return replaced.unionByName(appended)
