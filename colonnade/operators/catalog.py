"""Catalog maintenance: identity, incremental skip, upsert, order, performance table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CATALOG_SCHEMA = (
    "id string, title string, sourcePath string, sourceName string, sourceType string, inputObjectKey string, "
    "rawzonePath string, rawzoneCopied boolean, sourceMtime long, metadataPath string, perfPath string, status string, "
    "fileType string, dataFormat string, updateFrequency string, themes array<string>, spatialGranularity string, "
    "temporalGranularity string, "
    "spatialScope array<struct<spatialScopeLevel:string,nValues:bigint>>, "
    "temporalScope array<struct<temporalScopeLevel:string,nValues:bigint>>, "
    "fileSizeBytes long, fileSizeHuman string, nRows long, nCols int, nRecords long, nFeatures long, "
    "uncompressedSizeBytes long, checksum string, generatedAt string, version int"
)
PERF_SCHEMA = (
    "datasetId string, inputObjectKey string, rawzonePath string, fileSizeBytes long, "
    "timings struct<read_df_sec:double,semantic_helper_sec:double,classify_attributes_sec:double,"
    "scopes_granularities_sec:double,find_common_theme_sec:double,transform_result_sec:double,total_sec:double>, "
    "executedAt string"
)
TIMINGS = (
    "read_df_sec", "semantic_helper_sec", "classify_attributes_sec", "scopes_granularities_sec", "find_common_theme_sec",
    "transform_result_sec", "total_sec",
)


def dataset_id(key: Column) -> Column:
    """Stable identifier of a dataset: the first 16 hex digits of its key's SHA-1."""
    return F.substring(F.sha1(key.cast("binary")), 1, 16)


def pending(files: DataFrame, catalog: DataFrame, outputs: DataFrame, *, metadata_dir: str, perf_dir: str) -> DataFrame:
    """Files to process: those without a good catalog entry of the same modification time and complete outputs.

    ``files`` has path, mtime and title; ``outputs`` lists the paths that exist.  A file the catalog does not know
    counts as done when both of its outputs exist under its name.
    """
    exists = outputs.select(F.col("path").alias("output")).distinct()
    keyed = files.withColumn("id", dataset_id(F.col("path")))
    good = (
        catalog.where("lower(status) = 'ok' AND rawzoneCopied")
        .join(exists, F.col("metadataPath") == F.col("output"), "left_semi")
        .join(exists, F.col("perfPath") == F.col("output"), "left_semi")
        .join(exists, F.col("rawzonePath") == F.col("output"), "left_semi")
        .select("id", F.col("sourceMtime").alias("mtime"))
    )
    unknown = (
        keyed.join(catalog.select("id").distinct(), "id", "left_anti")
        .select(
            "id", "mtime", F.concat(F.lit(metadata_dir + "/"), F.col("title"), F.lit(".metadata.json")).alias("meta"),
            F.concat(F.lit(perf_dir + "/"), F.col("title"), F.lit(".perf.json")).alias("perf"),
        )
        .join(exists, F.col("meta") == F.col("output"), "left_semi")
        .join(exists, F.col("perf") == F.col("output"), "left_semi")
        .select("id", "mtime")
    )
    return keyed.join(good.unionByName(unknown), ["id", "mtime"], "left_anti").select("id", *files.columns)


def upsert(catalog: DataFrame, fresh: DataFrame) -> DataFrame:
    """Catalog with new entries replacing the old ones of the same id."""
    kept = catalog.join(fresh.select("id"), "id", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def latest(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Latest row of each key."""
    order = W.partitionBy(*keys).orderBy(F.desc_nulls_last(by))
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def ordered(catalog: DataFrame) -> DataFrame:
    """Catalog in its written order: title without case, then id."""
    return catalog.orderBy(F.lower(F.coalesce("title", F.lit(""))), F.coalesce("id", F.lit("")))


def perf_table(log: DataFrame) -> DataFrame:
    """Performance log entries as flat rows, newest first; unreadable times come last."""
    present = log.schema["timings"].dataType.names
    timings = [
        (F.col(f"timings.{t}") if t in present else F.lit(None)).cast("double").alias(t) for t in TIMINGS
    ]
    flat = log.select("datasetId", "rawzonePath", F.try_to_timestamp("executedAt").alias("executedAt"), "fileSizeBytes", *timings)
    return flat.orderBy(F.desc_nulls_last("executedAt"), F.asc("datasetId"))
