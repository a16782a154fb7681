"""Writing and reading metadata documents, the catalog, performance logs and the raw zone."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from colonnade.operators import catalog

METADATA_SCHEMA = (
    "title string, description string, dataFormat string, fileType string, rawzonePath string, fileSizeBytes long, "
    "fileSizeHuman string, nRows long, nCols int, nRecords long, nFeatures long, uncompressedSizeBytes long, "
    "updateFrequency string, sourceName string, sourceType string, sourceAddress string, spatialGranularity string, "
    "spatialScope array<struct<spatialScopeLevel:string,nValues:long>>, temporalGranularity string, "
    "temporalScope array<struct<temporalScopeLevel:string,nValues:long>>, "
    "themes array<struct<themeName:string,themeDescription:string>>, "
    "attributes array<struct<dataName:string,dataDescription:string,dataType:string,spatialLevel:string,"
    "temporalLevel:string,granularity:string,related_parameter:string,indicatorType:string,"
    "theme:struct<themeName:string,themeDescription:string>>>"
)


def named_attributes(records: DataFrame) -> DataFrame:
    """Dataset records with the field names that :func:`read_documents` expects, beside their own, in each attribute."""
    if "attributes" not in records.columns or "columns" not in (names := records.schema["attributes"].dataType.elementType.names):
        return records

    def named(a):
        level = lambda role: F.when(a["role"] == role, a["granularity"])
        indicator = (a["role"] == "indicator") & a["theme"].isNotNull()
        return F.struct(
            *[a[f].alias(f) for f in names if f not in ("theme", "granularity")],
            F.array_join(a["columns"], ", ").alias("dataName"), a["description"].alias("dataDescription"), F.array_join(a["type"], ", ").alias("dataType"),
            level("spatial").alias("spatialLevel"), level("temporal").alias("temporalLevel"),
            F.when(~a["role"].isin("spatial", "temporal", "indicator"), a["granularity"]).alias("granularity"),
            F.when(indicator, a["indicator_type"]).alias("indicatorType"),
            F.when(indicator, F.struct(a["theme"].alias("themeName"), a["theme"].alias("themeDescription"))).alias("theme"),
        )

    return records.withColumn("attributes", F.transform("attributes", named))


def write_documents(records: DataFrame, folder: str, key: str = "dataset_id") -> None:
    """One JSON document per record, in a folder of its own below ``folder``."""
    named_attributes(records).withColumn("document", F.col(key)).write.mode("overwrite").option(
        "ignoreNullFields", True
    ).partitionBy("document").json(folder)


def write_scopes(scopes: DataFrame, path: str) -> None:
    """Write the scope rows of some datasets in place of those that they had: describing a file again changes nothing."""
    marked = scopes.withColumn("document", F.col("dataset_id"))
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("document").parquet(path)


def append_documents(records: DataFrame, folder: str, key: str = "dataset_id") -> None:
    """Like :func:`write_documents`, replacing only the documents of these records."""
    named_attributes(records).withColumn("document", F.col(key)).write.mode("overwrite").option("ignoreNullFields", True).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("document").json(folder)


def read_documents(spark: SparkSession, path: str, schema: str = METADATA_SCHEMA) -> DataFrame:
    """Metadata documents with the kind of each attribute told by the fields it has."""
    documents = spark.read.schema(schema).option("multiLine", True).json(path)
    return documents.withColumn("attributes", F.transform("attributes", _with_kind))


def _with_kind(a):
    kind = (
        F.when(a["spatialLevel"].isNotNull(), "SpatialParameter")
        .when(a["temporalLevel"].isNotNull(), "TemporalParameter")
        .when(a["granularity"].isNotNull() | a["related_parameter"].isNotNull(), "ComplementaryInformation")
        .when(a["theme"].isNotNull(), "ExistingIndicator")
        .when(a["dataName"].isNotNull() & a["dataDescription"].isNotNull() & a["dataType"].isNotNull(), "Parameter")
        .otherwise("Attribute")
    )
    return a.withField("kind", kind)


def read_catalog(spark: SparkSession, path: str, schema: str = catalog.CATALOG_SCHEMA) -> DataFrame:
    """The catalog, empty when it has not been written yet; any other table that :func:`write_version` wrote by its schema."""
    try:
        versions = spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return versions.where(F.col("catalog_version") == versions.agg(F.max("catalog_version")).first()[0]).drop("catalog_version")


def write_catalog(entries: DataFrame, path: str) -> None:
    """Write the catalog in its order as the next version; readers keep the last complete one."""
    write_version(catalog.ordered(entries), path)


def write_version(table: DataFrame, path: str) -> None:
    """Write the next version of a table."""
    spark = table.sparkSession
    try:
        last = spark.read.parquet(path).agg(F.max("catalog_version")).first()[0]
    except AnalysisException:
        last = 0
    table.withColumn("catalog_version", F.lit((last or 0) + 1)).write.mode("append").partitionBy(
        "catalog_version"
    ).parquet(path)


def write_perf_log(entries: DataFrame, folder: str) -> None:
    """One JSON entry per dataset."""
    entries.withColumn("document", F.col("datasetId")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("document").json(folder)


def read_perf_log(spark: SparkSession, path: str) -> DataFrame:
    """Performance log entries; files that are not JSON are left out."""
    schema = catalog.PERF_SCHEMA + ", _corrupt_record string"
    log = spark.read.schema(schema).option("mode", "PERMISSIVE").option("multiLine", True).option(
        "recursiveFileLookup", True
    ).json(path)
    return log.where("_corrupt_record IS NULL").drop("_corrupt_record")


def write_perf_table(spark: SparkSession, log_path: str, csv_path: str | None, parquet_path: str | None) -> DataFrame:
    """Summary of the performance log as CSV and Parquet."""
    table = catalog.perf_table(read_perf_log(spark, log_path))
    if csv_path:
        table.write.mode("overwrite").option("header", True).csv(csv_path)
    if parquet_path:
        table.write.mode("overwrite").parquet(parquet_path)
    return table


def place_in_raw_zone(table: DataFrame, path: str) -> None:
    """Write a dataset under its theme path unless it is there already."""
    table.write.mode("ignore").parquet(path)


def write_enriched(table: DataFrame, path: str, ext: str) -> bool:
    """Delimited dataset with added columns: written with its own separator; other formats are left alone."""
    if ext not in ("csv", "tsv"):
        return False
    separator = "\t" if ext == "tsv" else ","
    table.write.mode("overwrite").option("header", True).option("sep", separator).option("encoding", "UTF-8").csv(path)
    return True


def new_run_folder(root: str, name: str) -> str:
    """A folder name no earlier run has used."""
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
