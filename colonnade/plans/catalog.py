"""Building the catalog of a lake: list, skip what is up to date, describe, write, upsert."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions import fixed
from colonnade.operators import catalog as entries
from colonnade.operators import annotations as notes
from colonnade.operators import labels, lookups, reference
from colonnade.operators.profile import address_columns, profile_tables
from colonnade.plans.classify import attribute_categories, classify_annotated, classify_columns, detected_profile
from colonnade.plans.clock import Clock
from colonnade.plans.dataset import add_constant_column, dataset_records
from colonnade.plans.series import inherit_classes, inherited_annotations, with_given
from colonnade.session import stage
from colonnade.sources import lake, readers, sinks


@dataclass(frozen=True)
class Described:
    """Records, attributes and scope rows of a set of datasets, and the backbone of their series where one was given."""

    records: DataFrame
    attributes: DataFrame
    scopes: DataFrame
    backbone: DataFrame | None = None


def describe_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    files: DataFrame,
    reference_lists: DataFrame,
    *,
    annotations: DataFrame | None = None,
    backbone: DataFrame | None = None,
    labelled: DataFrame | None = None,
    hierarchy: DataFrame | None = None,
    theme_nodes: DataFrame | None = None,
    root: str = fixed.RAW_ZONE_ROOT,
    guard: bool = False,
    iso_dates: bool = False,
    strict_numeric: bool = False,
    clock: Clock | None = None,
) -> Described:
    """Profile, classify and describe any number of tables in one set of jobs.

    With ``annotations`` the columns are classified by them, otherwise by names and values alone.  With a ``backbone``
    the columns of datasets whose file has a ``filename_series_hint`` inherit the annotations of their series first.
    ``labelled`` names the label columns that a code list gave: (dataset_id, code_column, label_column); their labels
    decide the level of the places that the code column stands for.
    """
    clock = clock or Clock()
    with clock.step("semantic_helper_sec"):
        keys = stage(reference.reference_keys(reference_lists), "keys")
        address = address_columns(spark, tables)
        if annotations is not None:
            address = _annotated_parts(spark, address, annotations)
        profiled = profile_tables(spark, tables, address=address, strict_numeric=strict_numeric)
        profile = detected_profile(profiled, iso_dates=iso_dates)
        series = None
        if backbone is not None and "filename_series_hint" in files.columns:
            series = files.where("filename_series_hint <> ''").select("dataset_id", F.col("filename_series_hint").alias("series_hint")).distinct()
        if series is not None and annotations is not None:
            inherited = stage(inherited_annotations(profile, backbone, series), "inherited")
            annotations, backbone = with_given(inherited, annotations, series, backbone)
    with clock.step("classify_attributes_sec"):
        mixed = None
        if annotations is not None:
            attributes, mixed = classify_annotated(profiled, annotations, keys, guard=guard, profile=profile)
        else:
            attributes = classify_columns(profiled, keys, guard=guard, profile=profile)
            if series is not None:
                attributes, mixed, backbone = inherit_classes(
                    profiled, stage(attributes, "classes"), keys, profile, backbone, series, guard=guard
                )
        if labelled is not None:
            attributes, mixed = _with_labels(profiled, attributes, mixed, profile, labelled, keys)
        attributes = stage(attributes, "attributes")
    records, scopes = dataset_records(
        spark, tables, profiled, attributes, files, keys, mixed=mixed, hierarchy=hierarchy, theme_nodes=theme_nodes,
        categories=attribute_categories(attributes, profiled), root=root, profile=profile, clock=clock,
    )
    return Described(records, attributes, scopes, backbone)


def _with_labels(profiled, attributes, mixed, profile, labelled, keys) -> tuple[DataFrame, DataFrame]:
    """Attributes with those of label columns in place of their codes, and the values of columns that mix levels."""
    own = profile.select("cid", "dataset_id", F.col("column").alias("label_column"), "col_pos", "spark_type").join(labelled, ["dataset_id", "label_column"])
    own = stage(own, "labelled")
    values = stage(profiled.texts_of(own).where("present").select("cid", "v"), "labels")
    levels, places = labels.label_levels(values, keys, ["cid"])
    merged = lookups.merge_overrides(attributes, labels.label_overrides(levels, own))
    return merged, places if mixed is None else mixed.join(own, "cid", "left_anti").unionByName(places)


def _annotated_parts(spark: SparkSession, address: dict[str, list[str]], annotations: DataFrame) -> dict[str, list[str]]:
    """Address sub-columns that are annotated as spatial."""
    parts = [(ds, c) for ds, columns in address.items() for c in columns]
    if not parts:
        return {}
    asked = spark.createDataFrame(parts, "dataset_id string, column string")
    spatial = {
        (r["dataset_id"], r["column"])
        for r in asked.join(annotations.where("is_spatial"), ["dataset_id", "column"], "left_semi").toLocalIterator()
    }
    kept = {ds: [c for c in columns if (ds, c) in spatial] for ds, columns in address.items()}
    return {ds: columns for ds, columns in kept.items() if columns}


def build_catalog(
    spark: SparkSession,
    root: str,
    output: str,
    reference_lists: DataFrame,
    *,
    annotations: DataFrame | None = None,
    registry: DataFrame | None = None,
    backbone: DataFrame | None = None,
    update_backbone: bool = False,
    extensions: Iterable[str] = fixed.DATA_EXTENSIONS,
    force: bool = False,
    files: DataFrame | None = None,
    batch: int = 200,
    **options,
) -> DataFrame:
    """Describe the pending files of a lake and update the catalog; returns the errors (path, error).

    Below ``output`` lie ``metadata`` and ``perf`` documents, the ``raw`` zone, the ``scopes`` rows and the
    ``catalog``.  Files are profiled together in batches: a batch is one set of jobs whatever its number of files.
    ``files`` replaces the listing; it may name the ``sidecar`` of each file and the files to describe ``again``.  The
    files that ``registry`` puts in a series inherit annotations from ``backbone`` (series_hint,
    column_name_normalized and the annotation fields) and, with ``update_backbone``, from what earlier batches and
    runs left below ``output/backbone``; the files of one batch do not inherit from each other.
    """
    places = {name: f"{output.rstrip('/')}/{name}" for name in ("metadata", "perf", "raw", "scopes", "catalog", "backbone")}
    listing = lake.list_files(spark, root) if files is None else files
    found = listing.where(lake.is_data_file(extensions))
    known = sinks.read_catalog(spark, places["catalog"])
    if force:
        todo = found.withColumn("id", entries.dataset_id(F.col("path")))
    else:
        todo = entries.pending(found, known, _outputs(known, output, spark), metadata_dir=places["metadata"], perf_dir=places["perf"])
        if "again" in found.columns:
            repeated = found.where("again").withColumn("id", entries.dataset_id(F.col("path")))
            todo = todo.unionByName(repeated).dropDuplicates(["id"])
    pairs = listing.where("sidecar IS NOT NULL") if "sidecar" in listing.columns else lookups.pair_sidecars(listing)
    errors: list[tuple[str, str]] = []
    pending = list(todo.orderBy("path").toLocalIterator())  # one row per file to process: paths, not data
    sidecars = {r["path"]: r["sidecar"] for r in pairs.select("path", "sidecar").toLocalIterator()}
    for start in range(0, len(pending), batch):
        tables, rows, enriched, clock = {}, [], {}, Clock()
        for file in pending[start : start + batch]:
            try:
                with clock.step("read_df_sec"):
                    table = readers.read_table(spark, file["path"])
                    if file["path"] in sidecars:
                        table, added = lookups.add_code_labels(table, read_sidecar(spark, sidecars[file["path"]]))
                        if added:
                            enriched[file["id"]] = added
                tables[file["id"]] = table
                rows.append(tuple(file[c] for c in ("id", "path", "title", "ext", "length", "mtime")))
            except Exception as problem:  # an unreadable file must not stop the others
                errors.append((file["path"], str(problem)))
        groups = [rows] if rows else []
        while groups:  # a batch that fails is halved until the file that cannot be read is alone
            group = groups.pop()
            try:
                listed = spark.createDataFrame(group, "dataset_id string, path string, title string, ext string, length long, mtime long")
                own = {r[0]: tables[r[0]] for r in group}
                _describe_batch(spark, own, listed, reference_lists, places, annotations, registry, enriched, clock, backbone, update_backbone, options)
            except Exception as problem:
                if len(group) > 1:
                    groups += [group[: len(group) // 2], group[len(group) // 2 :]]
                else:
                    errors.append((group[0][1], str(problem)))
    return spark.createDataFrame(errors, "path string, error string")


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Code list next to a data file, in file order."""
    table = spark.read.option("header", True).option("sep", ";").csv(path)
    clean = table.toDF(*[c.strip().strip('"') for c in table.columns])
    return clean.withColumn("row_pos", F.monotonically_increasing_id())


def _outputs(known: DataFrame, output: str, spark: SparkSession) -> DataFrame:
    """Output paths the catalog names that exist, found by one listing of the output folder."""
    folders = lake.list_files(spark, output).select(F.regexp_replace("path", "/[^/]*$", "").alias("path")).distinct()
    named = known.select(F.explode(F.array("metadataPath", "perfPath", "rawzonePath")).alias("path")).distinct()
    return named.join(folders, "path", "left_semi")


def _describe_batch(spark, tables, listed, reference_lists, places, annotations, registry, enriched, clock, backbone, update_backbone, options) -> None:
    files = listed.select(
        "dataset_id", "path", "title", F.concat(F.lit("."), F.col("ext")).alias("fileType"),
        readers.category(F.col("ext")).alias("dataFormat"), F.col("length").alias("fileSizeBytes"), "mtime",
    )
    empty = spark.createDataFrame([], "file_name string, sourceAddress string, sourceName string, sourceType string, filename_series_hint string")
    files = lookups.source_lookup(files, empty if registry is None else registry, "title")
    known = sinks.read_catalog(spark, places["backbone"], notes.BACKBONE_SCHEMA) if update_backbone else None
    if backbone is not None:  # what earlier runs left goes before the given rows
        given = backbone.select(*[c.split()[0] for c in notes.BACKBONE_SCHEMA.split(", ")])
        keys = ["series_hint", "column_name_normalized"]
        known = given if known is None else known.unionByName(given.join(known, keys, "left_anti"))
    named = [(ds, "GEO", column) for ds, column in enriched.items() if ds in tables]
    labelled = spark.createDataFrame(named, "dataset_id string, code_column string, label_column string") if named else None
    described = describe_tables(
        spark, tables, files, reference_lists, annotations=annotations, backbone=known, labelled=labelled, root=places["raw"], clock=clock, **options
    )
    with clock.step("transform_result_sec"):
        records = stage(described.records, "records")
    # before anything is written, so that a file that cannot be hashed leaves nothing behind
    sums = stage(lake.checksums(spark, [r["path"] for r in listed.toLocalIterator()]), "checksums")
    sinks.write_scopes(described.scopes, places["scopes"])
    sinks.append_documents(records, places["metadata"])
    if update_backbone and described.backbone is not None:
        sinks.write_version(stage(described.backbone, "backbone"), places["backbone"])
    from_title = F.filter("attributes", lambda a: F.startswith(a["matched_by"], F.lit("filename_")))
    constants = F.transform(from_title, lambda a: F.struct(a["columns"][0].alias("column"), a["constant"].alias("value")))
    for row in records.select("dataset_id", "rawzonePath", "fileType", constants.alias("constants")).toLocalIterator():
        table = tables[row["dataset_id"]]
        for constant in sorted(row["constants"] or (), key=lambda c: c["column"], reverse=True):  # the period before the place
            table = add_constant_column(table, constant["column"], constant["value"])
        added = row["dataset_id"] in enriched or row["constants"]
        if added and sinks.write_enriched(table, row["rawzonePath"], row["fileType"].lstrip(".")):
            continue
        sinks.place_in_raw_zone(tables[row["dataset_id"]], row["rawzonePath"])
    executed = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    sinks.write_perf_log(
        records.select(
            F.col("dataset_id").alias("datasetId"), F.col("path").alias("inputObjectKey"), "rawzonePath", "fileSizeBytes",
            clock.timings().alias("timings"), executed.alias("executedAt"),
        ),
        places["perf"],
    )
    fresh = catalog_entries(records.join(sums, "path", "left"), places)
    sinks.write_catalog(stage(entries.upsert(sinks.read_catalog(spark, places["catalog"]), fresh), "catalog"), places["catalog"])


def catalog_entries(records: DataFrame, places: Mapping[str, str]) -> DataFrame:
    """Catalog rows of dataset records."""
    return records.select(
        F.col("dataset_id").alias("id"), "title", F.col("sourceAddress").alias("sourcePath"), "sourceName", "sourceType",
        F.col("path").alias("inputObjectKey"), "rawzonePath", F.lit(True).alias("rawzoneCopied"),
        F.col("mtime").alias("sourceMtime"),
        F.concat(F.lit(places["metadata"] + "/document="), F.col("dataset_id")).alias("metadataPath"),
        F.concat(F.lit(places["perf"] + "/document="), F.col("dataset_id")).alias("perfPath"),
        F.lit("ok").alias("status"), "fileType", "dataFormat", F.lit("").alias("updateFrequency"),
        F.col("themes.themeName").alias("themes"), "spatialGranularity", "temporalGranularity", "spatialScope", "temporalScope",
        "fileSizeBytes", "fileSizeHuman", "nRows", "nCols", "nRecords", "nFeatures",
        F.lit(None).cast("long").alias("uncompressedSizeBytes"), "checksum",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generatedAt"), F.lit(1).alias("version"),
    )


__all__ = ["Described", "build_catalog", "catalog_entries", "describe_tables", "read_sidecar"]
