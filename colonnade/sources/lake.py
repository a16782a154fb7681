"""Listing a lake and measuring its files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as filesystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from colonnade.functions import fixed

#: Largest file that a row may hold (Spark allows 2 GB), and bytes of a larger one that are hashed at a time.
WHOLE_BYTES, BLOCK_BYTES = 256 << 20, 1 << 20
LISTING_SCHEMA = "path string, modificationTime timestamp, length long, mtime long, title string, ext string"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below a folder: path, modification time, size, epoch seconds, name and extension.

    The contents are not read: only the listing columns of the scan are selected.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    except AnalysisException:  # the folder does not exist yet
        return spark.createDataFrame([], LISTING_SCHEMA)
    return with_names(files.select("path", "modificationTime", "length"))


def with_names(files: DataFrame, *kept: str) -> DataFrame:
    """Listing with epoch seconds, file name and extension, and the columns ``kept``."""
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.when(F.contains(name, F.lit(".")), F.lower(F.element_at(F.split(name, r"\."), -1))).otherwise("")
    return files.select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"), "modificationTime", "length",
        F.unix_timestamp("modificationTime").alias("mtime"), name.alias("title"), ext.alias("ext"), *kept,
    )


def is_data_file(extensions: Iterable[str] = fixed.DATA_EXTENSIONS) -> Column:
    """Listing filter: known extensions, no hidden files, no metadata sidecars."""
    name = F.lower("title")
    return (
        F.col("ext").isin(*[e.lower().lstrip(".") for e in extensions])
        & ~name.startswith(".")
        & ~name.endswith(".ini")
        & ~name.rlike(r"[_.]metadata\.(csv|tsv)$")
    )


def data_files(spark: SparkSession, root: str, extensions: Iterable[str] = fixed.DATA_EXTENSIONS) -> DataFrame:
    """Data files of a lake."""
    return list_files(spark, root).where(is_data_file(extensions))


def checksums(spark: SparkSession, paths: list[str], *, whole_bytes: int = WHOLE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """SHA-256 of files of any size: (path, checksum).

    Small files are hashed by Spark's reader, one in a row.  Those above ``whole_bytes`` are never held: a task opens each
    and hashes it block by block, so its store must be one that Arrow's file systems open (local, HDFS, object stores).
    Empty files, which Spark's listing leaves out, have no row.
    """
    files = spark.read.format("binaryFile").load(paths)
    plain = F.regexp_replace("path", "^file:/+", "/").alias("path")
    small = files.where(F.col("length") <= whole_bytes).select(plain, F.sha2("content", 256).alias("checksum"))

    def hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                store, place = filesystem.FileSystem.from_uri(name)
                digest = hashlib.sha256()
                with store.open_input_stream(place) as stream:
                    while part := stream.read(block_bytes):
                        digest.update(part)
                yield pa.RecordBatch.from_pydict({"path": [name], "checksum": [digest.hexdigest()]})

    # only the listing columns are read; a task of its own for each file
    large = files.where(F.col("length") > whole_bytes).select(plain)
    names = [r["path"] for r in large.collect()]
    if not names:
        return small
    listed = spark.createDataFrame([(n,) for n in names], "path string").repartition(len(names), "path")
    return small.unionByName(listed.mapInArrow(hash_blocks, "path string, checksum string"))
