"""Loading the given tables and the reference lists derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """Given tables by name."""
    return {name: load(spark, sf_dir, name) for name in names}


def reference_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions and nations as reference levels; nation codes are padded to two digits as code lists do."""
    region = load(spark, sf_dir, "region").select(
        F.lit("reg").alias("level"), F.lit(0).alias("level_rank"),
        F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("nom"),
    )
    nation = load(spark, sf_dir, "nation").select(
        F.lit("dep").alias("level"), F.lit(2).alias("level_rank"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"), F.col("n_name").alias("nom"),
    )
    return region.unionByName(nation)
