"""Mixing sources to target weights: repetition rates from per-source sizes, whole copies plus one hashed draw.

A document is taken floor(rate) times, and once more if a number hashed from a seed, its id and its source falls below the
fraction. So a rerun takes the same rows, and no row needs another one.

Defined results: a null or empty text has size 0 and takes nothing; a null source is one source, which comes last. Sources
whose size is 0 have target 0. Rows with the same id and source are drawn alike; a null id is an id like any other. An
empty table gives no rows. Columns of the input stay, but for one that is called mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colonnade.llm.common import word_count
from colonnade.session import stage as written

#: Weights by turn over the sources in order of code points; share of all sizes to take; most times a source repeats.
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
SEED = 17


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: one row for each source.

    The excess over a source's limit goes to the others by weight until none is above. With sources in order of limit per
    weight, those before some place stop at their limit and the rest share what is left: the place is the first whose
    share is within its limit. The windows run over one row for each source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights) + 1
    weighted = sizes.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn).alias("weight"))
    limit = F.lit(most) * F.col("source_size")
    ranked = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    below = ranked.rowsBetween(Window.unboundedPreceding, -1)
    rest = ranked.rowsBetween(0, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(below), F.lit(0.0))) / F.sum("weight").over(rest)
    marked = weighted.select("*", F.when(level * F.col("weight") <= limit, level).alias("level"))
    shared = F.first("level", ignorenulls=True).over(ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return marked.select("source", "source_size", F.when(shared.isNull(), limit).otherwise(F.least(limit, shared * F.col("weight"))).alias("target"))


def draw(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double") / F.lit(float(1 << 53))


def mix(docs: DataFrame, seed: int = SEED, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with a struct ``mix``: size, source_size, target, copies and taken of each row."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "mix"]).alias("row"), F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"),
    )
    goals = written(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mixing-targets")
    goals = goals.select(F.col("source").alias("goal_source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(whole + (draw(seed, F.col("id"), F.col("source")) < rate - whole).cast("long"))
    return sized.join(goals, F.col("source").eqNullSafe(F.col("goal_source"))).select(
        "row.*", F.struct("size", "source_size", "target", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken")).alias("mix")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken"
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it."""
    mixed = mix(docs.withColumnsRenamed({c: f"own {c}" for c in docs.columns}), id_column="own doc_id", text="own text", source="own source")
    repeated = mixed.select(
        *[F.col(f"`own {c}`").alias(c) for c in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col("mix.copies").cast("int"))).alias("copy of row")
    )
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
