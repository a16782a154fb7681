"""Period ranges: distinct periods per key merged into contiguous ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colonnade.functions.periods import with_period


def merge_periods(periods: DataFrame, keys: list[str]) -> DataFrame:
    """Merge neighbouring periods ``(keys, start, end, label)`` into ranges ``(keys, start_label, end_label)``.

    Periods are made distinct first; a key has at most one row per calendar unit of three centuries, so the window of
    a key is bounded however many rows the key has in the data.
    """
    order = W.partitionBy(*keys).orderBy("start", "end")
    distinct = periods.groupBy(*keys, "start", "end").agg(F.min("label").alias("label"))
    breaks = distinct.withColumn(
        "new_range", F.coalesce((F.col("start") != F.date_add(F.lag("end").over(order), 1)).cast("int"), F.lit(1))
    ).withColumn("range_id", F.sum("new_range").over(order))
    return (
        breaks.groupBy(*keys, "range_id")
        .agg(
            F.min_by("label", "start").alias("start_label"),
            F.max_by("label", "start").alias("end_label"),
            F.count("*").alias("n_periods"),
        )
        .drop("range_id")
    )


def period_ranges(tokens: DataFrame, keys: list[str], token: str, granularity: str) -> DataFrame:
    """Contiguous ranges of the tokens of one granularity, per key.  Invalid tokens are ignored."""
    distinct = tokens.where(F.col(token).isNotNull()).select(*keys, F.col(token).cast("string").alias("token")).distinct()
    return merge_periods(with_period(distinct.withColumn("token", F.trim("token")), "token", granularity), keys)


def mixed_period_ranges(tokens: DataFrame, keys: list[str], token: str, granularity: str) -> DataFrame:
    """Like :func:`period_ranges` with the granularity in a column, which stays in the result."""
    group = keys + [granularity]
    distinct = tokens.where(F.col(token).isNotNull()).select(*group, F.col(token).cast("string").alias("token")).distinct()
    dated = with_period(distinct.withColumn("token", F.trim("token")), "token", F.col(granularity))
    return merge_periods(dated, group)
