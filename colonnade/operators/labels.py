"""Levels of label columns: places named by the labels of a code list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.fixed import LABEL_LEVEL_MIN, LABEL_SOURCES
from colonnade.functions.numbers import ratio
from colonnade.functions.text import strip
from colonnade.operators import reference
from colonnade.operators.reference import specificity


def _bounded(share: Column) -> Column:
    return F.least(F.lit(0.99), F.greatest(F.lit(0.8), share))


def label_levels(values: DataFrame, keys: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
    """Levels that the labels of each column name, and the labels of each level.

    ``values`` are the different labels (group, v).  The first table has one row for each column with a label: (group,
    granularity, matched_by, confidence, mixed_levels).  Labels of several levels make the column ``mixed``, those of one
    level give it that level.  Without a known name, labels that are codes of one level for at least 80 % count; else the
    column stays a code list of its own.  The second table is (group, level, value), one row for each label with a name,
    at its most specific level.
    """
    filled = values.where(strip(F.col("v")) != "").select(*group, strip(F.col("v")).alias("v")).distinct()
    named = reference.value_levels(filled, keys, group, by="nom")
    labels = named.select(*group, "level", "value").distinct()
    found = named.groupBy(*group).agg(
        F.count("*").alias("n_named"),
        F.transform(F.array_sort(F.collect_set(F.struct(specificity(F.col("level")).alias("pos"), "level"))), lambda s: s["level"]).alias("mixed_levels"),
    )
    totals = filled.groupBy(*group).agg(F.count("*").alias("n_labels"))
    # names are out of question where this is used, so the best level is one of codes
    coded = reference.best_level(filled, keys, group).where(F.col("ratio") >= LABEL_LEVEL_MIN).select(*group, "level", "by", "ratio")
    n_levels = F.coalesce(F.size("mixed_levels"), F.lit(0))
    share = ratio(F.coalesce("n_named", F.lit(0)), F.col("n_labels"))

    def chosen(several, one, code, none) -> Column:
        return F.when(n_levels > 1, several).when(n_levels == 1, one).when(F.col("level").isNotNull(), code).otherwise(none)

    columns = totals.join(found, group, "left").join(coded, group, "left").select(
        *group,
        chosen(F.lit("mixed"), F.col("mixed_levels")[0], F.col("level"), F.lit(LABEL_SOURCES["level"])).alias("granularity"),
        chosen(
            F.lit(LABEL_SOURCES["mixed"]), F.lit(LABEL_SOURCES["one"]), F.concat(F.lit(LABEL_SOURCES["by"]), F.col("by")), F.lit(LABEL_SOURCES["none"])
        ).alias("matched_by"),
        chosen(_bounded(share), _bounded(share), _bounded(F.col("ratio")), F.lit(0.98)).alias("confidence"),
        F.coalesce("mixed_levels", F.array().cast("array<string>")).alias("mixed_levels"),
    )
    return columns, labels


def label_overrides(levels: DataFrame, labelled: DataFrame) -> DataFrame:
    """Spatial attributes of label columns for :func:`lookups.merge_overrides`.

    ``levels`` is the first table of :func:`label_levels` with ``cid``; ``labelled`` has cid, dataset_id, code_column,
    label_column, spark_type and col_pos of the label column.
    """
    listed = F.when(F.size("mixed_levels") > 0, F.concat(F.lit("; its labels name places of: "), F.array_join("mixed_levels", ", "))).otherwise(
        F.when(F.col("granularity") == LABEL_SOURCES["level"], "; its labels name no listed place").otherwise("; its labels are codes of listed places")
    )
    return labelled.join(levels, "cid").select(
        "dataset_id", "code_column", "label_column", F.array("label_column").alias("columns"), F.lit("spatial").alias("role"),
        F.concat(F.lit("Places named by the code list of "), F.col("code_column")).alias("description"), "granularity", "matched_by",
        "confidence", F.concat(F.lit("Code list next to the data explains "), F.col("code_column"), listed).alias("evidence"),
        F.array("spark_type").alias("type"), "mixed_levels", "cid", "col_pos",
    )
