"""Header rows and roles of sheet grids given as cells (dataset_id, sheet, row, col, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colonnade.functions import fixed
from colonnade.functions.numbers import ratio
from colonnade.functions.text import header_key, looks_numeric, strip

SHEET_KEYS = ["dataset_id", "sheet"]


#: Non-empty rows that the header is sought in, rows below it that count as its body.
HEADER_ROWS, BODY_ROWS = 50, 10


def sheet_rows(cells: DataFrame, *, first: int = HEADER_ROWS + BODY_ROWS) -> DataFrame:
    """The first non-empty rows of each sheet: their rank and their filled, distinct and textual cells.

    A header lies in the first rows by its definition; the rank filter is applied before the rows are shuffled.
    """
    text = header_key(F.col("value"))
    filled = cells.where(F.col("value").isNotNull()).withColumn("text", text)
    per_row = filled.groupBy(*SHEET_KEYS, "row").agg(
        F.count("*").alias("n_filled"),
        F.count(F.when(F.col("text") != "", 1)).alias("n_text"),
        F.count_distinct(F.when(F.col("text") != "", F.col("text"))).alias("n_distinct"),
        F.count(F.when((F.col("text") != "") & ~looks_numeric(F.col("text")), 1)).alias("n_words"),
    )
    return per_row.withColumn("rank", F.row_number().over(W.partitionBy(*SHEET_KEYS).orderBy("row"))).where(F.col("rank") <= first)


def header_rows(rows: DataFrame, *, first: int = HEADER_ROWS) -> DataFrame:
    """Header row of each sheet: the best scored of its first non-empty rows (key, header_row, score)."""
    following = W.partitionBy(*SHEET_KEYS).orderBy("row").rowsBetween(1, 5)
    scored = (
        rows.withColumn("next_fill", F.coalesce(F.avg("n_filled").over(following), F.lit(0.0)))
        .where((F.col("rank") <= first) & (F.col("n_text") > 0))
        .withColumn(
            "score",
            F.col("n_text")
            + ratio(F.col("n_distinct"), F.col("n_text"))
            + ratio(F.col("n_words"), F.col("n_text"))
            + F.least(F.col("next_fill"), F.col("n_text")),
        )
    )
    return scored.groupBy(*SHEET_KEYS).agg(
        F.max_by("row", F.struct("score", -F.col("row"))).alias("header_row"), F.max("score").alias("score")
    )


def sheet_name_role(sheet: Column) -> Column:
    """Role told by a sheet name: dictionary, dashboard or null."""
    key = header_key(sheet)
    return F.when(key.rlike("|".join(fixed.SHEET_DICTIONARY_NAMES)), "dictionary").when(
        key.rlike("|".join(fixed.SHEET_DASHBOARD_NAMES)), "dashboard"
    )


def _any_in(texts: Column, words: tuple[str, ...]) -> Column:
    return F.arrays_overlap(texts, F.array(*[F.lit(w) for w in words]))


def sheet_roles(cells: DataFrame) -> DataFrame:
    """Role of each sheet: data, dictionary, dashboard, empty or unknown."""
    sheets = cells.groupBy(*SHEET_KEYS).agg(
        (F.max("col") + 1).alias("n_cols"), F.nullif(F.count_distinct(F.when(F.col("value").isNotNull(), F.col("row"))), F.lit(0)).alias("n_rows")
    )
    rows = sheet_rows(cells)
    heads = header_rows(rows)
    header_cells = (
        cells.join(heads, SHEET_KEYS)
        .where(F.col("row") == F.col("header_row"))
        .withColumn("text", header_key(F.col("value")))
        .where(F.col("text") != "")
        .groupBy(*SHEET_KEYS)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda c: c["text"]).alias("headers"))
    )
    head_rank = rows.join(heads, SHEET_KEYS).where(F.col("row") == F.col("header_row")).select(
        *SHEET_KEYS, F.col("rank").alias("head_rank")
    )
    ranked = rows.join(head_rank, SHEET_KEYS)
    body = (F.col("rank") > F.col("head_rank")) & (F.col("rank") <= F.col("head_rank") + BODY_ROWS)
    facts = ranked.groupBy(*SHEET_KEYS).agg(
        F.avg(F.when(body, F.col("n_filled"))).alias("body_fill"),
        F.sum(F.when(F.col("rank") <= 15, F.col("n_filled"))).alias("preview_filled"),
        F.count(F.when(F.col("rank") <= 15, 1)).alias("preview_rows"),
    )
    title = (
        cells.join(heads, SHEET_KEYS)
        .where((F.col("row") < F.col("header_row")) & (strip(F.col("value")) != ""))
        .groupBy(*SHEET_KEYS)
        .agg(F.count("*").alias("title_cells"))
    )
    joined = (
        sheets.join(heads, SHEET_KEYS, "left").join(header_cells, SHEET_KEYS, "left")
        .join(facts, SHEET_KEYS, "left").join(title, SHEET_KEYS, "left")
    )
    headers, n = F.col("headers"), F.size("headers")
    line = F.array_join(headers, " ")
    has_key, has_variable = _any_in(headers, fixed.SHEET_KEY_TOKENS), _any_in(headers, fixed.SHEET_VARIABLE_TOKENS)
    content = (
        F.when(F.col("n_rows").isNull(), "empty")
        .when(F.col("header_row").isNull(), "unknown")
        .when(has_key & has_variable, "dictionary")
        .when((n <= 4) & has_variable & line.rlike("|".join(fixed.SHEET_KEY_TOKENS)), "dictionary")
        .when((F.col("header_row") > 3) & (F.col("title_cells") >= 3) & (n <= 6), "dashboard")
        .when((n >= 3) & (F.col("body_fill") >= F.greatest(F.lit(2.0), n * 0.4)), "data")
        .when(n.isin(2, 3) & line.rlike("|".join(fixed.SHEET_SHORT_HEADER_TOKENS)), "dictionary")
        .when(
            (F.col("n_cols") >= 3)
            & (ratio(F.col("preview_filled"), F.col("preview_rows") * F.col("n_cols")) >= 0.2),
            "data",
        )
        .otherwise("unknown")
    )
    by_name = sheet_name_role(F.col("sheet"))
    role = F.when(content.isin("empty", "data") | by_name.isNull(), content).otherwise(by_name)
    return joined.select(
        *SHEET_KEYS, role.alias("sheet_role"), "header_row",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_cols",
    )
