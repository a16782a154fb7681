"""Matching column values against reference code lists of spatial levels.

The reference table is expanded, not the data: every code contributes its own form and the forms that zero-padding
would turn into it, so that each distinct value needs exactly one equi-join on its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colonnade.functions import fixed
from colonnade.functions.names import level_hits
from colonnade.functions.numbers import padded_code, ratio
from colonnade.functions.text import code_key, column_key, name_key, strip
from colonnade.session import stage

REFERENCE_SCHEMA = "level string, level_rank int, code string, nom string"


def specificity(level: Column) -> Column:
    """Position of a level from general to specific; -1 for an unknown level."""
    known = F.array(*[F.lit(name) for name in fixed.LEVEL_SPECIFICITY])
    return F.coalesce(F.array_position(known, level) - 1, F.lit(-1)).cast("int")


def level_name(level: Column) -> Column:
    """Reported name of a reference level key."""
    names = F.create_map(*[F.lit(x) for pair in fixed.LEVEL_NAMES.items() for x in pair])
    return F.coalesce(names[level], level)


def common_code_lengths(reference: DataFrame, top: int = 3) -> DataFrame:
    """Most frequent code lengths of every level; shorter lengths win ties."""
    lengths = (
        reference.where("code IS NOT NULL")
        .select("level", code_key(F.col("code")).alias("code"))
        .distinct()
        .groupBy("level", F.length("code").alias("length"))
        .agg(F.count("*").alias("n"))
    )
    order = W.partitionBy("level").orderBy(F.desc("n"), "length")
    return lengths.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def reference_keys(reference: DataFrame) -> DataFrame:
    """Join keys of the code lists: (level, level_rank, by, key, code, long_code, common).

    ``common`` tells that the key needs no padding or padding to one of the level's common lengths only.
    """
    codes = (
        reference.where("code IS NOT NULL").select("level", "level_rank", code_key(F.col("code")).alias("code")).distinct()
    )
    lengths = common_code_lengths(reference).groupBy("level").agg(F.collect_list("length").alias("lengths"))
    zeros = F.length(F.regexp_extract("code", "^(0*)", 1))
    forms = F.transform(
        F.sequence(F.lit(0), F.when(F.col("code").rlike("[A-Z]"), 0).otherwise(zeros)),
        lambda k: F.struct(F.expr("code").substr(k + 1, F.length("code")).alias("key"), (k == 0).alias("same")),
    )
    padded = (
        codes.join(lengths, "level")
        .select("level", "level_rank", "code", "lengths", F.explode(forms).alias("form"))
        .select(
            "level", "level_rank", F.lit("code").alias("by"), F.col("form.key").alias("key"), "code",
            F.col("form.same").alias("same"), (F.col("form.same") | F.array_contains("lengths", F.length("code"))).alias("common"),
        )
    )
    # several codes can be reached from one value: its own form comes first, then the shortest padding;
    # file names try the longest padding first
    by_code = (
        padded.groupBy("level", "level_rank", "by", "key")
        .agg(
            F.min_by("code", F.struct(F.length("code"), "code")).alias("code"),
            F.max_by("code", F.struct("same", F.length("code"))).alias("long_code"),
            F.max("common").alias("common"),
        )
    )
    by_name = (
        reference.where("nom IS NOT NULL")
        .select("level", "level_rank", name_key(F.col("nom")).alias("key"))
        .distinct()
        .select("level", "level_rank", F.lit("nom").alias("by"), "key", F.lit(None).cast("string").alias("code"),
                F.lit(None).cast("string").alias("long_code"), F.lit(True).alias("common"))
    )
    return by_code.unionByName(by_name)


def _keyed(values: DataFrame, group: list[str]) -> DataFrame:
    """Two rows per distinct value: its code key and its name key."""
    text = padded_code(F.col("v"))
    return values.select(
        *group, "v",
        F.inline(
            F.array(
                F.struct(F.lit("code").alias("by"), code_key(text).alias("key")),
                F.struct(F.lit("nom").alias("by"), name_key(text).alias("key")),
            )
        ),
    )


def value_hits(
    values: DataFrame, keys: DataFrame, group: list[str], *, by: str | None = None, gated: bool = False
) -> DataFrame:
    """Every (value, level) a distinct value belongs to.

    ``values`` holds ``group`` columns and distinct texts ``v``; with ``gated`` also ``levels``, the level keys a
    column may be matched with (null for all).  No broadcast is forced: Spark broadcasts the keys only when their
    measured size is under its threshold, and joins by shuffle beyond it.
    """
    carried = group + (["levels"] if gated else [])
    keyed = _keyed(values, carried)
    if by:
        keyed = keyed.where(F.col("by") == by)
    hits = keyed.join(keys, ["by", "key"])
    if gated:
        hits = hits.where(F.col("levels").isNull() | F.array_contains("levels", F.col("level")))
    return hits.select(*group, "v", "level", "level_rank", "by", "code", "common")


def level_ratios(values: DataFrame, keys: DataFrame, group: list[str], *, gated: bool = False) -> DataFrame:
    """Share of a column's distinct values found in each level, by code and by name."""
    totals = values.groupBy(*group).agg(F.count("*").alias("n_values"))
    hits = (
        value_hits(values, keys, group, gated=gated)
        .where("common")
        .groupBy(*group, "level", "level_rank")
        .agg(
            F.sum((F.col("by") == "code").cast("long")).alias("code_hits"),
            F.sum((F.col("by") == "nom").cast("long")).alias("name_hits"),
        )
    )
    return hits.join(totals, group).select(
        *group, "level", "level_rank", "n_values",
        ratio(F.col("code_hits"), F.col("n_values")).alias("code_ratio"),
        ratio(F.col("name_hits"), F.col("n_values")).alias("name_ratio"),
    )


def best_level(values: DataFrame, keys: DataFrame, group: list[str], *, gated: bool = False) -> DataFrame:
    """Best level of each column: (level, by, ratio); codes win over names, earlier levels win ties."""
    best = F.greatest("code_ratio", "name_ratio")
    order = W.partitionBy(*group).orderBy(F.desc(best), "level_rank")
    return (
        level_ratios(values, keys, group, gated=gated)
        .withColumn("rank", F.row_number().over(order))
        .where("rank = 1")
        .select(
            *group,
            level_name(F.col("level")).alias("level"),
            F.when(F.col("code_ratio") >= F.col("name_ratio"), "code").otherwise("nom").alias("by"),
            best.alias("ratio"),
        )
    )


def value_levels(
    values: DataFrame, keys: DataFrame, group: list[str], *, by: str | None = None, gated: bool = False
) -> DataFrame:
    """Most specific level of every matching distinct value, with the value to report.

    Values naming the country belong to the country level; code hits report the listed code, name hits the value.
    """
    is_country = name_key(F.col("v")).isin(*fixed.COUNTRY_NAME_ALIASES)
    filled = values.where(strip(F.col("v")) != "")
    if by is None:
        country = filled.where(is_country).select(
            *group, "v", F.lit("country").alias("level"), F.lit(fixed.COUNTRY_LABEL).alias("value")
        )
        filled = filled.where(~is_country)
    hits = value_hits(filled, keys, group, by=by, gated=gated).withColumn("level", level_name(F.col("level")))
    order = W.partitionBy(*group, "v").orderBy(F.desc(specificity(F.col("level"))), "by", "level_rank")
    chosen = (
        hits.withColumn("rank", F.row_number().over(order))
        .where("rank = 1")
        .select(*group, "v", "level", F.when(F.col("by") == "code", F.col("code")).otherwise(strip(F.col("v"))).alias("value"))
    )
    return chosen if by else chosen.unionByName(country)


def mixed_levels(levels: DataFrame, group: list[str], minimum: int = 2) -> DataFrame:
    """Columns whose values lie on several levels: (group, level, value, most_specific, contains_aggregates)."""
    distinct = levels.select(*group, "level", "value").distinct()
    per_column = (
        distinct.groupBy(*group, "level")
        .agg(F.count("*").alias("n"))
        .groupBy(*group)
        .agg(
            F.array_sort(F.collect_list(F.struct(specificity(F.col("level")).alias("pos"), "level"))).alias("found"),
        )
        .where(F.size("found") >= minimum)
        .select(
            *group,
            F.col("found.level").alias("mixed_levels"),
            F.element_at("found", -1)["level"].alias("most_specific"),
        )
    )
    return distinct.join(per_column, group)


def _at_level(codes: Column, level: str, name: str) -> Column:
    """Codes found in a text, in upper case, each with its level."""
    return F.transform(codes, lambda code: F.struct(F.lit(level).alias("level"), F.upper(code).alias(name)))


def file_name_levels(names: DataFrame, keys: DataFrame, *, name: str = "name") -> DataFrame:
    """Spatial levels named in file names with a listed code: (name, granularity, value)."""
    stem = column_key(F.regexp_replace(F.col(name), r"\.[^./]*$", ""))
    found = []
    for level, aliases in fixed.FILE_NAME_LEVEL_ALIASES:
        for alias in aliases:
            pattern = f"(?:^|_){alias}_?(2a|2b|[0-9a-z]{{1,9}})(?:_|$)"
            found.append(
                _at_level(F.regexp_extract_all("stem", F.lit(pattern), F.lit(1)), level, "key")
            )
    return (
        names.select(name, stem.alias("stem"))
        .select(name, F.inline(F.flatten(F.array(*found))))
        .distinct()
        .join(keys.where("by = 'code'"), ["level", "key"])
        .select(name, level_name(F.col("level")).alias("granularity"), F.col("long_code").alias("value"))
        .distinct()
    )


#: Words of a text that a row of the index carries: a name of no more words is compared in the index itself.
INDEX_WORDS = 4


def _line(t: Column) -> Column:
    """A folded text as words between single blanks."""
    words = F.regexp_replace(t, "[^a-z0-9]+", " ")
    line = F.concat(F.lit(" "), F.when(F.contains(t, F.lit("_")), words).otherwise(F.concat_ws(" ", t, words)), F.lit(" "))
    return F.regexp_replace(line, " +", " ")


def names_in_text(texts: DataFrame, reference: DataFrame, *, key: str, text: str) -> DataFrame:
    """Reference names of any length and codes mentioned in texts: (key, level, by, value).

    Texts are folded once into an index: every word with the few that follow it, and the codes.  A name is looked up by
    its first two words and compared with those that follow; what is found is written down.  Only a name of more than
    ``INDEX_WORDS`` words whose beginning was found is compared with the text itself, which is read and folded again for
    these pairs.  ``key`` names each text once.
    """
    lines = texts.select(key, column_key(F.col(text)).alias("t")).withColumn("line", _line(F.col("t")))
    names = (
        reference.where("nom IS NOT NULL").select("level", name_key(F.col("nom")).alias("value")).distinct()
        .where((F.length("value") >= 4) & ~F.col("value").rlike("^[0-9]+$"))
        .withColumn("n", F.size(F.split("value", " ")))
    )
    segments = F.split("t", "_")
    inner = F.when(F.size(segments) > 2, F.slice(segments, 2, F.size(segments) - 2)).otherwise(F.array().cast("array<string>"))
    spaces = lambda words: F.transform(words, lambda w: F.concat(w, F.lit(" ")))
    alone = F.array_distinct(F.concat(spaces(inner), spaces(F.split(F.trim("line"), " "))))
    # the look-ahead finds a group at every word without using it up, so neighbouring groups overlap
    groups = F.regexp_extract_all("line", F.lit("(?<= )(?=((?:[^ ]+ ){2,%d}))" % INDEX_WORDS), F.lit(1))
    # a code does not end with a blank, all words do
    marked = lambda level, code: F.concat(F.lit("="), level, F.lit("="), code)
    found_codes = lambda level, pattern, group: F.transform(
        F.regexp_extract_all("t", F.lit(pattern), F.lit(group)), lambda c: marked(F.lit(level), F.upper(c))
    )
    codes_of = [found_codes(*trial) for trial in fixed.TEXT_CODE_PATTERNS]
    # outer: else Spark tests the array before it explodes it, by folding the text anew at each place that names it
    index = lines.select(key, F.explode_outer(F.concat(alone, groups, F.array_distinct(F.concat(*codes_of)))).alias("found"))
    start = lambda found: F.substring_index(found, " ", 2).alias("start")
    codes = reference.where("code IS NOT NULL").select("level", code_key(F.col("code")).alias("value")).distinct()
    code = marked(F.col("level"), F.col("value"))
    beginning = F.concat(F.substring_index("value", " ", INDEX_WORDS), F.lit(" "))
    begins = names.select("level", F.lit("nom").alias("by"), "value", "n", beginning.alias("beginning"), start(beginning)).unionByName(
        codes.select("level", F.lit("code").alias("by"), "value", F.lit(0).alias("n"), code.alias("beginning"), start(code))
    )
    fits = F.when(F.col("by") == "code", F.col("found") == F.col("beginning")).otherwise(F.startswith("found", "beginning"))
    begun = index.withColumn("start", start(F.col("found"))).join(begins, "start").where(fits)
    begun = stage(begun.select(key, "level", "by", "value", "n").distinct(), "names-begun")
    short = begun.where(F.col("n") <= INDEX_WORDS)
    spaced = F.concat(F.lit(" "), F.col("value"), F.lit(" "))
    read = texts.select(key, F.col(text).alias("text of row"))
    long = begun.where(F.col("n") > INDEX_WORDS).join(read, key).where(F.contains(_line(column_key(F.col("text of row"))), spaced))
    wanted = (key, "level", "by", "value")
    return short.select(*wanted).unionByName(long.select(*wanted)).distinct()


def column_levels(columns: DataFrame, *, strict: bool = False) -> DataFrame:
    """Level keys named in each column name."""
    return columns.withColumn("levels", level_hits(column_key(F.col("column")), strict=strict))
