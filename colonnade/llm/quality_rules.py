"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Defined results: a null or empty text has no words, so all counts are 0 and it fails the base rule. Every input row gives
one row, repeated rows included; an empty table gives no rows. The operator adds columns under the names it is given and
leaves all others, so tables with columns of the same names as its inner values are safe. Ratios are per word or per line,
compared by multiplication, so nothing is divided by 0. Texts of any length are counted whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import word_array

#: Frequent function words of the languages that the rules are meant for.
STOP_WORDS = (
    "the and of to in is that it for was on are with as be this from by an at or have not "
    "le la les des un une et de du en que qui dans pour est au par sur pas avec ce "
    "der die das und zu den von mit sich des auf für ist im dem nicht ein eine als auch "
    "el los las del y se por con para una su al lo como más o"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= count / per <= high`` for two of the counts of a text; a missing bound is none."""

    name: str
    count: str
    per: str
    low: float | None = None
    high: float | None = None


#: Judged in turn; ``rejected_by`` names the first that a text breaks.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("exclamations", "n_exclamations", "n_words", high=0.25),
    Rule("stop_words", "n_stop_words", "n_words", low=0.03),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """Add ``repeats``: the positions of the runs of three words that a text holds twice or more, in order.

    Each run is one number: its hash shifted left by as many bits as a position takes, plus its position. Sorting brings
    equal runs together. Most texts repeat no run and need no sort. Each step is a projection of its own, so that Spark
    computes the arrays once and sorts them as plain numbers.
    """
    words, runs, keys, bits = F.col("words"), F.col("runs"), F.col("keys"), F.col("bits")
    none = F.array().cast("array<bigint>")
    shift = lambda f, x, n: F.call_function(f, x, n)
    at = lambda k: k.bitwiseAND(shift("shiftleft", F.lit(1).cast("long"), bits) - 1)
    hashed = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    sorted_keys = F.sort_array(F.transform(runs, lambda h, i: shift("shiftleft", h, bits).bitwiseOR(i.cast("long"))))
    before = F.filter(
        F.sequence(F.lit(0), F.size(keys) - 2),
        lambda i: shift("shiftrightunsigned", F.get(keys, i).bitwiseXOR(F.get(keys, i + 1)), bits) == 0,
    )
    found = F.col("before")
    both = F.array_union(F.transform(found, lambda i: at(F.get(keys, i))), F.transform(found, lambda i: at(F.get(keys, i + 1))))
    return (
        docs.withColumn("runs", F.when(F.size(words) < 4, none).otherwise(hashed))
        .withColumn("bits", F.length(F.bin(F.size(runs))))
        .withColumn("keys", F.when(F.size(F.array_distinct(runs)) == F.size(runs), none).otherwise(sorted_keys))
        .withColumn("before", F.when(F.size(keys) < 2, F.array().cast("array<int>")).otherwise(before))
        .withColumn("repeats", F.sort_array(both))
    )


def _covered(at: Column) -> Column:
    """Number of words in runs of three words that start at these positions."""
    gaps = F.transform(F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))), lambda p, i: F.least(F.lit(3), p - F.get(at, i)))
    return F.when(F.size(at) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3).cast("long"), lambda a, g: a + g)).cast("long")


def counts(text: Column, words: Column, repeats: Column) -> dict[str, Column]:
    """The counts of a text that rules can name; ``words`` is its word array, ``repeats`` where its repeated runs start."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"),
        "n_exclamations": (F.length(whole) - F.length(F.replace(whole, F.lit("!"), F.lit("")))).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
        "n_repeat_words": _covered(repeats),
        "lines": F.struct(F.size(lines).cast("long").alias("n"), F.size(F.array_distinct(lines)).cast("long").alias("different")),
    }


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Name of the first rule that a row with the counts as columns breaks, else null."""
    broken = []
    for rule in rules:
        count, per = F.col(rule.count).cast("double"), F.col(rule.per).cast("double")
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (count < F.lit(rule.low) * per)
        if rule.high is not None:
            bad = bad | (count > F.lit(rule.high) * per)
        broken.append(F.when(bad, F.lit(rule.name)))
    return F.coalesce(*broken) if broken else F.lit(None).cast("string")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_exclamations", "n_stop_words", "n_dup_lines", "n_lines", "n_repeat_words")


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, into: str = "quality") -> DataFrame:
    """``docs`` with a struct ``into``: the counts, ``base_failed``, ``kept`` and ``rejected_by``."""
    columns = [F.col(f"`{c}`") for c in docs.columns if c != into]
    kept = docs.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").alias("text"), word_array(F.col(f"`{text}`")).alias("words"))
    kept = _with_repeats(kept)
    of = counts(F.col("text"), F.col("words"), F.col("repeats"))
    lines = of.pop("lines")
    counted = kept.select("row", lines.alias("lines"), *[c.alias(n) for n, c in of.items()]).select(
        "row", *of, F.col("lines.n").alias("n_lines"), (F.col("lines.n") - F.col("lines.different")).alias("n_dup_lines")
    )
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # a filter on the verdict would be moved below the projections, and repeat them in one expression; a task's number
    # is not deterministic for Spark, so the filter stays above
    judged = counted.select("row", *COUNTS, base.alias("base_failed"), compile_rules(rules).alias("rejected_by"), F.spark_partition_id().alias("task"))
    kept = ~F.col("base_failed") & F.col("rejected_by").isNull() & (F.col("task") >= 0)
    verdict = F.struct(*COUNTS, "base_failed", kept.alias("kept"), "rejected_by")
    return judged.select("row.*", verdict.alias(into))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("doc_id", *[F.col(f"quality.{c}") for c in (*COUNTS, "base_failed", "kept", "rejected_by")])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep."""
    return judge(docs, into="quality rules").filter(F.col("`quality rules`.kept")).drop("quality rules")
