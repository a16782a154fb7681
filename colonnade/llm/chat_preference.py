"""Chat formatting for preference training: a shared prompt, and the two completions with their loss masks.

A pair is two conversations. Their longest common run of first turns (equal role and text) is rendered once as the prompt;
what follows in each is its completion. A mask lists the spans of a completion that the loss sees: the texts of assistant
turns with the sign that ends them, as start:end in code points, comma-joined.

Defined results: turns are ordered by number, then role, then text, nulls first; a null role or text is an empty one. Equal
rows stay. A pair of which one conversation is missing has prompt and completion of the other with the prompt empty, and
null for the missing one. Conversations without an id take no part. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def _rendered(turns: Column) -> Column:
    """Turns as text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """Spans of the assistant's turns within the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(t["role"]) + F.lit(len(OPEN) + len(CLOSE))
        end = begin + F.length(t["text"]) + F.lit(len(END))
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.array_join(F.aggregate(turns, start, add, lambda s: s["spans"]), ",")


def format_pairs(turns: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """``pair_id``, the two conversations' ids, number of common turns, ``prompt``, and completion and mask of each.

    ``turns`` has conv_id, turn, role, text; ``pair`` names a turn's pair and ``chosen`` says on which side it is.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    talks = turns.filter("conv_id is not null").groupBy(pair.alias("pair_id"), "conv_id", chosen.alias("chosen")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    side = lambda yes, column: F.max(F.when(F.col("chosen") if yes else ~F.col("chosen"), F.col(column)))
    pairs = talks.groupBy("pair_id").agg(
        side(True, "conv_id").alias("chosen_id"), side(False, "conv_id").alias("rejected_id"), side(True, "turns").alias("a"), side(False, "turns").alias("b")
    )
    differ = F.filter(
        F.sequence(F.lit(0), F.least(F.size("a"), F.size("b"))),
        lambda i: ~F.coalesce((F.get("a", i)["role"] == F.get("b", i)["role"]) & (F.get("a", i)["text"] == F.get("b", i)["text"]), F.lit(False)),
    )
    common = F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0)).otherwise(F.get(differ, F.lit(0)))
    cut = pairs.withColumn("n_common", common)
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0)))
    parts = cut.select(
        "pair_id", "chosen_id", "rejected_id", "n_common", F.slice(F.coalesce("a", "b"), F.lit(1), F.col("n_common")).alias("shared"),
        rest(F.col("a")).alias("a"), rest(F.col("b")).alias("b"),
    )
    return parts.select(
        "pair_id", "chosen_id", "rejected_id", "n_common", _rendered(F.col("shared")).alias("prompt"),
        _rendered(F.col("a")).alias("chosen_completion"), F.when(F.col("a").isNotNull(), _mask(F.col("a"))).alias("chosen_mask"),
        _rendered(F.col("b")).alias("rejected_completion"), F.when(F.col("b").isNotNull(), _mask(F.col("b"))).alias("rejected_mask"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as preference pairs: of ids 2k and 2k + 1 the first is chosen, the second rejected."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return format_pairs(turns, F.floor(F.col("conv_id") / 2), F.pmod(F.col("conv_id"), F.lit(2)) == 0)


ORACLE = """
WITH c AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id,
    list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), p AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, a.conv_id AS chosen_id, b.conv_id AS rejected_id, a.t AS a, b.t AS b
  FROM (SELECT * FROM c WHERE conv_id % 2 = 0) a FULL JOIN (SELECT * FROM c WHERE conv_id % 2 <> 0) b USING (pair_id)
), n AS (
  SELECT *, CASE WHEN a IS NULL OR b IS NULL THEN 0
    ELSE coalesce(list_min(list_filter(range(0, least(len(a), len(b))), lambda i: a[i + 1] <> b[i + 1])), least(len(a), len(b))) END AS n_common
  FROM p
), r AS (
  SELECT pair_id, chosen_id, rejected_id, n_common, coalesce(a, b)[1:n_common] AS s, a[n_common + 1:] AS a, b[n_common + 1:] AS b FROM n
), x AS (
  SELECT *, list_transform(s, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS ss,
    list_transform(a, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS aa,
    list_transform(b, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS bb
  FROM r
)
SELECT pair_id, chosen_id, rejected_id, CAST(n_common AS INTEGER) AS n_common, coalesce(array_to_string(ss, ''), '') AS prompt,
  array_to_string(aa, '') AS chosen_completion, array_to_string(bb, '') AS rejected_completion,
  array_to_string(list_transform(list_filter(range(1, len(a) + 1), lambda i: a[i].role = 'assistant'), lambda i:
    CAST(coalesce(list_sum(list_transform(aa[1:i - 1], lambda u: length(u))), 0) + 14 AS BIGINT) || ':' ||
    CAST(list_sum(list_transform(aa[1:i], lambda u: length(u))) AS BIGINT)), ',') AS chosen_mask,
  array_to_string(list_transform(list_filter(range(1, len(b) + 1), lambda i: b[i].role = 'assistant'), lambda i:
    CAST(coalesce(list_sum(list_transform(bb[1:i - 1], lambda u: length(u))), 0) + 14 AS BIGINT) || ':' ||
    CAST(list_sum(list_transform(bb[1:i], lambda u: length(u))) AS BIGINT)), ',') AS rejected_mask
FROM x
"""
