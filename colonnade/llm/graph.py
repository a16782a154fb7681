"""Connected components of a table of links, by joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.session import stage as written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each end of the links ``a, b``: root is the smallest node that links reach.

    Each round takes the least root among a node's neighbours, then the root of that root, until nothing changes. Tables
    are written each round, so plans stay short, and no node's links are collected in one row.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    both = written(both.distinct(), "links")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
    while True:
        seen = roots.select(F.col("node").alias("b"), F.col("root").alias("near"))
        least = both.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        pulled = written(roots.join(least, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("old")), "roots")
        jump = pulled.select(F.col("node").alias("root"), F.col("root").alias("further"))
        moved = pulled.join(jump, "root").select("node", F.least("root", "further").alias("root"), "old")
        moved = written(moved, "roots")
        roots = moved.select("node", "root")
        if moved.filter("root <> old").isEmpty():
            return roots
