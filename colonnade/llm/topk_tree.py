"""Exact top-k inner-product search by dual-tree traversal of cover trees.

Queries and data share the top of the tree: centres taken farthest-first from a sample of bounded size (``SAMPLE``), with
every row in the cell of its nearest centre. Below it, a cell's rows lie in blocks and its queries in groups of bounded
size, each with a cover tree of its own in numpy. A pair of nodes is left out when the largest product that their centres
and covering radii allow is below the worst kth score of the node's queries. A group first searches its own cell; with the
scores found there, whole cells are left out, and the rest is searched block by block. Nothing else limits candidates.

Defined results: vectors that are null, or hold null or non-finite components, and rows without an id take no part. Shorter
vectors count as filled with zeros. Equal rows (id and vector) count once; an id with several vectors is as many
candidates; a query never finds its own id. Products are exact below 2^53. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colonnade.session import stage as written

#: Rows that the centres are chosen from, centres, rows of a block, queries of a group, children and rows of a tree's node.
SAMPLE, CENTRES, BLOCK, GROUP, CHILDREN, LEAF = 1024, 16, 8192, 512, 8, 128

_RESULT = "query_id long, vec_id long, score long, grp long, cell int"


def farthest_first(points: np.ndarray, most: int, stop: float = 0.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Indices of centres, each farthest from those before, until all points are within ``stop``; nearest centre and its distance."""
    chosen, near = [0], np.zeros(len(points), dtype=np.int64)
    gap = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most and gap.max() > stop:
        at = int(gap.argmax())
        new = np.linalg.norm(points - points[at], axis=1)
        near[new < gap] = len(chosen)
        gap = np.minimum(gap, new)
        chosen.append(at)
    return chosen, near, gap


class Tree:
    """A cover tree: nodes with a centre, the radius that covers their rows, and children of at most half that radius,
    if so many are enough."""

    def __init__(self, points: np.ndarray):
        self.points, self.nodes = points, []
        self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray) -> int:
        points = self.points[rows]
        centre = points[0] if len(points) <= 2 else points[np.linalg.norm(points - points.mean(axis=0), axis=1).argmin()]
        radius = float(np.linalg.norm(points - centre, axis=1).max())
        number = len(self.nodes)
        self.nodes.append([centre, radius, float(np.linalg.norm(centre)), rows, []])
        if len(rows) > LEAF and radius > 0:
            chosen, near, _ = farthest_first(points, CHILDREN, radius / 2)
            self.nodes[number][4] = [self._grow(rows[near == i]) for i in range(len(chosen))]
        elif len(rows) > LEAF:  # equal rows only
            self.nodes[number][4] = [self._grow(rows[i : i + LEAF]) for i in range(0, len(rows), LEAF)]
        return number


def search(queries: np.ndarray, query_ids: np.ndarray, tree: Tree, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best rows for each query, -inf where there are fewer."""
    own = Tree(queries)
    best = np.full((len(queries), k), -np.inf)
    names = np.full((len(queries), k), np.iinfo(np.int64).max)

    def bound(q: int, d: int) -> float:
        (cq, rq, nq, *_), (cd, rd, nd, *_) = own.nodes[q], tree.nodes[d]
        most = float(cq @ cd) + nq * rd + nd * rq + rq * rd
        return most + 1e-9 * abs(most) + 1e-6

    todo = [(bound(0, 0), 0, 0)]
    while todo:
        most, q, d = todo.pop()
        rows_q, under_q = own.nodes[q][3], own.nodes[q][4]
        if most < best[rows_q, -1].min():
            continue
        rows_d, under_d = tree.nodes[d][3], tree.nodes[d][4]
        if under_q or under_d:
            pairs = [(bound(a, b), a, b) for a in under_q or [q] for b in under_d or [d]]
            todo += sorted(pairs)  # the most promising is taken next
            continue
        scores = queries[rows_q] @ tree.points[rows_d].T
        scores[query_ids[rows_q][:, None] == ids[rows_d][None, :]] = -np.inf
        hit = np.flatnonzero((scores >= best[rows_q, -1][:, None]).any(axis=1))
        if len(hit):
            r = rows_q[hit]
            all_scores = np.hstack([best[r], scores[hit]])
            all_names = np.hstack([names[r], np.where(np.isinf(scores[hit]), np.iinfo(np.int64).max, ids[rows_d][None, :])])
            order = np.lexsort((all_names, -all_scores), axis=-1)[:, :k]
            best[r], names[r] = np.take_along_axis(all_scores, order, 1), np.take_along_axis(all_names, order, 1)
    return best, names


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lists = column.cast(pa.large_list(pa.float64()))
    sizes = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lists), width))
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(lists.flatten())
    return out


def top_k(rows: DataFrame, is_query, k: int = 10, id_column: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row that ``is_query`` marks, the k best other rows by integer product."""
    x = F.transform(F.col(f"`{vector}`"), lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("double"))
    bad = F.exists(F.col(f"`{vector}`"), lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    valid = rows.filter(F.col(f"`{id_column}`").isNotNull() & F.col(f"`{vector}`").isNotNull() & ~bad)
    full = F.array_max(F.transform("v", lambda c, i: F.when(c != 0, i + 1).otherwise(0)))  # zeros at the end are as good as missing
    valid = valid.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), x.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    valid = valid.withColumn("v", F.slice("v", F.lit(1), F.coalesce(full, F.lit(0))))
    # equal rows are one before they are queries and candidates
    valid = written(valid.groupBy("vec_id", "v").agg(F.max("asks").alias("asks")), "topk-vectors")
    width = valid.agg(F.max(F.size("v"))).first()[0] or 1
    picked = valid.select("v", F.xxhash64("vec_id").alias("order")).orderBy("order", "v").limit(SAMPLE).collect()
    sample = _matrix(pa.array([r["v"] for r in picked], pa.list_(pa.float64())), width) if picked else np.zeros((1, width))
    centres = sample[farthest_first(sample, CENTRES)[0]]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v"), width)
            gaps = np.sqrt(np.maximum((points**2).sum(1)[:, None] + (centres**2).sum(1)[None] - 2 * points @ centres.T, 0))
            cell = gaps.argmin(axis=1)
            exact = np.linalg.norm(points - centres[cell], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(exact)], ["vec_id", "v", "asks", "cell", "gap"])

    placed = written(valid.mapInArrow(place, "vec_id long, v array<double>, asks boolean, cell int, gap double"), "topk-cells")
    facts = {(r["cell"], r["asks"]): r for r in placed.groupBy("cell", "asks").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()}
    rows_in = {c: sum(facts[c, a]["n"] for a in (True, False) if (c, a) in facts) for c in range(len(centres))}
    radius = {c: max(facts[c, a]["radius"] for a in (True, False) if (c, a) in facts) for c, n in rows_in.items() if n}
    blocks = F.element_at(F.array(*[F.lit(-(-max(rows_in[c], 1) // BLOCK)) for c in range(len(centres))]), F.col("cell") + 1)
    groups = F.element_at(F.array(*[F.lit(-(-max(facts[c, True]["n"] if (c, True) in facts else 1, 1) // GROUP)) for c in range(len(centres))]), F.col("cell") + 1)
    data = placed.select("cell", F.xxhash64("cell", F.pmod(F.xxhash64("vec_id"), blocks)).alias("block"), "vec_id", "v")
    places = written(data.groupBy("cell", "block").count().select("cell", "block"), "topk-blocks")
    asking = placed.filter("asks").select(F.xxhash64("cell", F.pmod(F.xxhash64(F.lit(1), "vec_id"), groups), F.lit("q")).alias("grp"), "cell", "vec_id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block: first its data, then its groups of queries."""
        key = part = None
        tree, ids, held = None, np.zeros(0, np.int64), []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal tree, ids
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            points, names = _matrix(table.column("v").combine_chunks(), width), table.column("vec_id").to_numpy()
            if part == (False, 0):
                tree, ids = Tree(points), names
            elif tree is not None:
                scores, found = search(points, names, tree, ids, k)
                i, j = np.nonzero(~np.isinf(scores))
                home = table.column("cell").to_numpy()
                columns = [names[i], found[i, j], scores[i, j].astype(np.int64), np.full(len(i), part[1]), home[i].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score", "grp", "cell"])
            held.clear()

        for batch in batches:
            table = list(zip(batch.column("block").to_pylist(), batch.column("asks").to_pylist(), batch.column("grp").to_pylist(), strict=True))
            cuts = [0, *[i for i in range(1, len(table)) if table[i] != table[i - 1]], len(table)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b:
                    if (table[a][0], table[a][1:]) != (key, part):
                        yield from close()
                        if table[a][0] != key:
                            tree = None
                        key, part = table[a][0], table[a][1:]
                    held.append(batch.slice(a, b - a))
        yield from close()

    def meet(pairs: DataFrame) -> DataFrame:
        """Search the blocks of the cells that each group is paired with: ``pairs`` has ``grp, into``."""
        routed = asking.join(pairs, "grp").join(places.withColumnRenamed("cell", "into"), "into").select("block", F.lit(True).alias("asks"), "grp", "cell", "vec_id", "v")
        used = data.join(written(routed.select("block").distinct(), "topk-used"), "block").select("block", F.lit(False).alias("asks"), F.lit(0).cast("long").alias("grp"), "cell", "vec_id", "v")
        dealt = used.unionByName(routed).repartition("block").sortWithinPartitions("block", "asks", "grp")
        return written(dealt.mapInArrow(run, _RESULT), "topk-found")

    own = written(asking.select("grp", F.col("cell").alias("into")).distinct(), "topk-groups")
    first = meet(own)
    kth = first.select("query_id", "grp", "score", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"))).alias("rank")).filter(f"rank = {k}")
    reached = kth.groupBy("grp").agg(F.min("score").alias("worst"), F.count_distinct("query_id").alias("n"))
    sizes = asking.groupBy("grp", "cell").agg(F.count_distinct("vec_id").alias("all"))
    worst = sizes.join(reached, "grp", "left").select("grp", "cell", F.when(F.col("all") == F.col("n"), F.col("worst")).alias("worst"))
    bounds = []
    for c in radius:
        for d in radius:
            if c != d:
                most = float(centres[c] @ centres[d]) + np.linalg.norm(centres[c]) * radius[d] + np.linalg.norm(centres[d]) * radius[c] + radius[c] * radius[d]
                bounds.append((c, d, float(most + 1e-9 * abs(most) + 1e-6)))
    spark = rows.sparkSession
    limits = spark.createDataFrame(bounds or [(-1, -1, 0.0)], "cell int, into int, most double")
    open_pairs = worst.join(limits, "cell").filter("worst is null or most >= worst").select("grp", "into")
    found = first.unionByName(meet(written(open_pairs, "topk-open"))).select("query_id", "vec_id", "score")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors of each vector whose id is divisible by 100."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
