"""Substring deduplication with prefix-partitioned suffix trees.

A word goes if a run of ``width`` words that covers it also starts in a document with a smaller id. The suffixes that can
start such a run are grouped by prefixes of variable length, so that each group fits in memory:

1. Documents with the same words are one class; all but the smallest id lose everything, one stands for them.
2. In each run of ``width`` words the n-gram of least hash is its anchor. Equal runs have equal anchors at equal places, so
   only about every twentieth suffix, one that starts at an anchor, needs to be sorted. Anchors found in one class only go.
3. Suffixes with the same anchor are a group. Its trees are arrays in numpy: the words after the anchor sorted, with the
   lengths that neighbours share, and the words before it likewise, read backwards. A run is a node of the first tree and
   one of the second whose depths add up to ``width``; a node holds the suffixes below it, of which the least id stays.
4. In groups of more than ``GROUP`` suffixes, equal ones are aggregated first. What is still more gets the longest prefix,
   the whole run: then a group is one deep node, of which only the least id matters. So no task holds such a group.

Defined results: a null or empty text has no words; fewer words than ``width`` lose none. A null id counts as greater than
all others. Repeated rows have one id, so none of them is removed for the other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import Words, chunks, mix, texts_of, windows
from colonnade.session import stage as written

#: Words of an anchor; suffixes of a group that one task sorts at most; rows of groups that it sorts together.
ANCHOR, GROUP, SORTED = 8, 2000, 4000

_LAST = (1 << 63) - 1


def _class(hashes: np.ndarray) -> int:
    """A hash of a sequence of word hashes."""
    at = np.arange(1, len(hashes) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(mix(hashes) + at).sum(dtype=np.uint64).view(np.int64))


def _anchors(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: the n-gram's hash, its place, and the first run whose anchor it is; plus a closing run."""
    grams = windows(hashes, ANCHOR)
    view = np.lib.stride_tricks.sliding_window_view(grams, width - ANCHOR + 1)
    place = np.concatenate([view[i : i + 65536].argmin(axis=1) + np.arange(i, min(i + 65536, len(view))) for i in range(0, len(view), 65536)])
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return grams[place[first]], place[first], np.r_[first, len(place)]


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, own, n_words, class, sha`` of every row; own is the id, or the greatest number for a null id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in chunks(batch.column("text")):
                part = batch.slice(at, to - at)
                words = Words(part.column("text"))
                first, data = words.first.tolist(), words.data.tobytes()
                start, end = words.start.tolist(), words.end.tolist()
                all_words = [data[a:b] for a, b in zip(start, end, strict=True)]
                spans = list(zip(first[:-1], first[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("own"), pa.array([b - a for a, b in spans], pa.int64()),
                        pa.array([_class(words.hash[a:b]) if b > a else None for a, b in spans], pa.int64()),
                        pa.array([hashlib.sha256(b" ".join(all_words[a:b])).hexdigest() for a, b in spans], pa.string()),
                    ],
                    ["doc_id", "own", "n_words", "class", "sha"],
                )

    return docs.mapInArrow(run, "doc_id long, own long, n_words long, class long, sha string")


def anchors(docs: DataFrame, width: int) -> DataFrame:
    """``gram, class, place`` of the anchors of every text; a class that a task meets again is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for at, to in chunks(batch.column("text")):
                words = Words(batch.column("text").slice(at, to - at))
                grams, classes, places = [], [], []
                for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                    if b - a >= width and (name := _class(words.hash[a:b])) not in met:
                        if len(met) < 100_000:
                            met.add(name)
                        gram, place, _ = _anchors(words.hash[a:b], width)
                        grams.append(gram)
                        places.append(place)
                        classes.append(np.full(len(gram), name))
                if grams:
                    columns = [np.concatenate(grams).view(np.int64), np.concatenate(classes), np.concatenate(places).astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "class", "place"])

    return docs.select("text").mapInArrow(run, "gram long, class long, place long")


def _each_text(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[Words, int, int, int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each text of the class that is asked for: its words, and of the anchors asked for their hash, place and runs."""
    for batch in batches:
        for at, to in chunks(batch.column("text")):
            part = batch.slice(at, to - at)
            words = Words(part.column("text"))
            rows = zip(part.column("class").to_pylist(), part.column("own").to_pylist(), part.column("places").to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)
            for name, own, places, a, b in rows:
                if b - a >= width and _class(words.hash[a:b]) == name:  # another text of the same id is another class
                    gram, place, runs = _anchors(words.hash[a:b], width)
                    asked = np.isin(place, np.array(places))
                    yield words, name, own, a, b, gram[asked], place[asked], runs[:-1][asked], runs[1:][asked]


def slices(texts: DataFrame, width: int) -> DataFrame:
    """``gram, kind, class, own, place, low, high, slice``: of each anchor its runs' first and last start, their words, and
    a hash of the words with the anchor's place in them."""
    names = ["gram", "kind", "class", "own", "place", "low", "high", "slice"]
    kinds = (*[pa.int64()] * 7, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for words, name, own, a, _b, gram, place, low, high in _each_text(batches, width):
            for g, p, first, stop in zip(gram.view(np.int64).tolist(), place.tolist(), low.tolist(), high.tolist(), strict=True):
                data = words.data[words.start[a + first] : words.end[a + stop + width - 2]].tobytes()
                inner = np.r_[words.hash[a + first : a + stop + width - 1], np.array([p - first, stop - 1 - first], np.uint64)]
                rows.append((g, _class(inner), name, own, p, first, stop - 1, data))
            if len(rows) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return texts.mapInArrow(run, "gram long, kind long, class long, own long, place long, low long, high long, slice binary")


def _shared(matrix: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorted suffix array of rows of words within their groups: the order, and what each row shares with the one before."""
    width = matrix.shape[1]
    order = np.lexsort((*[matrix[:, i] for i in range(width - 1, -1, -1)], group))
    sorted_rows, sorted_lengths, sorted_groups = matrix[order], lengths[order], group[order]
    differ = np.concatenate([sorted_rows[1:] != sorted_rows[:-1], np.ones((max(len(order) - 1, 0), 1), dtype=bool)], axis=1)
    common = np.minimum(differ.argmax(axis=1), np.minimum(sorted_lengths[1:], sorted_lengths[:-1]))
    common[sorted_groups[1:] != sorted_groups[:-1]] = -1
    return order, np.r_[-1, common]


def _nodes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """For each row the number of its node at a depth."""
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def repeats(gram: np.ndarray, own: np.ndarray, before: np.ndarray, runs: np.ndarray, words: Words, width: int) -> np.ndarray:
    """Which runs of the anchors in some groups also start in a document with a smaller id: bit d for the run that starts d
    words before the anchor. ``before``: words of the slice before the anchor; ``runs``: most d, least d."""
    n, reach = len(gram), width - ANCHOR
    first, total = words.first[:-1], np.diff(words.first)
    after = total - before
    code = np.r_[words.hash, np.uint64(0)].view(np.int64)
    step = np.arange(width)[None, :]
    right = np.where(step < after[:, None], code[np.minimum((first + before)[:, None] + step, len(code) - 1)], 0)
    step = np.arange(reach)[None, :]
    left = np.where(step < before[:, None], code[np.maximum((first + before)[:, None] - 1 - step, 0)], 0)
    group = np.cumsum(np.r_[True, gram[1:] != gram[:-1]])
    forward, backward = _shared(right, np.minimum(after, width), group), _shared(left, np.minimum(before, reach), group)
    found = np.zeros(n, dtype=np.int64)
    for d in range(reach + 1):
        here = np.flatnonzero((runs[:, 0] >= d) & (runs[:, 1] <= d))
        if len(here) < 2:
            continue
        key = _nodes(*forward, width - d)[here] * np.int64(n + 1) + _nodes(*backward, d)[here]
        order = np.lexsort((own[here], key))
        starts = np.r_[True, key[order][1:] != key[order][:-1]]
        least = own[here][order][np.flatnonzero(starts)][np.cumsum(starts) - 1]
        later = here[order[least < own[here][order]]]
        found[later] |= np.int64(1) << np.int64(d)
    return found


def by_trees(rows: DataFrame, width: int) -> DataFrame:
    """``class, own, place, mask`` of the anchors with repeated runs, from slices that lie together by anchor."""

    def work(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(parts).combine_chunks()
        column = lambda c: table.column(c).to_numpy()
        words = Words(table.column("slice").combine_chunks().cast(pa.large_string()))
        place, low, high = column("place"), column("low"), column("high")
        mask = repeats(column("gram"), column("own"), place - low, np.column_stack([place - low, place - high]), words, width)
        hit = np.flatnonzero(mask)
        if len(hit):
            return pa.RecordBatch.from_arrays([pa.array(column("class")[hit]), pa.array(column("own")[hit]), pa.array(place[hit]), pa.array(mask[hit])], ["class", "own", "place", "mask"])
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            for i in range(0, batch.num_rows, SORTED):
                held.append(batch.slice(i, SORTED))
                count += held[-1].num_rows
                if count < SORTED:
                    continue
                last = held[-1].column("gram")[-1].as_py()  # its group may go on
                table = pa.Table.from_batches(held).combine_chunks()
                whole = int((table.column("gram").to_numpy() != last).sum())
                if whole:
                    if (out := work(table.slice(0, whole).to_batches())) is not None:
                        yield out
                    held = table.slice(whole).to_batches()
                    count = table.num_rows - whole
        if count and (out := work(held)) is not None:
            yield out

    return rows.select("gram", "class", "own", "place", "low", "high", "slice").repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "class long, own long, place long, mask long")


def by_nodes(rows: DataFrame, width: int) -> DataFrame:
    """``class, mask`` like ``by_trees``, from whole runs as prefixes: one row for each run, whose hash is its node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("slice").cast(pa.large_string()))
            name, own, place = (batch.column(c).to_numpy() for c in ("class", "own", "place"))
            for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                node = windows(words.hash[a:b], width).view(np.int64)
                columns = [node, np.full(len(node), name[i]), np.full(len(node), own[i]), place[i] - np.arange(len(node))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "class", "own", "d"])

    starts = written(rows.select("class", "own", "place", "slice").mapInArrow(run, "node long, class long, own long, d long"), "substring-runs")
    least = written(starts.groupBy("node").agg(F.min("own").alias("least"), F.max("own").alias("most")).filter("least < most"), "substring-nodes")
    later = starts.join(least, "node").filter("least < own")
    return later.groupBy("class").agg(F.bit_or(F.expr("shiftleft(1L, cast(d as int))")).alias("mask"))


def by_kinds(rows: DataFrame, width: int) -> DataFrame:
    """``class, own, place, mask`` for anchors of large groups: equal slices are one suffix, which has the least id of its
    rows. The others of these lose all its runs; the one itself what the trees, or the nodes, of the different slices say."""
    rows = written(rows, "substring-hot")
    lead, span = F.col("place") - F.col("low"), F.col("high") - F.col("low")
    kinds = rows.groupBy("gram", F.col("kind").alias("class")).agg(
        F.min("own").alias("own"), F.any_value(lead).alias("place"), F.lit(0).cast("long").alias("low"), F.any_value(span).alias("high"), F.any_value("slice").alias("slice")
    )
    kinds = written(kinds, "substring-kinds")
    sizes = written(kinds.groupBy("gram").agg(F.count("*").alias("n")), "substring-sizes")
    sized = kinds.join(sizes, "gram")
    masks = by_trees(sized.filter(F.col("n") <= GROUP).drop("n"), width).select("class", "mask").unionByName(by_nodes(sized.filter(F.col("n") > GROUP), width))
    facts = kinds.select("class", "own").join(masks, "class", "left").select(F.col("class").alias("kind"), "own", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    every = F.expr("shiftleft(1L, cast(place - low + 1 as int)) - shiftleft(1L, cast(place - high as int))")
    # only the rows of a kind's least id are joined with what its slice loses; an anchor that has no such row loses all
    first = rows.select("kind", "class", "own", "place").join(written(facts, "substring-masks"), ["kind", "own"]).select("class", "own", "place", "mask")
    both = rows.select("class", "own", "place", every.alias("every"), F.lit(None).cast("long").alias("mask")).unionByName(first.withColumn("every", F.lit(None).cast("long")))
    found = both.groupBy("class", "own", "place").agg(F.max("every").alias("every"), F.max("mask").alias("mask"))
    return found.select("class", "own", "place", F.coalesce("mask", "every").alias("mask")).filter("mask <> 0")


def strip(texts: DataFrame, width: int) -> DataFrame:
    """``class, n_removed, kept_sha256, kept`` from ``class, text`` and ``hits``, a list of place and mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in chunks(batch.column("text")):
                part = batch.slice(at, to - at)
                words = Words(part.column("text"))
                data, rows = words.data.tobytes(), []
                keys = zip(part.column("class").to_pylist(), part.column("hits").to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)
                for name, hits, a, b in keys:
                    if _class(words.hash[a:b]) != name:
                        continue
                    place = np.array([h["place"] for h in hits])[:, None]
                    mask = np.array([h["mask"] for h in hits])[:, None]
                    d = np.arange(width - ANCHOR + 1)[None, :]
                    start = (place - d)[(mask >> d) & 1 == 1]
                    edge = np.zeros(b - a + 1, dtype=np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + width, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    kept = b" ".join([data[words.start[i] : words.end[i]] for i in (np.flatnonzero(keep) + a).tolist()])
                    rows.append((name, int((~keep).sum()), hashlib.sha256(kept).hexdigest()))
                columns = list(zip(*rows, strict=True)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["class", "n_removed", "kept_sha256"])

    return texts.mapInArrow(run, "class long, n_removed long, kept_sha256 string")


def dedup(docs: DataFrame, width: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    docs = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(_LAST)).alias("own"), F.col(f"`{text}`").alias("text"))
    rows = written(describe(docs), "substring-rows")
    classes = rows.filter(F.col("n_words") >= width).groupBy("class").agg(F.min("own").alias("least"), F.count("*").alias("rows"))
    classes = written(classes, "substring-classes")
    marks = written(anchors(docs, width), "substring-anchors")
    shared = marks.groupBy("gram").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("size")).filter("low < high")
    asked = written(marks.join(written(shared.select("gram", "size"), "substring-shared"), "gram"), "substring-asked")

    def texts(part: DataFrame) -> DataFrame:
        places = part.groupBy("class").agg(F.collect_set("place").alias("places"), F.count("*").alias("n"))
        wanted = places.join(classes, "class").select("class", "places", "n", F.col("least").alias("own"))
        return texts_of(docs.select("own", "text"), written(wanted, "substring-wanted"), "own")

    found = by_trees(slices(texts(asked.filter(F.col("size") <= GROUP)), width), width)
    found = written(found.unionByName(by_kinds(slices(texts(asked.filter(F.col("size") > GROUP)), width), width)), "substring-found")
    hits = found.groupBy("class", "own").agg(F.collect_list(F.struct("place", "mask")).alias("hits"), F.count("*").alias("n"))
    stripped = strip(texts_of(docs.select("own", "text"), written(hits, "substring-hits"), "own"), width)
    stripped = stripped.groupBy("class").agg(F.max("n_removed").alias("n_removed"), F.max("kept_sha256").alias("kept_sha256"))
    facts = classes.join(stripped, "class", "left").filter("rows > 1 or n_removed is not null").select("class", "least", "n_removed", "kept_sha256")
    joined = rows.join(written(facts, "substring-facts"), "class", "left")
    copy = F.col("own") > F.col("least")
    return joined.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses: runs of 50 words."""
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
