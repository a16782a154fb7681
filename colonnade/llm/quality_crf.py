"""Document quality from a linear-chain field that labels every line good or bad.

Features of a line are counts over its bytes and words and the same of the lines beside it, so they need no language. A
labelled document lends its label to its lines. The chain is fitted on the driver to a sample of labelled documents of
bounded size (``Bounds``), taken by a hash of their ids; everything else covers all rows. A document's score is the mean,
weighted by length, of the probabilities that its lines are good.

Defined results: a null or empty text, or one without words, has score 0. Lines without words take no part. Every input
row gives one row, repeated rows included; an empty table gives no rows. Labels whose id or quality is null are left out;
if none is left, or only one label, every text scores the share of label 1 (0.5 without labels). Only the named columns
are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm import crf
from colonnade.llm.common import Words, chunks


@dataclass(frozen=True)
class Bounds:
    """Size of the training sample: labelled documents of each label, which are read whole."""

    documents: int = 600


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


_CLASSES = (
    _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789"), _table("#*$%&|<>"), _table("!"), _table("|"), _table(".,;:?"),
    np.arange(256) >= 128,
)
_OWN = 15


class Lines:
    """The lines with words of the rows of a string column: ``row``, ``size`` (bytes) and ``features`` of each."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        data, offsets = words.data, words.offsets
        breaks = np.flatnonzero(data == 10)
        start = np.unique(np.r_[offsets[:-1][offsets[:-1] < offsets[1:]], breaks + 1])
        start = start[start < len(data)]
        first = np.searchsorted(words.start, np.r_[start, len(data)])
        filled = np.diff(first) > 0
        self.row = (np.searchsorted(offsets, start, side="right") - 1)[filled]
        stop = np.r_[start[1:], len(data)][filled]
        start, a, b = start[filled], first[:-1][filled], first[1:][filled]
        self.size = stop - start
        self.lengths = np.bincount(self.row, minlength=len(column)).astype(np.int64)
        n = np.maximum(b - a, 1).astype(float)
        sums = lambda x, i, j: (lambda c: c[j] - c[i])(np.r_[0, np.cumsum(x, dtype=np.int64)]).astype(float)
        chars = np.maximum(sums((words.end - words.start), a, b), 1.0)
        per_class = [sums(t[data], start, stop) for t in _CLASSES]
        last = data[words.end[b - 1] - 1] if len(b) else np.zeros(0, np.uint8)
        again = np.r_[False, words.hash[1:] == words.hash[:-1]] if len(words.hash) else np.zeros(0, bool)
        head = words.data[words.start] if len(words.start) else np.zeros(0, np.uint8)
        same_line = np.zeros(len(start), dtype=bool)
        whole = sums(words.hash.view(np.int64) >> 8, a, b)
        if len(start) > 1:
            same_line[1:] = (whole[1:] == whole[:-1]) & (self.row[1:] == self.row[:-1]) & (n[1:] == n[:-1])
        own = np.column_stack([
            *[np.minimum(x / chars, 1.0) for x in per_class[:2]], *[np.minimum(x / n, 2.0) for x in per_class[2:6]], per_class[6] / chars,
            np.minimum(chars / n, 20.0) / 10, np.log1p(n) / 5, sums(again, a, b) / n, (last == 46) | (last == 63), (last == 33),
            sums(_CLASSES[0][head], a, b) / n, same_line, sums((words.end - words.start) > 12, a, b) / n,
        ]).astype(np.float32) if len(start) else np.zeros((0, _OWN), np.float32)
        before, after = np.zeros_like(own), np.zeros_like(own)
        if len(own) > 1:
            near = (self.row[1:] == self.row[:-1])[:, None]
            before[1:], after[:-1] = own[:-1] * near, own[1:] * near
        self.features = np.hstack([own, own**2, before, after])


def fit(texts: list[str], labels: list[int]) -> crf.Chain | float:
    """A chain of labels bad (0) and good (1) from labelled texts, or the share of label 1 if there is but one label."""
    known = sorted(set(labels))
    if len(known) < 2:
        return float(known[0]) if known else 0.5
    lines = Lines(pa.array(texts, pa.large_string()))
    mark = np.array(labels)[lines.row]
    weight = np.array([0.5 / max(np.sum(np.array(labels) == y), 1) for y in labels]) * len(labels)
    sizes = np.maximum(lines.lengths, 1)
    return crf.train(lines.features.astype(float), mark, lines.lengths, 2, weight / sizes, steps=120, rate=0.15)


def sample(docs: DataFrame, labels: DataFrame, held_out: Column, bounds: Bounds) -> tuple[list[str], list[int]]:
    """Whole texts and labels of the training sample, never of rows that ``held_out`` marks."""
    labelled = labels.select(F.col("doc_id"), F.col("quality")).filter("doc_id is not null and quality in (0, 1)").filter(~held_out)
    chosen = None
    for y in (0, 1):
        part = labelled.filter(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bounds.documents)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", "text").filter("text is not null")
    rows = chosen.join(texts, "doc_id").orderBy("doc_id", "quality", "text").limit(4 * bounds.documents).collect()
    return [r["text"] for r in rows], [int(r["quality"]) for r in rows]


def score(docs: DataFrame, chain: crf.Chain | float) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in chunks(batch.column("text")):
                part = batch.slice(at, to - at)
                if isinstance(chain, float):
                    values = np.full(len(part), chain)
                else:
                    lines = Lines(part.column("text"))
                    good = chain.marginals(chain.scores(lines.features), lines.lengths)[:, 1]
                    size = lines.size.astype(float)
                    total = np.bincount(lines.row, size, len(part))
                    values = np.bincount(lines.row, size * good, len(part)) / np.maximum(total, 1)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.clip(values, 0, 1))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    chain = fit(*sample(docs, labels, held_out(F.col("doc_id")), Bounds()))
    return score(docs, chain).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
