"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs, drawn from its code point. A run of three letters is the element-wise product of
its letters' vectors, the first rotated twice, the second once; a text is the sum of its runs' vectors. A language's
prototype is the sum of the unit vectors of its training texts, and a text gets the language whose prototype has the
largest cosine with it. Letters are lower-cased, and anything between two words, also the begin and end of the text, is
one blank, which counts as a letter; so a word of one letter has a run of its own.

Training takes about ``Bounds.documents`` texts of each language, chosen by a hash of text and id; they are read whole, in
tasks, which add their vectors up by language. Only each language's count and prototype (``DIMENSIONS`` numbers) reach the
driver. Every text is classified, whole.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text when no language was
learned. The score is the cosine, 0 where it is negative; equal cosines go to the first language by code point. Every row
gives one row, repeated rows included; a null id is never held out. An empty table gives no rows. Only the named columns
are read, so others may have any name.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS, BLANK, SEED = 1024, 32, 90125

#: Letters classified at a time, and runs whose vectors are held at a time; they bound the memory of a task.
BLOCK, SLICE = 1 << 20, 4096

_CODES = 0x110000


@dataclass(frozen=True)
class Bounds:
    """Size of the training sample: documents of each language, which are read whole."""

    documents: int = 3000


class Letters:
    """The vectors of letters and their three rotations, and the code each code point is read as."""

    def __init__(self):
        self._read, self._code = np.zeros(_CODES, dtype=bool), np.full(_CODES, BLANK, dtype=np.int64)
        self._vectors: dict[int, np.ndarray] = {}

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Lower-cased letters of code points; all else is a blank."""
        for point in np.unique(points[~self._read[points]]):
            letter = chr(point)
            if letter.isalpha():
                low = letter.lower()
                self._code[point] = ord(low) if len(low) == 1 else point
            self._read[point] = True
        return self._code[points]

    def vector(self, code: int) -> np.ndarray:
        """Signs drawn from a letter's code."""
        if code not in self._vectors:
            bits = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, dtype=np.int8)
            self._vectors[code] = bits * 2 - 1
        return self._vectors[code]

    def bound(self, runs: np.ndarray) -> np.ndarray:
        """Vectors of runs of three letters, packed in 21 bits each."""
        out = np.ones((len(runs), DIMENSIONS), dtype=np.int8)
        for place in range(3):
            letters, which = np.unique((runs >> (21 * (2 - place))) & 0x1FFFFF, return_inverse=True)
            turned = np.stack([np.roll(self.vector(int(c)), 2 - place) for c in letters])
            out *= turned[which]
        return out.astype(np.float32)


_LETTERS: list[Letters] = []


def letters() -> Letters:
    """The tables of this process."""
    if not _LETTERS:
        _LETTERS.append(Letters())
    return _LETTERS[0]


def _spaced(text: str, table: Letters) -> np.ndarray:
    """Letters of a text with one blank before, between and after its words; empty without letters."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    codes = table.codes(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32))
    kept = codes != BLANK
    if not kept.any():
        return np.zeros(0, np.int64)
    ended = np.zeros(len(kept), dtype=bool)
    ended[1:] = kept[:-1] & ~kept[1:]
    return np.r_[BLANK, codes[kept | ended], *([BLANK] if kept[-1] else [])]


def run_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text and each different run of letters in it: row, run, and how often."""
    table, rows, parts = letters(), [], []
    for row, text in enumerate(texts):
        codes = _spaced(text or "", table)
        if len(codes):
            parts.append(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])
            rows.append(np.full(len(codes) - 2, row))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs, which = np.unique(np.concatenate(parts), return_inverse=True)
    pairs, counts = np.unique(np.concatenate(rows) * len(runs) + which, return_counts=True)
    return pairs // len(runs), runs[pairs % len(runs)], counts


def vectors(texts: list[str | None]) -> np.ndarray:
    """The sum of the vectors of each text's runs."""
    row, run, count = run_counts(texts)
    out = np.zeros((len(texts), DIMENSIONS))
    order = np.argsort(run, kind="stable")
    runs, first = np.unique(run[order], return_index=True)
    first = np.r_[first, len(run)]
    for at in range(0, len(runs), SLICE):  # runs of a slice meet the texts that have them in one product
        to = min(at + SLICE, len(runs))
        used = order[first[at] : first[to]]
        held, place = np.unique(row[used], return_inverse=True)
        table = np.zeros((len(held), to - at), dtype=np.float32)
        table[place, np.repeat(np.arange(to - at), np.diff(first[at : to + 1]))] = count[used]
        out[held] += table @ letters().bound(runs[at:to])
    return out


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of a batch, with the row of the first, about ``BLOCK`` letters at a time."""
    at, held, size = 0, [], 0
    for row, value in enumerate(column):
        text = value.as_py()
        if held and size + len(text or "") > BLOCK:
            yield at, held
            at, held, size = row, [], 0
        held.append(text)
        size += len(text or "")
    if held:
        yield at, held


@dataclass(frozen=True)
class Profiles:
    """Languages in the order of their code points, and a unit prototype of each."""

    languages: tuple[str, ...]
    prototypes: np.ndarray

    def classify(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language (-1: none) and score of each text."""
        found = vectors(texts)
        size = np.linalg.norm(found, axis=1)
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts))
        cosine = found @ self.prototypes.T / np.maximum(size, 1e-300)[:, None]
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
        return np.where(size > 0, best, -1), np.where(size > 0, score, 0.0)


def learn(docs: DataFrame, usable: Column, bounds: Bounds = Bounds()) -> Profiles:
    """Prototypes of the languages of the usable rows with a language and a text."""
    known = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col("lang").alias("language"))
    sizes = known.groupBy("language").count().collect()
    shares = known.sparkSession.createDataFrame([(r["language"], bounds.documents / r["count"]) for r in sizes], "language string, share double")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    # one row for each language, as few as the prototypes; without the hint texts could be shuffled by language
    chosen = known.join(F.broadcast(shares), "language").filter(draw < F.col("share")).select("language", "text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            languages = batch.column("language").to_pylist()
            for at, texts in _blocks(batch.column("text")):
                found = vectors(texts)
                found /= np.maximum(np.linalg.norm(found, axis=1), 1e-300)[:, None]
                for i, vector in enumerate(found):
                    held = sums.setdefault(languages[at + i], np.zeros(DIMENSIONS))
                    held += vector
        for language, vector in sums.items():
            places = np.arange(DIMENSIONS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([language] * DIMENSIONS), pa.array(places), pa.array(vector)], ["language", "place", "value"])

    added = chosen.mapInArrow(add, "language string, place int, value double").groupBy("language", "place").agg(F.sum("value").alias("value"))
    rows = added.groupBy("language").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v")).select("language", "v.value").collect()
    found = {r["language"]: np.array(r["value"]) for r in rows}
    named = tuple(sorted(k for k, v in found.items() if v.any()))
    table = np.array([found[k] / np.linalg.norm(found[k]) for k in named]) if named else np.zeros((0, DIMENSIONS))
    return Profiles(named, table)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    names = pa.array([*profiles.languages, "und"], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _blocks(batch.column("text")):
                best, score = profiles.classify(texts)
                best = np.where(best < 0, len(names) - 1, best)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), names.take(pa.array(best)), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    profiles = learn(docs, ~held_out(F.col("doc_id")))
    return identify(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
