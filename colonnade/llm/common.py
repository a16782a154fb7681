"""What several operators of this subpackage share: words as the contracts define them, native and in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Bytes of text that are turned into numpy arrays at a time; bounds the memory of a task for texts of any length. The arrays
#: take up to a hundred times as much, and a Python worker keeps that for the steps after it.
BLOCK_BYTES = 1 << 17

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[ord(c) for c in SPACE_CHARS]] = True
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def word_array(text: Column) -> Column:
    """The words of a text, empty for null."""
    spaced = F.coalesce(text, F.lit(""))
    for c in SPACE_CHARS[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def texts_of(docs: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` joined with ``wanted`` on a key; ``wanted`` needs a positive column ``n``.

    Lets Spark drop the texts that nothing asks for by a Bloom filter at the scan, before they are shuffled, also where the
    scan is smaller than Spark's default for it. The filter's size is bounded by Spark; without it the join is the same.
    """
    conf = docs.sparkSession.conf
    conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "1g")
    return docs.join(wanted.filter("n > 0"), key)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, _BASE, dtype=np.uint64), np.full(size, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows in them; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold about ``limit`` bytes each, at least one row."""
    _, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, to
        at = to


class Words:
    """The words of the rows of a string column: ``hash``, ``start`` and ``end`` (bytes) of each, ``first`` word of each row."""

    def __init__(self, column: pa.Array, fold_case: bool = False):
        self.data, self.offsets = text_bytes(column)
        space = _SPACE[self.data]
        begins = np.empty(len(space), dtype=bool)
        begins[:1], begins[1:] = True, space[:-1]
        begins[self.offsets[:-1][self.offsets[:-1] < len(space)]] = True
        ends = np.empty(len(space), dtype=bool)
        ends[-1:], ends[:-1] = True, space[1:]
        inner = self.offsets[1:][self.offsets[1:] > 0]
        ends[inner - 1] = True
        self.start = np.flatnonzero(begins & ~space)
        self.end = np.flatnonzero(ends & ~space) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.hash = self._hashes(_FOLDED if fold_case else _VALUES)

    def _hashes(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(out):  # blocks of whole words
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + BLOCK_BYTES, side="right")))
            low, high = self.start[at], self.end[to - 1]
            up, down = _powers(high - low)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(values[self.data[low:high]] * up[: high - low], out=sums[1:])
            begin, end = self.start[at:to] - low, self.end[at:to] - low
            out[at:to] = mix((sums[end] - sums[begin]) * down[begin])
            at = to
        return out


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` hashes, one for each start that has so many after it."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n] + np.uint64(width))
