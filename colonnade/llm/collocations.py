"""Phrase collocations: phrases of two to four words that occur oftener than their parts suggest.

Counting. Every word of a piece begins a suffix, which ends with the piece or with the longest phrase. Words are read as
64-bit numbers of language and word. Suffixes whose first two words are rare are abandoned: occurrences of words, then of
leading pairs, are counted by Spark, and those that are frequent are marked in bit maps of bounded size (``BITS``). A mark
may stand for a rare word too, which only costs time. What is left goes, with equal suffixes of a block added up before,
to tasks by leading pair. A task sorts its suffix pointers by three-way partitioning, one word after the other, down to
the longest phrase: the weight of a part with equal words is the count of the phrase, and a part that weighs too little is
abandoned. A pair with more than ``HOT`` suffixes is dealt over several tasks, which abandon nothing; their counts are
summed by phrase. Scores, cuts and the phrases inside longer ones come from joins of the frequent phrases alone.

Defined results: A-Z are lower-cased; a null text is empty, a null language is ``und`` and one with the language of that
name; rows without an id and repeated rows count as any other. Pieces and words are as the contract of ``op11`` says. An
empty table, or one without frequent phrases, gives no rows. Only ``text`` and ``lang`` are read, so other columns may have
any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import _FOLDED, Words, chunks, mix, text_bytes
from colonnade.session import stage as written

#: Words of the longest phrase.
LONGEST = 4
#: Bits of a map, at most (32 MB); suffixes of a leading pair that go to one task; rows of suffixes that a task sorts.
BITS, HOT, TASK = 1 << 28, 1 << 18, 1 << 20
#: Bytes of text whose suffixes are added up before they are sent.
BLOCK = 1 << 20

_END, _SPACE = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SPACE[[ord(" "), ord("\t")]] = True
_BITMAP_BITS = 8 * 4096  # of one row of Spark's bitmap functions


class PieceWords(Words):
    """The words of the rows of a string column, and ``piece``: the number of the piece each word is in."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = text_bytes(column)
        end = _END[self.data]
        gap = end | _SPACE[self.data]
        starts = self.offsets[:-1][self.offsets[:-1] < len(gap)]
        begins, ends = np.ones(len(gap), dtype=bool), np.ones(len(gap), dtype=bool)
        begins[1:], ends[:-1] = gap[:-1], gap[1:]
        begins[starts] = True
        ends[self.offsets[1:][self.offsets[1:] > 0] - 1] = True
        self.start = np.flatnonzero(begins & ~gap)
        self.end = np.flatnonzero(ends & ~gap) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.row = np.repeat(np.arange(len(column)), np.diff(self.first))
        self.piece = np.searchsorted(np.flatnonzero(end), self.start) + self.row
        self.hash = self._hashes(_FOLDED)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[PieceWords, np.ndarray, pa.Array]]:
    """Words of a block of rows, the number of each word in its language, and the languages of the rows."""
    for batch in batches:
        texts, languages = batch.column("text"), batch.column("language")
        for at, to in chunks(texts, BLOCK):
            words = PieceWords(texts.slice(at, to - at))
            own = languages.slice(at, to - at).dictionary_encode()
            number = mix(words.hash ^ _language_numbers(own.dictionary)[own.indices.to_numpy(zero_copy_only=False)][words.row]) | np.uint64(1)
            yield words, number, languages.slice(at, to - at)


def _language_numbers(names: pa.Array) -> np.ndarray:
    """A 64-bit number for each name."""
    digests = [hashlib.blake2b(name.encode(), digest_size=8).digest() for name in names.to_pylist()]
    return np.frombuffer(b"".join(digests), np.uint64)


def _signed(numbers: np.ndarray) -> pa.Array:
    return pa.array(numbers.view(np.int64))


def word_counts(docs: DataFrame) -> DataFrame:
    """``number, language, word, f`` of every word: how often it occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, number, languages in blocks(batches):
            found, first, times = np.unique(number, return_index=True, return_counts=True)
            data = words.data.tobytes()
            spelled = [data[a:b].decode("utf-8", "replace") for a, b in zip(words.start[first], words.end[first], strict=True)]
            columns = [_signed(found), languages.take(pa.array(words.row[first])), pa.array(spelled, pa.string()), pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, ["number", "language", "word", "n"])

    folded = F.translate("word", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = docs.mapInArrow(count, "number long, language string, word string, n long").withColumn("word", folded)
    return found.groupBy("number", "language", "word").agg(F.sum("n").alias("f"))


def bit_map(numbers: DataFrame, column: str, n: int) -> np.ndarray:
    """Bits that are set for the numbers of a column, at least 16 bits each up to ``BITS`` in all."""
    size = min(BITS, max(1 << 20, 1 << (16 * max(n, 1) - 1).bit_length()))
    place = F.pmod(F.col(column), F.lit(size)) + 1
    maps = numbers.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(size // 8, dtype=np.uint8)
    for row in maps.toLocalIterator():
        at = (row["bucket"] - 1) * _BITMAP_BITS // 8
        part = np.frombuffer(row["bits"], np.uint8)[: size // 8 - at]
        out[at : at + len(part)] = part
    return out


def marked(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether the bit of each number is set."""
    place = numbers & np.uint64(8 * len(bits) - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def pair_numbers(number: np.ndarray, following: np.ndarray) -> np.ndarray:
    """A number for each pair of words."""
    return mix(number * np.uint64(0x9E3779B97F4A7C15) + following)


def _pairs(words: PieceWords, number: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the pairs of frequent words within a piece, and the number of each pair."""
    kept = marked(frequent, number)
    first = np.flatnonzero((words.piece[1:] == words.piece[:-1]) & kept[1:] & kept[:-1])
    return first, pair_numbers(number[first], number[first + 1])


def pair_counts(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``pair, f``: how often each pair of frequent words leads a suffix."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, number, _ in blocks(batches):
            found, times = np.unique(_pairs(words, number, frequent)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(found), pa.array(times)], ["pair", "n"])

    return docs.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("f"))


def equal_parts(keys: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Three-way partitioning of pointers to rows of keys, one column after the other: for each depth above one the parts
    with equal leading keys that weigh ``least`` or more, as one pointer into each and its weight.

    All open parts are split at once: each by a pivot of its own into what is smaller, equal and larger. The equal part goes
    on with the next column; a key 0 ends a row. Parts that weigh less than ``least`` are abandoned.
    """
    pointers = np.arange(len(keys))
    sizes, depths = np.array([len(keys)] if len(keys) else [], dtype=np.int64), np.zeros(1 if len(keys) else 0, dtype=np.int64)
    while len(pointers):
        part = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.cumsum(sizes) - sizes
        key = keys[pointers, depths[part]]
        low, mid, high = key[begin], key[begin + sizes // 2], key[begin + sizes - 1]
        pivot = np.maximum(np.minimum(low, mid), np.minimum(np.maximum(low, mid), high))[part]
        side = 3 * part + (key >= pivot) + (key > pivot)
        count = np.bincount(side, minlength=3 * len(sizes))
        weight = np.bincount(side, weights[pointers], 3 * len(sizes)).astype(np.int64)
        depth = np.repeat(depths, 3)
        depth[1::3] += 1
        held = pointers[np.argsort(side, kind="stable")]
        at = np.cumsum(count) - count
        filled = (count > 0) & (weight >= least)
        equal = np.flatnonzero(filled & (np.arange(len(count)) % 3 == 1))
        equal = equal[keys[held[at[equal]], depth[equal] - 1] != 0]
        for d in range(2, keys.shape[1] + 1):
            done = equal[depth[equal] == d]
            if len(done):
                yield d, held[at[done]], weight[done]
        goes_on = filled & (depth < keys.shape[1])
        goes_on[1::3] = False
        goes_on[equal[depth[equal] < keys.shape[1]]] = True
        pointers = held[np.repeat(goes_on, count)]
        sizes, depths = count[goes_on], depth[goes_on]


def phrase_counts(docs: DataFrame, least: int, longest: int, frequent: np.ndarray, pairs: DataFrame) -> DataFrame:
    """``words, a`` of every phrase of two words or more that occurs ``least`` times: its words' numbers and its count."""
    facts = pairs.agg(F.count("*").alias("n"), F.sum("f").alias("suffixes")).first()
    leading = bit_map(pairs, "pair", facts["n"])
    # at most suffixes / limit pairs are hot, 2^20 in all
    limit = max(HOT, (facts["suffixes"] or 0) >> 20)
    hot = sorted((r["pair"], -(-r["f"] // limit)) for r in pairs.filter(F.col("f") > limit).collect())
    hot_pairs, hot_parts = np.array([p for p, _ in hot], np.int64), np.array([n for _, n in hot], np.int64)
    names = [f"w{i}" for i in range(longest)]

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, number, _ in blocks(batches):
            first, pair = _pairs(words, number, frequent)
            kept = marked(leading, pair)
            first, pair = first[kept], pair[kept]
            leads = np.zeros(len(number) + longest, dtype=bool)
            leads[first] = True
            padded = np.r_[number, np.zeros(longest, np.uint64)]
            keys = np.zeros((len(first), longest), dtype=np.uint64)
            open_ = np.ones(len(first), dtype=bool)
            for i in range(longest):  # a suffix goes on while each two neighbours are a frequent pair
                open_ = open_ & leads[first + i - 1] if i else open_
                keys[:, i] = np.where(open_, padded[first + i], 0)
            whole = pair.copy()
            for i in range(2, longest):
                whole = pair_numbers(whole, keys[:, i])
            _, chosen, times = np.unique(whole, return_index=True, return_counts=True)
            pair, salt = pair[chosen].view(np.int64), np.zeros(len(chosen), np.int64)
            if len(hot_pairs):
                place = np.minimum(np.searchsorted(hot_pairs, pair), len(hot_pairs) - 1)
                is_hot = hot_pairs[place] == pair
                salt[is_hot] = 1 + (whole[chosen][is_hot] >> np.uint64(11)).astype(np.int64) % hot_parts[place[is_hot]]
            columns = [pa.array(pair), pa.array(salt.astype(np.int32)), *[_signed(np.ascontiguousarray(keys[chosen, i])) for i in range(longest)], pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, ["pair", "salt", *names, "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys = np.column_stack([table.column(c).to_numpy().view(np.uint64) for c in names])
        n, dealt = table.column("n").to_numpy(), table.column("salt").to_numpy() > 0
        for rows, bound in ((np.flatnonzero(~dealt), least), (np.flatnonzero(dealt), 1)):
            for depth, pointers, weight in equal_parts(keys[rows], n[rows], bound):
                flat = _signed(np.ascontiguousarray(keys[rows[pointers], :depth]).ravel())
                lists = pa.ListArray.from_arrays(np.arange(0, len(pointers) * depth + 1, depth, dtype=np.int32), flat)
                yield pa.RecordBatch.from_arrays([lists, pa.array(weight)], ["words", "n"])

    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(facts["suffixes"] or 0) // TASK))
    sent = docs.mapInArrow(suffixes, f"pair long, salt int, {', '.join(f'{c} long' for c in names)}, n long").repartition(tasks, "pair", "salt")
    found = sent.mapInArrow(count, "words array<long>, n long")
    return found.groupBy("words").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)


def collocations(docs: DataFrame, least: int = 30, longest: int = LONGEST, top: int = 2000, inside: int = 80) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of each language.

    A phrase inside a longer one that has ``inside`` percent of its count is dropped.
    """
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("language"))
    words = written(word_counts(texts), "phrase-words")
    common = words.filter(F.col("f") >= least)
    frequent = bit_map(common, "number", common.count())
    pairs = written(pair_counts(texts, frequent).filter(F.col("f") >= least), "phrase-pairs")
    phrases = written(phrase_counts(texts, least, longest, frequent, pairs), "phrases")

    known = phrases.select("words", "a").unionByName(common.select(F.array("number").alias("words"), F.col("f").alias("a")))
    size = F.size("words")
    parts = [F.struct(F.slice("words", F.lit(i + 1), F.lit(m)).alias("part"), F.lit(m).alias("m"), F.lit(i).alias("i")) for m in range(2, longest) for i in range(longest - m + 1)]
    within = phrases.select("words", "a", F.explode(F.filter(F.array(*parts), lambda p: (p["m"] < F.size("words")) & (p["i"] + p["m"] <= F.size("words")))).alias("p"))
    longer = within.groupBy(F.col("p.part").alias("words")).agg(F.max("a").alias("longer"))
    covered = F.coalesce(F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * inside, F.lit(False))
    kept = phrases.join(longer, "words", "left").filter(~covered).select("words", "a")

    cuts = kept.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("words", F.lit(1), F.col("k")), "right": F.slice("words", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(known.select(F.col("words").alias("left"), F.col("a").alias("l")), "left")
    cuts = cuts.join(known.select(F.col("words").alias("right"), F.col("a").alias("r")), "right")
    score = F.expr("CAST(a AS DECIMAL(20,0)) * 2000000 div (CAST(l AS DECIMAL(20,0)) + r)")
    scored = cuts.select("words", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("words", "a").agg(F.min("cut").alias("cut"))

    spelled = scored.select("words", F.posexplode("words").alias("place", "number")).join(common.select("number", "language", "word"), "number")
    spelled = spelled.groupBy("words").agg(F.first("language").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"))
    totals = words.groupBy(F.col("language").alias("lang")).agg(F.sum("f").alias("n"))
    named = scored.join(spelled, "words").select("lang", F.array_join("w.word", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score").join(totals, "lang")
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")
    ranked = named.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", F.col("score").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language of the documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, w[i:i + m - 1] AS g FROM p, unnest([1, 2, 3, 4]) AS x(m), unnest(range(1, len(w) - m + 2)) AS y(i)),
f AS (SELECT lang, g, count(*) AS a FROM g GROUP BY lang, g),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE a >= 30 AND len(g) > 1),
s AS (SELECT lang, g[i:i + m - 1] AS g, max(a) AS longer FROM c, unnest([2, 3]) AS x(m), unnest(range(1, len(g) - m + 2)) AS y(i) WHERE m < len(g) GROUP BY ALL),
k AS (SELECT c.* FROM c LEFT JOIN s ON s.lang = c.lang AND s.g = c.g WHERE s.longer IS NULL OR CAST(100 AS HUGEINT) * s.longer < CAST(80 AS HUGEINT) * c.a),
u AS (SELECT k.lang, k.g, k.a, i, l.a AS l, r.a AS r, CAST(CAST(2000000 AS HUGEINT) * k.a // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
  FROM k, unnest(range(1, len(k.g))) AS y(i) JOIN f l ON l.lang = k.lang AND l.g = k.g[1:i] JOIN f r ON r.lang = k.lang AND r.g = k.g[i + 1:]),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM b JOIN n USING (lang) QUALIFY rank <= 2000"""
