"""BPE encoding and decoding with a given public vocabulary, merged in batched numpy rounds.

The vocabulary file (JSON, ``model.type`` BPE with word ends) is read on the driver and its tables go to the tasks with
the function; their size is that of the vocabulary. Texts are normalised and split as the file says, then each word is a
row of byte symbols. Words that a task has not met are merged together: their symbols lie in one flat array, each round
looks all neighbouring pairs up in the sorted pair keys by binary search and merges, in every word, the pairs of its
lowest rank. What words become is remembered up to a fixed number of words.

Defined results: a null or empty text has no tokens and decodes to the empty text. Repeated rows are encoded alike, each
on its own; an empty table gives no rows. Only the named columns are read; results come under the names of the contract.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from colonnade.llm.common import chunks

#: Words whose tokens a task remembers before it starts anew, and the longest word that it remembers.
REMEMBERED, LONGEST = 50_000, 64

#: How the vocabulary cuts normalised text into pieces; a fixed value of the public tokenizer, as in its file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def newer_characters() -> tuple[str, dict[int, str]]:
    """``PIECES`` and lower-case forms for characters that Python's own table does not have yet.

    The regex module knows a later version of Unicode than the tokenizer, and Python an earlier one. So letters and
    numbers unassigned in Python's table are held against the classes of the tokenizer's own expressions.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers

    unassigned = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    ours = set(regex.findall(r"[\p{L}\p{N}]", unassigned))
    split = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True)
    theirs = {c for c, _ in split.pre_tokenize_str("".join(sorted(ours)))}
    lower = normalizers.Lowercase()
    lowered = {ord(c): low for c in ours if (low := lower.normalize_str(c)) != c}
    points = sorted(map(ord, ours - theirs))
    if not points:
        return PIECES, lowered
    cuts = [i for i, p in enumerate(points) if not i or p != points[i - 1] + 1]
    ranges = "".join(rf"\U{points[a]:08X}-\U{points[b - 1]:08X}" for a, b in zip(cuts, [*cuts[1:], len(points)], strict=True))
    letter, number = rf"[\p{{L}}--[{ranges}]]", rf"[\p{{N}}--[{ranges}]]"
    return rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|(?:[^\s\p{{L}}\p{{N}}]|[{ranges}])+", lowered


def byte_symbols() -> dict[int, str]:
    """The visible character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """Tables of a BPE vocabulary with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        end = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in ids.items()}
        symbols = byte_symbols()
        self.inner = np.array([ids[symbols[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([ids[symbols[b] + end] for b in range(256)], dtype=np.int64)
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        left, right, made = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        self.special = {t["content"]: t["id"] for t in whole.get("added_tokens", [])}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.pattern, self.lowered = newer_characters()

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The token ids of each word."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        row = np.repeat(np.arange(len(words)), lengths)
        ids = self.inner[data]
        stop = np.cumsum(lengths) - 1
        ids[stop] = self.last[data[stop]]
        out: list[np.ndarray | None] = [None] * len(words)

        def finish(rows: np.ndarray, ids: np.ndarray) -> None:
            if len(rows):
                cuts = np.flatnonzero(rows[1:] != rows[:-1]) + 1
                for r, part in zip(rows[np.r_[0, cuts]].tolist(), np.split(ids, cuts), strict=True):
                    out[r] = part

        none = np.int64(1 << 60)
        while len(ids):
            key = ids[:-1] << 32 | ids[1:]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[found] == key) & (row[1:] == row[:-1])
            rank = np.where(known, self.ranks[found], none)
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, none], starts)  # the last symbol of a word has no pair: none
            sizes = np.diff(np.r_[starts, len(row)])
            open_rows = np.repeat(lowest < none, sizes)
            if not open_rows.all():  # words without a pair are done
                finish(row[~open_rows], ids[~open_rows])
                rank, found, row, ids = np.r_[rank, none][open_rows][:-1], np.r_[found, 0][open_rows][:-1], row[open_rows], ids[open_rows]
                if not len(ids):
                    break
                lowest, sizes = lowest[lowest < none], sizes[np.flatnonzero(lowest < none)]
            take = np.r_[rank == np.repeat(lowest, sizes)[: len(rank)], False]
            self._every_second(take)
            at = np.flatnonzero(take)
            ids[at] = self.made[found[at]]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ids, row = ids[keep], row[keep]
        return [x if x is not None else np.zeros(0, np.int64) for x in out]

    @staticmethod
    def _every_second(take: np.ndarray) -> None:
        """Of neighbouring hits, which overlap as in "aaa", keep the first, third and so on."""
        at = np.flatnonzero(take)
        if len(at) > 1:
            run = np.cumsum(np.r_[True, np.diff(at) > 1])
            first = at[np.flatnonzero(np.r_[True, run[1:] != run[:-1]])]
            take[at[(at - first[run - 1]) % 2 == 1]] = False


class Encoder:
    """Encodes texts; remembers the words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces, self.plain = regex.compile(vocabulary.pattern), regex.compile(PIECES)
        self.special = regex.compile("|".join(regex.escape(t) for t in vocabulary.special) or "(?!)")
        self.known: dict[str, tuple[int, str, str]] = {}

    def _cut(self, text: str) -> list[str]:
        """The pieces of a text without special tokens."""
        if text.isascii():
            return self.plain.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower case by character, without the final form
            text = text.replace("Σ", "σ")
        if max(text) < "\u0530":  # older than any version of the tables
            return self.plain.findall(text.lower())
        return self.pieces.findall(text.lower().translate(self.vocabulary.lowered))

    def words(self, text: str) -> list[str]:
        """The pieces of a text in order; special tokens stay as they are."""
        if "<|" not in text:
            return self._cut(text)
        out, at = [], 0
        for hit in self.special.finditer(text):
            out += self._cut(text[at : hit.start()])
            out.append(hit.group())
            at = hit.end()
        return out + self._cut(text[at:])

    def learn(self, words: Iterable[str]) -> dict[str, tuple[int, str, str]]:
        """For each different word: number of tokens, their ids and their tokens, each joined by a space."""
        different = set(words)
        new = [w for w in different if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(different)
        special, tokens = self.vocabulary.special, self.vocabulary.tokens
        now: dict[str, tuple[int, str, str]] = {w: (1, str(special[w]), w) for w in new if w in special}
        plain = [w for w in new if w not in special]
        for w, ids in zip(plain, self.vocabulary.merge([w.encode() for w in plain]) if plain else [], strict=True):
            ids = ids.tolist()
            now[w] = len(ids), " ".join(map(str, ids)), " ".join([tokens[i] for i in ids])
        self.known |= {w: x for w, x in now.items() if len(w) <= LONGEST}
        return {w: now[w] if w in now else self.known[w] for w in different}

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Number of tokens, ids and decoded text of each text."""
        cut = [self.words(t) for t in texts]
        known = self.learn(w for words in cut for w in words)
        for words in cut:
            if words:
                n, ids, decoded = zip(*[known[w] for w in words], strict=True)
                yield sum(n), " ".join(ids), " ".join(decoded)
            else:
                yield 0, "", ""


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", full: bool = False) -> DataFrame:
    """Tokens of every text: their number, and digests of the ids and of the decoded text; ``full`` adds both themselves."""
    vocabulary = Vocabulary(path)
    source = docs.select(docs[f"`{id_column}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    fields = [f for f in source.schema.fields if f.name == "doc_id"]
    kind = fields[0].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded string" * full

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for batch in batches:
            for at, to in chunks(batch.column("text")):
                part = batch.slice(at, to - at)
                rows = [(n, digest(ids), digest(decoded), *((ids, decoded) if full else ())) for n, ids, decoded in encoder.encode([t or "" for t in part.column("text").to_pylist()])]
                names = ["n_tokens", "ids_sha256", "decoded_sha256", *(("ids", "decoded") if full else ())]
                columns = [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.string()) for i in range(1, len(names)))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names])

    return source.mapInArrow(run, schema)


def word_vocabulary() -> str:
    """Path of the public word vocabulary that the contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), word_vocabulary())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: every document encoded and decoded."""
    return encode(docs, word_vocabulary())
