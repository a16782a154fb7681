"""Records of delimited text whose quoted fields may hold line breaks, read from splittable files.

Whether a line begins inside quotes depends on all lines before it.  Each block of a file (a split as Spark reads it) is a
function from the state at its begin, outside or inside quotes, to the state at its end.  A first pass finds these
functions, one row for each block; composed in file order they give every block's state, and a second pass then cuts each
block into records on its own.  Only records that cross a block's end are put together by a shuffle.  A quote opens a
field only where the field begins; elsewhere it is a character.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_INSIDE = re.compile(r'[^"]*(?:""[^"]*)*')
#: What stands between quotes; a doubled quote ends one such part and begins the next.
QUOTED = r'"[^"]*"'


class Quotes:
    """The state after a line: inside quotes or not."""

    def __init__(self, separator: str):
        field = r'"[^"]*(?:""[^"]*)*("?)'
        self._first = re.compile(rf"(?:^|{re.escape(separator)}){field}")
        self._later = re.compile(rf"{re.escape(separator)}{field}")

    def after(self, line: str, inside: bool) -> bool:
        """State at the end of a line that begins in the given state."""
        if '"' not in line:
            return inside
        at, pattern = 0, self._first
        if inside:
            at = _INSIDE.match(line).end()
            if at == len(line):
                return True
            at, pattern = at + 1, self._later
        opened = False
        for found in pattern.finditer(line, at):
            opened = not found[1]
        return opened


Block = tuple[str, int]


@dataclass(frozen=True)
class Blocks:
    """Blocks by file and begin: whether each begins inside quotes, and the block in which its open record began."""

    inside: dict[Block, bool]
    opener: dict[Block, int | None]
    crossing: bool
    closed: bool


def lines_of(spark: SparkSession, path: str, charset: str, line_end: str) -> DataFrame:
    """Lines of a file, or of the files of a folder, with the block each is in; lines keep a carriage return at their end."""
    lines = spark.read.option("lineSep", line_end).text(path)
    # the bytes of a line come as they are
    value = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    return lines.select(value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, list[str]]]:
    """Lines in order, by block as they come; a block may come in several parts, one after the other."""
    for batch in batches:
        blocks = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True))
        texts = batch.column("value").to_pylist()
        at = 0
        while at < len(blocks):
            to = at
            while to < len(blocks) and blocks[to] == blocks[at]:
                to += 1
            yield blocks[at], texts[at:to]
            at = to


def scan_blocks(lines: DataFrame, separator: str) -> Blocks:
    """States of all blocks, from one row for each of them."""
    quotes = Quotes(separator)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[Block, list] = {}
        for block, texts in _by_block(batches):
            # for both states at the begin: the state now, whether a line has ended inside, whether one has ended outside
            state = found.setdefault(block, [[False, False, False], [True, False, False]])
            for text in texts:
                for s in state:
                    s[0] = quotes.after(text, s[0])
                    s[1], s[2] = s[1] or s[0], s[2] or not s[0]
        rows = [{"file": f, "block": b, "out_end": o[0], "out_crosses": o[1], "in_end": i[0], "in_crosses": i[1], "in_closes": i[2]} for (f, b), (o, i) in found.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows)

    schema = "file string, block long, out_end boolean, out_crosses boolean, in_end boolean, in_crosses boolean, in_closes boolean"
    inside, opener, crossing, closed, state, begun, last = {}, {}, False, True, False, None, None
    for r in sorted(lines.mapInArrow(run, schema).collect()):  # one row for each block
        if r["file"] != last:
            closed, state, last = closed and not state, False, r["file"]
        inside[r["file"], r["block"]], opener[r["file"], r["block"]] = state, begun if state else None
        crossing |= r["in_crosses"] if state else r["out_crosses"]
        if not state or r["in_closes"]:
            begun = r["block"]
        state = r["in_end"] if state else r["out_end"]
    return Blocks(inside, opener, crossing, closed and not state)


def records(lines: DataFrame, separator: str, blocks: Blocks, line_end: str) -> DataFrame:
    """Records (record, header): whole records, the first of each file marked."""
    quotes = Quotes(separator)
    first: dict[str, int] = {}
    for file, block in blocks.inside:
        first[file] = min(block, first.get(file, block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records as (record, header, file, block that they began in if they are not whole, block of the part)."""
        held: list[str] = []
        block, inside, key, header = None, False, None, False

        def row(part_of: int | None) -> dict:
            return {"record": line_end.join(held), "header": header, "file": block[0], "opener": part_of, "part": block[1]}

        def left() -> list[dict]:
            return [row(key if key is not None else block[1])] if held else []

        for at, texts in _by_block(batches):
            out = []
            if at != block:
                out += left()
                block, inside, held = at, blocks.inside[at], []
                key, header = blocks.opener[at], at[1] == first[at[0]]
            for text in texts:
                held.append(text)
                inside = quotes.after(text, inside)
                if not inside:
                    out.append(row(key))
                    held, key, header = [], None, False
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_PARTS)
        if held:
            yield pa.RecordBatch.from_pylist(left(), schema=_PARTS)

    parts = lines.mapInArrow(run, "record string, header boolean, file string, opener long, part long")
    if not any(blocks.inside.values()):
        return parts.select("record", "header")
    ordered = F.array_sort(F.collect_list(F.struct("part", "record")))
    crossing = parts.where("opener IS NOT NULL").groupBy("file", "opener").agg(F.array_join(ordered["record"], line_end).alias("record"), F.bool_or("header").alias("header"))
    whole = parts.where("opener IS NULL").select("record", "header")
    return whole.unionByName(crossing.select("record", "header"))


_PARTS = pa.schema([("record", pa.string()), ("header", pa.bool_()), ("file", pa.string()), ("opener", pa.int64()), ("part", pa.int64())])
