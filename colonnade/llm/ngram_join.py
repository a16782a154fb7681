"""Similarity join on word n-grams by vertical partitioning.

Two texts link when 100 * |A ∩ B| >= threshold * |A ∪ B| for their sets of distinct n-grams. All n-grams have one global
order: rare first, then by hash. How rare is taken from counts over all documents, kept in a fixed number of buckets,
to 65,535 for each task.

1. Texts with equal sets are one class; a class is known by the hash of its set. Its members are never paired.
2. A link needs a common n-gram among the first |A| - 3/4 |A| + 1 of each set (at 75), so only these are shuffled. N-grams that many classes share are dealt out over several lists.
3. Star turns: each class is held against one other, the head of most of its n-grams, then against some heads of the
   largest component among long lists. So copies meet their group without pairs inside it. Turns end when few pairs link;
   all but the first read the lists of frequent n-grams only.
4. Exact pass: classes that are still in different components meet at the first n-gram they share, if their sizes and
   its places leave a link possible: it must lie among the first |A| - c + 1 of each set, c being what these two sizes
   need in common. Parities of both sets, more of them for larger sets, then bound the n-grams that only one of them has.
   Lists of a dealt-out n-gram meet one another here.
5. A pair's overlap is counted fragment by fragment: the global order is cut into ranges, each range of each pair is its
   own row, partial counts are summed per pair.
6. Components grow over links by minimum labels until nothing changes.

Defined results: a null or empty text, or one without words, has an empty set, is its own component and links with
nothing. A text of fewer words than n has its whole sequence as its only n-gram. Repeated rows link like any equal texts;
a null id takes part, but a component is named by the smallest id that is not null. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colonnade.llm.common import Words, chunks, mix, texts_of, windows, word_count
from colonnade.llm.graph import components
from colonnade.session import stage as written

#: Buckets of the counts that order the n-grams; the counts of one bucket share a place in the order.
BUCKETS, PARTS = 1 << 20, 256

#: Ranges that the global order is cut into.
FRAGMENTS = 4

#: Least number of parities kept of a set; a larger set has as many as n-grams at least, else long texts of one kind all look alike.
BITS = 1024

#: Pairs of one head that are counted together; heads of an n-gram in a turn, after the first.
BLOCK, HEADS = 64, 8


@dataclass(frozen=True)
class Rule:
    """N-gram width, and least percentage of common n-grams."""

    width: int = 5
    percent: int = 75


def _sets(column: pa.Array, rule: Rule) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text."""
    words = Words(column, fold_case=True)
    grams, first = windows(words.hash, rule.width), words.first.tolist()
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= rule.width:
            yield np.unique(grams[a : b - rule.width + 1])
        elif b > a:
            yield windows(words.hash[a:b], b - a)
        else:
            yield grams[:0]


def _name(grams: np.ndarray) -> int:
    """A hash of a set."""
    return int(mix(grams ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64).view(np.int64))


def _mark(grams: np.ndarray) -> np.ndarray:
    """Parities of a set, a power of two of them: whether the number of its n-grams that hash to a bit is odd."""
    width = max(BITS, 1 << (len(grams) - 1).bit_length())
    bits = (mix(grams ^ np.uint64(0x5BD1E995)) % np.uint64(width)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=width) & 1).astype(np.uint8)).view(np.int64)


def describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, key, size, class, mark`` of each row (``part`` null), and the counts of each task: ``part, hits``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key long, size int, class long, mark array<long>, part int, hits binary"
    names = ["doc_id", "key", "size", "class", "mark", "part", "hits"]
    marks = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros(BUCKETS, dtype=np.int64)
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for at, to in chunks(batch.column("text")):
                part, sizes, keys, seen, odd = batch.slice(at, to - at), [], [], [], []
                for grams in _sets(part.column("text"), rule):
                    sizes.append(len(grams))
                    keys.append(_name(grams) if len(grams) else None)
                    seen.append(grams)
                    odd.append(_mark(grams) if len(grams) else None)
                np.add.at(hits, _bucket(np.concatenate(seen)), 1)
                columns = [part.column("doc_id"), part.column("key"), pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()), pa.array(odd, marks)]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary())], names)
        if hits.any():
            parts = np.minimum(hits, 65535).astype(np.uint16).reshape(PARTS, -1)
            columns = [pa.nulls(PARTS, t) for t in (id_type, pa.int64(), pa.int32(), pa.int64(), marks)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(PARTS, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names)

    return docs.mapInArrow(run, schema)


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def levels(described: DataFrame) -> np.ndarray:
    """For each bucket its place in the order: 64 at the mean of all counts, 16 more for each doubling. BUCKETS small
    numbers, whatever the size of the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, hits in zip(batch.column("part").to_pylist(), batch.column("hits").to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(hits, np.uint16).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "hits"])

    counts = described.filter("part is not null").select("part", "hits").repartition("part").mapInArrow(add, "part int, hits binary")
    total = np.zeros((PARTS, BUCKETS // PARTS))
    for row in counts.toLocalIterator():
        total[row["part"]] = np.frombuffer(row["hits"], np.int64)
    total = total.ravel()
    return np.clip(64 + 16 * np.log2(np.maximum(total, 0.5) / max(total.mean(), 0.5)), 0, 255).astype(np.uint8)


def ordered(grams: np.ndarray, level: np.ndarray) -> np.ndarray:
    """A set in the global order."""
    return grams[np.argsort(level[_bucket(grams)], kind="stable")]


def prefixes(docs: DataFrame, rule: Rule, level: np.ndarray) -> DataFrame:
    """``gram, class, size, place`` of the first n-grams of each class; a class that a task meets again is left out."""
    share = rule.percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for at, to in chunks(batch.column("text")):
                parts: list[tuple[np.ndarray, int, int]] = []
                for grams in _sets(batch.column("text").slice(at, to - at), rule):
                    if len(grams) and (name := _name(grams)) not in met:
                        if len(met) < 100_000:
                            met.add(name)
                        keep = len(grams) - int(np.ceil(share * len(grams) - 1e-9)) + 1
                        parts.append((ordered(grams, level)[:keep], name, len(grams)))
                if parts:
                    counts = [len(p[0]) for p in parts]
                    gram = np.concatenate([p[0] for p in parts])
                    rank = np.maximum(level[_bucket(gram)].astype(np.int64) - 88, 0) // 16
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(gram.view(np.int64)), pa.array(np.repeat(np.array([p[1] for p in parts], dtype=np.int64), counts)),
                            pa.array(np.repeat(np.array([p[2] for p in parts], dtype=np.int32), counts)),
                            pa.array(np.concatenate([np.arange(c, dtype=np.int32) for c in counts])), pa.array(rank.astype(np.int32)),
                        ],
                        ["gram", "class", "size", "place", "level"],
                    )

    return docs.select("text").mapInArrow(run, "gram long, class long, size int, place int, level int")


def lists(prefix: DataFrame) -> DataFrame:
    """Rows of the prefixes whose n-gram two classes or more have: ``gram, class, size, place``.

    They are sought in lists by n-gram; one of level k, about 2^k times three as frequent as the mean, is dealt out over 4^k lists by class, so that no list is much longer
    than those of rare n-grams, and kept. A class that several tasks have met has each n-gram once.
    """
    salt = F.when(F.col("level") > 0, F.pmod(F.col("class"), F.expr("shiftleft(1, least(2 * level, 20))"))).otherwise(F.lit(-1)).cast("int")
    packed = F.shiftleft(F.col("size").cast("long"), 32).bitwiseOR(F.col("place").cast("long"))  # fewer bytes to shuffle
    keyed = prefix.select("gram", salt.alias("salt"), "class", packed.alias("facts"))
    w = Window.partitionBy("gram", "salt")
    found = keyed.withColumn("same", F.lag("class").over(w.orderBy("class")))
    found = found.withColumn("low", F.min("class").over(w)).withColumn("high", F.max("class").over(w))
    size, place = F.shiftright("facts", 32).cast("int"), F.col("facts").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    found = found.filter(F.col("same").isNull() | (F.col("same") < F.col("class")))
    return found.filter((F.col("low") < F.col("high")) | (F.col("salt") >= 0)).select("gram", "class", size.alias("size"), place.alias("place"))


def _least(a: Column, b: Column, percent: int) -> Column:
    """Least number of common n-grams of sets of these sizes that link."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent) - F.lit(1e-9))


def _possible(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can link."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def overlaps(docs: DataFrame, pairs: DataFrame, rule: Rule, level: np.ndarray) -> DataFrame:
    """``a, b, size_a, size_b, common`` of each pair of classes; ``pairs`` has ``a, b`` and the key of a row of each, ``key_a, key_b``.

    Each pair is in a block with some others of the same ``a``. A block's ``a`` and each ``b`` come as rows of (block,
    fragment), which holds the n-grams of one range of the order. A fragment's overlaps are counted where it lies, then
    summed per pair.
    """
    sized = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("n")), "ngram-blocks")
    blocks = written(pairs.join(sized, "a").select("a", "b", "key_a", "key_b", F.pmod(F.xxhash64("b"), F.col("n")).alias("block")), "ngram-pairs")
    uses = blocks.select(F.col("key_b").alias("key"), F.col("b").alias("class"), "a", "block").unionByName(
        blocks.select(F.col("key_a").alias("key"), F.col("a").alias("class"), "a", "block").distinct()
    )
    texts = texts_of(docs.select("key", "text"), written(uses.withColumn("n", F.lit(1)), "ngram-uses"), "key").select("class", "a", "block", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([(f << 64) // FRAGMENTS for f in range(1, FRAGMENTS)], dtype=np.uint64)
        for batch in batches:
            for at, to in chunks(batch.column("text")):
                part = batch.slice(at, to - at)
                rows: list[tuple] = []
                keys = zip(*[part.column(c).to_pylist() for c in ("class", "a", "block")], strict=True)
                for (name, a, block), grams in zip(keys, _sets(part.column("text"), rule), strict=True):
                    if len(grams) and _name(grams) == name:  # another text of the same key is another class
                        pieces = np.split(grams, np.searchsorted(grams, bounds))
                        rows += [(a, block, f, name, len(grams), piece.tobytes()) for f, piece in enumerate(pieces)]
                columns = list(zip(*rows, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "block", "fragment", "class", "size", "grams"])

    pieces = texts.mapInArrow(cut, "a long, block long, fragment int, class long, size int, grams binary")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, size = None, np.zeros(0, np.uint64), 0
        for batch in batches:
            rows = []
            for a, block, f, name, n, grams in zip(*[c.to_pylist() for c in batch.columns[:6]], strict=True):
                grams = np.frombuffer(grams, np.uint64)
                if name == a:
                    key, head, size = (a, block, f), grams, n
                elif key == (a, block, f):
                    common = 0
                    if len(head) and len(grams):
                        found = np.minimum(np.searchsorted(head, grams), len(head) - 1)
                        common = int((head[found] == grams).sum())
                    rows.append((a, name, f, size, n, common))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "fragment", "size_a", "size_b", "common"])

    dealt = pieces.withColumn("other", F.col("class") != F.col("a")).repartition("a", "block", "fragment").sortWithinPartitions("a", "block", "fragment", "other")
    partial = dealt.select("a", "block", "fragment", "class", "size", "grams").mapInArrow(count, "a long, b long, fragment int, size_a int, size_b int, common long")
    once = partial.groupBy("a", "b", "fragment").agg(F.max("size_a").alias("size_a"), F.max("size_b").alias("size_b"), F.max("common").alias("common"))
    return once.groupBy("a", "b").agg(F.max("size_a").alias("size_a"), F.max("size_b").alias("size_b"), F.sum("common").alias("common"))


def linked(counted: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose overlap reaches the threshold."""
    union = F.col("size_a") + F.col("size_b") - F.col("common")
    return counted.filter(100 * F.col("common") >= rule.percent * union).select("a", "b", "common")


def _key(doc_id: Column, text: Column) -> Column:
    """A hash that rows of the same id and text have in common, never null."""
    return F.xxhash64(doc_id, text)


def join(docs: DataFrame, rule: Rule = Rule(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    rows, classes, roots = grouped(docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), rule)
    named = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = written(named.filter("rows > 1 or root <> class").unionByName(named.join(roots.select("root").distinct(), "root", "left_semi").select(named.columns).filter("rows = 1 and root = class")), "ngram-roots")
    least = written(named.groupBy("root").agg(F.min("first.doc_id").alias("component_id")), "ngram-least")
    ids = written(named.join(least, "root").select("class", "component_id"), "ngram-components")
    return rows.join(ids, "class", "left").select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def grouped(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``doc_id, key, size, class`` of every row; ``class, first, rows`` of every class, ``first`` being its row with the least
    id; ``node, root`` of the classes that link. ``docs`` has ``doc_id, text``."""
    docs = docs.withColumn("key", _key(F.col("doc_id"), F.col("text")))
    described = written(describe(docs, rule), "ngram-sets")
    level = levels(described)
    rows = described.filter("part is null").select("doc_id", "key", "size", "class", "mark")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))
    classes = written(rows.filter("class is not null").groupBy("class").agg(first.alias("first"), F.count("*").alias("rows"), F.any_value("mark").alias("mark")), "ngram-classes")
    dealt = written(lists(prefixes(docs, rule, level)), "ngram-lists")

    def with_keys(pairs: DataFrame, apart: Column | None = None) -> DataFrame:
        of = classes.select("class", F.col("first.key").alias("key"), *["mark"] * (apart is not None))
        of_a, of_b = (of.withColumnsRenamed({c: c.replace("class", x) if c == "class" else f"{c}_{x}" for c in of.columns}) for x in "ab")
        out = pairs.join(of_a, "a").join(of_b, "b")
        out = out if apart is None else out.filter(_differ(F.col("mark_a"), F.col("mark_b")) <= apart)
        return written(out.select("a", "b", "key_a", "key_b"), "ngram-candidates")

    links, near, often, turn = None, None, None, 0
    while True:
        # before any link a class is its own root, so the lists are read as they lie; later turns read those of frequent n-grams
        rooted = _rooted(dealt, near) if often is None else written(_rooted(often, near), "ngram-open")
        heads = written(_heads(rooted, turn), "ngram-heads")
        tests = with_keys(_stars(rooted, heads, turn, rule))
        new = written(linked(overlaps(docs, tests, rule, level), rule), "ngram-links")
        tried, hit, turn = tests.count(), new.count(), turn + 1
        links = new if links is None else written(links.unionByName(new), "ngram-links")
        near = components(links) if hit else near
        if 10 * hit < tried or not hit:  # heads find little any more; the exact pass meets the rest at less than a turn costs
            break
        if often is None:
            often = written(dealt.join(heads.filter(F.col("n") > 2 * HEADS).select("gram"), "gram", "left_semi"), "ngram-often")
    rest = with_keys(_across(_rooted(dealt, near), rule), F.col("apart"))
    links = written(links.unionByName(linked(overlaps(docs, rest, rule, level), rule)), "ngram-links")
    return rows.drop("mark"), classes.drop("mark"), components(links)


def _rooted(opened: DataFrame, near: DataFrame | None) -> DataFrame:
    """``opened`` with the root of each class, and how many classes have that root."""
    plain = opened.select("gram", "class", "size", "place")
    if near is None:
        return plain.withColumn("root", F.col("class")).withColumn("many", F.lit(1).cast("long"))
    many = near.groupBy("root").agg(F.count("*").alias("many"))
    of = written(near.join(many, "root").select(F.col("node").alias("class"), "root", "many"), "ngram-near")
    found = plain.join(of, "class", "left")
    return found.withColumn("root", F.coalesce("root", "class")).withColumn("many", F.coalesce("many", F.lit(1).cast("long")))


def _heads(opened: DataFrame, turn: int) -> DataFrame:
    """Heads of this turn for each n-gram whose classes have several roots: classes of the largest component; ``n``: how many
    classes the n-gram has.

    The first turn has one head for each. Later ones try some more, and are given the n-grams of many classes only; where
    an n-gram has few, the exact pass is as cheap.
    """
    facts = [F.max(F.struct("many", F.xxhash64(F.lit(turn), F.lit(i), "class").alias("order"), "class", "size", "root")) for i in range(HEADS if turn else 1)]
    found = opened.groupBy("gram").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.array(*facts).alias("heads"))
    found = found.filter("low <> high").select("gram", "n", F.explode("heads").alias("head"))
    return found.select("gram", "n", F.col("head.class").alias("a"), F.col("head.size").alias("size_a"), F.col("head.root").alias("root_a")).distinct()


def _stars(opened: DataFrame, heads: DataFrame, turn: int, rule: Rule) -> DataFrame:
    """Pairs ``a, b``: classes with the heads that they share many n-grams with, for a prefix; at first with the best only."""
    met = opened.join(heads.drop("n"), "gram").filter((F.col("root") != F.col("root_a")) & _possible(F.col("size"), F.col("size_a"), rule.percent))
    shared = met.groupBy("class", "size", "a").agg(F.count("*").alias("n")).filter(10 * F.col("n") >= F.col("size"))
    if turn:
        return shared.select("a", F.col("class").alias("b")).groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b")
    best = shared.groupBy("class").agg(F.max(F.struct("n", "a")).alias("best"))
    return best.select(F.col("best.a").alias("a"), F.col("class").alias("b"))


def _differ(a: Column, b: Column) -> Column:
    """Least number of n-grams that only one of two sets with these parities has; the more are folded to as few as the others."""
    n = F.least(F.size(a), F.size(b))

    def at(mark: Column, i: Column) -> Column:
        return F.aggregate(F.sequence(i, F.size(mark) - 1, n), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(mark, j)))

    odd = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.bit_count(at(a, i).bitwiseXOR(at(b, i))))
    return F.aggregate(odd, F.lit(0), lambda x, y: x + y)


def _across(rooted: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``a, b`` of classes that share a first n-gram, lie in different components and can still link; ``apart``: the
    most n-grams that only one of them has if they do."""
    sa, sb = F.col("size_a"), F.col("size_b")
    pairs = _met(rooted, rule).dropDuplicates(["class_a", "class_b"])
    return pairs.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"), (sa + sb - 2 * _least(sa, sb, rule.percent)).alias("apart"))


def _met(rooted: DataFrame, rule: Rule) -> DataFrame:
    """``class, size`` of two classes (``_a``, ``_b``) of different components, at n-grams they share that can be the first they
    share if they link."""
    main = rooted.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.struct("many", "root")).alias("main"))
    main = written(main.filter("low <> high").select("gram", F.col("main.root").alias("main")), "ngram-main")
    # an n-gram that follows one and the same in both sets is not the first they share
    before = F.lag("gram").over(Window.partitionBy("class").orderBy("place"))
    open_rows = written(rooted.join(main, "gram").withColumn("before", before), "ngram-rooted")
    # of two classes with different roots one at least is not of the n-gram's main root: members of that never meet
    left, right = (open_rows.select("gram", *[F.col(c).alias(f"{c}_{x}") for c in ("class", "size", "place", "root", "main", "before")]) for x in "ab")
    met = left.filter("root_a <> main_a").join(right, "gram").filter("root_a <> root_b and (root_b = main_b or class_a < class_b)")
    turned = F.col("class_a") > F.col("class_b")
    sides = [F.when(turned, F.col(f"{c}_{y}")).otherwise(F.col(f"{c}_{x}")).alias(f"{c}_{x}") for c in ("class", "size") for x, y in ("ab", "ba")]
    sa, sb, pa_, pb = (F.col(c) for c in ("size_a", "size_b", "place_a", "place_b"))
    first = ~F.coalesce(F.col("before_a") == F.col("before_b"), F.lit(False))
    enough = F.least(sa - pa_, sb - pb) >= _least(sa, sb, rule.percent)  # what is left from there on
    return met.filter(first & _possible(sa, sb, rule.percent) & enough).select(*sides)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the documents: five words, 75 percent."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: of its least id, if it has one; of equal rows, and of rows of one id and text, any.

    Rows without words are in no component; of those with the same id one stays, and all without an id."""
    rows, classes, roots = grouped(docs.select("doc_id", "text"), Rule())
    named = classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
    first = named.groupBy(F.coalesce("root", "class").alias("root")).agg(F.min("first").alias("first")).select("first.doc_id", "first.key")
    bare = rows.filter("class is null and doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("key"))
    kept = written(first.unionByName(bare).select(F.struct("doc_id", "key").alias("key of row")).distinct(), "ngram-kept")
    # the rows of a key become one in each task before texts are shuffled
    keyed = docs.withColumn("key of row", F.struct("doc_id", _key(F.col("doc_id"), F.col("text")).alias("key")))
    once = keyed.withColumn("copy of row", F.row_number().over(Window.partitionBy("key of row").orderBy("key of row"))).filter("`copy of row` = 1")
    return once.join(kept, "key of row").select(docs.columns).unionByName(docs.filter(F.col("doc_id").isNull() & (word_count(F.col("text")) == 0)))
