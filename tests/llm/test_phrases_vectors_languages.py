"""Collocations, whitening and language identification against brute force and held-out rows, on small tables."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.llm import collocations, language_id, whitening

# -- collocations -----------------------------------------------------------------------------------------------------------


def pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute_collocations(rows, least, longest, top, inside):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            totals[lang] += len(w)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        dropped = {
            g[i : i + m] for g, a in candidates.items() for m in range(2, len(g)) for i in range(len(g) - m + 1) if 100 * a >= inside * f[g[i : i + m]]
        }
        found = []
        for g, a in candidates.items():
            if g not in dropped:
                score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows():
    r = random.Random(7)
    vocabulary = ["new", "York", "times", "of", "the", "state", "Ärger", "ß", "a-b", "x y", "in", "and"]
    rows = []
    for i in range(160):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 4)):
            at = r.randint(0, len(words))
            words[at:at] = r.choice([["New", "york", "Times"], ["state", "of", "the", "art"], ["of", "the"]])
        text = "".join(w + r.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for w in words)
        rows.append((text, ("en", "de", None, "und")[i % 4]))
    rows += [(None, "en"), ("", "en"), ("  \t.,;\n", "fr"), ("one", None), ("and " * 3000, "en"), ("ha ha ha ha. ha", "de"), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("hot", [1 << 18, 40])
def test_collocations(spark, monkeypatch, hot):
    monkeypatch.setattr(collocations, "HOT", hot)  # the small one deals frequent pairs over tasks
    monkeypatch.setattr(collocations, "BLOCK", 2000)
    rows = phrase_rows()
    table = spark.createDataFrame([(i, t, g, "clash", 1, 2) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, word string, n long, f long").repartition(5)
    for least, top in ((6, 2000), (30, 3)):
        got = sorted(tuple(r) for r in collocations.collocations(table, least=least, top=top).collect())
        expected = brute_collocations(rows, least, 4, top, 80)
        assert expected and got == expected


def test_collocations_of_nothing(spark):
    schema = "text string, lang string"
    assert collocations.collocations(spark.createDataFrame([], schema)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("a b c", "en")], schema)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_equal_parts(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 400))
    keys = rng.integers(1, 5, (n, 4)).astype(np.uint64)
    for i, stop in enumerate(rng.integers(2, 5, n)):
        keys[i, stop:] = 0
    weights = rng.integers(1, 9, n)
    for least in (1, 12):
        counts = collections.Counter()
        for row, w in zip(keys.tolist(), weights.tolist(), strict=True):
            for m in range(2, 5):
                if row[m - 1]:
                    counts[tuple(row[:m])] += w
        got = {tuple(keys[p, :d].tolist()): int(w) for d, at, ws in collocations.equal_parts(keys, weights, least) for p, w in zip(at, ws, strict=True)}
        assert got == {k: v for k, v in counts.items() if v >= least}


def test_marks_hold_every_number(spark):
    numbers = [(i * 7919 - (1 << 62),) for i in range(500)] + [(-1,), (0,), ((1 << 63) - 1,)]
    bits = collocations.bit_map(spark.createDataFrame(numbers, "v long"), "v", len(numbers))
    assert collocations.marked(bits, np.array([v for v, in numbers], np.int64).view(np.uint64)).all()
    assert not collocations.marked(bits, np.arange(5000, 9000, dtype=np.uint64)).all()


# -- whitening --------------------------------------------------------------------------------------------------------------


def integers(vector, width, scale=256):
    out = [int(np.floor(scale * float(np.float32(c)))) for c in vector]
    return tuple(out + [0] * (width - len(out)))


def brute_whitening(rows, width, by_multiplicity=False):
    valid = [(i, integers(v, width)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = [x for _, x in valid] if by_multiplicity else sorted({x for _, x in valid})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    out = {}
    for i, x in valid:
        w = (np.array(x, float) - np.array(sums) / n) @ axes / np.sqrt(values)
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        out[i, x] = (n, deviation, np.abs(w), values / np.trace(centred.T @ centred / n))
    return valid, out


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=6) * [3, 2, 1.5, 1, 0.5, 0.2])]) for i in range(150)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # one vector of a third of the rows
    rows += [(2000, rows[1][1][:4]), (2001, [*rows[1][1][:4], 0.0, 0.0]), (2002, None), (2003, [1.0, None]), (2004, [float("nan"), 1.0]), (2005, [float("inf")]), (2006, [])]
    return [*rows, rows[3], rows[3], (None, rows[4][1])]


@pytest.mark.parametrize("by_multiplicity", [False, True])
@pytest.mark.parametrize("hot_share", [1 / 500, 1.0])
def test_whitening(spark, by_multiplicity, hot_share):
    rows = vector_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("vector", F.lit(0)).repartition(3)
    got = whitening.whiten(table, by_multiplicity=by_multiplicity, hot_share=hot_share).collect()
    valid, expected = brute_whitening(rows, 6, by_multiplicity)
    assert collections.Counter(r.vec_id for r in got) == collections.Counter(i for i, _ in valid)
    by_id = collections.defaultdict(list)
    for i, x in valid:
        by_id[i].append(expected[i, x])
    for r in got:
        n, deviation, whitened, explained = by_id[r.vec_id][0]
        assert (r.n, r.deviation, [p.component for p in r.whitened]) == (n, deviation, [1, 2, 3, 4])
        assert np.allclose(np.abs([p.whitened for p in r.whitened]), whitened, atol=1e-9) and np.allclose([p.explained for p in r.whitened], explained, rtol=1e-9)
        assert r.identity_error < 1e-9
    signs = {r.vec_id: [p.whitened for p in r.whitened] for r in got}
    assert signs[0] == signs[1000] == signs[1079] and signs[2000] == signs[2001]


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 3, [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], schema)).collect()
    assert [len(r.whitened) for r in line] == [1] * 5 and abs(line[0].whitened[0].explained - 1) < 1e-12


def test_deviation_of_large_entries():
    model = whitening.Whitener(3, (10, 5), np.eye(2), np.ones(2), 2.0)
    assert model.deviations(np.array([[1, 2], [1 << 40, 0]])) == [49 + 1, None]
    assert model.deviations(np.array([[1 << 28, 0]])) == [(3 * (1 << 28) - 10) ** 2 + 25]


# -- language identification ------------------------------------------------------------------------------------------------


def test_runs_of_letters():
    rows, runs, counts = language_id.run_counts(["Ab, ab!", None, "", "7 - 9", "é", "é"])
    spelled = {}
    for i, run, n in zip(rows.tolist(), runs.tolist(), counts.tolist(), strict=True):
        spelled.setdefault(i, {})["".join(chr(run >> s & 0x1FFFFF) for s in (42, 21, 0))] = n
    assert spelled == {0: {" ab": 2, "ab ": 2, "b a": 1}, 4: {" é ": 1}, 5: {" é ": 1}}


def test_vectors_are_bound_and_bundled(monkeypatch):
    monkeypatch.setattr(language_id, "SLICE", 3)
    text = "the cat and the hat"
    table, padded = language_id.letters(), f" {text} "
    expected = np.zeros(language_id.DIMENSIONS)
    for i in range(len(padded) - 2):
        a, b, c = (table.vector(ord(x)).astype(int) for x in padded[i : i + 3])
        expected += np.roll(a, 2) * np.roll(b, 1) * c
    got = language_id.vectors([None, text, "", text.upper() + "!"])
    assert (got[1] == expected).all() and (got[3] == expected).all() and not got[[0, 2]].any()


def test_languages(spark):
    r = random.Random(5)
    parts = {"aa": ["ing", "tion", "the", "an", "er"], "bb": ["ung", "sch", "ei", "der", "en"], "cc": ["ción", "que", "ado", "los", "ar"]}
    rows = []
    for i in range(240):
        lang = ("aa", "bb", "cc")[i % 3]
        text = " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(8, 60)))
        rows.append((i, text, None if i % 10 == 0 else lang, "clash"))
    odd = [(900, None, "aa", "x"), (901, "", "bb", "x"), (902, "12 34 !?", "cc", "x"), (None, rows[1][1], "bb", "x"), (903, "the tion ing " * 20000, None, "x"), rows[5], rows[5]]
    table = spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string, score string").repartition(4)
    usable = ~language_id.held_out(F.col("doc_id"))
    profiles = language_id.learn(table, usable)
    assert profiles.languages == ("aa", "bb", "cc")
    got = collections.defaultdict(list)
    for row in language_id.identify(table, profiles).collect():
        got[row.doc_id].append((row.lang_pred, row.score))
    assert {i: len(v) for i, v in got.items()} == {i: (3 if i == 5 else 1) for i in [*range(240), 900, 901, 902, 903, None]}
    assert all(got[i] == [("und", 0.0)] for i in (900, 901, 902)) and got[903][0][0] == "aa" and got[None][0][0] == "bb"
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i][0][0] == ("aa", "bb", "cc")[i % 3] for i in held) >= 0.98 * len(held)
    assert all(0 <= s <= 1 for v in got.values() for _, s in v)
    # nothing is learned from held-out rows, nor from the language of the rows that are scored
    wrong = table.withColumn("lang", F.when(usable, F.col("lang")).otherwise("zz"))
    assert language_id.learn(wrong, usable).languages == profiles.languages
    bounded = language_id.learn(table, usable, language_id.Bounds(documents=20))
    assert bounded.languages == profiles.languages and not np.allclose(bounded.prototypes, profiles.prototypes)


def test_languages_of_nothing(spark):
    schema = "doc_id long, text string, lang string"
    none = language_id.learn(spark.createDataFrame([(1, "abc", None), (2, None, "aa"), (3, "1", "aa")], schema), F.lit(True))
    assert none.languages == ()
    assert [tuple(r) for r in language_id.identify(spark.createDataFrame([(1, "abc", "aa")], schema), none).collect()] == [(1, "und", 0.0)]
    assert language_id.identify(spark.createDataFrame([], schema), none).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language_id.query(spark, sf_dir).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").filter("lang is not null")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
