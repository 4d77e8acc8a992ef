"""The quality classifier and language identification against plain loops."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_edges import words

from ledgerlake.llm import language_id, quality


def follow_by_hand(rows, size, s):
    """Per-coordinate regularised-leader updates, one number at a time; rows: (label, {bucket: value})."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        if abs(z[k]) <= s.l1:
            return 0.0
        return -(z[k] - math.copysign(s.l1, z[k])) / ((s.beta + math.sqrt(n[k])) / s.alpha + s.l2)

    for _ in range(s.passes):
        for label, x in rows:
            x = {**x, size - 1: 1.0}
            w = {k: weight(k) for k in x}
            error = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items()))) - label
            for k, v in x.items():
                step = error * v
                sigma = (math.sqrt(n[k] + step * step) - math.sqrt(n[k])) / s.alpha
                z[k] += step - sigma * w[k]
                n[k] += step * step
    return {k: weight(k) for k in z}


def test_updates_and_scores_of_the_classifier(spark):
    s = quality.Settings(bits=9, shards=1, passes=2)
    texts = [(words(6 + i % 5, i).upper() if i % 2 else words(6 + i % 5, i)) for i in range(20)] + ["", None, "one"]
    vectors = [dict(zip(*(x.tolist() for x in quality.sparse(t, s)))) for t in texts]
    rows = [(i % 2, vectors[i]) for i in range(20)]
    expected = follow_by_hand(rows, (1 << s.bits) + 1, s)
    found = quality.follow_the_leader([(y, np.array(list(x), np.int64), np.array(list(x.values()))) for y, x in rows], s)
    for k, value in enumerate(found.tolist()):
        assert value == pytest.approx(expected.get(k, 0.0), abs=1e-5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scored = {r.doc_id: r for r in quality.score(docs, found, s).collect()}
    for i, x in enumerate(vectors):
        total = found[-1] + sum(float(found[k]) * v for k, v in x.items())
        assert scored[i].score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5)
        assert scored[i].predicted == int(scored[i].score >= 0.5)


def test_fit_learns_from_the_rows_that_count(spark):
    """The sample, its shards and their mean, from the same rows by hand."""
    import zlib

    s = quality.Settings(bits=8, shards=2, passes=1)
    docs = [(i, words(8, i)) for i in range(40)]
    labels = [(i, i % 2) for i in range(30)] + [(3, 0), (None, 1), (31, None), (99, 1)]
    found = quality.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), settings=s)
    chosen = [i for i in range(30) if zlib.crc32(str(i).encode()) % 3 != 1]
    label = {i: 0 if i == 3 else i % 2 for i in chosen}
    from pyspark.sql import functions as F

    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(2))
    of = {r.doc_id: r.shard for r in spark.createDataFrame([(i,) for i in chosen], "doc_id long").select("doc_id", shard.alias("shard")).collect()}
    import pandas as pd

    order = dict(zip(chosen, pd.util.hash_array(np.array([str(i) for i in chosen], object)).tolist()))
    total, size = defaultdict(float), (1 << s.bits) + 1
    for k in (0, 1):
        mine = sorted((i for i in chosen if of[i] == k), key=lambda i: (order[i], str(i)))
        rows = [(label[i], dict(zip(*(x.tolist() for x in quality.sparse(dict(docs)[i], s))))) for i in mine]
        for at, value in follow_by_hand(rows, size, s).items():
            total[at] += value * len(mine) / len(chosen)
    for at, value in enumerate(found.tolist()):
        assert value == pytest.approx(total.get(at, 0.0), abs=1e-5)


def profile_by_hand(text, dimensions):
    """Three-letter windows as products of permuted letter vectors, added up with their counts; None without letters."""
    if not text or not any(c.isalpha() for c in text):
        return None
    table = language_id._symbols()
    letters = np.random.default_rng(4).choice(np.array([-1, 1], np.int8), (language_id.SYMBOLS, dimensions)).astype(int).tolist()
    symbols = [int(table[ord(c)]) for c in "\n" + text + "\n"]
    total = [0.0] * dimensions
    for (a, b, c), n in Counter(zip(symbols, symbols[1:], symbols[2:])).items():
        if not (b or (a and c)):
            continue
        for d in range(dimensions):
            total[d] += n * letters[a][(d - 2) % dimensions] * letters[b][(d - 1) % dimensions] * letters[c][d]
    size = math.sqrt(sum(x * x for x in total))
    return [x / size for x in total] if size else None


def test_profiles_and_cosines_by_loops(spark):
    size = 64
    texts = [("en", "the cat sat on the mat"), ("en", "a dog, and THE other dog"), ("fr", "le chat était là"), ("fr", "où est le chien"), (None, "the le"), ("en", "42 !"), ("en", None)]
    ids = [i for i in range(100) if not __import__("brute").held_out(i)][: len(texts)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in zip(ids, texts)], "doc_id long, text string, lang string")
    profiles = [profile_by_hand(t, size) for _, t in texts]
    for (_, text), expected in zip(texts, profiles):
        found = language_id.profile(text, size)
        assert (found is None) == (expected is None)
        if expected:
            assert found.tolist() == pytest.approx(expected, abs=1e-5)
    prototypes = {}
    for lang in ("en", "fr"):
        total = [sum(x) for x in zip(*(p for (x, _), p in zip(texts, profiles) if x == lang and p))]
        norm = math.sqrt(sum(x * x for x in total))
        prototypes[lang] = [x / norm for x in total]
    fitted = language_id.fit(docs, size)
    assert list(fitted) == ["en", "fr"]
    for lang, expected in prototypes.items():
        assert fitted[lang].tolist() == pytest.approx(expected, abs=1e-5)
    rows = {r.doc_id: r for r in language_id.identify(docs, size).collect()}
    for i, p in zip(ids, profiles):
        if p is None:
            assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
            continue
        cosines = {lang: sum(x * y for x, y in zip(p, v)) for lang, v in prototypes.items()}
        best = max(cosines, key=cosines.get)
        assert rows[i].lang_pred == best and rows[i].score == pytest.approx(min(max(cosines[best], 0), 1), abs=1e-5)
