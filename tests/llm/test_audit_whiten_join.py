"""Source divergence, whitening and the Jaccard join: against plain Python, and on awkward rows."""

from __future__ import annotations

import os
import random
import re
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_edges import BASE, CLASH, TEXTS, edited, frame, same, words

from ledgerlake.llm import divergence, jaccard_join, queries, whitening

FOLDER = "/root/testdata/sf0.001"
driver_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


# ---------------------------------------------------------------- source divergence


def divergence_of(rows, min_docs, top=50):
    """rows: (lang, source, text). Sorted (lang, source, part, item, value, rank)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = [(a, b, re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", brute.lower(t))) for a, b, t in rows]
    out = []
    for lang in {a for a, _, _ in found}:
        docs = [(b, w) for a, b, w in found if a == lang]
        holds = Counter(x for _, w in docs for x in set(w))
        kept = [x for x, n in holds.items() if n >= min_docs]
        p = {}
        for source in [None, *{b for b, _ in docs}]:
            count = Counter(x for b, w in docs for x in w if source in (None, b))
            total = sum(count[x] for x in kept)
            p[source] = {x: (1 + 10**9 * (count[x] + 5) // (total + 5 * len(kept)), count[x]) for x in kept}
        for source in p:
            if source is None:
                continue
            pairs = [(sum(abs(p[source][x][0] - p[o][x][0]) for x in kept), o) for o in p if o not in (None, source)]
            terms = [(p[source][x][0] - p[None][x][0], x) for x in kept if p[source][x][1] and p[source][x][0] > p[None][x][0]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, x, v, k) for k, (v, x) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out, key=repr)


COLUMNS = "lang", "source", "part", "item", "value", "rank"


def spoken(n, seed):
    pick = random.Random(seed)
    vocabulary = "the The of a Ähre ähre naïve 日本 x y1z don't".split()
    langs, sources = ["en", "de", "d e", None, ""], ["s1", "s2", None, "", "s 3", "ü"]
    made = [(pick.choice(langs), pick.choice(sources), " ".join(pick.choices(vocabulary, range(11, 0, -1), k=pick.randrange(12)))) for _ in range(n)]
    return [*made, ("fr", "alone", "un deux"), ("it", "one", None), ("it", "two", "123 !"), *made[:9]]


@pytest.mark.parametrize("block_terms", [1_000_000, 3])
def test_divergence_against_brute_force(spark, block_terms):
    rows = spoken(150, 1)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    docs = docs.select("*", *(F.lit(7).alias(c) for c in (*CLASH, "term", "terms", "count", "index", "vector", "p", "doc_id")))
    found = divergence.audit(docs, divergence.Settings(min_docs=4, top=3, block_terms=block_terms))
    assert same(found, *COLUMNS) == divergence_of(rows, 4, 3)
    assert [f.dataType.simpleString() for f in found.schema] == ["string"] * 4 + ["bigint", "int"]


def test_divergence_looks_up_a_term_of_a_document_once(spark):
    """Whatever its count, a term is in one list of its document, beside the terms of the same count."""
    texts = ["b a b c a b", "", "one", "x " * 1000 + "y y z", None]
    docs = spark.createDataFrame([("d e", str(i), t) for i, t in enumerate(texts)], "lang string, source string, text string")
    found = {int(r.source): {g["count"]: sorted(g.terms) for g in r.groups} for r in divergence.tokens(docs).collect()}
    assert found == {
        0: {3: ["d e b"], 2: ["d e a"], 1: ["d e c"]}, 1: {}, 2: {1: ["d e one"]}, 3: {1000: ["d e x"], 2: ["d e y"], 1: ["d e z"]}, 4: {}
    }


def test_divergence_without_kept_terms_or_rows(spark):
    rows = [("en", "a", "one"), ("en", "b", "two"), ("de", "a", None), (None, None, "")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert same(divergence.audit(docs), *COLUMNS) == divergence_of(rows, 30)
    assert divergence.audit(docs.limit(0)).collect() == []


# ---------------------------------------------------------------- whitening


def check_whitening(found, vectors):
    """Rows of the result against exact sums and numpy's eigenvectors; vectors: {vec_id: list}."""
    x = {i: [int(np.floor(1024 * float(c))) + 100_000 for c in v] for i, v in vectors.items()}
    n, d = len(x), len(next(iter(x.values())))
    totals = [sum(v[k] for v in x.values()) for k in range(d)]
    deviation = {i: sum((n * c - t) ** 2 for c, t in zip(v, totals)) for i, v in x.items()}
    centred = {i: np.array([float(Fraction(n * c - t, n)) for c, t in zip(v, totals)]) for i, v in x.items()}
    cov = sum(np.outer(v, v) for v in centred.values()) / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(found) == n * min(d, 8)
    by_row = {}
    for r in found:
        assert r.n == n and r.deviation == deviation[r.vec_id]
        by_row.setdefault(r.component, {})[r.vec_id] = r
    for k, rows in by_row.items():
        value = values[k - 1]
        if value < 1e-9 * max(values[0], 1):
            assert all(r.whitened is None and r.explained == 0 for r in rows.values())
            continue
        assert all(r.explained == pytest.approx(value / values.sum(), rel=1e-9) for r in rows.values())
        ours = np.array([rows[i].whitened for i in centred])
        same_value = basis[:, np.isclose(values, value, rtol=1e-7)]
        theirs = np.array([centred[i] for i in centred]) @ same_value / np.sqrt(value)
        # the component lies in the space of its eigenvalue: its length there is 1
        weights = np.linalg.lstsq(theirs, ours, rcond=None)[0]
        assert np.abs(theirs @ weights - ours).max() < 1e-7 and np.linalg.norm(weights) == pytest.approx(1, rel=1e-7)
        assert r.identity_error < 1e-10
    return by_row


def embedded(spark, rows, kind="double"):
    made = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return made.select("*", *(F.lit(7).alias(c) for c in ("key", "vector", "white", "n", "component", "d", "squares", "label")))


@driver_tables
def test_whitening_query(spark):
    rows = queries.QUERIES["op12_embedding_whitening"](spark, FOLDER)
    assert dict(rows.dtypes)["deviation"] == "bigint"
    source = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    check_whitening(rows.collect(), {r.vec_id: r.embedding for r in source})


def test_whitening_leaves_out_what_it_cannot_use(spark):
    pick = np.random.default_rng(1)
    good = {i: (pick.normal(size=5) * [5, 4, 3, 2, 1]).tolist() for i in range(40)}
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [1.0, float("nan"), 1.0, 1.0, 1.0]), (103, [float("inf")] * 5), (104, []), (105, [1.0])]
    rows = embedded(spark, [*good.items(), *bad, (106, [2.0**60, 0.0, 0.0, 0.0, 0.0])]).repartition(3)
    check_whitening(whitening.whiten(rows).collect(), good)


def test_whitening_of_equal_eigenvalues_and_dependent_entries(spark):
    unit = [tuple(s if k == j else 0.0 for k in range(6)) for j in range(6) for s in (-1.0, 1.0)]
    check_whitening(whitening.whiten(embedded(spark, list(enumerate(map(list, unit))))).collect(), dict(enumerate(unit)))
    pick = np.random.default_rng(2)
    thin = {i: [a, b, a, 2 * b, 7.0, a, b, 0.0, a, b] for i, (a, b) in enumerate(pick.integers(-9, 9, (30, 2)).astype(float).tolist())}
    found = check_whitening(whitening.whiten(embedded(spark, list(thin.items()))).collect(), thin)
    assert len(found) == 8


def test_whitening_of_large_entries(spark):
    """Entries whose products need several limbs, and deviations beyond 64 bits."""
    pick = np.random.default_rng(3)
    rows = {i: (pick.normal(size=3) * [2.0**44, 2.0**42, 2.0**40]).tolist() for i in range(25)}
    check_whitening(whitening.whiten(embedded(spark, list(rows.items()))).collect(), rows)


def test_whitening_of_few_rows(spark):
    assert whitening.whiten(embedded(spark, [])).collect() == []
    (one,) = {(r.whitened, r.explained, r.identity_error, r.deviation) for r in whitening.whiten(embedded(spark, [(1, [1.0, 2.0])])).collect()}
    assert one == (None, 0.0, None, 0)
    again = whitening.whiten(embedded(spark, [(1, [1.0, 2.0])] * 3 + [(None, [2.0, 2.0])])).collect()
    assert sorted(((r.vec_id or 0), r.component, round(abs(r.whitened), 6)) for r in again if r.component == 1) == [
        (0, 1, 1.732051), (1, 1, 0.57735), (1, 1, 0.57735), (1, 1, 0.57735)
    ]


def test_exact_polynomial_and_roots(spark):
    pick = np.random.default_rng(4)
    base = pick.integers(-50, 50, (7, 5))
    matrix = (base @ base.T).tolist()  # rank 5, two roots are 0
    poly = whitening.characteristic_polynomial(spark, matrix)
    for t in (0, 1, -3, 17):
        shifted = [[Fraction(t * (i == j) - x) for j, x in enumerate(row)] for i, row in enumerate(matrix)]
        value = Fraction(1)
        for k in range(7):
            at = next((i for i in range(k, 7) if shifted[i][k]), None)
            if at is None:
                value = Fraction(0)
                break
            if at != k:
                shifted[k], shifted[at], value = shifted[at], shifted[k], -value
            value *= shifted[k][k]
            for i in range(k + 1, 7):
                times = shifted[i][k] / shifted[k][k]
                shifted[i] = [a - times * b for a, b in zip(shifted[i], shifted[k])]
        assert sum(c * t**k for k, c in enumerate(poly)) == value
    roots = whitening.largest_roots(poly, sum(matrix[i][i] for i in range(7)), 7)
    found = [a / 2**s for a, s, m in roots for _ in range(m)]
    assert found == pytest.approx(np.linalg.eigvalsh(np.array(matrix, float))[::-1][:5].tolist(), rel=1e-9)


# ---------------------------------------------------------------- Jaccard join


def joined(rows, percent=85):
    from collections import defaultdict

    sets = {i: brute.shingles(t, 4) for i, t in rows}
    holders = defaultdict(list)
    for i, found in sets.items():
        for x in found:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, found in sets.items():
        for j, n in Counter(j for x in found for j in holders[x] if j > i).items():
            if 100 * n >= percent * (len(found) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted((i, len(s), root(i)) for i, s in sets.items())


JOIN = "doc_id", "n_shingles", "component_id"


@driver_tables
def test_jaccard_join_query(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = joined(documents)
    assert sorted(same(queries.QUERIES["op13_jaccard_join"](spark, FOLDER), *JOIN)) == found
    assert any(x[0] != x[2] for x in found)


def test_jaccard_join_of_awkward_rows(spark):
    docs = frame(spark, TEXTS).repartition(3)
    assert sorted(same(jaccard_join.classes(docs), *JOIN)) == joined(TEXTS)
    assert jaccard_join.classes(docs.limit(0)).collect() == []
    twice = same(jaccard_join.classes(frame(spark, [*TEXTS[:9], *TEXTS[3:9], (None, "word"), (None, BASE)])), *JOIN)
    assert twice.count((6, 77, 6)) == 2 and (None, 1, 4) in twice and (None, 77, 6) in twice and (2, 0, 2) in twice


CHAINS = [(i, edited(words(120, 8), 1 + i % 4, i)) for i in range(120)] + [(200 + i, words(50, 50 + i)) for i in range(20)]
CHAINS += [(300 + i, " ".join(f"w{k}" for k in range(i, i + 90))) for i in range(0, 60, 2)]  # each links with the next ones only


@pytest.mark.parametrize(
    "settings",
    [
        jaccard_join.Settings(),
        jaccard_join.Settings(block=1500, anchors=1, bucket=512, batch=2000, hot=3),
        jaccard_join.Settings(block=300, anchors=0, bucket=4096, batch=500, hot=2),
    ],
)
def test_jaccard_join_in_blocks(spark, settings):
    """Near copies, and chains that only hold together through links between blocks; shingles hotter than `hot`."""
    assert sorted(same(jaccard_join.classes(frame(spark, CHAINS).repartition(3), settings), *JOIN)) == joined(CHAINS)


def test_merge_skip_and_partners_against_counting():
    pick = random.Random(5)
    for _ in range(200):
        lists = [sorted(pick.sample(range(30), pick.randrange(1, 15))) for _ in range(pick.randrange(1, 12))]
        need = pick.randrange(1, len(lists) + 1)
        counts = Counter(x for held in lists for x in held)
        assert list(jaccard_join.merge_skip(lists, need)) == sorted((x, n) for x, n in counts.items() if n >= need)
    settings = jaccard_join.Settings(percent=60)
    sets = [np.array(sorted(pick.sample(range(25), pick.randrange(1, 20))), np.uint64) for _ in range(120)]
    index = jaccard_join.Index([len(x) for x in sets], sets, settings)
    for query in sets:
        found = {int(index.order[k]) for k in index.partners(index.numbers(query), len(query))}
        expected = {
            k for k, other in enumerate(sets) if 100 * (both := len(set(query.tolist()) & set(other.tolist()))) >= 60 * (len(query) + len(other) - both)
        }
        assert found == expected


def test_a_group_of_near_copies_is_not_searched_pair_by_pair():
    base = np.arange(300, dtype=np.uint64)
    sets = [np.union1d(np.delete(base, k % 300), [np.uint64(1000 + k)]) for k in range(2000)]
    index = jaccard_join.Index([len(x) for x in sets], sets, jaccard_join.Settings())
    searched = []
    plain = jaccard_join.merge_skip
    try:
        jaccard_join.merge_skip = lambda lists, need: searched.append(sum(map(len, lists))) or plain(lists, need)
        assert len(index.spanning_links()) == 1999
    finally:
        jaccard_join.merge_skip = plain
    assert sum(searched) < 20 * 2000 * 300 / 10
