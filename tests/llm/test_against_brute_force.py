"""Registered queries over the driver's smallest tables against plain Python."""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import brute
import pytest

from ledgerlake.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def run(spark, name, *columns):
    return sorted((tuple(r) for r in queries.QUERIES[name](spark, FOLDER).select(*columns).collect()), key=repr)


def test_exact_dedup(spark, documents):
    found = run(spark, "op2_exact_dedup", "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert found == brute.exact(documents)


def test_suffix_dedup(spark, documents):
    found = run(spark, "op5_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == brute.repeats(documents, 400)
    assert sum(x[2] for x in found) > 0


def test_near_dedup(spark, documents):
    assert sorted(run(spark, "op8_near_dedup", "doc_id", "n_shingles", "component_id", "kept")) == brute.near(documents)


def test_decontamination(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    found = run(spark, "op9_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert found == brute.contamination(documents, items)
    assert any(x[-1] for x in found)


def check_packing(pieces, texts):
    """Pieces (doc_id, piece, start, length, crc, sequence, offset) of the texts by id; returns the sequences."""
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc_id, piece, start, length, crc, sequence, offset in pieces:
        by_doc[doc_id].append((piece, start, length, crc))
        by_sequence[sequence].append((offset, length))
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, (piece, start, length, crc) in enumerate(sorted(by_doc[doc_id])):
            assert (piece, start) == (k, at)
            assert crc == zlib.crc32(ids[at : at + length].tobytes())
            assert k == 0 or length == 2048
            at += length
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return by_sequence


def test_packing(spark, documents):
    pieces = run(spark, "op6_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    sequences = check_packing(pieces, dict(documents))
    assert len(sequences) <= 1.05 * sum(x[3] for x in pieces) / 2048 + 2


def test_sharding(spark, documents):
    rows = queries.QUERIES["op10_sharding"](spark, FOLDER).collect()
    texts = dict(documents)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
        slots[r.shard].append(r.slot)
        shards[data].add(r.shard)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(slots) == set(range(40)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(len(x) == 1 for x in shards.values())


def test_html_text(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in queries.QUERIES["op7_html_text"](spark, FOLDER).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == " ".join(x for x in blocks if x)
        assert r.n_chars == len(r.text)


def test_language_id(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_language_id"](spark, FOLDER).collect()
    assert all(r.held_out == brute.held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    judged = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert sum(judged) >= 0.95 * len(judged)


def test_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.QUERIES["op1_quality_classifier"](spark, FOLDER).collect()
    assert all(r.held_out == brute.held_out(r.doc_id) and r.predicted == int(r.score >= 0.5) for r in rows)
    judged = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in judged if y == 1], [s for s, y in judged if y == 0]
    assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_pipeline(spark, documents):
    import corpus_pipeline

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [(i, t) for i, t in documents if any(c.isalpha() for c in t)]
    ids = {x[0] for x in brute.exact(kept) if x[3]}
    kept = [x for x in kept if x[0] in ids]
    ids = {x[0] for x in brute.near(kept) if x[3]}
    kept = [x for x in kept if x[0] in ids]
    ids = {x[0] for x in brute.contamination(kept, items) if not x[-1]}
    pieces = [tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect()]
    check_packing(pieces, {i: t for i, t in kept if i in ids})


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns


def test_lm_scores_learn(spark):
    """Trained weights predict the texts better than class frequencies alone, and shuffled words worse."""
    import random
    from math import log

    from ledgerlake.llm import lm_scoring as L

    docs = spark.read.parquet(FOLDER.replace("0.001", "0.01") + "/documents.parquet")
    s = L.Settings(masked=2)
    values = L.fit(docs, s)
    rows = {r.doc_id: r for r in L.score(docs, values, s).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(rows) == set(texts)
    weights = L.unflat(values, s)
    for i in (0, 1, 2):
        logs = L.log_probabilities(texts[i], weights, s)
        assert rows[i].n_words == len(texts[i].split()) and rows[i].score == pytest.approx(float(logs.sum()), rel=1e-4)
    total = sum(r.n_words for r in rows.values())
    assert sum(r.score for r in rows.values()) / total > -log(s.groups**2) + 0.3
    words = [w for i in range(100) for w in texts[i].split()]
    there = L.log_probabilities(" ".join(words), weights, s).mean()
    random.Random(1).shuffle(words)
    assert there > L.log_probabilities(" ".join(words), weights, s).mean()


def test_lm_scores_against_a_plain_network(spark):
    """Scores of a small corpus by loops over words, places and classes, written apart from the module."""
    from collections import Counter
    from math import exp, log, tanh

    from ledgerlake.llm import lm_scoring as L

    texts = ["a b c d e f g a b c", "b a", "", None, "solo", "g f e d c b a " * 30, "c c c c unseen"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    s = L.Settings(groups=3, inputs=11, width=4, chunk_words=20)
    held = L.words_of(docs, s)
    values = L.fit_words(held, s)
    w = {k: v.astype(float).tolist() for k, v in L.unflat(values, s).items()}

    def softmax(xs):
        es = [exp(x - max(xs)) for x in xs]
        return [e / sum(es) for e in es]

    def class_log(inputs, classes, i):
        total = list(w["hidden"])
        for k, place in enumerate((-2, -1, 1, 2)):
            there = inputs[i + place] if 0 <= i + place < len(inputs) else s.inputs
            total = [t + x * p for t, x, p in zip(total, w["words"][there], w["places"][k])]
        hidden = [tanh(t) for t in total]
        g, c = divmod(classes[i], s.groups)
        first = softmax([sum(h * w["group"][d][j] for d, h in enumerate(hidden)) + w["group_bias"][j] for j in range(s.groups)])
        gated = [h * x for h, x in zip(hidden, w["gate"][g])]
        second = softmax([sum(h * w["inside"][d][j] for d, h in enumerate(gated)) + w["inside_bias"][g][j] for j in range(s.groups)])
        return log(first[g] * second[c])

    hashes = [[int(h) for h in L.word_hashes(t)] for t in texts]
    counts = Counter(h for found in hashes for h in found)
    in_class = Counter()
    for h, n in counts.items():
        in_class[(h >> 32) % 9] += n
    scored = L.score_words(L.with_scores(held, values, s), L.vocabulary(held), s, held).collect()
    assert len(scored) == len(texts)
    for r in scored:
        found = hashes[r.doc_id]
        inputs, classes = [h % s.inputs for h in found], [(h >> 32) % 9 for h in found]
        logs = [class_log(inputs, classes, i) + log(counts[h] / (in_class[c] + 1)) for i, (h, c) in enumerate(zip(found, classes))]
        assert r.n_words == len(found) and r.score == pytest.approx(sum(logs), rel=1e-4, abs=1e-6)


def test_lm_gradients_against_differences():
    """A first step moves every weight by its slope, measured by small changes of the weight."""
    import numpy as np

    from ledgerlake.llm import lm_scoring as L

    s = L.Settings(groups=3, inputs=6, width=4, rate=0.01)
    pick = np.random.default_rng(5)
    around, target = pick.integers(0, 7, (40, 4)).astype(np.int32), pick.integers(0, 9, 40).astype(np.int32)
    start = {k: (pick.standard_normal(v) * 0.5).astype(np.float64) for k, v in s.shapes.items()}

    def loss(weights):
        *_, first, second = L.forward(weights, around, target, s)
        return -np.log(first * second).mean()

    moved, past = {k: v.copy() for k, v in start.items()}, {k: np.full_like(v, 1.0) for k, v in start.items()}
    L.train_step(moved, past, around, target, s)
    for name, values in start.items():
        for at in list(np.ndindex(values.shape))[:30]:
            up, down = ({k: v.copy() for k, v in start.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            assert values[at] - moved[name][at] == pytest.approx(s.rate * slope / np.sqrt(1 + slope * slope + 1e-8), abs=2e-6), (name, at)


def test_registered_lm_settings_learn(spark):
    """With the parameters of the query, words are predicted better than by their frequencies, and shuffled ones worse."""
    import random
    from collections import Counter
    from math import log

    from ledgerlake.llm import lm_scoring as L

    folder = FOLDER.replace("0.001", "0.01")
    docs = spark.read.parquet(folder + "/documents.parquet")
    texts = [r.text for r in docs.collect()]
    counts = Counter(h for t in texts for h in L.word_hashes(t).tolist())
    total = sum(counts.values())
    rows = queries.QUERIES["op3_lm_scoring"](spark, folder).collect()
    assert len(rows) == len(texts) and sum(r.n_words for r in rows) == total
    assert sum(r.score for r in rows) / total > sum(n * log(n / total) for n in counts.values()) / total
    weights = L.unflat(L.fit(docs), L.Settings())
    words = [w for t in texts[:100] for w in t.split()]
    there = L.log_probabilities(" ".join(words), weights, L.Settings()).mean()
    random.Random(1).shuffle(words)
    assert there > L.log_probabilities(" ".join(words), weights, L.Settings()).mean()
