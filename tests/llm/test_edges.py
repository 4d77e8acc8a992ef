"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import html
import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import (
    decontaminate,
    exact_dedup,
    html_text,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    quality,
    sharding,
    suffix_dedup,
)
from ledgerlake.llm.components import components
from ledgerlake.llm.queries import tokenizer_file

CLASH = (
    "row k1 k2 node root score shard slot seed link keep_id recipe norm chunks signature set_key found _text rank "
    "label held_out lang_pred hit_spans items piece length text_key place value kept"
).split()


def words(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(pick.randrange(999)) for _ in range(n))


BASE = words(80, 1)
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "word"),
    (5, "WORD"),
    (6, BASE),
    (7, BASE.replace(" ", "  \n", 3)),
    (8, BASE + " and one more"),
    (9, words(40, 2) + " " + words(60, 3) + " " + words(30, 4)),
    (10, words(60, 3)),
    (11, "é" * 500 + " ñandú 日本語 😀 " + "x" * 900),
    (12, "a" * 3000),
    (13, words(20_000, 5)),
    (14, "!!! ??? 123"),
    (15, "\x00\x01 control \x7f text"),
]
KIND = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, extra=True):
    docs = spark.createDataFrame([(i, t, None if i == 4 else "en", None, len(t or "")) for i, t in texts], KIND)
    return docs.select("*", *(F.lit(7).alias(c) for c in CLASH)) if extra else docs


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS).repartition(3)


@pytest.fixture(scope="module")
def twice(spark):
    """Repeated rows, and a row without id."""
    return frame(spark, [*TEXTS[:9], *TEXTS[3:9], (None, "word"), (None, BASE)])


def same(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_exact_dedup(docs, twice):
    columns = "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    assert same(exact_dedup.exact_groups(docs), *columns) == brute.exact(TEXTS)
    rows = [tuple(r) for r in twice.select("doc_id", "text").collect()]
    assert same(exact_dedup.exact_groups(twice), *columns) == brute.exact(rows)


def test_exact_dedup_tells_apart_chunks_of_one_fingerprint(docs):
    weak = lambda c: F.length(c).cast("long") % F.lit(3)
    cuts = exact_dedup.Cuts(16, 64)
    found = exact_dedup.exact_groups(docs, cuts, weak)
    assert same(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(TEXTS)


def test_chunks_end_where_the_content_says(spark):
    import re

    pattern = re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), exact_dedup.Cuts(16, 1024).pattern())
    text = words(4000, 6)
    chunks, later = (re.findall(pattern, x) for x in (text, "one edit " + text))
    assert "".join(chunks) == text
    assert len(set(chunks) & set(later)) > 0.8 * len(chunks)


def test_suffix_dedup(docs, twice):
    columns = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    assert same(suffix_dedup.remove_repeats(docs), *columns) == brute.repeats(TEXTS, 400)
    rows = [tuple(r) for r in twice.select("doc_id", "text").collect()]
    assert same(suffix_dedup.remove_repeats(twice), *columns) == brute.repeats(rows, 400)


def test_suffix_dedup_at_every_offset(spark, monkeypatch):
    """Short strings of few letters, so that repeats overlap in many ways; long texts in small segments."""
    pick = random.Random(7)
    core = ["".join(pick.choice("ab") for _ in range(n)) for n in (30, 55, 80)]
    rows = [(i, "".join(pick.choice([*core, "".join(pick.choice("ab") for _ in range(9))]) for _ in range(pick.randrange(6)))) for i in range(40)]
    rows += [(40, "a" * 70), (41, "ab" * 40), (42, "a" * 23), (43, "a" * 24)]
    settings = suffix_dedup.Settings(length=24, block=4)
    found = suffix_dedup.remove_repeats(frame(spark, rows), settings)
    columns = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    assert same(found, *columns) == brute.repeats(rows, 24)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 32)
    import numpy as np

    for i, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        starts = [s + off for off, _, _, first, n in suffix_dedup.runs(data, settings) for a, b in zip(first, n) for s in range(a, a + b)]
        assert starts == list(range(max(0, len(data) - 23)))


def test_suffix_dedup_of_many_equal_rows(spark):
    """500 rows alike in id and text: the spans found are those of one of them."""
    from ledgerlake.llm.scratch import Scratch

    text = words(120, 70)
    rows = [(1, text)] * 500 + [(2, text[:700])]
    docs = frame(spark, rows).repartition(4)
    found = suffix_dedup.repeats(docs.select("doc_id", "text"), suffix_dedup.Settings(), Scratch(spark))
    most = max(len(r.found) for r in found.collect())
    assert most <= len(text)
    columns = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    assert same(suffix_dedup.remove_repeats(docs), *columns) == brute.repeats(rows, 400)


def test_buckets_are_refined_in_rounds():
    import numpy as np

    data = np.frombuffer(("ab" * 300 + words(100, 71) + "ab" * 300).encode(), np.uint8)
    for size in (5, 24, 64, 200):
        ids = suffix_dedup.bucket_ids(data, size).tolist()
        strings = [data[k : k + size].tobytes() for k in range(len(data) - size + 1)]
        assert len(ids) == len(strings) and len(set(zip(ids, strings))) == len(set(ids)) == len(set(strings))
    assert len(suffix_dedup.bucket_ids(data[:10], 200)) == 0


def test_near_dedup(docs):
    found = same(near_dedup.classes(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(found) == brute.near(TEXTS)


def test_near_dedup_of_repeated_rows(twice):
    rows = same(near_dedup.classes(twice), "doc_id", "component_id", "kept")
    assert (None, 4, False) in rows and (None, 6, False) in rows
    assert rows.count((6, 6, True)) == 2 and rows.count((1, 1, True)) == 1


def edited(base, n, seed):
    pick, parts = random.Random(seed), base.split()
    for _ in range(n):
        parts[pick.randrange(len(parts))] = f"edit{pick.randrange(10**6)}"
    return " ".join(parts)


def test_near_dedup_of_a_large_bucket(spark):
    """More near copies than a block holds, some linked only through others."""
    rows = [(i, edited(words(150, 8), i % 5, i)) for i in range(150)] + [(200 + i, words(50, 50 + i)) for i in range(20)]
    settings = near_dedup.Settings(block=16, leaders=2)
    found = same(near_dedup.classes(frame(spark, rows), settings), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(found) == brute.near(rows)


def test_sequential_test_keeps_what_is_similar():
    import numpy as np

    settings, pick = near_dedup.Settings(), np.random.default_rng(1)
    left = pick.integers(0, 1 << 16, (4000, settings.hashes)).astype("<u2")
    every = np.arange(len(left))
    for share, least, most in ((0.88, 0.999, 1), (0.5, 0, 0.001)):
        right = np.where(pick.random(left.shape) < share, left, pick.integers(0, 1 << 16, left.shape)).astype("<u2")
        kept, _ = near_dedup.survivors(left, right, (every, every), settings)
        assert least <= len(kept) / len(left) <= most


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1002, 1001), (5, 5)] + [(2000, 2001 + i) for i in range(50)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {found[i] for i in range(201)} == {0} and {found[i] for i in (1000, 1001, 1002)} == {1000}
    assert {found[2000 + i] for i in range(51)} == {2000}


@pytest.mark.parametrize("distinct, width", [(0, 2), (1 << 16, 2), ((1 << 16) + 1, 4)])
def test_chunks_hold_places_as_bytes(spark, distinct, width):
    texts = [None, " ".join(f"w{i}" for i in range(distinct)), "", " ".join(f"w{i}" for i in range(0, distinct, 7))]
    held = lm_scoring.words_of(frame(spark, list(enumerate(texts))).coalesce(1))
    assert dict(held.dtypes)["at"] == "binary"
    ((hashes, n_words),) = lm_scoring._held(held.toArrow().to_batches())
    found = [lm_scoring.word_hashes(x) for x in texts]
    assert hashes.tolist() == [h for x in found for h in x.tolist()] and sorted(n_words) == sorted(map(len, found))
    assert len(held.first()["at"]) == width * len(hashes)


@pytest.mark.parametrize("kind, of", [("bigint", int), ("string", "n{:03d}".format)])
def test_components_take_no_round_where_links_fit_a_task(spark, monkeypatch, kind, of):
    from ledgerlake.llm import components as module

    plain, written = module.materialize, []
    monkeypatch.setattr(module, "materialize", lambda df, name: written.append(name) or plain(df, name))
    edges = [(of(i + 1), of(i)) for i in range(200)] + [(of(i), of(i + 1)) for i in range(200)] + [(of(900), None), (of(7), of(7))]
    links = spark.createDataFrame(edges, f"u {kind}, v {kind}").repartition(3)
    expected = sorted((of(i), of(0)) for i in range(201))
    assert sorted((r.node, r.root) for r in components(links).collect()) == expected
    assert not {"large-star", "small-star"} & set(written)
    monkeypatch.setattr(module, "_HELD", 9)  # the rounds do the same
    assert sorted((r.node, r.root) for r in components(links).collect()) == expected
    assert {"large-star", "small-star"} < set(written)


ITEMS = [(1, words(30, 3)), (2, "short item"), (3, None), (4, "..."), (None, words(12, 4)), (5, words(30, 3)), (6, "Ünïcode Wörter")]


def test_decontamination(spark, docs):
    rows = [*TEXTS, (20, "a SHORT, item!"), (21, "ünïcode wörter"), (22, "Ünïcode-Wörter")]
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    columns = "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    expected = brute.contamination(rows, ITEMS)
    assert same(decontaminate.report(frame(spark, rows), benchmark), *columns) == expected
    in_blocks = decontaminate.Settings(block_windows=5)
    assert same(decontaminate.report(frame(spark, rows), benchmark, in_blocks), *columns) == expected


def test_decontamination_maps_to_the_original(spark):
    text = "Vor « é: A SHORT,\n\titem! » danach"
    found = decontaminate.matches(frame(spark, [(1, text)]), spark.createDataFrame(ITEMS, "item_id long, text string")).first()
    (span,) = found.hit_spans
    assert text[span.start : span.stop] == "SHORT,\n\titem" and span.words == 2


def test_packing_cases(spark, docs):
    found = same(packing.pack(docs, tokenizer_file()), "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    from test_against_brute_force import check_packing

    check_packing(found, dict(TEXTS))


def test_packing_plan_is_near_the_bound():
    pick = random.Random(9)
    for shift, most in ((0, 1.005), (300, 1.03)):
        histogram = {}
        for _ in range(20_000):
            n = min(2048, 1 + int(pick.expovariate(1 / 500)) + shift)
            histogram[n] = histogram.get(n, 0) + 1
        runs = packing.plan(dict(histogram), packing.Settings())
        used = {}
        for count, lengths in runs:
            assert count > 0 and sum(lengths) <= 2048
            for n in lengths:
                used[n] = used.get(n, 0) + count
        assert used == histogram
        assert sum(c for c, _ in runs) <= most * sum(k * n for k, n in histogram.items()) / 2048 + 1


def test_encoder_gives_the_ids_of_the_file():
    from tokenizers import Tokenizer

    tokenizer, fast = Tokenizer.from_file(tokenizer_file()), packing.encoding(tokenizer_file())
    pick = random.Random(10)
    texts = [t or "" for _, t in TEXTS] + ["<|endoftext|> x", "don't  stop\r\n\r\n  it'll", "\u2028\u00a0 \u3000x\u200b", "١٢٣ ½ Ⅷ"]
    texts += ["".join(chr(pick.choice((pick.randrange(32, 127), pick.randrange(0x20, 0xD800), pick.randrange(0xE000, 0x30000)))) for _ in range(40)) for _ in range(500)]
    for text in texts:
        assert fast.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    for blank in (" ", "\t", "\n", "\u3000"):
        for text in (blank * 49_999 + "x", blank * 50_000 + "x", "a" + blank * 700_000 + "<|endoftext|>", blank * 2_000_000, blank * 2_000_000 + "x"):
            assert fast.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, (blank, len(text))


@pytest.mark.parametrize(
    "change",
    [
        {"normalizer": {"type": "NFC"}},
        {"pre_tokenizer": {"type": "Whitespace"}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}},
        {"model": {"merges": [["h", "e"], ["Ġ", "t"]]}},
        {"model": {"end_of_word_suffix": "</w>"}},
        {"added_tokens": [{"id": 50256, "content": "<x>", "lstrip": True}]},
    ],
)
def test_encoder_refuses_other_files(tmp_path, change):
    import json

    with open(tokenizer_file(), encoding="utf-8") as file:
        whole = json.load(file)
    for key, value in change.items():
        whole[key] = whole[key] | value if key == "model" else value
    (tmp_path / "other.json").write_text(json.dumps(whole))
    with pytest.raises(ValueError):
        packing.encoding(str(tmp_path / "other.json"))


def test_chunks_divide_equal_rows(spark):
    """50,000 rows alike in every column: no chunk of packing or sharding holds many of them."""
    rows = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text")).repartition(8)
    pieces = packing.tokenised(rows, tokenizer_file()).withColumn("row", F.monotonically_increasing_id())
    chunks = [r["count"] for r in packing.chunked(pieces, 1000).groupBy("length", "chunk").count().collect()]
    assert sum(chunks) == 50_000 and max(chunks) < 1300
    found = sharding.shard_documents(rows, sharding.Settings(shards=4, chunk_rows=1000)).collect()
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(found) == 50_000 and all(sorted(x) == list(range(12_500)) for x in slots.values())


def test_added_tokens_are_one_id(spark):
    """Against the file's tokenizer as it is, without encode_special_tokens."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    mark = "<|endoftext|>"
    tokenizer = Tokenizer.from_file(tokenizer_file())
    assert tokenizer.encode(f"a{mark}b", add_special_tokens=False).ids == [64, 50256, 65]
    parts, pick = [mark, "a", " b", "  ", "\n\n", "<|", "|>", "é", "1 "], random.Random(12)
    texts = [mark, f"a{mark}b", f"a  {mark}  b", mark * 3, "".join(f"w{i} {mark} " for i in range(1500))]
    texts += ["".join(pick.choice(parts) for _ in range(12)) for _ in range(200)]
    found = {}
    for r in packing.tokenised(frame(spark, list(enumerate(texts))), tokenizer_file()).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert sum(n for _, n, _ in found[i]) == len(ids), text
        assert all(crc == zlib.crc32(ids[at : at + n].tobytes()) for at, n, crc in found[i]), text


def test_sharding_laws(spark):
    hot = [(i, "hot") for i in range(400)]
    rows = hot + [(400 + i, f"pair {i // 2}") for i in range(200)] + [(1000 + i, f"single {i}") for i in range(500)]
    rows += [(2000 + i, None) for i in range(7)] + [(400, "pair 0"), (None, "x")]
    found = sharding.shard_documents(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(slots) == 40 and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    shards = {}
    for r in found:
        shards.setdefault(dict(rows)[r.doc_id] or "", set()).add(r.shard)
    small = [x for t, x in shards.items() if t.startswith("pair")]
    assert len(small) == 100 and sum(len(x) > 1 for x in small) <= 10


def test_scores_of_hard_texts(docs, spark):
    labels = spark.createDataFrame([(6, 1), (9, 1), (13, 1), (12, 0), (14, 0), (14, None), (2, 0), (None, 1)], "doc_id long, quality int")
    rows = quality.classify(docs, labels).collect()
    assert sorted(r.doc_id for r in rows) == [i for i, _ in TEXTS]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == brute.held_out(r.doc_id) for r in rows)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_languages_of_hard_texts(docs, spark):
    rows = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert {i for i, r in rows.items() if r.lang_pred == "und"} == {1, 2, 3, 14}
    assert all(rows[i].score == 0 for i in (1, 2, 3, 14)) and all(0 <= r.score <= 1 for r in rows.values())
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_profile_does_not_depend_on_blocks(monkeypatch):
    import numpy as np

    whole = language_id.profile(words(300, 3))
    monkeypatch.setattr(language_id.W, "BLOCK", 64)
    assert np.allclose(whole, language_id.profile(words(300, 3)), atol=1e-6)


def test_lm_scores_of_hard_texts(docs):
    settings = lm_scoring.Settings(rounds=1, send_after=100)
    rows = {r.doc_id: r for r in lm_scoring.score(docs, lm_scoring.fit(docs, settings), settings).collect()}
    assert all((rows[i].n_words, rows[i].score, rows[i]["mean"]) == (0, 0.0, None) for i in (1, 2, 3))
    assert all(r.score < 0 for i, r in rows.items() if i > 3) and rows[13].n_words == 20_000


def test_lm_scores_tell_words_of_a_class_apart(spark, docs):
    """Class probability times the word's share of its class; words that the vocabulary lacks share one count more."""
    from collections import Counter
    from math import log

    settings = lm_scoring.Settings(groups=4, chunk_words=300)
    values = lm_scoring.fit(docs, settings)
    weights = lm_scoring.unflat(values, settings)
    others = [(20, "word nonce"), (21, "word word"), (22, None), (None, "alpha1 word")]
    chunks = lm_scoring.chunked(docs, values, settings)
    vocabulary = lm_scoring.vocabulary(chunks)
    counts, totals = Counter(), Counter()
    for _, text in TEXTS:
        found = lm_scoring.word_hashes(text)
        counts.update(found.tolist())
        totals.update(lm_scoring.classes_of(found, settings).tolist())
    assert vocabulary.count() == len(counts) > settings.groups**2 and vocabulary.agg(F.sum("n")).first()[0] == sum(counts.values())
    more = lm_scoring.chunked(frame(spark, others), values, settings)
    for part, texts in ((chunks, TEXTS), (more, others)):
        rows = {r.doc_id: r for r in lm_scoring.score_words(part, vocabulary, settings).collect()}
        assert len(rows) == len(texts)
        for i, text in texts:
            found = lm_scoring.word_hashes(text)
            shares = [log(max(counts[h], 1) / (totals[c] + 1)) for h, c in zip(found.tolist(), lm_scoring.classes_of(found, settings).tolist())]
            expected = float(lm_scoring.log_probabilities(text, weights, settings).sum()) + sum(shares)
            assert rows[i].n_words == len(found) and rows[i].score == pytest.approx(expected, rel=1e-4)
    assert lm_scoring.score_words(lm_scoring.chunked(docs.where("false"), values), vocabulary).count() == 0


def test_lm_answers_follow_their_chunk_over_batches():
    """A chunk's rows come in any order and over batches; a chunk that asked for nothing stays."""
    from collections import defaultdict

    rows = [(4, -7, 2), (4, None, None), (4, 9, 0), (6, None, None), (8, 1, 1), (8, -1, 5), (8, 3, 1), (8, None, None)]
    kinds = {"chunk": pa.int64(), "word": pa.int64(), "n": pa.int64(), "ids": pa.list_(pa.int64()), "n_words": pa.list_(pa.int64())}
    kinds |= {"scores": pa.list_(pa.float64()), "at": pa.binary()}
    held = [(c, w, n, *(([], [], [], None) if w is not None else ([c], [0], [0.0], b"%d" % c))) for c, w, n in rows]
    expected = defaultdict(list)
    for c, w, n in rows:
        expected[c] += [(w, n)] if w is not None else []
    for size in (1, 2, 3, 5, 8):
        parts = [held[at : at + size] for at in range(0, len(held), size)] + [[]]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], kind) for i, kind in enumerate(kinds.values())], [*kinds]) for part in parts]
        found = [(row["ids"].as_py(), row["at"].as_py(), [*zip(words.tolist(), counts.tolist())]) for row, words, counts in lm_scoring._answered(iter(batches))]
        assert found == [([c], b"%d" % c, expected[c]) for c in (4, 6, 8)]
    assert not [*lm_scoring._answered(iter(batches[-1:]))]


def test_lm_scoring_holds_few_chunks_at_a_time(spark):
    """Chunks of one task lie in files of a few, Arrow batches are bounded, and no list gathers the answers of a chunk."""
    from math import log

    import numpy as np

    limits = {"spark.sql.execution.arrow.maxBytesPerBatch": None, "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    try:
        texts = [(i, " ".join(f"w{i * 3 + k}" for k in range(i % 40))) for i in range(300)] + [(300, None), (None, "w1 unseen")]
        settings = lm_scoring.Settings(groups=4, chunk_words=200)
        held = lm_scoring.words_of(frame(spark, texts).coalesce(1), settings)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4m"
        files = [r.n for r in held.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
        assert sum(files) > 3 * lm_scoring._CHUNKS_A_FILE and max(files) <= lm_scoring._CHUNKS_A_FILE
        values = lm_scoring.flat(lm_scoring.drawn(settings), settings).astype(float)
        chunks = lm_scoring.with_scores(held, values, settings, columns=("chunk", "ids", "n_words", "at"))
        assert chunks.columns == ["chunk", "ids", "n_words", "at", "scores"]
        scored = lm_scoring.score_words(chunks, lm_scoring.vocabulary(held), settings, held)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in plan and "MapInArrow" in plan
        rows = {r.doc_id: r for r in scored.collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hashes = {i: lm_scoring.word_hashes(text) for i, text in texts}
    known, counts = np.unique(np.concatenate([*hashes.values()]), return_counts=True)
    of = lm_scoring.classes_of(known, settings)
    share = {int(h): log(n / (counts[of == c].sum() + 1)) for h, n, c in zip(known, counts, of)}
    weights = lm_scoring.unflat(values, settings)
    assert len(rows) == len(texts)
    for i, text in texts:
        expected = float(lm_scoring.log_probabilities(text, weights, settings).sum()) + sum(share[int(h)] for h in hashes[i])
        assert rows[i].n_words == len(hashes[i]) and rows[i].score == pytest.approx(expected, rel=1e-4)


def test_every_word_is_a_target_once():
    settings = lm_scoring.Settings()
    for n in range(40):
        seen = [k for turn in range(settings.rounds) for k in range(n)[lm_scoring.targets(n, turn, settings)]]
        assert sorted(seen) == list(range(n))


PAGES = [
    (1, "u", None),
    (2, None, ""),
    (3, "u", "<script>never closed <p>text</p>"),
    (4, "u", "<article><p>a &amp; b&nbsp;&lt;i&gt; <b>bo</b>ld<br>new<p>two</article><!-- open <p>x</p>"),
    (5, "u", "<nav>menu</nav><main><h1>T</h1><aside>side</aside><p>one</p><form>f<input></form><div class='comments'><p>c c c</p></div></main><footer>foot</footer>"),
    (6, "u", "<article>" + "<p>" + "long " * 50_000 + "</p></article>"),
    (7, "u", "<ul><li><a href='/a'>one</a><li><a href='/b'>two</a></ul><div class='x'><p>" + "word " * 40 + "</p><p>Short.</p><p>" + "more " * 40 + "</p></div><div class='ad'>buy this now</div>"),
]


def test_html(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").select("*", *(F.lit(1).alias(c) for c in ("text_", "place")))
    rows = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert [rows[i].text for i in (1, 2, 3)] == ["", "", ""]
    assert rows[4].text == "a & b <i> bold new two"
    assert rows[5].text == "T one"
    assert rows[6].n_chars == 250_000 - 1
    assert rows[7].text == " ".join(["word"] * 40 + ["Short."] + ["more"] * 40)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_html_keeps_the_whole_article():
    """Names that only hold a word of boilerplate, links as paragraphs, the article's own header; other articles go."""
    a, b, c = words(40, 1), words(40, 2), words(9, 3)
    text = html_text.main_text
    assert text(f"<article><div class='share-price'><p>{a}</p></div><div id='comments-on-law'><p>{b}</p></div></article>") == f"{a} {b}"
    assert text(f"<article><p>{a}</p><p><a href='/x'>{c}</a></p><p>{b}</p></article>") == f"{a} {c} {b}"
    assert text(f"<article><p>{a}</p><p><a href='/x'>{c}</a></p><p><a href='/y'>{c}</a></p></article>") == f"{a} {c} {c}"
    assert text(f"<header>Site</header><article><header><h1>{c}</h1></header><p>{a}</p><footer>end</footer></article>") == f"{c} {a}"
    assert text(f"<article><p>{a}</p></article><article class='teaser'><h2>{c}</h2><p>{b}</p></article>") == a
    boilerplate = "comments", "ad-banner", "related-posts", "sidebar right", "comment-section", "newsletter-signup-form"
    for name in boilerplate:
        assert text(f"<article><p>{a}</p><div class='{name}'><p>{b}</p></div><p>{c}</p></article>") == f"{a} {c}", name
    for name in ("has-sidebar", "no-comments", "price-alerts-explained", "commentary"):
        assert text(f"<article class='{name}'><div class='{name}'><p>{a}</p></div></article>") == a, name
    assert text(f"<article><ul><li><a href='/a'>x</a><li><a href='/b'>y</a><li><a href='/c'>z</a></ul><p>{a}</p></article>") == a


def test_html_of_deep_pages_is_read_once():
    import time

    started = time.process_time()
    for page in ("<div>" * 200_000 + "x" + "</p>" * 200_000, "<div class='x y'>" * 200_000 + "</b></div>" * 100_000, "<p>" * 200_000 + "</section>" * 200_000):
        html_text.main_text(page)
    assert time.process_time() - started < 20  # quadratic reading takes minutes


def test_tree_fits_its_table():
    import numpy as np

    table = np.array(html_text.LABELLED, float)
    assert (html_text.tree().predict(table[:, :-1]) == table[:, -1]).mean() >= 0.95
    assert html.unescape("&amp") == "&"


def test_empty_tables(spark, docs):
    none = frame(spark, TEXTS).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for empty in (
        exact_dedup.exact_groups(none),
        suffix_dedup.remove_repeats(none),
        near_dedup.classes(none),
        decontaminate.report(none, benchmark),
        packing.pack(none, tokenizer_file()),
        sharding.shard_documents(none),
        quality.classify(none, labels),
        language_id.identify(none),
        lm_scoring.score(none, lm_scoring.fit(none)),
    ):
        assert empty.count() == 0
    assert not any(r.contaminated for r in decontaminate.report(docs, benchmark).collect())


def test_pipeline_stages(spark, twice, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = frame(spark, [*TEXTS, *TEXTS[3:9], (20, "xx " + words(30, 3))])
    docs = texts
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == texts.columns, name
        path = f"{tmp_path}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    # no letter: 1, 2, 3, 14; copies of 4 and 6; near copy of 6; 9, 10 and 20 hold benchmark windows
    assert sorted(r.doc_id for r in docs.collect()) == [4, 6, 11, 12, 13, 15]
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()} == {4, 6, 11, 12, 13, 15}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, texts.where("false"), str(tmp_path)).count() == 0


def test_pipeline_sends_texts_once_and_in_small_batches(spark, tmp_path, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, [(i, words(40, i) + " x" * 25_000) for i in range(400)]).repartition(1)
    given = []
    for module, name in ((language_id, "predict"), (decontaminate, "matches")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda d, *a, plain=plain, **b: (given.append(d), plain(d, *a, **b))[1])

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": [batch.nbytes]})

    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        stage(spark, docs, str(tmp_path))
        assert max(r.doc_id for r in docs.mapInArrow(sizes, "doc_id long").collect()) < 5 << 20
    assert [d.columns for d in given] == [["row", "text"]] * 2
    assert not any("text" in d.schema["row"].dataType.names for d in given)
    # a size of the session's own stays
    spark.conf.set(key, "8m")
    corpus_pipeline.pack_sequences(spark, docs, "")
    assert spark.conf.get(key) == "8m"
    spark.conf.unset(key)


def test_batches_are_joined_for_several_automata():
    parts = [pa.RecordBatch.from_pydict({"x": ["ab"] * n}) for n in (3, 2, 4, 1)]
    assert [b.num_rows for b in decontaminate._together(iter(parts), 5, 1 << 20)] == [5, 5]
    assert [b.num_rows for b in decontaminate._together(iter(parts), 99, 1)] == [3, 2, 4, 1]
    assert list(decontaminate._together(iter(()), 5, 1)) == []


def test_pipeline_stages_tell_rows_apart(spark):
    """Rows without an id, and different texts of one id, through both stages of copies."""
    rows = [(None, words(40, 100 + i)) for i in range(6)]
    rows += [(5, words(60, 200)), (5, words(60, 201)), (3, words(60, 201)), (7, words(60, 202)), (7, words(60, 203)), (7, words(60, 203))]
    rows += [(None, words(80, 300)), (None, words(80, 300)), (None, edited(words(80, 300), 1, 1)), (9, edited(words(80, 300), 1, 2))]
    rows += [(11, words(80, 400)), (11, edited(words(80, 400), 1, 3)), (None, edited(words(80, 500), 1, 4)), (None, words(80, 500))]
    least = {}
    for i, text in rows:
        least[text] = min((x for x in (i, least.get(text)) if x is not None), default=None)
    kept = same(corpus_pipeline.drop_copies(spark, frame(spark, rows), ""), "doc_id", "text")
    assert kept == sorted(((i, text) for text, i in least.items()), key=repr)
    # one row of each class; its id is the smallest
    kept.sort(key=lambda x: (x[0] is None, x[0]))
    classes = {}
    for at, _, root, _ in brute.near([(at, text) for at, (_, text) in enumerate(kept)]):
        classes.setdefault(root, set()).add(kept[at])
    for texts in (kept, rows):
        found = same(corpus_pipeline.drop_near_copies(spark, frame(spark, texts).repartition(3), ""), "doc_id", "text")
        assert len(found) == len(classes) < len(kept)
        assert all(len(x & set(found)) == 1 for x in classes.values())
        assert sorted(str(i) for i, _ in found) == sorted(str(kept[root][0]) for root in classes)


def test_row_keys_are_checked(spark):
    docs = frame(spark, [(1, "a"), (1, "b"), (None, "a"), (1, None), (None, None), (1, "a")])
    weak = lambda seed, *parts: F.when(seed == 0, F.lit(0)).otherwise(F.xxhash64(seed, *parts))
    assert docs.select(corpus_pipeline._row_key(docs, weak)).distinct().count() == 5


def test_sharding_writes_three_tables_a_round(spark, monkeypatch):
    written, materialize = [], sharding.materialize
    monkeypatch.setattr(sharding, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    linked = spark.range(40).selectExpr("concat('t', id div 4) AS text_key", "id AS seed", "CAST(id % 2 AS int) AS shard")
    moved = sharding.propagate(linked, {0: 20, 1: 20}, sharding.Settings(shards=2, rounds=1))
    assert written == ["sized", "asked", "moved"] and moved.count() == 40
