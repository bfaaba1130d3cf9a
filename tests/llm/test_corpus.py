"""Mixing, packing, fingerprints, selection, search, URLs and chats."""

import math
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hourloom.llm import chat, fingerprint, mixing, packing, quality, topk, url_filter
from hourloom.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.conftest import SMALL


def check_mix(rows, texts):
    sizes = defaultdict(int)
    want = sorted((i, len(brute.words(t)), s) for i, t, s in texts) if all(i is not None for i, _, _ in texts) else None
    for _, t, s in texts:
        sizes[s] += len(brute.words(t))
    targets, taken = brute.targets(sizes), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, float(targets[r.source]), abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    assert sum(r.size for r in rows) == sum(sizes.values()) and len(rows) == len(texts)
    if want:
        assert sorted((r.doc_id, r.size, r.source) for r in rows) == want


@pytest.mark.parametrize("ranges", [1, 4, 4096])
def test_mix(spark, documents, ranges):
    edge = brute.edge_frame(spark)
    check_mix(mixing.mix(edge, ranges=ranges).collect(), [(r[0], r[1], r[3]) for r in brute.EDGES])
    texts = [(r.doc_id, r.text, r.source) for r in documents[0].collect()]
    rows = mixing.mix(documents[0], ranges=ranges, keep=("doc_id", "source")).collect()
    check_mix(rows, texts)
    again = mixing.mix(documents[0].repartition(7), ranges=ranges, keep=("doc_id", "source")).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mixed_documents_hold_the_words_taken(spark, documents):
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(documents[0]).collect()}
    held = defaultdict(int)
    whole = dict(documents[1])
    for r in mixing.mixed_documents(documents[0]).collect():
        held[r.doc_id] += len(brute.words(r.text))
        assert whole[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert {i: t for i, (t, _) in taken.items() if t} == dict(held)
    none = spark.createDataFrame([], brute.SCHEMA)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=9))
def test_filling_by_hand(sizes):
    total = brute.targets(dict(enumerate(sizes)))
    assert sum(total.values()) == sum(sizes) * 3 / 2 and all(total[k] <= 2 * n for k, n in enumerate(sizes))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_pack(rows, texts, tokenizer):
    whole = defaultdict(list)
    for i, text in texts:
        whole[i].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    want = brute.bag((i, len(d)) for i, docs in whole.items() for d in docs)
    assert brute.bag((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == want
    sequences = defaultdict(list)
    covered = defaultdict(int)
    for r in rows:
        cuts = [zlib.crc32(d[r.start : r.start + r.length].tobytes()) for d in whole[r.doc_id] if len(d) == r.doc_tokens]
        assert r.ids_crc32 in cuts
        covered[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length, r.sequence_length))
    assert covered == {i: sum(map(len, docs)) for i, docs in whole.items()}
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and {p[2] for p in parts} == {at if at & (at - 1) == 0 else 2048}
        padding += parts[0][2] - at
    return padding / sum(covered.values())


def test_pack(spark, documents, tokenizer):
    check_pack(packing.pack(brute.edge_frame(spark)).collect(), brute.edge_texts(), tokenizer)
    assert check_pack(packing.pack(documents[0]).collect(), documents[1], tokenizer) < 0.02
    rows = packing.pack(documents[0], with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert packing.pack(spark.createDataFrame([], brute.SCHEMA)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r'sStT.,!1é漢\u00a0\u2003\x1c\x85"), st.characters(codec="utf-8")), max_size=40))
def test_ids_are_the_tokenizers(tokenizer, text):
    ids = np.frombuffer(packing.chunk_ids(packing.vocabulary_path()).of_text(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


ADDED = ["<|endoftext|>", "a<|endoftext|>b", " <|endoftext|>  x", "<|endoftext|><|endoftext|>\n\n<|endoftext", "<|endoftext|>'s ok"]


def test_added_tokens_are_the_tokenizers(spark, tokenizer):
    memory, added = packing.chunk_ids(packing.vocabulary_path()), packing.added_tokens()
    for text in ADDED:
        assert np.frombuffer(memory.of_document(text, added), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    rows = [(k, t, "en", "a", 1) for k, t in enumerate(ADDED)]
    check_pack(packing.pack(spark.createDataFrame(rows, brute.SCHEMA)).collect(), [r[:2] for r in rows], tokenizer)
    plain = packing.pack(spark.createDataFrame(rows, brute.SCHEMA), added={}).collect()
    assert all(r.doc_tokens > 3 for r in plain)


def test_memory_keeps_two_generations(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    memory = packing.ChunkIds(packing.vocabulary_path())
    text = " ".join(f"w{k % 7}" for k in range(50))
    assert memory.of_text(text) == memory.encoded(text) and len(memory) <= 3 and len(memory.older) <= 3


def test_equal_pieces_are_dealt_to_many_shards(spark, tokenizer):
    rows = [(5, "same words again", "en", "a", 1)] * 600 + [(None, "no id", "en", "a", 1)] * 300 + [(k, f"own {k}", "en", "a", 1) for k in range(100, 200)]
    frame = spark.createDataFrame(rows, brute.SCHEMA)
    check_pack(packing.pack(frame).collect(), [r[:2] for r in rows], tokenizer)
    pieces = packing.stored(spark.range(20_000).selectExpr("5L AS doc_id", "0L AS start", "9L AS ids_crc32"))
    sizes = [r["count"] for r in packing.shard_numbers(pieces, 10).groupBy("shard").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2400


def test_best_fit_takes_the_tightest_window():
    window, offset = packing.best_fit(np.array([5, 8, 3, 2, 2]), 10)
    assert window.tolist()[:3] == [1, 0, 1] and offset.tolist() == [0, 0, 5, 8, 8]
    rng = random.Random(1)
    lengths = np.array([rng.randint(1, 100) for _ in range(500)])
    window, offset = packing.best_fit(lengths, 100)
    open_, at = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        fits = [w for w, room in enumerate(open_) if room >= lengths[i]]
        tightest = min((open_[w] for w in fits), default=100)
        at[i] = 100 - tightest
        if fits:
            open_[window[i]] -= lengths[i]
        else:
            open_.append(100 - lengths[i])
    assert [at[i] for i in range(500)] == offset.tolist()


def plain_marks(text, gram, window):
    points = fingerprint.code_points(text.encode())
    if not text:
        return []
    g = [int(fingerprint.rolling(points[k : k + min(gram, len(text))], min(gram, len(text)))[0] >> np.uint64(32)) for k in range(max(1, len(text) - gram + 1))]
    w = min(window, len(g))
    return sorted({min(range(k, k + w), key=lambda i: (g[i], -i)) for k in range(len(g) - w + 1)}), g


@settings(max_examples=60, deadline=None)
@given(st.text("abé漢", max_size=60), st.integers(1, 7), st.integers(1, 6))
def test_winnowing_by_hand(text, gram, window):
    marks, at = fingerprint.winnow(fingerprint.code_points(text.encode()), gram, window)
    if text:
        want, grams = plain_marks(text, gram, window)
        assert at.tolist() == want and marks.tolist() == [grams[i] for i in want]
    else:
        assert not len(at)


def check_fingerprints(rows, texts):
    order = sorted((t for t in texts if t[0] is not None), key=lambda t: -t[0])
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for k, (i, text) in enumerate(order):
        text, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + nxt[:n]
        r = got[i]
        marks = [fingerprint.winnow(fingerprint.code_points(t.encode()))[0] for t in (text, edited, nxt)]
        assert r.n_chars == len(text) and r.edited_sha256 == brute.sha(edited)
        assert r.fingerprint == fingerprint.written(marks[0]) and r.edited_fingerprint == fingerprint.written(marks[1])
        assert math.isclose(r.near_edited, fingerprint.likeness(marks[0], marks[1]))
        assert math.isclose(r.near_next, fingerprint.likeness(marks[0], marks[2]))


def test_fingerprints(spark, documents):
    check_fingerprints(fingerprint.compare_with_edits(documents[0]).collect(), documents[1])
    unique = {r[0]: r for r in brute.EDGES if r[0] is not None}
    edges = brute.edge_frame(spark, list(unique.values()))
    check_fingerprints(fingerprint.compare_with_edits(edges).collect(), [r[:2] for r in unique.values()])
    assert fingerprint.compare_with_edits(brute.edge_frame(spark)).count() == len(brute.EDGES)
    one = spark.createDataFrame([(5, "abcdefghi", "en", "s", 9)], brute.SCHEMA)
    assert fingerprint.compare_with_edits(one).first().edited_sha256 == brute.sha("abcdefabc")
    assert fingerprint.compare_with_edits(one.where("false")).count() == 0
    marks = fingerprint.fingerprints(brute.edge_frame(spark)).collect()
    assert len(marks) == len(brute.EDGES) and all(len(r.hashes) == len(r.positions) for r in marks)


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 4 <> 0")
    scored = quality.classify(docs, train).join(quality.graded(labels.where("doc_id % 4 = 0")), "doc_id").collect()
    good = [r for r in scored if r.grade == 2]
    bad = [r for r in scored if r.grade < 2]
    assert sum(r.selected for r in good) >= 0.98 * len(good)
    assert sum(not r.selected for r in bad) >= 0.95 * len(bad)
    by_grade = [np.mean([r.expected_grade for r in scored if r.grade == g]) for g in range(3)]
    assert by_grade == sorted(by_grade)


def plain_loss(weights, thresholds, rows, grades, emphasis):
    """The objective, written out document by document."""
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    total = 0.0
    for row, grade, weight in zip(rows, grades, emphasis):
        score = sum(weights[b] for b in row)
        at_least = [1.0, *(sigmoid(score - t) for t in thresholds), 0.0]
        total -= weight * math.log(at_least[grade] - at_least[grade + 1])
    return total / len(rows) + quality.DECAY / 2 * sum(w * w for w in weights)


def test_fit_is_the_least_of_the_written_out_likelihood(monkeypatch):
    """Against a slow search: no feasible change of one weight or threshold makes it better,
    if the fit goes on until nothing is won."""
    monkeypatch.setattr(quality, "LEAST_GAIN", 1e-9)
    rng = np.random.default_rng(4)
    dimensions, n = 128, 240
    grades = rng.integers(0, 3, n)
    rows = [np.unique(np.concatenate([rng.integers(0, 6, 1) + 8 * g * (rng.random() < 0.7), rng.integers(30, 34, 2), 64 + rng.integers(0, 3, 1) + 3 * (g == 2)])) for g in grades]
    weights, thresholds = quality.fit_ordinal(rows, grades, dimensions, 3)
    assert thresholds[0] < thresholds[1] and (weights[: dimensions - quality.SHAPE] <= 0).all() and np.count_nonzero(weights) > 5
    share = np.bincount(grades) / n
    emphasis = 1 / (share[grades] * 3)
    best = plain_loss(weights, thresholds, rows, grades, emphasis)
    assert math.isclose(best, quality.Ordinal(np.concatenate(rows), np.repeat(np.arange(n), [len(r) for r in rows]), grades, emphasis, dimensions).at(
        np.concatenate([weights / quality.Ordinal(np.concatenate(rows), np.repeat(np.arange(n), [len(r) for r in rows]), grades, emphasis, dimensions).scale, thresholds]))[0], rel_tol=1e-9)
    for bucket in np.flatnonzero(weights):
        for change in (-0.05, 0.05):
            moved = weights.copy()
            moved[bucket] += change
            if bucket >= dimensions - quality.SHAPE or moved[bucket] <= 0:
                assert plain_loss(moved, thresholds, rows, grades, emphasis) >= best - 1e-5
    for k in range(2):
        for change in (-0.05, 0.05):
            moved = thresholds.copy()
            moved[k] += change
            assert plain_loss(weights, moved, rows, grades, emphasis) >= best - 1e-5


def many_rows(n, told, dimensions):
    """Rows of three grades; a bucket of ``told`` is there more often in one of the grades."""
    rng = np.random.default_rng(5)
    grades = rng.integers(0, 3, n)
    chance = np.where(np.arange(told) % 3 == np.arange(3)[:, None], 0.2, 0.1)
    rows = [np.flatnonzero(rng.random(told) < chance[g]).astype(np.int32) for g in grades]
    return [np.append(r, np.int32(dimensions - 1 - g)) if r.size else r for r, g in zip(rows, grades)], grades


def test_fit_in_blocks_is_the_fit_at_once(monkeypatch):
    """Also where blocks are shorter than a row or a bucket, and where rows are empty or lose all."""
    rows, grades = many_rows(1200, 40, 256)
    rows[0], rows[7], rows[-1] = rows[0][:0], np.array([150], np.int32), rows[0][:0]
    whole = quality.fit_ordinal(rows, grades, 256, 3)
    flat, row_of = np.concatenate(rows), np.repeat(np.arange(1200), [len(r) for r in rows])
    point = np.append(np.linspace(-1, 0.5, 256), [-0.5, 0.5])
    value, slope = quality.Ordinal(flat, row_of, grades, np.ones(1200), 256).at(point)
    assert np.count_nonzero(whole[0]) > 10
    for block in (5, 64, 3000):
        monkeypatch.setattr(quality, "BLOCK", block)
        part = quality.fit_ordinal(rows, grades, 256, 3)
        assert (part[0] == whole[0]).all() and (part[1] == whole[1]).all()
        objective = quality.Ordinal(flat, row_of, grades, np.ones(1200), 256)
        assert (objective.row_of == row_of[np.argsort(flat, kind="stable")]).all()
        again = objective.at(point)
        assert again[0] == value and (again[1] == slope).all()


def test_fit_holds_little_beside_its_entries(monkeypatch):
    """It runs in one task, beside what the worker holds from others."""
    monkeypatch.setattr(quality, "STEPS", 2)
    rows, grades = many_rows(4000, 4000, 8192)
    entries = sum(map(len, rows))
    tracemalloc.start()
    weights, _ = quality.fit_ordinal(rows, grades, 8192, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert entries > 2_000_000 and np.count_nonzero(weights) > 1000
    # Bucket and row, the rows in the order of buckets, and blocks.
    assert peak < 8 * entries + 16e6, f"{peak / entries:.0f} bytes an entry"


def test_classifier_edges(spark):
    edge = brute.edge_frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.classify(edge, none).collect()
    assert len(rows) == len(brute.EDGES) and all(r.selected and r.tail_probability is None for r in rows)
    odd = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, None, 0), (None, 1, 1), (6, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in quality.graded(odd).collect()} == {0: 0, 6: 1, 8: 2}
    rows = quality.classify(edge, odd).collect()
    assert len(rows) == len(brute.EDGES) and all(0 <= r.tail_probability <= 1 for r in rows)
    assert quality.classify(edge.where("false"), odd).count() == 0


def test_classifier_fits_one_row_of_an_id(spark):
    docs = spark.createDataFrame([(i, f"{'fine' if i % 2 else 'awful'} text {i}", i % 2 * 2) for i in range(80)], "doc_id long, text string, grade int")
    once, often = (quality.fitted(d, 4096, 3) for d in (docs, docs.unionAll(docs.where("doc_id = 4")).unionAll(docs)))
    assert all((a == b).all() for a, b in zip(once, often)) and once[0].any()


def test_classifier_fits_whole_feature_sets(spark):
    """Of long documents too: the model is that of all buckets, and shape steps are among them."""
    filler = " ".join(f"w{k}q{k * 7 % 1009}" for k in range(3000))
    told = lambda i: " ".join(f"{'fine' if i % 2 else 'b'}{k}" for k in range(40))
    rows = [(i, f"{filler} {told(i)} {'| ' * (0 if i % 2 else 3000)}", i % 2 * 2) for i in range(60)]
    memory = quality.WordHashes()
    sets = [quality.text_features(t.encode(), memory, 1 << 14) for _, t, _ in rows]
    assert min(map(len, sets)) > 2000
    weights, thresholds = quality.fit_ordinal(sets, np.array([g for _, _, g in rows]), 1 << 14, 3)
    model = quality.fitted(spark.createDataFrame(rows, "doc_id long, text string, grade int").repartition(3), 1 << 14, 3)
    assert (model[0] == weights.astype(np.float32)).all() and (model[1] == thresholds).all()
    assert model[0][-quality.SHAPE :].any() and np.count_nonzero(model[0]) > 40


VECTORS = [(0, [1.0, -2.5]), (50, [0.5, 0.25]), (100, None), (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0]), (3, [0.5, 0.25]), (4, [0.5, 0.25]), (5, [0.5]), (150, [2.0]), (11, []), (200, []), (12, [1e9, -1e9]), (13, [1e15, 1e15])]


def test_top_k(spark):
    frame = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>").withColumns({"dim": F.lit(0), "qb": F.lit("x")})
    got = sorted(map(tuple, topk.top_k(frame).collect()))
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in VECTORS]
    assert got == brute.top(exact, 50, 5)
    assert topk.top_k(frame.where("false")).count() == 0
    doubled = topk.top_k(frame.unionAll(frame))
    assert sorted(map(tuple, doubled.collect())) == brute.top(exact + exact, 50, 5)


def test_top_k_of_rows_that_share_an_id(spark):
    rows = [(50, [1.0, 2.0]), (50, [3.0, -1.0]), (7, [1.0, 1.0]), (7, [2.0, 2.0]), (7, [2.0, 2.0]), (8, [2.0, 2.0]), (9, [-5.0, 0.5]), *[(100, [0.5, 0.5])] * 40]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(frame).collect())) == brute.top(rows, 50, 5)


@pytest.mark.parametrize("scale", [1, 1e5, 1e15])
def test_threshold_leaves_few_entries_and_loses_none(scale):
    # Clustered vectors: a query's cluster is far ahead of the rest.
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 32))
    vectors = np.floor(256 * scale * (centres[np.arange(400) % 40] + 0.05 * rng.normal(size=(400, 32))))
    block = topk.LocalLists(vectors[:20], vectors, topk.LISTS)
    own = np.arange(20)[:, None] == np.arange(400)[None, :]
    exact = np.array([[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(a, b)))) for b in vectors] for a in vectors[:20]])
    rows, at = block.heads(own, 5)
    score = block.resolved(rows, at)
    assert (score == exact[rows, at]).all() and len(rows) <= 20 * topk.LISTS * 5 and not own[rows, at].any()
    cutoff = np.array([np.sort(score[rows == r])[-5] for r in range(20)])
    over = block.over(cutoff)
    assert over[exact >= cutoff[:, None]].all()
    assert over.sum() < (1 if scale == 1e15 else 0.25) * over.size


@pytest.mark.parametrize("block", [2048, 37])
def test_top_k_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 9)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(frame, every=20).collect())) == brute.top(rows, 20, 5)


URLS = [None, "", "no scheme/net/", "http://a.NET", "http://a.net/", "https://www.example.net/en/x?y", "http://example.net/EN/", "http://notexample.net/en/", "x://Example.COM/de/?a#b", "x://example.com/de", "http://f.org/fr/1", "http://f.org#/fr/", "http://f.org?u=http://a.net/", "http:///net/", "http://net/a\nb", "http://net./", "http://É.net/é"]


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:k].translate(brute.FOLD), rest[k:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, "allow")


@pytest.mark.parametrize("blocks", [1, 1 << 16])
def test_urls(spark, blocks):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.net", "", "allow"), ("F.org", "/f", "block")]
    lists = spark.createDataFrame([*rules, (None, "/", "block"), ("net", "/", "allow"), ("", "/", "block"), ("x", "/", "?")], "host string, path string, action string")
    pages = spark.createDataFrame([(k, u, "h", "v") for k, u in enumerate(URLS + URLS)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, lists, blocks=blocks).collect()}
    lowered = [(h.translate(brute.FOLD), p, a) for h, p, a in rules]
    assert got == {k: plain_verdict(u, lowered) for k, u in enumerate(URLS + URLS)}
    assert url_filter.filter_urls(pages, lists.where("false")).where("verdict = 'allow'").count() == len(got)
    assert url_filter.filter_urls(pages.where("false"), lists).count() == 0


def test_filter_passes_every_key_and_few_others(spark):
    keys = spark.range(20_000).selectExpr("concat('host', id, '.net/') AS key")
    bloom = url_filter.bloom_filter(keys, 1 << 13)
    assert bloom.count() <= 1 << 13
    mask = url_filter.probe_mask(F.col("key"), url_filter.PROBES)
    probe = lambda k: k.withColumn("block", url_filter.block_of(F.col("key"), 1 << 13)).join(bloom, "block").where(F.col("bits").bitwiseAND(mask) == mask).count()
    assert probe(keys) == 20_000
    assert probe(spark.range(20_000).selectExpr("concat('other', id, '.org/') AS key")) < 2_000


TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (3, 1, "assistant", "yes"), (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (4, 2, "user", None), (5, 0, None, ""), (6, None, "user", "first"), (6, 0, "user", "hi"), (None, 0, "user", "lost"), (7, 5, "user", "hi"), (7, 9, "assistant", "no")]


def test_chats(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("step", F.lit("x")).withColumn("h1", F.lit(0))
    got = {r.conv_id: (r.n_turns, r.n_snapshots, r.rendered) for r in chat.format_chats(frame).collect()}
    said = lambda *t: "".join(f"<|{r}|>\n{x}\n<|end|>\n" for r, x in t)
    assert got == {
        1: (2, 2, said(("user", "hi"), ("assistant", "yes"))),
        4: (3, 1, said(("user", "hi"), ("assistant", "no"), ("user", ""))),
        5: (1, 1, said(("", ""))),
        6: (2, 1, said(("user", "first"), ("user", "hi"))),
    }
    assert chat.format_chats(frame.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    rows = con.execute(ORACLES[name])
    columns = [d[0] for d in rows.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert brute.bag(got.select(columns).collect()) == brute.bag(rows.fetchall())
