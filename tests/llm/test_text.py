"""Line, passage and near-duplicate removal against brute force, on edges and test rows."""

import random

import pytest
from pyspark.sql import functions as F

from hourloom.llm import line_dedup, near_dup, substring_dedup
from tests.llm import brute

ROWS = brute.edge_texts()


def line_rows(frame):
    rows = frame.select("doc_id", "n_lines", "n_dropped", F.coalesce("text", F.lit("")).alias("t")).collect()
    return brute.bag(rows)


def test_lines(spark, documents):
    assert line_rows(line_dedup.dedup_lines(brute.edge_frame(spark))) == brute.bag(brute.cut_lines(ROWS))
    assert line_rows(line_dedup.dedup_lines(documents[0])) == brute.bag(brute.cut_lines(documents[1]))


def test_lines_keep_other_columns(spark):
    cut = line_dedup.dedup_lines(brute.edge_frame(spark))
    assert set(cut.columns) == set(brute.edge_frame(spark).columns) | {"n_dropped"}
    assert {r.source for r in cut.collect()} == {r[3] for r in brute.EDGES}


def span_rows(frame):
    return brute.bag(frame.select("doc_id", "n_words", "n_removed", "kept").collect())


def test_substrings(spark, documents):
    assert span_rows(substring_dedup.dedup_substrings(brute.edge_frame(spark))) == brute.bag(brute.cut_substrings(ROWS))
    assert span_rows(substring_dedup.dedup_substrings(documents[0])) == brute.bag(brute.cut_substrings(documents[1]))


def passages(n=120, seed=5):
    """Documents with quotations of one another, in parts and with seams."""
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(40)]
    stock = [" ".join(rng.choices(vocabulary, k=rng.randint(10, 50))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            text = rng.choice(stock).split()
            a = rng.randint(0, len(text) - 1)
            parts.append(" ".join(text[a : a + rng.randint(8, 40)]) if rng.random() < 0.7 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 30))))
        rows.append((i * 7 % 1000, rng.choice([" ", "\n", "  "]).join(parts), "en", "s", 1))
    return rows


@pytest.mark.parametrize("chunk_bytes", [6_000_000, 3_000])
def test_substrings_in_parts(spark, monkeypatch, chunk_bytes):
    """The same with meetings in one chunk and in many."""
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", chunk_bytes)
    rows = passages()
    got = substring_dedup.dedup_substrings(spark.createDataFrame(rows, brute.SCHEMA))
    assert span_rows(got) == brute.bag(brute.cut_substrings([r[:2] for r in rows]))


def test_substrings_of_rows_that_repeat(spark, monkeypatch):
    """Thousands of equal rows under one id are judged once; versions of an id stay apart."""
    text = " ".join(f"q{k}" for k in range(203))
    rows = [(7, text, "en", "s", 1)] * 5000 + [(9, f"start {text} end", "en", "s", 1)] * 700 + [(3, " ".join(text.split()[50:90]), "en", "s", 1)]
    rows += [(9, f"other {text}", "en", "s", 1), (9, None, "en", "s", 1), (9, None, "en", "s", 1), (None, text, "en", "s", 1), (None, text, "en", "s", 1), (11, text, "en", "s", 1)]
    assert span_rows(substring_dedup.dedup_substrings(spark.createDataFrame(rows, brute.SCHEMA))) == brute.bag(brute.cut_substrings([r[:2] for r in rows]))


@pytest.mark.parametrize("characters", [1_100_000, 5])
def test_words_that_share_a_character(spark, monkeypatch, characters):
    """More words than characters: a match is held against the words."""
    import pyarrow as pa

    monkeypatch.setattr(substring_dedup, "CHARACTERS", characters)
    texts = [f"{chr(97 + i)} " + " ".join(f"w{(i % 3) * 100 + k}" for k in range(30)) for i in range(9)]
    docs = pa.table({"doc_id": list(range(9)), "version": list(range(9)), "start": [0] * 9, "text": texts})
    spans = substring_dedup.covered_spans(13)(docs, pa.table({"window": pa.array([], pa.int64()), "low": pa.array([], pa.int64())}))
    assert sorted(spans.to_pylist(), key=str) == [{"doc_id": i, "version": i, "lo": 1, "hi": 31} for i in range(3, 9)]


def near_rows(frame):
    return brute.bag(frame.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("threshold", [80, 85])
def test_near(spark, documents, threshold):
    assert near_rows(near_dup.near_duplicates(brute.edge_frame(spark), threshold)) == brute.bag(brute.near(ROWS, threshold))
    assert near_rows(near_dup.near_duplicates(documents[0], threshold)) == brute.bag(brute.near(documents[1], threshold))


def variants(n=150, seed=9):
    """A group whose members lie on both sides of the threshold, and chains."""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(90)]
    rows, text = [], list(base)
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"e{i}x{rng.random()}"
        if i % 3 == 0:
            text = text[1:] + [f"c{i}"]
            copy = list(text)
        rows.append((1000 - i, " ".join(copy), "en", "s", 1))
    return rows


@pytest.mark.parametrize("chunk_docs", [1024, 16])
def test_near_groups(spark, monkeypatch, chunk_docs):
    monkeypatch.setattr(near_dup, "CHUNK_DOCS", chunk_docs)
    rows = variants()
    got = near_dup.near_duplicates(spark.createDataFrame(rows, brute.SCHEMA), 85)
    assert near_rows(got) == brute.bag(brute.near([r[:2] for r in rows], 85))


def test_components_of_long_paths(spark):
    path = list(range(200))
    random.Random(3).shuffle(path)
    links = spark.createDataFrame(list(zip(path, path[1:])) + [(500, 500), (900, 901)], "a long, b long")
    got = {r.node: r.component for r in near_dup.components(links).collect()}
    assert got == {k: 0 for k in range(200)} | {900: 900, 901: 900}


def test_least_overlap_holds_the_tail():
    assert near_dup.least_overlap(85) >= 7 and near_dup.least_overlap(80) >= 5
    assert near_dup.least_overlap(100) == near_dup.SKETCH


def test_empty_tables(spark):
    none = spark.createDataFrame([], brute.SCHEMA)
    assert line_dedup.dedup_lines(none).count() == 0
    assert substring_dedup.dedup_substrings(none).count() == 0
    assert near_dup.near_duplicates(none).count() == 0
    assert near_dup.one_of_each(none).count() == 0
