"""Every stage of the pipeline against brute force on what the stage before kept."""

from collections import Counter, defaultdict

import corpus_pipeline
from hourloom.llm import near_dup
from hourloom.llm.common import stored
from hourloom.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import SMALL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def selects_well(spark, folder, after, most_bad):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    good = {i for i, r in labels.items() if r.quality == 1 and r.toxic == 0}
    here, bad = {i for i, _ in after}, set(labels) - good
    return len(good & here) >= 0.97 * len(good) and len(here & bad) <= most_bad * len(bad)


def test_quality_stage(spark):
    """With some thousand labels; the smallest table has 20 of bad documents to learn from."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["quality"](spark, docs, folder)
    assert selects_well(spark, folder, kept.select("doc_id", "text").collect(), most_bad=0.1)


def test_stages(spark, documents):
    docs, kept = documents[0], {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = stored(stage(spark, docs, SMALL), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == COLUMNS
        after = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] if name != "packing" else []
        if name == "quality":
            assert set(after) < set(before) and selects_well(spark, SMALL, after, most_bad=0.25)
        if name == "line_dedup":
            want = [(i, t) for i, _, n, t in brute.cut_lines(before) if not (n and not t.strip(" \t\n\x0b\x0c\r"))]
            assert brute.bag(after) == brute.bag(want)
        if name == "near_dup":
            want = {i for i, _, _, k in brute.near(before, 80) if k}
            assert brute.bag(after) == brute.bag(x for x in before if x[0] in want)
        if name == "mixing":
            words = lambda rows: sum(len(brute.words(t)) for _, t in rows)
            assert abs(words(after) - 1.5 * words(before)) <= 20
        if name == "packing":
            at = defaultdict(int)
            for r in docs.collect():
                at[r.doc_id] += r.length
            assert set(at) == {i for i, _ in before}


def test_documents_left_blank_go(spark):
    line = "A line that Many documents repeat word for word"
    rows = [(k, f"{line}\n\t\n", "en", "a", 1) for k in range(5)] + [(9, "\n \n", "en", "a", 1), (10, None, "en", "a", 1)]
    cut = dict(corpus_pipeline.STAGES)["line_dedup"](spark, spark.createDataFrame(rows, brute.SCHEMA), SMALL)
    assert sorted(r.doc_id for r in cut.collect()) == [4, 9, 10]


def test_run_is_the_stages(spark):
    rows = QUERIES["pipeline"](spark, SMALL)
    assert rows.count() > 0 and "ids" in rows.columns


def test_stages_on_edges(spark):
    docs = brute.edge_frame(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL))
    assert docs.count() > 0


def test_near_dup_stage_leaves_one_row_of_each_group(spark):
    """Repeated rows, near and other versions of one id, and copies without an id."""
    old = "words that near versions of one document share " * 3 + " ".join(f"n{k}" for k in range(80))
    more = [(30, old, "en", "a", 1), (30, old + " end", "en", "a", 1), (30, "", "en", "a", 0), (31, old, "en", "a", 1), (31, old, "en", "a", 1)]
    more += [(32, None, "en", "a", 0), (32, "", "en", "a", 0), (33, "another text of one id", "en", "a", 1), (33, "a version of it that is not alike", "en", "a", 1)]
    more += [(None, "a text WITHOUT an id here", "en", "b", 1), (None, "a text without an  id here", "en", "a", 1), (None, "", "en", "a", 0), (None, "", "en", "a", 0)]
    rows = brute.EDGES + more
    rows = rows + rows[::3] + [(6, brute.EDGES[6][1], "en", "a", 1)] * len(rows)
    texts = [(r[0], r[1]) for r in rows]
    kept = {i for i, _, _, k in brute.near(texts, 80) if k and i is not None}
    kept -= {i for i, _, _, k in brute.near(texts, 80) if not k}
    after = dict(corpus_pipeline.STAGES)["near_dup"](spark, brute.edge_frame(spark, rows), SMALL).collect()
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(kept)
    assert {tuple(r) for r in after} <= set(rows)
    assert {r.doc_id: r.text for r in after}[30] == old + " end"
    loose = lambda found: [frozenset(brute.shingles(t)) or t for i, t in found if i is None]
    assert Counter(set(loose(texts))) == Counter(loose([(r.doc_id, r.text) for r in after]))


def test_a_table_without_repeats_is_not_regrouped(spark, documents):
    plan = near_dup.one_of_each(documents[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "MapInArrow" not in plan
