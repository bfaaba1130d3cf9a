"""Near words and forms against a brute-force version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from hourloom.llm import spelling
from tests.llm import brute
from tests.llm.conftest import SMALL


def counted(docs):
    found = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(brute.FOLD)
            h = 1 if i is None else zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1 :] or a[k + 1 :] == b[k + 1 :]


def variants(n):
    """Rows of the operator for counts ``n``; words meet at every text with one left out."""
    meeting, near = defaultdict(set), defaultdict(set)
    for w in n:
        meeting[w].add(w)
        for k in range(len(w)):
            meeting[w[:k] + w[k + 1 :]].add(w)
    for group in meeting.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), form[w] and n[form[w]]))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_variants_of_documents(spark, documents):
    want = variants(counted(documents[1]))
    assert rows_of(spelling.spelling_variants(documents[0])) == want
    assert any(w[1] for w in want) and any(w[4] > 3 for w in want)


def random_words(seed):
    """Words of few letters, so that many are near, with chains of counts and repeats."""
    pick, words = random.Random(seed), {}
    while len(words) < 1500:
        w = "".join(pick.choice("abé") for _ in range(pick.randint(7, 9))) if pick.random() < 0.7 else "ab" * pick.randint(4, 7) + pick.choice("abcé")
        words[w] = pick.choice([2, 3, 20, 21, 200, 2000])
    return words | {"x" * 400: 2, "x" * 401: 30, "y" + "x" * 400: 400, "aaaaaaa": 4000}


@pytest.mark.parametrize("grams", [(2, 6, 24), (1, 2, 1), (3, 4, 2), (2, 9, 100_000)])
def test_near_pairs_of_any_grams(spark, grams):
    n = random_words(7)
    words = spark.createDataFrame([(i, w, n[w]) for i, w in enumerate(sorted(n))], "id long, word string, n long")
    by_id = dict(enumerate(sorted(n)))
    got = {(r.low, r.high) for r in spelling.near_pairs(words, *grams).collect()}
    assert all(low < high for low, high in got)
    near = {(by_id[a], by_id[b]) for a, b in got if one_apart(by_id[a], by_id[b])}
    want, places = set(), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            places[w[:k] + w[k + 1 :]].add(w)
    for key, group in places.items():
        group = group | ({key} & n.keys())
        want |= {(a, b) for a in group for b in group if a < b and one_apart(a, b)}
    assert near == want
    assert len(got) <= 1.01 * len(want) + 5


def test_chains_and_edges(spark):
    n = random_words(3)
    texts = [(None, " ".join([w] * min(c, 40))) for w, c in n.items()]
    want = variants(counted(texts))
    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'x' AS word", "1 AS n", "2 AS id", "'k' AS key")
    assert rows_of(spelling.spelling_variants(frame.repartition(5))) == want
    edge = brute.edge_frame(spark)
    assert rows_of(spelling.spelling_variants(edge)) == variants(counted(brute.edge_texts()))
    assert spelling.spelling_variants(edge.where("false")).count() == 0
    assert spelling.spelling_variants(edge.where("text IS NULL OR text = ''")).count() == 0


def test_roots_of_long_ways(spark):
    """Each form has ten times the n of the one before."""
    ladder = ["aaaaaaa" + "b" * k for k in range(8)]
    words = spark.createDataFrame([(i, w, 2 * 10**i) for i, w in enumerate(ladder)], "id long, word string, n long")
    near = spark.createDataFrame([(i, i + 1, 2 * 10**i, 2 * 10 ** (i + 1)) for i in range(7)], "low long, high long, low_n long, high_n long")
    formed = spelling.forms(words, near)
    assert {r.id: r.form_id for r in formed.collect()} == {i: i + 1 for i in range(7)}
    assert {r.id: r.root_id for r in spelling.roots(words, formed).collect()} == {i: 7 for i in range(7)}


def test_dictionary_is_bounded(spark):
    words = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("explode(split(text, ' ')) AS word").where("length(word) > 3")
    small = spelling.gram_dictionary(words, share=512)
    assert 0 < len(small) < 512
    assert small < spelling.gram_dictionary(words, share=1 << 14)


def test_hash_damages_runs():
    assert spelling.damaged("abcdefgh", 31 * 3) == "abcdegh" and spelling.damaged("abcdefgh", 5) == "abcdefgh"
