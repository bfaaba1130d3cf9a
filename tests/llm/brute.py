"""What each operator must return, by the plainest Python, and rows that try the edges."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cut_lines(docs, min_key=20, min_docs=3):
    """(doc_id, n_lines, n_dropped, kept text) of rows (doc_id, text); null ids keep all."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    seen = defaultdict(set)
    for i, text in docs:
        if i is not None:
            for line in (text or "").split("\n"):
                seen[key(line)].add(i)
    shared = {k: max(v) for k, v in seen.items() if len(k) >= min_key and len(v) >= min_docs}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or shared.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def cut_substrings(docs, window=13):
    """(doc_id, n_words, n_removed, kept text)."""
    first = {}
    for i, text in docs:
        if i is not None:
            w = words(text)
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k : k + window])] < i:
                    gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), " ".join(kept)))
    return out


def shingles(text):
    w = words((text or "").translate(FOLD))
    return {tuple(w[k : k + min(5, len(w))]) for k in range(max(1, len(w) - 4))} if w else set()


def near(docs, threshold):
    """(doc_id, n_shingles, component_id, kept) of rows with ids; rows of one id belong together."""
    sets = [(i, shingles(t)) for i, t in docs]
    up = {i: i for i, _ in docs if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for g in s:
                holders[g].append(k)
    tried = set()
    for found in holders.values():
        for a in found:
            for b in found:
                if a < b and (a, b) not in tried:
                    tried.add((a, b))
                    (i, s), (j, t) = sets[a], sets[b]
                    common = len(s & t)
                    if 100 * common >= threshold * (len(s) + len(t) - common):
                        x, y = root(i), root(j)
                        up[max(x, y)] = min(x, y)
    return [(i, len(s), *((None, True) if i is None else (root(i) if s else i, (root(i) if s else i) == i))) for i, s in sets]


def targets(sizes, weights=(3, 1, 2), share=150, copies=2):
    """Exact targets by filling round after round; ``sizes`` by source, null allowed."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, target = Fraction(share * sum(sizes.values()), 100), list(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level >= copies * sizes[s]]
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in over:
            target[s] = Fraction(copies * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target


def top(vectors, every, k):
    import math

    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, asked) in enumerate(usable):
        if q % every == 0:
            clip = lambda x: max(-(2**63), min(2**63 - 1, x))
            others = [r for place, r in enumerate(usable) if place != at and len(r[1]) == len(asked)]
            scored = sorted((-clip(sum(a * b for a, b in zip(asked, v))), i) for i, v in others)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def bag(rows):
    return Counter(map(tuple, rows))


PASSAGE = " ".join(f"shared{k}" for k in range(60))
LINE = "A line that Many documents repeat word for word"

#: doc_id, text, lang, source, n_chars: nulls, empties, ties, repeats, long texts.
EDGES = [
    (0, f"{LINE}\nown zero one two three", "en", "b", 1),
    (1, f"  {LINE.upper()} \nsecond own text\n\n", "en", "a", 1),
    (2, f"{LINE.lower()}\t\nthird {PASSAGE} end of it", "en", None, 1),
    (3, None, "en", "a", 0),
    (4, "", None, "a", 0),
    (5, " \t\n ", "en", "c", 4),
    (6, f"start {PASSAGE} and more", "en", "a", 1),
    (6, f"start {PASSAGE} and more", "en", "a", 1),
    (7, " ".join(PASSAGE.split()[10:40]) + " other words here", "en", "a", 1),
    (8, "one two three", "en", "d", 1),
    (9, "One TWO three", "en", "d", 1),
    (10, "É é groß Ünïcode 漢字 \U0001f600 " * 4, "fr", "é", 1),
    (11, f"{LINE}\nÉCOLE école de la ligne numéro un\nx", "fr", "b", 1),
    (12, "école école de la ligne numéro un\nÉCOLE ÉCOLE de la LIGNE numéro un", "fr", "b", 1),
    (None, f"{LINE}\nrow without an id {PASSAGE}", "en", "b", 1),
    (13, " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000)), "en", "long", 1),
    (14, " ".join(f"w{k % 977}x{k % 31}" for k in range(29_900)), "en", "long", 1),
    (15, "\n".join([LINE] * 500 + ["a tail"]), "en", "b", 1),
    (16, "x" * 50_000, "en", "a", 1),
    (17, "aaa " * 400, "en", "a", 1),
    (18, "aaa " * 300, "en", "a", 1),
    (19, "nbsp\u00a0joined words\u2003here \x85 next", "en", "a", 1),
    (-4, "a negative id", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_frame(spark, rows=EDGES):
    """The edge rows, with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    extra = {c: F.lit("extra") for c in ("size", "row", "key", "taken", "target", "spans", "kept", "n_lines", "gram", "range", "tail_probability", "_id", "version", "shard", "host", "grade")}
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(extra)


def edge_texts():
    return [(r[0], r[1]) for r in EDGES]
