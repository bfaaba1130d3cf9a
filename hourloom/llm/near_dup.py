"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Each document's 5-word shingles are hashed; the set's digest groups exact equals, whose
   smallest id stands for them, and the k smallest hashes are its sketch.
2. Inverted lists of retained sketch values bring documents together. Values are retained
   rarest first: two sketches that must share c values share one of their k - c + 1 rarest,
   so a passage that many documents quote doesn't bring all of them together.
3. Documents of one list, or of lists with the same smallest document, meet in a group. Large
   groups are cut into chunks, every two chunks meet. Each pair is first estimated from the
   sketch of the union, then confirmed on the full sets, unless links found before connect it.
4. Links are contracted to connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ids_and_texts, in_slices, small, stored, wide_hash
from hourloom.llm.words import WordHashes, gram_hashes, hashed, split_words

SHINGLE = 5
SKETCH = 24
#: Chance that the candidate search misses one link at the threshold itself.
MISS = 1e-9
CHUNK_DOCS = 1024
CHUNK_SHINGLES = 1 << 20
#: Columns of shared shingles that are multiplied at once.
SLAB = 4096


def shingle_set(text: bytes | None, memory: WordHashes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text of fewer words is one shingle."""
    words = hashed(split_words(text, lower=True), memory)
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(n, len(words))))


def least_overlap(threshold: int, k: int = SKETCH, miss: float = MISS) -> int:
    """Values that the sketches of two sets of similarity ``threshold`` % share at least.

    Each of the union's k smallest values lies in both sets with that chance, so fewer are
    shared with the chance of a binomial tail, which is held below ``miss``.
    """
    p, tail = threshold / 100, 0.0
    for c in range(k + 1):
        tail += math.comb(k, c) * p**c * (1 - p) ** (k - c)
        if tail > miss:
            return max(1, c)
    return k


def sketch_batches(k: int):
    """doc_id, size, digest and sketch of every document of the Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for ids, texts in ids_and_texts(batches):
            sets = [shingle_set(t, memory) for t in texts]
            digests = [xxhash.xxh3_128(s.tobytes()).digest() for s in sets]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array([s[:k].view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "sketch"],
            )

    return run


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, digest and the whole set, as bytes, of the documents that have one."""
    memory = WordHashes()
    for ids, texts in ids_and_texts(batches):
        sets = [shingle_set(t, memory).tobytes() for t in texts]
        halves = np.frombuffer(b"".join(xxhash.xxh3_128(s).digest() for s in sets), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(sets, pa.binary())],
            ["doc_id", "d1", "d2", "shingles"],
        )


class Forest:
    """Which of the documents of one task are connected so far."""

    def __init__(self, n: int):
        self.of = list(range(n))

    def root(self, i: int) -> int:
        while self.of[i] != i:
            self.of[i] = self.of[self.of[i]]
            i = self.of[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.of[max(a, b)] = min(a, b)
        return a != b


def estimated(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """Values of the union's sketch that both sets hold, and the size of that sketch."""
    union = np.union1d(a[:k], b[:k])[:k]
    shared = np.intersect1d(a[:k], b[:k], assume_unique=True)
    return int(np.searchsorted(shared, union[-1], side="right")), len(union)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``.

    Only values that both sides hold count; they are dealt to slabs of a 0/1 matrix.
    """
    flat = [np.concatenate(side) for side in (left, right)]
    rows = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    shared = np.intersect1d(*(np.unique(f) for f in flat), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    at = []
    for f, r in zip(flat, rows):
        place = np.searchsorted(shared, f)
        place[place == len(shared)] = 0
        hit = shared[place] == f if len(shared) else np.zeros(len(f), bool)
        order = np.argsort(place[hit], kind="stable")
        at.append((place[hit][order], r[hit][order]))
    for start in range(0, len(shared), SLAB):
        width = min(SLAB, len(shared) - start)
        slabs = []
        for (place, r), n in zip(at, out.shape):
            lo, hi = np.searchsorted(place, [start, start + width])
            used, compact = np.unique(r[lo:hi], return_inverse=True)
            slab = np.zeros((len(used), width), np.float32)
            slab[compact, place[lo:hi] - start] = 1
            slabs.append((used, slab))
        (ua, a), (ub, b) = slabs
        if len(ua) and len(ub):
            out[np.ix_(ua, ub)] += a @ b.T
    return out


def confirmed_links(threshold: int, k: int, least: int):
    """Links of one pair of chunks: at most one fewer than the documents that they connect."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "d1"], kind="stable")
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        ids, chunk = frame["doc_id"].to_numpy(), frame["chunk"].to_numpy()
        first = chunk == frame["low"].to_numpy()
        same = frame["low"].iloc[0] == frame["high"].iloc[0]
        links = linked_pairs(ids, sets, first, same, threshold, k, least)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def linked_pairs(ids, sets, first, same, threshold, k, least) -> list[tuple[int, int]]:
    size = np.array([len(s) for s in sets])
    left = np.flatnonzero(first)
    right = left if same else np.flatnonzero(~first)
    if not len(left) or not len(right):
        return []
    sketches = [s[:k] for s in sets]
    near = overlaps([sketches[i] for i in left], [sketches[j] for j in right])
    # Sketch filter: what the smaller of two small sets must share, or the least overlap.
    small_set = np.minimum(size[left][:, None], size[right][None, :])
    large_set = np.maximum(size[left][:, None], size[right][None, :])
    need = np.minimum(least, -(-threshold * large_set // 100))
    maybe = (near >= need) & (100 * small_set >= threshold * large_set)
    if same:
        maybe &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    rows, cols = np.nonzero(maybe)
    if not len(rows):
        return []
    forest, links = Forest(len(sets)), []
    # Many pairs are counted together, a few one by one.
    exact = overlaps([sets[i] for i in left], [sets[j] for j in right]) if len(rows) > 4 * (len(left) + len(right)) else None
    order = np.argsort(-near[rows, cols], kind="stable")
    for r, c in zip(rows[order].tolist(), cols[order].tolist()):
        i, j = int(left[r]), int(right[c])
        if ids[i] == ids[j] or forest.root(i) == forest.root(j):
            continue
        if exact is None:
            agree, union = estimated(sets[i], sets[j], k)
            if agree < min(least, -(-threshold * union // 100)):
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        else:
            common = int(exact[r, c])
        if 100 * common >= threshold * (int(size[i]) + int(size[j]) - common):
            forest.join(i, j)
            links.append((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
    return links


def retained(reps: DataFrame, threshold: int, k: int, least: int) -> DataFrame:
    """Rows ``value, doc_id, d1, d2``: the rarest sketch values of each document.

    A sketch of n values that must share c is brought together by its n - c + 1 rarest; any
    order that all documents share will do, so only values found more than once are looked
    up.
    """
    values = reps.select("doc_id", "d1", "d2", "n_shingles", F.explode("sketch").alias("value"))
    often = values.groupBy("value").agg(F.count("*").alias("often")).where(F.col("often") > 1)
    must_share = F.least(F.lit(least), F.ceil(F.col("n_shingles") * threshold / 100))
    keep = (F.least(F.col("n_shingles"), F.lit(k)) - must_share + 1).cast("int")
    ranked = (
        values.join(often, "value", "left")
        .groupBy("doc_id", "d1", "d2", "n_shingles")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"), "value"))).alias("values"))
    )
    kept = ranked.select("doc_id", "d1", "d2", "n_shingles", F.explode(F.slice("values", F.lit(1), keep)).alias("v"))
    return kept.where(F.col("v.often") > 1).select("doc_id", "d1", "d2", "n_shingles", F.col("v.value").alias("value"))


def meetings(entries: DataFrame) -> DataFrame:
    """Rows ``meeting, doc_id, d1, d2, n_shingles``: documents that have to be compared.

    Lists with the same smallest document become one meeting, so a document comes once to
    what would be many lists of the same group of copies.
    """
    heads = entries.groupBy("value").agg(F.min("doc_id").alias("meeting"), F.count("*").alias("n")).where(F.col("n") > 1)
    return entries.join(heads.select("value", "meeting"), "value").select("meeting", "doc_id", "d1", "d2", "n_shingles").distinct()


def in_chunks(met: DataFrame) -> DataFrame:
    """Rows of ``met`` for every pair ``low <= high`` of chunks that a row's chunk is in."""
    sizes = met.groupBy("meeting").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("all")).where(F.col("docs") > 1)
    chunks = F.greatest(F.ceil(F.col("docs") / CHUNK_DOCS), F.ceil(F.col("all") / CHUNK_SHINGLES)).cast("int")
    placed = met.join(sizes.select("meeting", chunks.alias("chunks")), "meeting")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "d1"), F.col("chunks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return placed.select(
        "meeting", "doc_id", "d1", "d2", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    )


def components(links: DataFrame) -> DataFrame:
    """Rows ``node, component``: the smallest node that each linked node can reach.

    Large-star and small-star steps in turn: every step hangs nodes on the smallest neighbour
    known, and the number of steps grows with the logarithm of the longest path. Each step is
    a grouping and a join, written to the shared folder.
    """

    def both_ways(e: DataFrame) -> DataFrame:
        return e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        around = both_ways(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: every neighbour above a node hangs on the node's smallest.
        large = around.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").distinct()
        large = stored(large, "large-star")
        # Small star: the neighbours below a node, and the node, hang on the smallest of them.
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(down, "b")
        nxt = (
            joined.select(F.col("m").alias("a"), F.col("b"))
            .unionAll(joined.select(F.col("m").alias("a"), F.col("a").alias("b")))
            .where("a <> b")
            .distinct()
        )
        nxt = stored(nxt, "small-star")
        # Done when every node hangs on one node that hangs on none.
        open_ends = nxt.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        open_ends = open_ends or nxt.join(nxt.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        edges = nxt
        if not open_ends:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(roots)


def near_duplicates(docs: DataFrame, threshold: int = 80, k: int = SKETCH) -> DataFrame:
    """Rows ``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Texts are linked whose sets of 5-word shingles (A-Z lower-cased; fewer words are one
    shingle) have 100 * intersection >= ``threshold`` * union; a component is what links
    reach, named by its smallest id, whose row is kept. Links are confirmed on full sets of
    64-bit shingle hashes; the search for them misses one at the threshold with a chance of
    at most ``MISS``.

    A null or empty text, or one of white space, has an empty set and links with nothing.
    Rows that repeat an id are versions of one document: what one links, all link. Rows
    without an id link with nothing; their component is null and they are kept. Other columns
    are ignored; an empty table gives an empty one.
    """
    least = least_overlap(threshold, k)
    schema = "doc_id long, n_shingles long, d1 long, d2 long, sketch array<long>"
    sketched = stored(docs.select("doc_id", "text").mapInArrow(sketch_batches(k), schema), "sketches")
    with_words = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = with_words.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    member = stored(with_words.select("doc_id", "d1", "d2").distinct().join(classes, ["d1", "d2"]), "members")
    reps = sketched.join(member.where("doc_id = rep").select("doc_id", "d1", "d2"), ["doc_id", "d1", "d2"], "left_semi")
    reps = reps.dropDuplicates(["doc_id", "d1", "d2"])
    met = stored(meetings(stored(retained(reps, threshold, k, least), "retained")), "meetings")
    dealt = stored(in_chunks(met), "dealt")
    wanted = small(stored(dealt.select("doc_id").distinct(), "wanted"))
    sets = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInArrow(set_batches, "doc_id long, d1 long, d2 long, shingles binary")
    sets = sets.dropDuplicates(["doc_id", "d1", "d2"])
    links = dealt.join(sets, ["doc_id", "d1", "d2"]).groupBy("meeting", "low", "high").applyInPandas(confirmed_links(threshold, k, least), "a long, b long")
    links = stored(links, "links")
    same_text = member.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = components(links)
    # Copies join their class' component; versions of one id join their classes first.
    versions = member.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("rep").alias("a"), F.max("rep").alias("z"))
    if versions.where("n > 1").limit(1).count():
        found = components(links.unionAll(same_text))
        of_doc = found.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    else:
        of_rep = member.join(found, F.col("rep") == F.col("node"), "left")
        of_doc = of_rep.select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    out = sketched.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, with the size and the digest of each text's shingle set."""
    memory = WordHashes()
    for batch in in_slices(batches):
        sets = [shingle_set(t, memory) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        halves = np.frombuffer(b"".join(xxhash.xxh3_128(s.tobytes()).digest() for s in sets), np.int64).reshape(-1, 2)
        digest = [pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
        yield pa.RecordBatch.from_arrays([*batch.columns, *digest], [*batch.schema.names, "_shingles", "_d1", "_d2"])


def one_row_each(rows: DataFrame) -> DataFrame:
    """One row per id, and one per shingle set of the rows without an id.

    Of an id's versions the one of most shingles stays, then the longest. Each task leaves
    one row of a group before the shuffle, so a group may hold any share of the rows.
    Texts without words have no set to go by; without an id, only equal ones are one.
    """
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "_shingles long, _d1 long, _d2 long"])
    sized = rows.mapInArrow(digest_batches, schema)
    own = [F.when(F.col("_shingles") > 0, F.col(d)).otherwise(h) for d, h in zip(("_d1", "_d2"), wide_hash("text"))]
    group = [F.when(F.col("doc_id").isNull(), k) for k in (F.least(F.col("_shingles"), F.lit(1)), *own)]
    order = F.struct("_shingles", F.octet_length("text"), *wide_hash("text"), F.xxhash64(*rows.columns))
    keyed = sized.select("doc_id", *[k.alias(f"_g{i}") for i, k in enumerate(group)], F.struct(*rows.columns).alias("_row"), order.alias("_order"))
    return keyed.groupBy("doc_id", "_g0", "_g1", "_g2").agg(F.max_by("_row", "_order").alias("_row")).select("_row.*")


def one_of_each(docs: DataFrame, threshold: int = 80) -> DataFrame:
    """One row of every component of ``near_duplicates``: that of the kept id.

    Rows that repeat a kept id, with the same text or as versions of it, leave one row.
    Rows without an id are in no component; of those with equal shingle sets one stays.
    """
    gone = near_duplicates(docs, threshold).where("NOT kept").select("doc_id").distinct()
    gone = small(stored(gone, "near-copies"))
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = stored(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    if not again.limit(1).count():
        return left
    # Rows whose id is theirs alone don't move.
    ids, loose = small(again.where("doc_id IS NOT NULL")), left.where("doc_id IS NULL")
    alone = left.where("doc_id IS NOT NULL").join(ids, "doc_id", "left_anti").select(*docs.columns)
    repeated = left.join(ids, "doc_id", "left_semi").select(*docs.columns)
    return alone.unionAll(one_row_each(repeated.unionAll(loose)))
