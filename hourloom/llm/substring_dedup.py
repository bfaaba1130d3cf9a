"""Repeated passages are found, compiled to automata, and cut from all but the first document.

1. Winnowing selects some 7-word grams of a text so that every window of 13 words holds one,
   and which one depends on the window's words only. A gram is recurring if two documents
   select it; its owner is the smallest of them.
2. Documents meet at the owners of their recurring grams: all documents that hold a window
   meet at one place, that of its selected gram. Only the words around the grams are sent
   there. Large meetings are cut into chunks.
3. In a meeting the windows that recur are confirmed. Of a meeting in one chunk that is done
   there; of one in several, the chunks' windows are counted together first.
4. Each chunk compiles one word sequence of each recurring window to an Aho-Corasick
   automaton, and streams its documents through it: it alone finds the occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ids_and_texts, small, stored
from hourloom.llm.words import WordHashes, gram_hashes, hashed, split_words, winnowed
from hourloom.operators.frames import expand_rows

WINDOW = 13
GRAM = 7
CHUNK_BYTES = 6_000_000
#: Characters that words are numbered with.
CHARACTERS = 1_100_000
SEGMENT = "meeting long, chunk long, chunks long, doc_id long, version long, start long, text string"


def selected_grams(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Distinct hashes of the grams that winnowing selects; none if there is no window."""
    if len(words) < window:
        return np.zeros(0, np.uint64)
    grams = gram_hashes(words, gram)
    return np.unique(grams[winnowed(grams, window - gram + 1)])


def gram_batches(window: int, gram: int):
    """doc_id and each selected gram of the batches' documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for ids, texts in ids_and_texts(batches):
            found = [selected_grams(hashed(split_words(t), memory), window, gram) for t in texts]
            owners = np.repeat(np.array(ids, np.int64), [len(f) for f in found])
            grams = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(owners)], ["gram", "doc_id"])

    return run


def segment_batches(window: int, gram: int):
    """The words around a document's recurring grams, for each meeting, with where they start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for ids, texts, versions, places in ids_and_texts(batches, "version", "places"):
            rows = []
            for doc_id, text, version, place in zip(ids, texts, versions, places):
                words = split_words(text)
                here = gram_hashes(hashed(words, memory), gram).view(np.int64)
                by_meeting: dict[tuple, list[int]] = {}
                for p in place:
                    by_meeting.setdefault((p["meeting"], p["chunk"], p["chunks"]), []).append(p["gram"])
                known = np.unique(np.array([p["gram"] for p in place], np.int64))
                at = np.flatnonzero(np.isin(here, known))
                for (meeting, chunk, chunks), grams in by_meeting.items():
                    found = at[np.isin(here[at], np.array(grams, np.int64))]
                    for lo, hi in runs(found - (window - gram), found + window, len(words)):
                        rows.append((meeting, chunk, chunks, doc_id, version, lo, b" ".join(words[lo:hi])))
            columns = list(zip(*rows)) or [[]] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SEGMENT.split(", ")])

    return run


def runs(starts: np.ndarray, ends: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Ascending spans within 0..length, joined where they overlap."""
    out: list[tuple[int, int]] = []
    for lo, hi in zip(np.maximum(starts, 0).tolist(), np.minimum(ends, length).tolist()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


class Chunk:
    """The words of a chunk's rows, its distinct windows, and the least and most document of each."""

    def __init__(self, table: pa.Table, window: int):
        memory = WordHashes()
        texts = table.column("text").cast(pa.binary()).to_pylist() if table.num_rows else []
        self.ids = table.column("doc_id").to_numpy() if table.num_rows else np.zeros(0, np.int64)
        self.words = [hashed(split_words(t), memory) for t in texts]
        found = [gram_hashes(w, window) for w in self.words]
        counts = np.array([len(f) for f in found], np.int64)
        flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
        # Sorted by window, the rows of each one lie together; ``first`` is one place of each.
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(flat) else np.zeros(0, np.int64)
        self.values, first = ordered[begin], order[begin]
        owners = np.repeat(self.ids, counts)[order]
        self.low = np.minimum.reduceat(owners, begin) if len(begin) else owners
        self.high = np.maximum.reduceat(owners, begin) if len(begin) else owners
        ends = np.cumsum(counts)
        self.row = np.searchsorted(ends, first, side="right")
        self.start = first - (ends - counts)[self.row] if len(first) else first


def chunk_windows(window: int):
    """Windows of one of several chunks of a meeting."""

    def run(table: pa.Table) -> pa.Table:
        chunk = Chunk(table, window)
        meeting = np.full(len(chunk.values), table.column("meeting")[0].as_py())
        columns = (meeting, chunk.values.view(np.int64), chunk.low, chunk.high)
        return pa.table(dict(zip(("meeting", "window", "low", "high"), columns)))

    return run


def as_characters(words: np.ndarray, values: np.ndarray) -> str:
    """Each word as the character of its number among ``values``; of others, character 0.

    Surrogates are left out. Beyond ``CHARACTERS`` values two words may share a character; a
    match is then held against the words themselves.
    """
    place = np.searchsorted(values, words)
    place[place == len(values)] = 0
    numbers = np.where(values[place] == words, place % CHARACTERS + 1, 0).astype(np.uint32)
    numbers[numbers >= 0xD800] += 0x800
    return numbers.astype("<u4").tobytes().decode("utf-32-le")


def compiled(strings: list[str], rows: list[int], starts: list[int], owners: list[int], window: int) -> ahocorasick.Automaton:
    """The automaton of one sequence of each window, one character per word: with its smallest
    document, and where it was taken from."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    for row, start, owner in zip(rows, starts, owners):
        sequence = strings[row][start : start + window]
        same = automaton.get(sequence, None)
        automaton.add_word(sequence, [*(same or []), (owner, row, start)])
    automaton.make_automaton()
    return automaton


def covered_spans(window: int):
    """Spans of words of one chunk's documents that windows from smaller documents cover.

    The windows that recur are confirmed first, and one word sequence of each is compiled; where
    they occur, and so which words go, is found by the automaton alone.
    """

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        chunk = Chunk(docs, window)
        low, recurs = chunk.low.copy(), chunk.low < chunk.high
        if known.num_rows:
            # Windows that recur in other chunks of the meeting.
            there, least = known.column("window").to_numpy().view(np.uint64), known.column("low").to_numpy()
            at = np.minimum(np.searchsorted(chunk.values, there), max(0, len(chunk.values) - 1))
            here = chunk.values[at] == there if len(chunk.values) else np.zeros(len(there), bool)
            np.minimum.at(low, at[here], least[here])
            recurs[at[here]] = True
        spans = []
        if recurs.any():
            rows, begins = chunk.row[recurs], chunk.start[recurs]
            flat = np.concatenate(chunk.words)
            lengths = np.array([len(w) for w in chunk.words], np.int64)
            edges = np.cumsum(lengths) - lengths
            vocabulary = np.unique(flat[(edges[rows] + begins)[:, None] + np.arange(window)])
            every = as_characters(flat, vocabulary)
            strings = [every[a : a + n] for a, n in zip(edges.tolist(), lengths.tolist())]
            automaton = compiled(strings, rows.tolist(), begins.tolist(), low[recurs].tolist(), window)
            exact = len(vocabulary) <= CHARACTERS
            starting = (docs.column(c).to_pylist() for c in ("version", "start"))
            for doc_id, version, base, string, words in zip(chunk.ids.tolist(), *starting, strings, chunk.words):
                open_at = end = -1
                for last, found in automaton.iter(string):
                    begin = last - window + 1
                    if exact:
                        owner = found[0][0]
                    else:
                        same = (o for o, r, s in found if (chunk.words[r][s : s + window] == words[begin : last + 1]).all())
                        owner = min(same, default=doc_id)
                    if owner >= doc_id:
                        continue
                    if begin > end:
                        if end >= 0:
                            spans.append((doc_id, version, base + open_at, base + end))
                        open_at = begin
                    end = last + 1
                if end >= 0:
                    spans.append((doc_id, version, base + open_at, base + end))
        columns = list(zip(*spans)) or [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "version", "lo", "hi"), columns)})

    return run


def cut_batches(window: int, *others: str):
    """The documents' words without those in their spans; of copies, without all. Columns
    ``others`` of longs come along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, versions, spans, *rest in ids_and_texts(batches, "version", "spans", *others):
            n_words, n_removed, kept_text = [], [], []
            for text, version, cuts in zip(texts, versions, spans):
                # A whole copy has a span that ends nowhere.
                cuts = [c for c in cuts or [] if c["version"] == version]
                is_copy = any(c["hi"] is None for c in cuts)
                cuts = [c for c in cuts if c["hi"] is not None]
                words = split_words(text)
                kept = words
                if is_copy and len(words) >= window:
                    kept = []
                elif cuts:
                    keep = np.ones(len(words), bool)
                    for span in cuts:
                        keep[span["lo"] : span["hi"]] = False
                    kept = [words[i] for i in np.flatnonzero(keep).tolist()]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                kept_text.append(b" ".join(kept))
            columns = [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            columns.append(pa.array([hashlib.sha256(t).hexdigest() for t in kept_text]))
            columns += [pa.array(kept_text, pa.binary()).cast(pa.string()), *[pa.array(r, pa.int64()) for r in rest]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", *others])

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows ``doc_id, n_words, n_removed, kept_sha256, kept`` for every row of ``docs``.

    A word goes if a window of ``window`` words covers it whose words also start, in this
    order, in a document with a smaller id. Words are runs of characters other than space and
    \\t to \\r; kept words are joined by one space. Windows are judged on the input.

    A null text has no words. A text that a smaller id has as it is goes whole (of fewer words
    than a window: stays), without being searched. Rows that repeat id and text are judged once
    and come out as often as they are there. Other rows of one id are versions of one document,
    which don't remove each other's words. Rows without an id take no part and stay. Other
    columns are ignored; an empty table gives an empty one. Windows are confirmed by 64-bit
    hashes and located word by word through 64-bit word hashes.
    """
    every = docs.select("doc_id", "text").withColumn("version", F.xxhash64("text"))
    place, check = ["doc_id", "version", "check"], F.xxhash64(F.lit(1), "text").alias("check")
    known = stored(every.where("doc_id IS NOT NULL").select("doc_id", "version", check), "texts")
    repeated = stored(known.groupBy(*place).agg(F.count("*").alias("copies")).where("copies > 1"), "repeated")
    columns = ["doc_id", "text", "version"]
    if not repeated.isEmpty():
        # Rows that repeat are judged once, and what they come to is repeated at the end.
        tagged = every.select("*", check).join(small(repeated), place, "left")
        once = tagged.where("copies IS NOT NULL").dropDuplicates(place)
        every = tagged.where("copies IS NULL").unionByName(once).drop("check")
        columns.append("copies")
    texts = every.where("doc_id IS NOT NULL").select(*columns)
    groups = known.groupBy("version", "check").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = known.join(groups, ["version", "check"]).where(F.col("doc_id") > F.col("first")).select("doc_id", "version").distinct()
    copies = stored(copies, "copies")
    singles = texts.join(small(copies), ["doc_id", "version"], "left_anti")

    grams = stored(singles.select("doc_id", "text").mapInArrow(gram_batches(window, gram), "gram long, doc_id long"), "grams")
    owned = grams.groupBy("gram").agg(F.min("doc_id").alias("meeting"), F.max("doc_id").alias("most")).where("meeting < most")
    met = stored(grams.join(owned.select("gram", "meeting"), "gram").select("meeting", "doc_id", "gram"), "meetings")
    # Words around a gram, at a mean length of words, give the size of a meeting.
    around = 8 * (2 * window - gram) // 2
    # Stored, so that the join below has plain exchanges and can split a large meeting.
    sizes = stored(met.groupBy("meeting").agg(F.ceil(F.count("*") * around / CHUNK_BYTES).cast("long").alias("chunks")), "sizes")
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int").alias("chunk")
    places = met.join(sizes, "meeting").groupBy("doc_id").agg(F.collect_list(F.struct("gram", "meeting", chunk, "chunks")).alias("places"))
    copied = copies.select("doc_id", F.struct("version", F.lit(0).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi")).alias("span"))

    # The documents are dealt by id once, for the words around their grams and for the cut; both
    # joins read the same exchange as long as nothing else filters one of them. A version that is
    # a whole copy may come along here: its windows are those of the smaller id it copies.
    at = ["meeting", "chunk"]

    def segments_of(of: DataFrame) -> DataFrame:
        return texts.join(of, "doc_id").select(*columns, "places").mapInArrow(segment_batches(window, gram), SEGMENT)

    segments = segments_of(places)
    # Only what lies in meetings of several chunks is counted apart.
    several = F.filter("places", lambda p: p["chunks"] > 1)
    counted = (
        segments_of(places.withColumn("places", several).where(F.size("places") > 0))
        .groupBy(*at)
        .applyInArrow(chunk_windows(window), "meeting long, window long, low long, high long")
        .groupBy("meeting", "window")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high")
    )
    counted = counted.join(sizes.where("chunks > 1"), "meeting")
    counted = counted.select("meeting", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "window", "low")
    spans = segments.groupBy(*at).cogroup(counted.groupBy(*at)).applyInArrow(covered_spans(window), "doc_id long, version long, lo long, hi long")
    spans = spans.select("doc_id", F.struct("version", "lo", "hi").alias("span")).unionAll(copied)
    spans = spans.groupBy("doc_id").agg(F.collect_set("span").alias("spans"))
    judged = texts.join(spans, "doc_id", "left").select(*columns, "spans")
    no_spans = F.lit(None).cast(judged.schema["spans"].dataType).alias("spans")
    nowhere = every.where("doc_id IS NULL").select(*columns, no_spans)
    result = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    if "copies" not in columns:
        return judged.unionAll(nowhere).mapInArrow(cut_batches(window), result)
    cut = stored(judged.unionAll(nowhere).mapInArrow(cut_batches(window, "copies"), f"{result}, copies long"), "cut")
    again = expand_rows(cut.where("copies > 1"), F.col("copies"), ["doc_id"], "copy", block=256).drop("copy")
    return cut.where("copies IS NULL").unionAll(again).drop("copies")
