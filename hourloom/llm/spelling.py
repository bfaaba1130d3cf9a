"""Spelling variants: words one edit apart, and the frequent word each one stands for.

1. A gram dictionary holds the grams that are frequent among the words. Gram by gram, a word
   is tiled from its left end and from its right end: a gram grows while it is in the
   dictionary, so the last character that it takes makes it rare enough.
2. An edit affects the tiles that it touches; which tiles, is bounded per word and place. All
   other grams survive in the neighbour, at the same distance from their end. So for each
   place of an edit the lists of the surviving grams are merged, by one key of all of them:
   two neighbours share a key, and what they share leaves only the affected window open.
3. Words that share a key are compared in that window. A merged list that is longer than
   ``LIST`` gets longer grams instead: every window is narrowed to the one character that an
   edit may change, where the list can't be longer than the alphabet.
4. Pairs found are verified on the whole words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import UPPER, ids_and_texts, in_slices, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = str.maketrans(UPPER, UPPER.lower())
LEAST_CHARS, LEAST_COUNT, RATIO, DAMAGED = 7, 2, 10, 31
#: Characters of the shortest and longest gram.
SHORTEST, LONGEST = 2, 6
#: A gram is frequent if it is more than this share of all; so fewer than 2**17 are.
FREQUENT_SHARE = 2**17
#: Longest merged list that is compared as it is.
LIST = 24
#: Words or grams a task counts before it sends them on.
COUNTED = 400_000
PRIME, BASE = (1 << 61) - 1, 1_000_003


def flushed(counts: Counter, names: tuple[str, str]) -> pa.RecordBatch:
    arrays = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    counts.clear()
    return pa.RecordBatch.from_arrays(arrays, list(names))


def damaged(run: str, crc: int) -> str:
    """The run without one character if its hash says so."""
    if crc % DAMAGED:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def word_batches(least_chars: int):
    """Words of the batches' whole texts with their counts, counted together by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for ids, texts in ids_and_texts(batches):
            for doc_id, text in zip(ids, texts):
                if not text:
                    continue
                start = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
                for word, n in Counter(RUN.findall(text.decode().translate(FOLD))).items():
                    if len(word) >= least_chars:
                        if start is not None:
                            word = damaged(word, zlib.crc32(word.encode(), start))
                            if len(word) < least_chars:
                                continue
                        counts[word] += n
            if len(counts) >= COUNTED:
                yield flushed(counts, ("word", "n"))
        yield flushed(counts, ("word", "n"))

    return run


def gram_batches(shortest: int, longest: int):
    """Grams that might be extended, with their counts among the batches' words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in in_slices(batches):
            for word in batch.column("word").to_pylist():
                for size in range(shortest, longest):
                    counts.update([word[i : i + size] for i in range(len(word) - size + 1)])
            if len(counts) >= COUNTED:
                yield flushed(counts, ("gram", "n"))
        yield flushed(counts, ("gram", "n"))

    return run


def gram_dictionary(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, share: int = FREQUENT_SHARE) -> frozenset[str]:
    """Grams of ``shortest`` to ``longest`` - 1 characters that are more than 1/``share`` of all
    grams of all words; fewer than ``share``, whatever the words."""
    schema = "gram string, n long"
    grams = words.mapInArrow(gram_batches(shortest, longest), schema).groupBy("gram").agg(F.sum("n").alias("n"))
    grams = stored(grams, "grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    return frozenset(r.gram for r in grams.where(F.col("n") > max(1, total // share)).select("gram").collect())


def tiled(word: str, frequent: frozenset[str], shortest: int, longest: int) -> tuple[list[int], list[int]]:
    """Where tiles end, counted from the left, and where they begin, counted from the right;
    both ascend. A tile that the word's end cuts short is none."""
    length, left, right = len(word), [0], [len(word)]
    start, end = 0, shortest
    while end <= length:
        if end - start < longest and word[start:end] in frequent:
            end += 1
        else:
            left.append(end)
            start, end = end, end + shortest
    end, start = length, length - shortest
    while start >= 0:
        if end - start < longest and word[start:end] in frequent:
            start -= 1
        else:
            right.append(start)
            end, start = start, start - shortest
    return left, right[::-1]


def windows(word: str, frequent: frozenset[str], shortest: int, longest: int) -> list[tuple[int, int]]:
    """The windows that one edit can affect: for a changed or deleted character at each place,
    and for a character inserted before each place and at the end.

    Left of a window are the tiles that end before the edit, right of it those that begin
    after it. They depend on no character of the edit, so a neighbour has them too.
    """
    left, right = tiled(word, frequent, shortest, longest)
    found, i, j = [], 0, 0
    for place in range(len(word) + 1):
        while i + 1 < len(left) and left[i + 1] <= place:
            i += 1
        while right[j] < place:
            j += 1
        # An insertion keeps what begins at its place, a change does not.
        found.append((left[i], right[j]))
        if place < len(word):
            found.append((left[i], right[j + (right[j] == place)]))
    return list(dict.fromkeys(found))


def mixed(pre: np.ndarray, post: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A 64-bit key of what is left and right of a window."""
    key = pre * np.uint64(0x9E3779B97F4A7C15) + before
    key ^= key >> np.uint64(29)
    key = (key ^ post) * np.uint64(0xBF58476D1CE4E5B9) + after
    key ^= key >> np.uint64(32)
    key *= np.uint64(0x94D049BB133111EB)
    return (key ^ (key >> np.uint64(29))).view(np.int64)


def listed_batches(dictionary: Broadcast, shortest: int, longest: int):
    """A row for each word and window: the key of the surviving grams, and the open window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = dictionary.value
        step = lambda h, c: (h * BASE + c) % PRIME
        for batch in in_slices(batches):
            owners, open_text, keys = [], [], []
            for number, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                codes = list(map(ord, word))
                pre, post = list(accumulate(codes, step, initial=7)), list(accumulate(codes[::-1], step, initial=7))
                length = len(word)
                for lo, hi in windows(word, frequent, shortest, longest):
                    owners.append(number)
                    open_text.append(word[lo:hi])
                    keys.append((pre[lo], post[length - hi], lo, length - hi))
            parts = np.array(keys, np.uint64).reshape(-1, 4)
            arrays = [pa.array(mixed(*parts.T.copy())), pa.array(owners, pa.int64()), pa.array(open_text, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "id", "open"])

    return run


def pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of ids of equal keys; the rows are sorted by key, and no key has more than the
    alphabet's rows and one."""
    keys, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pairs(upto: int) -> pa.RecordBatch:
        found, off = [], 1
        while off < upto:
            same = np.flatnonzero(keys[: upto - off] == keys[off:upto])
            if not len(same):
                break
            a, b = ids[same], ids[same + off]
            differ = a != b
            found.append(np.stack([np.minimum(a, b)[differ], np.maximum(a, b)[differ]]))
            off += 1
        rows = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1])], ["low", "high"])

    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        ids = np.concatenate([ids, batch.column("id").to_numpy()])
        if len(keys):
            # The last key may go on in the next batch.
            upto = int(np.searchsorted(keys, keys[-1]))
            yield pairs(upto)
            keys, ids = keys[upto:], ids[upto:]
    yield pairs(len(keys))


def vocabulary(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``id, word, n``: the words of all documents; ids follow the words' code-point order."""
    counts = docs.select("doc_id", "text").mapInArrow(word_batches(least_chars), "word string, n long")
    counts = stored(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "words")
    return stored(counts.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def near_pairs(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, longest_list: int = LIST) -> DataFrame:
    """``low, high``: candidates, each pair once, by id. All that are one edit apart are among
    them."""
    spark = words.sparkSession
    dictionary = spark.sparkContext.broadcast(gram_dictionary(words, shortest, longest))
    listed = words.select("id", "word").mapInArrow(listed_batches(dictionary, shortest, longest), "key long, id long, open string")
    listed = stored(listed, "listed")
    # Stored, so that the join's sides are both plain exchanges and a long list can be split.
    lists = stored(listed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    listed = stored(listed.join(lists, "key"), "lists")

    short = listed.where(F.col("size") <= longest_list).select("key", "id", "open")
    other = short.select("key", F.col("id").alias("high"), F.col("open").alias("their"))
    gap = F.char_length("open") - F.char_length("their")
    merged = short.join(other, "key").where((F.col("id") < F.col("high")) & gap.between(-1, 1))
    merged = merged.where(F.levenshtein("open", "their", 1) == 1).select(F.col("id").alias("low"), "high")

    # Places of a long list's window: its characters, each left out, and the gaps between them.
    at = F.explode(F.sequence(F.lit(0), 2 * F.char_length("open"))).alias("at")
    place = F.floor(F.col("at") / 2).cast("int")
    rest = F.expr("substring(open, place + 1 + at % 2)")
    exact = F.xxhash64("key", "place", F.expr("substring(open, 1, place)"), rest).alias("key")
    fine = listed.where(F.col("size") > longest_list).select("key", "id", "open", at).withColumn("place", place).select(exact, "id")
    fine = fine.repartition("key").sortWithinPartitions("key").mapInArrow(pair_batches, "low long, high long")
    return merged.unionAll(fine).distinct()


def forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``id, form_id, form_n``: of a word's near words the one of largest n, ties to the first,
    if it has at least ``ratio`` times the word's n."""
    rarer = F.when(F.col("low_n") < F.col("high_n"), F.struct(F.col("low").alias("id"), F.col("high").alias("form_id"), F.col("high_n").alias("form_n")))
    rarer = rarer.otherwise(F.struct(F.col("high").alias("id"), F.col("low").alias("form_id"), F.col("low_n").alias("form_n")))
    enough = F.greatest("low_n", "high_n") >= ratio * F.least("low_n", "high_n").cast("decimal(20,0)")
    candidates = stored(near.where(enough).select(rarer.alias("r")).select("r.*"), "candidates")
    most = candidates.groupBy("id").agg(F.max("form_n").alias("form_n"))
    return stored(candidates.join(most, ["id", "form_n"]).groupBy("id", "form_n").agg(F.min("form_id").alias("form_id")), "forms")


def roots(words: DataFrame, formed: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``id, root_id`` of the words that have a form: the last one on the way of forms.

    Each form has ``ratio`` times the n of the one before, so a way is no longer than the
    logarithm of the largest n, and each step doubles what is known of it.
    """
    most, hops = words.agg(F.max("n")).first()[0] or 1, 0
    while most >= ratio:
        most, hops = most // ratio, hops + 1
    reached, known = formed.select("id", F.col("form_id").alias("root_id")), 1
    while known < hops:
        further = reached.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        reached = reached.join(further, "root_id", "left").select("id", F.coalesce("next_id", "root_id").alias("root_id"))
        reached, known = stored(reached, "roots"), 2 * known
    return reached


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Rows ``word, form, root, n, n_near, form_n`` for every word of ``docs``.

    Runs are the maximal ones of A-Z, a-z and U+00C0 to U+00FF in whole texts, A-Z lower-cased.
    If 31 divides the crc32 h of ``<doc_id>:<run>``, the run loses its code point h % length.
    Words have at least 7 code points and occur at least twice. Two are near if one inserted,
    deleted or replaced code point makes them equal. A word's form is its near word of the
    largest n, ties to the smaller, if it has at least 10 times the word's n; the root is the
    last word on the way of forms, the word itself if it has none.

    A null text has no runs. In a row without an id the runs stay as they are. Rows that repeat
    are counted each; other columns are ignored; an empty table gives an empty one.
    """
    words = vocabulary(docs)
    pairs = near_pairs(words)
    side = lambda name: words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"), F.col("n").alias(f"{name}_n"))
    near = pairs.join(side("low"), "low").join(side("high"), "high")
    near = near.where(F.levenshtein("low_word", "high_word", 1) == 1).select("low", "high", "low_n", "high_n")
    near = stored(near, "near")
    counts = near.select(F.explode(F.array("low", "high")).alias("id")).groupBy("id").agg(F.count("*").alias("n_near"))
    formed = forms(words, near)
    rooted = roots(words, formed)
    known = words.join(counts, "id", "left").join(formed, "id", "left").join(rooted, "id", "left")
    named = lambda id_name, name: words.select(F.col("id").alias(id_name), F.col("word").alias(name))
    known = known.join(named("form_id", "form"), "form_id", "left").join(named("root_id", "root"), "root_id", "left")
    return known.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
