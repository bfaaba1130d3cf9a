"""Mixing sources to target weights by hash-random order and distributed prefix sums."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import DOCUMENT_COLUMNS, small, stored

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_COPIES = 2
#: Ranges of the key in a source; the one that holds the cut is sorted.
RANGES = 1 << 16
SEED = 11


def word_counts(texts: pa.Array) -> pa.Array:
    """Words of each text; splitting bytes breaks at exactly the six white-space characters."""
    return pa.array([0 if t is None else len(t.split()) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())


def count_words(text: Column) -> Column:
    # Said to be nondeterministic, so that a filter on the count doesn't count once more in a
    # second worker of the same task.
    return F.arrow_udf(word_counts, "long").asNondeterministic()(text)


def random_key(columns: list[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = SHARE_PERCENT, copies: int = MOST_COPIES) -> DataFrame:
    """Rows ``source, source_size, target`` from rows ``source, source_size``.

    Sources in code-point order, null last, take the weights in turn. Filling by weight with
    a ceiling of ``copies`` times the size is solved at once: in the order of ceiling over
    weight the capped sources come first, and a source is capped if its own level is at most
    the level at which what the earlier ones leave would fill all the rest. The table has one
    row per source, so the windows here see as many rows as there are sources.
    """
    # Every row sees all sources: one partition, of one row per source.
    every = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("rank", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = reduce(lambda c, i: c.when(F.col("rank") % len(weights) == i, weights[i]), range(1, len(weights)), F.when(F.col("rank") % len(weights) == 0, weights[0]))
    ranked = ranked.withColumn("weight", cycle.cast("double")).withColumn("ceiling", (F.col("source_size") * copies).cast("double"))
    by_level = every.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole) * share / 100
    filled = (
        ranked.withColumn("level", F.col("ceiling") / F.col("weight"))
        .withColumn("before", F.coalesce(F.sum("ceiling").over(by_level), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0)))
        .withColumn("reach", (total - F.col("before")) / F.col("weight_left"))
        .withColumn("capped", F.col("level") <= F.col("reach"))
        # Past the first source that is not capped the reach only falls.
        .withColumn("water", F.max(F.when(~F.col("capped"), F.col("reach"))).over(whole))
    )
    target = F.when(F.col("capped"), F.col("ceiling")).otherwise(F.col("weight") * F.col("water"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: int = SHARE_PERCENT,
    copies: int = MOST_COPIES,
    ranges: int = RANGES,
    seed: int = SEED,
    keep: tuple[str, ...] = tuple(DOCUMENT_COLUMNS),
) -> DataFrame:
    """Per row of ``docs`` the columns ``keep`` (those it has) and ``size``, ``source_size``,
    ``target`` and ``taken``: the words that the mix takes of it, repeats counted.

    Every source is read as often as fits its target in whole passes; the rest is taken in
    hash-random order up to the exact word. The keys' top bits cut a source into ``ranges``
    ranges; range sums give the range that holds the cut, and only that range is sorted, so
    a source with a third of all rows costs no large sort.

    A null text has size 0 and takes 0; a null source is a source of its own, the last. Rows
    that repeat are rows of their own; ties of the key are equal rows, of which any may come
    first. The key hashes id and text, so reruns agree. Other columns are dropped; columns of
    the input that carry an output's name are ignored. No rows, or no words: no rows, or
    targets of 0.
    """
    have = [c for c in keep if c in docs.columns]
    sized = docs.select(
        F.struct(*have).alias("row"),
        "source",
        count_words(F.col("text")).alias("size"),
        random_key(["doc_id", "text"], seed).alias("key"),
    )
    sized = sized.withColumn("range", F.shiftrightunsigned("key", 64 - (ranges - 1).bit_length()))
    if "text" not in have:
        sized = stored(sized, "sized")
    ranged = stored(sized.groupBy("source", "range").agg(F.sum("size").alias("words")), "ranges")
    sizes = ranged.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, copies).withColumn("budget", F.round("target").cast("long"))
    targets = targets.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0))
    targets = targets.withColumn("rest", F.col("budget") - F.col("passes") * F.col("source_size"))
    up_to = Window.partitionBy("source").orderBy("range")
    sums = ranged.withColumn("after", F.sum("words").over(up_to))
    cuts = (
        sums.withColumnRenamed("source", "_source")
        .join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .groupBy("source", "source_size", "target", "passes", "rest")
        .agg(
            F.min(F.when(F.col("after") > F.col("rest"), F.struct("range", (F.col("after") - F.col("words")).alias("before")))).alias("cut")
        )
    )
    cuts = small(stored(cuts.withColumnRenamed("source", "_source"), "cuts"), 50_000)
    placed = sized.join(cuts, F.col("_source").eqNullSafe(F.col("source")))
    room = F.col("rest") - F.col("cut.before")
    in_cut = placed.where(F.col("range") == F.col("cut.range"))
    outside = placed.where((F.col("range") != F.col("cut.range")) | F.col("cut").isNull())
    order = Window.partitionBy("source").orderBy("key", "size", F.col("row.doc_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    once_more = F.greatest(F.least(F.col("size"), room - (F.col("until") - F.col("size"))), F.lit(0))
    result = [F.col("row"), *[F.col(c) for c in ("size", "source_size", "target", "passes")]]
    outside = outside.select(*result, F.when(F.col("range") < F.col("cut.range"), F.col("size")).otherwise(0).alias("extra"))
    in_cut = in_cut.withColumn("until", F.sum("size").over(order)).select(*result, once_more.alias("extra"))
    return outside.unionAll(in_cut).select(
        "row.*", "size", "source_size", "target", (F.col("passes") * F.col("size") + F.col("extra")).cast("long").alias("taken")
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, white space as it is."""
    words = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    return F.array_join(F.slice(words, 1, n.cast("int")), "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, in the columns of ``docs``: a document taken twice is there
    twice, and the one at a source's cut has its last copy cut to the words taken.

    Rows of size 0 (empty or null texts) hold nothing and are left out.
    """
    mixed = mix(docs, **options).where(F.col("taken") > 0)
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    copies = F.filter(
        F.concat(F.array_repeat(F.col("size"), whole), F.array(F.col("taken") - whole * F.col("size"))), lambda n: n > 0
    )
    cut = mixed.withColumn("words", F.explode(copies))
    cut = cut.withColumn("text", F.when(F.col("words") < F.col("size"), first_words(F.col("text"), F.col("words"))).otherwise(F.col("text")))
    cut = cut.withColumn("n_chars", F.char_length("text").cast("long"))
    return cut.select(*[c for c in DOCUMENT_COLUMNS if c in mixed.columns])
