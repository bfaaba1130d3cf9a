"""Line dedup: drop lines that many documents share, all but one occurrence's document.

Lines are exploded to a narrow table (document, position, hashed key), documents are counted
per key, and the positions to drop go back to the documents, which are cut natively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import SPACE, ascii_lower, stored, wide_hash

MIN_KEY = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def dropped_lines(docs: DataFrame, min_key: int = MIN_KEY, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows ``doc_id, version, drops``: the sorted positions that each document loses.

    ``version`` tells rows apart that repeat an id. Keys are counted in two steps, first by
    (key, document), so a line that a third of all documents share is spread over them.
    """
    lines = (
        docs.where("doc_id IS NOT NULL")
        .select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "version", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_key)
        .select("doc_id", "version", "pos", *wide_hash(F.col("key")))
    )
    lines = stored(lines, "lines")
    shared = (
        lines.groupBy("h1", "h2", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )
    return (
        lines.join(shared.select("h1", "h2", "keeper"), ["h1", "h2"])
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy("doc_id", "version")
        .agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    )


def without(lines: Column, drops: Column) -> Column:
    """The array ``lines`` without the positions in the sorted array ``drops``.

    The runs between two dropped positions are sliced out, so the work is one pass over the
    lines, however many are dropped.
    """
    edges = F.concat(F.array(F.lit(-1)), drops, F.array(F.size(lines)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(edges) - 1),
        lambda i: F.slice(lines, F.get(edges, i - 1) + 2, F.get(edges, i) - F.get(edges, i - 1) - 1),
    )
    return F.flatten(runs)


def dedup_lines(docs: DataFrame, min_key: int = MIN_KEY, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` cut, and the columns ``n_lines`` and ``n_dropped``.

    A line's key is the line without white space at its ends and with A-Z lower-cased. A key
    of at least ``min_key`` code points found in at least ``min_docs`` documents loses its
    lines in every document but the one of the largest id.

    A null text counts as one empty line and stays null. Rows that repeat an id are versions
    of one document: they count once, and each keeps or loses its own lines. Rows without an
    id take no part and keep all lines. A column ``n_lines`` or ``n_dropped`` of the input is
    replaced; all others are kept. An empty table gives an empty table.
    """
    drops = dropped_lines(docs.select("doc_id", "text"), min_key, min_docs)
    drops = drops.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("drops").alias("_drops"))
    joined = docs.join(drops, (docs["doc_id"] == drops["_id"]) & (F.xxhash64(docs["text"]) == drops["_version"]), "left")
    lines = F.split(docs["text"], "\n", -1)
    cut = F.when(drops["_drops"].isNull(), docs["text"]).otherwise(F.array_join(without(lines, drops["_drops"]), "\n"))
    n_lines = F.when(docs["text"].isNull(), 1).otherwise(F.size(lines)).cast("long")
    counts = {"n_lines": n_lines, "n_dropped": F.coalesce(F.size(drops["_drops"]), F.lit(0)).cast("long")}
    kept = [cut.alias(c) if c == "text" else docs[c] for c in docs.columns if c not in counts]
    return joined.select(*kept, *[v.alias(k) for k, v in counts.items()])
