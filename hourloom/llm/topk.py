"""Exact top-k by inner product in three phases with one uniform threshold.

A vector's dimensions are cut into lists; a score is the sum of one partial score per list.
Phase 1 gathers, per query and list, the k best partial scores of every block of vectors, and
scores only those heads: the k-th best is a cutoff that the answer can't be below. A vector
that reaches the cutoff has at least one partial score of cutoff / lists, so phase 2 collects
the entries over that threshold, and phase 3 adds their other lists and keeps what reaches the
cutoff.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import stored

LISTS = 4
QUERY_BLOCK = 1024
VECTOR_BLOCK = 2048
#: Largest sum of products that is exact in doubles, and in 64-bit integers.
EXACT_DOUBLE, EXACT_LONG = 2.0**53, 2.0**62
LEAST, MOST = -(2**63), 2**63 - 1


def quantized(vectors: pd.Series) -> np.ndarray:
    """floor(256 x) of every component, one row per vector."""
    return np.floor(256.0 * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def reach(a: np.ndarray, b: np.ndarray) -> float:
    """No sum of products of a row of ``a`` and a row of ``b`` is larger, nor is a part of one."""
    return float(np.abs(a).sum(1).max(initial=0)) * float(np.abs(b).max(initial=0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``, as 64-bit integers.

    Doubles hold them exactly while no partial sum can reach 2**53, which is checked; larger
    components are multiplied as integers, the largest as Python's, clipped to 64 bits.
    """
    most = reach(a, b)
    if most < EXACT_DOUBLE:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side] for side in (a, b)]
    if most < EXACT_LONG:
        left, right = (np.array(side, dtype=np.int64) for side in whole)
        return left @ right.T
    wide = np.array(whole[0], dtype=object).dot(np.array(whole[1], dtype=object).T)
    return np.clip(wide, LEAST, MOST).astype(np.int64)


class LocalLists:
    """The partial scores of one block pair, a list per run of dimensions."""

    def __init__(self, q: np.ndarray, v: np.ndarray, lists: int):
        self.q, self.v, self.lists = q, v, lists
        self.partial = [products(a, b) for a, b in zip(np.array_split(q, lists, axis=1), np.array_split(v, lists, axis=1))]
        self.summable = reach(q, v) < EXACT_LONG

    def resolved(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact scores of query ``rows[i]`` and vector ``at[i]``, from all their lists."""
        if self.summable:
            return sum(p[rows, at] for p in self.partial)
        pairs = [products(self.q[r : r + 1], self.v[c : c + 1])[0, 0] for r, c in zip(rows, at)]
        return np.array(pairs, dtype=np.int64)

    def heads(self, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and vectors that are among the k first of a list, each pair once, without ``own``."""
        k = min(k, self.v.shape[0])
        chosen = np.zeros(own.shape, bool)
        for p in self.partial:
            first = np.argpartition(np.where(own, LEAST, p), own.shape[1] - k, axis=1)[:, own.shape[1] - k :]
            np.put_along_axis(chosen, first, True, axis=1)
        return np.nonzero(chosen & ~own)

    def over(self, cutoff: np.ndarray) -> np.ndarray:
        """Which pairs have an entry of at least cutoff / lists in some list."""
        floor = cutoff.astype(np.float64)[:, None]
        # A little below cutoff / lists: rounding must not lose an entry.
        threshold = np.where(cutoff[:, None] == LEAST, -np.inf, floor / self.lists - 1 - np.abs(floor) * 1e-9)
        found = np.zeros(self.partial[0].shape, bool)
        for p in self.partial:
            found |= p >= threshold
        return found


def first_k(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each row: highest score, then smallest id."""
    # ~x turns the order of integers round and, unlike -x, holds the least one.
    order = np.lexsort((ids, ~scores, rows))
    ordered = rows[order]
    starts = np.flatnonzero(np.diff(ordered, prepend=-1))
    place = np.arange(len(ordered)) - np.repeat(starts, np.diff(starts, append=len(ordered)))
    return order[place < k]


def list_heads(k: int, lists: int):
    """Phase 1 of one block pair: exact scores of the heads of each query's local lists."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_row": [], "score": []}).astype("int64")
        asked, row = left["row"].to_numpy(), right["row"].to_numpy()
        block = LocalLists(quantized(left["embedding"]), quantized(right["embedding"]), lists)
        rows, at = block.heads(asked[:, None] == row[None, :], k)
        score = block.resolved(rows, at)
        best = first_k(rows, score, row[at], k)
        return pd.DataFrame({"query_row": asked[rows[best]], "score": score[best]})

    return run


def entries_over(k: int, lists: int):
    """Phases 2 and 3 of one block pair: entries over the threshold, their scores completed.

    What stays below the cutoff goes. Of the rest no more than k of one block can be in the
    answer, so the k best leave the block.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        asked, row, ids, cutoff = left["row"].to_numpy(), right["row"].to_numpy(), right["vec_id"].to_numpy(), left["cutoff"].to_numpy()
        block = LocalLists(quantized(left["embedding"]), quantized(right["embedding"]), lists)
        rows, at = np.nonzero(block.over(cutoff) & (asked[:, None] != row[None, :]))
        score = block.resolved(rows, at)
        reached = score >= cutoff[rows]
        rows, at, score = rows[reached], at[reached], score[reached]
        best = first_k(rows, score, ids[at], k)
        found = {"query_row": asked[rows[best]], "query_id": left["vec_id"].to_numpy()[rows[best]], "vec_id": ids[at[best]], "score": score[best]}
        return pd.DataFrame(found)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that can be scored, each with a number ``row`` that holds once they are stored."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .where(finite)
        .select("vec_id", "embedding", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("row"))
    )


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, lists: int = LISTS) -> DataFrame:
    """Rows ``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``
    the ``k`` other rows of the highest inner product of floor(256 x), ties to the smaller id;
    all others, if they are fewer.

    Queries and vectors are dealt in blocks; a block pair is one task's work, and sends at
    most ``k`` rows per query. Vectors that are null, or hold a null or a component that isn't
    finite, take no part, nor do rows without an id. Rows that repeat an id are rows like any
    other: each is a candidate, also for the others of its id, and each is a query of its own,
    so the ranks of their id are there once for each. Vectors are compared with those of their
    own length. Other columns are ignored; an empty table gives an empty result. A score beyond
    64 bits is clipped.
    """
    usable_vectors = stored(usable(vectors), "vectors")
    is_query = F.col("vec_id") % every == 0
    counts = usable_vectors.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks, query_blocks = (max(1, -(-n // size)) for n, size in ((counts["n"], VECTOR_BLOCK), (counts["q"], QUERY_BLOCK)))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64(F.lit(5), "row"), F.lit(query_blocks)).cast("int")
    dealt = usable_vectors.withColumn("vb", block).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    # Aliases, so the two sides of a block pair are told apart.
    queries = usable_vectors.where(is_query).select(*[F.col(c).alias(c) for c in ("vec_id", "embedding", "dim", "row")]).withColumn("qb", query_block)
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    pair = ["dim", "qb", "vb"]
    best = Window.partitionBy("query_row").orderBy(F.desc("score"))

    heads = queries.withColumn("vb", every_block).groupBy(*pair).cogroup(dealt.groupBy(*pair)).applyInPandas(list_heads(k, lists), "query_row long, score long")
    cutoffs = heads.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    cutoffs = stored(cutoffs.select(F.col("query_row").alias("row"), F.col("score").alias("cutoff")), "cutoffs")
    bound = queries.join(cutoffs, "row", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(LEAST)))
    found = (
        bound.withColumn("vb", every_block)
        .groupBy(*pair)
        .cogroup(dealt.groupBy(*pair))
        .applyInPandas(entries_over(k, lists), "query_row long, query_id long, vec_id long, score long")
    )
    ranked = found.withColumn("rank", F.row_number().over(best.orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
