"""Packing token pieces into fixed windows by best-fit decreasing."""

from __future__ import annotations

import base64
import json
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import in_slices, small, stored
from hourloom.operators.frames import join_on_keys

VOCABULARY = "byte_bpe_50k"
CAPACITY = 2048
END_ID = 1
#: Pieces that one task packs; enough for windows to fill to the last few.
SHARD_PIECES = 2000
#: Equal pieces beyond which they are dealt to several shards.
EQUAL_PIECES = 200
#: Chunks of text a worker remembers the ids of, in each of two generations.
REMEMBERED = 150_000
#: White space that isn't one plain space or line feed between two other characters.
UNEVEN = re.compile(r"\s\s|[^\S \n]")

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the ranks of the public vocabulary ``name`` are."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


def added_tokens(name: str = VOCABULARY) -> dict[str, int]:
    """Strings that the public tokenizer ``name`` takes as one token each, wherever they stand."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as lines:
        return {token["content"]: token["id"] for token in json.load(lines)["added_tokens"]}


class ChunkIds(dict):
    """Ids, as bytes, of a chunk of text with the space before it.

    Byte-level BPE never merges across the start of a space or line feed that stands alone,
    so the ids of a text are those of its chunks, and chunks come again. A chunk that came
    neither in this generation of the memory nor in the one before is forgotten.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoder = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.older: dict[str, bytes] = {}
        self.remembered = REMEMBERED

    def encoded(self, text: str) -> bytes:
        return np.array(self.encoder.encode_ordinary(text), "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.encoded(chunk if chunk[:1] == "\n" else f" {chunk}")
        if len(self) >= self.remembered:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def of_text(self, text: str) -> bytes:
        """Little-endian 32-bit ids of ``text``, no added tokens among them."""
        if UNEVEN.search(text):
            return self.encoded(text)
        head, *chunks = text.replace("\n", " \n").split(" ")
        return self.encoded(head) + b"".join(map(self.__getitem__, chunks))

    def of_document(self, text: str, added: dict[str, int]) -> bytes:
        """Ids of ``text`` with the ``added`` tokens in it; what is between them is encoded alone."""
        if not any(token in text for token in added):
            return self.of_text(text)
        parts = re.split("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")", text)
        return b"".join(np.array([added[p]], "<u4").tobytes() if k % 2 else self.of_text(p) for k, p in enumerate(parts))


def chunk_ids(path: str) -> ChunkIds:
    """The ids remembered by this worker process, which runs many tasks."""
    memory = sys.modules.setdefault("_worker_memory", types.ModuleType("_worker_memory")).__dict__
    return memory[path] if path in memory else memory.setdefault(path, ChunkIds(path))


def piece_batches(path: str, added: dict[str, int], capacity: int, end_id: int, with_ids: bool, remembered: int):
    """Full windows are cut first, what is left of a document is one more piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, end = chunk_ids(path), np.array([end_id], "<u4").tobytes()
        memory.remembered = remembered
        for batch in in_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = memory.of_document(text or "", added) + end
                total = len(data) // 4
                for start in range(0, total, capacity):
                    ids = data[4 * start : 4 * (start + capacity)]
                    row = (doc_id, start, len(ids) // 4, zlib.crc32(ids), total)
                    rows.append((*row, np.frombuffer(ids, "<i4")) if with_ids else row)
            columns = list(zip(*rows)) or [[]] * (5 + with_ids)
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.list_(pa.int32())) for c in columns[5:]]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * with_ids)

    return run


class OpenWindows:
    """Open windows by room left; a segment tree over the rooms finds the tightest that fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Room and number of the window of least room that is at least ``need``."""
        node = need + self.leaves
        if not self.count[node]:
            # Up to the first right neighbour that holds a window, then down to its left.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.windows[room].pop()


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each length, longest first, each in the tightest open window."""
    order = np.argsort(-lengths, kind="stable")
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    still_open, n = OpenWindows(capacity), 0
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        room, at = still_open.take(length) or (capacity, n)
        n += at == n
        window[i], offset[i] = at, capacity - room
        if room > length:
            still_open.add(room - length, at)
    return window, offset


def packed_shard(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "doc_tokens")])
        window, offset = best_fit(table.column("length").to_numpy(), capacity)
        filled = np.bincount(window, table.column("length").to_numpy()).astype(np.int64)
        padded = np.where(filled & (filled - 1), capacity, filled)
        numbers = (table.column("shard").to_numpy().astype(np.int64) << 32) | window
        table = table.append_column("sequence_id", pa.array(numbers)).append_column("offset", pa.array(offset))
        return table.append_column("sequence_length", pa.array(padded[window])).drop_columns(["shard"])

    return run


def shard_numbers(pieces: DataFrame, shards: int) -> DataFrame:
    """``pieces`` (stored) with ``shard``, by hash; pieces that are equal many times are dealt
    by their rows as well, so no shard gets them all."""
    place = ["doc_id", "start", "ids_crc32"]
    hot = stored(pieces.groupBy(*place).agg(F.count("*").alias("_n")).where(F.col("_n") > EQUAL_PIECES).drop("_n"), "hot")
    tagged = join_on_keys(pieces, small(hot.withColumn("_hot", F.lit(True))), place, "left")
    row = F.when(F.col("_hot"), F.monotonically_increasing_id()).otherwise(0)
    return tagged.withColumn("shard", F.pmod(F.xxhash64(*place, row), F.lit(shards)).cast("int")).drop("_hot")


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    added: dict[str, int] | None = None,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Rows ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_length`` (and ``ids``): every document's tokens, cut in pieces, each placed.

    A document is its byte-level BPE ids and ``end_id``. Pieces lie in their sequence from
    offset 0 without gaps; a sequence is padded to ``capacity`` unless its length is a power
    of two. Pieces are dealt by hash to shards of about ``SHARD_PIECES``, so no task sees all,
    and each shard is packed longest piece first. A worker remembers the ids of at most twice
    ``remembered`` chunks, which changes its speed and memory only.

    The strings of ``added`` tokens (those of the public tokenizer, if not given) are one id
    each, as in the tokenizer. A null text is an empty one: one piece of one id. Rows that
    repeat are packed each; rows without an id are packed under a null id. Other columns are
    ignored; an empty table gives an empty one. Reruns agree on what lies in a sequence, but
    for rows that repeat more than ``EQUAL_PIECES`` times.
    """
    path = vocabulary or vocabulary_path()
    known = added_tokens() if added is None else added
    schema = PIECE + (", ids array<int>" if with_ids else "")
    pieces = docs.select("doc_id", "text").mapInArrow(piece_batches(path, known, capacity, end_id, with_ids, remembered), schema)
    pieces = stored(pieces, "pieces")
    shards = -(-pieces.count() // SHARD_PIECES) or 1
    out = f"{schema}, sequence_id long, offset long, sequence_length long"
    return shard_numbers(pieces, shards).groupBy("shard").applyInArrow(packed_shard(capacity), out)
