"""Document fingerprints by winnowing rolling hashes of k code points."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import spread, stored
from hourloom.llm.words import winnowed

GRAM = 12
WINDOW = 16
#: Most ranges that the documents are dealt to, and ranges per partition of an exchange.
MOST_RANGES = 8192
RANGES_EACH = 4
BASE = 0x100000001B3


def code_points(text: bytes | None) -> np.ndarray:
    return np.frombuffer((text or b"").decode("utf-8").encode("utf-32-le"), np.uint32)


def rolling(points: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` consecutive code points, the polynomial built by doubling and mixed."""
    base, total, have = points.astype(np.uint64) + np.uint64(1), None, 0
    span, power = 1, BASE
    while True:
        if gram & span:
            if total is None:
                total, have = base, span
            else:
                n = min(len(total) - span, len(base) - have)
                total, have = total[:n] * np.uint64(power) + base[have : have + n], have + span
        if span * 2 > gram:
            break
        base = base[:-span] * np.uint64(power) + base[span:]
        span, power = span * 2, power * power % 2**64
    mixed = total[: max(0, len(points) - gram + 1)] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


def winnow(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Selected 32-bit hashes and their positions, in order.

    Of every ``window`` consecutive grams the least hash is selected, the rightmost of equal
    ones. Two texts that share ``gram + window - 1`` code points in a row share a selected
    hash. A text shorter than a gram is one gram; an empty one has none.
    """
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    grams = rolling(points, min(gram, len(points)))
    at = winnowed(grams, window)
    return (grams[at] >> np.uint64(32)).astype(np.uint32), at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' hashes; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return common / union if union else 1.0


def written(hashes: np.ndarray) -> str:
    """A fingerprint as text: its hashes in order of position, base64 of 32 bits each."""
    return base64.b64encode(hashes.astype("<u4").tobytes()).decode()


def fingerprint_batches(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [winnow(code_points(t), gram, window) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            columns = [
                batch.column("doc_id"),
                pa.array([h.astype(np.int64) for h, _ in marks], pa.list_(pa.int64())),
                pa.array([p for _, p in marks], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hashes", "positions"])

    return run


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Rows ``doc_id, hashes, positions``: the winnowed fingerprint of every row's text.

    A null or empty text has an empty fingerprint, a text shorter than a gram one hash. Rows
    that repeat are rows of their own; other columns are ignored; no rows give no rows.
    """
    schema = "doc_id long, hashes array<long>, positions array<long>"
    return docs.select("doc_id", "text").mapInArrow(fingerprint_batches(gram, window), schema)


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared_batches(gram: int, window: int):
    """Each document against its edited text and the next document, along a sorted partition.

    Only the document before the current one is held. A range ends with rows marked ``ghost``,
    the first of which is the next document of the range's last one.
    """

    def compare(doc, nxt) -> tuple:
        doc_id, points, marks, text = doc
        n_new = min(len(points) // 3, len(nxt[1]))
        edited = np.concatenate([points[: len(points) - len(points) // 3], nxt[1][:n_new]])
        same = len(edited) == len(points) and np.array_equal(edited, points)
        new_marks = marks if same else winnow(edited, gram, window)[0]
        sha = hashlib.sha256(text if same else edited.astype("<u4").tobytes().decode("utf-32-le").encode()).hexdigest()
        near_next = 1.0 if nxt[3] == text else likeness(marks, nxt[2])
        return doc_id, len(points), sha, written(marks), written(new_marks), likeness(marks, new_marks), near_next

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = held_range = None
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "range", "ghost")]
            for doc_id, part, ghost, text in zip(*columns, batch.column("text").cast(pa.binary()).to_pylist()):
                if ghost and (held is None or held_range != part):
                    continue
                points = code_points(text)
                doc = (doc_id, points, winnow(points, gram, window)[0], text or b"")
                if held is not None and held_range == part:
                    rows.append(compare(held, doc))
                held, held_range = (None, None) if ghost else (doc, part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])],
                [c.split()[0] for c in RESULT.split(", ")],
            )

    return run


def ranges_of(bounds: np.ndarray):
    """The range of each id: ranges descend, ids that are null come last."""

    def run(ids: pa.Array) -> pa.Array:
        known = np.asarray(ids.fill_null(0))
        place = len(bounds) - np.searchsorted(bounds, known, side="right")
        place[np.asarray(ids.is_null())] = len(bounds) + 1
        return pa.array(place, pa.int32())

    return run


def compare_with_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Rows of ``RESULT`` for every row of ``docs``: fingerprints of its text and of its edited
    text, and their likeness.

    In the edited text the last third (rounded down) is replaced by as many first code points
    of the next document, in order of descending id; the last document's next is the first.
    Documents are dealt to id ranges at quantiles, each range gets the first rows of the
    following one, and a range is walked in order; texts travel once.

    A null text is an empty one. Rows that repeat an id follow each other in order of their
    text's hash; rows without an id come last. Equal texts have equal fingerprints. A single
    row is its own next. Other columns are ignored; an empty table gives an empty one.
    """
    docs = docs.select("doc_id", "text")
    n = min(MOST_RANGES, RANGES_EACH * spread(docs.sparkSession))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] if n > 1 else []
    bounds = np.unique(np.array(cuts or [], np.int64))
    placed = docs.withColumn("range", F.arrow_udf(ranges_of(bounds), "int")("doc_id")).withColumn("ghost", F.lit(False))
    heads = placed.groupBy("range").agg(F.max("doc_id").alias("head"))
    # One row per range, of which there are at most MOST_RANGES + 2.
    first = sorted(stored(heads, "heads").collect())
    before = {row["head"]: first[i - 1]["range"] for i, row in enumerate(first)}
    if not before:
        return docs.sparkSession.createDataFrame([], RESULT)
    ghosts = docs.where(F.col("doc_id").isin([h for h in before if h is not None]) | (F.lit(None in before) & F.col("doc_id").isNull()))
    to = docs.sparkSession.createDataFrame([(h, r) for h, r in before.items()], "head long, range int")
    ghosts = ghosts.join(F.broadcast(to), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", "range", F.lit(True).alias("ghost"))
    walked = (
        placed.unionAll(ghosts)
        .repartition(spread(docs.sparkSession), "range")
        .sortWithinPartitions("range", "ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    )
    return walked.mapInArrow(compared_batches(gram, window), RESULT)
