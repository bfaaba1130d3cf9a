"""A quality classifier: cumulative-link regression on graded labels.

One weight per hashed word is shared by all grades, and ordered thresholds part the grades:
P(grade >= j) = sigmoid(score - threshold_j). The fit sees a bounded sample of the labelled
documents; every document is then scored on its whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ids_and_texts, in_slices, stored
from hourloom.llm.words import WordHashes, hashed, split_words

#: Bound of the sample that is fitted: labelled documents, drawn by the hash of their id.
SAMPLE = 20_000
DIMENSIONS = 1 << 18
#: The last buckets, those of a text's shape.
SHAPE = 64
GRADES = 3
BEGINNING = 4
#: Marks that may stand around a word, and signs that prose seldom ends a word in.
MARKS = b".,;:!?\"'()[]|#$%&*@~^=+-_<>/\\"
SIGNS = b"|#$%&*@~^=+_<>/\\"
#: A bucket takes part if its log-likelihood ratio against some grade is at least this.
EVIDENCE = 12.0
CUTOFF = 0.5
#: Weight of the squared weights beside the mean loss; steps of the fit at most; the share of the
#: objective that ten steps must win for it to go on.
DECAY, STEPS, LEAST_GAIN = 1e-4, 1000, 1e-3
#: Entries that the fit works on at once; what it holds of all entries is two short numbers each.
BLOCK = 1 << 17

Model = tuple[np.ndarray, np.ndarray]


def text_features(text: bytes | None, memory: WordHashes, dimensions: int) -> np.ndarray:
    """Buckets of a text: its distinct words and word beginnings, and its shape.

    A beginning is a word's first ``BEGINNING`` bytes; it knows words that are rare themselves
    by their stem. Marks around a word and letter case don't count. The last 64 buckets are
    the shape: eight steps each of the shares of distinct words, of words that are marks only
    and of words that end in a mark; the very last one is that of a text without words.
    """
    words = split_words(text)
    if not words:
        return np.array([dimensions - 1])
    distinct = set(words)
    plain = {w.strip(MARKS).lower() for w in distinct}
    begun = {b"^" + w[:BEGINNING] for w in plain}
    buckets = hashed([*plain, *begun], memory) % np.uint64(dimensions - SHAPE)
    bare = sum(not w.strip(MARKS) for w in words) / len(words)
    marked = sum(w[-1:] in SIGNS for w in words) / len(words)
    shape = [int(7.99 * len(distinct) / len(words)), 8 + int(7.99 * bare), 16 + int(7.99 * marked)]
    return np.concatenate([np.unique(buckets).astype(np.int64), dimensions - SHAPE + np.array(shape)])


def evidence(among: np.ndarray, of_grade: np.ndarray) -> np.ndarray:
    """For each bucket the largest log-likelihood ratio of holding it and being of one grade.

    ``among`` has for each bucket and grade the documents of the grade that hold the bucket,
    ``of_grade`` those of the grade.
    """

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0)

    n, best, held = of_grade.sum(), np.zeros(len(among)), among.sum(1)
    for grade in np.flatnonzero(of_grade):
        here, size = among[:, grade], of_grade[grade]
        cells = [(here, held, size), (held - here, held, n - size), (size - here, n - held, size)]
        cells.append((n - held - size + here, n - held, n - size))
        best = np.maximum(best, 2 * sum(part(seen, a * (b / n)) for seen, a, b in cells))
    return best


def held_by_grade(flat: np.ndarray, grade_of: np.ndarray, dimensions: int, n_grades: int) -> np.ndarray:
    """For each bucket and grade, how often ``flat`` has the bucket for a document of the grade."""
    return np.bincount(flat * n_grades + grade_of, minlength=dimensions * n_grades).reshape(dimensions, n_grades)


def spans(edges: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of segments, in order, that hold about ``BLOCK`` entries or are one segment.

    Segment ``k`` has the entries from ``edges[k]`` to ``edges[k + 1]``.
    """
    cuts = np.minimum(np.searchsorted(edges, np.arange(0, edges[-1] + BLOCK, BLOCK)), len(edges) - 1)
    cuts = np.unique(np.append(cuts, len(edges) - 1)).tolist()
    return list(zip(cuts[:-1], cuts[1:]))


def segment_sums(values: np.ndarray, at: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The sum of ``values[at]`` over each segment (none is empty), a block at a time."""
    sums = np.zeros(len(edges) - 1)
    for a, b in spans(edges):
        sums[a:b] = np.add.reduceat(values[at[edges[a] : edges[b]]], edges[a:b] - edges[a])
    return sums


def link_loss(score: np.ndarray, grades: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """-log P(grade) of each row, with its derivatives by the score and by each threshold.

    P(grade = j) = P(grade >= j) - P(grade >= j + 1), where P(grade >= j) is
    sigmoid(score - threshold_j) for the inner grades, 1 for the least and 0 beyond the last.
    """
    edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
    at_least, beyond = (1 / (1 + np.exp(np.clip(edges[grades + k] - score, -500, 500))) for k in (0, 1))
    share = np.maximum(at_least - beyond, 1e-300)
    lower, upper = at_least * (1 - at_least) / share, beyond * (1 - beyond) / share
    by_threshold = np.zeros((len(score), len(thresholds) + 2))
    rows = np.arange(len(score))
    by_threshold[rows, grades] = lower
    by_threshold[rows, grades + 1] -= upper
    return -np.log(share), upper - lower, by_threshold[:, 1:-1]


class Ordinal:
    """The objective of the fit: mean link loss, documents weighted, and the squared weights.

    ``flat`` has the buckets of all rows, ``row_of`` their rows, ascending. Weights are scaled by how
    often their bucket is there, so that one step size suits all. Beside the two it is given, the
    objective holds one number of ``row_of``'s type for each entry.
    """

    def __init__(self, flat: np.ndarray, row_of: np.ndarray, grades: np.ndarray, emphasis: np.ndarray, buckets: int):
        self.flat, self.grades, self.emphasis, self.buckets = flat, grades, emphasis, buckets
        # Both ways of the sums go over entries that lie together: by row, and by bucket.
        row_at = np.searchsorted(row_of, np.arange(len(grades), dtype=row_of.dtype))
        self.rows = np.flatnonzero(np.diff(row_at, append=len(flat)))
        self.row_edges = np.append(row_at[self.rows], len(flat))
        blocks = [slice(k, k + BLOCK) for k in range(0, len(flat), BLOCK)]
        often = sum((np.bincount(flat[k], minlength=buckets) for k in blocks), np.zeros(buckets, np.int64))
        free = np.cumsum(often) - often
        self.held = np.flatnonzero(often)
        self.held_edges = np.append(free[self.held], len(flat))
        self.row_of = np.empty_like(row_of)
        for k in blocks:
            order = np.argsort(flat[k], kind="stable")
            bucket, here = flat[k][order], np.bincount(flat[k], minlength=buckets)
            self.row_of[(free - np.cumsum(here) + here)[bucket] + np.arange(len(bucket))] = row_of[k][order]
            free += here
        self.scale = 1 / np.sqrt(often / len(grades) + DECAY)

    def at(self, point: np.ndarray) -> tuple[float, np.ndarray]:
        """Value and gradient; infinite where the thresholds are not in order."""
        weights, thresholds, n = point[: self.buckets] * self.scale, point[self.buckets :], len(self.grades)
        if (np.diff(thresholds) <= 0).any():
            return np.inf, point
        score, pull = np.zeros(n), DECAY * weights
        if len(self.flat):
            score[self.rows] = segment_sums(weights, self.flat, self.row_edges)
        loss, by_score, by_threshold = link_loss(score, self.grades, thresholds)
        if len(self.flat):
            pull[self.held] += segment_sums(self.emphasis * by_score, self.row_of, self.held_edges) / n
        push = (self.emphasis[:, None] * by_threshold).mean(0)
        return float((self.emphasis * loss).mean() + DECAY / 2 * weights @ weights), np.concatenate([pull * self.scale, push])

    def least(self, point: np.ndarray, bounded: np.ndarray) -> np.ndarray:
        """The point of least value with ``bounded`` weights at 0 or below, by projected
        gradient steps of spectral length. The objective is convex, so there is one."""
        value, slope = self.at(point)
        step, values = 1.0, [value]
        for _ in range(STEPS):
            aim = point - step * slope
            aim[bounded] = np.minimum(aim[bounded], 0)
            way, part = aim - point, 1.0
            while True:
                there = point + part * way
                there_value, there_slope = self.at(there)
                if there_value <= max(values[-8:]) + 1e-4 * part * (slope @ way) or part < 1e-9:
                    break
                part /= 2
            moved, turned = there - point, there_slope - slope
            bend = moved @ turned
            step = float(np.clip(moved @ moved / bend, 1e-4, 1e4)) if bend > 0 else 1e4
            point, value, slope = there, there_value, there_slope
            values.append(value)
            if part < 1e-9 or (len(values) > 20 and min(values[:-10]) - min(values) <= LEAST_GAIN * abs(value)):
                break
        return point


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, dimensions: int, n_grades: int) -> Model:
    """Weights and thresholds of the cumulative-link model, by its likelihood.

    Documents of a rare grade weigh more. Buckets without ``EVIDENCE`` for any grade keep
    weight 0, so the many words that tell nothing have no say. Words only tell against a
    text: their weights are held at 0 or below, so that a long text can't make up for what
    is wrong with it; the shape's weights are free.
    """
    n = len(rows)
    length = np.array([len(r) for r in rows])
    among = np.zeros((dimensions, n_grades), np.int64)
    for a, b in spans(np.append(0, np.cumsum(length))):
        among += held_by_grade(np.concatenate(rows[a:b]).astype(np.int64), np.repeat(grades[a:b], length[a:b]), dimensions, n_grades)
    used = np.flatnonzero(evidence(among, np.bincount(grades, minlength=n_grades)) >= EVIDENCE)
    # Buckets and rows are numbered anew, in the shortest type that holds them.
    told, place = np.zeros(dimensions, bool), np.zeros(dimensions, np.min_scalar_type(len(used)))
    told[used], place[used] = True, np.arange(len(used))
    parts = [place[r[told[r]]] for r in rows]
    flat, row_of = np.concatenate(parts), np.repeat(np.arange(n, dtype=np.min_scalar_type(n)), [len(p) for p in parts])
    del parts
    share = np.bincount(grades, minlength=n_grades) / n
    emphasis = 1 / np.maximum(share[grades] * (share > 0).sum(), 1e-9)
    objective = Ordinal(flat, row_of, grades, emphasis, len(used))
    start = np.concatenate([np.zeros(len(used)), np.linspace(-1, 1, n_grades - 1)])
    bounded = np.flatnonzero(used < dimensions - SHAPE)
    point = objective.least(start, bounded)
    weights = np.zeros(dimensions)
    weights[used] = point[: len(used)] * objective.scale
    return weights, point[len(used) :]


def tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= j) for every row and j from 1."""
    return 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -50, 50)))


def listed(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32()))


def unlisted(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a list column, and where each row's begin and end."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    edges = column.offsets.to_numpy()
    return column.flatten().to_numpy(), edges - edges[0]


def sample_batches(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for ids, texts, grades in ids_and_texts(batches, "grade"):
            rows = [text_features(t, memory, dimensions) for t in texts]
            # Rows of one id are told apart by their content, for one choice among them.
            keys = [hashlib.sha1(r.tobytes()).hexdigest() for r in rows]
            columns = [pa.array(ids, pa.int64()), pa.array(keys), pa.array(grades, pa.int32()), listed(rows)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "grade", "features"])

    return run


def count_batches(dimensions: int, n_grades: int):
    """For each bucket and grade, the documents of the task: at most all buckets, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        among = np.zeros((dimensions, n_grades), np.int64)
        for batch in in_slices(batches):
            flat, edges = unlisted(batch.column("features"))
            grades = np.repeat(batch.column("grade").to_numpy(), np.diff(edges))
            among += held_by_grade(flat.astype(np.int64), grades, dimensions, n_grades)
        bucket = np.flatnonzero(among.any(1))
        for start in range(0, len(bucket), 1 << 14):
            some = bucket[start : start + (1 << 14)]
            columns = [pa.array(some, pa.int32()), *(pa.array(among[some, g]) for g in range(n_grades))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", *(f"g{g}" for g in range(n_grades))])

    return run


def telling_batches(of_grade: np.ndarray, dimensions: int):
    """The buckets that have ``EVIDENCE``, and those of the shape."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            among = np.stack([batch.column(f"g{g}").to_numpy() for g in range(len(of_grade))], axis=1)
            bucket = batch.column("bucket").to_numpy()
            tells = (evidence(among, of_grade) >= EVIDENCE) | (bucket >= dimensions - SHAPE)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[tells])], ["bucket"])

    return run


def telling(rows: DataFrame, dimensions: int, n_grades: int) -> np.ndarray:
    """Which buckets the fit needs, as flags; counted over the whole feature sets of ``rows``.

    The counts stay in the cluster; what comes to the driver is at most ``dimensions`` numbers.
    """
    of_grade = np.zeros(n_grades, np.int64)
    for r in rows.groupBy("grade").agg(F.count("*").alias("n")).collect():
        of_grade[r["grade"]] = r["n"]
    columns = [f"g{g}" for g in range(n_grades)]
    counts = rows.select("grade", "features").mapInArrow(count_batches(dimensions, n_grades), ", ".join(["bucket int", *(f"{c} long" for c in columns)]))
    counts = counts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])
    flags = np.zeros(dimensions, bool)
    flags[counts.mapInArrow(telling_batches(of_grade, dimensions), "bucket int").toArrow().column("bucket").to_numpy()] = True
    return flags


def telling_features(flags: np.ndarray):
    """The rows of the batches with those of their buckets that are flagged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            flat, edges = unlisted(batch.column("features"))
            rows = [r[flags[r]] for r in (flat[a:b] for a, b in zip(edges[:-1], edges[1:]))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), listed(rows)], ["doc_id", "grade", "features"])

    return run


def fitted(sample: DataFrame, dimensions: int, n_grades: int) -> Model | None:
    """The model of ``sample`` (``doc_id, text, grade``), fitted in one task.

    The sample is bounded by ``SAMPLE`` rows. Evidence is counted over their whole feature
    sets first, and the task gets all of each row's buckets that have it: the model is that
    of the whole sets. It returns one row of ``dimensions`` weights.
    """

    def fit(table: pa.Table) -> pa.Table:
        # Rows are views of the batches as they came; to sort the table would copy it.
        order = pc.sort_indices(table.column("doc_id")).to_numpy()
        lists = [unlisted(chunk) for chunk in table.column("features").chunks]
        rows = [values[a:b] for values, edges in lists for a, b in zip(edges[:-1], edges[1:])]
        grades = table.column("grade").to_numpy()[order].astype(np.int64)
        weights, thresholds = fit_ordinal([rows[k] for k in order], grades, dimensions, n_grades)
        return pa.table({"weights": [weights.astype(np.float32).tobytes()], "thresholds": [thresholds.tobytes()]})

    rows = sample.mapInArrow(sample_batches(dimensions), "doc_id long, key string, grade int, features array<int>")
    # Of rows that repeat an id one is fitted, so the bound holds whatever the table.
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("key", "grade", "features")).alias("row")).select("doc_id", "row.*")
    rows = stored(rows, "features")
    few = rows.select("doc_id", "grade", "features").mapInArrow(telling_features(telling(rows, dimensions, n_grades)), "doc_id long, grade int, features array<int>")
    model = few.groupBy(F.lit(0).alias("all")).applyInArrow(fit, "weights binary, thresholds binary").first()
    return model and (np.frombuffer(model["weights"], np.float32).astype(float), np.frombuffer(model["thresholds"]))


def score_batches(model: Model | None, dimensions: int, cutoff: float):
    packed = model and (model[0].astype(np.float32), model[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in in_slices(batches):
            n = batch.num_rows
            if packed is None:
                expected, tail, keep = pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array([True] * n)
            else:
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                score = np.array([packed[0][text_features(t, memory, dimensions)].sum(dtype=float) for t in texts])
                above = tails(score, packed[1])
                # Probabilities are rounded, so that another order of additions gives the same.
                tail = np.round(above[:, -1], 9)
                expected, keep = pa.array(np.round(above.sum(1), 9)), pa.array(tail >= cutoff)
            names = [*batch.schema.names, "expected_grade", "tail_probability", "selected"]
            yield pa.RecordBatch.from_arrays([*batch.columns, expected, pa.array(tail), keep], names)

    return run


def graded(labels: DataFrame) -> DataFrame:
    """Rows ``doc_id, grade`` from labels: 0 for low quality, 1 for toxic, 2 for good text.

    Labels that are null don't count; of labels that repeat an id the lowest grade holds.
    """
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    rows = labels.select("doc_id", grade.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")
    return rows.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def classify(
    docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE, dimensions: int = DIMENSIONS, cutoff: float = CUTOFF
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, with ``expected_grade``,
    ``tail_probability`` (of the best grade) and ``selected``.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; the ``sample`` labelled documents of
    smallest hashed id are fitted, all documents are scored. A row is selected if its tail
    probability is at least ``cutoff``.

    A null text is an empty one, which has a bucket of its own. Without labelled documents
    both figures are null and everything is selected. Rows that repeat are scored each;
    of the rows of a sampled id one is fitted. Rows without an id are scored. Input columns of the
    outputs' names are not carried; an empty table gives an empty one.
    """
    drawn = graded(labels).orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "grade")
    model = fitted(texts, dimensions, GRADES)
    carried = docs.select(*dict.fromkeys([c for c in keep if c in docs.columns] + ["text"]))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema), "expected_grade double, tail_probability double, selected boolean"])
    scored = carried.mapInArrow(score_batches(model, dimensions, cutoff), schema)
    return scored.select(*[c for c in carried.columns if c in keep], "expected_grade", "tail_probability", "selected")
