"""From raw documents to packed training sequences, one operator per stage.

Each stage takes what the one before kept. ``run`` writes every stage's rows to the shared
folder and reads them back, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourloom.llm import line_dedup, mixing, near_dup, packing, quality
from hourloom.llm.common import DOCUMENT_COLUMNS, SPACE, stored, table
from pyspark.sql import functions as F

#: Rows of an Arrow batch. Its buffers lie outside the heap, beside what earlier stages left there.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Texts go to the workers in small batches; stays set, as frames run after their stage."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on their labels, puts in the best grade."""
    small_batches(spark)
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), keep=tuple(DOCUMENT_COLUMNS))
    return scored.where("selected").select(*DOCUMENT_COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat; those that lose lines and keep white
    space only go. Documents without text that lose no line stay."""
    cut = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_dropped") > 0) & (F.btrim("text", F.lit(SPACE)) == "")
    return cut.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    small_batches(spark)
    return near_dup.one_of_each(docs).select(*DOCUMENT_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight; a document taken twice is there twice."""
    small_batches(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in pieces, placed in sequences, with their ids."""
    small_batches(spark)
    # Workers that ran the other stages hold memory already.
    return packing.pack(docs, with_ids=True, remembered=70_000)


STAGES = [
    ("quality", select_quality),
    ("line_dedup", dedup_lines),
    ("near_dup", dedup_documents),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained model and subword tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
