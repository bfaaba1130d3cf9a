"""Raw file readers. Everything is read as text and typed later, column by column."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.functions.casts import lenient_int
from hourloom.functions.times import offset_to_zone
from hourloom.schemas import STATION_MAP_FILE

LINES_PER_BATCH = 20_000


def csv_scan(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """Headered CSV files as text columns, chosen by name.

    Types are not inferred: that is a second pass over the data, and the types would
    depend on it. Files whose header differs from the first are an error, not a shift.
    """
    return spark.read.csv(path, header=True, enforceSchema=False).select(*columns)


def station_map(spark: SparkSession, path: str, pad_key_to: int | None = None) -> DataFrame:
    """Airport, weather station and time zone; the file gives the zone as whole hours.

    Station ids that lost their leading zeros match no reading unless ``pad_key_to``
    restores their length.
    """
    raw = spark.read.schema(STATION_MAP_FILE).csv(path, header=True)
    if pad_key_to:
        raw = raw.withColumn("WBAN", F.lpad("WBAN", pad_key_to, "0"))
    return raw.withColumn("TimeZone", offset_to_zone(lenient_int("TimeZone")))


def file_key(pattern: str, path: Column | None = None) -> Column:
    """First group of ``pattern`` in the path of the file a row was read from."""
    source = path if path is not None else F.col("_metadata.file_path")
    return F.regexp_extract(source, pattern, 1)


def file_key_semi_join(df: DataFrame, keys: DataFrame, key_col: str, pattern: str) -> DataFrame:
    """Rows of the files whose key, cut from the path, is one of ``keys``."""
    columns = df.columns
    wanted = keys.select(F.col(key_col).alias("_key"))
    tagged = df.select(*columns, file_key(pattern).alias("_file_key"))
    return tagged.join(wanted, F.col("_file_key") == F.col("_key"), "left_semi").select(*columns)


def matching_files(spark: SparkSession, path: str, keys: DataFrame, key_col: str, pattern: str) -> list[str]:
    """Paths of the files below ``path`` whose key is one of ``keys`` (an action).

    Only names travel to the driver, which lists the files of a scan anyway; files of
    other keys are then never opened. ``file_key_semi_join`` drops their rows instead.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    tagged = listed.withColumn("_file_key", file_key(pattern, F.col("path")))
    wanted = keys.select(F.col(key_col).alias("_key"))
    found = tagged.join(wanted, F.col("_file_key") == F.col("_key"), "left_semi").select("path").collect()
    if not found:
        raise ValueError(f"no file below {path} belongs to a known key")
    return sorted(r["path"] for r in found)


ARCHIVE_LINES = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("line", T.StringType()),
    ]
)


def archive_scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per archive file: ``path`` and ``content``."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def archive_expand(archives: DataFrame, suffix: str = ".csv", headers_only: bool = False) -> DataFrame:
    """Lines of the members whose name ends in ``suffix``, numbered from 0 per member.

    Members are unpacked as a stream inside the tasks and leave in bounded batches.
    ``headers_only`` stops after the first line of each member.
    """

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        if member.endswith(suffix):
                            yield from member_lines(path, archive, member)

    def member_lines(path: str, archive: zipfile.ZipFile, member: str) -> Iterator[pd.DataFrame]:
        with archive.open(member) as raw:
            start, lines = 0, []
            for line in io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="\n"):
                lines.append(line.rstrip("\r\n"))
                if headers_only:
                    break
                if len(lines) == LINES_PER_BATCH:
                    yield frame(path, member, start, lines)
                    start, lines = start + len(lines), []
            if lines:
                yield frame(path, member, start, lines)

    def frame(path: str, member: str, start: int, lines: list[str]) -> pd.DataFrame:
        return pd.DataFrame(
            {"archive": path, "member": member, "line_no": range(start, start + len(lines)), "line": lines}
        )

    return archives.select("path", "content").mapInPandas(expand, ARCHIVE_LINES)


def archive_records(spark: SparkSession, path: str, columns: Sequence[str], suffix: str = ".csv") -> DataFrame:
    """CSV members of archives as text columns, like ``csv_scan`` on the unpacked files.

    The header is looked up first (an action on the first line of each member); all
    members must share it.
    """
    archives = archive_scan(spark, path)
    headers = archive_expand(archives, suffix, headers_only=True).select("line").distinct().limit(2).collect()
    if len(headers) != 1:
        raise ValueError(f"expected one header over all members of {path}, found {len(headers)}")
    names = [n.replace("`", "``") for n in next(csv.reader([headers[0]["line"]]))]
    record = F.from_csv("line", ", ".join(f"`{n}` STRING" for n in names))
    lines = archive_expand(archives, suffix).where("line_no > 0")
    return lines.select(record.alias("r")).select(*[F.col("r")[c].alias(c) for c in columns])
