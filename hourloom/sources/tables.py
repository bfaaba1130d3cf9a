"""Stage tables: declared schemas, one partition per year, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

YEAR = "year"
#: Folder of the audit rows below that of the tables.
AUDIT = "audit"
AUDITS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField(YEAR, T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("nulls", T.MapType(T.StringType(), T.LongType())),
        T.StructField("first_ts", T.TimestampType()),
        T.StructField("last_ts", T.TimestampType()),
    ]
)


def enforce_schema(df: DataFrame, schema: T.StructType, merge_schema: bool = False) -> DataFrame:
    """Columns in the declared order and type.

    A missing column comes out null, and a type without an implicit cast (text to number)
    is an error. So is an extra column, unless ``merge_schema`` keeps it after the others.
    """
    extra = [f for f in df.schema if f.name not in schema.names]
    if extra and not merge_schema:
        raise ValueError(f"columns that the table does not have: {[f.name for f in extra]}")
    return df.to(T.StructType([*schema.fields, *extra]))


def with_year(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(YEAR, T.IntegerType())])


def mark_finished(spark: SparkSession, path: str, year: int) -> None:
    """Record that a year was run to its end, with or without rows; twice is as once."""
    row = spark.createDataFrame([(year,)], f"{YEAR} int")
    row.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={year}")


def unmark_finished(spark: SparkSession, path: str, year: int) -> None:
    """Take the record back, if there is one: the year is being run again."""
    remove(spark, f"{path.rstrip('/')}/run={year}")


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is at ``path``, if anything; an error if it stays."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True) and exists(spark, path):
        raise OSError(f"{path} can't be deleted")


def finished_years(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``year`` of what ``mark_finished`` recorded at ``path``; none if it is new."""
    schema = T.StructType([T.StructField(YEAR, T.IntegerType())])
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(YEAR)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Create an empty table unless something is at ``path`` already."""
    spark.createDataFrame([], schema).write.format(fmt).mode("ignore").save(path)


def append_table(
    df: DataFrame, path: str, schema: T.StructType, fmt: str = "parquet", merge_schema: bool = False
) -> None:
    """Add rows; running it twice adds them twice.

    With ``merge_schema`` new columns are added to the table; older rows have nulls there
    where the table is read with ``merge_schema``.
    """
    enforce_schema(df, schema, merge_schema).write.format(fmt).mode("append").save(path)


def write_year(df: DataFrame, path: str, schema: T.StructType, year: int, fmt: str = "parquet") -> None:
    """Replace one year of a table, also by nothing: running it twice changes nothing."""
    enforce_schema(df, schema).write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/{YEAR}={year}")


def write_years(df: DataFrame, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Replace the years that occur in the column ``year`` of ``df``, and leave the others."""
    (
        enforce_schema(df, with_year(schema))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(YEAR)
        .save(path)
    )


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    reader = spark.read.format(fmt).option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_year(
    spark: SparkSession, path: str, schema: T.StructType, year: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """One year of a table (only its files are read), or all years with the column ``year``."""
    table = read_table(spark, path, with_year(schema), fmt)
    return table if year is None else table.where(F.col(YEAR) == year).drop(YEAR)


def table_audit(df: DataFrame, ts: str | None = None) -> DataFrame:
    """One row: number of rows, nulls per column, first and last ``ts``."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns]
    if ts:
        aggs += [F.min(ts).alias(f"min_{ts}"), F.max(ts).alias(f"max_{ts}")]
    return df.agg(*aggs)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def write_audited(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    year: int,
    record: str,
    name: str,
    fmt: str = "parquet",
    ts: str | None = None,
) -> None:
    """``write_year``, and then one row of ``AUDITS`` at ``record``, counted on what was stored.

    The row comes after the table: where it is, the table was written to its end and can be
    read. ``ts`` is a column whose first and last value are kept, where the table has it; null
    without rows. The counts are a scan of the new files. An ``Observation`` of the write would
    save it, but in a session that has made one no fitted classifier can score any more: the
    model's summary holds the session, which then can't be sent to the tasks.
    """
    write_year(df, path, schema, year, fmt)
    kept = read_year(df.sparkSession, path, schema, year, fmt)
    nulls = [x for c in schema.names for x in (F.lit(c), F.count_if(F.col(c).isNull()))]
    known = ts is not None and ts in schema.names
    ends = [end(ts).cast("timestamp") if known else F.lit(None).cast("timestamp") for end in (F.min, F.max)]
    audit = kept.agg(
        F.lit(name).alias("name"),
        F.lit(year).cast("int").alias(YEAR),
        F.count(F.lit(1)).alias("n_rows"),
        F.create_map(*nulls).alias("nulls"),
        ends[0].alias("first_ts"),
        ends[1].alias("last_ts"),
    )
    audit.write.mode("overwrite").parquet(record)


def audits(spark: SparkSession, path: str) -> DataFrame:
    """The audit rows below ``path``, one of each table and year; none if it is new."""
    if not exists(spark, path):
        return spark.createDataFrame([], AUDITS)
    return spark.read.schema(AUDITS).option("recursiveFileLookup", "true").parquet(path)
