"""Raw files and stage tables. Files are made from the test tables, in the shared folder."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.functions.casts import lenient_double, lenient_int
from hourloom.plans.registry import query, table
from hourloom.plans.stages import Stage, StageRun
from hourloom.plans.yearly import pending_partitions as pending
from hourloom.session import scratch_path
from hourloom.sources import raw, tables

_PART = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]


@query("csv_scan", f"SELECT {', '.join(_PART)} FROM part")
def part_csv(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "part").write.csv(path, header=True)
    text = raw.csv_scan(spark, path, _PART)
    return text.select(
        F.col("p_partkey").try_cast("long").alias("p_partkey"),
        "p_name",
        "p_brand",
        lenient_int("p_size").alias("p_size"),
        lenient_double("p_retailprice").alias("p_retailprice"),
    )


@query(
    "file_key_semi_join",
    """SELECT p_partkey, p_name FROM part
       WHERE p_size IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)""",
)
def parts_of_files(spark, sf):
    """One folder per size; the wanted sizes come from another table."""
    path = scratch_path(spark, "by-size")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    parts.repartition("p_size").write.partitionBy("p_size").csv(path, header=True)
    owing = table(spark, sf, "supplier").where("s_acctbal < 0")
    wanted = owing.select(F.col("s_nationkey").cast("string").alias("size"))
    text = spark.read.csv(path, header=True, enforceSchema=False)
    chosen = raw.file_key_semi_join(text, wanted, "size", r"/p_size=(\d+)/")
    return chosen.select(F.col("p_partkey").try_cast("long").alias("p_partkey"), "p_name")


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]


@query("archive_expand", f"SELECT {', '.join(_CUSTOMER)} FROM customer")
def customer_archives(spark, sf):
    """Customers zipped batch by batch, with a member to skip, and unpacked again."""

    def pack(batches):
        for n, batch in enumerate(batches):
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.html", "no data here\n")
                archive.writestr("customer.csv", batch.to_csv(index=False))
            yield pd.DataFrame({"path": [f"batch-{n}.zip"], "content": [data.getvalue()]})

    zipped = table(spark, sf, "customer").select(_CUSTOMER).mapInPandas(pack, "path string, content binary")
    lines = raw.archive_expand(zipped).where("line_no > 0")
    record = F.from_csv("line", "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE")
    return lines.select(record.alias("r")).select("r.*")


_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]
)
_ORDER_COLUMNS = ", ".join(_ORDERS.names)


@query(
    "enforce_schema",
    "SELECT c_custkey::DOUBLE AS c_custkey, c_nationkey::BIGINT AS c_nationkey, c_name FROM customer",
)
def wider_customer(spark, sf):
    wider = T.StructType(
        [
            T.StructField("c_custkey", T.DoubleType()),
            T.StructField("c_nationkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
        ]
    )
    return tables.enforce_schema(table(spark, sf, "customer").select("c_name", "c_nationkey", "c_custkey"), wider)


@query("table_round_trip", f"SELECT {_ORDER_COLUMNS}, year(o_orderdate)::INTEGER AS year FROM orders")
def orders_by_year(spark, sf):
    """All years written, one of them again: the table is the same as after one write."""
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders").select(_ORDERS.names)
    tables.write_years(orders.withColumn("year", F.year("o_orderdate")), path, _ORDERS)
    tables.write_year(orders.where(F.year("o_orderdate") == 1997), path, _ORDERS, 1997)
    return tables.read_year(spark, path, _ORDERS)


@query("table_append", f"SELECT {_ORDER_COLUMNS} FROM orders")
def orders_appended(spark, sf):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders").select(_ORDERS.names)
    tables.ensure_table(spark, path, _ORDERS)
    tables.append_table(orders.where("o_orderstatus <=> 'F'"), path, _ORDERS)
    tables.append_table(orders.where("NOT o_orderstatus <=> 'F'"), path, _ORDERS)
    tables.ensure_table(spark, path, _ORDERS)
    return tables.read_table(spark, path, _ORDERS)


@query(
    "schema_evolution_write",
    f"""SELECT {_ORDER_COLUMNS}, CASE WHEN o_orderstatus IS DISTINCT FROM 'F' THEN o_totalprice > 100000 END AS is_large
        FROM orders""",
)
def orders_with_a_new_column(spark, sf):
    """Old files and files with one more column, read back as one table."""
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders")
    narrow, wider = orders.select(_ORDERS.names), orders.select(*_ORDERS.names, (F.col("o_totalprice") > 100000).alias("is_large"))
    tables.append_table(narrow.where("o_orderstatus <=> 'F'"), path, _ORDERS)
    tables.append_table(wider.where("NOT o_orderstatus <=> 'F'"), path, _ORDERS, merge_schema=True)
    return tables.read_table(spark, path, merge_schema=True)


@query(
    "table_audit",
    """SELECT count(*) AS n_rows, count(*) - count(o_orderkey) AS o_orderkey_nulls,
              count(*) - count(nullif(o_orderstatus, 'P')) AS o_orderstatus_nulls,
              count(*) - count(o_orderdate) AS o_orderdate_nulls,
              min(o_orderdate)::TIMESTAMP AS min_o_orderdate, max(o_orderdate)::TIMESTAMP AS max_o_orderdate
       FROM orders""",
)
def orders_audit(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"), "o_orderdate"
    )
    return tables.table_audit(orders, "o_orderdate")


@query(
    "pending_partitions",
    """SELECT y::INTEGER AS year FROM range(1992, 2013) t(y)
       WHERE y NOT IN (SELECT year(o_orderdate) FROM orders)""",
)
def years_to_do(spark, sf):
    done = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return pending(done, spark, 1992, 2012)


_DAYS = T.StructType([T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("largest", T.DoubleType())])


@query(
    "stage_audits",
    """WITH days AS (
         SELECT o_orderdate, max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS largest FROM orders GROUP BY 1
       )
       SELECT 'by_day' AS name, count(*) AS n_rows, NULL::BIGINT AS status_nulls,
              count(*) - count(largest) AS largest_nulls,
              min(o_orderdate)::TIMESTAMP AS first_ts, max(o_orderdate)::TIMESTAMP AS last_ts FROM days
       UNION ALL
       SELECT 'orders', count(*), count(*) - count(nullif(o_orderstatus, 'P')), NULL,
              min(o_orderdate)::TIMESTAMP, max(o_orderdate)::TIMESTAMP FROM orders""",
)
def audits_of_stages(spark, sf):
    """Two stages, run one after the other by two runs; the second finds the first's table done."""
    path = scratch_path(spark, "stages")
    stages = {
        "orders": Stage({"orders": _ORDERS}, ts="o_orderdate"),
        "by_day": Stage({"by_day": _DAYS}, ("orders",), "o_orderdate"),
    }

    def orders():
        known = F.nullif(F.col("o_orderstatus"), F.lit("P"))
        return {"orders": table(spark, sf, "orders").select(_ORDERS.names).withColumn("o_orderstatus", known)}

    def by_day(done):
        price = F.when(F.col("o_orderstatus").isNotNull(), F.col("o_totalprice"))
        return {"by_day": done.groupBy("o_orderdate").agg(F.max(price).alias("largest"))}

    StageRun(spark, path, 1, stages, only=["orders"]).run("orders", orders)
    resumed = StageRun(spark, path, 1, stages, resume=True)
    done = resumed.run("orders", orders)["orders"]
    resumed.run("by_day", lambda: by_day(done))
    return tables.audits(spark, resumed.path(tables.AUDIT)).select(
        "name",
        "n_rows",
        F.col("nulls")["o_orderstatus"].alias("status_nulls"),
        F.col("nulls")["largest"].alias("largest_nulls"),
        F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
        F.col("last_ts").cast("timestamp_ntz").alias("last_ts"),
    )
