"""Raw readers and stage tables."""

import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.plans.yearly import STATION_FILE, next_year, pending_partitions
from hourloom.sources import raw, tables

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def ids(df):
    return sorted(r.id for r in df.collect())


def test_csv_scan_reads_by_name_and_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,id,name\n0,01,one\n0,,\n")
    (tmp_path / "b.csv").write_text('x,id,name\n0,3,"t, hree"\n')
    got = raw.csv_scan(spark, str(tmp_path), ["name", "id"])
    assert got.dtypes == [("name", "string"), ("id", "string")]
    assert sorted(map(tuple, got.collect()), key=repr) == [("one", "01"), ("t, hree", "3"), (None, None)]


def test_csv_scan_refuses_a_shifted_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,one\n")
    (tmp_path / "b.csv").write_text("name,id\ntwo,2\n")
    with pytest.raises(Exception):
        raw.csv_scan(spark, str(tmp_path), ["id", "name"]).collect()


def test_station_map(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text("AirportID,WBAN,TimeZone\n1,03927,-6\n2,3972,0\n")
    got = sorted(tuple(r) for r in raw.station_map(spark, str(path)).collect())
    assert got == [("1", "03927", "UTC-06:00"), ("2", "3972", "UTC")]
    padded = raw.station_map(spark, str(path), pad_key_to=5)
    assert sorted(r.WBAN for r in padded.collect()) == ["03927", "03972"]


def test_station_files(spark, tmp_path):
    for name, v in (("72259003927.csv", 1), ("72259009999.csv", 2), ("700.csv", 3)):
        (tmp_path / name).write_text(f"id\n{v}\n")
    keys = spark.createDataFrame([("03927",), ("3927",)], "WBAN string")
    text = spark.read.csv(str(tmp_path), header=True)
    assert ids(raw.file_key_semi_join(text, keys, "WBAN", STATION_FILE)) == ["1"]
    files = raw.matching_files(spark, str(tmp_path), keys, "WBAN", STATION_FILE)
    assert [f.rsplit("/", 1)[1] for f in files] == ["72259003927.csv"]
    assert ids(raw.csv_scan(spark, files, ["id"])) == ["1"]
    with pytest.raises(ValueError, match="no file"):
        raw.matching_files(spark, str(tmp_path), keys.where("false"), "WBAN", STATION_FILE)


def write_zip(path, members):
    with zipfile.ZipFile(path, "w") as archive:
        for name, content in members.items():
            archive.writestr(name, content)


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "LINES_PER_BATCH", 2)
    write_zip(tmp_path / "1.zip", {"a.csv": 'id,"na me"\n1,"x, y"\n2,z\n3,\n', "readme.html": "id\n9\n"})
    write_zip(tmp_path / "2.zip", {"b.csv": 'id,"na me"\n4,w\n', "empty.txt": ""})
    lines = raw.archive_expand(raw.archive_scan(spark, str(tmp_path / "*.zip")))
    assert sorted((r.member, r.line_no) for r in lines.collect()) == [
        ("a.csv", 0), ("a.csv", 1), ("a.csv", 2), ("a.csv", 3), ("b.csv", 0), ("b.csv", 1)
    ]
    records = raw.archive_records(spark, str(tmp_path / "*.zip"), ["na me", "id"])
    assert sorted(map(tuple, records.collect()), key=lambda r: r[1]) == [
        ("x, y", "1"), ("z", "2"), (None, "3"), ("w", "4")
    ]


def test_archives_with_different_headers_are_refused(spark, tmp_path):
    write_zip(tmp_path / "1.zip", {"a.csv": "id\n1\n", "b.csv": "other\n2\n"})
    with pytest.raises(ValueError, match="one header"):
        raw.archive_records(spark, str(tmp_path / "*.zip"), ["id"])


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "name string, id int")


def test_append_twice_doubles(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.ensure_table(spark, path, SCHEMA)
    assert tables.read_table(spark, path, SCHEMA).count() == 0
    for _ in range(2):
        tables.append_table(frame(spark, ("a", 1)), path, SCHEMA)
    tables.ensure_table(spark, path, SCHEMA)
    assert ids(tables.read_table(spark, path)) == [1, 1]


def test_year_written_twice_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_year(frame(spark, ("a", 1), ("b", 2)), path, SCHEMA, 2012)
    tables.write_year(frame(spark, ("c", 3)), path, SCHEMA, 2013)
    tables.write_year(frame(spark, ("d", 4)), path, SCHEMA, 2012)
    assert ids(tables.read_year(spark, path, SCHEMA)) == [3, 4]
    one = tables.read_year(spark, path, SCHEMA, 2013)
    assert one.schema == SCHEMA and ids(one) == [3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    done = tables.read_year(spark, path, SCHEMA)
    assert sorted(r.year for r in pending_partitions(done, spark, 2011, 2015).collect()) == [2011, 2014, 2015]
    assert next_year(done, spark, 2012, 2024) == 2014
    with pytest.raises(ValueError, match="already processed"):
        next_year(done, spark, 2012, 2013)
    tables.write_year(frame(spark, ("x", 9)).where("false"), path, SCHEMA, 2012)
    assert ids(tables.read_year(spark, path, SCHEMA)) == [3]


def test_years_written_together(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("a", 1, 2012), ("b", 2, 2013)], "name string, id long, year int")
    tables.write_years(both, path, SCHEMA)
    tables.write_years(both.where("year = 2013").withColumn("id", F.lit(7).cast("long")), path, SCHEMA)
    assert sorted((r.id, r.year) for r in tables.read_year(spark, path, SCHEMA).collect()) == [(1, 2012), (7, 2013)]


def test_schema_is_enforced(spark):
    assert tables.enforce_schema(frame(spark, ("a", 1)), SCHEMA).schema == SCHEMA
    assert [tuple(r) for r in tables.enforce_schema(spark.range(1), SCHEMA).collect()] == [(0, None)]
    wider = spark.range(1).select("id", F.lit(1).alias("extra"))
    with pytest.raises(ValueError, match="extra"):
        tables.enforce_schema(wider, SCHEMA)
    assert [tuple(r) for r in tables.enforce_schema(wider, SCHEMA, merge_schema=True).collect()] == [(0, None, 1)]
    with pytest.raises(Exception, match="required to be"):
        tables.enforce_schema(spark.createDataFrame([("x", "a")], "id string, name string"), SCHEMA)


def test_empty_years_are_finished(spark, tmp_path):
    path = str(tmp_path / "finished")
    assert next_year(tables.finished_years(spark, path), spark, 2013, 2015) == 2013
    tables.mark_finished(spark, path, 2013)
    tables.mark_finished(spark, path, 2013)
    assert next_year(tables.finished_years(spark, path), spark, 2013, 2015) == 2014
    assert tables.finished_years(spark, path).count() == 1


def test_audit(spark):
    got = tables.table_audit(frame(spark, ("a", 1), (None, 5)), "id").first().asDict()
    assert got == {"n_rows": 2, "name_nulls": 1, "id_nulls": 0, "min_id": 1, "max_id": 5}
