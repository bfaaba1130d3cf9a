"""Every query against its SQL in DuckDB, on the smallest test tables."""

import glob
import os

import duckdb
import pytest

from hourloom.plans.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def bag(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_only_the_forest_on_embeddings_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"rf_train_score"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = bag(cursor.fetchall(), columns)
    got = bag([tuple(r) for r in df.collect()], df.columns)
    assert got == expected


def test_forest_scores_every_test_row(spark):
    scored = QUERIES["rf_train_score"](spark, SF_DIR)
    rows = scored.collect()
    assert rows and all(0 <= r.probability <= 1 and r.prediction in (0.0, 1.0) for r in rows)
    assert len({r.vec_id for r in rows}) == len(rows)
