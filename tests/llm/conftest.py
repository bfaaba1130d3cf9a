import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    return frame, [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
