"""Archives are read back as they were written, by the index and by plain reading."""

import base64
import gzip
import hashlib
import random
from collections import Counter
from types import SimpleNamespace

import pytest

from hourloom.llm import warc
from hourloom.session import scratch_path
from tests.llm.conftest import SMALL

SCHEMA = "page_id long, url string, html string"


def plain(rows, min_bytes):
    """What a page must be read back as, rows of (page_id, url, html)."""
    groups, out = {}, []
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for place, i in enumerate(ids):
            again = place > 0 and len(payload) >= min_bytes
            out.append((i, len(payload), digest, "revisit" if again else "response", ids[0] if again else None))
    return Counter(out)


EDGES = [
    (1, "http://a.example.net/x", "<p>one</p>"),
    (2, "http://a.example.net/x", "<p>one</p>"),
    (2, "http://a.example.net/x", "<p>one</p>"),
    (2, "https://B.example.net/x", "<p>one</p>"),
    (-5, "http://a.example.net/x", "<p>one</p>"),
    (None, "http://a.example.net/x", "<p>one</p>"),
    (None, None, "<p>no id</p>"),
    (None, None, "<p>no id</p>"),
    (3, None, None),
    (4, "", ""),
    (5, "x://h\r\nWARC-Type: revisit\r\n\r\n/ space", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "http://é.example/ü", "é漢\U0001f600 " * 20_000),
    (7, "http://" + "long" * 3_000 + ".net/", "<p>7</p>"),
    (8, "http://" + "long" * 3_000 + ".org/", "<p>8</p>"),
    (-(1 << 63), "no scheme", "<p>least</p>"),
    ((1 << 63) - 1, "http://z/#f", "<p>most</p>"),
]


@pytest.mark.parametrize("min_bytes", [0, 1, 1000])
def test_archive_edges(spark, min_bytes):
    frame = spark.createDataFrame(EDGES, SCHEMA).repartition(3).selectExpr("*", "'x' AS digest", "1 AS row", "'y' AS capture", "0 AS offset")
    assert Counter(map(tuple, warc.archive_pages(frame, min_bytes).collect())) == plain(EDGES, min_bytes)
    assert warc.archive_pages(frame.where("false"), min_bytes).count() == 0


def test_many_equal_rows(spark):
    rows = [(9, "http://same.net/", "same")] * 3000 + [(k, f"http://h{k % 7}.net/{k}", "same" if k % 3 else f"page {k}") for k in range(1500)]
    got = warc.archive_pages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(map(tuple, got)) == plain(rows, 0)


def test_archives_are_plain_members(spark):
    """Every archive and block can be read without the index, and shards hold sorted captures."""
    root = scratch_path(spark, "archives")
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    captures, shards = warc.write_archives(pages, root, block_lines=7, archive_bytes=50_000)
    fs, base = warc.folder(root)
    names = [f.path for f in fs.get_file_info(warc.pafs.FileSelector(base))]
    heads = Counter()
    for name in names:
        if name.endswith(".warc.gz"):
            text = gzip.decompress(fs.open_input_file(name).read())
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
            for kind in (b"warcinfo", b"response", b"revisit"):
                heads[kind] += text.count(b"WARC/1.1\r\nWARC-Type: " + kind + b"\r\n")
    assert heads[b"response"] + heads[b"revisit"] == pages.count() and heads[b"warcinfo"] > 1
    index = warc.Index(root, shards)
    keys = sorted(r.capture.encode() for r in captures.collect())
    assert len(set(keys)) == len(keys) == pages.count()
    random.Random(1).shuffle(keys)
    places = {tuple(index.find(k)) for k in keys}
    assert len(places) == len(keys)
    for missing in (b"", b"~~~", keys[0] + b"0", keys[0][:-1]):
        with pytest.raises(KeyError):
            index.find(missing)


def test_long_equal_beginnings_of_shard_keys(monkeypatch, tmp_path):
    """Shards whose first keys differ only beyond what lookups are given."""
    root, rows = str(tmp_path), [("k" * 600 + f"{i:04d}", "a", i, 1) for i in range(100)]
    shards = []
    for number, part in enumerate((rows[:30], rows[30:60], rows[60:])):
        monkeypatch.setattr(warc.TaskContext, "get", lambda at=number: SimpleNamespace(partitionId=lambda: at))
        batch = warc.pa.RecordBatch.from_pylist([dict(zip(("capture", "archive", "offset", "length"), r)) for r in part])
        shards += [tuple(r.values()) for b in warc.written_shards(root, 8)(iter([batch])) for r in b.to_pylist()]
    index = warc.Index(root, shards)
    assert [int(index.find(r[0].encode())[1]) for r in reversed(rows)] == list(range(99, -1, -1))


def test_damage_is_seen():
    record = warc.page_record({"page_id": 1, "url": None, "digest": hashlib.sha1(b"abc").hexdigest(), "size": 3, "row": 0}, b"abc")
    assert warc.parsed(record)[:2] == (1, 3)
    wrong = warc.page_record({"page_id": 1, "url": None, "digest": hashlib.sha1(b"abc").hexdigest(), "size": 3, "row": 0}, b"abd")
    with pytest.raises(ValueError):
        warc.parsed(wrong)


def test_url_keys(spark):
    urls = ["http://www.Example.net/a?b#c", None, "none", "https://a.b"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(warc.F.col("u"))).collect()]
    assert got == ["net,example,www)/a?b", "", ")", "b,a)"]
