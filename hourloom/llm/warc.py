"""WARC archives with a two-level index of their captures.

1. Payloads are grouped by digest; of each group one record holds the payload, the others
   refer to it. A payload that is alone goes from the scan to its archive without a shuffle.
2. Each task writes gzip members, one per record, to archives in the shared folder.
3. The captures are sorted by URL with its host reversed and written as index shards: blocks
   of lines, each compressed, and behind them the shard's sparse directory of the blocks.
4. A capture is looked up by binary search: over the shards' first keys, over the shard's
   directory, over the lines of one block. The records found are read in the archives' order,
   neighbours in one range read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, in_slices, small, spread, stored
from hourloom.session import scratch_path

#: Bytes after which a task begins another archive.
ARCHIVE_BYTES = 1 << 30
#: Lines of one compressed block of the index.
BLOCK_LINES = 1000
#: Characters of a shard's first key that every lookup task gets; the rest is in the shard.
KEY_CHARS = 512
#: A range read ends at a gap or a size beyond these.
READ_GAP, READ_BYTES = 64 << 10, 8 << 20
#: Pages bear no date of capture.
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "capture string, archive string, offset long, length long"
READ_BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
UNSAFE = re.compile(r"[\x00-\x20\x7f-\x9f]")


def url_key(url: Column) -> Column:
    """The URL with its host's labels reversed, scheme and fragment dropped; sorts a domain's
    pages together. White space and control characters become ``_``."""
    host = ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.regexp_replace(F.coalesce(key, F.lit("")), r"[\x00-\x20\x7f]", "_")


def fixed_hex(number: Column) -> Column:
    """A long as 16 hex digits that sort as the numbers do; null sorts first."""
    return F.coalesce(F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lit("-"))


def with_payload_groups(pages: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Every page without its payload, judged; and the groups of equal payloads.

    Judged: ``page_id, url, key, digest, size, row, head_id, head_row, revisit``. A group's
    head is the row of its largest page_id, of rows that repeat it one. ``row`` is 0 for a
    payload that is alone, and tells the rows of a group apart.
    """
    bare = stored(pages.select("page_id", "url", url_key(F.col("url")).alias("key"), *payload_columns()), "captures")
    bare = bare.withColumn("row", F.monotonically_increasing_id() + 1)
    bare = stored(bare, "rows")
    same = ["digest", "size"]
    groups = bare.groupBy(*same).agg(F.count("*").alias("n"), F.max("page_id").alias("head_id")).where("n > 1").drop("n")
    groups = stored(groups, "groups")
    heads = bare.join(small(groups), same).where(F.col("page_id").eqNullSafe(F.col("head_id")))
    heads = stored(heads.groupBy(*same, "head_id").agg(F.max("row").alias("head_row")), "heads")
    judged = bare.join(small(heads), same, "left").withColumns(
        {
            "revisit": F.coalesce((F.col("size") >= min_bytes) & (F.col("row") != F.col("head_row")), F.lit(False)),
            "row": F.when(F.col("head_row").isNull(), 0).otherwise(F.col("row")),
        }
    )
    return stored(judged, "judged"), heads


def payload_columns() -> list[Column]:
    payload = F.coalesce("html", F.lit(""))
    return [F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("size")]


def capture_key() -> Column:
    return F.concat_ws(" ", "key", fixed_hex(F.col("page_id")), "digest", fixed_hex(F.col("row"))).alias("capture")


def archive_records(pages: DataFrame, judged: DataFrame, heads: DataFrame) -> DataFrame:
    """What each record is made of; only records that hold a payload bring ``html``."""
    same = ["digest", "size"]
    nothing = {c: F.lit(None).cast("long") for c in ("head_id", "head_row")}
    alone = pages.select("page_id", "url", url_key(F.col("url")).alias("key"), *payload_columns(), "html")
    alone = alone.join(small(heads), same, "left_anti").withColumns({**nothing, "row": F.lit(0).cast("long"), "revisit": F.lit(False)})
    copies = judged.where("head_row IS NOT NULL")
    revisits = copies.where("revisit").withColumn("html", F.lit(None).cast("string"))
    payloads = pages.select("page_id", *payload_columns(), "html").join(small(heads.select(*same, "head_id")), same)
    payloads = payloads.where(F.col("page_id").eqNullSafe(F.col("head_id"))).dropDuplicates(same).select(*same, "html")
    holders = copies.where("NOT revisit").join(payloads, same)
    columns = ["page_id", "url", "digest", "size", "row", "head_id", "head_row", "revisit", "html", capture_key()]
    return alone.select(*columns).unionAll(revisits.select(*columns)).unionAll(holders.select(*columns))


def base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record_id(page_id: int | None, digest: str, row: int) -> str:
    return f"<urn:page:{'-' if page_id is None else page_id}:{digest}:{row}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    record = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def page_record(row: dict, payload: bytes | None) -> bytes:
    """The record of a page: a response with its payload, or a revisit of another's."""
    headers = [("WARC-Type", "response" if payload is not None else "revisit")]
    headers.append(("WARC-Record-ID", record_id(row["page_id"], row["digest"], row["row"])))
    headers.append(("WARC-Date", DATE))
    if row["url"] is not None:
        # A line break in a URL must not begin another header.
        headers.append(("WARC-Target-URI", UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", row["url"])))
    headers.append(("WARC-Payload-Digest", f"sha1:{base32(row['digest'])}"))
    if payload is None:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(row["head_id"], row["digest"], row["head_row"]))]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    # Of a revisit too, the length here is that of the whole payload.
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n"
    return member(headers, answer.encode() + (payload or b""))


def folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder; any that pyarrow reaches (file, hdfs, s3, gs...)."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def written_archives(root: str, archive_bytes: int):
    """Archives of the batches' records, and where each record lies.

    A name is used by one attempt of one task, so what a lost attempt leaves is never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = folder(root)
        fs.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in in_slices(batches):
            payloads = batch.column("html").cast(pa.binary()).to_pylist()
            captures, places = batch.column("capture"), []
            for row, payload in zip(batch.drop_columns(["html", "capture"]).to_pylist(), payloads):
                if out is None or at >= archive_bytes:
                    if out:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    first = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Filename", name)], b"")
                    out.write(first)
                    at = len(first)
                data = page_record(row, None if row["revisit"] else payload or b"")
                out.write(data)
                places.append((name, at, len(data)))
                at += len(data)
            names, offsets, lengths = zip(*places) if places else ([], [], [])
            arrays = [captures, pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in CAPTURE.split(", ")])
        if out:
            out.close()

    return run


def written_shards(root: str, block_lines: int):
    """One index shard of the batches' sorted captures: blocks, then their directory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = folder(root)
        fs.create_dir(base, recursive=True)
        # Names follow the order of the ranges, which tells shards apart whose first keys begin alike.
        out, name, at, lines, directory = None, f"{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}.cdx", 0, [], []

        def end_block() -> int:
            data = zlib.compress("\n".join(lines).encode())
            out.write(data)
            directory.append(f"{lines[0].split(chr(9))[0]}\t{at}\t{len(data)}")
            lines.clear()
            return len(data)

        for batch in in_slices(batches):
            out = out or fs.open_output_stream(f"{base}/{name}", compression=None)
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append("\t".join(map(str, values)))
                if len(lines) >= block_lines:
                    at += end_block()
        if out:
            if lines:
                at += end_block()
            data = zlib.compress("\n".join(directory).encode())
            out.write(data)
            out.close()
            first = directory[0].split("\t")[0][:KEY_CHARS]
            yield pa.RecordBatch.from_pylist([{"first": first, "shard": name, "offset": at, "length": len(data)}])

    return run


class Index:
    """Lookups in index shards; keeps the directory and the block that were used last.

    ``shards`` has rows (beginning of the first key, file, place and length of the directory).
    Keys are compared as UTF-8, which is how the engine sorts them.
    """

    def __init__(self, root: str, shards: list[tuple[str, str, int, int]]):
        self.fs, self.base = folder(root)
        self.shards = sorted((first.encode(), name, offset, length) for first, name, offset, length in shards)
        self.firsts = [s[0] for s in self.shards]
        self.shard = self.block = None

    def lines(self, name: str, offset: int, length: int) -> list[list[bytes]]:
        with self.fs.open_input_file(f"{self.base}/{name}") as file:
            return [line.split(b"\t") for line in zlib.decompress(file.read_at(length, offset)).split(b"\n")]

    def load(self, number: int) -> None:
        if self.shard != number:
            self.directory = self.lines(*self.shards[number][1:])
            self.keys, self.shard, self.block = [d[0] for d in self.directory], number, None

    def find(self, capture: bytes) -> list[bytes]:
        """Archive, offset and length of a capture."""
        number = bisect_right(self.firsts, capture) - 1
        if number >= 0:
            self.load(number)
            # Only the beginning of a shard's first key was compared.
            while number > 0 and capture < self.keys[0]:
                number -= 1
                self.load(number)
            place = bisect_right(self.keys, capture) - 1
            if place >= 0:
                if self.block != place:
                    self.found = self.lines(self.shards[number][1], *map(int, self.directory[place][1:]))
                    self.found_keys, self.block = [line[0] for line in self.found], place
                at = bisect_right(self.found_keys, capture) - 1
                if at >= 0 and self.found_keys[at] == capture:
                    return self.found[at][1:]
        raise KeyError(capture.decode())


def located(root: str, shards: list[tuple[str, str, int, int]]):
    """Where the batches' captures lie, by lookups in the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in in_slices(batches):
            index = index or Index(root, shards)
            captures = batch.column("capture")
            found = [index.find(c) for c in captures.cast(pa.binary()).to_pylist()]
            arrays = [captures, pa.array([f[0].decode() for f in found], pa.string())]
            arrays += [pa.array([int(f[k]) for f in found], pa.int64()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in CAPTURE.split(", ")])

    return run


def parsed(data: bytes) -> tuple:
    """The row of one record; a payload that doesn't have the record's digest is an error."""
    head, rest = zlib.decompress(data, 31).split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"not a record: {head[:80]!r}")
    answer, payload = block.split(b"\r\n\r\n", 1)
    size, digest = int(answer.rsplit(b": ", 1)[1]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page = lambda name: None if (found := fields[name].split(":")[2]) == "-" else int(found)
    if fields["WARC-Type"] == "revisit":
        return page("WARC-Record-ID"), size, digest, "revisit", page("WARC-Refers-To")
    if len(payload) != size or base32(hashlib.sha1(payload).hexdigest()) != digest:
        raise ValueError(f"damaged payload: {fields['WARC-Record-ID']}")
    return page("WARC-Record-ID"), size, digest, "response", None


def read_ranges(root: str):
    """The records at the batches' places, which are sorted; near ones share a range read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = folder(root)
        for batch in in_slices(batches):
            places = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))))
            rows, i = [], 0
            while i < len(places):
                name, start, length = places[i]
                end, j = start + length, i + 1
                while j < len(places) and places[j][0] == name and places[j][1] - end <= READ_GAP and places[j][1] - start < READ_BYTES:
                    end, j = places[j][1] + places[j][2], j + 1
                with fs.open_input_file(f"{base}/{name}") as file:
                    data = file.read_at(end - start, start)
                rows += [parsed(data[o - start : o - start + n]) for _, o, n in places[i:j]]
                i = j
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in READ_BACK.split(", ")])

    return run


def write_archives(
    pages: DataFrame, root: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, block_lines: int = BLOCK_LINES
) -> tuple[DataFrame, list[tuple[str, str, int, int]]]:
    """Write ``pages`` as archives and an index below ``root``; returns every page's capture
    key, and the index's shards (at most one per shuffle partition of the session)."""
    spark = pages.sparkSession
    judged, heads = with_payload_groups(pages, min_bytes)
    records = archive_records(pages, judged, heads)
    captures = stored(records.mapInArrow(written_archives(root, archive_bytes), CAPTURE), "archived")
    ordered = captures.repartitionByRange(spread(spark), "capture").sortWithinPartitions("capture")
    shards = ordered.mapInArrow(written_shards(root, block_lines), "first string, shard string, offset long, length long")
    shards = [tuple(r) for r in stored(shards, "shards").collect()]
    return judged.select(capture_key()), shards


def read_captures(captures: DataFrame, root: str, shards: list[tuple[str, str, int, int]]) -> DataFrame:
    """The records of ``captures`` (column ``capture``), looked up in the index and read."""
    n = spread(captures.sparkSession)
    asked = captures.repartitionByRange(n, "capture").sortWithinPartitions("capture")
    places = asked.mapInArrow(located(root, shards), CAPTURE).select("archive", "offset", "length")
    places = places.repartitionByRange(n, "archive", "offset").sortWithinPartitions("archive", "offset")
    return places.mapInArrow(read_ranges(root), READ_BACK)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows ``page_id, payload_bytes, payload_digest, record_type, refers_to``: every page as it
    is read back from archives that it was written to.

    The payload is ``html`` in UTF-8. Of records with equal payloads of at least ``min_bytes``
    the one with the largest page_id is a response, the others revisit it; of rows that repeat
    that id one is the response. Smaller payloads are all responses.

    A null html is an empty payload. A row without an id is archived under a null id, and is a
    response only where no row of its payload has one. A null url has an empty key. Rows that
    repeat have a record each. Other columns are ignored; an empty table gives an empty one.
    Payloads are equal by SHA-1 and length.
    """
    pages = pages.select("page_id", "url", "html")
    root = scratch_path(pages.sparkSession, "archives")
    captures, shards = write_archives(pages, root, min_bytes)
    return read_captures(captures, root, shards)
