"""WARC archives: a writer with revisit records, and a reader that salvages damaged ones.

The writer makes one gzip member per record, rolls archives at ARCHIVE_BYTES and lists what it wrote in a table; a
task that runs again writes under other names, and only files that the table lists count.  Of records with equal
payloads that with the least page_id is a response, the others revisit it.

The reader checks every record: version line, headers, length, block and payload digests.  After a failed check it
searches the next gzip member or version line that begins a valid record, goes on from there, and reports the bytes
between as a gap with the reason; inside a member's content, and in what comes out of a damaged one, it does the same.
A record alone in its member fails with the member, whose checksum is its own.  Reports and records are rows of one table.
The search passes over an archive once: the next place of each mark is looked for only when the last one is passed, and
what follows a mark is read no further than its headers (HEADER_BYTES at most) unless they promise a record.

The folder is a URI that pyarrow's file systems open on every executor (file, hdfs, s3, gs; s3a is read as s3).  Archives
are read through Spark, which holds one at a time: ARCHIVE_BYTES or one longer record, 2 GB at most.

Defined results: a null payload or URL is empty; line breaks in a URL are percent-encoded.  Null page_ids come after
all others; of repeated rows with one page_id all are responses if one is, and where all page_ids of a payload are null
each is a response.  An empty table gives no rows.  Payloads of any length are written whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.llm.common import materialised, shared_dir, sliced

ARCHIVE_BYTES = 16 << 20
#: Pages of one payload that may meet in a task, and payloads of more pages that are broadcast (28 bytes each).
MOST_COPIES = 10_000
MOST_BROADCAST = 100_000
FIRST_BYTES = 4096
#: Headers of a record, and bytes of a gzip member before its first content, are at most this long.
HEADER_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."

RECORDS = (
    "file string, offset bigint, length bigint, kind string, problem string, record_type string, record_id string, uri string, "
    "refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, response: bool) -> bytes:
    """One record; a revisit has the HTTP headers (with the payload's length) as its block, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if response else http
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{page_id}>", f"WARC-Target-URI: {uri}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if not response:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", folder))
        held, size, given = [], 0, []

        def roll() -> None:
            nonlocal held, size
            name = f"{uuid.uuid4().hex}.warc.gz"
            with store.open_output_stream(f"{root}/{name}.part", compression=None) as out:
                for member in held:
                    out.write(member)
            store.move(f"{root}/{name}.part", f"{root}/{name}")
            given.append((name, len(held), size))
            held, size = [], 0

        for whole in batches:
            for batch in sliced(whole, 2):
                for page_id, url, html, refers, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    by = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = by.compress(record(page_id, url, (html or "").encode(), refers, response)) + by.flush()
                    held.append(member)
                    size += len(member)
                    if size >= ARCHIVE_BYTES:
                        roll()
        if held:
            roll()
        if given:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*given, strict=True)], names=["file", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (page_id, url, html) to folder/archives; the table of files (file, records, bytes)."""
    raw = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint"), "url", raw.alias("html"), F.unhex(F.sha1(raw)).alias("sha"))
    copies = rows.select("page_id", "sha").groupBy("sha").agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1")
    copies = materialised(copies, "copies")
    often = copies.where(F.col("n") > MOST_COPIES)
    if n_often := often.count():
        # payloads of many pages meet their first page where they are, and no other payload when the rest is joined
        often = often.select("sha", F.col("first").alias("often"))
        rows = rows.join(F.broadcast(often) if n_often <= MOST_BROADCAST else often, "sha", "left")
        key = F.when(F.col("often").isNull(), F.col("sha")).otherwise(F.unhex(F.md5(F.col("page_id").cast("string"))))
        rows = rows.withColumn("sha", key)
    else:
        rows = rows.withColumn("often", F.lit(None).cast("bigint"))
    rare = copies.where(F.col("n") <= MOST_COPIES).select("sha", F.col("first").alias("rare"))
    rows = rows.join(rare, "sha", "left").withColumn("first", F.coalesce("often", "rare"))
    response = F.col("first").isNull() | F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    rows = rows.select("page_id", "url", "html", "first", response.alias("response"))
    spark = pages.sparkSession
    store = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/archives")
    store.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(store)
    rows.mapInArrow(_writer(f"{folder}/archives"), "file string, records bigint, bytes bigint").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def parse(data: bytes, start: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the plain record at start; ValueError says what is wrong."""
    if not data.startswith(VERSION, start):
        raise ValueError("no version line")
    end = data.find(b"\r\n\r\n", start, start + HEADER_BYTES)
    if end < 0:
        raise ValueError("headers do not end")
    head = {}
    for line in data[start:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        head[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not re.fullmatch("[0-9]{1,18}", head.get("content-length", "")):
        raise ValueError("no content length")
    begin, stop = end + 4, end + 4 + int(head["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("block does not end where it should")
    block = data[begin:stop]
    said = head.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != digest(block):
        raise ValueError("block digest differs")
    return head, block, stop + 4


def member(data: memoryview, start: int) -> tuple[bytes, int, str, bool]:
    """Content and end of the gzip member at start, fed in steps so that nothing beyond is copied; if it is damaged also
    why, and then the content is what comes out before, and whether it may be wrong."""
    by, out, at, step = zlib.decompressobj(31), [], start, FIRST_BYTES
    # reserved flags, or a first block of no known kind right after a header without further fields
    flags = data[start + 3] if start + 3 < len(data) else 0
    if flags & 0xE0 or (not flags and start + 10 < len(data) and data[start + 10] & 6 == 6):
        return b"", start, "bad member: no gzip header", True
    while not by.eof:
        if at >= len(data):
            return b"".join(out), at, "member is cut off", False
        if at - start > HEADER_BYTES and not any(out):
            return b"", at, "bad member: no content", True
        piece, before = data[at : at + step], by.copy()
        try:
            out.append(by.decompress(piece))
        except zlib.error as e:
            if len(piece) == 1:
                return b"".join(out), at, f"bad member: {e}", True
            by, step = before, len(piece) // 2
            continue
        at += len(piece)
        step = min(step * 2, 1 << 20)
    return b"".join(out), at - len(by.unused_data), "", False


def inside(content: bytes, sure: bool) -> Iterator[tuple[int, int, str, dict[str, str], bytes]]:
    """(start, end, problem, headers, block) of the records and, with a problem, gaps of a member's content."""
    at, gap, why = 0, -1, ""
    while at < len(content):
        try:
            head, block, end = parse(content, at)
            if not sure and not head.get("warc-block-digest", "").startswith("sha1:"):
                raise ValueError("no digest in a damaged member")
            checked(head, block)
        except ValueError as e:
            if gap < 0:
                gap, why = at, str(e)
            at = content.find(VERSION, at + 1)
            if at < 0:
                break
            continue
        if gap >= 0:
            yield gap, at, why, {}, b""
            gap = -1
        yield at, end, "", head, block
        at = end
    if gap >= 0:
        yield gap, len(content), why, {}, b""


def payload_of(head: dict[str, str], block: bytes) -> tuple[bytes | None, int | None]:
    """Payload and its full length; a revisit has only the length."""
    if "application/http" not in head.get("content-type", ""):
        return block, len(block)
    http, _, body = block.partition(b"\r\n\r\n")
    if head.get("warc-type") != "revisit":
        return body, len(body)
    for line in http.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return None, int(value)
    return None, None


def checked(head: dict[str, str], block: bytes) -> tuple[str, int | None, bytes | None]:
    """The payload's digest as said, its length and the payload; ValueError if the digest differs."""
    body, size = payload_of(head, block)
    said = head.get("warc-payload-digest", "")
    if body is not None and said.startswith("sha1:") and said[5:] != digest(body):
        raise ValueError("payload digest differs")
    return said.removeprefix("sha1:"), size, body


def salvage(raw: bytes) -> Iterator[tuple]:
    """Rows (offset, length, kind, problem, type, id, uri, refers_to, digest, payload bytes, payload) of an archive.

    Records and gaps inside a gzip member have its offset and length; a gap's problem names the bytes of its content.
    """
    data, at, n = memoryview(raw), 0, len(raw)
    gap, why = -1, ""
    marks = {GZIP: -1, VERSION: -1}  # the next place of each, looked for anew when it is passed

    def told(start: int, end: int, head: dict[str, str], block: bytes) -> tuple:
        return (start, end - start, "record", None, head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-refers-to"), *checked(head, block))

    while at < n:
        rows, damage, lost = [], "", ""
        try:
            if bytes(data[at : at + 3]) == GZIP:
                content, end, damage, doubtful = member(data, at)
                parts = list(inside(content, not doubtful))
                ends = [p[1] for p in parts if not p[2]]
                alone = len(ends) == 1 and not content.startswith(VERSION, ends[0]) and not parts[0][2]
                if not ends or (damage and alone):
                    raise ValueError(damage or (parts[0][2] if parts else "empty member"))
                if damage and parts[-1][2]:
                    parts.pop()  # the member's end, which the gap after it stands for
                for a, b, problem, head, block in parts:
                    rows.append((at, end - at, "gap", f"bytes {a} to {b} of the member: {problem}", *[None] * 7) if problem else told(at, end, head, block))
            else:
                head, block, end = parse(raw, at)
                rows.append(told(at, end, head, block))
        except ValueError as e:
            lost = str(e)
        if not lost:
            if gap >= 0:
                yield (gap, max(0, at - gap), "gap", why, *[None] * 7)
                gap = -1
            yield from rows
            if not damage:
                at = end
                continue
        if gap < 0:
            gap, why = (at, lost) if lost else (end, damage)
        for mark, place in marks.items():
            if place <= at:
                found = raw.find(mark, at + 1)
                marks[mark] = n if found < 0 else found
        at = min(marks.values())
    if gap >= 0:
        yield (gap, n - gap, "gap", why, *[None] * 7)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 7, pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def told(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            path, rows, size = batch.column(0)[i].as_py(), [], 0
            for row in salvage(batch.column(1)[i].as_buffer().to_pybytes()):
                rows.append((path, *row))
                size += len(row[-1] or b"") + 500
                if size > ARCHIVE_BYTES:
                    yield told(rows)
                    rows, size = [], 0
            if rows:
                yield told(rows)


def read_archives(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Records and gaps of the archives (plain or gzip, named *.warc or *.warc.gz) at those paths or in those folders, which
    only Spark must be able to open."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc{,.gz}").load(paths).select("path", "content").mapInArrow(_read, RECORDS)


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
d AS (SELECT page_id, octet_length(raw)::BIGINT AS payload_bytes, sha1(raw) || '0' AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (1 + (5 * i) // 4)::INT, 2))::INT >> (3 - (5 * i) % 4)::INT) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = shared_dir(spark, "warc")
    files = write_archives(pages, folder).select("file")
    rows = read_archives(spark, f"{folder}/archives").where("kind = 'record'")
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:x-page:(-?[0-9]+)>', 1) AS bigint)")
    refers = F.when(F.col("record_type") == "revisit", number("refers_to"))
    rows = rows.select(F.substring_index("file", "/", -1).alias("file"), number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", refers.alias("refers_to"))
    return rows.join(files, "file", "left_semi").drop("file")
