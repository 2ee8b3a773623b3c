r"""Deterministic sharded WARC writer and reader.

Pages are range-sorted by ``page_id`` into shards whose split points do not
change between runs, and each shard is streamed into gzip files (one member per
record) that roll at ``roll_bytes`` of compressed size.  Record ids, dates,
lengths, block and payload digests are made anew from the page, so the same
input gives the same bytes.  Files are written under temporary names and
renamed; the pinned manifest (file, records, bytes, digest), written last,
commits them.

Of records with equal payloads (at least ``min_payload`` bytes) the one with the
largest ``page_id`` is the response, the others are revisits of it.  Groups are
made from payload digests alone (pre-aggregated); payloads are shuffled once,
and the group's answer reaches each of them in that same shuffle.

Defined cases: NULL html counts as empty; a NULL url gives no target header;
NULL ids sort first and are the response only of a group without other ids; of
rows that repeat the response's id and payload the first is the response;
white space and control characters of a url are percent-encoded in its header;
an empty table writes no file and reads as empty; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pin, range_bounds, shard_of, ship, shuffle_partitions, work_dir
from .token_codec import read_whole, write_atomically

DATE = "2024-01-01T00:00:00Z"
ROLL_BYTES = 32 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}')}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member holding one record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + z.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = sha1_base32(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
            "\r\n\r\n").encode()
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    headers += [("Content-Type", "application/http;msgtype=response"),
                ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
        if refers_to is not None:
            headers.append(("X-Refers-To-Page-ID", str(refers_to)))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    return record(headers, block)


def file_info(name: str) -> bytes:
    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", DATE),
               ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return record(headers, b"format: WARC File Format 1.1\r\n")


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of every record of a gzip file, one member in memory at a time."""
    at = memoryview(data)
    while len(at):
        z = zlib.decompressobj(31)
        raw = z.decompress(at) + z.flush()
        at = at[len(at) - len(z.unused_data):] if z.unused_data else at[:0]
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) for x in lines)
        size = int(headers["Content-Length"])
        if len(rest) != size + 4:
            raise ValueError("record length differs from its header")
        yield headers, rest[:size]


_MANIFEST_DDL = "shard int, number int, file string, n_records long, n_bytes long, sha1 string"
_ROWS_DDL = "shard int, page_id long, sha binary, part int, url string, html string, response long"


def write_warc(pages: DataFrame, path: str, min_payload: int = 0, roll_bytes: int = ROLL_BYTES,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages as WARC files under ``path``; returns the pinned manifest."""
    spark = pages.sparkSession
    ship(spark)
    shards = shuffle_partitions(spark)
    bounds = range_bounds(pages, id_col, shards)

    @F.arrow_udf("int")
    def shard(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for x in ids:
            yield pa.array(shard_of(x, bounds))

    html = F.coalesce(F.col(html_col), F.lit(""))
    sha = F.unhex(F.sha2(html.cast("binary"), 256))
    whole = pages.select(F.col(id_col).cast("long").alias("page_id"), sha.alias("sha"), F.lit(1).alias("part"),
                         F.col(url_col).alias("url"), html.alias("html"), F.lit(None).cast("long").alias("response"))
    narrow = pages.filter(F.octet_length(html) >= min_payload).select(
        F.col(id_col).cast("long").alias("page_id"), sha.alias("sha"))
    groups = (narrow.groupBy("sha").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
              .filter("n > 1").select("sha", "response"))
    roles = (narrow.join(groups, "sha").select("page_id", "sha", F.lit(0).alias("part"),
                                               F.lit(None).cast("string").alias("url"),
                                               F.lit(None).cast("string").alias("html"), "response"))
    rows = whole.unionAll(roles).withColumn("shard", shard("page_id")).select(
        *(x.split()[0] for x in _ROWS_DDL.split(", ")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shard, number, n, held, size = None, 0, 0, [], 0
        role, seen = None, None  # the group answer for the rows that follow it; the response already written

        def flush():
            nonlocal number, n, held, size
            name = f"pages-{open_shard:06d}-{number:06d}.warc.gz"
            data = b"".join([file_info(name), *held])
            write_atomically(path, name, data)
            row = {"shard": [open_shard], "number": [number], "file": [name], "n_records": [n],
                   "n_bytes": [len(data)], "sha1": [sha1_base32(data)]}
            number, n, held, size = number + 1, 0, [], 0
            return pa.RecordBatch.from_pydict(row, pa.schema([
                ("shard", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_records", pa.int64()),
                ("n_bytes", pa.int64()), ("sha1", pa.string())]))

        for b in batches:
            for s, page, key, part, url, text, response in zip(*(b.column(i).to_pylist() for i in range(7))):
                if held and (s != open_shard or size >= roll_bytes):
                    yield flush()
                if s != open_shard:
                    open_shard, number = s, 0
                if part == 0:
                    role = (page, key, response)
                    continue
                revisit, target = False, None
                if role is not None and role[:2] == (page, key):
                    revisit = page != role[2] or seen == (page, key)
                    target = role[2] if revisit else None
                seen = (page, key)
                held.append(page_record(page, url, text.encode(), target, revisit))
                n, size = n + 1, size + len(held[-1])
        if held:
            yield flush()

    files = (rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "page_id", "sha", "part", "url")
             .mapInArrow(write, _MANIFEST_DDL))
    return pin(files, "warc-manifest")


def read_warc(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page record of the archives.

    The manifest says which files there are; others in the folder are never read.
    Digests of files, and digests and lengths of blocks and payloads, are
    checked; a mismatch fails.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, digest_of_file in zip(*(c.to_pylist() for c in b.columns)):
                data = read_whole(path, name)
                if sha1_base32(data) != digest_of_file:
                    raise ValueError(f"{name} differs from its manifest")
                rows = []
                for h, block in records(data):
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    if h["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
                        raise ValueError("block digest differs from its header")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
                        raise ValueError("payload differs from its header")
                    page, target = h.get("X-Page-ID"), h.get("X-Refers-To-Page-ID")
                    rows.append((None if page is None else int(page), size, digest, h["WARC-Type"],
                                 None if target is None else int(target)))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if manifest.isEmpty():
        return spark.createDataFrame([], schema)
    return manifest.select("file", "sha1").repartition(shuffle_partitions(spark)).mapInArrow(parse, schema)


def warc_round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write all pages as WARC files and read the archives back."""
    path = work_dir(pages.sparkSession, "warc")
    return read_warc(pages.sparkSession, path, write_warc(pages, path, min_payload))
