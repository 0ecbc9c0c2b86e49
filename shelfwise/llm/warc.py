"""Deterministic sharded WARC archives.

Records are ordered by page id and payload digest and dealt to shards at exact sums of payload bytes, with an allowance
for the headers of each, so the shards do not depend on how the input is partitioned. A shard's task writes gzip members, one a record, and rolls to a new
file when the compressed size is reached. Headers, record ids and digests are made anew from the content; the date
is a parameter. Files get their names when complete (see :mod:`files`); the manifest is committed as a table.

Of records with equal payloads of at least ``least_bytes`` bytes, that with the smallest page id is a response with
the payload; the others are revisits, which refer to it and have no payload. The date apart, reading the archives gives
back all that was written.

Defined cases: a null html is an empty payload; a null page id stands first, has no id header, and gives way to any id
as response; rows that repeat id and payload stand next to each other and only the first is the response; null urls
have no target header; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import running
from ..sources.checkpoints import scratch_path, stored
from .common import bound_batches, text_of
from .files import MAX_SHARDS, NewFile, read_file

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# What a record counts in a shard besides its payload.
HEADER_BYTES = 600
# Bytes of the pages, and records, that pass between Spark and a worker at a time.
BATCH_BYTES, BATCH_RECORDS = 4 << 20, 512
MANIFEST = "shard long, part long, name string, records long, bytes long, sha256 string"


def record_id(*parts: object) -> str:
    """A record id that follows from what the record is."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One WARC record as a gzip member; the same content gives the same bytes."""
    lines = [VERSION, *[f"{name}: {value}".encode() for name, value in headers if value is not None],
             f"Content-Length: {len(block)}".encode()]
    return gzip.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def page_record(
    page_id: int | None, place: int, url: str | None, payload: bytes, digest: str, size: int, revisit: bool,
    refers_to: int | None, date: str,
) -> bytes:
    """A response, or a revisit of the payload that page ``refers_to`` holds.

    ``place`` tells rows apart that repeat a page and its payload.
    """
    target = None if url is None else "".join(c for c in url if c not in "\r\n")
    block = b"" if revisit else payload
    return record([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, place)), ("WARC-Date", date), ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest, 0) if revisit else None),
        ("X-Page-ID", page_id), ("X-Payload-Length", size), ("X-Refers-To-Page-ID", refers_to if revisit else None),
        ("Content-Type", "text/html; charset=utf-8"),
    ], block)


def members_of(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The decompressed gzip members of a file, one at a time."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts = zlib.decompressobj(zlib.MAX_WBITS | 16), []
        while not member.eof:
            piece = view[at:at + step]
            if not len(piece):
                raise ValueError("the file ends within a record")
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        yield b"".join(parts)


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive file; digests are verified."""
    for body in members_of(data):
        head, _, rest = body.partition(b"\r\n\r\n")
        first, *lines = head.split(b"\r\n")
        if first != VERSION:
            raise ValueError("not a WARC record")
        headers = dict(line.decode().split(": ", 1) for line in lines)
        block = rest[:int(headers["Content-Length"])]
        if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
        yield headers, block


def order_key(page_id: Column, digest: Column) -> Column:
    """A text that sorts as (page id, digest), nulls first."""
    hexed = F.lpad(F.hex(page_id.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(F.coalesce(hexed, F.lit("")), F.lit(":"), digest)


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = 100, file_bytes: int = 4 << 20, shard_bytes: int = 64 << 20,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write archives below ``folder``; returns their manifest, which is written last.

    ``file_bytes`` is the compressed size at which a file ends, ``shard_bytes`` the payload and headers of a shard
    (more, where there would be over ``MAX_SHARDS`` shards): several times as much, so that files end by their size.
    """
    bound_batches(pages.sparkSession, BATCH_BYTES)
    payload = text_of(html).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("digest")).withColumn(
        "key", order_key(F.col("page_id"), F.col("digest")))
    narrow = stored(rows.select("page_id", "digest", "key", F.octet_length("payload").cast("long").alias("size")),
                    "payloads")

    # Pages whose payload a smaller page holds. These marks are dealt out like the pages and sorted in front of them,
    # so payloads are not joined with anything.
    firsts = stored(
        narrow.filter(F.col("size") >= least_bytes).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first"),
        "first-pages")
    marks = narrow.join(firsts, "digest").filter(
        F.col("page_id").isNull() & F.col("first").isNotNull() | (F.col("page_id") > F.col("first"))).select(
        "key", F.lit(0).alias("kind"), "first").distinct()

    # The limits of the shards: keys at equal sums of bytes.
    counted = F.col("size") + HEADER_BYTES
    total = narrow.agg(F.coalesce(F.sum(counted), F.lit(0)).alias("s")).first()["s"]
    step = max(shard_bytes, total // MAX_SHARDS + 1)
    limits: list[str] = []
    if total > step:
        sums = running(narrow.select("key", "size"), [], [F.col("key")], {"upto": counted})
        shard = F.floor((F.col("upto") - counted) / step)
        limits = sorted(r["key"] for r in sums.groupBy(shard.alias("shard")).agg(F.max("key").alias("key")).collect())
        limits = limits[:-1]

    @F.arrow_udf("int")
    def shard_number(keys: pa.Array) -> pa.Array:
        return pa.array([bisect_left(limits, k) for k in keys.to_pylist()], pa.int32())

    both = rows.withColumn("kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    dealt = (
        both.withColumn("shard", shard_number("key") if limits else F.lit(0))
        .repartitionById(len(limits) + 1, "shard").sortWithinPartitions("key", "kind", "url")
        .select("page_id", "url", "payload", "digest", "key", "kind", "first", F.col("shard").cast("long"))
    )
    schema = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("name", pa.string()), ("records", pa.int64()),
                        ("bytes", pa.int64()), ("sha256", pa.string())])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part, records, last, marked, place = None, 0, 0, None, None, 0

        def roll(shard: int) -> pa.RecordBatch:
            nonlocal out, part, records
            row = [shard, part, name_of(shard, part), records, out.size, out.commit()]
            out, part, records = None, part + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, schema)], schema=schema)

        for batch in batches:
            for page, target, body, digest, key, kind, first, shard in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    marked, first_page = key, first
                    continue
                place = place + 1 if key == last else 0
                last = key
                again = key == marked or (place > 0 and len(body) >= least_bytes)
                out = out or NewFile(folder, name_of(shard, part))
                out.write(page_record(page, place, target, body, digest, len(body), again,
                                      first_page if key == marked else page, date))
                records += 1
                if out.size >= file_bytes:
                    yield roll(shard)
        if out:
            yield roll(shard)

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def name_of(shard: int, part: int) -> str:
    return f"pages-{shard:06d}-{part:06d}.warc.gz"


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives in a manifest: ``page_id, url, html`` (null for revisits), ``payload_bytes,
    payload_digest, record_type, refers_to``."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64())])

    def number(headers: dict[str, str], name: str) -> int | None:
        return int(headers[name]) if name in headers else None

    def rows_of(name: str) -> Iterator[tuple]:
        for headers, block in records_of(read_file(folder, name)):
            kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
            if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
            yield (number(headers, "X-Page-ID"), headers.get("WARC-Target-URI"),
                   block.decode("utf-8", "replace") if kind == "response" else None,
                   number(headers, "X-Payload-Length"), digest, kind, number(headers, "X-Refers-To-Page-ID"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from _batches(rows_of(name), schema)

    return manifest.select("name").repartition(max(1, manifest.count())).mapInArrow(
        read, "page_id long, url string, html string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long")


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Read records in batches that end at ``BATCH_RECORDS``, or when their pages reach ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2] or "")
        if len(held) == BATCH_RECORDS or size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, f.type) for column, f in zip(zip(*rows), schema)], schema=schema)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write archives in the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, folder, **options), folder)
