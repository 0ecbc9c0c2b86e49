"""WARC archives: whole tables against SQL (see the oracle test), edge cases, format and determinism."""

import gzip
import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from shelfwise.llm import files, warc as W
from shelfwise.sources.checkpoints import scratch_path

LONG = "<p>" + "long enough to be referred to " * 5
EDGES = [
    (5, "http://a/", LONG), (3, "http://b/", LONG), (9, None, LONG), (1, "http://c/", "short"), (2, "http://d/", "short"),
    (4, "u", None), (6, "u", ""), (None, "u", LONG), (None, "v", LONG), (7, "x\r\ny", "é" * 50), (8, "z", "é" * 50),
    (7, "x\r\ny", "é" * 50), (10, "u", "y" * 200_000), (-1, "u", "only" * 40),
]


def plain(rows, least=100):
    first, out, seen = {}, Counter(), Counter()
    for p, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least and p is not None:
            first[body] = min(first.get(body, p), p)
    for p, _, html in rows:
        body = (html or "").encode()
        known = first.get(body)
        again = len(body) >= least and (known is not None and (p is None or p > known) or seen[p, body] > 0)
        seen[p, body] += 1
        out[p, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
            (known if known is not None else p) if again else None] += 1
    return out


def found(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit(c) for c in ("key", "kind", "first", "shard", "digest", "payload", "name")})


def test_edge_cases_in_any_layout(spark):
    for options in ({}, {"shard_bytes": 300, "file_bytes": 400}, {"shard_bytes": 1}):
        assert found(W.round_trip(pages_of(spark, EDGES).repartition(4), **options)) == plain(EDGES)


def test_payloads_come_back(spark):
    rows = W.round_trip(pages_of(spark, EDGES)).filter("record_type = 'response'").collect()
    want = {(p, h or "") for p, _, h in EDGES}
    assert {(r.page_id, r.html) for r in rows} <= want


def test_the_same_bytes_whatever_the_partitions(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    digests = []
    for n in (1, 9):
        folder = scratch_path(spark, "archives")
        manifest = W.write_archives(pages.repartition(n), folder, shard_bytes=100_000, file_bytes=20_000)
        rows = manifest.orderBy("name").collect()
        digests.append([(r["name"], r["records"], r["bytes"], r["sha256"]) for r in rows])
        for r in rows:
            data = files.read_file(folder, r["name"])
            assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
    assert digests[0] == digests[1] and len(digests[0]) > 3


def test_records_are_well_formed():
    data = W.page_record(7, 0, "http://x/", b"body", hashlib.sha256(b"body").hexdigest(), 4, False, None, "2024-01-01T00:00:00Z")
    text = gzip.decompress(data)
    head, _, rest = text.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and rest == b"body\r\n\r\n"
    headers, block = next(W.records_of(data + data))
    assert block == b"body" and headers["Content-Length"] == "4" and headers["X-Page-ID"] == "7"


def test_empty_table(spark):
    assert W.round_trip(pages_of(spark, EDGES).limit(0)).collect() == []


def test_damage_is_noticed(spark):
    import pytest

    data = W.page_record(7, 0, None, b"body", hashlib.sha256(b"body").hexdigest(), 4, False, None, "2024-01-01T00:00:00Z")
    broken = gzip.compress(gzip.decompress(data).replace(b"body", b"bode"))
    with pytest.raises(ValueError):
        list(W.records_of(broken))


def test_files_end_by_their_compressed_size_with_the_own_parameters(spark):
    # 24 MiB that compress to a half, and many pages without a payload.
    pages = spark.range(24 * 16).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(1024)), lambda i: F.sha2(
            F.concat(F.col("id").cast("string"), F.lit("/"), i.cast("string")), 256))).alias("html"))
    files = W.write_archives(pages, scratch_path(spark, "rolled")).orderBy("shard", "part").collect()
    assert len({r.shard for r in files}) == 1 and len(files) > 2
    assert all(r.bytes >= 4 << 20 for r in files[:-1])
    empty = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("html"))
    assert W.write_archives(empty, scratch_path(spark, "empty"), shard_bytes=20_000).select("shard").distinct().count() > 3


def test_large_pages_are_read_in_bounded_batches():
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
    rows = [(i, "u", None if i % 3 == 0 else "x" * 400_000) for i in range(600)]
    batches = list(W._batches(iter(rows), schema))
    assert [i for b in batches for i in b.column(0).to_pylist()] == list(range(600))
    assert max(b.nbytes for b in batches) < W.BATCH_BYTES + 500_000
    small = list(W._batches(((i, "u", None) for i in range(600)), schema))
    assert [b.num_rows for b in small] == [W.BATCH_RECORDS, 600 - W.BATCH_RECORDS]
