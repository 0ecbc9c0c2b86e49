"""Elias-Fano sequences, the encoder, and whole stores against the tokenizer library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import files, token_store as T
from shelfwise.sources.checkpoints import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
@pytest.mark.parametrize("gap", [0, 1, 7, 100_000])
def test_elias_fano_returns_every_value(n, gap):
    draw = np.random.default_rng(n + gap)
    values = np.cumsum(draw.integers(0, gap + 1, n)).astype(np.uint64)
    data = b"xy" + T.EliasFano.of(values).to_bytes() + b"rest"
    found, end = T.EliasFano.read(data, 2)
    assert data[end:] == b"rest" and found.values().tolist() == values.tolist()
    assert [found.select(i) for i in range(0, n, 7)] == values[::7].tolist()
    with pytest.raises(IndexError):
        found.select(n)


def test_elias_fano_is_small():
    starts = np.arange(100_000, dtype=np.uint64) * np.uint64(700)
    assert len(T.EliasFano.of(starts).to_bytes()) < 100_000 * 13 / 8


def test_encoder_agrees_with_the_library():
    draw = random.Random(1)
    parts = ["a", "B", "é", "中", "1", "23", "'s", "'ll", "'", "!", "...", " ", "  ", "\n", "\n\n", "\t", "\xa0", "\x1c", " ",
             "<|endoftext|>", "\U0001f600", "_", "x'", "'ve "]
    texts = ["".join(draw.choices(parts, k=draw.randrange(0, 14))) for _ in range(4000)]
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = T.Encoder(PATH, 4)
    for _ in range(2):  # a second time from what is remembered
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == want


def plain(rows, end=2):
    library = Tokenizer.from_file(PATH)
    rows = sorted(((d is not None, d or 0, (t or "").encode(), d) for d, t in rows))
    out, start = [], 0
    for _, _, text, d in rows:
        ids = library.encode(text.decode(), add_special_tokens=False).ids + [end]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("options", [{}, {"rows_per_shard": 23, "file_ids": 3000}, {"width": 4}])
def test_whole_table(spark, sf_dir, options):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(T.store_tokens(docs, PATH, **options)) == plain([(r.doc_id, r.text) for r in docs.collect()])


EDGES = [(5, "five"), (None, "no id"), (None, None), (-3, ""), (-3, "minus"), (7, "same"), (7, "same"), (2**62, "far"),
         (8, "word " * 30_000), (9, "  blanks \n\n")]


@pytest.mark.parametrize("rows_per_shard", [1, 3, 1000])
def test_edge_cases(spark, rows_per_shard):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in ("shard", "ids", "start", "name")})
    assert got(T.store_tokens(docs, PATH, rows_per_shard=rows_per_shard, file_ids=50)) == plain(EDGES)


def test_documents_are_selected_from_a_file(spark):
    folder = scratch_path(spark, "tokens")
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 5)) for i in range(700)], "doc_id long, text string")
    manifest = T.write_tokens(docs, folder, PATH).collect()
    assert [r["docs"] for r in manifest] == [700]
    import hashlib

    data = files.read_file(folder, manifest[0]["name"])
    assert (len(data), hashlib.sha256(data).hexdigest()) == (manifest[0]["bytes"], manifest[0]["sha256"])
    stored, library = T.TokenFile(data), Tokenizer.from_file(PATH)
    for i in (0, 1, 255, 256, 699):
        assert library.decode(stored.document(i).tolist()[:-1]) == f"text number {i} " * (i % 5)


def test_empty_table(spark):
    assert got(T.store_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH)) == []


def test_shards_by_binary_search(spark):
    limits = sorted(random.Random(2).sample(range(1000), 37))
    rows = spark.range(1000).select("id", files.shard_of(F.col("id"), limits).alias("s")).collect()
    assert all(r.s == sum(x < r.id for x in limits) for r in rows)


def test_strings_of_added_tokens_are_encoded_as_by_the_library(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "a b", "x<|endoftext|>y\nz", "<|endoftext", "|> <|endoftext |>", "", None]
    library = Tokenizer.from_file(PATH)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert 50256 in want[0]
    found = T.Encoder(PATH, 2, added=True).encode([t or "" for t in texts])
    assert [np.frombuffer(b, "<u2").tolist() for b in found] == want
    rows = list(enumerate(texts))
    stored = T.store_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    assert got(stored) == plain(rows)


def test_a_worker_keeps_its_encoder_and_recovers_from_a_failure(monkeypatch):
    encoder = T.encoder_of(PATH, 2, True)
    want = T.Encoder(PATH, 2, added=True).encode(["one two three", "four one two"])
    assert encoder.encode(["one two three"]) == want[:1]
    known = len(encoder.numbers)
    assert T.encoder_of(PATH, 2, True) is encoder and encoder.encode(["three one"]) and len(encoder.numbers) <= known + 2
    with monkeypatch.context() as failing:
        failing.setattr(encoder, "_learn", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            encoder.encode(["four one two"])
    assert T.encoder_of(PATH, 2, True).encode(["one two three", "four one two"]) == want
