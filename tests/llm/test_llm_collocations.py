"""Collocations against plain counting, and packed counts against counters."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import collocations as C
from shelfwise.llm import packed

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, support=30, contained=80, reported=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    out = {}
    longer = {}
    for (lang, p), a in f.items():
        if len(p) > 2 and a >= support:
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        longer[lang, p[i:j]] = max(longer.get((lang, p[i:j]), 0), a)
    for (lang, p), a in f.items():
        if len(p) < 2 or a < support or 100 * longer.get((lang, p), 0) >= contained * a:
            continue
        score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                             for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:reported]))


def test_packing():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        for top in (2**64 - 1, 2**20):
            codes = np.unique(draw.integers(0, top, n, dtype=np.uint64, endpoint=True))
            assert (packed.unpack(packed.pack(codes)) == codes).all()
    for values in ([], [1, 255], [70000], [2**40, 3]):
        assert packed.unpack_numbers(packed.pack_numbers(np.array(values, np.int64))).tolist() == values
    edges = np.array([0, 2**64 - 1], np.uint64)
    assert (packed.unpack(packed.pack(edges)) == edges).all()


def test_packed_counts(spark, monkeypatch):
    monkeypatch.setattr(packed, "CHUNK", 500)
    draw = random.Random(2)
    rows = [(draw.randrange(3), draw.choice([draw.randrange(2**63), draw.randrange(40)])) for _ in range(4000)]

    def make():
        def codes_of(batch):
            for g in range(3):
                codes = np.array([v for k, v in zip(*[c.to_pylist() for c in batch.columns]) if k == g], np.uint64)
                yield g, codes * np.uint64(0x9E3779B97F4A7C15), np.full(len(codes), 3, np.int64) if g == 1 else None
        return codes_of

    table = spark.createDataFrame(rows, "g int, v long").repartition(4)
    expected = Counter()
    for g, v in rows:
        expected[g, v * 0x9E3779B97F4A7C15 % 2**64] += 3 if g == 1 else 1
    for least in (1, 4):
        got = {(r.grp, r.code % 2**64): r.n for r in packed.count(table, make, 13, least).collect()}
        assert got == {k: n for k, n in expected.items() if n >= least}

    def make_marked():
        codes_of = make()
        return lambda batch: ((g, c, n, (c >> np.uint64(56)).astype(np.int64) + g) for g, c, n in codes_of(batch))

    got = {(r.grp, r.code % 2**64): (r.n, r.mark) for r in packed.count(table, make_marked, 13, marked=True).collect()}
    assert got == {(g, c): (n, (c >> 56) + g) for (g, c), n in expected.items()}


def texts(seed, n):
    draw = random.Random(seed)
    words = ["the", "of", "New", "York", "éa", "b-c", "d\tE", "Wörter", "ſ", "K"] + [f"w{i}" for i in range(30)]
    fixed = ["in spite of the", "New York City council", "ad hoc committee", "a b c d e"]
    out = []
    for _ in range(n):
        parts = [draw.choice(fixed) if draw.random() < 0.3 else draw.choices(words, [30 // (i + 1) + 1 for i in range(len(words))])[0]
                 for _ in range(draw.randrange(60))]
        out.append("".join(p + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\x1c", "\r\n", "\x0c"]) for p in parts))
    return out


def got(docs, **options):
    return sorted(tuple(r) for r in C.collocations(docs, **options).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("shards", [1, 4, 30])
def test_agrees_with_plain_counting(spark, shards):
    rows = [(t, lang) for i, t in enumerate(texts(shards, 500)) for lang in [("en", "de", None, "und")[i % 7 % 4]]]
    rows += [(None, "en"), ("", None), (" \t", "fr"), ("only once", "xx"), ("x " * 20000, "long"), ("É.É é, é " * 40, "fr")]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumns(
        {c: F.lit(c) for c in ("code", "phrase", "k", "n", "shard", "grp", "a")}).repartition(5)
    expected = plain(rows)
    assert len(expected) > 30
    assert got(docs, shards=shards) == expected


def test_small_support_and_report(spark):
    rows = [(t, "en") for t in texts(9, 60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert got(docs, support=3, shards=2, reported=25, contained=60) == plain(rows, 3, 60, 25)


def test_whole_table_agrees_with_plain_counting(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(docs, doc_id="doc_id") == plain([(r.text, r.lang) for r in docs.collect()])


def test_products_beyond_64_bits(spark):
    big = 2**62
    assert spark.range(1).selectExpr(
        f"(CAST(2000000 AS DECIMAL(7,0)) * CAST({big} AS DECIMAL(19,0))) DIV (CAST({big} AS DECIMAL(19,0)) + CAST({big} AS "
        "DECIMAL(19,0))) AS s").first().s == 1_000_000


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "text string, lang string")) == []
