"""Paragraph sketches against sets of paragraphs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import fingerprints as P


def paragraphs(text):
    return set(re.findall(r"[^\n]{1,256}", text or ""))


def share(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(rows):
    """Of (doc_id, text) rows, ties in order of text."""
    low = -(2**63)
    rows = sorted(((low if d is None else d, d, t or "") for d, t in rows), key=lambda r: (-r[0], r[2].encode()))
    out = []
    for (_, d, t), (_, _, u) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(),
                    share(paragraphs(t), paragraphs(edited)), share(paragraphs(t), paragraphs(u))))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows_per_block", [17, 2000])
def test_whole_table(spark, sf_dir, rows_per_block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = P.fingerprints(docs, rows_per_block=rows_per_block)
    assert got(found) == plain([(r.doc_id, r.text) for r in docs.collect()])
    prints = {}
    for r in found.join(docs.select("doc_id", "text"), "doc_id").collect():
        assert prints.setdefault(r.text, r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len({frozenset(paragraphs(t)) for t in prints})


EDGES = [(1, "a\nb\nc"), (2, None), (3, ""), (None, "null id"), (None, "another\nnull id"), (4, "é\U0001f600" * 400),
         (5, "same"), (5, "same"), (5, "other"), (9, "\n\n\n"), (-7, "x\n" * 3), (2**63 - 1, "top"),
         (6, "\n".join(f"line {i}" for i in range(3000)))]


@pytest.mark.parametrize("rows_per_block", [1, 3, 2000])
def test_edge_cases(spark, rows_per_block):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in ("key", "block", "digests", "next_text", "copy")})
    assert got(P.fingerprints(docs, rows_per_block=rows_per_block)) == plain(EDGES)


def test_one_row_and_no_row(spark):
    docs = spark.createDataFrame([(1, "only\none")], "doc_id long, text string")
    assert got(P.fingerprints(docs)) == plain([(1, "only\none")])
    assert P.fingerprints(docs.limit(0)).collect() == []


def test_differences_are_recovered_and_sketches_grow_on_failure(spark):
    draw = random.Random(8)
    rows = []
    for n in (0, 1, 5, 30, 400, 3000):
        common = [draw.getrandbits(63) for _ in range(n)]
        for apart in (0, 1, 12, 500):
            rows.append((common + [draw.getrandbits(63) - 2**62 for _ in range(apart)],
                         common + [draw.getrandbits(63) for _ in range(apart // 2)]))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    for r in df.select("a", "b", P.difference(F.col("a"), F.col("b")).alias("d")).collect():
        assert sorted(r.d.first) == sorted(set(r.a) - set(r.b)) and sorted(r.d.second) == sorted(set(r.b) - set(r.a))
    # Thirty digests do not come out of one bucket.
    bucket = P.peel(P.subtract(P.sketch(F.col("a")), P.sketch(F.col("b"))))
    assert {r.rest for r in df.filter("size(a) > 400 AND size(b) > 200").select(bucket["rest"].alias("rest")).collect()} >= {True}


def test_no_python_in_the_plan(spark, sf_dir):
    text = P.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
