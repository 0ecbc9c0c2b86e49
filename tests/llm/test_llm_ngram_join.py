"""The exact join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import ngram_join as J
from tests.llm.test_llm_near_dup import plain_groups


def got(docs, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.ngram_groups(docs, **options).collect()}


@pytest.mark.parametrize("rare, paired", [(J.RARE, J.PAIRED), (2, 3), (0, 0), (0, 10**9)])
def test_similar_sets_share_a_combination(monkeypatch, rare, paired):
    monkeypatch.setattr(J, "RARE", rare)
    monkeypatch.setattr(J, "PAIRED", paired)
    draw = np.random.default_rng(4)
    for _ in range(300):
        n = int(draw.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 15, 16, 17, 30, 64, 70, 150]))
        universe = np.unique(draw.integers(0, 2**64, 4 * n + 4, dtype=np.uint64))
        freqs = draw.integers(1, 6, len(universe))
        x = draw.permutation(len(universe))[:n]
        y = np.unique(np.concatenate([draw.permutation(x)[: n - draw.integers(0, n // 5 + 1)],
                                      draw.integers(0, len(universe), draw.integers(0, n // 5 + 1))]))
        keys = []
        for s, t in ((x, y), (y, x)):
            shared = s[(freqs[s] > 1) | np.isin(s, t)]
            keys.append(J.combinations_of(len(s), universe[shared], np.maximum(freqs[shared], 2), 80))
        if 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y)):
            assert len(np.intersect1d(*keys)), (n, len(y))


@pytest.mark.parametrize("words", [2, 5])
def test_whole_table_agrees_with_all_pairs(spark, sf_dir, words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(docs, words=words) == plain_groups({r.doc_id: r.text for r in docs.collect()}, words)


@pytest.mark.parametrize("rare, paired", [(J.RARE, J.PAIRED), (1, 3)])
def test_families_of_edited_copies(spark, monkeypatch, rare, paired):
    """Families around the threshold, with passages that all documents share, so that frequent tokens come into prefixes."""
    monkeypatch.setattr(J, "RARE", rare)
    monkeypatch.setattr(J, "PAIRED", paired)
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(5000)]
    common = draw.choices(vocabulary, k=120)
    texts = {}
    for family in range(4):
        base = draw.choices(vocabulary, k=[10, 40, 150, 150][family]) + common[:[0, 40, 100, 120][family]]
        for copy in range(25):
            words = list(base)
            for _ in range(draw.randrange(0, len(base) // 8 + 1)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts[family * 100 + copy] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert got(docs, words=2) == plain_groups(texts, 2)
    assert got(docs, words=5) == plain_groups(texts, 5)


def test_sketches_of_any_lengths_are_compared(spark):
    """The bits that differ are those of two sketches made in the shorter length, and never exceed the difference."""
    draw = np.random.default_rng(8)
    rows, want = [], []
    for n, m in [(1, 1), (30, 40), (120, 140), (129, 128), (60, 100), (100, 60), (60, 500), (700, 3)]:
        x, y = (np.unique(draw.integers(0, 2**64, k, dtype=np.uint64)) for k in (n, m))
        y = np.unique(np.concatenate([y, x[:m // 2]]))
        one, two = J.odd_sketch(x), J.odd_sketch(y)
        place = np.uint64(64 * min(len(one), len(two)) - 1)
        both = np.bincount(((np.concatenate([x, y]) >> np.uint64(40)) & place).astype(np.int64)) % 2
        rows.append((one.tolist(), two.tolist()))
        want.append(int(both.sum()))
        assert want[-1] <= len(np.setxor1d(x, y))
    side = [F.struct(F.col(c).alias("odd"), J.halved(F.col(c)).alias("half")).alias(c) for c in "xy"]
    bits = spark.createDataFrame(rows, "x array<long>, y array<long>").coalesce(1).select(*side).select(J.odd_bits("x", "y").alias("n"))
    assert [r.n for r in bits.collect()] == want


def test_a_group_whose_sketches_have_two_lengths_is_not_paired_out(spark, monkeypatch):
    """Copies about a base of 128 shingles, too far apart to be linked: few pairs are left to confirm."""
    made, stored = [], J.stored

    def counting(df, label, **options):
        out = stored(df, label, **options)
        if label == "candidate-pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(J, "stored", counting)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(140)]
    texts = {}
    for copy in range(120):
        words = base[:126 + draw.randrange(15)]
        for at in range(5, 125, 10):
            words[at] += draw.choice("abc")
        texts[copy] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert got(docs, words=5) == plain_groups(texts, 5)
    assert sum(made) < 2500


def test_edge_cases(spark):
    long_text = " ".join(str(i) for i in range(30_000))
    rows = [(1, "One two THREE"), (2, "one  two\nthree"), (3, None), (4, ""), (5, " \t"), (6, "single"), (7, "SINGLE"),
            (None, "one two three"), (None, None), (8, long_text), (9, long_text + " end"), (10, "one two three"),
            (10, "one two three"), (11, "Été x y"), (12, "été x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in ("n", "rep", "keys", "key", "id", "tokens", "grp", "component")})
    got_ = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.ngram_groups(docs, words=2).collect()), key=str)
    assert got_ == sorted([
        (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (None, 2, None), (None, 0, None),
        (8, 29_999, 8), (9, 30_000, 8), (10, 2, 1), (10, 2, 1), (11, 2, 11), (12, 2, 12)], key=str)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == {}
