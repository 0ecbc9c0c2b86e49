"""Greedy string tiling against a plain greedy search, and leaks in documents."""

import numpy as np
import pytest

from shelfwise.llm import decontamination as D


def plain_tiling(item, doc, least):
    """The longest common run of unmarked places, again and again."""
    free_i, free_d, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and free_i[i + n] and free_d[j + n]
                       and item[i + n] == doc[j + n]):
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return tiles
        free_i[i:i + n] = free_d[j:j + n] = [False] * n
        tiles.append((i, j, n))


@pytest.mark.parametrize("seed", range(40))
def test_tiles_are_those_of_a_plain_search(seed):
    draw = np.random.default_rng(seed)
    item = draw.integers(0, 4, draw.integers(0, 25)).astype(np.uint64)
    doc = draw.integers(0, 4, draw.integers(0, 40)).astype(np.uint64)
    assert D.tiling(item, doc, 3) == plain_tiling(item.tolist(), doc.tolist(), 3)


def test_reordered_passages_are_covered():
    words = np.arange(1, 31, dtype=np.uint64)
    moved = np.concatenate([words[20:], np.array([99], np.uint64), words[:10], words[10:20]])
    assert sum(n for _, _, n in D.tiling(words, moved, 4)) == 30


ITEM = "one two three four five six seven eight nine ten eleven twelve"


def test_scan_of_edge_cases(spark):
    docs = spark.createDataFrame([
        (1, f"start {ITEM} end", 1, "x"), (2, None, None, None), (3, "", 1, "x"), (4, "seven eight nine ten " * 3, 1, "x"),
        (5, "ten eleven twelve ,,, SEVEN eight nine. one two three four five six", 1, "x"), (None, ITEM, 1, "x"),
        (1, f"start {ITEM} end", 1, "x"), (6, "one two three " + "z " * 30_000, 1, "x"), (7, "short  ONE", 1, "x"),
    ], "doc_id long, text string, share int, items string")
    bench = spark.createDataFrame(
        [(10, ITEM, "a"), (11, ITEM, "b"), (12, "short one", "c"), (13, "", "d"), (14, None, "e"), (None, "one two", "f")],
        "item_id long, text string, leaked string")
    rows = sorted(D.scan(docs, bench).collect(), key=str)
    found = {(r.doc_id, tuple(r["items"]), r.share, r.leaked) for r in rows}
    assert len(rows) == 9
    # Document 5 holds the item in three parts, of which the first two are shorter than a tile.
    assert found == {(1, (10, 11), 1.0, True), (2, (), 0.0, False), (3, (), 0.0, False), (4, (), 0.0, False),
                     (5, (10, 11), 0.5, True), (None, (10, 11), 1.0, True), (6, (), 0.0, False), (7, (12,), 1.0, True)}
    assert sorted(r.doc_id for r in D.keep_clean(docs, bench).collect()) == [2, 3, 4, 6]
    assert D.keep_clean(docs, bench).columns == docs.columns


def test_blocks_of_items_give_the_same(spark):
    docs = spark.createDataFrame([(i, f"{ITEM} {i}") for i in range(5)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, f"{ITEM} {i}") for i in range(7)], "item_id long, text string")
    one = {(r.doc_id, tuple(r["items"])) for r in D.scan(docs, bench).collect()}
    assert one == {(r.doc_id, tuple(r["items"])) for r in D.scan(docs, bench, block_words=20).collect()}
    assert all(len(items) == 7 for _, items in one)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert [tuple(r) for r in D.scan(docs, bench.limit(0)).collect()] == [(1, [], 0.0, False)]
    assert D.scan(docs.limit(0), bench).collect() == []


def test_documents_with_whole_items_are_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = {r.item_id: r.text for r in bench.collect()}
    got = {r.doc_id: r["items"] for r in D.scan(docs, bench).collect()}
    assert got == {d: sorted(i for i, text in items.items() if text in body) for d, body in texts.items()}
    assert any(got.values())
