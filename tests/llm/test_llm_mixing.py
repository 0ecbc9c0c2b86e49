"""Mixing against a plain computation on whole tables and on edge cases."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, cycle=(3, 1, 2), share=1.5, limit=2.0):
    """Water filling: give shares by weight, fix what overflows, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    left, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= limit * sizes[s]}
        for s in over or open_:
            target[s] = limit * sizes[s] if over else weight[s] * level
            left -= target[s]
        open_ -= over or set(open_)
    return target


def plain_mix(rows, seed=17):
    """(doc_id, size, source_size, target, taken) of rows (doc_id, text, source)."""
    sized = [(d, s, len(WORD.findall(t or "")),
              hashlib.md5(f"{seed}:{'' if d is None else d}:{t or ''}".encode()).hexdigest()) for d, t, s in rows]
    totals = defaultdict(int)
    for _, s, n, _ in sized:
        totals[s] += n
    targets, taken = plain_targets(totals), {}
    for s, total in totals.items():
        budget = int(targets[s] + 0.5)
        epochs, rest = divmod(budget, total) if total else (0, 0)
        tied, start = Counter((k, n) for _, x, n, k in sized if x == s), 0
        for (k, n), copies in sorted(tied.items()):
            taken[s, k] = epochs * n + max(0, min(n, (rest - start) // copies))
            start += n * copies
    return Counter((d, n, totals[s], round(targets[s], 6), taken[s, k]) for d, s, n, k in sized)


def as_counter(df):
    return Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect())


EDGES = [
    (1, "a b c", "s1"), (2, None, "s1"), (3, "", "s2"), (4, "\t one two \n", None), (None, "null id here", "s1"),
    (5, "w " * 20_000, "Z"), (6, "tie", "é"), (6, "tie", "é"), (6, "tie", "é"), (7, "x y", "s2"), (8, "p q r s", ""),
    (None, "null id here", "s1"), (9, "a b c", "s1"), (10, "   ", "blank"),
]


@pytest.mark.parametrize("slice_rows", [2, 50_000])
def test_edge_cases(spark, slice_rows):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, source string").withColumns(
        {"size": F.lit("x"), "key": F.lit(1), "target": F.lit(None), "row": F.lit(2)})
    assert as_counter(M.mix_plan(docs, slice_rows=slice_rows)) == plain_mix(EDGES)
    assert M.mix(docs).columns == docs.columns


def test_whole_table_agrees_and_targets_are_met(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    plan = M.mix_plan(docs, slice_rows=7)
    assert as_counter(plan) == plain_mix(rows)
    for r in plan.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r.t - r.g) <= 1
    assert plan.filter("taken > 2 * size").isEmpty()


def test_mixed_rows_hold_the_words_that_were_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = {r.doc_id: r.taken for r in M.mix_plan(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = defaultdict(list)
    for r in M.mix(docs).collect():
        got[r.doc_id].append(r.text)
    for doc_id, taken in plan.items():
        assert sum(len(WORD.findall(t)) for t in got[doc_id]) == taken
        assert all(texts[doc_id].startswith(t) for t in got[doc_id])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix_plan(docs).collect() == [] and M.mix(docs).collect() == []


def test_no_python_and_no_text_in_a_shuffle(spark, sf_dir):
    plan = M.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hashpartitioning" not in plan
