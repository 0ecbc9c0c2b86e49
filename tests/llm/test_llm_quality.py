"""The additive classifier: what it can learn, held-out accuracy, and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm import quality as Q
from shelfwise.llm.common import is_in_fold


def test_tables_learn_single_features_and_pairs():
    draw = np.random.default_rng(1)
    x = draw.random((3000, 3))
    single = Q.fit(x, (x[:, 0] > 0.4).astype(float))
    assert ((single.scores(x) > 0.5) == (x[:, 0] > 0.4)).mean() > 0.97
    crossed = (x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)
    paired = Q.fit(x, crossed.astype(float))
    assert ((paired.scores(x) > 0.5) == crossed).mean() > 0.9
    assert {1, 2} in [{a, b} for a, b, _ in paired.pairs]


def test_scores_are_sums_of_table_entries():
    draw = np.random.default_rng(2)
    x = draw.random((500, 4))
    model = Q.fit(x, (x.sum(axis=1) > 2).astype(float), rounds=20, pair_rounds=5)
    for row, score in zip(x[:20], model.scores(x[:20])):
        total = model.base
        for value, edges, table in zip(row, model.edges, model.tables):
            total += table[sum(value >= e for e in edges)]
        for a, b, table in model.pairs:
            total += table[sum(row[a] >= e for e in model.grids[a]), sum(row[b] >= e for e in model.grids[b])]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12


def test_held_out_accuracy_and_repeatability(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held_out = is_in_fold("doc_id", 5, 0)
    scored = []
    for partitions in (1, 7):
        model = Q.train(docs.repartition(partitions), labels, ~held_out)
        scored.append({r.doc_id: r.s for r in docs.select("doc_id", Q.score(model, "text").alias("s")).collect()})
    assert scored[0] == scored[1]
    truth = {r.doc_id: r.quality for r in labels.filter(held_out).collect()}
    assert np.mean([(scored[0][d] >= 0.3) == q for d, q in truth.items()]) > 0.95




def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "a good line of text.", 0), (2, None, 1), (3, "", 2), (4, "w " * 50_000, 3), (None, "x", 4), (1, "a good line", 5),
         (5, "\x00\x01 ퟿ \t", 6)], "doc_id long, text string, score int")
    labels = spark.createDataFrame(
        [(1, 1, "x"), (1, 0, "x"), (2, None, "x"), (9, 1, "x"), (4, 0, "x"), (None, 1, "x"), (5, 7, "x")],
        "doc_id long, quality int, text string")
    model = Q.train(docs, labels, F.lit(True))
    rows = docs.select("doc_id", Q.score(model, "text").alias("s")).collect()
    assert len(rows) == 7 and all(0 <= r.s <= 1 for r in rows)
    assert Q.keep_good(docs, model, threshold=0.0).columns == docs.columns
    # Labels of one kind, or none: the smoothed share.
    one_kind = Q.train(docs, labels.filter("doc_id = 9 OR doc_id = 4"), F.lit(True))
    assert {r.s for r in docs.select(Q.score(one_kind, "text").alias("s")).collect()} == {1 / 3}
    none = Q.train(docs, labels.limit(0), F.lit(True))
    assert {r.s for r in docs.select(Q.score(none, "text").alias("s")).collect()} == {0.5}
    assert docs.limit(0).select(Q.score(none, "text")).collect() == []


def test_the_sample_is_bounded(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    seen = []
    fit = Q.fit
    try:
        Q.fit = lambda x, y: seen.append(len(y)) or fit(x, y, rounds=1, pair_rounds=0)
        Q.train(docs, labels, F.lit(True), sample_rows=50)
    finally:
        Q.fit = fit
    assert seen == [50]
