"""Partition writers."""

import pytest
from pyspark.sql import Observation, functions as F

from shelfwise.sources import checkpoints, sinks as W


@pytest.fixture
def df(spark):
    return spark.range(40).select("id", (F.col("id") % 4).cast("string").alias("p"))


def test_overwrite_is_idempotent(spark, df, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        W.overwrite_partitions(df, path, ["p"], files=2)
    assert spark.read.parquet(path).count() == 40
    W.overwrite_one_partition(df.filter("id < 3"), path, {"p": "3"})
    back = spark.read.parquet(path)
    assert back.count() == 33 and back.filter("p = 3").count() == 3


def test_single_partition_guard(spark, df, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        W.replace_single_partition(df, path, "p")
    with pytest.raises(ValueError):
        W.replace_single_partition(df.filter("false"), path, "p")
    assert W.replace_single_partition(df.filter("p = '2'"), path, "p") == "2"


def test_compaction_leaves_small_partitions_alone(spark, df, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        df.filter("p = '1'").repartition(3).write.mode("append").partitionBy("p").parquet(path)
    df.filter("p = '0'").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    assert W.compact_partitions(spark, path, ["p"], threshold=5) == 1
    table = spark.read.parquet(path)
    assert {r["p"]: r["n_files"] for r in W.partition_files(spark, path, ["p"]).collect()}[0] == 1
    assert table.filter("p = 1").count() == 30
    assert {r["p"]: r["n_files"] for r in W.partition_files(spark, path, ["p"]).collect()}[1] <= 2
    assert W.compact_partitions(spark, path, ["p"]) == 0


def test_compaction_follows_the_plan_with_files_over_several_read_splits(spark, tmp_path):
    path, size = str(tmp_path / "t"), 150_000
    rows = spark.range(40_000).select("id", F.md5(F.col("id").cast("string")).alias("text"), F.when(
        F.col("id") % 10 > 0, F.col("id") % 2).alias("p"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",)}
    rows.repartition(12).write.option("parquet.block.size", "32768").partitionBy("p").parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        before = {r.p: (r.n_files, -(-r.bytes // size)) for r in W.partition_files(spark, path, ["p"]).collect()}
        assert W.compact_partitions(spark, path, ["p"], size, threshold=3) == 3
        after = {r.p: r.n_files for r in W.partition_files(spark, path, ["p"]).collect()}
        assert after == {p: wanted for p, (_, wanted) in before.items()} and all(n < before[p][0] for p, n in after.items())
        names = sorted(r.file for r in W.file_listing(spark, path, ["p"]).collect())
        assert W.compact_partitions(spark, path, ["p"], size, threshold=3) == 0
        assert names == sorted(r.file for r in W.file_listing(spark, path, ["p"]).collect())
        assert sorted(map(tuple, spark.read.parquet(path).select("id", "text", "p").collect())) == sorted(map(tuple, rows.collect()))
        assert not (tmp_path / "t.compaction").exists()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_interrupted_compaction_is_carried_out_later(spark, df, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df.repartition(8).write.partitionBy("p").parquet(path)
    rows = sorted(map(tuple, spark.read.parquet(path).select("id", "p").collect()))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(W, "_moves", lost)
        with pytest.raises(RuntimeError):
            W.compact_partitions(spark, path, ["p"], threshold=2)
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "p").collect())) == rows
    assert W.finish_compaction(spark, path) == 1
    assert {r.n_files for r in W.partition_files(spark, path, ["p"]).collect()} == {1}
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "p").collect())) == rows
    assert W.finish_compaction(spark, path) == 0


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = spark.range(1000).select("id", F.lit("a").alias("p"))
    W.overwrite_partitions(hot, path, ["p"], files=4)
    assert W.partition_files(spark, path, ["p"]).first()["n_files"] > 1


def test_guard_counts(spark, df, tmp_path):
    seen = Observation()
    W.append_new(W.guard_keys(df.withColumn("p", F.nullif(F.col("p"), F.lit("0"))), ["id", "p"], seen), str(tmp_path / "t"))
    assert seen.get == {"rows_in": 40, "rows_dropped": 10}


def test_checkpoint_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root is None or checkpoints.checkpoint_root(spark) == root
    assert checkpoints.scratch_path(spark, "x").startswith(checkpoints.checkpoint_root(spark).rstrip("/"))


def content(spark, path):
    return sorted(map(tuple, spark.read.schema("id long, p string").parquet(path).select("id", "p").collect()), key=str)


def test_published_partitions_pass_their_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40).select("id", F.element_at(F.array(*[F.lit(x) for x in ("a:b", "x y", "01", None)]), (
        F.col("id") % 4 + 1).cast("int")).alias("p"), F.lit(1).alias("n"))
    checks = {"even": F.count_if(F.col("id") % 2 == 1), "single": F.count_if(F.col("n") > 1)}
    with pytest.raises(W.ChecksFailed) as failed:
        W.publish_checked(rows, path, ["p"], checks, ["n"])
    assert failed.value.violations == {"even": 20} and not (tmp_path / "t").exists()
    none = {"single": checks["single"]}
    assert W.publish_checked(rows, path, ["p"], none, ["n"]) == {"single": 0, "rows": 40}
    before = content(spark, path)
    assert before == sorted(map(tuple, rows.select("id", "p").collect()), key=str)
    some = rows.filter("p = 'a:b' OR p IS NULL").withColumn("id", F.col("id") + 100)
    with pytest.raises(W.ChecksFailed):
        W.publish_checked(some, path, ["p"], checks, ["n"])
    assert content(spark, path) == before and not (tmp_path / "t.compaction").exists()
    assert W.publish_checked(some, path, ["p"], none, ["n"], files=3)["rows"] == 20
    assert content(spark, path) == sorted(
        [(i + 100, p) if p in ("a:b", None) else (i, p) for i, p in before], key=str)
    assert W.publish_checked(some.filter("id < 0"), path, ["p"], none, ["n"]) == {"single": 0, "rows": 0}


def test_interrupted_publication_is_carried_out_later(spark, df, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    W.publish_checked(df, path, ["p"], {})
    before, real = content(spark, path), W._moves

    def lost(*_):
        raise RuntimeError("lost")

    changed = df.filter("p = '2'").withColumn("id", -F.col("id"))
    with monkeypatch.context() as m:
        m.setattr(W, "_moves", lost)
        with pytest.raises(RuntimeError):
            W.publish_checked(changed, path, ["p"], {})
    assert content(spark, path) == before and real is W._moves
    assert W.finish_compaction(spark, path) == 1
    assert content(spark, path) == sorted([(-i, p) if p == "2" else (i, p) for i, p in before], key=str)


def test_rows_are_made_once_to_be_checked_and_published(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("p")).mapInArrow(count, "id long, p string")
    W.publish_checked(rows, str(tmp_path / "t"), ["p"], {"none": F.count_if(F.col("id") < 0)})
    assert made.value == 100


def test_partitions_with_special_names_are_compacted(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60).select("id", F.element_at(F.array(*[F.lit(x) for x in ("a:b", "x y", "50%")]), (
        F.col("id") % 3 + 1).cast("int")).alias("p"))
    rows.repartition(6).write.partitionBy("p").parquet(path)
    before = content(spark, path)
    assert W.compact_partitions(spark, path, ["p"], threshold=2) == 3
    assert content(spark, path) == before
    assert {r.n_files for r in W.partition_files(spark, path, ["p"]).collect()} == {1}
