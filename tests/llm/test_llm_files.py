"""Files that tasks write: names, attempts, limits of shards."""

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import files
from shelfwise.llm.common import small_batches, utf8


def test_a_file_has_its_name_only_when_complete(tmp_path):
    folder = f"file:{tmp_path}/a"
    lost = files.NewFile(folder, "x.bin")
    lost.write(b"half of")  # a task that was lost
    first = files.NewFile(folder, "x.bin")
    first.write(b"the whole")
    assert not (tmp_path / "a" / "x.bin").exists()
    digest = first.commit()
    again = files.NewFile(f"{tmp_path}/a", "x.bin")  # the task is run again
    again.write(b"the whole")
    assert again.commit() == digest and files.read_file(folder, "x.bin") == b"the whole"


def test_folders_are_taken_as_they_are_named(tmp_path):
    for uri in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        assert files.open_fs(uri)[1] == str(tmp_path)


def test_limits_deal_rows_evenly(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000 - 500).alias("k"))
    limits = files.range_limits(rows, F.col("k"), 100)
    counts = [r["count"] for r in rows.groupBy(files.shard_of(F.col("k"), limits).alias("s")).count().collect()]
    assert len(counts) == 10 and max(counts) < 150
    assert files.range_limits(rows.limit(0), F.col("k"), 100) == [] == files.range_limits(rows, F.col("k"), 1000)
    hot = files.range_limits(spark.range(1000).select(F.lit(3).cast("long").alias("k")), F.col("k"), 100)
    assert set(hot) == {3}


def test_the_number_of_shards_is_bounded(spark):
    assert len(files.range_limits(spark.range(1000), F.col("id"), 1, max_shards=8)) == 7


def test_batches():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a", None, "é"])], names=["t"])
    assert utf8(batch.column(0)) == [b"a", b"", "é".encode()]
    assert [b.num_rows for b in small_batches([batch], 2)] == [2, 1]


def test_the_package_stands_alone():
    """Nothing else in the library imports the optional package, and no module of it swallows an import error."""
    import pathlib

    root = pathlib.Path(files.__file__).parents[1]
    for path in root.rglob("*.py"):
        code = path.read_text(encoding="utf8")
        if path.parent.name == "llm":
            assert "ImportError" not in code and "ModuleNotFoundError" not in code
        else:
            assert "llm" not in code, path


@pytest.mark.parametrize("word", ["localCheckpoint", "toPandas", "crossJoin", "mkdtemp"])
def test_forbidden_calls(word):
    import pathlib

    root = pathlib.Path(files.__file__).parents[1]
    assert not [p for p in root.rglob("*.py") if word in p.read_text(encoding="utf8")]
