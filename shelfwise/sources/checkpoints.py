"""Lineage cuts in the folder that the cluster shares."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows up to which a slice is worked on at once.
SLICE_ROWS = 1_000_000


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir``, else a folder in the session's warehouse.

    Both are places that every executor reaches; a machine-local temporary folder is never used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` reliably and read it back, so that values assigned at run time stay fixed on retries."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the checkpoint folder; it is deleted when the Spark application ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside delete their shuffle files when they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, label: str, clean: bool = False) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: computed once, whatever reads it.

    With ``clean``, the shuffle files behind it are deleted as soon as it is written, and it is packed more tightly.
    """
    path = scratch_path(df.sparkSession, label)
    if clean:
        with _shuffles_cleaned(df.sparkSession):
            df.write.option("compression", "zstd").parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` gave, when nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            if not re.search("-[0-9a-f]{32}$", path.getName()):
                raise ValueError(f"not a scratch table: {folder}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def in_slices(
    df: DataFrame, keys: Sequence[str], work: Callable[[DataFrame], DataFrame], label: str, rows: int = SLICE_ROWS,
) -> DataFrame:
    """``work(df)`` for work that treats every value of ``keys`` apart, done on slices of whole keys one after another.

    Rows that are wide while they are collapsed take many times their size on disk between two stages. Here only one slice
    of about ``rows`` rows is between stages at a time: its shuffle files go when its result is written, then its rows.
    Slices are parts of a hash of the keys, NULL being a value too. A key with more rows than that makes its slice larger.
    With no more than ``rows`` rows there is one slice, and ``work`` is left to the caller's job.
    """
    spark, whole = df.sparkSession, stored(df, label, clean=True)
    slices = -(-whole.count() // rows)
    if slices <= 1:
        return work(whole)
    path = scratch_path(spark, f"{label}-slices")
    cut = F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int")
    whole.withColumn("_slice", cut).write.option("compression", "zstd").partitionBy("_slice").parquet(path)
    discard(whole)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = sorted(s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root))
    done, schema = [], None
    for name in names:
        if not name.startswith("_slice="):
            continue
        result = work(spark.read.schema(whole.schema).parquet(f"{path}/{name}"))
        done.append(scratch_path(spark, f"{label}-result"))
        schema = result.schema
        with _shuffles_cleaned(spark):
            result.write.option("compression", "zstd").parquet(done[-1])
        _delete(spark, f"{path}/{name}")
    return spark.read.schema(schema).parquet(*done)
