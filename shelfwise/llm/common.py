"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word: a run of code points other than ASCII blanks. ``bytes.split()`` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(c: Column | str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def utf8(column: pa.Array) -> list[bytes]:
    """A string column of an Arrow batch as UTF-8 bytes, empty for null."""
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size`` rows, so that what a worker derives from a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def is_in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves the remainder ``fold``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def bound_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Keep Arrow batches below ``size`` bytes, so that very long texts do not pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
