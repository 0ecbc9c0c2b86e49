"""Files that tasks write in a shared folder: written under a temporary name, then renamed, then listed in a manifest.

A task that is repeated writes the same bytes under the same final name; what a lost task leaves under a temporary
name is never read, because readers take the names from the manifest, which Spark commits as a table.
"""

from __future__ import annotations

import hashlib
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

# Shards at most, so that the list of their limits has a fixed bound.
MAX_SHARDS = 20_000


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there; a path without a scheme is local."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class NewFile:
    """A file under a temporary name until :meth:`commit`."""

    def __init__(self, folder: str, name: str):
        self.fs, root = open_fs(folder)
        self.fs.create_dir(root, recursive=True)
        self.final, self.temporary = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out, self.digest, self.size = self.fs.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def commit(self) -> str:
        """Give the file its name; returns the digest of its bytes."""
        self.out.close()
        if self.fs.get_file_info(self.final).type != fs.FileType.NotFound:
            self.fs.delete_file(self.final)  # of an earlier attempt, with the same bytes
        self.fs.move(self.temporary, self.final)
        return self.digest.hexdigest()


def read_file(folder: str, name: str) -> bytes:
    where, root = open_fs(folder)
    with where.open_input_stream(f"{root}/{name}", compression=None) as f:
        return f.read()


def range_limits(df: DataFrame, key: Column, rows_per_shard: int, max_shards: int = MAX_SHARDS) -> list[int]:
    """Upper limits, in order, of all shards but the last, that deal the rows of ``df`` evenly by a long ``key``.

    Reads the key only. The limits are keys that occur.
    """
    n = min(max_shards, -(-df.count() // rows_per_shard))
    if n <= 1:
        return []
    at = [i / n for i in range(1, n)]
    return df.agg(F.percentile_approx(key, at, max(10_000, 20 * n)).alias("x")).first()["x"] or []


def shard_of(key: Column, limits: list[int]) -> Column:
    """Number of limits below ``key``, by binary search."""
    if not limits:
        return F.lit(0)
    listed = F.from_json(F.lit(str(list(limits))), "array<bigint>")
    steps = [2**i for i in reversed(range(len(limits).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(limits)) & (F.get(listed, low + step - 1) < key), low + step).otherwise(low))
