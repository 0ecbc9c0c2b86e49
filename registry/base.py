"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.sources.checkpoints import scratch_path, stored

from .fixtures import VIEWS, oracle, view


# An average of fixed-point numbers in SQL: text in between, as the cast of a decimal to a double may be off by the last bit.
EXACT_AVG = "CAST(CAST(sum(CAST({0} AS DECIMAL(38, 16))) AS VARCHAR) AS DOUBLE) / count({0})"

# Views that were written beforehand, by scale folder and name; see prepare().
_PREPARED: dict[tuple[str, str], str] = {}


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Write all views of one scale, so that queries of this session read them instead of deriving them.

    Each is written in several files, as a table of some size would be; the test tables have one row group each.
    """
    files = spark.sparkContext.defaultParallelism
    for name in VIEWS:
        path = scratch_path(spark, f"view-{name}")
        view(spark, sf_dir, name).repartition(files).write.parquet(path)
        _PREPARED[sf_dir, name] = path


class Views:
    """Attribute access to the tables and views of one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        path = _PREPARED.get((self.sf_dir, name))
        return self.spark.read.parquet(path) if path else view(self.spark, self.sf_dir, name)

    def stored(self, name: str) -> DataFrame:
        """The view as a written table, derived once per query: for queries that read it several times."""
        if (self.sf_dir, name) in _PREPARED:
            return getattr(self, name)
        if name not in self._stored:
            self._stored[name] = stored(view(self.spark, self.sf_dir, name), name, clean=True)
        return self._stored[name]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, views: tuple[str, ...] = ()):
        """Decorator: register a function of :class:`Views` and the SQL that must give the same rows."""

        def register(build: Callable[[Views], DataFrame]):
            self.queries[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
            if sql is not None:
                self.sql[name] = oracle(sql, *views) if views else sql.strip()
            return build

        return register
