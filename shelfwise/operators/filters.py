"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose key columns are neither NULL nor ``''``."""
    return df.filter(reduce(lambda a, b: a & b, [~is_blank(c) for c in cols]))


def in_open_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Strict bounds; NULL is out."""
    return df.filter((F.col(col) > lo) & (F.col(col) < hi))


def any_of(df: DataFrame, *predicates: Column) -> DataFrame:
    """Keep rows for which at least one predicate is true."""
    return df.filter(reduce(lambda a, b: a | b, predicates))


def matches(df: DataFrame, col: str, pattern: str, negate: bool = False) -> DataFrame:
    """Regex search in the lower-cased text; NULL never passes."""
    hit = F.lower(F.col(col)).rlike(pattern)
    return df.filter(~hit if negate else hit)


def having(grouped: DataFrame, predicate: Column) -> DataFrame:
    """Filter on aggregated columns."""
    return grouped.filter(predicate)
