"""Reading: partition filters, scope filters, feed unions and schema conformance."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Values that mean "no restriction" in a scope (any case, trimmed). Fixed values.
NO_FILTER = ("", "*", "ALL", "NULL", "NONE")


def scan_partition(df: DataFrame, col: str, eq=None, ge=None, le=None, between=None) -> DataFrame:
    """Restrict a scan by one partition column; a literal predicate, so Spark prunes files."""
    if between is not None:
        ge, le = between
    predicates = [F.col(col) == eq] if eq is not None else []
    if ge is not None:
        predicates.append(F.col(col) >= ge)
    if le is not None:
        predicates.append(F.col(col) <= le)
    if not predicates:
        raise ValueError("scan_partition needs eq, ge, le or between")
    return df.filter(reduce(lambda a, b: a & b, predicates))


def scope_value(value: str | None) -> str | None:
    """A scope argument, or None when it stands for "everything"."""
    if value is None:
        return None
    text = str(value).strip()
    return None if text.upper() in NO_FILTER else text


def scope_filter(
    df: DataFrame,
    mode: str,
    month: str | None = None,
    platform: str | None = None,
    market: str | None = None,
    start_month: str | None = None,
) -> DataFrame:
    """Restrict by month, platform and market.

    ``incremental`` keeps the one month; ``full`` keeps every month from ``start_month`` on when a month is
    named, else every row that has a month. An argument listed in ``NO_FILTER`` does not restrict.
    """
    month, platform, market = scope_value(month), scope_value(platform), scope_value(market)
    if mode == "incremental":
        if month:
            df = df.filter(F.col("month_dt") == month)
    elif mode == "full":
        if month and not start_month:
            raise ValueError("full mode with a month needs start_month")
        df = df.filter(F.col("month_dt") >= start_month if month else F.col("month_dt").isNotNull())
    else:
        raise ValueError(f"unknown mode {mode!r}")
    for name, value in (("platform", platform), ("market", market)):
        if value:
            df = df.filter(F.col(name) == value)
    return df


def union_feeds(
    feeds: Mapping[str, tuple[DataFrame, Callable[[DataFrame], DataFrame]]],
    enabled: Iterable[str] | None = None,
) -> DataFrame:
    """Adapt every enabled feed and stack the results by column name."""
    names = list(feeds) if enabled is None else list(enabled)
    unknown = [n for n in names if n not in feeds]
    if unknown:
        raise ValueError(f"unknown feeds: {unknown}")
    if not names:
        raise ValueError("no feed is enabled")
    return reduce(DataFrame.unionByName, [feeds[n][1](feeds[n][0]) for n in names])


def conform(df: DataFrame, schema: T.StructType, values: Mapping[str, Column] | None = None) -> DataFrame:
    """Order and cast columns to ``schema``; extra columns go, absent ones become typed NULLs.

    ``values`` gives expressions for target columns that are not plain input columns. A value that cannot be
    cast becomes NULL.
    """
    values = values or {}
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        if field.name in values:
            source = values[field.name]
        elif field.name in present:
            source = F.col(field.name)
        else:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return source.try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def resolve_month_range(run_date: DataFrame, overrides: DataFrame, col: str = "run_dt") -> DataFrame:
    """Add ``month_dt, start_dt, end_dt``: the month before ``col``, with its day range.

    ``overrides(month_dt, start_dt, end_dt)`` replaces the calendar range of the months it lists; it is a
    configuration table with one row per month.
    """
    first = F.add_months(F.trunc(F.to_date(col), "MM"), -1)
    dated = run_date.withColumn("month_dt", F.date_format(first, "yyyy-MM-dd"))
    o = overrides.select("month_dt", F.col("start_dt").alias("_start"), F.col("end_dt").alias("_end"))
    both = F.col("_start").isNotNull() & (F.col("_start") != "") & F.col("_end").isNotNull() & (F.col("_end") != "")
    return (
        dated.join(o, "month_dt", "left")
        .withColumn("start_dt", F.when(both, F.col("_start")).otherwise(F.col("month_dt")))
        .withColumn("end_dt", F.when(both, F.col("_end")).otherwise(
            F.date_format(F.last_day(F.to_date("month_dt")), "yyyy-MM-dd")))
        .drop("_start", "_end")
        .select(*run_date.columns, "month_dt", "start_dt", "end_dt")
    )
