"""Data-quality checks of the monthly price table, as one report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .history import attach
from .prices import distinct_count, mode_low, valid

PRICES = ("sku_list_price", "sku_online_price")
TOLERANCE = 0.001


def differs(a: Column | str, b: Column | str, tolerance: float = TOLERANCE) -> Column:
    """True when the values are apart by the tolerance or more, or exactly one of them is NULL."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.coalesce(F.abs(a - b) >= tolerance, a.isNull() != b.isNull())


def any_true(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def run_checks(
    target: DataFrame, upstream: DataFrame, keys: Sequence[str] = ("sku_id", "region", "month_dt"),
    prices: Sequence[str] = PRICES,
) -> DataFrame:
    """Report ``(check, violations, passed)`` of a monthly price table against the daily prices it came from.

    ``upstream`` has the keys (with the month as a column) and the daily prices. Statistics are derived again here,
    independently of the job that built the target. The row checks are counted in one pass over the target.
    """
    keys = list(keys)
    priced = upstream.filter(any_true([F.col(p).isNotNull() for p in prices]))

    derived = priced.groupBy(*keys).agg(*[
        f(valid(p)).alias(f"_{p}_{name}") for p in prices
        for name, f in (("min", F.min), ("max", F.max), ("avg", F.avg))
    ])
    modes = mode_low(priced, keys, prices).select(*keys, *[F.col(f"{p}_mode").alias(f"_{p}_mode") for p in prices])
    expected = derived.join(modes, keys, "left")
    counted = attach(target, keys, [F.count(F.lit(1)).alias("_rows")]).join(expected, keys, "left")

    row_checks = {
        "key_unique": F.col("_rows") > 1,
        "min_max_avg": any_true([
            differs(f"{p}_{s}", f"_{p}_{s}") for p in prices for s in ("min", "max", "avg")]),
        "default_is_min": any_true([differs(p, f"{p}_min") for p in prices]),
        "midrange_is_null": any_true([F.col(f"{p}_midrange").isNotNull() for p in prices]),
        "mode": any_true([differs(f"{p}_mode", f"_{p}_mode") for p in prices]),
        "not_negative": any_true([F.col(c) < 0 for p in prices for c in (p, f"{p}_min")]),
        "price_has_currency": any_true([
            F.col(p).isNotNull() & F.coalesce(F.col(f"{p}_currency") == "", F.lit(True)) for p in prices]),
    }
    totals = counted.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(c).alias(name) for name, c in row_checks.items()],
        distinct_count(*keys).alias("_found"),
    )
    both = totals.withColumn("_wanted", priced.agg(distinct_count(*keys).alias("_wanted")).scalar())
    violations = {
        "not_empty": F.when(F.col("_n") == 0, 1).otherwise(0),
        **{name: F.col(name) for name in row_checks},
        "complete": F.abs(F.col("_found") - F.col("_wanted")),
    }
    report = both.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), v.cast("bigint").alias("violations")) for name, v in violations.items()
    ])).alias("r")).select("r.check", "r.violations")
    return report.withColumn("passed", F.col("violations") == 0)
