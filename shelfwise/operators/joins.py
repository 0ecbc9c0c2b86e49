"""Keyed joins.

All joins are plain equi-joins on named or derived columns, so that Spark can shuffle, broadcast by measured size,
and split skewed partitions at run time. Nothing here forces a broadcast. Unless stated otherwise the right side should hold one row per key; where it does not, rows
multiply as in any join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import keys as K

# Columns that identify a listing-month in every feed; market and shop only count on some platforms.
LISTING_KEYS = ("platform", "month_dt", "item_id", "pfsku_id")


def enrich(df: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Left or inner join on equal column names."""
    return df.join(right, list(keys), how)


# Parts over which rows with a NULL key are spread in a join that they cannot match.
NULL_PARTS = 4096


def spread_nulls(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for rows with complete keys, else a number from 1 by a hash of the row."""
    hashed = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()
              and "variant" not in f.dataType.simpleString()]
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(missing, F.pmod(F.xxhash64(*hashed), F.lit(NULL_PARTS)) + 1).otherwise(F.lit(0).cast("long"))


def enrich_by(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join, for a right side that is partitioned by the keys (an aggregate), and for keys that may be NULL or hot.

    A join on the aggregate's own keys would reuse its partitioning, and adaptive execution does not split a hot key
    then. Compared null-safely, both sides are shuffled for the join alone and can be split. Rows with a NULL key match nothing; they are
    spread over many partitions, so that they never meet in one task.
    """
    other = totals.dropna(subset=list(keys)).withColumnsRenamed({k: f"_e_{k}" for k in keys})
    # 0 for every row, but no constant: the planner would turn an equality with one into a filter of the left rows.
    other = other.withColumn("_whole", F.pmod(F.xxhash64(*[F.col(f"_e_{k}") for k in keys]), F.lit(1).cast("long")))
    on = [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in keys] + [F.col("_spread") == F.col("_whole")]
    spread = df.withColumn("_spread", spread_nulls(df, keys))
    return spread.join(other, on, "left").drop(*[f"_e_{k}" for k in keys], "_spread", "_whole")


def keep_in(df: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs on the right."""
    return df.join(right.select(*keys), list(keys), "left_semi")


def drop_in(df: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur on the right."""
    return df.join(right.select(*keys), list(keys), "left_anti")


def with_listing_keys(df: DataFrame, case_insensitive: bool = True) -> DataFrame:
    """Add ``_k_*``: platform (any case on request), market where it matters, shop where it matters."""
    platform = F.lower("platform") if case_insensitive else F.col("platform")
    return df.withColumns({
        "_k_platform": platform,
        "_k_market": K.effective_market("platform", "market"),
        "_k_shop": K.effective_shop("platform", "shop_id"),
    })


def listing_join(
    df: DataFrame, right: DataFrame, cols: Mapping[str, str] | None = None, how: str = "left",
    case_insensitive: bool = True,
) -> DataFrame:
    """Join two tables of listing-months.

    The market is part of the key on Amazon only and the shop on Suning only, expressed as derived key columns.
    ``cols`` maps right columns to output names. ``left_semi`` and ``left_anti`` take no columns.
    """
    left = with_listing_keys(df, case_insensitive)
    keyed = with_listing_keys(right, case_insensitive)
    names = ["_k_platform", "_k_market", "_k_shop", "month_dt", "item_id", "pfsku_id"]
    extra = {} if how in ("left_semi", "left_anti") else dict(cols or {})
    other = keyed.select(*names, *[F.col(c).alias(f"_r_{out}") for c, out in extra.items()])
    joined = left.join(other, names, how)
    kept = [c for c in df.columns if c not in extra.values()]
    return joined.select(*kept, *[F.col(f"_r_{out}").alias(out) for out in extra.values()])


def null_safe_join(
    df: DataFrame, right: DataFrame, keys: Sequence[str], nullable: Sequence[str] = (), how: str = "left"
) -> DataFrame:
    """Join where NULL equals NULL on the ``nullable`` keys; keeps the left key columns."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [
        F.col(k).eqNullSafe(F.col(f"_r_{k}")) if k in nullable else F.col(k) == F.col(f"_r_{k}") for k in keys
    ])
    return df.join(other, on, how).drop(*[f"_r_{k}" for k in keys])


def axis_position(c: Column, kind: T.DataType) -> Column:
    """A number that never falls while the values of an ordered type rise: numbers cut off, texts by their first bytes."""
    if isinstance(kind, T.StringType):
        head = F.substring(F.concat(c.cast("binary"), F.lit(bytearray(7))), 1, 7)
        return F.conv(F.hex(head), 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(c.cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.greatest(F.least(c.cast("long"), F.lit(2**61)), F.lit(-(2**61)))
    bounded = F.greatest(F.least(c.cast("double"), F.lit(2.0**61)), F.lit(-(2.0**61)))  # NaN is the largest double
    return F.floor(bounded).cast("long")


def interval_join(
    df: DataFrame, right: DataFrame, keys: Sequence[str], point: str, start: str, end: str, how: str = "left"
) -> DataFrame:
    """Equal keys, and ``point`` within ``[start, end]`` of the right row; keeps the left key columns.

    The axis is cut into bins as wide as a power of two. An interval goes to the one or two bins that it touches at the
    width next to its own length, a point to its bin at every width that occurs; they meet by key, width and bin. So a hot key is
    spread along the axis, and the pairs that are compared are few times those that match. Points are looked up once
    per key and value; their rows get what was found by an equi-join. ``how`` is ``left`` or ``inner``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"an interval join is left or inner, not {how}")
    kind = df.schema[point].dataType
    at = {c: axis_position(F.col(c), right.schema[c].dataType) for c in (start, end)}
    names = {c: f"_i_{c}" for c in right.columns}
    wide = right.withColumns({"_from": at[start], "_to": at[end]}).filter("_from <= _to").withColumn(
        "_width", F.when(F.col("_from") == F.col("_to"), 0).otherwise(F.length(F.bin(F.col("_to") - F.col("_from")))).cast("int"))
    bins = wide.withColumnsRenamed(names).withColumn("_bin", F.explode(F.array_distinct(F.array(
        F.expr("shiftright(_from, _width)"), F.expr("shiftright(_to, _width)"))))).drop("_from", "_to")
    widths = wide.agg(F.collect_set("_width").alias("w")).scalar()  # at most 64 numbers
    points = df.select(*keys, point).dropna().distinct().withColumn("_at", axis_position(F.col(point), kind))
    spread = points.withColumn("_width", F.explode(widths)).withColumn("_bin", F.expr("shiftright(_at, _width)"))
    same = [F.col(k) == F.col(names[k]) for k in keys]
    met = spread.alias("p").join(bins.alias("i"), reduce(lambda a, b: a & b, [
        *same, F.col("p._width") == F.col("i._width"), F.col("p._bin") == F.col("i._bin")])).filter(
        F.col(point).between(F.col(names[start]), F.col(names[end])))
    others = [c for c in right.columns if c not in keys]
    found = met.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(point).alias("_point"),
                       *[F.col(names[c]) for c in others])
    on = reduce(lambda a, b: a & b, [*[F.col(k) == F.col(f"_k_{k}") for k in keys], F.col(point) == F.col("_point")])
    joined = df.join(found, on, how).drop(*[f"_k_{k}" for k in keys], "_point")
    return joined.withColumnsRenamed({names[c]: c for c in others})


def with_scalar(df: DataFrame, source: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Put aggregates over all rows of ``source`` on every row of ``df``, each as a scalar subquery."""
    return df.withColumns({name: source.agg(a.alias(name)).scalar() for name, a in aggregates.items()})


def period_before(c: Column | str, periods: int, step_days: int = 7) -> Column:
    """The date text ``periods`` steps earlier, in its own format (``yyyy-MM-dd`` or ``yyyyMMdd``)."""
    text = F.col(c) if isinstance(c, str) else c
    dashed = F.contains(text, F.lit("-"))
    day = F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "yyyyMMdd"))
    moved = F.date_sub(day, periods * step_days)
    return F.when(dashed, F.date_format(moved, "yyyy-MM-dd")).otherwise(F.date_format(moved, "yyyyMMdd"))


def lag_periods(
    df: DataFrame, current: DataFrame, key: str, period: str, values: Sequence[str], lags: Sequence[int],
    step_days: int = 7,
) -> DataFrame:
    """Add ``<value>_prev<n>`` of the same key ``n`` steps before the row's own period.

    One pass over the history: every history row is sent forward to the periods that look back at it and folded
    to one row per key and period, instead of one self-join per lag. With several history rows for a key and
    period the largest value counts.
    """
    steps = F.array(*[F.lit(n) for n in lags])
    ahead = df.select(
        F.col(key).alias("_key"), F.explode(steps).alias("_lag"), F.col(period).alias("_at"), *values
    )
    looking = F.coalesce(*[
        F.when(F.col("_lag") == n, period_before(F.col("_at"), -n, step_days)) for n in lags
    ])
    history = ahead.groupBy("_key", looking.alias("_for")).agg(*[
        F.max(F.when(F.col("_lag") == n, F.col(v))).alias(f"{v}_prev{n}") for n in lags for v in values
    ])
    on = (F.col(key) == F.col("_key")) & (F.col(period) == F.col("_for"))
    return current.join(history, on, "left").drop("_key", "_for")


def override(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], col: str | Sequence[str], from_col: str, label: str,
    src_col: str | None = None,
) -> DataFrame:
    """Replace ``col`` by the lookup value where there is one, and note ``label`` in ``src_col``."""
    targets = [col] if isinstance(col, str) else list(col)
    other = lookup.select(*keys, F.col(from_col).alias("_new"))
    out = enrich_by(df, other, keys)
    changes = {c: F.coalesce(F.col("_new"), F.col(c)) for c in targets}
    if src_col:
        old = F.col(src_col) if src_col in df.columns else F.lit(None).cast("string")
        changes[src_col] = F.when(F.col("_new").isNotNull(), F.lit(label)).otherwise(old)
    columns = list(df.columns) + [c for c in changes if c not in df.columns]
    return out.withColumns(changes).select(*columns)


def annotation_join(df: DataFrame, annotated: DataFrame, cols: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join annotations keyed by place and product.

    On Amazon the place is the market, the product the SKU and the month does not matter; elsewhere the place is
    the platform, the product the item, and the month counts. ``annotated`` has ``platform, product_id, sku_id,
    month_dt``; its ``platform`` holds the place. Several Amazon months of one product multiply rows, so give
    one row per product there.
    """
    amazon = K.on_platform("platform", "amazon")
    left = df.withColumns({
        "_place": F.lower(F.when(amazon, F.col("market")).otherwise(F.col("platform"))),
        "_product": K.product_key("platform", "item_id", "pfsku_id"),
        "_sku": F.col("pfsku_id"),
        # An Amazon row meets the copy of the annotation that carries no month.
        "_month": F.when(amazon, F.lit("")).otherwise(F.col("month_dt")),
    })
    names = ["_place", "_product", "_sku", "_month"]
    columns = [F.col(c).alias(f"_r_{out}") for c, out in cols.items()]
    other = annotated.withColumns({
        "_place": F.lower("platform"), "_product": F.col("product_id"), "_sku": F.col("sku_id"),
        "_month": F.explode(F.array(F.col("month_dt"), F.lit(""))),
    }).select(*names, *columns)
    joined = left.join(other, names, how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*df.columns)
    kept = [c for c in df.columns if c not in cols.values()]
    return joined.select(*kept, *[F.col(f"_r_{out}").alias(out) for out in cols.values()])
