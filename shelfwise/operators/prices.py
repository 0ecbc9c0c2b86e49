"""Daily and monthly price facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank


def valid(c: Column | str) -> Column:
    """The price as a number if it is greater than 0, else NULL."""
    number = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(number > 0, number)


def valid_min(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Smallest valid price per key, for keys with at least one price."""
    any_price = F.coalesce(*[F.col(c).cast("string") for c in cols]).isNotNull()
    return df.filter(any_price).groupBy(*keys).agg(*[F.min(valid(c)).alias(c) for c in cols])


def at_min(price: str, attr: str, then: Sequence[Column]) -> Column:
    """Aggregate: ``attr`` of the row with the smallest valid price, by ``then`` (largest first) among equals.

    When no price is valid all rows compete by ``then``. This needs no second pass: rows without a valid price
    order below all others.
    """
    return F.max_by(F.col(attr), F.struct((-valid(price)).alias("p"), *then, F.col(attr)))


def not_blank(c: str) -> Column:
    return ~is_blank(c)


def fixed_sum(c: Column | str) -> Column:
    """Aggregate: a sum of doubles that does not depend on the order of its additions.

    Numbers below 10^12 are added as ``decimal(38,16)``, those up to 10^24 as ``decimal(38,4)``, so a number counts to its 16th
    or 4th digit after the point and each sum holds 10^10 numbers at least. Larger ones, infinity and NaN are added
    as doubles. NULL when there is no number.
    """
    number = (F.col(c) if isinstance(c, str) else c).cast("double")
    small, wide = F.abs(number) < 1e12, F.abs(number) < 1e24
    parts = [
        F.sum(F.when(small, number.try_cast("decimal(38,16)"))), F.sum(F.when(wide & ~small, number.try_cast("decimal(38,4)"))),
        F.sum(F.when(~wide, number))]
    some = F.coalesce(*[p.cast("double") for p in parts])
    return F.when(some.isNotNull(), sum((F.coalesce(p.cast("double"), F.lit(0.0)) for p in parts[1:]),
                                        F.coalesce(parts[0].cast("double"), F.lit(0.0))))


def group_avg(df: DataFrame, keys: Sequence[str], col: str, predicate: Column, out: str | None = None) -> DataFrame:
    """Average per key over the rows that satisfy the predicate; equal however the rows are spread."""
    return df.filter(predicate).groupBy(*keys).agg(F.try_divide(fixed_sum(col), F.count(col)).alias(out or col))


def sum_if(c: Column | str, predicate: Column) -> Column:
    """Conditional sum; 0 for rows that do not count, NULL only when all counted values are NULL."""
    return F.sum(F.when(predicate, F.col(c) if isinstance(c, str) else c).otherwise(F.lit(0)))


def distinct_count(*cols: str) -> Column:
    """Distinct composite values; tuples with a NULL do not count."""
    return F.count_distinct(*[F.col(c) for c in cols])


def set_concat(c: str, sep: str = ",") -> Column:
    """Distinct values in order, joined."""
    return F.array_join(F.sort_array(F.collect_set(c)), sep)


def mode_low(df: DataFrame, keys: Sequence[str], cols: Sequence[str], only_valid: bool = True) -> DataFrame:
    """Most frequent price per key and column, the lower one on ties.

    Prices are counted by (key, column, price) first, so a key with very many rows reaches the second step as
    one row per distinct price.
    """
    counted = _histogram(df, keys, {c: {} for c in cols}, only_valid)
    return counted.groupBy(*keys).agg(*[_mode(c).alias(f"{c}_mode") for c in cols])


def _mode(kind: str) -> Column:
    seen = (F.col("_kind") == kind) & F.col("_price").isNotNull()
    return F.max_by(F.col("_price"), F.when(seen, F.struct(F.col("_n"), -F.col("_price"))))


def _histogram(
    df: DataFrame, keys: Sequence[str], kinds: Mapping[str, Mapping[str, Column]], only_valid: bool = True
) -> DataFrame:
    """One row per key, price column and distinct price: its count and, per named order, the best attribute.

    ``kinds[price][name]`` is a struct whose largest value is kept as ``name``.
    """
    names = sorted({n for attrs in kinds.values() for n in attrs})

    def entry(price: str) -> Column:
        value = valid(price) if only_valid else F.col(price).try_cast("double")
        best = [kinds[price][n].alias(n) if n in kinds[price] else F.lit(None).alias(n) for n in names]
        return F.struct(F.lit(price).alias("_kind"), value.alias("_price"), *best)

    rows = df.select(*keys, F.explode(F.array(*[entry(p) for p in kinds])).alias("_e"))
    return rows.groupBy(*keys, F.col("_e._kind").alias("_kind"), F.col("_e._price").alias("_price")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(F.col(f"_e.{n}")).alias(n) for n in names]
    )


def price_stats(df: DataFrame, keys: Sequence[str], period: str = "dt") -> DataFrame:
    """Monthly statistics of list and online price over valid (> 0) daily prices.

    Default price is the minimum; the mode is the most frequent valid price over the whole month, the lower one
    on ties; the midrange stays NULL. The currency comes from the cheapest row, non-blank first, then latest. The
    product id comes from the cheapest list price, else from the latest row that has one.
    """
    def latest(attr: str) -> Column:
        return F.struct(not_blank(attr).alias("known"), F.col(period).alias("at"), F.col(attr).alias("value"))

    any_price = F.col("sku_online_price").isNotNull() | F.col("sku_list_price").isNotNull()
    counted = _histogram(df.filter(any_price), keys, {
        "sku_list_price": {"_cur": latest("sku_list_price_currency"), "_product": latest("product_id")},
        "sku_online_price": {"_cur": latest("sku_online_price_currency"), "_product": latest("product_id")},
    })

    def of(kind: str) -> Column:
        return F.when(F.col("_kind") == kind, F.col("_price"))

    def average(kind: str) -> Column:
        return F.try_divide(fixed_sum(of(kind) * F.col("_n")), F.sum(F.when(of(kind).isNotNull(), F.col("_n"))))

    def currency(kind: str) -> Column:
        rank = F.when(F.col("_kind") == kind, F.struct(-F.col("_price"), F.col("_cur")))
        return F.max_by(F.col("_cur.value"), rank)

    listed = F.col("_kind") == "sku_list_price"
    known = listed & F.col("_product.known")
    product = F.coalesce(
        # ``nullif`` with the known flag: only a non-blank id of the cheapest list price counts here.
        F.max_by(F.when(F.col("_product.known"), F.col("_product.value")),
                 F.when(listed & F.col("_price").isNotNull(), -F.col("_price"))),
        F.max_by(F.col("_product.value"), F.when(known, F.col("_product"))),
        F.max_by(F.col("_product.value"), F.when(listed, F.col("_product"))),
    )
    stats = []
    for kind in ("sku_list_price", "sku_online_price"):
        stats += [
            F.min(of(kind)).alias(kind), currency(kind).alias(f"{kind}_currency"),
            F.min(of(kind)).alias(f"{kind}_min"), F.max(of(kind)).alias(f"{kind}_max"),
            average(kind).alias(f"{kind}_avg"), _mode(kind).alias(f"{kind}_mode"),
            F.lit(None).cast("double").alias(f"{kind}_midrange"),
        ]
    return counted.groupBy(*keys).agg(product.alias("product_id"), *stats)
