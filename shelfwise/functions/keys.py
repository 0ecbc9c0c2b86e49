"""Surrogate keys, derived join keys and the audit timestamp."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col


def surrogate_key(*cols: Column | str, sep: str = "||") -> Column:
    """64-bit hash of the columns as one separated text."""
    return F.xxhash64(F.concat_ws(sep, *[col(c).cast("string") for c in cols]))


def part_key(
    platform: Column | str = "platform", market: Column | str = "market", item: Column | str = "item_id",
    sku: Column | str = "pfsku_id", part: Column | str | None = None, month: Column | str = "month_dt",
    shop: Column | str = "shop_id", sep: str = "||",
) -> Column:
    """Key of one part of a listing-month. The part number is included, so parts of a bundle never collide."""
    number = F.lit("1") if part is None else F.coalesce(col(part).cast("string"), F.lit("1"))
    return surrogate_key(
        platform, F.coalesce(col(market), F.lit("cn")), item, sku, number, month,
        F.coalesce(col(shop).cast("string"), F.lit("0")), sep=sep,
    )


def on_platform(platform: Column | str, name: str) -> Column:
    return F.lower(col(platform)) == name


def effective_market(platform: Column | str, market: Column | str) -> Column:
    """Market where it is part of the listing key (Amazon), else ``''``."""
    return F.when(on_platform(platform, "amazon"), col(market)).otherwise(F.lit(""))


def effective_shop(platform: Column | str, shop: Column | str) -> Column:
    """Shop where it is part of the listing key (Suning), else ``'0'``."""
    return F.when(on_platform(platform, "suning"), col(shop).cast("string")).otherwise(F.lit("0"))


def product_key(platform: Column | str, item: Column | str, sku: Column | str) -> Column:
    """The SKU on Amazon, else the item."""
    return F.when(on_platform(platform, "amazon"), col(sku)).otherwise(col(item))


def audit_ts() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
