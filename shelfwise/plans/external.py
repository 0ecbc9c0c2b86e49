"""Prices of an external feed before own prices, and rule prices before both."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import override
from ..operators.rules import RuleSet, override_numeric

# Platform that the feed covers. Fixed value.
FEED_PLATFORM = "douyin"


def clean_feed(feed: DataFrame, first_month: str, last_month: str, platform: str = FEED_PLATFORM) -> DataFrame:
    """Rows of the month range with a price above 0, under the feed's platform name."""
    return feed.filter((F.col("price") > 0) & F.col("month_dt").between(first_month, last_month)).withColumn(
        "platform", F.lit(platform))


def external_price(
    price: DataFrame, feed: DataFrame, rules: RuleSet, label: str, result: str = "price",
) -> DataFrame:
    """Feed price over own prices, then rule price over both; the source says which one counted."""
    keys = ["platform", "item_id", "month_dt"]
    fed = override(price, feed, keys, ["page_price", "discount_price"], "price", label, "discount_price_src")
    return override_numeric(fed, rules, result, ["page_price", "discount_price"], "discount_price_src")
