"""Literal forms of four operators next to the forms used here, over the same written inputs.

The literal forms are what the jobs in the survey do: one window per field, a re-join after a minimum with one window
per attribute, rules as Python per row, and one self-join per lag.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Window, functions as F

from registry.base import Views
from registry.crawl import DAILY
from registry.joins import LISTING
from registry.rules import BRAND, CATEGORY
from shelfwise.operators import forecast, rules as Q
from shelfwise.operators.collapse import source_rank
from shelfwise.plans import crawl

PRIORITY = ["feed_a", "feed_r"]


def window_per_field(rows):
    keys = ["sku_id", "region", "dt"]
    rank = source_rank("etl_source", PRIORITY)

    def first(field):
        w = Window.partitionBy(*keys).orderBy(
            F.when(F.coalesce(field, F.lit("")) != "", 0).otherwise(1), rank, F.desc("snapshot_time"),
            F.length("product_title").asc_nulls_first(), F.desc_nulls_last(field))
        return F.first(field).over(w)

    whole = Window.partitionBy(*keys).orderBy(rank, F.desc("snapshot_time"))
    picked = rows.select(*keys, *[first(f).alias(f) for f in DAILY], F.row_number().over(whole).alias("rn"))
    return picked.filter("rn = 1").drop("rn")


def best_fields(rows):
    return crawl.sku_daily(rows, PRIORITY, DAILY).drop("etl_source")


def rejoin_after_min(rows):
    keys = ["sku_id", "region", "dt"]
    prices = ("sku_online_price", "sku_list_price")
    low = rows.filter("sku_online_price IS NOT NULL OR sku_list_price IS NOT NULL").groupBy(*keys).agg(
        *[F.min(F.when(F.col(p) > 0, F.col(p))).alias(f"low_{p}") for p in prices])
    both = rows.join(low, keys)

    def at_low(price, attr, known):
        order = [F.when(F.col(price) == F.col(f"low_{price}"), 0).otherwise(1)]
        order += [F.when(F.coalesce(attr, F.lit("")) != "", 0).otherwise(1)] if known else []
        return F.first(attr).over(Window.partitionBy(*keys).orderBy(
            *order, F.desc("snapshot_time"), F.desc_nulls_last(attr)))

    rank = Window.partitionBy(*keys).orderBy(F.desc("snapshot_time"))
    picked = both.select(
        *keys, *[F.col(f"low_{p}").alias(p) for p in prices], F.row_number().over(rank).alias("rn"),
        at_low("sku_online_price", "product_id", False).alias("product_id"),
        *[at_low(p, f"{p}_currency", True).alias(f"{p}_currency") for p in prices],
        *[at_low(p, "etl_source", False).alias(f"{p}_source") for p in prices])
    return picked.filter("rn = 1").drop("rn")


def price_daily(rows):
    out = crawl.price_daily(rows)
    sources = [F.get_json_object("price_info", f"$.{p}").alias(f"{p}_source") for p in ("sku_online_price", "sku_list_price")]
    return out.select("*", *sources).drop("price_info")


def rules_per_row(rows):
    def transform(part):
        for row in part:
            r = row.asDict()
            if r["brand_name"] == "Brand#2":
                r["std_brand_name"], r["brand_src"] = "B2", "5,1"
            if r["std_brand_name"] == "B2":
                r["std_category_2"], r["category_src"] = "C2", "6,1"
            yield tuple(r[c] for c in columns)

    ready = rows.select(*LISTING, "brand_name", F.col("brand_name").alias("std_brand_name"),
                        F.col("category_1").alias("std_category_2"), F.lit(None).cast("string").alias("brand_src"),
                        F.lit(None).cast("string").alias("category_src"))
    columns = ready.columns
    return rows.sparkSession.createDataFrame(ready.repartition(8).rdd.mapPartitions(transform), ready.schema)


def rules_as_columns(rows):
    ready = rows.select(*LISTING, "brand_name", F.col("brand_name").alias("std_brand_name"),
                        F.col("category_1").alias("std_category_2"), F.lit(None).cast("string").alias("brand_src"),
                        F.lit(None).cast("string").alias("category_src"))
    return Q.apply_chain(ready, [
        {"rules": BRAND, "results": {"std_brand_name": "std_brand_name"}, "src_col": "brand_src"},
        {"rules": CATEGORY, "results": {"std_category_2": "std_category_2"}, "src_col": "category_src"}])


def join_per_lag(rows):
    week = rows.agg(F.max("next_week_dt")).first()[0]
    out = rows.filter(F.col("next_week_dt") == week).select("product_id", "comments_number")
    for n in (1, 2, 3):
        earlier = F.date_format(F.date_sub(F.lit(week).cast("date"), 7 * n), "yyyy-MM-dd")
        past = rows.filter(F.col("next_week_dt") == earlier).select(
            "product_id", F.col("comments_number").alias(f"comments_number_prev{n}"))
        out = out.join(past, "product_id", "left")
    return out


def one_pass_lags(rows):
    return forecast.weekly_features(rows).select(
        "product_id", "comments_number", *[f"comments_number_prev{n}" for n in (1, 2, 3)])


PAIRS = {
    "best value per field": ("sku_snapshot", window_per_field, best_fields),
    "price daily": ("sku_snapshot", rejoin_after_min, price_daily),
    "rules": ("listing_month", rules_per_row, rules_as_columns),
    "weekly lags": ("weekly_reviews", join_per_lag, one_pass_lags),
}


def forms(spark, sf_dir):
    """``{name: {"literal": build, "ours": build}}``, after checking that both give the same rows."""
    views, out = Views(spark, sf_dir), {}
    for name, (view, literal, ours) in PAIRS.items():
        rows = views.stored(view)
        columns = sorted(ours(rows).columns)
        same = [Counter(map(tuple, f(rows).select(*columns).collect())) for f in (literal, ours)]
        if same[0] != same[1]:
            raise AssertionError(f"{name}: the forms differ")
        out[name] = {"literal": lambda f=literal, r=rows: f(r), "ours": lambda f=ours, r=rows: f(r)}
    return out
