"""Crawl snapshots to SKU fact, best daily values, price facts, SKU dimension and translation candidates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions.crawl import parse_sales_text, region_of, sales_type, split_path
from ..functions.jsons import json_build, json_build_if_any
from ..functions.text import blank_to_null, cache_key, first_non_blank, flag, image_list, is_blank
from ..operators.collapse import best_fields, best_state, fields_of, merge_json, merge_states, shortest_first, source_rank
from ..operators.filters import require
from ..operators.joins import drop_in, enrich_by, keep_in
from ..operators.ordered import first_by_key
from ..operators.prices import at_min, not_blank, price_stats, valid
from ..sources.checkpoints import SLICE_ROWS, in_slices
from ..sources.scans import conform, resolve_month_range, union_feeds

# The value of a flag, and blank JSON. Fixed values.
YES_NO = {"YES": 1, "NO": 0}
EMPTY_JSON = "{}"


def _with_fields(df: DataFrame, prefix: str, names: Sequence[str]) -> DataFrame:
    """Add ``_<name>`` for the JSON keys ``<prefix>|<name>`` of ``sr``; the text is parsed once per row."""
    return df.select("*", F.json_tuple("sr", *[f"{prefix}|{n}" for n in names]).alias(*[f"_{n}" for n in names]))


def _with_units(df: DataFrame, region: str) -> DataFrame:
    return df.withColumn("_units", parse_sales_text("_sales_count", region))


def _sales() -> dict[str, Column]:
    return {"sell_count_str": blank_to_null("_sales_count", ()), "vague_sell_count": F.col("_units"),
            "sell_count_type": sales_type("_units")}


def adapt_menu(df: DataFrame, prefix: str, etl_source: str) -> DataFrame:
    """Menu feed: prices, rating and region come from the JSON; a row without a JSON region is dropped."""
    rows = _with_fields(df, prefix, (
        "region", "online_price", "list_price", "sales_count", "review_rating", "number_of_reviews",
        "expected_delivery_time", "delivery_destination")).filter(~is_blank("_region"))
    return conform(_with_units(rows, "_region"), S.SKU_FACT, {
        "sku_id": F.col("retailer_product_code"), "product_title": F.col("product_description"),
        "sku_online_price": blank_to_null("_online_price"), "sku_list_price": blank_to_null("_list_price"),
        **_sales(),
        "review_rating": blank_to_null("_review_rating"), "number_of_reviews": blank_to_null("_number_of_reviews"),
        "extra_json": json_build_if_any(
            expected_delivery_time="_expected_delivery_time", delivery_destination="_delivery_destination"),
        "region": F.upper("_region"), "etl_source": F.lit(etl_source),
    })


def adapt_menu_detail(df: DataFrame, prefix: str, etl_source: str) -> DataFrame:
    """Detail feed: most fields are columns; the region falls back to the URL host."""
    rows = _with_fields(df, prefix, (
        "region", "parent_asin", "online_price_currency", "sales_count", "seller", "seller_id"))
    rows = rows.withColumn("_place", region_of("_region", "url")).filter(~is_blank("_place"))
    return conform(_with_units(rows, "_place"), S.SKU_FACT, {
        "product_id": F.col("_parent_asin"),
        "sku_id": F.col("retailer_product_code"), "product_title": F.col("product_description"),
        "sku_online_price": blank_to_null("online_price"),
        "sku_online_price_currency": F.col("online_price_currency"),
        "sku_list_price": blank_to_null("list_price"),
        "sku_list_price_currency": F.coalesce(
            first_non_blank("_online_price_currency"), F.col("online_price_currency")),
        "promo": F.col("promotion"),
        **_sales(),
        "has_sku": flag("has_variants", YES_NO),
        "seller": F.col("_seller"), "seller_id": F.col("_seller_id"),
        "review_rating": blank_to_null("review_rating"), "number_of_reviews": blank_to_null("number_of_reviews"),
        "first_image": F.col("product_image"), "imags": image_list("secondary_image", "aplus_images"),
        "inventory": F.col("in_stock"), "region": F.col("_place"), "etl_source": F.lit(etl_source),
    })


def adapt_search(df: DataFrame, prefix: str, etl_source: str) -> DataFrame:
    """Search feed: list price and currencies come from the JSON; a row without a JSON region is dropped."""
    rows = _with_fields(df, prefix, (
        "region", "online_price_currency", "list_price", "list_price_currency", "sales_count",
    )).filter(~is_blank("_region"))
    return conform(_with_units(rows, "_region"), S.SKU_FACT, {
        "sku_id": F.col("product_code"), "product_title": F.col("product_name"), "url": F.col("product_url"),
        "sku_online_price": F.col("price"),
        "sku_online_price_currency": first_non_blank("_online_price_currency"),
        "sku_list_price": blank_to_null("_list_price"),
        "sku_list_price_currency": first_non_blank("_list_price_currency"),
        **_sales(),
        "review_rating": blank_to_null("review_rating"), "number_of_reviews": blank_to_null("number_of_reviews"),
        "first_image": F.col("product_image"),
        # The feed has columns of these names that the fact does not take from it.
        "category": F.lit(None), "sub_category": F.lit(None),
        "region": F.upper("_region"), "etl_source": F.lit(etl_source),
    })


ADAPTERS = {"menu": adapt_menu, "menu_detail": adapt_menu_detail, "search": adapt_search}


def sku_fact(
    feeds: Mapping[str, tuple[str, DataFrame, str]], prefix: str, enabled: Sequence[str] | None = None
) -> DataFrame:
    """SKU fact of several feeds. ``feeds`` maps a name to (adapter name, rows of the day, source label)."""
    unknown = [kind for kind, _, _ in feeds.values() if kind not in ADAPTERS]
    if unknown:
        raise ValueError(f"unknown feed types: {unknown}")
    return union_feeds({
        name: (df, lambda d, kind=kind, label=label: ADAPTERS[kind](d, prefix, label))
        for name, (kind, df, label) in feeds.items()
    }, enabled)


# Fields of the SKU fact that are chosen one by one. Fixed values.
BEST_FIELDS = (
    "product_id", "product_title", "url", "color", "size", "brand", "manufacturer", "has_sku",
    "variant_information", "category", "sub_category", "seller", "seller_id", "first_image", "imags", "video",
    "specifications", "additional_description", "extra_json", "snapshot_time",
)


def sku_daily(fact: DataFrame, priority: Sequence[str], fields: Sequence[str] = BEST_FIELDS) -> DataFrame:
    """Best value per field, SKU, region and day, with the JSON objects of all rows merged.

    Order: non-blank, source priority, latest snapshot, shortest title. The JSON falls back to the best single
    value when no object could be merged.
    """
    keys = ["sku_id", "region", "dt"]
    rows = require(fact, ["region", "sku_id"])
    rank = [-source_rank("etl_source", priority), F.col("snapshot_time")]
    best = best_fields(rows, keys, fields, [*rank, *shortest_first("product_title")],
                       blanks={"extra_json": (EMPTY_JSON,)})
    if "extra_json" in fields:
        with_json = rows.filter(~is_blank("extra_json", (EMPTY_JSON,)))
        merged = merge_json(with_json, keys, "extra_json", rank).withColumnRenamed("extra_json", "_merged")
        best = enrich_by(best, merged, keys).withColumn("extra_json", F.coalesce(
            F.col("_merged"), F.when(F.col("extra_json") != EMPTY_JSON, F.col("extra_json")))).drop("_merged")
    return conform(best.withColumn("etl_source", F.lit(None).cast("string")), S.SKU_DAILY)


def _sliced(fact: DataFrame, fields: Sequence[str], work, label: str, rows: int) -> DataFrame:
    """``work`` on slices of whole SKUs and regions, with the columns of the fact that :func:`sku_daily` reads."""
    read = dict.fromkeys(["sku_id", "region", "dt", "etl_source", "snapshot_time", "product_title", *fields])
    return in_slices(require(fact, ["region", "sku_id"]).select(*read), DIM_KEYS, work, label, rows)


def sku_daily_sliced(
    fact: DataFrame, priority: Sequence[str], fields: Sequence[str] = BEST_FIELDS, rows: int = SLICE_ROWS
) -> DataFrame:
    """:func:`sku_daily` of a long fact, slice by slice: the disk it takes between stages is that of one slice."""
    return _sliced(fact, fields, lambda part: sku_daily(part, priority, fields), "sku-daily", rows)


def sku_dimension_of_fact(
    fact: DataFrame, priority: Sequence[str], fields: Sequence[str] = BEST_FIELDS, rows: int = SLICE_ROWS
) -> DataFrame:
    """:func:`sku_dimension` over the :func:`sku_daily` rows of a long fact, both within one slice."""
    return _sliced(fact, fields, lambda part: sku_dimension(sku_daily(part, priority, fields)), "sku-dimension", rows)


def price_daily(fact: DataFrame) -> DataFrame:
    """Smallest valid price per SKU, region and day with its currency, product and feed."""
    keys = ["sku_id", "region", "dt"]
    rows = require(fact, ["region", "sku_id"])
    any_price = F.col("sku_online_price").isNotNull() | F.col("sku_list_price").isNotNull()
    latest = F.col("snapshot_time")

    def currency(price: str) -> Column:
        return at_min(price, f"{price}_currency", [not_blank(f"{price}_currency"), latest])

    daily = rows.groupBy(*keys).agg(
        F.max(any_price).alias("_priced"),
        at_min("sku_online_price", "product_id", [latest]).alias("product_id"),
        F.min(valid("sku_online_price")).alias("sku_online_price"),
        currency("sku_online_price").alias("sku_online_price_currency"),
        F.min(valid("sku_list_price")).alias("sku_list_price"),
        currency("sku_list_price").alias("sku_list_price_currency"),
        at_min("sku_online_price", "etl_source", [latest]).alias("_online_src"),
        at_min("sku_list_price", "etl_source", [latest]).alias("_list_src"),
    ).filter("_priced")
    info = json_build(sku_online_price="_online_src", sku_list_price="_list_src")
    return conform(daily.withColumn("price_info", info), S.PRICE_DAILY)


def price_monthly(daily: DataFrame, run_date: str | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """Monthly price statistics.

    With ``run_date`` only the month before it is read: its calendar days, or the day range that ``overrides``
    gives for that month. The range is one row, fetched first, so that the scan is pruned by literal dates.
    """
    rows = require(daily, ["region", "sku_id"])
    if run_date:
        spark = daily.sparkSession
        if overrides is None:
            overrides = spark.createDataFrame([], "month_dt string, start_dt string, end_dt string")
        day = spark.range(1).select(F.lit(run_date).alias("run_dt"))
        found = resolve_month_range(day, overrides).first()
        rows = rows.filter(F.col("dt").between(found["start_dt"], found["end_dt"]))
    month = F.date_format(F.to_date("dt"), "yyyy-MM-01")
    stats = price_stats(rows.withColumn("month_dt", month), ["sku_id", "region", "month_dt"])
    return conform(stats, S.PRICE_MONTHLY)


# Fields of the SKU dimension that are chosen one by one. Fixed values.
DIM_FIELDS = (
    "product_id", "product_title", "url", "color", "size", "brand", "brand_id", "std_brand_name", "manufacturer",
    "has_sku", "variant_information", "category", "sub_category", "seller", "seller_id", "first_image", "imags",
    "video", "specifications", "additional_description", "extra_json", "etl_source",
)


def sku_dimension(daily: DataFrame, until: str | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """Latest known value per field, SKU and region over the history, with category levels and the seen range.

    The sub-category comes from the row that supplied the category.
    """
    rows = require(daily, ["region", "sku_id"])
    if until:
        rows = rows.filter(F.col("dt") <= until)
    fields = fields or [f for f in DIM_FIELDS if f in daily.columns]
    dim = best_fields(
        rows, ["sku_id", "region"], fields, [F.col("snapshot_time")],
        paired={"sub_category": "category"}, blanks={"extra_json": (EMPTY_JSON,)},
        extra=[F.min("dt").alias("first_snapshot_dt"), F.max("snapshot_time").alias("last_snapshot_time")],
    )
    return conform(dim, S.SKU_DIM, split_path("sub_category", "category"))


DIM_KEYS, SEEN_FIRST, SEEN_LAST = ["sku_id", "region"], "first_snapshot_dt", "last_snapshot_time"


def dimension_state(daily: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """The mergeable state of :func:`sku_dimension` over some days, one row per SKU and region."""
    fields = fields or [f for f in DIM_FIELDS if f in daily.columns]
    return best_state(
        require(daily, ["region", "sku_id"]), DIM_KEYS, fields, [F.col("snapshot_time")],
        paired={"sub_category": "category"}, blanks={"extra_json": (EMPTY_JSON,)},
        least={SEEN_FIRST: F.col("dt")}, most={SEEN_LAST: F.col("snapshot_time")})


def add_day(state_path: str, day: DataFrame, fields: Sequence[str] | None = None) -> None:
    """Merge new days into the stored state: one pass over these days and the state, whatever the history.

    A day may be added again, and days in any order. The state is written as a new version beside the old one, which stays
    until the new one is whole; readers take the newest whole version.
    """
    spark, path = day.sparkSession, day.sparkSession._jvm.org.apache.hadoop.fs.Path
    versions = _versions(spark, state_path)
    new = dimension_state(day, fields)
    if versions:
        new = merge_states(spark.read.parquet(f"{state_path}/v={versions[-1]}"), new, DIM_KEYS, [SEEN_FIRST])
    new.write.mode("overwrite").parquet(f"{state_path}/v={versions[-1] + 1 if versions else 0}")
    fs = path(state_path).getFileSystem(spark._jsc.hadoopConfiguration())
    for old in versions:
        fs.delete(path(f"{state_path}/v={old}"), True)


def _versions(spark, state_path: str) -> list[int]:
    """The whole versions of a stored state; there are two at most."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(state_path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and fs.exists(path(f"{state_path}/{n}/_SUCCESS")))


def dimension_from_state(spark, state_path: str, fields: Sequence[str] | None = None) -> DataFrame:
    """The dimension of all days that were added to the stored state."""
    state = spark.read.parquet(f"{state_path}/v={_versions(spark, state_path)[-1]}")
    fields = fields or [f for f in DIM_FIELDS if f in state.columns]
    return conform(fields_of(state, fields), S.SKU_DIM, split_path("sub_category", "category"))


# Work-list task that asks for translations. Fixed value.
TRANSLATION_TASK = "amazon_translation"


def translation_candidates(
    work_list: DataFrame, dimension: DataFrame, cache: DataFrame | None = None, quota: int | None = None,
    done_today: int = 0, task: str = TRANSLATION_TASK,
) -> DataFrame:
    """Titles on the newest work list that have no cached translation; all of them unless a ``quota`` is given.

    With a quota, at most that many minus those done today: the titles with the smallest hash, so a run can be
    repeated.
    """
    asked = work_list.filter(F.col("task_type") == task)
    newest = asked.filter(F.col("etl_dt") == asked.select(F.max("etl_dt")).scalar())
    titled = require(keep_in(dimension, newest, ["sku_id"]), ["product_title", "brand"])
    wanted = titled.select("product_title", "brand", cache_key("product_title").alias("fields_hash")).distinct()
    if cache is not None:
        translated = require(cache, ["Fields_in_translation"]).select(F.col("Fields_hash").alias("fields_hash"))
        wanted = drop_in(wanted, translated, ["fields_hash"])
    if quota is None:
        return wanted
    # A title can occur with several brands; the quota counts rows, so the brand is part of the order key.
    keyed = wanted.withColumn("_key", F.concat("fields_hash", F.md5("brand")))
    return first_by_key(keyed, "_key", max(quota - done_today, 0)).drop("_key")
