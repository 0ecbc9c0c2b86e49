"""Target schemas. Column names, order and types are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType()}


def schema(columns: str) -> T.StructType:
    """A StructType from a list ``name type, name type``; unlike DDL parsing it needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# SKU fact: one row per SKU, region, snapshot day and feed.
SKU_FACT = schema("""
    product_id string, sku_id string, product_title string, url string,
    sku_online_price string, sku_online_price_currency string,
    sku_list_price string, sku_list_price_currency string,
    promo string, sell_count_str string, sell_count bigint, vague_sell_count bigint, sell_count_type string,
    color string, size string, brand string, manufacturer string, has_sku int, variant_information string,
    category string, sub_category string, category_ids string, seller string, seller_id string,
    review_rating string, number_of_reviews bigint, first_image string, imags string, video string,
    availability string, inventory string, comment_count_str string, comment_count bigint,
    vague_comment_count bigint, specifications string, additional_description string,
    batch_id string, task_id string, project string, crawl_status string, extra_json string,
    snapshot_time string, region string, dt string, etl_source string
""")

CATEGORY_LEVELS = ", ".join(f"category_{i}_id int, category_{i}_name string" for i in range(1, 10))

# Best value per field, SKU, region and day.
SKU_DAILY = schema(f"""
    product_id string, sku_id string, product_title string, url string, color string, size string,
    brand string, brand_id bigint, std_brand_name string, manufacturer string, has_sku int,
    variant_information string, category string, sub_category string, category_id string,
    category_name string, {CATEGORY_LEVELS}, seller string, seller_id string, first_image string,
    imags string, video string, specifications string, additional_description string,
    extra_json string, etl_source string, snapshot_time string, region string, dt string
""")

# SKU dimension: one row per SKU and region.
SKU_DIM = schema(f"""
    sku_id string, product_id string, product_title string, url string, color string, size string,
    brand string, brand_id bigint, std_brand_name string, manufacturer string, has_sku int,
    variant_information string, category string, sub_category string, category_id string,
    category_name string, {CATEGORY_LEVELS}, seller string, seller_id string, first_image string,
    imags string, video string, specifications string, additional_description string,
    extra_json string, etl_source string, first_snapshot_dt string, last_snapshot_time string,
    region string
""")

PRICE_DAILY = schema("""
    product_id string, sku_id string, sku_online_price double, sku_online_price_currency string,
    sku_list_price double, sku_list_price_currency string, price_info string, region string, dt string
""")

PRICE_MONTHLY = schema("""
    product_id string, sku_id string, sku_list_price double, sku_list_price_currency string,
    sku_online_price double, sku_online_price_currency string,
    sku_list_price_min double, sku_list_price_max double, sku_list_price_avg double,
    sku_list_price_mode double, sku_list_price_midrange double,
    sku_online_price_min double, sku_online_price_max double, sku_online_price_avg double,
    sku_online_price_mode double, sku_online_price_midrange double,
    region string, month_dt string
""")

TRANSLATION_CACHE = schema("Fields string, Fields_in_translation string, Fields_hash string")

_LEVELS = range(1, 7)
# Canonical listing attributes of all platforms and months.
MONTHLY_ATTRIBUTES = schema(
    "item_id string, pfsku_id string, item_title string, pfsku_title string, "
    + ", ".join(f"category_{i} string" for i in _LEVELS) + ", "
    + ", ".join(f"category_{i}_id string" for i in _LEVELS)
    + """, category_id bigint, category_name string, categories string, shop_id string, shop_name string,
    shop_type string, brand_id string, brand_name string, manufacturer string, properties string,
    shop_url string, item_url string, pfsku_url string, item_image string, item_images string,
    pfsku_image string, recommend_remark string, tags string, basic_info string, pfsku_title_cn string,
    sub_category string, sub_category_cn string, """
    + ", ".join(f"category_{i}_cn string" for i in _LEVELS)
    + ", platform string, month_dt string, market string"
)

MONTHLY_COUNT = schema("""
    item_id string, pfsku_id string, shop_id string, price double, item_unit_sales bigint,
    pfsku_unit_sales bigint, pfsku_unit_sales_src string, legacy_item_unit_sales bigint,
    legacy_pfsku_unit_sales bigint, is_multi_pfsku string, fix_count_ratio double,
    platform string, month_dt string, market string
""")

MONTHLY_PRICE = schema("""
    item_id string, pfsku_id string, shop_id string, page_price double, discount_price double,
    discount_price_src string, legacy_page_price double, legacy_discount_price double,
    platform string, month_dt string, market string
""")

PRODUCT_STATUS = schema("""
    item_id string, pfsku_id string, shop_id string, status string, status_src string,
    platform string, month_dt string, market string
""")

# Wide monthly sales.
WIDE_SALES = schema(
    "unique_id bigint, category_id bigint, category_name string, "
    + ", ".join(f"category_{i} string" for i in _LEVELS) + ", "
    + ", ".join(f"category_{i}_id string" for i in _LEVELS) + ", "
    + ", ".join(f"category_{i}_cn string" for i in _LEVELS)
    + """, shop_id string, shop_name string, unique_shop_name string, updated_shop_name string, shop_type string,
    shop_url string, brand_id string, brand_name string, ai_brand_name string, item_id string, item_url string,
    item_title string, item_image string, is_multi_pfsku string, pfsku_id string, pfsku_url string,
    pfsku_title string, pfsku_title_cn string, pfsku_image string, sub_category string, sub_category_cn string,
    is_bundle int, is_gift int, sku_src string, sku_title string, sku_no int, sku_num int, media string,
    std_category_name string, std_sub_category_name string, std_brand_name_ori string, std_brand_name string,
    manufacturer string, variant string, std_spu_name string, std_sku_name string, attributes string, package int,
    weight double, total_weight double, item_unit_sales bigint, pfsku_unit_sales bigint,
    pfsku_discount_price double, pfsku_page_price double, pfsku_value_sales double,
    pfsku_discountprice_value_sales double, pfsku_pageprice_value_sales double, sku_unit_sales bigint,
    sku_discount_price_tmp double, sku_discount_price double, sku_value_sales double, sku_value_ratio double,
    sku_value_ratio_src string, sku_value_ratio_fixed double, sku_page_price double,
    sku_pageprice_value_sales double, sku_discountprice_value_sales double, sku_volume_sales double,
    sku_pack_sales double, fix_count_ratio double, etl_updated_at string, product_listing_time string, """
    + ", ".join(f"std_category_{i} string" for i in _LEVELS)
    + ", platform string, month_dt string, market string"
)

WEEKLY_FORECAST = schema("""
    sku_id string, category_id string, category_name string, comments_number bigint,
    comments_score double, predicted_weekly_sales bigint, comments_number_diff bigint,
    days_diff double, dt string, prediction_dt string, next_week_dt string
""")

CALIBRATED_FORECAST = schema("""
    sku_id string, category_id string, category_name string, comments_number bigint,
    comments_score double, predicted_weekly_sales bigint, comments_number_diff bigint,
    days_diff double, origin_count bigint, weekly_count bigint, weekly_count_src string,
    dt string, prediction_dt string, next_week_dt string
""")
