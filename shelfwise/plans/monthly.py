"""Monthly listing tables: attributes, mapping origin, standard mapping, fixed price and count, status, wide sales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions import keys as K, measures as M
from ..functions.text import clean_text, nfkc_in_market, part_title, rewrite_url, sku_title
from ..operators.collapse import keep_first
from ..operators.filters import in_open_range
from ..operators.history import attach, count_over
from ..operators.joins import annotation_join, drop_in, enrich, enrich_by, listing_join, null_safe_join, override
from ..operators.prices import group_avg
from ..operators.rules import (
    EXCLUDE, RuleSet, apply_rules, exclusions, override_numeric, override_then_scale,
)
from ..sources.scans import conform, scope_filter, scope_value, union_feeds

CN = "cn"
_C = [f"category_{i}" for i in range(1, 7)]
_IMAGES = ["item_image", "item_images"]
_DETAILS = ["tags", "basic_info"]
_CATEGORY = ["category_id", "category_name"]
_SHOP = ["shop_id", "shop_name"]
_BRAND = ["brand_id", "brand_name"]


def _ids(n: int) -> list[str]:
    return [f"category_{i}_id" for i in range(1, n + 1)]


def _names(n: int) -> dict[str, str]:
    return {f"category_{i}": f"category_{i}_name" for i in range(1, n + 1)}


# Per platform: the canonical columns its feed has under the same name, and the renamed ones. Columns named in
# neither list are NULL. Fixed values.
PLATFORM_COLUMNS: dict[str, tuple[list[str], dict[str, str]]] = {
    "Tmall": (["pfsku_id", "item_title", "pfsku_title", *_C[:3], *_CATEGORY, "categories", *_SHOP, *_BRAND,
               "properties", "shop_url", "item_url", "pfsku_url", *_IMAGES, "pfsku_image", *_DETAILS], {}),
    "Amazon": (["pfsku_id", "pfsku_title", *_C[:5], "category_name", *_SHOP, "brand_name", "manufacturer",
                "pfsku_url", "pfsku_image", "pfsku_title_cn", "sub_category", "sub_category_cn",
                *[f"{c}_cn" for c in _C[:5]], "market"], {}),
    "JD": (["item_title", "pfsku_title", *_C[:4], *_ids(4), *_CATEGORY, "categories", *_SHOP, *_BRAND,
            "shop_url", "item_url", *_IMAGES, *_DETAILS], {"pfsku_id": "item_id", "shop_type": "store_type"}),
    "PDD": (["item_title", *_C[:4], *_CATEGORY, "categories", *_SHOP, *_BRAND, "shop_url", "item_url",
             *_IMAGES, *_DETAILS], {"pfsku_id": "item_id"}),
    "Suning": (["item_title", *_ids(3), "categories", *_SHOP, *_BRAND, "shop_url", "item_url", *_IMAGES,
                *_DETAILS], {"pfsku_id": "item_id", **_names(3), "category_id": "category_3_id",
                             "category_name": "category_3_name"}),
    "Taobao": (["item_title", *_C[:3], *_CATEGORY, "categories", *_SHOP, *_BRAND, "shop_url", "item_url",
                *_IMAGES, *_DETAILS], {"pfsku_id": "item_id"}),
    "VIP": (["item_title", *_C[:3], *_ids(3), *_CATEGORY, "categories", *_BRAND, "item_url", *_IMAGES,
             *_DETAILS], {"pfsku_id": "item_id"}),
    "Douyin": (["item_title", *_ids(4), "categories", "shop_name", "brand_name", "shop_url", "item_url",
                *_IMAGES, "recommend_remark", *_DETAILS],
               {"pfsku_id": "item_id", **_names(4), "category_id": "category_4_id",
                "category_name": "category_4_name", "shop_id": "store_id"}),
    "Kaola": (["item_title", *_C, *_ids(6), *_CATEGORY, *_SHOP, *_BRAND, "item_url", *_DETAILS],
              {"pfsku_id": "item_id"}),
    "Kuaishou": (["item_title", *_C[:3], "category_name", *_SHOP, "shop_type", "brand_name"],
                 {"pfsku_id": "item_id"}),
}
# The patch feed already has the canonical columns, but no manufacturer and no translated SKU title. Fixed values.
PATCH_ABSENT = ("manufacturer", "pfsku_title_cn")


def adapt_platform(df: DataFrame, platform: str) -> DataFrame:
    """One platform feed in the canonical schema; every platform but Amazon belongs to the market ``cn``."""
    same, renamed = PLATFORM_COLUMNS[platform]
    columns = {**{c: c for c in ["item_id", "month_dt", *same]}, **renamed}
    values = {f.name: F.col(columns[f.name]) if f.name in columns else F.lit(None)
              for f in S.MONTHLY_ATTRIBUTES.fields}
    values["platform"] = F.lit(platform)
    if "market" not in columns:
        values["market"] = F.lit(CN)
    return conform(df, S.MONTHLY_ATTRIBUTES, values)


def adapt_patch(df: DataFrame) -> DataFrame:
    return conform(df, S.MONTHLY_ATTRIBUTES, {c: F.lit(None) for c in PATCH_ABSENT})


def monthly_attributes(
    feeds: Mapping[str, DataFrame], patch: DataFrame | None, mode: str, month: str | None = None,
    platform: str | None = None, market: str | None = None, start_month: str | None = None,
) -> DataFrame:
    """Canonical listing attributes of all platforms plus the patch feed, in scope.

    Feeds that the scope rules out are not read: other platforms, and feeds of the market ``cn`` when another
    market is asked for.
    """
    unknown = [p for p in feeds if p not in PLATFORM_COLUMNS]
    if unknown:
        raise ValueError(f"unknown platforms: {unknown}")
    wanted_platform, wanted_market = scope_value(platform), scope_value(market)

    def in_reach(name: str) -> bool:
        if wanted_platform and name != wanted_platform:
            return False
        own_market = "market" in PLATFORM_COLUMNS[name][0]
        return own_market or not wanted_market or wanted_market.lower() == CN

    used = {
        name: (
            scope_filter(df, mode, month, None, market if "market" in df.columns and name == "Amazon" else None,
                         start_month),
            lambda d, name=name: adapt_platform(d, name),
        )
        for name, df in feeds.items() if in_reach(name)
    }
    if patch is not None:
        used["patch"] = (scope_filter(patch, mode, month, platform, market, start_month), adapt_patch)
    return union_feeds(used)


# Label of the price that the sales feed itself gives. Fixed value.
FEED_PRICE = "月销表价格"


def split_feed(sales: DataFrame) -> dict[str, DataFrame]:
    """One sales feed as attribute, count and price tables; rows without SKU or market are dropped."""
    rows = sales.filter(F.col("pfsku_id").isNotNull() & F.col("market").isNotNull())
    attributes = ["item_id", *PLATFORM_COLUMNS["Amazon"][0], "month_dt"]
    return {
        "attributes": rows.select(*[c for c in attributes if c in rows.columns]),
        "count": rows.select("item_id", "pfsku_id", "pfsku_unit_sales", "market", "month_dt"),
        "price": rows.select("item_id", "pfsku_id", "page_price", "discount_price",
                             F.lit(FEED_PRICE).alias("discount_price_src"), "market", "month_dt"),
    }


LISTING = ("month_dt", "platform", "item_id", "pfsku_id", "shop_id", "market")


def mapping_origin(
    attributes: DataFrame, annotated: DataFrame, weights: DataFrame, threshold: float,
    brands: DataFrame | None = None, annotation_label: str = "pfsku_package_splited",
) -> DataFrame:
    """Keyed parts: annotated listings split into their parts, all others as one part with a measured weight.

    ``annotated(platform, item_id, pfsku_id, month_dt, market, sku_no, sku_title, is_bundle, is_gift, package,
    weight)`` has several rows per listing; ``weights(platform, item_id, pfsku_id, month_dt, weight_all_in_g,
    package_all)`` one. ``brands`` holds annotated brands for :func:`annotation_join`.
    """
    keys = ["_p", "item_id", "pfsku_id", "month_dt", "_m"]
    base = attributes.withColumns({
        "_p": F.lower("platform"), "_m": K.effective_market("platform", "market"),
        "market": F.coalesce("market", F.lit(CN)),
    })
    parts = annotated.withColumns({"_p": F.lower("platform"), "_m": K.effective_market("platform", "market")}) \
        .select(*keys, *[F.col(c).alias(f"_a_{c}") for c in
                         ("sku_no", "sku_title", "is_bundle", "is_gift", "package", "weight")])
    measured = weights.select(
        F.lower("platform").alias("_p"), "item_id", "pfsku_id", "month_dt", "weight_all_in_g", "package_all")
    # One join tells annotated listings from the others; a listing's rows are all of one kind.
    joined = base.join(parts.withColumn("_hit", F.lit(True)), keys, "left").join(
        measured, ["_p", "item_id", "pfsku_id", "month_dt"], "left")
    hit = F.col("_hit").isNotNull()
    whole = {
        "sku_no": F.lit(1), "sku_title": sku_title("item_title", "pfsku_title"), "is_bundle": F.lit(0), "is_gift": F.lit(0),
        "sku_src": F.lit(M.WEIGHT_DERIVED), **M.unit_weight("weight_all_in_g", "package_all", threshold),
    }
    split = {c: F.col(f"_a_{c}") for c in ("sku_no", "sku_title", "is_bundle", "is_gift", "package", "weight")}
    split |= {"total_weight": F.col("_a_package") * F.col("_a_weight"), "total_weight_src": F.lit(annotation_label),
              "sku_src": F.lit(annotation_label)}
    listed = joined.withColumns({c: F.when(hit, split[c]).otherwise(whole[c]) for c in whole}).drop(
        *[c for c in parts.columns if c.startswith("_a_")], "_hit", "weight_all_in_g", "package_all")

    both = count_over(listed, LISTING, "sku_num", "sku_no")
    keyed = both.withColumn("unique_id", K.part_key(part="sku_no")).drop("_p", "_m")
    if brands is None:
        return keyed.withColumn("ai_brand_name", F.col("brand_name"))
    found = annotation_join(keyed, brands, {"std_brand_name": "ai_brand_name"})
    return found.withColumn("ai_brand_name", F.coalesce("ai_brand_name", "brand_name"))


def mapping_origin_weighted(
    attributes: DataFrame, annotated: DataFrame, weights: DataFrame, threshold: float,
    annotation_label: str = "pfsku_package_splited",
) -> DataFrame:
    """The variant for listings that bring their own weights and part numbers.

    Annotated parts are named by product, weight, unit and packages; listing weights fill what the annotation or
    the measurement lacks. All rows belong to the market ``cn``.
    """
    keys = ["_p", "item_id", "pfsku_id", "month_dt"]
    listing = ["month_dt", "platform", "item_id", "pfsku_id", "shop_id"]
    base = attributes.withColumns({"_p": F.lower("platform"), "market": F.lit(CN)})
    parts = annotated.withColumn("_p", F.lower("platform")).select(*keys, *[F.col(c).alias(f"_a_{c}") for c in (
        "sku_no", "std_spu_name", "std_brand_name", "weight", "weight_unit", "package_num", "is_bundle", "is_gift")])
    split = base.join(parts, keys, "inner").withColumn("sku_no", F.col("_a_sku_no"))
    split = count_over(split, listing, "sku_num", "sku_no")
    merged = M.annotated_weight("_a_weight", "_a_package_num", "weight", "package", annotation_label)
    split = split.withColumns({
        **merged, "is_bundle": F.col("_a_is_bundle"), "is_gift": F.col("_a_is_gift"),
        "std_spu_name": F.col("_a_std_spu_name"), "sku_src": F.lit(annotation_label),
        "std_brand_name": F.coalesce("_a_std_brand_name", "brand_name"),
        "std_brand_name_src": F.when(F.col("_a_std_brand_name").isNull(), M.WEIGHT_DERIVED).otherwise(annotation_label),
        "_unit": F.col("_a_weight_unit"),
    }).withColumn("sku_title", part_title("std_spu_name", "weight", "_unit", "package", "sku_num"))
    split = split.drop("_unit", *[c for c in parts.columns if c.startswith("_a_")])

    measured = weights.select(F.lower("platform").alias("_p"), "item_id", "pfsku_id", "month_dt",
                              "weight_all_in_g", "package_all")
    whole = count_over(drop_in(base, parts, keys), listing, "sku_num", "sku_no")
    whole = whole.join(measured, keys, "left").withColumns(M.unit_weight_or_upstream(
        "weight_all_in_g", "package_all", "total_weight", "package", "total_weight_src", threshold,
    )).withColumn("is_gift", F.lit(0)).drop("weight_all_in_g", "package_all")
    return split.unionByName(whole, allowMissingColumns=True).withColumn(
        "unique_id", K.part_key(part="sku_no", sep="|")).drop("_p")


# Source label of a brand that the brand map supplied.
BRAND_MAP_SRC = "std_brand_mapping"


def standard_mapping(
    source: DataFrame, media_rules: RuleSet, brand_rules: RuleSet, category_rules: RuleSet,
    translation_rules: RuleSet, brand_map: DataFrame | None = None, japan: str = "JP",
) -> DataFrame:
    """Standard fields by rules at two grains.

    The media rule looks at one row per item and month (the one with the smallest key) and its result goes to all
    rows of the item. Brand, category and translation rules look at each row; brands of the Japanese market are
    NFKC-normalised first. ``brand_map(brand_name, std_brand_name)`` wins over every rule. The text ``NULL`` is a value
    here, other than in annotation results.
    """
    item_keys = ["platform", "market", "item_id", "_shop", "month_dt"]
    rows = source.withColumn("_shop", K.effective_shop("platform", "shop_id"))
    inputs = sorted({c for r in media_rules.rules for c in r.when} - set(item_keys))
    wanted = [*item_keys, *inputs, "unique_id", "media", "media_src"]
    first = keep_first(rows.select(*dict.fromkeys(wanted)), item_keys, [-F.col("unique_id").cast("decimal(20,0)")])
    items = apply_rules(first, media_rules, {"media": "media"}, "media_src").select(
        *item_keys, F.col("media").alias("_media"), F.col("media_src").alias("_media_src"))

    named = nfkc_in_market(rows, ["brand_name", "ai_brand_name"], "market", japan)
    ruled = apply_rules(named, brand_rules, {"std_brand_name": "std_brand_name"}, "std_brand_name_src", EMPTY)
    ruled = apply_rules(ruled, category_rules, {c: c for c in category_rules.result_columns}, blank=EMPTY)
    ruled = apply_rules(ruled, translation_rules, {c: c for c in translation_rules.result_columns}, blank=EMPTY)
    if brand_map is not None:
        mapped = brand_map.select("brand_name", F.col("std_brand_name").alias("_mapped_brand")).distinct()
        ruled = override(ruled, mapped, ["brand_name"], "std_brand_name", "_mapped_brand",
                         BRAND_MAP_SRC, "std_brand_name_src")
    texts = [c for c in ruled.columns if c in (
        *_C, *[f"{c}_cn" for c in _C], "sub_category", "sub_category_cn")]
    joined = null_safe_join(ruled, items, item_keys, nullable=["market"])
    return joined.withColumns({
        "media": F.coalesce("_media", "media"), "media_src": F.coalesce("_media_src", "media_src"),
        **{c: clean_text(c) for c in texts},
    }).drop("_media", "_media_src", "_shop")


# Rule results that keep the value of a row in the standard mapping. Fixed value.
EMPTY = ("",)


def first_part(mapping: DataFrame) -> DataFrame:
    return mapping.filter(F.col("sku_no") == 1)


def fixed_price(price: DataFrame, mapping: DataFrame, rules: RuleSet, result: str = "price") -> DataFrame:
    """Monthly prices with the shop of the mapping; a rule price replaces both prices."""
    inputs = listing_join(price, first_part(mapping), {"shop_id": "shop_id"})
    return conform(override_numeric(inputs, rules, result, ["page_price", "discount_price"], "discount_price_src"),
                   S.MONTHLY_PRICE)


def fixed_count(
    count: DataFrame, mapping: DataFrame, value_rules: RuleSet, ratio_rules: RuleSet,
    mapping_cols: Sequence[str] = ("shop_id", "brand_name"), value: str = "units", ratio: str = "ratio",
) -> DataFrame:
    """Monthly units: set by rule, scaled by rule ratio, and summed again per item."""
    inputs = listing_join(count, first_part(mapping), {c: c for c in mapping_cols})
    fixed = override_then_scale(inputs, value_rules, value, ratio_rules, ratio, "pfsku_unit_sales",
                                "pfsku_unit_sales_src", "fix_count_ratio")
    keyed = fixed.withColumn("_shop", K.effective_shop("platform", "shop_id"))
    total = F.sum("pfsku_unit_sales").alias("item_unit_sales")
    return conform(attach(keyed, ["month_dt", "platform", "market", "item_id", "_shop"], [total]), S.MONTHLY_COUNT)


def product_status(
    listings: DataFrame, mapping: DataFrame, listed: DataFrame, rules: RuleSet, listed_label: str, result: str = "status",
    mapping_cols: Sequence[str] = ("shop_id",),
) -> DataFrame:
    """Excluded listings. ``listed(platform, item_id, month_dt, exclude)`` names excluded items; rules add more."""
    inputs = listing_join(listings, first_part(mapping), {c: c for c in mapping_cols})
    names = listed.filter(F.col("exclude") == 1).select(
        F.lower("platform").alias("_p"), "item_id", "month_dt", F.lit(1).alias("exclude_flag")).distinct()
    flagged = enrich(inputs.withColumn("_p", F.lower("platform")), names, ["_p", "item_id", "month_dt"])
    return conform(exclusions(flagged, rules, result, listed_label), S.PRODUCT_STATUS)


# URL part of assembled listings that is rewritten to the plain one. Fixed value.
ASSEMBLED = "/dp/MC_Assembly_1#"


def sales_wide(
    mapping: DataFrame, count: DataFrame, price: DataFrame, status: DataFrame, history: DataFrame | None = None,
    fixed_prices: DataFrame | None = None, shop_names: DataFrame | None = None,
    brand_groups: DataFrame | None = None, min_price: float = 0, max_price: float = 1e9,
    min_count: int = 0, max_count: int = 10**12,
) -> DataFrame:
    """Wide monthly sales.

    The price and count bounds drop rows without a price or count, so both joins are inner. ``history`` is the
    mapping of all months for the listing month (the given mapping by default). Part prices of bundles come from
    the average single-part price of the same standard SKU, then from ``fixed_prices(platform, month_dt,
    std_sku_name, sku_price)``.
    """
    in_count = in_open_range(count, "item_unit_sales", min_count, max_count)
    in_price = in_open_range(price, "page_price", min_price, max_price)
    counts = {c: c for c in ("item_unit_sales", "pfsku_unit_sales", "is_multi_pfsku", "fix_count_ratio")
              if c in count.columns}
    rows = listing_join(mapping, in_count, counts, "inner", case_insensitive=False)
    rows = listing_join(rows, in_price, {"discount_price": "discount_price", "page_price": "page_price"}, "inner",
                        case_insensitive=False)
    rows = listing_join(rows, status.filter(F.col("status") == EXCLUDE), how="left_anti", case_insensitive=False)
    rows = rows.withColumns({
        **{c: rewrite_url(c, ASSEMBLED, "/dp/") for c in ("item_url", "pfsku_url") if c in rows.columns},
        **M.sales_measures(),
    }).withColumn("sku_value_ratio_fixed", F.col("sku_value_ratio"))

    sku = ["market", "platform", "month_dt", "std_sku_name"]
    usable = (F.col("sku_num") == 1) & F.col("std_sku_name").isNotNull() & (F.col("sku_discount_price_tmp") != 0)
    average = group_avg(rows, sku, "sku_discount_price_tmp", usable, "_group_price")
    rows = enrich_by(rows, average, sku)
    if fixed_prices is None:
        rows = rows.withColumn("_fixed_price", F.lit(None).cast("double"))
    else:
        rows = enrich_by(rows, fixed_prices.select("platform", "month_dt", "std_sku_name",
                                                   F.col("sku_price").alias("_fixed_price")),
                         ["platform", "month_dt", "std_sku_name"])
    if shop_names is not None:
        rows = enrich_by(rows, shop_names.select("platform", "market", "shop_id", "month_dt", "updated_shop_name"),
                         ["platform", "market", "shop_id", "month_dt"])
    rows = rows.withColumn("std_brand_name_ori", F.col("std_brand_name"))
    if brand_groups is not None:
        groups = brand_groups.select(F.col("std_brand_name_ori").alias("std_brand_name"),
                                     F.col("std_brand_name").alias("_group"))
        rows = override(rows, groups, ["std_brand_name"], "std_brand_name", "_group", "")
    rows = rows.withColumns({
        **M.single_part_defaults("sku_num", "sku_discount_price_tmp", "_group_price", "_fixed_price",
                                 "pfsku_value_sales", "sku_value_ratio", "sku_value_ratio_src"),
        "etl_updated_at": K.audit_ts(),
    }).drop("_group_price", "_fixed_price")
    return conform(listing_month(rows, history if history is not None else mapping), S.WIDE_SALES, {
        "pfsku_discount_price": F.col("discount_price"), "pfsku_page_price": F.col("page_price")})


def listing_month(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Add ``product_listing_time``: the first month in which the product was seen (NULL market is a market)."""
    product = K.product_key("platform", "item_id", "pfsku_id")
    keys = ["_p", "market", "_product"]

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"_p": F.lower("platform"), "_product": product})

    first = F.min("month_dt").alias("product_listing_time")
    seen = keyed(history.filter(F.col("month_dt").isNotNull()))
    return attach(keyed(rows), keys, [first], seen).drop("_p", "_product")
