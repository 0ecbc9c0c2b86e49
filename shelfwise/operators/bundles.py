"""Bundle listings: which ones to merge, and the merged name and counts per brand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions.text import is_blank
from .prices import set_concat

# Category names and name parts of the two merged product types. Fixed values.
LIQUID_CATEGORY, BRUSH_CATEGORY = "电热蚊香液", "一次性马桶刷"
LIQUID, DEVICE, HANDLE = "液", "器", "杆|柄"
# Categories whose listings are never merged, and texts that disqualify the category list. Fixed values.
NEVER_MERGED = "厨房油污清洁剂|杀虫气雾剂|驱蚊"
MIXED_OR_EXCLUDED = ",|洁厕|others"


def qualify_bundles(
    parts: DataFrame, keys: Sequence[str], category: str = "std_category_3", group: str | None = "std_category_2",
    never: str = NEVER_MERGED, disqualifying: str = MIXED_OR_EXCLUDED,
) -> DataFrame:
    """Keys of listings with more than one part, one single category and no excluded category.

    One aggregate decides everything: distinct part numbers, the category list, and whether any part falls under
    an excluded group.
    """
    excluded = F.coalesce(F.lower(F.col(group)).rlike(never), F.lit(False)) if group else F.lit(False)
    per_part = parts.groupBy(*keys, "sku_no", category).agg(F.max(excluded).alias("_excluded"))
    listing = per_part.groupBy(*keys).agg(
        F.count_distinct("sku_no").alias("sku_num"),
        set_concat(category).alias("categorys"),
        F.max("_excluded").alias("_excluded"),
    )
    return listing.filter(
        (F.col("sku_num") > 1) & ~F.col("_excluded") & ~F.lower("categorys").rlike(disqualifying)
    ).drop("_excluded")


def _name(pattern: str) -> Column:
    return F.lower("std_spu_name").rlike(pattern)


def weight_packages(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Packages per weight as one sorted list of (weight, packages) per group.

    Parts are summed per weight first, so a list has one record per distinct weight, not per part.
    """
    summed = parts.groupBy(*group, "weight").agg(F.sum(F.coalesce("package_num", F.lit(0))).alias("packages"))
    return summed.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("weight", "packages"))).alias("records"))


def merge_typed(
    parts: DataFrame, keys: Sequence[str], type_col: str = "categorys", observation: Observation | None = None,
) -> DataFrame:
    """Merge liquid and brush bundles to one row per listing and brand, in one pass.

    ``type_col`` holds the category of the whole listing and is not returned. A NULL brand is a brand of its own.

    Liquid + device: the best liquid's name up to its first ``<n>ml``, then ``<weight>ml*<packages>`` per weight in
    order joined by ``+``, then the number of devices (1 if unknown); NULL without a liquid. Parts that are neither
    liquid nor device do not take part. Brush + handle: ``<name>*<brushes>+<handles or 1>``; NULL without a brush.

    Parts are folded per (listing, brand, weight) first and then per (listing, brand), both before any ordering.
    ``observation`` receives ``parts`` and ``parts_dropped``, the liquid listings' parts that take no part, from the same
    pass; a map task that is run again for a lost executor counts again.
    """
    columns = [c for c in parts.columns if c != type_col]
    group = [*keys, "std_brand_name"]
    others = [c for c in columns if c not in group]
    is_liquid = F.col(type_col) == LIQUID_CATEGORY
    device, handle = F.coalesce(_name(DEVICE), F.lit(False)), F.coalesce(_name(HANDLE), F.lit(False))
    main = F.when(is_liquid, F.coalesce(_name(LIQUID), F.lit(False)) & ~device).otherwise(~handle)
    addition = F.when(is_liquid, device).otherwise(handle)
    taken = ~is_liquid | _name(f"{LIQUID}|{DEVICE}")
    if observation is not None:
        parts = parts.observe(observation, F.count(F.lit(1)).alias("parts"),
                              F.count_if(~F.coalesce(taken, F.lit(False))).alias("parts_dropped"))
    used = parts.filter(taken).withColumns({"_main": main, "_addition": addition})

    # Smallest first: main products, for liquids those of known weight, then the lowest part number.
    unknown = F.when(is_liquid, F.col("weight").isNull()).otherwise(F.lit(False))
    row = F.struct(type_col, "_main", *others)
    rank = F.struct((~F.col("_main")).alias("addition"), unknown.alias("unknown"), F.col("sku_no"), row.alias("row"))
    count = F.coalesce("package_num", F.lit(0))
    by_weight = used.groupBy(*group, F.col("weight").alias("_weight")).agg(
        F.min(rank).alias("_best"), F.min("sku_no").alias("_first_no"),
        F.sum(F.when(F.col("_main"), count)).alias("_mains"),
        F.sum(F.when(F.col("_addition"), count)).alias("_additions"),
    )
    weighed = F.when(F.col("_weight").isNotNull() & F.col("_mains").isNotNull(), F.struct("_weight", "_mains"))
    merged = by_weight.groupBy(*group).agg(
        F.min("_best").alias("_best"), F.min("_first_no").alias("_first_no"),
        F.coalesce(F.sum("_mains"), F.lit(0)).alias("_main_count"),
        F.coalesce(F.sum("_additions"), F.lit(0)).alias("_addition_count"),
        F.sort_array(F.collect_list(weighed)).alias("_weights"),
    )
    best = F.col("_best.row")
    flat = merged.select(*group, *[best[c].alias(c) for c in (type_col, "_main", *others)], "_first_no",
                         "_main_count", "_addition_count", "_weights")

    added = F.greatest(F.col("_addition_count"), F.lit(1)).cast("string")
    mains = F.col("_main_count").cast("string")
    listed = F.array_join(F.transform("_weights", lambda w: F.concat(
        F.bround(w["_weight"]).cast("bigint").cast("string"), F.lit("ml*"), w["_mains"].cast("string"))), "+")
    base = F.trim(F.regexp_replace("std_spu_name", r"\d+ml.*", ""))
    listing = F.when(F.size("_weights") > 0, F.concat(listed, F.lit("+"))).otherwise(F.lit(""))
    brush = F.trim("std_spu_name")
    name = (
        F.when(~F.col("_main"), F.lit(None).cast("string"))
        .when((F.col(type_col) == LIQUID_CATEGORY) & ~is_blank(base), F.concat(base, listing, added, F.lit(DEVICE)))
        .when((F.col(type_col) != LIQUID_CATEGORY) & ~is_blank(brush),
              F.concat(brush, F.lit("*"), mains, F.lit("+"), added))
    )
    out = flat.withColumns({
        "std_spu_name": name, "package_num": F.col("_main_count").cast(parts.schema["package_num"].dataType)})
    copies = {"quantity": "package_num", "unit_weight": "weight"}
    out = out.withColumns({c: F.col(source) for c, source in copies.items() if c in columns})
    # One row per listing and brand is left, so a window holds the brands of one listing.
    numbers = Window.partitionBy(*keys).orderBy(F.col("_first_no"), F.col("std_brand_name"))
    return out.withColumn("sku_no", F.row_number().over(numbers)).select(*columns)


def merge_liquid(parts: DataFrame, keys: Sequence[str], observation: Observation | None = None) -> DataFrame:
    """:func:`merge_typed` for parts of liquid + device listings only."""
    return merge_typed(parts.withColumn("_type", F.lit(LIQUID_CATEGORY)), keys, "_type", observation)


def merge_brush(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`merge_typed` for parts of brush + handle listings only."""
    return merge_typed(parts.withColumn("_type", F.lit(BRUSH_CATEGORY)), keys, "_type")
