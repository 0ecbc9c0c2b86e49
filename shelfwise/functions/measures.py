"""Weights, sales measures and single-part defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col

# Source labels of a weight and of the ratio of a single part. Fixed values.
WEIGHT_MEASURED, WEIGHT_DERIVED, SINGLE_PART = "GPT克重清洗", "机器清洗", "单品不拆"


def over_threshold(threshold: float) -> str:
    return f"超过阈值{threshold}g"


def unit_weight(total: Column | str, packages: Column | str, threshold: float) -> dict[str, Column]:
    """Package count, unit weight, total weight and source of a measured weight.

    Packages default to 1 and a missing total counts as 0. Unit weights at or above ``threshold`` are dropped.
    """
    total, count = col(total), F.coalesce(col(packages), F.lit(1))
    filled = F.coalesce(total, F.lit(0.0))
    each = F.try_divide(filled, count)
    below = F.coalesce(each < threshold, F.lit(False))
    return {
        "package": count,
        "weight": F.when(below, each),
        "total_weight": F.when(below, filled),
        "total_weight_src": F.when(
            below | total.isNull(), F.when(total.isNotNull(), WEIGHT_MEASURED).otherwise(WEIGHT_DERIVED)
        ).otherwise(over_threshold(threshold)),
    }


def unit_weight_or_upstream(
    total: Column | str, packages: Column | str,
    upstream_total: Column | str, upstream_packages: Column | str, upstream_src: Column | str,
    threshold: float,
) -> dict[str, Column]:
    """As :func:`unit_weight`, with upstream total, packages and source where nothing was measured.

    A missing total stays NULL here.
    """
    best = F.coalesce(col(total), col(upstream_total))
    count = F.coalesce(col(packages), col(upstream_packages), F.lit(1))
    each = F.try_divide(best, count)
    below = F.coalesce(each < threshold, F.lit(False))
    return {
        "package": count,
        "weight": F.when(below, each),
        "total_weight": F.when(below, best),
        "total_weight_src": F.when(
            below | col(upstream_src).isNull(),
            F.when(col(total).isNotNull(), F.lit(WEIGHT_MEASURED)).otherwise(col(upstream_src)),
        ).otherwise(over_threshold(threshold)),
    }


def annotated_weight(
    weight: Column | str, packages: Column | str, own_weight: Column | str, own_packages: Column | str, label: str
) -> dict[str, Column]:
    """Annotated weight and packages before the listing's own; total is their product."""
    w, n = F.coalesce(col(weight), col(own_weight)), F.coalesce(col(packages), col(own_packages))
    return {
        "package": n,
        "weight": w,
        "total_weight": w * n,
        "total_weight_src": F.when(col(weight).isNull(), WEIGHT_DERIVED).otherwise(label),
    }


def sales_measures(
    units: Column | str = "pfsku_unit_sales", discount: Column | str = "discount_price",
    page: Column | str = "page_price", total_weight: Column | str = "total_weight",
    packages: Column | str = "package", parts: Column | str = "sku_num",
) -> dict[str, Column]:
    """Value at both prices, volume, packs and the price of one package of a single-part listing (else 0)."""
    units, discount = col(units), col(discount)
    return {
        "pfsku_value_sales": units * discount,
        "pfsku_discountprice_value_sales": units * discount,
        "pfsku_pageprice_value_sales": units * col(page),
        "sku_unit_sales": units.cast("bigint"),
        "sku_volume_sales": units.cast("bigint") * col(total_weight),
        "sku_pack_sales": units.cast("bigint") * col(packages),
        "sku_discount_price_tmp": F.when(col(parts) == 1, F.try_divide(discount, col(packages))).otherwise(
            F.lit(0.0)),
    }


def single_part_defaults(
    parts: Column | str, own_price: Column | str, group_price: Column | str, fixed_price: Column | str,
    value: Column | str, ratio: Column | str, ratio_src: Column | str,
) -> dict[str, Column]:
    """Part measures: a listing of one part takes the listing's own, others the rule ratio and group price."""
    single = F.coalesce(col(parts) == 1, F.lit(False))
    return {
        "sku_discount_price_tmp": F.coalesce(
            F.when(single, col(own_price)).otherwise(col(group_price)), col(fixed_price)),
        "sku_value_sales": F.when(single, col(value)),
        "sku_value_ratio": F.when(single, F.lit(1.0)).otherwise(col(ratio)),
        "sku_value_ratio_src": F.when(single, F.lit(SINGLE_PART)).otherwise(col(ratio_src)),
    }
