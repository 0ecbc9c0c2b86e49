"""Home-care mapping: one grain, rule sets chained in a fixed order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from ..functions.text import display_title, standard_sku_name
from ..operators.rules import RuleSet, apply_chain, match, tiered


def package_weight_size(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Rule package, weight and size before the row's own.

    When a rule wrote package or weight, the total weight is their product (NULL if one is unknown). Its source is
    noted unless the values are the set's defaults.
    """
    rows = match(df, rules)

    def value(name: str, kind: str):
        return F.col(f"_rule.{name}").try_cast(kind) if name in rules.result_columns else F.lit(None).cast(kind)

    n, w, size = value("package", "int"), value("weight", "double"), value("size", "double")
    written = n.isNotNull() | w.isNotNull()
    new_n, new_w = F.coalesce(n, F.col("package")), F.coalesce(w, F.col("weight"))
    by_rule = written & ~F.contains(F.col("_rule.src"), F.lit("__DEFAULT__"))
    return rows.withColumns({
        "package_weight_src": F.when(written, F.col("_rule.src")).otherwise(F.col("package_weight_src")),
        "total_weight_src": F.when(by_rule, F.col("_rule.src")).otherwise(F.col("total_weight_src")),
        "total_weight": F.when(written, new_w * new_n).otherwise(F.col("total_weight")),
        "size_src": F.when(size.isNotNull(), F.col("_rule.src")).otherwise(F.col("size_src")),
        "size": F.coalesce(size, F.col("size")), "package": new_n, "weight": new_w,
    }).drop("_rule")


def names(df: DataFrame) -> DataFrame:
    """Standard SKU name, and the display title that follows from it."""
    named = df.withColumn("std_sku_name", standard_sku_name(
        "std_spu_name", "weight", "weight_unit" if "weight_unit" in df.columns else None))
    return named.withColumn("sku_title", display_title("std_sku_name", "platform", "pfsku_title", "item_title"))


def brand_tiers(df: DataFrame, first: RuleSet, first_result: str, second: RuleSet, second_result: str) -> DataFrame:
    """The first set's brand, else the second's, else the row's own."""
    rows = match(match(df, first, "_first"), second, "_second")
    tiers = [(F.col(f"_{name}.{result}"), F.col(f"_{name}.{result}_src"))
             for name, result in (("first", first_result), ("second", second_result))]
    return tiered(rows, "std_brand_name", tiers, "std_brand_name_src").drop("_first", "_second")


def chained_mapping(
    df: DataFrame, weight_rules: RuleSet, segment_steps: Sequence[Mapping[str, Any]], first_brand: RuleSet,
    second_brand: RuleSet, later_steps: Sequence[Mapping[str, Any]] = (),
    brand_results: tuple[str, str] = ("fix_std_brand_name", "std_brand_name"),
) -> DataFrame:
    """Weights, names, segments and categories, brand tiers, everything that depends on them, total size.

    Steps are ``apply_rules`` arguments; each sees what the ones before it wrote.
    """
    rows = names(package_weight_size(df, weight_rules))
    rows = apply_chain(rows, segment_steps)
    rows = brand_tiers(rows, first_brand, brand_results[0], second_brand, brand_results[1])
    rows = apply_chain(rows, later_steps)
    known = (F.col("size") != 0) & (F.col("package") != 0)
    return rows.withColumn("total_size", F.when(known, F.col("size") * F.col("package")))
