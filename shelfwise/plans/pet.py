"""Pet-food mapping: chained and tiered rule sets, the brand gate, and a second name map."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import keys as K
from ..functions.text import gram_sku_name, is_blank
from ..operators.joins import enrich
from ..operators.rules import RuleSet, apply_rules, brand_gate, match, tiered, value_map

# External category names, and the species of a category. Fixed values.
EXTERNAL_CATEGORIES = {
    "Dog Dry": "狗干粮", "Dog Wet": "狗湿粮", "Dog C&T": "狗零食",
    "Cat Dry": "猫干粮", "Cat Wet": "猫湿粮", "Cat C&T": "猫零食",
}
SPECIES = {
    "猫干粮": "猫食品", "猫湿粮": "猫食品", "猫零食": "猫食品",
    "狗干粮": "狗食品", "狗湿粮": "狗食品", "狗零食": "狗食品",
}
# External feeds by platform. Fixed values.
FEED_A, FEED_B = ("Tmall", "Taobao"), ("JD",)


def external_value(on_a: str, on_b: str) -> Column:
    """The value of the feed that covers the row's platform."""
    return F.when(F.col("platform").isin(*FEED_A), F.col(on_a)).when(F.col("platform").isin(*FEED_B), F.col(on_b))


def external_label(label_a: str, label_b: str) -> Column:
    return F.when(F.col("platform").isin(*FEED_A), F.lit(label_a)).when(
        F.col("platform").isin(*FEED_B), F.lit(label_b))


def shared_then_own(
    df: DataFrame, shared: RuleSet, own: Mapping[str, RuleSet], targets: Mapping[str, str],
) -> DataFrame:
    """Attributes that one shared rule set fills first and an own rule set each fills otherwise.

    ``targets`` maps result columns to attributes; sources go to ``<attribute>_src``. The shared set is evaluated
    once for all attributes.
    """
    rows = match(df, shared, "_shared")
    for result, target in targets.items():
        note = f"{target}_src"
        tiers = [(F.col(f"_shared.{result}"), F.col(f"_shared.{result}_src"))] \
            if result in shared.result_columns else []
        if target in own:
            rows = match(rows, own[target], "_own")
            tiers.append((F.col(f"_own.{result}"), F.col(f"_own.{result}_src")))
        absent = [c for c in (target, note) if c not in rows.columns]
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else rows
        if tiers:
            rows = tiered(rows, target, tiers, note)
        rows = rows.drop("_own")
    return rows.drop("_shared")


def standard_names(
    df: DataFrame, brand_rules: RuleSet, fallback_brand: RuleSet, late_brand: RuleSet,
    fallback_category: RuleSet, late_category: RuleSet, label_a: str, label_b: str,
) -> DataFrame:
    """Brand and category by tiers.

    The primary rule wins. Otherwise the external feed of the platform, else the fallback rule, and in both cases
    the late rule may still overwrite. The late and fallback rules see what was written before them. The species
    follows from the category.
    """
    rows = match(df, brand_rules, "_primary")

    def fill(
        rows: DataFrame, col: str, external: Column, written: Column, fallback: RuleSet, late: RuleSet,
        late_result: str,
    ) -> DataFrame:
        note = f"{col}_src"
        none = F.lit(None).cast("string")
        has_primary = col in brand_rules.result_columns
        primary, primary_src = (F.col(f"_primary.{col}"), F.col(f"_primary.{col}_src")) if has_primary else (none, none)
        is_external = ~is_blank(external)
        rows = match(rows, fallback, "_fallback").withColumns({
            "_done": primary.isNotNull(),
            col: F.when(primary.isNotNull(), primary).when(is_external, written)
                 .otherwise(F.coalesce(F.col(f"_fallback.{col}"), F.col(col))),
            note: F.when(primary.isNotNull(), primary_src).when(is_external, external_label(label_a, label_b))
                  .otherwise(F.coalesce(F.col(f"_fallback.{col}_src"), F.col(note))),
        }).drop("_fallback")
        late_value, late_src = F.col(f"_late.{late_result}"), F.col(f"_late.{late_result}_src")
        return match(rows, late, "_late").withColumns({
            col: F.coalesce(F.when(~F.col("_done"), late_value), F.col(col)),
            note: F.coalesce(F.when(~F.col("_done"), late_src), F.col(note)),
        }).drop("_late", "_done")

    brand = external_value("pn_brandname_new", "rc_brandname")
    rows = fill(rows, "std_brand_name", brand, brand, fallback_brand, late_brand, "fix_brand")
    category = external_value("pn_sub_categoryname", "rc_categoryname_revised")
    # An external category that has no translation still counts, as NULL.
    rows = fill(rows, "std_category_2", category, value_map(category, EXTERNAL_CATEGORIES),
                fallback_category, late_category, "fix_std_category_2")
    species = F.coalesce(value_map("std_category_2", SPECIES), F.col("std_category_1"))
    return rows.drop("_primary").withColumn("std_category_1", species)


def package_and_weight(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Rule package and weight; the total is their product where both are known after a rule wrote one of them."""
    rows = match(df, rules)
    n, w = F.col("_rule.fix_package").try_cast("int"), F.col("_rule.fix_weight").try_cast("double")
    new_n, new_w = F.coalesce(n, F.col("package")), F.coalesce(w, F.col("weight"))
    total = new_n.cast("double") * new_w
    touched = (n.isNotNull() | w.isNotNull()) & total.isNotNull()
    return rows.withColumns({
        "package_src": F.when(n.isNotNull(), F.col("_rule.src")).otherwise(F.col("package_src")),
        "weight_src": F.when(w.isNotNull(), F.col("_rule.src")).otherwise(F.col("weight_src")),
        "total_weight_src": F.when(touched, F.col("_rule.src")).otherwise(F.col("total_weight_src")),
        "total_weight": F.when(touched, total).otherwise(F.col("total_weight")),
        "package": new_n, "weight": new_w,
    }).drop("_rule")


def gated_names(
    df: DataFrame, gate: DataFrame, naming_set: int, trusted: Sequence[str], machine: str,
    name_map: DataFrame | None = None, map_label: str = "spu_mapping",
) -> DataFrame:
    """Brand gate, then the second name map (``std_spu_name -> std_spu_name_map``), then the SKU name in grams."""
    rows = brand_gate(df, gate, naming_set, trusted, machine)
    if name_map is not None:
        renamed = name_map.select("std_spu_name", F.col("std_spu_name_map").alias("_mapped"))
        rows = enrich(rows, renamed, ["std_spu_name"]).withColumns({
            "std_spu_name": F.coalesce("_mapped", "std_spu_name"),
            "std_spu_name_src": F.when(F.col("_mapped").isNotNull(), F.lit(map_label)).otherwise(
                F.col("std_spu_name_src")),
        }).drop("_mapped")
    return rows.withColumns({
        "std_sku_name": gram_sku_name("std_spu_name", "weight"), "etl_updated_at": K.audit_ts()})


def pet_mapping(
    df: DataFrame, shop_rules: RuleSet, name_rules: RuleSet, brand_rules: RuleSet, fallback_brand: RuleSet,
    late_brand: RuleSet, fallback_category: RuleSet, late_category: RuleSet, attribute_rules: RuleSet,
    own_attribute_rules: Mapping[str, RuleSet], attribute_targets: Mapping[str, str], weight_rules: RuleSet,
    channel_rules: RuleSet, gate: DataFrame, label_a: str, label_b: str, naming_set: int, trusted: Sequence[str],
    machine: str, name_map: DataFrame | None = None,
) -> DataFrame:
    """The whole chain: shop, name, brand and category tiers, attributes, weights, channel, gate and name map.

    ``label_a`` and ``label_b`` name the external feeds. Rules of ``naming_set`` are trusted on the ``trusted``
    platforms; ``machine`` is the label of machine-cleaned rows.
    """
    rows = apply_rules(df, shop_rules, {"fix_shop_id": "shop_id", "fix_shop_name": "shop_name"})
    rows = apply_rules(rows, name_rules, {"fix_spu_name": "std_spu_name"}, "std_spu_name_src")
    rows = standard_names(rows, brand_rules, fallback_brand, late_brand, fallback_category, late_category,
                          label_a, label_b)
    rows = shared_then_own(rows, attribute_rules, own_attribute_rules, attribute_targets)
    rows = package_and_weight(rows, weight_rules)
    rows = apply_rules(rows, channel_rules, {c: c for c in channel_rules.result_columns}, {"channel": "ka_name_src"})
    return gated_names(rows, gate, naming_set, trusted, machine, name_map)
