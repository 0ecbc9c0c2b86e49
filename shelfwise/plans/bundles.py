"""Annotated parts with bundles merged by product type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.bundles import BRUSH_CATEGORY, LIQUID_CATEGORY, merge_typed, qualify_bundles
from ..operators.joins import enrich
from ..operators.rules import apply_chain
from ..sources.sinks import guard_keys

KEYS = ("platform", "item_id", "pfsku_id", "month_dt")


def merge_bundles(
    parts: DataFrame, keys: Sequence[str] = KEYS, category: str = "std_category_3", group: str | None = "std_category_2",
    steps: Sequence[dict] = (),
) -> DataFrame:
    """Merge qualified liquid and brush bundles; keep part 1 of other qualified listings and all other parts.

    ``steps`` are rule sets (``apply_rules`` arguments) for the merged table. Rows without a key are dropped.
    """
    keys = list(keys)
    chosen = qualify_bundles(parts, keys, category, group).select(*keys, "categorys")
    tagged = enrich(parts, chosen, keys)
    merges = F.col("categorys").isin(LIQUID_CATEGORY, BRUSH_CATEGORY)
    changed = merge_typed(tagged.filter(merges), keys, "categorys")
    kept = tagged.filter(F.col("categorys").isNull() | (~merges & (F.col("sku_no") == 1)))
    merged = kept.select(*parts.columns).unionByName(changed.select(*parts.columns))
    return guard_keys(apply_chain(merged, steps), keys)
