"""Bundle listings."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F

from shelfwise.operators import bundles as B
from shelfwise.operators.rules import Rule, RuleSet
from shelfwise.plans.bundles import merge_bundles
from shelfwise.sources.checkpoints import stored

from .base import Registry

R = Registry()
QUERIES, ORACLE = R.queries, R.sql
KEYS = ["platform", "item_id", "pfsku_id", "month_dt"]

_CHOSEN = """
listings AS (SELECT item_id, pfsku_id, count(DISTINCT sku_no) AS sku_num,
    string_agg(DISTINCT std_category_3, ',' ORDER BY std_category_3) AS categorys,
    bool_or(regexp_matches(std_category_2, '厨房油污清洁剂|杀虫气雾剂|驱蚊')) AS excluded
  FROM bundle_part GROUP BY item_id, pfsku_id),
chosen AS (SELECT item_id, pfsku_id, CAST(sku_num AS BIGINT) AS sku_num, categorys FROM listings
  WHERE sku_num > 1 AND NOT excluded AND NOT regexp_matches(lower(categorys), ',|洁厕|others')),
parts AS (SELECT b.*, categorys FROM bundle_part b JOIN chosen USING (item_id, pfsku_id))
"""
_LIQUID = """
liquid AS (SELECT *, std_spu_name LIKE '%液%' AND std_spu_name NOT LIKE '%器%' AS pure,
    std_spu_name LIKE '%器%' AS device FROM parts WHERE categorys = '电热蚊香液'
    AND regexp_matches(std_spu_name, '液|器')),
by_weight AS (SELECT item_id, pfsku_id, std_brand_name, weight, sum(package_num) AS n FROM liquid
  WHERE pure AND weight IS NOT NULL GROUP BY ALL),
weights AS (SELECT item_id, pfsku_id, std_brand_name,
    string_agg(CAST(CAST(round_even(weight, 0) AS BIGINT) AS VARCHAR) || 'ml*' || CAST(n AS VARCHAR), '+' ORDER BY weight) AS listed
  FROM by_weight GROUP BY item_id, pfsku_id, std_brand_name),
first_liquid AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, pfsku_id, std_brand_name ORDER BY
    pure DESC, weight IS NOT NULL DESC, sku_no) AS rn FROM liquid) WHERE rn = 1),
sums AS (SELECT item_id, pfsku_id, std_brand_name, min(sku_no) AS first_no,
    sum(CASE WHEN pure THEN package_num ELSE 0 END) AS liquids, sum(CASE WHEN device THEN package_num ELSE 0 END) AS devices
  FROM liquid GROUP BY item_id, pfsku_id, std_brand_name),
liquid_merged AS (SELECT f.platform, f.item_id, f.pfsku_id, f.month_dt, f.std_category_2, f.std_category_3, f.std_brand_name, f.weight,
    CAST(liquids AS BIGINT) AS package_num,
    CAST(row_number() OVER (PARTITION BY f.item_id, f.pfsku_id ORDER BY first_no, f.std_brand_name NULLS FIRST) AS INT) AS sku_no,
    CASE WHEN pure AND trim(regexp_replace(std_spu_name, '[0-9]+ml.*', '')) <> '' THEN
      trim(regexp_replace(std_spu_name, '[0-9]+ml.*', '')) || coalesce(listed || '+', '') ||
      CAST(CASE WHEN devices = 0 THEN 1 ELSE devices END AS VARCHAR) || '器' END AS std_spu_name
  FROM first_liquid f JOIN sums s ON f.item_id = s.item_id AND f.pfsku_id = s.pfsku_id
      AND f.std_brand_name IS NOT DISTINCT FROM s.std_brand_name
    LEFT JOIN weights w ON f.item_id = w.item_id AND f.pfsku_id = w.pfsku_id
      AND f.std_brand_name IS NOT DISTINCT FROM w.std_brand_name)
"""
_BRUSH = """
brush AS (SELECT *, regexp_matches(std_spu_name, '杆|柄') AS handle FROM parts WHERE categorys = '一次性马桶刷'),
first_brush AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, pfsku_id, std_brand_name
    ORDER BY handle, sku_no) AS rn FROM brush) WHERE rn = 1),
brush_sums AS (SELECT item_id, pfsku_id, std_brand_name, min(sku_no) AS first_no,
    sum(CASE WHEN handle THEN 0 ELSE package_num END) AS brushes, sum(CASE WHEN handle THEN package_num ELSE 0 END) AS handles
  FROM brush GROUP BY item_id, pfsku_id, std_brand_name),
brush_merged AS (SELECT f.platform, f.item_id, f.pfsku_id, f.month_dt, f.std_category_2, f.std_category_3, f.std_brand_name, f.weight,
    CAST(brushes AS BIGINT) AS package_num,
    CAST(row_number() OVER (PARTITION BY f.item_id, f.pfsku_id ORDER BY first_no, f.std_brand_name NULLS FIRST) AS INT) AS sku_no,
    CASE WHEN NOT handle THEN std_spu_name || '*' || CAST(brushes AS VARCHAR) || '+' ||
      CAST(CASE WHEN handles = 0 THEN 1 ELSE handles END AS VARCHAR) END AS std_spu_name
  FROM first_brush f JOIN brush_sums s ON f.item_id = s.item_id AND f.pfsku_id = s.pfsku_id
      AND f.std_brand_name IS NOT DISTINCT FROM s.std_brand_name)
"""
_COLUMNS = ("platform, item_id, pfsku_id, month_dt, std_category_2, std_category_3, std_brand_name, weight, package_num, "
            "sku_no, std_spu_name")


def _parts(v):
    parts = v.stored("bundle_part").withColumn("package_num", F.col("package_num").cast("bigint"))
    chosen = B.qualify_bundles(parts, KEYS).select(*KEYS, "categorys")
    return parts.join(chosen, KEYS)


@R.add("bundle_qualify", f"WITH {_CHOSEN.strip()} SELECT * FROM chosen", ("bundle_part",))
def _(v):
    return B.qualify_bundles(v.stored("bundle_part"), KEYS).select("item_id", "pfsku_id", "sku_num", "categorys")


@R.add("bundle_liquid", f"WITH {_CHOSEN.strip()}, {_LIQUID.strip()} SELECT {_COLUMNS} FROM liquid_merged",
       ("bundle_part",))
def _(v):
    return B.merge_liquid(_parts(v).filter(F.col("categorys") == B.LIQUID_CATEGORY).drop("categorys"), KEYS)


@R.add("bundle_dropped_parts", f"""
WITH {_CHOSEN.strip()}, {_LIQUID.strip()}
SELECT (SELECT count(*) FROM liquid_merged) AS merged, count(*) AS parts,
  count(*) FILTER (NOT coalesce(regexp_matches(std_spu_name, '液|器'), FALSE)) AS parts_dropped
FROM parts WHERE categorys = '电热蚊香液'
""", ("bundle_part",))
def _(v):
    """Parts of liquid listings that are neither liquid nor device are counted by the job that merges them."""
    seen = Observation()
    liquid = _parts(v).filter(F.col("categorys") == B.LIQUID_CATEGORY).drop("categorys")
    merged = stored(B.merge_liquid(liquid, KEYS, seen), "merged")
    counts = seen.get
    return merged.agg(F.count(F.lit(1)).alias("merged")).withColumns({k: F.lit(n).cast("bigint") for k, n in counts.items()})


@R.add("bundle_brush", f"WITH {_CHOSEN.strip()}, {_BRUSH.strip()} SELECT {_COLUMNS} FROM brush_merged",
       ("bundle_part",))
def _(v):
    return B.merge_brush(_parts(v).filter(F.col("categorys") == B.BRUSH_CATEGORY).drop("categorys"), KEYS)


@R.add("bundle_weight_records", """
WITH w AS (SELECT item_id, pfsku_id, weight, sum(package_num) AS n FROM bundle_part GROUP BY ALL)
SELECT item_id, pfsku_id, string_agg(coalesce(CAST(weight AS VARCHAR), '?') || 'x' || CAST(n AS VARCHAR), ';'
  ORDER BY weight NULLS FIRST) AS records FROM w GROUP BY item_id, pfsku_id
""", ("bundle_part",))
def _(v):
    listed = B.weight_packages(v.stored("bundle_part"), ["item_id", "pfsku_id"])
    text = F.transform("records", lambda r: F.concat(
        F.coalesce(r["weight"].cast("string"), F.lit("?")), F.lit("x"), r["packages"].cast("string")))
    return listed.select("item_id", "pfsku_id", F.array_join(text, ";").alias("records"))


_MERGED_RULES = RuleSet(77, [Rule(1, {"std_spu_name": ("contains", "马桶刷")}, {"std_brand_name": "BRUSH"})])


@R.add("bundle_merge", f"""
WITH {_CHOSEN.strip()}, {_LIQUID.strip()}, {_BRUSH.strip()},
others AS (SELECT * FROM parts WHERE categorys NOT IN ('电热蚊香液', '一次性马桶刷') AND sku_no = 1),
untouched AS (SELECT * FROM bundle_part b WHERE NOT EXISTS (SELECT 1 FROM chosen c WHERE c.item_id = b.item_id AND c.pfsku_id = b.pfsku_id)),
merged AS (SELECT {_COLUMNS} FROM liquid_merged UNION ALL SELECT {_COLUMNS} FROM brush_merged
  UNION ALL SELECT {_COLUMNS} FROM others UNION ALL SELECT {_COLUMNS} FROM untouched)
SELECT * REPLACE (CASE WHEN contains(std_spu_name, '马桶刷') THEN 'BRUSH' ELSE std_brand_name END AS std_brand_name) FROM merged
""", ("bundle_part",))
def _(v):
    parts = v.stored("bundle_part").withColumn("package_num", F.col("package_num").cast("bigint"))
    return merge_bundles(parts, KEYS, steps=[
        {"rules": _MERGED_RULES, "results": {"std_brand_name": "std_brand_name"}}])
