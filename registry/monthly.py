"""Monthly listing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.operators.rules import Rule, RuleSet
from shelfwise.plans import external as X, monthly as P, pet as D
from shelfwise.sources.checkpoints import stored

from .base import EXACT_AVG, Registry
from .crawl import DUCK_TYPES, typed_nulls
from .joins import KEYS, LISTING, missing_unless
from .rules import GATE, P1, P2, PRICE, RATIO, STATUS, UNITS

R = Registry()
QUERIES, ORACLE = R.queries, R.sql

# --- attributes of all platforms --------------------------------------------------------------------------------
# Which feeds have a column, in SQL; '*' marks all feeds, and names the patch as 'patch'.
_HAS = {
    "item_title": "Tmall JD PDD Suning Taobao VIP Douyin Kaola Kuaishou patch", "pfsku_title": "Tmall Amazon JD patch",
    "category_1": "*", "category_2": "*", "category_3": "*", "category_4": "Amazon JD PDD Douyin Kaola patch",
    "category_5": "Amazon Kaola patch", "category_6": "Kaola patch",
    "category_1_id": "JD Suning VIP Douyin Kaola patch", "category_2_id": "JD Suning VIP Douyin Kaola patch",
    "category_3_id": "JD Suning VIP Douyin Kaola patch", "category_4_id": "JD Douyin Kaola patch",
    "category_5_id": "Kaola patch", "category_6_id": "Kaola patch",
    "category_id": "Tmall JD PDD Suning Taobao VIP Douyin Kaola patch", "category_name": "*",
    "categories": "Tmall JD PDD Suning Taobao VIP Douyin patch",
    "shop_id": "Tmall Amazon JD PDD Suning Taobao Douyin Kaola Kuaishou patch",
    "shop_name": "Tmall Amazon JD PDD Suning Taobao Douyin Kaola Kuaishou patch", "shop_type": "JD Kuaishou patch",
    "brand_id": "Tmall JD PDD Suning Taobao VIP Kaola patch", "brand_name": "*", "manufacturer": "Amazon",
    "properties": "Tmall patch", "shop_url": "Tmall JD PDD Suning Taobao Douyin patch",
    "item_url": "Tmall JD PDD Suning Taobao VIP Douyin Kaola patch", "pfsku_url": "Tmall Amazon patch",
    "item_image": "Tmall JD PDD Suning Taobao VIP Douyin patch",
    "item_images": "Tmall JD PDD Suning Taobao VIP Douyin patch", "pfsku_image": "Tmall Amazon patch",
    "recommend_remark": "Douyin patch", "tags": "Tmall JD PDD Suning Taobao VIP Douyin Kaola patch",
    "basic_info": "Tmall JD PDD Suning Taobao VIP Douyin Kaola patch", "pfsku_title_cn": "Amazon",
    "sub_category": "Amazon patch", "sub_category_cn": "Amazon patch",
    **{f"category_{i}_cn": "Amazon patch" for i in range(1, 6)}, "category_6_cn": "patch",
}
_SPECIAL = {
    **{f"category_{i}": f"CASE WHEN feed IN ('Suning', 'Douyin') THEN category_{i}_name ELSE category_{i} END"
       for i in (1, 2, 3)},
    "category_4": "CASE WHEN feed = 'Douyin' THEN category_4_name ELSE category_4 END",
    "category_id": "CASE feed WHEN 'Suning' THEN category_3_id WHEN 'Douyin' THEN category_4_id ELSE category_id END",
    "category_name": "CASE feed WHEN 'Suning' THEN category_3_name WHEN 'Douyin' THEN category_4_name ELSE category_name END",
    "shop_id": "CASE WHEN feed = 'Douyin' THEN store_id ELSE shop_id END",
    "shop_type": "CASE WHEN feed = 'JD' THEN store_type ELSE shop_type END",
}


def _attribute(f) -> str:
    kind, name = DUCK_TYPES[f.dataType.simpleString()], f.name
    if name in ("item_id", "month_dt"):
        return name
    if name == "pfsku_id":
        return "CASE WHEN feed IN ('Tmall', 'Amazon', 'patch') THEN pfsku_id ELSE item_id END AS pfsku_id"
    if name == "platform":
        return "CASE WHEN feed = 'patch' THEN 'Other' ELSE feed END AS platform"
    if name == "market":
        return "CASE WHEN feed IN ('Amazon', 'patch') THEN market ELSE 'cn' END AS market"
    value = _SPECIAL.get(name, name)
    if _HAS[name] != "*":
        feeds = ", ".join(f"'{x}'" for x in _HAS[name].split())
        value = f"CASE WHEN feed IN ({feeds}) THEN {value} END"
    return f"CAST({value} AS {kind}) AS {name}"


def _feeds(v):
    rows = v.stored("platform_rows")
    feeds = {p: rows.filter(F.col("feed") == p).drop("feed") for p in P.PLATFORM_COLUMNS}
    patch = rows.filter(F.col("feed") == "Tmall").withColumn("platform", F.lit("Other")).drop("feed")
    return feeds, patch


_ALL_FEEDS = "feeds AS (SELECT * FROM platform_rows UNION ALL SELECT * REPLACE ('patch' AS feed) FROM platform_rows " \
             "WHERE feed = 'Tmall')"


@R.add("adapt_platforms", f"""
WITH {_ALL_FEEDS} SELECT {', '.join(_attribute(f) for f in S.MONTHLY_ATTRIBUTES.fields)} FROM feeds
""", ("platform_rows",))
def _(v):
    feeds, patch = _feeds(v)
    return P.monthly_attributes(feeds, patch, "full")


@R.add("adapt_platforms_scoped", f"""
WITH {_ALL_FEEDS} SELECT {', '.join(_attribute(f) for f in S.MONTHLY_ATTRIBUTES.fields)} FROM feeds
WHERE month_dt >= '1994-01-01' AND market = 'us' AND feed IN ('Amazon', 'patch')
""", ("platform_rows",))
def _(v):
    feeds, patch = _feeds(v)
    return P.monthly_attributes(feeds, patch, "full", month="1995-01-01", market="us", start_month="1994-01-01")


@R.add("split_feed", """
WITH s AS (SELECT * REPLACE (CASE WHEN CAST(shop_id AS BIGINT) % 3 = 0 THEN NULL ELSE market END AS market) FROM platform_rows)
SELECT 'attributes' AS part, item_id, pfsku_id, market, month_dt, pfsku_title, brand_name, CAST(NULL AS BIGINT) AS pfsku_unit_sales,
  CAST(NULL AS DOUBLE) AS page_price, CAST(NULL AS DOUBLE) AS discount_price, CAST(NULL AS VARCHAR) AS discount_price_src FROM s WHERE market IS NOT NULL
UNION ALL SELECT 'count', item_id, pfsku_id, market, month_dt, NULL, NULL, pfsku_unit_sales, NULL, NULL, NULL FROM s WHERE market IS NOT NULL
UNION ALL SELECT 'price', item_id, pfsku_id, market, month_dt, NULL, NULL, NULL, page_price, discount_price, '月销表价格' FROM s
WHERE market IS NOT NULL
""", ("platform_rows",))
def _(v):
    sales = v.stored("platform_rows").withColumn("market", F.when(F.col("shop_id") % 3 != 0, F.col("market")))
    parts = P.split_feed(sales)
    keep = ["item_id", "pfsku_id", "market", "month_dt"]
    named = {
        "attributes": parts["attributes"].select(*keep, "pfsku_title", "brand_name"),
        "count": parts["count"].select(*keep, "pfsku_unit_sales"),
        "price": parts["price"].select(*keep, "page_price", "discount_price", "discount_price_src"),
    }
    out = None
    for name, df in named.items():
        df = df.withColumn("part", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


# --- mapping origin ---------------------------------------------------------------------------------------------
_ANNOTATED = """
notes AS (SELECT upper(platform) AS platform, market, CASE WHEN sku_num = 3 THEN item_id ELSE 'no ' || item_id END AS item_id, pfsku_id, month_dt, sku_no, min(std_sku_name) AS sku_title,
    1 AS is_bundle, CAST(sku_no % 2 AS INT) AS is_gift, max(package) AS package, max(weight) AS weight, min(std_brand_name) AS std_brand_name,
    CASE WHEN sku_no = 1 THEN NULL ELSE max(weight) END AS part_weight
  FROM mapping GROUP BY 1, 2, 3, 4, 5, 6),
weighed AS (SELECT platform, CASE WHEN category_1 >= 'M' THEN item_id ELSE 'no ' || item_id END AS item_id, pfsku_id, month_dt,
    CAST(sum(pfsku_unit_sales) AS DOUBLE) AS weight_all_in_g, CAST(max(page_price) AS INT) % 5 AS package_all FROM listing GROUP BY 1, 2, 3, 4)
"""


def _annotations(v):
    keys = ["platform", "market", "item_id", "pfsku_id", "month_dt", "sku_no"]
    notes = missing_unless(v.stored("mapping"), "sku_num = 3", "item_id").groupBy(*keys).agg(
        F.min("std_sku_name").alias("sku_title"), F.max("package").alias("package"), F.max("weight").alias("weight"),
        F.min("std_brand_name").alias("std_brand_name")).withColumns({
            "platform": F.upper("platform"), "is_bundle": F.lit(1), "is_gift": F.col("sku_no") % 2,
            "part_weight": F.when(F.col("sku_no") != 1, F.col("weight"))})
    weighed = missing_unless(v.stored("listing"), "category_1 >= 'M'", "item_id").groupBy("platform", "item_id", "pfsku_id", "month_dt").agg(
        F.sum("pfsku_unit_sales").cast("double").alias("weight_all_in_g"),
        (F.max("page_price").cast("int") % 5).alias("package_all"))
    return notes, weighed


_ORIGIN_COLUMNS = [*LISTING, "sku_no", "sku_num", "sku_title", "is_bundle", "is_gift", "package", "weight", "total_weight",
                   "total_weight_src", "sku_src", "ai_brand_name"]


@R.add("mapping_origin", f"""
WITH {_ANNOTATED.strip()},
brands AS (SELECT CASE WHEN platform = 'Amazon' THEN market ELSE platform END AS place, CASE WHEN platform = 'Amazon' THEN pfsku_id ELSE item_id END AS product_id,
    pfsku_id AS sku_id, max(month_dt) AS month_dt, upper(min(brand_name)) AS b FROM listing GROUP BY 1, 2, 3),
split AS (SELECT {', '.join('a.' + k for k in LISTING)}, a.brand_name, n.sku_no, n.sku_title, n.is_bundle, n.is_gift, n.package, n.weight,
    n.package * n.weight AS total_weight, 'notes' AS total_weight_src, 'notes' AS sku_src
  FROM listing a JOIN notes n ON lower(a.platform) = lower(n.platform) AND a.item_id = n.item_id AND a.pfsku_id = n.pfsku_id
    AND a.month_dt = n.month_dt AND (a.platform <> 'Amazon' OR a.market = n.market)),
rest AS (SELECT a.* FROM listing a WHERE NOT EXISTS (SELECT 1 FROM notes n WHERE lower(a.platform) = lower(n.platform)
    AND a.item_id = n.item_id AND a.pfsku_id = n.pfsku_id AND a.month_dt = n.month_dt AND (a.platform <> 'Amazon' OR a.market = n.market))),
whole AS (SELECT {', '.join('r.' + k for k in LISTING)}, r.brand_name, 1 AS sku_no, item_title || ' ' || brand_name AS sku_title, 0 AS is_bundle, 0 AS is_gift,
    coalesce(package_all, 1) AS package,
    CASE WHEN coalesce(package_all, 1) <> 0 AND coalesce(weight_all_in_g, 0) / coalesce(package_all, 1) < 40 THEN coalesce(weight_all_in_g, 0) / coalesce(package_all, 1) END AS weight,
    CASE WHEN coalesce(package_all, 1) <> 0 AND coalesce(weight_all_in_g, 0) / coalesce(package_all, 1) < 40 THEN coalesce(weight_all_in_g, 0) END AS total_weight,
    CASE WHEN weight_all_in_g IS NULL THEN '机器清洗' WHEN coalesce(package_all, 1) <> 0 AND weight_all_in_g / coalesce(package_all, 1) < 40
      THEN 'GPT克重清洗' ELSE '超过阈值40g' END AS total_weight_src, '机器清洗' AS sku_src
  FROM rest r LEFT JOIN weighed w ON r.platform = w.platform AND r.item_id = w.item_id AND r.pfsku_id = w.pfsku_id AND r.month_dt = w.month_dt),
both_parts AS (SELECT *, CAST(count(sku_no) OVER (PARTITION BY {KEYS}) AS INT) AS sku_num FROM split
  UNION ALL SELECT *, CAST(count(*) OVER (PARTITION BY {KEYS}) AS INT) FROM whole)
SELECT {', '.join('a.' + c for c in _ORIGIN_COLUMNS[:-1]).replace('a.weight', 'round(a.weight, 6) AS weight')}, coalesce(b, brand_name) AS ai_brand_name
FROM both_parts a LEFT JOIN brands d ON a.pfsku_id = d.sku_id
  AND (CASE WHEN lower(a.platform) = 'amazon' THEN lower(a.market) ELSE lower(a.platform) END) = lower(d.place)
  AND (CASE WHEN lower(a.platform) = 'amazon' THEN a.pfsku_id ELSE a.item_id END) = d.product_id
  AND (lower(a.platform) = 'amazon' OR a.month_dt = d.month_dt)
""", ("mapping", "listing"))
def _(v):
    notes, weighed = _annotations(v)
    amazon = F.col("platform") == "Amazon"
    brands = v.stored("listing").groupBy(
        F.when(amazon, F.col("market")).otherwise(F.col("platform")).alias("platform"),
        F.when(amazon, F.col("pfsku_id")).otherwise(F.col("item_id")).alias("product_id"),
        F.col("pfsku_id").alias("sku_id")).agg(
        F.max("month_dt").alias("month_dt"), F.upper(F.min("brand_name")).alias("std_brand_name"))
    attributes = v.stored("listing").withColumn("pfsku_title", F.col("brand_name"))
    out = P.mapping_origin(attributes, notes, weighed, 40, brands, "notes")
    return out.select(*_ORIGIN_COLUMNS).withColumn("weight", F.round("weight", 6))


# The surrogate key has no SQL twin; there have to be as many as there are distinct parts.
@R.add("mapping_origin_keys", f"""
SELECT platform, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT (coalesce(market, 'cn'), item_id, pfsku_id, coalesce(sku_no, 1),
  month_dt, coalesce(shop_id, '0'))) AS BIGINT) AS n_keys FROM ({R.sql["mapping_origin"]}) GROUP BY platform
""")
def _(v):
    notes, weighed = _annotations(v)
    attributes = v.stored("listing").withColumn("pfsku_title", F.col("brand_name"))
    return P.mapping_origin(attributes, notes, weighed, 40).groupBy("platform").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("unique_id").alias("n_keys"))


_WEIGHTED = [*LISTING, "sku_no", "sku_num", "sku_title", "package", "weight", "total_weight", "total_weight_src", "std_brand_name"]


@R.add("mapping_origin_weighted", f"""
WITH {_ANNOTATED.strip()},
own AS (SELECT * REPLACE ('cn' AS market), CAST(1 AS INT) AS own_no, CASE WHEN shop_id = '9' THEN page_price * 2 END AS own_total, 2 AS own_package,
    page_price AS own_weight, CASE WHEN shop_id <> '1' THEN 'upstream' END AS own_src FROM listing),
n AS (SELECT lower(platform) AS p, item_id, pfsku_id, month_dt, sku_no, min(sku_title) AS spu, max(part_weight) AS w, max(package) AS c, min(std_brand_name) AS b
  FROM notes GROUP BY ALL),
split AS (SELECT a.*, n.sku_no, spu, w, c, b, count(n.sku_no) OVER (PARTITION BY {', '.join('a.' + k for k in LISTING if k != 'market')}) AS parts
  FROM own a JOIN n ON lower(a.platform) = n.p AND a.item_id = n.item_id AND a.pfsku_id = n.pfsku_id AND a.month_dt = n.month_dt),
whole AS (SELECT a.*, weight_all_in_g AS g, package_all AS q, coalesce(weight_all_in_g, own_total) AS best, coalesce(package_all, own_package, 1) AS k
  FROM own a LEFT JOIN weighed w ON a.platform = w.platform AND a.item_id = w.item_id AND a.pfsku_id = w.pfsku_id AND a.month_dt = w.month_dt
  WHERE NOT EXISTS (SELECT 1 FROM n WHERE lower(a.platform) = n.p AND a.item_id = n.item_id AND a.pfsku_id = n.pfsku_id AND a.month_dt = n.month_dt)),
under AS (SELECT *, coalesce(CASE WHEN k <> 0 THEN best / k < 40 END, FALSE) AS ok FROM whole)
SELECT {KEYS}, sku_no, CAST(parts AS INT) AS sku_num,
  CASE WHEN parts = 1 THEN '' ELSE '（套组拆分）' END || spu || CAST(coalesce(w, own_weight) AS VARCHAR) || 'ml' || CAST(c AS VARCHAR) AS sku_title,
  c AS package, coalesce(w, own_weight) AS weight, coalesce(w, own_weight) * c AS total_weight, CASE WHEN w IS NULL THEN '机器清洗' ELSE 'notes' END AS total_weight_src,
  coalesce(b, brand_name) AS std_brand_name FROM split
UNION ALL
SELECT {KEYS}, own_no, CAST(count(own_no) OVER (PARTITION BY {', '.join(k for k in LISTING if k != 'market')}) AS INT), item_title, k,
  CASE WHEN ok THEN round(best / k, 6) END, CASE WHEN ok THEN best END,
  CASE WHEN ok OR own_src IS NULL THEN CASE WHEN g IS NOT NULL THEN 'GPT克重清洗' ELSE own_src END ELSE '超过阈值40g' END, NULL FROM under
""", ("mapping", "listing"))
def _(v):
    notes, weighed = _annotations(v)
    parts = notes.groupBy("platform", "item_id", "pfsku_id", "month_dt", "sku_no").agg(
        F.min("sku_title").alias("std_spu_name"), F.min("std_brand_name").alias("std_brand_name"),
        F.max("part_weight").alias("weight"), F.max("package").alias("package_num"),
        F.max("is_bundle").alias("is_bundle"), F.max("is_gift").alias("is_gift")).withColumn("weight_unit", F.lit("ml"))
    own = v.stored("listing").withColumns({
        "sku_no": F.lit(1), "sku_title": F.col("item_title"),
        "total_weight": F.when(F.col("shop_id") == "9", F.col("page_price") * 2), "package": F.lit(2),
        "weight": F.col("page_price"), "total_weight_src": F.when(F.col("shop_id") != "1", "upstream"),
        "is_bundle": F.lit(0)})
    out = P.mapping_origin_weighted(own, parts, weighed, 40, "notes")
    return out.select(*_WEIGHTED).withColumn("weight", F.round("weight", 6))


# --- standard mapping -------------------------------------------------------------------------------------------
_MEDIA = RuleSet(104996, [Rule(1, {"brand_name": ("contains", "1"), "platform": ("in", ["Suning", "Amazon"])}, {"media": "EC"}),
                          Rule(2, {"item_title": ("rlike", "^[a-m]")}, {"media": "OTHER"})])
_STD_BRAND = RuleSet(104998, [Rule(1, {"brand_name": "Brand#3"}, {"std_brand_name": "B3"}),
                              Rule(2, {"brand_name": "Brand#4"}, {"std_brand_name": ""}),
                              Rule(3, {"brand_name": "Brand#5"}, {"std_brand_name": "NULL"})])
_STD_CATEGORY = RuleSet(105117, [Rule(1, {"category_1": ("rlike", "^[A-M]"), "std_brand_name": "B3"},
                                      {"std_category_1": "early", "std_category_2": None}),
                                 Rule(2, {"category_1": ("rlike", "^[A-M]")}, {"std_category_1": "first", "std_category_2": "am"})])
_TRANSLATED = RuleSet(105116, [Rule(1, {"market": "cn"}, {"category_1_cn": " 国内\n"})])


@R.add("mapping_item_and_sku", f"""
WITH s AS (SELECT *, CASE WHEN platform = 'Suning' THEN shop_id ELSE '0' END AS shop, CAST(pfsku_id AS BIGINT) * 10 + sku_no AS uid FROM mapping),
first_row AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform, market, item_id, shop, month_dt ORDER BY uid) AS rn FROM s) WHERE rn = 1),
item AS (SELECT platform, market, item_id, shop, month_dt,
    CASE WHEN contains(brand_name, '1') AND platform IN ('Suning', 'Amazon') THEN 'EC' WHEN regexp_matches(item_title, '^[a-m]') THEN 'OTHER' END AS media,
    CASE WHEN contains(brand_name, '1') AND platform IN ('Suning', 'Amazon') THEN '104996,1' WHEN regexp_matches(item_title, '^[a-m]') THEN '104996,2' END AS media_src FROM first_row),
brands AS (SELECT CASE WHEN max(package) = 3 AND brand_name > 'Brand#2' THEN brand_name ELSE 'no ' || brand_name END AS brand_name,
    'MAP ' || m.brand_name AS mapped FROM mapping m GROUP BY m.brand_name),
r AS (SELECT *, CASE brand_name WHEN 'Brand#3' THEN 'B3' WHEN 'Brand#5' THEN 'NULL' ELSE std_brand_name END AS rb,
    CASE brand_name WHEN 'Brand#3' THEN '104998,1' WHEN 'Brand#5' THEN '104998,3' END AS rs FROM s)
SELECT r.platform, r.market, r.item_id, r.pfsku_id, r.shop_id, r.month_dt, r.sku_no, item.media, item.media_src, coalesce(mapped, rb) AS std_brand_name,
  CASE WHEN mapped IS NOT NULL THEN 'std_brand_mapping' ELSE rs END AS std_brand_name_src,
  CASE WHEN regexp_matches(category_1, '^[A-M]') THEN CASE WHEN rb = 'B3' THEN 'early' ELSE 'first' END END AS std_category_1,
  CASE WHEN regexp_matches(category_1, '^[A-M]') AND rb IS DISTINCT FROM 'B3' THEN 'am' END AS std_category_2,
  CASE WHEN r.market = 'cn' THEN '国内' ELSE '' END AS category_1_cn, trim(category_1) AS category_1
FROM r LEFT JOIN brands USING (brand_name) LEFT JOIN item ON r.platform = item.platform AND r.market IS NOT DISTINCT FROM item.market
  AND r.item_id = item.item_id AND r.shop = item.shop AND r.month_dt = item.month_dt
""", ("mapping",))
def _(v):
    none = F.lit(None).cast("string")
    source = v.stored("mapping").withColumns({
        "unique_id": F.col("pfsku_id").cast("bigint") * 10 + F.col("sku_no"), "media": none, "media_src": none,
        "ai_brand_name": F.col("brand_name"), "std_brand_name_src": none, "std_category_1": none,
        "std_category_2": none, "category_1_cn": none})
    named = v.stored("mapping").groupBy("brand_name").agg(F.max("package").alias("p")).withColumn(
        "std_brand_name", F.concat(F.lit("MAP "), "brand_name"))
    brands = missing_unless(named, "p = 3 AND brand_name > 'Brand#2'", "brand_name").select("brand_name", "std_brand_name")
    out = P.standard_mapping(source, _MEDIA, _STD_BRAND, _STD_CATEGORY, _TRANSLATED, brands, japan="asia")
    return out.select(*LISTING, "sku_no", "media", "media_src", "std_brand_name", "std_brand_name_src", "std_category_1",
                      "std_category_2", "category_1_cn", "category_1")


def _laid_out(schema, given) -> str:
    """A whole target layout in SQL: the columns given, and typed NULLs for the others."""
    names = [g.split(" AS ")[-1].split(".")[-1] for g in given]
    return ", ".join([*given, typed_nulls(schema, names)])


# --- fixed price, fixed count, status, wide sales ------------------------------------------------------------------
def _key(a: str, b: str) -> str:
    """The listing join condition in its literal form."""
    return (f"{a}.month_dt = {b}.month_dt AND lower({a}.platform) = lower({b}.platform) AND {a}.item_id = {b}.item_id "
            f"AND {a}.pfsku_id = {b}.pfsku_id AND (lower({a}.platform) <> 'amazon' OR {a}.market = {b}.market) "
            f"AND CASE WHEN lower({a}.platform) = 'suning' THEN {a}.shop_id ELSE '0' END = "
            f"CASE WHEN lower({b}.platform) = 'suning' THEN {b}.shop_id ELSE '0' END")


_PRICED = f"""
priced AS (SELECT a.platform, a.market, a.item_id, a.pfsku_id, c.shop_id, a.month_dt, a.category_1, a.item_title,
  a.page_price, a.discount_price FROM listing a LEFT JOIN mapping c ON c.sku_no = 1 AND {_key('a', 'c')}),
fixed_price AS (SELECT * REPLACE (CASE WHEN {P1} THEN 9.5 WHEN {P2} THEN 12 ELSE page_price END AS page_price,
    CASE WHEN {P1} THEN 9.5 WHEN {P2} THEN 12 ELSE discount_price END AS discount_price),
  CASE WHEN {P1} THEN '1,1' WHEN {P2} THEN '1,2' ELSE 'feed' END AS discount_price_src FROM priced)
"""
_COUNTED = f"""
counted AS (SELECT a.platform, a.market, a.item_id, a.pfsku_id, c.shop_id, a.month_dt, c.brand_name, a.pfsku_unit_sales
  FROM listing a LEFT JOIN mapping c ON c.sku_no = 1 AND {_key('a', 'c')}),
scaled AS (SELECT * REPLACE (CAST(trunc(CASE WHEN regexp_matches(brand_name, '#1[0-9]$') THEN 1.25 ELSE 1 END *
    CAST(CASE WHEN platform = 'Suning' THEN 100 ELSE pfsku_unit_sales END AS DOUBLE)) AS BIGINT) AS pfsku_unit_sales),
  CASE WHEN regexp_matches(brand_name, '#1[0-9]$') THEN '3,1' WHEN platform = 'Suning' THEN '2,1' END AS pfsku_unit_sales_src,
  CASE WHEN regexp_matches(brand_name, '#1[0-9]$') THEN 1.25 END AS fix_count_ratio FROM counted),
fixed_count AS (SELECT *, CAST(sum(pfsku_unit_sales) OVER (PARTITION BY month_dt, platform, market, item_id,
    CASE WHEN lower(platform) = 'suning' THEN shop_id ELSE '0' END) AS BIGINT) AS item_unit_sales FROM scaled)
"""
_STATUS = f"""
listed AS (SELECT upper(platform) AS platform, item_id, month_dt, CASE WHEN sum(pfsku_unit_sales) > 900 THEN 1 ELSE 0 END AS exclude
  FROM listing GROUP BY platform, item_id, month_dt),
judged AS (SELECT a.platform, a.market, a.item_id, a.pfsku_id, c.shop_id, a.month_dt, coalesce(e.exclude, 0) AS flag FROM listing a
  LEFT JOIN mapping c ON c.sku_no = 1 AND {_key('a', 'c')}
  LEFT JOIN listed e ON e.exclude = 1 AND lower(a.platform) = lower(e.platform) AND a.item_id = e.item_id AND a.month_dt = e.month_dt),
product_status AS (SELECT platform, market, item_id, pfsku_id, shop_id, month_dt, 'exclude' AS status,
    CASE WHEN flag = 1 THEN 'dwd_exclude_scope' ELSE '4,1' END AS status_src FROM judged WHERE flag = 1 OR market = 'asia')
"""


def _fixed_price(v):
    price = v.stored("listing").withColumn("discount_price_src", F.lit("feed"))
    return P.fixed_price(price, v.stored("mapping"), PRICE)


def _fixed_count(v):
    count = v.stored("listing").drop("brand_name").withColumn("pfsku_unit_sales_src", F.lit(None).cast("string"))
    return P.fixed_count(count, v.stored("mapping"), UNITS, RATIO)


def _status(v):
    listed = v.stored("listing").groupBy("platform", "item_id", "month_dt").agg(
        F.when(F.sum("pfsku_unit_sales") > 900, 1).otherwise(0).alias("exclude")).withColumn(
        "platform", F.upper("platform"))
    return P.product_status(v.stored("listing"), v.stored("mapping"), listed, STATUS, "dwd_exclude_scope")


@R.add("fixed_price", f"""
WITH {_PRICED.strip()} SELECT {_laid_out(S.MONTHLY_PRICE, [*LISTING, "page_price", "discount_price", "discount_price_src"])} FROM fixed_price
""", ("listing", "mapping"))
def _(v):
    return _fixed_price(v)


@R.add("fixed_count", f"""
WITH {_COUNTED.strip()} SELECT {_laid_out(S.MONTHLY_COUNT, [*LISTING, "pfsku_unit_sales", "pfsku_unit_sales_src", "fix_count_ratio",
  "item_unit_sales"])} FROM fixed_count
""", ("listing", "mapping"))
def _(v):
    return _fixed_count(v)


@R.add("product_status", f"""
WITH {_STATUS.strip()} SELECT {_laid_out(S.PRODUCT_STATUS, [*LISTING, "status", "status_src"])} FROM product_status
""", ("listing", "mapping"))
def _(v):
    return _status(v)


# Columns of the wide layout that the query computes, in SQL; the mapping's own columns are taken as they are.
_WIDE = {
    "pfsku_url": "replace(pfsku_url, '/dp/MC_Assembly_1#', '/dp/')", "std_brand_name_ori": "std_brand_name",
    "std_brand_name": "coalesce(grouped, std_brand_name)", "updated_shop_name": "updated_shop_name",
    "item_unit_sales": "item_unit_sales", "pfsku_unit_sales": "pfsku_unit_sales", "pfsku_discount_price": "discount_price",
    "pfsku_page_price": "page_price", "pfsku_value_sales": "pfsku_unit_sales * discount_price",
    "pfsku_discountprice_value_sales": "pfsku_unit_sales * discount_price",
    "pfsku_pageprice_value_sales": "pfsku_unit_sales * page_price", "sku_unit_sales": "pfsku_unit_sales",
    "sku_volume_sales": "pfsku_unit_sales * total_weight", "sku_pack_sales": "pfsku_unit_sales * package",
    "sku_discount_price_tmp": "coalesce(CASE WHEN sku_num = 1 THEN own_price ELSE group_price END, sku_price)",
    "sku_value_sales": "CASE WHEN sku_num = 1 THEN pfsku_unit_sales * discount_price END",
    "sku_value_ratio": "CASE WHEN sku_num = 1 THEN 1 ELSE sku_value_ratio END",
    "sku_value_ratio_src": "CASE WHEN sku_num = 1 THEN '单品不拆' ELSE sku_value_ratio_src END",
    "sku_value_ratio_fixed": "sku_value_ratio", "fix_count_ratio": "fix_count_ratio", "product_listing_time": "first_month",
    "etl_updated_at": "'noted'",
}
_OWN = ("category_1", "brand_name", "item_title", "sku_no", "sku_num", "std_sku_name", "package", "weight", "total_weight")


@R.add("sales_wide", f"""
WITH {_PRICED.strip()}, {_COUNTED.strip()}, {_STATUS.strip()},
staged AS (SELECT a.*, b.item_unit_sales, b.pfsku_unit_sales, b.fix_count_ratio, c.page_price, c.discount_price,
    CASE WHEN a.sku_num = 1 THEN c.discount_price / a.package ELSE 0 END AS own_price
  FROM mapping a JOIN fixed_count b ON {_key('a', 'b')} JOIN fixed_price c ON {_key('a', 'c')}
  WHERE c.page_price > 2 AND c.page_price < 49 AND b.item_unit_sales > 30 AND b.item_unit_sales < 5000
    AND NOT EXISTS (SELECT 1 FROM product_status d WHERE d.status = 'exclude' AND {_key('a', 'd')})),
average AS (SELECT market, platform, month_dt, std_sku_name, {EXACT_AVG.format("own_price")} AS group_price FROM staged
  WHERE sku_num = 1 AND std_sku_name IS NOT NULL AND own_price <> 0 GROUP BY 1, 2, 3, 4),
standard AS (SELECT platform, month_dt, std_sku_name, CAST(max(sku_no) AS DOUBLE) AS sku_price FROM mapping GROUP BY 1, 2, 3),
shops AS (SELECT platform, market, CASE WHEN platform = 'Suning' THEN shop_id ELSE 'no ' || shop_id END AS shop_id, month_dt,
    'shop ' || max(item_id) AS updated_shop_name FROM listing GROUP BY 1, 2, 3, 4),
groups AS (SELECT DISTINCT CASE WHEN brand_name < 'Brand#3' THEN brand_name ELSE 'no ' || brand_name END AS brand_name,
  'G' || l.brand_name AS grouped FROM listing l),
seen AS (SELECT lower(platform) AS p, market, CASE WHEN platform = 'Amazon' THEN pfsku_id ELSE item_id END AS product, min(month_dt) AS first_month
  FROM mapping GROUP BY 1, 2, 3)
SELECT {_laid_out(S.WIDE_SALES, ["a." + k for k in LISTING] + ["a." + c for c in _OWN] + [f"{x} AS {c}" for c, x in _WIDE.items()])}
FROM staged a LEFT JOIN average USING (market, platform, month_dt, std_sku_name) LEFT JOIN standard USING (platform, month_dt, std_sku_name)
  LEFT JOIN shops USING (platform, market, shop_id, month_dt) LEFT JOIN groups g ON a.std_brand_name = g.brand_name
  LEFT JOIN seen s ON lower(a.platform) = s.p AND a.market = s.market
    AND CASE WHEN a.platform = 'Amazon' THEN a.pfsku_id ELSE a.item_id END = s.product
""", ("listing", "mapping"))
def _(v):
    fixed = v.stored("mapping").groupBy("platform", "month_dt", "std_sku_name").agg(
        F.max("sku_no").cast("double").alias("sku_price"))
    shops = missing_unless(v.stored("listing"), "platform = 'Suning'", "shop_id").groupBy("platform", "market", "shop_id", "month_dt").agg(
        F.concat(F.lit("shop "), F.max("item_id")).alias("updated_shop_name"))
    grouped = v.stored("listing").select("brand_name", F.concat(F.lit("G"), "brand_name").alias("std_brand_name")).distinct()
    groups = missing_unless(grouped, "brand_name < 'Brand#3'", "brand_name").withColumnRenamed("brand_name", "std_brand_name_ori")
    # Fixed counts, prices and the status are tables of their own jobs.
    inputs = [stored(df, "fixed") for df in (_fixed_count(v), _fixed_price(v), _status(v))]
    out = P.sales_wide(
        v.stored("mapping"), *inputs, fixed_prices=fixed, shop_names=shops,
        brand_groups=groups, min_price=2, max_price=49, min_count=30, max_count=5000)
    return out.withColumns({"etl_updated_at": F.when(F.length("etl_updated_at") == 19, "noted")})


# --- external price, pet mapping ------------------------------------------------------------------------------------
@R.add("external_price_override", f"""
WITH feed AS (SELECT CASE WHEN platform = 'Amazon' THEN item_id ELSE 'no ' || item_id END AS item_id, month_dt, max(page_price) - 5 AS price
  FROM listing GROUP BY 1, 2),
clean AS (SELECT * FROM feed WHERE price > 0 AND month_dt BETWEEN '1993-01-01' AND '1996-10-01')
SELECT {KEYS}, CASE WHEN {P1} THEN 9.5 WHEN {P2} THEN 12 ELSE coalesce(price, page_price) END AS page_price,
  CASE WHEN {P1} THEN 9.5 WHEN {P2} THEN 12 ELSE coalesce(price, discount_price) END AS discount_price,
  CASE WHEN {P1} THEN '1,1' WHEN {P2} THEN '1,2' WHEN price IS NOT NULL THEN 'external' ELSE 'feed' END AS discount_price_src
FROM (SELECT l.*, price FROM listing l LEFT JOIN clean c ON l.platform = 'Tmall' AND l.item_id = c.item_id AND l.month_dt = c.month_dt)
""", ("listing",))
def _(v):
    feed = missing_unless(v.stored("listing"), "platform = 'Amazon'", "item_id").groupBy("item_id", "month_dt").agg(
        (F.max("page_price") - 5).alias("price"))
    clean = X.clean_feed(feed, "1993-01-01", "1996-10-01", "Tmall")
    price = v.stored("listing").withColumn("discount_price_src", F.lit("feed"))
    return X.external_price(price, clean, PRICE, "external").select(
        *LISTING, "page_price", "discount_price", "discount_price_src")


_SHOP = RuleSet(104732, [Rule(1, {"shop_id": "3"}, {"fix_shop_id": "33", "fix_shop_name": "three"})])
_NAME = RuleSet(104736, [Rule(1, {"item_title": ("contains", "gear")}, {"fix_spu_name": "Gear"})])
_PRIMARY = RuleSet(104735, [Rule(1, {"brand_name": "Brand#1"}, {"std_brand_name": "ONE", "std_category_2": "猫干粮"}),
                            Rule(2, {"brand_name": "Brand#2"}, {"std_brand_name": "TWO", "std_category_2": "NULL"})])
_FALL_BRAND = RuleSet(104744, [Rule(1, {"shop_id": "33"}, {"std_brand_name": "SHOP33"})])
_LATE_BRAND = RuleSet(104741, [Rule(1, {"std_brand_name": "SHOP33", "market": "cn"}, {"fix_brand": "LATE"})])
_FALL_CAT = RuleSet(104748, [Rule(1, {"category_1": ("rlike", "^[A-M]")}, {"std_category_2": "狗零食"})])
_LATE_CAT = RuleSet(104747, [Rule(1, {"std_category_2": "狗零食", "market": "asia"}, {"fix_std_category_2": "猫湿粮"})])
_SHARED = RuleSet(104737, [Rule(1, {"item_title": ("rlike", "^[a-f]")}, {"fix_lifestage": "kitten", "fix_breed": ""})])
_OWN = {"breed": RuleSet(104743, [Rule(1, {"lifestage": "kitten"}, {"fix_breed": "any"})])}
_PACK = RuleSet(104760, [Rule(1, {"platform": "Suning"}, {"fix_package": "3", "fix_weight": None}),
                         Rule(2, {"market": "europe"}, {"fix_package": None, "fix_weight": "250.5"})])
_CHANNEL = RuleSet(104733, [Rule(1, {"std_brand_name": "LATE"}, {"channel": "EC", "ka_group": "G", "ka_name": "N"})])


@R.add("pet_mapping", f"""
WITH {GATE.split('named AS')[0].strip().rstrip(',')},
a AS (SELECT m.* REPLACE (CASE WHEN shop_id = '3' THEN '33' ELSE shop_id END AS shop_id), category_1 AS std_category_3,
    CASE WHEN contains(item_title, 'gear') THEN 'Gear' ELSE 'name ' || item_title END AS spu,
    CASE WHEN contains(item_title, 'gear') THEN '104736,1' ELSE '104736,__DEFAULT__' END AS spu_src,
    CASE WHEN CAST(item_id AS INT) % 2 = 0 THEN '机器清洗' ELSE 'annotated' END AS sku_src,
    CASE WHEN platform = 'Tmall' THEN CASE WHEN CAST(item_id AS INT) % 3 = 0 THEN 'EXT' ELSE '' END END AS ext_brand,
    CASE WHEN platform = 'Tmall' THEN CASE CAST(item_id AS INT) % 4 WHEN 0 THEN 'Dog Dry' WHEN 1 THEN 'Bird' END END AS ext_cat FROM listing_month m),
b AS (SELECT *, CASE brand_name WHEN 'Brand#1' THEN 'ONE' WHEN 'Brand#2' THEN 'TWO' END AS prime_brand,
    CASE brand_name WHEN 'Brand#1' THEN '猫干粮' END AS prime_cat FROM a),
c AS (SELECT *, coalesce(prime_brand, nullif(ext_brand, ''), CASE WHEN shop_id = '33' THEN 'SHOP33' END) AS mid_brand,
    CASE WHEN prime_brand IS NOT NULL THEN '104735,' || right(brand_name, 1) WHEN ext_brand <> '' THEN 'pn_monthly_sales_discount'
      WHEN shop_id = '33' THEN '104744,1' END AS mid_brand_src FROM b),
d AS (SELECT *, prime_brand IS NULL AND mid_brand = 'SHOP33' AND market = 'cn' AS late FROM c),
e AS (SELECT *, CASE WHEN late THEN 'LATE' ELSE mid_brand END AS brand, CASE WHEN late THEN '104741,1' ELSE mid_brand_src END AS brand_src,
    CASE WHEN prime_cat IS NOT NULL THEN prime_cat WHEN ext_cat IS NOT NULL THEN CASE ext_cat WHEN 'Dog Dry' THEN '狗干粮' END
      WHEN regexp_matches(category_1, '^[A-M]') THEN '狗零食' END AS mid_cat,
    CASE WHEN prime_cat IS NOT NULL THEN '104735,1' WHEN ext_cat IS NOT NULL THEN 'pn_monthly_sales_discount'
      WHEN regexp_matches(category_1, '^[A-M]') THEN '104748,1' END AS mid_cat_src FROM d),
f AS (SELECT *, CASE WHEN prime_cat IS NULL AND mid_cat = '狗零食' AND market = 'asia' THEN '猫湿粮' ELSE mid_cat END AS cat,
    CASE WHEN prime_cat IS NULL AND mid_cat = '狗零食' AND market = 'asia' THEN '104747,1' ELSE mid_cat_src END AS cat_src,
    CASE WHEN regexp_matches(item_title, '^[a-f]') THEN 'kitten' END AS lifestage FROM e),
w AS (SELECT *, CASE WHEN platform = 'Suning' THEN 3 ELSE 2 END AS package, CASE WHEN platform <> 'Suning' AND market = 'europe' THEN 250.5 ELSE page_price END AS weight FROM f),
pet_gate AS (SELECT DISTINCT cat AS c2, CASE WHEN platform = 'Tmall' THEN brand ELSE 'no ' || brand END AS b FROM f
  WHERE brand IS NOT NULL AND cat IS NOT NULL),
g AS (SELECT w.*, p.b IS NOT NULL AND ((spu_src = '104736,1' AND platform = 'Tmall') OR sku_src <> '机器清洗') AS keep
  FROM w LEFT JOIN pet_gate p ON w.cat = p.c2 AND w.brand = p.b AND w.platform = 'Tmall' AND month_dt BETWEEN '1994-01-01' AND '1996-01-01'),
n AS (SELECT *, CASE WHEN keep THEN spu ELSE coalesce(brand, '') || coalesce(lifestage, '') || coalesce(std_category_3, '') END AS name0,
    CASE WHEN keep THEN spu_src ELSE 'brand_limit_rule' END AS src0 FROM g),
names AS (SELECT DISTINCT 'name ' || p_name AS old, 'line ' || upper(p_name) AS new FROM part),
o AS (SELECT n.*, coalesce(new, name0) AS name1, CASE WHEN new IS NOT NULL THEN 'spu_mapping' ELSE src0 END AS src1 FROM n LEFT JOIN names ON name0 = old)
SELECT platform, market, item_id, pfsku_id, shop_id, month_dt, brand AS std_brand_name, brand_src AS std_brand_name_src, cat AS std_category_2, cat_src AS std_category_2_src,
  CASE WHEN cat LIKE '猫%' THEN '猫食品' WHEN cat LIKE '狗%' THEN '狗食品' END AS std_category_1, lifestage,
  CASE WHEN lifestage IS NOT NULL THEN '104737,1' END AS lifestage_src,
  CASE WHEN lifestage IS NOT NULL THEN 'any' END AS breed, CASE WHEN lifestage IS NOT NULL THEN '104743,1' END AS breed_src,
  package, weight, CASE WHEN platform = 'Suning' OR market = 'europe' THEN package * weight ELSE 1 END AS total_weight,
  CASE WHEN brand = 'LATE' THEN 'EC' END AS channel, name1 AS std_spu_name, src1 AS std_spu_name_src,
  name1 || CAST(CAST(trunc(weight) AS INT) AS VARCHAR) || 'g' AS std_sku_name
FROM o
""", ("listing_month",))
def _(v):
    item = F.col("item_id").cast("int")
    none = F.lit(None).cast("string")
    rows = v.listing_month.withColumns({
        "shop_name": none, "std_spu_name": F.concat(F.lit("name "), "item_title"),
        "std_spu_name_src": F.lit("104736,__DEFAULT__"), "std_category_3": F.col("category_1"),
        "sku_src": F.when(item % 2 == 0, "机器清洗").otherwise("annotated"),
        "pn_brandname_new": F.when(item % 3 == 0, "EXT").otherwise(""),
        "pn_sub_categoryname": F.when(item % 4 == 0, "Dog Dry").when(item % 4 == 1, "Bird"),
        "rc_brandname": none, "rc_categoryname_revised": none, "std_brand_name": none, "std_brand_name_src": none,
        "std_category_1": none, "std_category_2": none, "std_category_2_src": none, "package": F.lit(2),
        "weight": F.col("page_price"), "total_weight": F.lit(1.0), "package_src": none, "weight_src": none,
        "total_weight_src": none, "lifestage": none, "breed": none})
    named = D.standard_names(
        D.apply_rules(rows, _SHOP, {"fix_shop_id": "shop_id", "fix_shop_name": "shop_name"}), _PRIMARY, _FALL_BRAND,
        _LATE_BRAND, _FALL_CAT, _LATE_CAT, "pn_monthly_sales_discount", "rc_monthly_sales_discount")
    known = named.filter("std_brand_name IS NOT NULL AND std_category_2 IS NOT NULL")
    gate = missing_unless(known, "platform = 'Tmall'", "std_brand_name").select(
        "std_category_2", "std_brand_name", "platform", F.lit("1994-01-01").alias("start_time"),
        F.lit("1996-01-01").alias("end_time")).distinct()
    names = v.part.select(F.concat(F.lit("name "), "p_name").alias("std_spu_name"),
                          F.concat(F.lit("line "), F.upper("p_name")).alias("std_spu_name_map")).distinct()
    out = D.pet_mapping(
        rows, _SHOP, _NAME, _PRIMARY, _FALL_BRAND, _LATE_BRAND, _FALL_CAT, _LATE_CAT, _SHARED, _OWN,
        {"fix_lifestage": "lifestage", "fix_breed": "breed"}, _PACK, _CHANNEL, gate, "pn_monthly_sales_discount",
        "rc_monthly_sales_discount", 104736, ("JD", "Tmall", "Douyin"), "机器清洗", names)
    return out.select(
        *LISTING, "std_brand_name", "std_brand_name_src", "std_category_2", "std_category_2_src", "std_category_1",
        "lifestage", "lifestage_src", "breed", "breed_src", "package", "weight", "total_weight", "channel", "std_spu_name",
        "std_spu_name_src", "std_sku_name")
