"""Column functions: cleaning, titles, fingerprints, brands, weights, measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import keys as K, measures as M, text as T

from .base import Registry

R = Registry()
QUERIES, ORACLE = R.queries, R.sql


@R.add("clean_fields", r"""
SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\r|\n', '', 'g')) AS cleaned,
  trim(regexp_replace(coalesce(CASE WHEN doc_id % 2 = 0 THEN source END, lang, ''), '\r|\n', '', 'g')) AS label
FROM documents
""")
def _(v):
    return v.documents.select(
        "doc_id", T.clean_text("text").alias("cleaned"),
        T.clean_text(F.when(F.col("doc_id") % 2 == 0, F.col("source")), "lang").alias("label"))


@R.add("blank_flags", """
SELECT o_orderkey, CASE WHEN p NOT IN ('', '0') THEN p END AS priority, CASE WHEN p <> '' THEN p END AS kept_zero,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS closed
FROM (SELECT *, CASE WHEN o_orderpriority LIKE '1%' THEN '0' WHEN o_orderpriority LIKE '2%' THEN '' ELSE
      o_orderpriority END AS p FROM orders)
""")
def _(v):
    p = F.when(F.col("o_orderpriority").startswith("1"), "0").when(
        F.col("o_orderpriority").startswith("2"), "").otherwise(F.col("o_orderpriority"))
    return v.orders.select("o_orderkey", T.blank_to_null(p).alias("priority"),
                           T.blank_to_null(p, ()).alias("kept_zero"),
                           T.flag("o_orderstatus", {"F": 1, "O": 0}).alias("closed"))


@R.add("first_non_blank", """
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN nullif('', '') ELSE lang END,
                        nullif(source, '')) AS label FROM documents
""")
def _(v):
    first = F.when(F.col("doc_id") % 3 == 1, "").when(F.col("doc_id") % 3 == 2, F.col("lang"))
    return v.documents.select("doc_id", T.first_non_blank(first, "source").alias("label"))


@R.add("image_lists", """
WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, images_1 AS a, images_2 AS b FROM
  (SELECT *, CAST(code AS BIGINT) AS l_partkey FROM crawl_rows))
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN a = b OR b IS NULL THEN '["' || replace(a, ' | ', '","') || '"]'
       WHEN a IS NULL THEN '["' || replace(b, ' | ', '","') || '"]'
       ELSE '["' || replace(a, ' | ', '","') || '","' || replace(b, ' | ', '","') || '"]' END AS images,
  CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN '[' || replace(a, '|', ',') || ',' || replace(b, '|', ',') || ']'
       ELSE '[' || replace(coalesce(a, b), '|', ',') || ']' END AS plain_images
FROM i
""", ("crawl_rows",))
def _(v):
    return v.crawl_rows.select(
        "l_orderkey", "l_linenumber", F.col("code").cast("bigint").alias("l_partkey"),
        T.image_list("images_1", "images_2").alias("images"),
        T.image_list_plain("images_1", "images_2").alias("plain_images"))


@R.add("titles", """
WITH p AS (SELECT p_partkey, p_name AS item, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN ''
                  ELSE p_brand END AS sku,
           CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Others' WHEN 2 THEN '' ELSE p_type END AS spu,
           CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 4 END AS weight,
           CASE p_size % 6 WHEN 0 THEN 'Tmall' WHEN 1 THEN 'jd' ELSE 'PDD' END AS platform,
           CAST(p_size % 2 + 1 AS INT) AS parts FROM part),
n AS (SELECT *, CASE WHEN spu <> '' AND lower(spu) <> 'others' AND weight IS NOT NULL
                THEN spu || CAST(CAST(round_even(weight, 0) AS BIGINT) AS VARCHAR) || 'ml' END AS std_sku_name FROM p)
SELECT p_partkey, CASE WHEN sku <> '' AND sku <> 'null' THEN item || ' ' || sku ELSE item END AS sku_title, std_sku_name,
  coalesce(std_sku_name, CASE WHEN lower(platform) IN ('tmall', 'jd') THEN coalesce(sku, '') || item ELSE item END)
    AS display_title,
  spu || CAST(CAST(trunc(weight) AS INT) AS VARCHAR) || 'g' AS gram_name,
  CASE WHEN parts = 1 THEN '' ELSE '（套组拆分）' END || spu || CASE WHEN weight IS NULL THEN '' ELSE
    CAST(weight AS VARCHAR) || 'ml' || CAST(parts AS VARCHAR) END AS part_title
FROM n
""")
def _(v):
    size = F.col("p_size")
    p = v.part.select(
        "p_partkey", F.col("p_name").alias("item"),
        F.when(size % 4 == 1, "null").when(size % 4 == 2, "").when(size % 4 == 3, F.col("p_brand")).alias("sku"),
        F.when(size % 5 == 1, "Others").when(size % 5 == 2, "").when(size % 5 > 2, F.col("p_type")).alias("spu"),
        F.when(size % 3 != 0, size.cast("double") / 4).alias("weight"),
        F.when(size % 6 == 0, "Tmall").when(size % 6 == 1, "jd").otherwise("PDD").alias("platform"),
        (size % 2 + 1).alias("parts"),
    ).withColumn("std_sku_name", T.standard_sku_name("spu", "weight"))
    return p.select(
        "p_partkey", T.sku_title("item", "sku").alias("sku_title"), "std_sku_name",
        T.display_title("std_sku_name", "platform", "sku", "item").alias("display_title"),
        T.gram_sku_name("spu", "weight").alias("gram_name"),
        T.part_title("spu", "weight", F.lit("ml"), "parts", "parts").alias("part_title"))


@R.add("urls", """
SELECT page_id, coalesce(nullif(replace(url, '/dp/MC_Assembly_1#', '/dp/'), ''), url) AS url FROM site_url
""", ("site_url",))
def _(v):
    return v.site_url.select("page_id", T.rewrite_url("url", "/dp/MC_Assembly_1#", "/dp/").alias("url"))


_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@R.add("text_fingerprint", rf"""
SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) || '_' ||
  trim(regexp_replace(coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source || '   ' END, ''), '{_SPACE}', ' ', 'g')))
  AS text_hash_id FROM documents
""")
def _(v):
    second = F.when(F.col("doc_id") % 3 != 0, F.concat("source", F.lit("   ")))
    return v.documents.select("doc_id", T.text_fingerprint("text", second).alias("text_hash_id"))


@R.add("cache_key", "SELECT doc_id, md5(text) AS fields_hash FROM documents")
def _(v):
    return v.documents.select("doc_id", T.cache_key("text").alias("fields_hash"))


# xxhash64 exists in no SQL function of the other engine. What a key has to do can be compared: as many keys as
# there are distinct tuples, in every platform, and no key for two tuples.
_TUPLE = """platform || '||' || coalesce(market, 'cn') || '||' || item_id || '||' || pfsku_id || '||' ||
  coalesce(CAST(sku_no AS VARCHAR), '1') || '||' || month_dt || '||' || coalesce(shop_id, '0')"""


@R.add("surrogate_key", f"""
SELECT platform, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT {_TUPLE}) AS BIGINT) AS n_keys, CAST(0 AS BIGINT) AS shared
FROM mapping GROUP BY platform
""", ("mapping",))
def _(v):
    parts = ["platform", F.coalesce("market", F.lit("cn")), "item_id", "pfsku_id",
             F.coalesce(F.col("sku_no").cast("string"), F.lit("1")), "month_dt", F.coalesce("shop_id", F.lit("0"))]
    keyed = v.mapping.select("platform", K.part_key(part="sku_no").alias("unique_id"), F.concat_ws("||", *parts).alias("t"))
    by_key = keyed.groupBy("platform", "unique_id").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("a"), F.max("t").alias("b"))
    return by_key.groupBy("platform").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("a") != F.col("b")).alias("shared"))


# Full-width forms of ASCII and some half-width katakana with their NFKC forms. Fixed values.
_WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
_ASCII = "".join(chr(c) for c in range(0x21, 0x7F))
_HALF, _FULL = "ｱｲｳｴｵｶｷｸｹｺ", "アイウエオカキクケコ"


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@R.add("nfkc_brand", f"""
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'JP' ELSE 'US' END AS market, CASE WHEN turn % 2 = 0
  THEN left(text, 40) || '{_FULL}' ELSE translate(left(text, 40), {_sql_text(_ASCII)}, {_sql_text(_WIDE)}) || '{_HALF}' END AS brand_name
FROM conversations
""")
def _(v):
    wide = F.concat(F.translate(F.substring("text", 1, 40), _ASCII, _WIDE), F.lit(_HALF))
    rows = v.conversations.select(
        "conv_id", "turn", F.when(F.col("turn") % 2 == 0, "JP").otherwise("US").alias("market"), wide.alias("brand_name"))
    return T.nfkc_in_market(rows, ["brand_name"], "market")


@R.add("brand_key", rf"""
SELECT doc_id, regexp_replace(lower(text), '[！!。，,、\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]', '', 'g')
  AS brand_key FROM documents
""")
def _(v):
    return v.documents.select("doc_id", T.brand_key("text").alias("brand_key"))


_BRAND = """
token AS (SELECT *, lower(regexp_extract(std_brand_name, '[a-zA-Z]+')) AS latin,
  regexp_extract(std_brand_name, '[一-龥]+') AS han,
  lower(item_title || coalesce(pfsku_title, '') || coalesce(brand_name, '')) AS hay FROM annotated),
chosen AS (SELECT *, coalesce(CASE WHEN (latin <> '' AND contains(hay, latin)) OR (han <> '' AND contains(hay, han))
    OR coalesce(brand_name, '') = '' OR lower(brand_name) LIKE '%无品牌%' OR lower(brand_name) LIKE '%其他%'
    OR lower(brand_name) LIKE '%other%' THEN std_brand_name ELSE brand_name END, brand_name) AS pick FROM token)
"""


@R.add("brand_arbitration", f"""
WITH {_BRAND.strip()}
SELECT item_id, pfsku_id, month_dt, upper(pick) AS std_brand_name,
  CASE WHEN std_brand_name <> pick THEN '因相同标题或std_brand_name为空原因修正异常std_brand_name' END AS std_brand_name_src
FROM chosen
""", ("annotated",))
def _(v):
    brand, label = T.arbitrated_brand("std_brand_name", "brand_name", "item_title", "pfsku_title")
    return v.annotated.select("item_id", "pfsku_id", "month_dt", brand.alias("std_brand_name"),
                              label.alias("std_brand_name_src"))


@R.add("unit_weight", """
WITH w AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity * 10 END AS total,
  CASE l_linenumber % 4 WHEN 0 THEN NULL ELSE l_linenumber END AS n,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_quantity END AS own, CASE WHEN l_linenumber % 5 = 0 THEN NULL
  ELSE 'upstream' END AS src FROM lineitem),
u AS (SELECT *, coalesce(n, 1) AS c, coalesce(total, own) AS best FROM w)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, c AS package,
  CASE WHEN coalesce(total, 0) / c < 120 THEN round(coalesce(total, 0) / c, 6) END AS weight,
  CASE WHEN coalesce(total, 0) / c < 120 THEN coalesce(total, 0) END AS total_weight,
  CASE WHEN coalesce(total, 0) / c < 120 OR total IS NULL THEN CASE WHEN total IS NOT NULL THEN 'GPT克重清洗' ELSE
    '机器清洗' END ELSE '超过阈值120g' END AS total_weight_src,
  CASE WHEN best / c < 120 THEN round(best / c, 6) END AS b_weight,
  CASE WHEN coalesce(best / c < 120, FALSE) OR src IS NULL THEN CASE WHEN total IS NOT NULL THEN 'GPT克重清洗' ELSE src END
    ELSE '超过阈值120g' END AS b_src,
  coalesce(total, own) * c AS c_total, CASE WHEN total IS NULL THEN '机器清洗' ELSE 'annotated' END AS c_src
FROM u
""")
def _(v):
    line = F.col("l_linenumber")
    w = v.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.when(line % 3 != 0, F.col("l_quantity") * 10).alias("total"), F.when(line % 4 != 0, line).alias("n"),
        F.when(line % 2 != 0, F.col("l_quantity")).alias("own"), F.when(line % 5 != 0, "upstream").alias("src"))
    a = M.unit_weight("total", "n", 120)
    b = M.unit_weight_or_upstream("total", "n", "own", F.lit(None).cast("int"), "src", 120)
    c = M.annotated_weight("total", "n", "own", F.lit(1), "annotated")
    return w.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", a["package"].alias("package"),
        F.round(a["weight"], 6).alias("weight"), a["total_weight"].alias("total_weight"),
        a["total_weight_src"].alias("total_weight_src"), F.round(b["weight"], 6).alias("b_weight"),
        b["total_weight_src"].alias("b_src"), c["total_weight"].alias("c_total"), c["total_weight_src"].alias("c_src"))


@R.add("measures", """
SELECT platform, market, item_id, pfsku_id, shop_id, month_dt, pfsku_unit_sales * discount_price AS pfsku_value_sales,
  pfsku_unit_sales * discount_price AS pfsku_discountprice_value_sales,
  pfsku_unit_sales * page_price AS pfsku_pageprice_value_sales, pfsku_unit_sales AS sku_unit_sales,
  pfsku_unit_sales * 2.5e0 AS sku_volume_sales, pfsku_unit_sales * 2 AS sku_pack_sales,
  CASE WHEN sku_num = 1 THEN discount_price / 2 ELSE 0 END AS sku_discount_price_tmp
FROM listing_month
""", ("listing_month",))
def _(v):
    return v.listing_month.select(
        "platform", "market", "item_id", "pfsku_id", "shop_id", "month_dt",
        *[c.alias(n) for n, c in M.sales_measures(total_weight=F.lit(2.5), packages=F.lit(2)).items()])


@R.add("single_part_defaults", """
SELECT platform, market, item_id, pfsku_id, shop_id, month_dt,
  coalesce(CASE WHEN sku_num = 1 THEN discount_price ELSE nullif(page_price, 10) END, 7) AS sku_discount_price_tmp,
  CASE WHEN sku_num = 1 THEN pfsku_unit_sales END AS sku_value_sales,
  CASE WHEN sku_num = 1 THEN 1.0 ELSE 0.25 END AS sku_value_ratio,
  CASE WHEN sku_num = 1 THEN '单品不拆' ELSE brand_name END AS sku_value_ratio_src
FROM listing_month
""", ("listing_month",))
def _(v):
    made = M.single_part_defaults("sku_num", "discount_price", F.nullif(F.col("page_price"), F.lit(10.0)), F.lit(7.0),
                                  "pfsku_unit_sales", F.lit(0.25), "brand_name")
    return v.listing_month.select("platform", "market", "item_id", "pfsku_id", "shop_id", "month_dt",
                                  *[c.alias(n) for n, c in made.items()])
