"""Inputs of the registered queries: plain SQL views over the test tables, the same text for both engines.

``{name}`` stands for a table or another view; literal braces are doubled. Every view reads whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

_SNAPSHOT = """
SELECT CAST(l_partkey % 20 AS STRING) AS sku_id,
       CASE WHEN l_linenumber % 3 = 0 THEN '' WHEN l_linenumber % 5 = 0 THEN NULL
            ELSE 'P' || CAST(l_suppkey % 7 AS STRING) END AS product_id,
       r_name AS region,
       CAST(CAST(date_trunc('{period}', l_shipdate) AS DATE) AS STRING) AS dt,
       CAST(CAST(l_shipdate AS DATE) AS STRING) || ' ' || lpad(CAST(l_orderkey % 24 AS STRING), 2, '0') || ':00:00'
           AS snapshot_time,
       CASE l_returnflag WHEN 'A' THEN 'feed_a' WHEN 'N' THEN 'feed_n' ELSE 'feed_r' END AS etl_source,
       CASE WHEN l_linestatus = 'F' THEN p_name ELSE '' END AS product_title,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS brand,
       CASE WHEN l_linenumber % 2 = 0 THEN p_type ELSE NULL END AS category,
       CASE WHEN l_linenumber % 2 = 0 THEN p_type || '>' || p_brand || '>' || p_name ELSE p_type END AS sub_category,
       CASE WHEN l_discount = 0 THEN 0.0E0 ELSE CAST(p_size * 10 - l_linenumber AS DOUBLE) END AS sku_online_price,
       CASE WHEN l_tax = 0 THEN NULL ELSE CAST(p_size * 10 AS DOUBLE) END AS sku_list_price,
       CASE WHEN l_returnflag = 'N' THEN '' ELSE 'USD' END AS sku_online_price_currency,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'EUR' END AS sku_list_price_currency
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey
JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
"""

VIEWS = {
    # Crawled SKU facts; the month stands in for the day, so that keys have several rows.
    "sku_snapshot": _SNAPSHOT.format(period="month"),
    # The same facts by real day.
    "sku_day": _SNAPSHOT.format(period="day"),
    # Monthly listings; the quarter stands in for the month.
    "listing_month": """
SELECT platform, market, item_id, pfsku_id, shop_id, month_dt,
       min(p_brand) AS brand_name, min(p_name) AS item_title, min(p_type) AS category_1,
       CAST(sum(l_quantity) AS BIGINT) AS pfsku_unit_sales,
       CAST(max(p_size) AS DOUBLE) AS page_price, CAST(min(p_size) AS DOUBLE) AS discount_price,
       CAST(count(DISTINCT l_linenumber) AS BIGINT) AS sku_num
FROM (
  SELECT CASE l_suppkey % 3 WHEN 0 THEN 'Amazon' WHEN 1 THEN 'Suning' ELSE 'Tmall' END AS platform,
         CASE WHEN l_suppkey % 3 = 0 THEN lower(r_name) ELSE 'cn' END AS market,
         CAST(l_partkey % 50 AS STRING) AS item_id,
         CAST((l_partkey % 50) * 10 + l_linenumber % 3 AS STRING) AS pfsku_id,
         CAST(l_suppkey % 4 AS STRING) AS shop_id,
         CAST(CAST(date_trunc('quarter', l_shipdate) AS DATE) AS STRING) AS month_dt,
         p_brand, p_name, p_type, p_size, l_quantity, l_linenumber
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
  JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey) t
GROUP BY platform, market, item_id, pfsku_id, shop_id, month_dt
""",
    # Weekly review counts. Two of seven users are listed anew from 29 January on, under another product id, so
    # that products without history occur; no event is left out.
    "weekly_reviews": """
SELECT sku_id, sku_id AS product_id, category_id, CAST(NULL AS STRING) AS category_name, next_week_dt,
       CAST(sum(reviews) AS BIGINT) AS comments_number, comments_score,
       CAST(max(ts) AS STRING) AS snapshot_time, next_week_dt AS dt
FROM (
  SELECT CAST(user_id AS STRING) || CASE WHEN user_id % 7 IN (0, 3) AND ts < TIMESTAMP '2024-01-29 00:00:00'
                                         THEN '-old' ELSE '' END AS sku_id,
         CASE user_id % 18 WHEN 0 THEN '31389' WHEN 1 THEN '17410' WHEN 2 THEN '12347' WHEN 3 THEN '862'
              WHEN 4 THEN '842' WHEN 5 THEN '12597' WHEN 6 THEN '12352' WHEN 7 THEN '863' WHEN 8 THEN '12348'
              WHEN 9 THEN '39284' WHEN 10 THEN '16961' WHEN 11 THEN '17413' WHEN 12 THEN '38678'
              WHEN 13 THEN '12350' WHEN 14 THEN '43533' WHEN 15 THEN '12417' ELSE 'other' END AS category_id,
         CAST(CAST(date_trunc('week', ts) AS DATE) AS STRING) AS next_week_dt,
         CAST(user_id % 6 AS DOUBLE) AS comments_score, date_trunc('second', ts) AS ts,
         CASE WHEN event_type <> 'purchase' THEN 0
              WHEN user_id % 8 = 1 AND ts >= TIMESTAMP '2024-01-08 00:00:00' THEN 0
              WHEN user_id % 8 = 2 AND ts >= TIMESTAMP '2024-01-15 00:00:00' THEN 0
              WHEN user_id % 8 = 3 AND ts >= TIMESTAMP '2024-01-22 00:00:00' THEN 0
              WHEN user_id % 8 = 4 AND ts >= TIMESTAMP '2024-01-29 00:00:00' THEN 0
              WHEN user_id % 10 = 0 THEN 120 ELSE 1 END AS reviews
  FROM {events}) e
GROUP BY sku_id, category_id, next_week_dt, comments_score
""",
    # Sales-count texts in four shapes, and one without a number.
    "sales_text": """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'JP' ELSE 'us' END AS region,
       CASE event_id % 5
            WHEN 0 THEN '過去1か月で' || CAST(user_id AS STRING) ||
                 CASE WHEN event_id % 10 = 0 THEN '万点以上購入' ELSE '点以上購入' END
            WHEN 1 THEN CAST(user_id AS STRING) || 'K+ bought in past month'
            WHEN 2 THEN CAST(user_id AS STRING) || ' mil comprados'
            WHEN 3 THEN CAST(user_id AS STRING) || CASE WHEN event_id % 2 = 0 THEN '+ gekauft' ELSE 'w' END
            ELSE 'none' END AS sell_count_str
FROM {events}
""",
    # Blank, empty, invalid and valid JSON; one key with a pipe.
    "crawl_json": """
SELECT event_id, CAST(user_id % 40 AS STRING) AS sku_id, event_type AS etl_source,
       CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN '{{}}' WHEN 2 THEN 'not json'
            WHEN 3 THEN '{{"site|region":"' || event_type || '","k":' || CAST(event_id % 9 AS STRING) || '}}'
            WHEN 4 THEN props
            ELSE '{{"d":"' || event_type || '","k":' || CAST(user_id % 9 AS STRING) || '}}' END AS extra_json,
       CAST(date_trunc('second', ts) AS STRING) AS snapshot_time
FROM {events}
""",
    # Hosts with one- and two-label suffixes, and URLs that have to be rewritten.
    "site_url": """
SELECT page_id, 'https://www.shop.' || CASE page_id % 5 WHEN 0 THEN 'com' WHEN 1 THEN 'de' WHEN 2 THEN 'co.jp'
            WHEN 3 THEN 'com.au' ELSE 'es' END
       || '/dp/' || CASE WHEN page_id % 2 = 0 THEN 'MC_Assembly_1#' ELSE '' END || CAST(page_id AS STRING) AS url,
       CASE WHEN page_id % 4 = 0 THEN 'fr' WHEN page_id % 4 = 1 THEN '' END AS json_region
FROM {pages}
""",
    # Parts of orders: one third liquid, one third brush, one third other.
    "bundle_part": """
SELECT 'Tmall' AS platform, CAST(l_orderkey AS STRING) AS item_id, CAST(l_orderkey % 3 AS STRING) AS pfsku_id,
       '2024-01-01' AS month_dt,
       CAST(row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INT) AS sku_no,
       CASE WHEN l_orderkey % 7 = 0 THEN '杀虫气雾剂' ELSE '家居' END AS std_category_2,
       CASE l_orderkey % 3 WHEN 0 THEN '电热蚊香液' WHEN 1 THEN '一次性马桶刷'
            ELSE CASE WHEN l_orderkey % 2 = 0 THEN p_type ELSE '地板清洁' END END AS std_category_3,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'B' || CAST(l_orderkey % 4 AS STRING) END AS std_brand_name,
       CASE l_orderkey % 3
            WHEN 0 THEN CASE WHEN l_linenumber % 3 = 0 THEN '液加热器'
                             ELSE '驱蚊液' || CAST(p_size AS STRING) || 'ml装' END
            WHEN 1 THEN CASE WHEN l_linenumber % 3 = 0 THEN '刷杆' ELSE '马桶刷' END
            ELSE p_name END AS std_spu_name,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS weight,
       CAST(l_quantity AS INT) AS package_num
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
""",
    # Rows of the three crawl feeds; JSON keys carry a prefix and a pipe.
    "crawl_rows": """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS STRING) AS code, p_name AS title,
       'https://www.shop.' || CASE l_suppkey % 4 WHEN 0 THEN 'com' WHEN 1 THEN 'de' WHEN 2 THEN 'co.jp' ELSE 'es' END
           || '/dp/' || CAST(l_partkey AS STRING) AS url,
       p_type AS category, p_type || '>' || p_brand AS sub_category, p_brand AS brand,
       CAST(l_orderkey AS STRING) AS batch_id, l_linestatus AS crawl_status,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS dt,
       CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 00:00:00' AS snapshot_time,
       CASE WHEN l_discount = 0 THEN '0' WHEN l_tax = 0 THEN '' ELSE CAST(p_size AS STRING) END AS price,
       CASE WHEN l_tax = 0 THEN '0' ELSE CAST(p_size * 2 AS STRING) END AS list_price,
       CASE WHEN l_returnflag = 'R' THEN 'YES' WHEN l_returnflag = 'A' THEN 'NO' ELSE '' END AS has_variants,
       CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE 'a' || CAST(l_linenumber AS STRING) || ' | b' END AS images_1,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 2 = 0
            THEN 'a' || CAST(l_linenumber AS STRING) || ' | b' ELSE 'c' END AS images_2,
       CASE WHEN l_linenumber % 5 = 0 THEN '0' ELSE CAST(l_linenumber AS STRING) END AS reviews,
       '{{"site|region":"' || CASE l_orderkey % 3 WHEN 0 THEN 'jp' WHEN 1 THEN 'US' ELSE '' END
           || '","site|online_price":"' || CASE WHEN l_discount = 0 THEN '0' ELSE CAST(p_size AS STRING) END
           || '","site|list_price":"' || CAST(p_size * 2 AS STRING)
           || '","site|online_price_currency":"' || CASE WHEN l_returnflag = 'N' THEN '' ELSE 'USD' END
           || '","site|sales_count":"' || CASE l_orderkey % 3 WHEN 0 THEN '過去1か月で' ELSE '' END
           || CAST(l_linenumber * 100 AS STRING)
           || CASE l_orderkey % 3 WHEN 0 THEN '点以上購入' ELSE '+ bought' END
           || '","site|seller":"S' || CAST(l_suppkey AS STRING)
           || '","site|expected_delivery_time":"' || CASE WHEN l_linenumber % 2 = 0 THEN 'soon' ELSE '' END
           || '"}}' AS sr
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
""",
    # Rows of the platform feeds with every column that any adapter reads.
    "platform_rows": """
SELECT CASE l_suppkey % 10 WHEN 0 THEN 'Tmall' WHEN 1 THEN 'Amazon' WHEN 2 THEN 'JD' WHEN 3 THEN 'PDD'
            WHEN 4 THEN 'Suning' WHEN 5 THEN 'Taobao' WHEN 6 THEN 'VIP' WHEN 7 THEN 'Douyin' WHEN 8 THEN 'Kaola'
            ELSE 'Kuaishou' END AS feed,
       CAST(l_partkey AS STRING) AS item_id, CAST(l_partkey * 10 + l_linenumber AS STRING) AS pfsku_id,
       p_name AS item_title, p_name || ' ' || p_brand AS pfsku_title,
       'c1' || p_type AS category_1, 'c2' || p_type AS category_2, 'c3' || p_type AS category_3,
       'c4' || p_type AS category_4, 'c5' || p_type AS category_5, 'c6' || p_type AS category_6,
       'n1' || p_type AS category_1_name, 'n2' || p_type AS category_2_name, 'n3' || p_type AS category_3_name,
       'n4' || p_type AS category_4_name,
       CAST(p_size AS BIGINT) AS category_1_id, CAST(p_size + 1 AS BIGINT) AS category_2_id,
       CAST(p_size + 2 AS BIGINT) AS category_3_id, CAST(p_size + 3 AS BIGINT) AS category_4_id,
       CAST(p_size + 4 AS BIGINT) AS category_5_id, CAST(p_size + 5 AS BIGINT) AS category_6_id,
       CAST(p_size + 9 AS BIGINT) AS category_id, p_type AS category_name, 'x>' || p_type AS categories,
       l_suppkey AS shop_id, l_suppkey + 1 AS store_id, 'shop ' || CAST(l_suppkey AS STRING) AS shop_name,
       'self' AS store_type, 'flag' AS shop_type, CAST(p_size AS BIGINT) AS brand_id, p_brand AS brand_name,
       'maker ' || p_brand AS manufacturer, 'props' AS properties, 'su' AS shop_url, 'iu' AS item_url,
       'pu' AS pfsku_url, 'ii' AS item_image, 'iis' AS item_images, 'pi' AS pfsku_image, 'rr' AS recommend_remark,
       'tags' AS tags, 'info' AS basic_info, 'tcn' AS pfsku_title_cn, 'sc' AS sub_category, 'sccn' AS sub_category_cn,
       'k1' AS category_1_cn, 'k2' AS category_2_cn, 'k3' AS category_3_cn, 'k4' AS category_4_cn,
       'k5' AS category_5_cn, 'k6' AS category_6_cn,
       CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS STRING) AS month_dt,
       CASE WHEN l_linenumber % 2 = 0 THEN 'us' ELSE 'de' END AS market,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS pfsku_unit_sales,
       l_extendedprice AS page_price, l_extendedprice * 0.5 AS discount_price
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
""",
    # Listings at the grain that the keyed joins use: the shop counts on one platform only.
    "listing": """
SELECT platform, market, item_id, pfsku_id, CASE WHEN platform = 'Suning' THEN shop_id ELSE '9' END AS shop_id, month_dt,
       CAST(sum(pfsku_unit_sales) AS BIGINT) AS pfsku_unit_sales, max(page_price) AS page_price,
       min(discount_price) AS discount_price, min(brand_name) AS brand_name, min(item_title) AS item_title,
       min(category_1) AS category_1
FROM {listing_month}
GROUP BY platform, market, item_id, pfsku_id, CASE WHEN platform = 'Suning' THEN shop_id ELSE '9' END, month_dt
""",
    # Mapping of listings: one row per part; every fourth item is a bundle of up to three parts.
    "mapping": """
SELECT platform, market, item_id, pfsku_id, shop_id, month_dt, sku_no,
       min(p_brand) AS brand_name, min(p_name) AS item_title, min(p_type) AS category_1,
       CAST(CASE WHEN CAST(item_id AS INT) % 4 = 0 THEN 3 ELSE 1 END AS INT) AS sku_num,
       min(p_type) || '-' || CAST(sku_no AS STRING) AS std_sku_name,
       CASE WHEN CAST(item_id AS INT) % 5 = 0 THEN NULL ELSE min(p_brand) END AS std_brand_name,
       CAST(CAST(item_id AS INT) % 3 + 1 AS INT) AS package, CAST(CAST(item_id AS INT) % 7 AS DOUBLE) AS weight,
       CAST((CAST(item_id AS INT) % 3 + 1) * (CAST(item_id AS INT) % 7) AS DOUBLE) AS total_weight,
       CAST(0.5E0 AS DOUBLE) AS sku_value_ratio, 'rule' AS sku_value_ratio_src,
       'https://www.shop.com/dp/MC_Assembly_1#' || pfsku_id AS pfsku_url
FROM (
  SELECT CASE l_suppkey % 3 WHEN 0 THEN 'Amazon' WHEN 1 THEN 'Suning' ELSE 'Tmall' END AS platform,
         CASE WHEN l_suppkey % 3 = 0 THEN lower(r_name) ELSE 'cn' END AS market,
         CAST(l_partkey % 50 AS STRING) AS item_id,
         CAST((l_partkey % 50) * 10 + l_linenumber % 3 AS STRING) AS pfsku_id,
         CASE WHEN l_suppkey % 3 = 1 THEN CAST(l_suppkey % 4 AS STRING) ELSE '9' END AS shop_id,
         CAST(CAST(date_trunc('quarter', l_shipdate) AS DATE) AS STRING) AS month_dt,
         CAST(CASE WHEN l_partkey % 50 % 4 = 0 THEN CAST(l_quantity AS BIGINT) % 3 + 1 ELSE 1 END AS INT) AS sku_no,
         p_brand, p_name, p_type
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
  JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey) t
GROUP BY platform, market, item_id, pfsku_id, shop_id, month_dt, sku_no
""",
    # Listings with texts, sales and annotated brands, from documents.
    "annotated": """
SELECT CASE WHEN doc_id % 2 = 0 THEN 'Tmall' ELSE 'JD' END AS platform, CAST(doc_id AS STRING) AS item_id,
       CAST(doc_id * 2 + m AS STRING) AS pfsku_id,
       '2025-0' || CAST(7 + m AS STRING) || '-01' AS month_dt,
       text AS item_title, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN m = 2 THEN source ELSE lang END AS pfsku_title,
       source AS shop_name, CAST(doc_id % 10 AS STRING) AS shop_id,
       CASE WHEN doc_id % 9 = 0 THEN 'MAKER' ELSE '' END AS manufacturer,
       CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '其他品牌' ELSE source END AS brand_name,
       CASE doc_id % 4 WHEN 0 THEN 'The' WHEN 1 THEN 'Zzyzx 品牌' WHEN 2 THEN lang ELSE '雷达' END AS std_brand_name,
       lang AS std_category_1, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE source END AS std_category_2,
       CASE WHEN doc_id % 2 = 0 THEN 'x' ELSE 'y' END AS std_category_3,
       CAST(n_chars % 50 AS DOUBLE) AS pfsku_value_sales
FROM (SELECT *, 0 AS m FROM {documents} UNION ALL SELECT *, 1 AS m FROM {documents}
      UNION ALL SELECT *, 2 AS m FROM {documents}) d
""",
}


def _names(sql: str) -> set[str]:
    return set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    return spark.sql(sql, **{n: view(spark, sf_dir, n) for n in _names(sql)})


def oracle(body: str, *names: str) -> str:
    """``body`` behind the definitions of the views it uses."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for inner in sorted(_names(VIEWS[name])):
            visit(inner)
        ordered.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in ordered:
        sql = VIEWS[name]
        for inner in _names(sql):
            sql = sql.replace("{" + inner + "}", inner)
        parts.append(f"{name} AS ({sql.replace('{{', '{').replace('}}', '}')})")
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
