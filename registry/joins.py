"""Scopes, filters and keyed joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import filters as L, joins as J
from shelfwise.sources.scans import conform, scan_partition, scope_filter
from shelfwise.sources.sinks import affected_partitions
from shelfwise.schemas import schema

from .base import Registry

R = Registry()
QUERIES, ORACLE = R.queries, R.sql
LISTING = ("platform", "market", "item_id", "pfsku_id", "shop_id", "month_dt")
KEYS = ", ".join(LISTING)


def missing_unless(df, condition: str, key: str):
    """Whole tables with keys that other tables lack: the key of rows that do not meet the condition is changed."""
    return df.withColumn(key, F.when(F.expr(condition), F.col(key)).otherwise(F.concat(F.lit("no "), key)))


# Platforms, markets and months that occur as partitions of the listing table.


@R.add("scope_full", f"""
SELECT {KEYS}, pfsku_unit_sales FROM listing_month WHERE month_dt >= '1994-01-01' AND platform = 'Amazon'
""", ("listing_month",))
def _(v):
    rows = scope_filter(v.listing_month, "full", month="1996-01-01", platform="Amazon", market=" all ",
                        start_month="1994-01-01")
    return rows.select(*LISTING, "pfsku_unit_sales")


@R.add("scope_incremental", f"""
SELECT {KEYS}, pfsku_unit_sales FROM listing_month WHERE month_dt = '1995-01-01' AND market = 'cn'
""", ("listing_month",))
def _(v):
    rows = scope_filter(v.listing_month, "incremental", month="1995-01-01", platform="*", market="cn")
    return rows.select(*LISTING, "pfsku_unit_sales")


@R.add("scan_partition", """
SELECT o_orderkey, 'le' AS scan FROM orders WHERE o_orderdate <= TIMESTAMP '1995-06-17 00:00:00'
UNION ALL SELECT o_orderkey, 'between' FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1994-01-01 00:00:00' AND TIMESTAMP '1994-12-31 00:00:00'
UNION ALL SELECT o_orderkey, 'eq' FROM orders WHERE o_orderstatus = 'F'
""")
def _(v):
    from datetime import datetime

    before = scan_partition(v.orders, "o_orderdate", le=datetime(1995, 6, 17))
    year = scan_partition(v.orders, "o_orderdate", between=(datetime(1994, 1, 1), datetime(1994, 12, 31)))
    done = scan_partition(v.orders, "o_orderstatus", eq="F")
    parts = [df.select("o_orderkey", F.lit(n).alias("scan")) for n, df in (
        ("le", before), ("between", year), ("eq", done))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@R.add("affected_partitions", "SELECT DISTINCT platform, month_dt, market FROM listing_month", ("listing_month",))
def _(v):
    return affected_partitions(v.listing_month, ["platform", "month_dt", "market"])


@R.add("conform", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, TRY_CAST(o_orderpriority AS BIGINT) AS priority,
  CAST(NULL AS DOUBLE) AS rebate, o_totalprice AS total, upper(o_orderstatus) AS status FROM orders
""")
def _(v):
    target = schema("order_id string, priority bigint, rebate double, total double, status string")
    return conform(v.orders, target, {
        "order_id": F.col("o_orderkey"), "priority": F.col("o_orderpriority"), "total": F.col("o_totalprice"),
        "status": F.upper("o_orderstatus")})


@R.add("scope_predicate", f"""
SELECT {KEYS} FROM listing_month WHERE pfsku_unit_sales > 60 OR shop_id IN ('1', '2')
  OR item_title IN ('steel gear 7') OR ((shop_id = '3' OR brand_name = 'Brand#2') AND market = 'cn')
""", ("listing_month",))
def _(v):
    rows = L.any_of(
        v.listing_month, F.col("pfsku_unit_sales") > 60, F.col("shop_id").isin("1", "2"),
        F.col("item_title").isin("steel gear 7"),
        ((F.col("shop_id") == "3") | (F.col("brand_name") == "Brand#2")) & (F.col("market") == "cn"))
    return rows.select(*LISTING)


@R.add("range_and_regex_filters", f"""
WITH kept AS (SELECT * FROM listing_month WHERE page_price > 5 AND page_price < 45 AND brand_name <> ''
  AND regexp_matches(lower(category_1), 'steel|brass|o') AND NOT regexp_matches(lower(item_title), 'gear'))
SELECT market, item_id, count(*) AS n FROM kept GROUP BY market, item_id HAVING count(*) > 1
""", ("listing_month",))
def _(v):
    rows = L.require(L.in_open_range(v.listing_month, "page_price", 5, 45), ["brand_name"])
    rows = L.matches(L.matches(rows, "category_1", "steel|brass|o"), "item_title", "gear", negate=True)
    return L.having(rows.groupBy("market", "item_id").agg(F.count(F.lit(1)).alias("n")), F.col("n") > 1)


@R.add("composite_join", f"""
SELECT {KEYS}, sku_no, pfsku_unit_sales, page_price FROM mapping LEFT JOIN (SELECT * REPLACE (CASE WHEN pfsku_unit_sales > 30
  THEN item_id ELSE 'no ' || item_id END AS item_id) FROM (SELECT {KEYS}, pfsku_unit_sales, page_price FROM listing)) USING ({KEYS})
""", ("mapping", "listing"))
def _(v):
    sold = missing_unless(v.listing, "pfsku_unit_sales > 30", "item_id").select(*LISTING, "pfsku_unit_sales", "page_price")
    return J.enrich(v.mapping.select(*LISTING, "sku_no"), sold, LISTING)


@R.add("conditional_key_join", """
WITH prices AS (SELECT lower(platform) AS platform, market, CASE WHEN sku_num > 1 THEN item_id ELSE 'no ' || item_id END AS item_id,
                pfsku_id, shop_id, month_dt, page_price FROM listing_month)
SELECT a.platform, a.market, a.item_id, a.pfsku_id, a.shop_id, a.month_dt, b.page_price AS other_price
FROM listing_month a LEFT JOIN prices b ON lower(a.platform) = b.platform AND a.month_dt = b.month_dt
  AND a.item_id = b.item_id AND a.pfsku_id = b.pfsku_id
  AND (lower(a.platform) <> 'amazon' OR a.market = b.market)
  AND (lower(a.platform) <> 'suning' OR a.shop_id = b.shop_id)
""", ("listing_month",))
def _(v):
    prices = missing_unless(v.stored("listing_month"), "sku_num > 1", "item_id").withColumn("platform", F.lower("platform"))
    return J.listing_join(v.stored("listing_month").select(*LISTING), prices, {"page_price": "other_price"})


@R.add("null_safe_join", """
WITH a AS (SELECT item_id, month_dt, nullif(market, 'cn') AS market, sum(pfsku_unit_sales) AS units
           FROM listing_month GROUP BY ALL),
b AS (SELECT CASE WHEN platform <> 'Tmall' THEN item_id ELSE 'no ' || item_id END AS item_id, month_dt,
      nullif(market, 'cn') AS market, CAST(count(*) AS BIGINT) AS n FROM listing_month GROUP BY ALL)
SELECT a.item_id, a.month_dt, a.market, CAST(units AS BIGINT) AS units, n FROM a LEFT JOIN b ON a.item_id = b.item_id
  AND a.month_dt = b.month_dt AND a.market IS NOT DISTINCT FROM b.market
""", ("listing_month",))
def _(v):
    keys = ["item_id", "month_dt", "market"]
    rows = v.listing_month.withColumn("market", F.nullif(F.col("market"), F.lit("cn")))
    a = rows.groupBy(*keys).agg(F.sum("pfsku_unit_sales").alias("units"))
    b = missing_unless(rows, "platform <> 'Tmall'", "item_id").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return J.null_safe_join(a, b, keys, nullable=["market"])


_GATE = """
gate AS (SELECT category_1, CASE WHEN platform = 'Suning' THEN brand_name ELSE 'no ' || brand_name END AS brand_name,
         min(month_dt) AS start_time, max(month_dt) AS end_time FROM listing_month GROUP BY 1, 2)
"""


@R.add("interval_join", f"""
WITH {_GATE.strip()}
SELECT {', '.join('a.' + k for k in LISTING)}, start_time, end_time FROM listing_month a LEFT JOIN gate g
  ON a.category_1 = g.category_1 AND a.brand_name = g.brand_name AND a.month_dt BETWEEN start_time AND end_time
""", ("listing_month",))
def _(v):
    rows = v.stored("listing_month")
    gate = missing_unless(rows, "platform = 'Suning'", "brand_name").groupBy("category_1", "brand_name").agg(
        F.min("month_dt").alias("start_time"), F.max("month_dt").alias("end_time"))
    return J.interval_join(rows.select(*LISTING, "category_1", "brand_name"), gate, ["category_1", "brand_name"],
                           "month_dt", "start_time", "end_time").select(*LISTING, "start_time", "end_time")


@R.add("override_lookup", f"""
WITH fixed AS (SELECT CASE WHEN sku_num > 1 THEN brand_name ELSE 'no ' || brand_name END AS brand_name,
               'Group ' || upper(max(shop_id)) AS grouped FROM listing_month GROUP BY 1)
SELECT {KEYS}, coalesce(grouped, brand_name) AS brand_name, CASE WHEN grouped IS NOT NULL THEN 'brand_group' END AS brand_src
FROM listing_month LEFT JOIN fixed USING (brand_name)
""", ("listing_month",))
def _(v):
    groups = missing_unless(v.stored("listing_month"), "sku_num > 1", "brand_name").groupBy("brand_name").agg(
        F.concat(F.lit("Group "), F.upper(F.max("shop_id"))).alias("grouped"))
    return J.override(v.stored("listing_month").select(*LISTING, "brand_name"), groups, ["brand_name"],
                      "brand_name", "grouped", "brand_group", "brand_src")


@R.add("expr_key_join", f"""
WITH notes AS (SELECT CASE WHEN platform = 'Amazon' THEN market ELSE lower(platform) END AS place,
    CASE WHEN platform = 'Amazon' THEN pfsku_id ELSE item_id END AS product_id, pfsku_id AS sku_id,
    max(month_dt) AS month_dt, max(brand_name) AS std_brand_name FROM listing_month GROUP BY 1, 2, 3)
SELECT {', '.join('a.' + k for k in LISTING)}, n.std_brand_name AS ai_brand_name FROM listing_month a LEFT JOIN notes n
  ON a.pfsku_id = n.sku_id
  AND (CASE WHEN lower(a.platform) = 'amazon' THEN lower(a.market) ELSE lower(a.platform) END) = n.place
  AND (CASE WHEN lower(a.platform) = 'amazon' THEN a.pfsku_id ELSE a.item_id END) = n.product_id
  AND (lower(a.platform) = 'amazon' OR a.month_dt = n.month_dt)
""", ("listing_month",))
def _(v):
    amazon = F.col("platform") == "Amazon"
    notes = v.stored("listing_month").groupBy(
        F.when(amazon, F.col("market")).otherwise(F.lower("platform")).alias("platform"),
        F.when(amazon, F.col("pfsku_id")).otherwise(F.col("item_id")).alias("product_id"),
        F.col("pfsku_id").alias("sku_id"),
    ).agg(F.max("month_dt").alias("month_dt"), F.max("brand_name").alias("std_brand_name"))
    return J.annotation_join(v.stored("listing_month").select(*LISTING), notes, {"std_brand_name": "ai_brand_name"})


@R.add("scalar_newest", """
WITH s AS (SELECT max(month_dt) AS newest, CAST(count(DISTINCT market) AS BIGINT) AS markets FROM listing_month)
SELECT platform, market, item_id, pfsku_id, shop_id, newest, markets FROM listing_month, s WHERE month_dt = newest
""", ("listing_month",))
def _(v):
    listings = v.stored("listing_month")
    newest = {"newest": F.max("month_dt"), "markets": F.count_distinct("market")}
    return J.with_scalar(listings, listings, newest).filter("month_dt = newest").select(
        "platform", "market", "item_id", "pfsku_id", "shop_id", "newest", "markets")


@R.add("lagged_self_join", """
WITH w AS (SELECT product_id, next_week_dt, comments_number FROM weekly_reviews)
SELECT a.product_id, a.next_week_dt, a.comments_number, b.comments_number AS comments_number_prev1,
  c.comments_number AS comments_number_prev2
FROM w a LEFT JOIN w b ON a.product_id = b.product_id
    AND b.next_week_dt = CAST(CAST(CAST(a.next_week_dt AS DATE) - INTERVAL 7 DAY AS DATE) AS VARCHAR)
  LEFT JOIN w c ON a.product_id = c.product_id
    AND c.next_week_dt = CAST(CAST(CAST(a.next_week_dt AS DATE) - INTERVAL 14 DAY AS DATE) AS VARCHAR)
""", ("weekly_reviews",))
def _(v):
    rows = v.stored("weekly_reviews").select("product_id", "next_week_dt", "comments_number")
    return J.lag_periods(rows, rows, "product_id", "next_week_dt", ["comments_number"], [1, 2])


@R.add("week_offsets", """
WITH d AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders)
SELECT day, CAST(CAST(CAST(day AS DATE) - INTERVAL 14 DAY AS DATE) AS VARCHAR) AS dashed,
  strftime(CAST(day AS DATE) - INTERVAL 21 DAY, '%Y%m%d') AS packed FROM d
""")
def _(v):
    days = v.orders.select(F.to_date("o_orderdate").cast("string").alias("day")).distinct()
    return days.select("day", J.period_before("day", 2).alias("dashed"),
                       J.period_before(F.replace("day", F.lit("-"), F.lit("")), 3).alias("packed"))
