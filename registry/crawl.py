"""Crawl snapshots: SKU fact, best values, prices, dimension, translation candidates, parsing of crawled strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions.crawl import parse_sales_suffix, parse_sales_text, region_of, sales_type
from shelfwise.functions.jsons import json_build, json_build_if_any, json_field
from shelfwise.operators.collapse import merge_json
from shelfwise.operators.prices import mode_low, valid_min
from shelfwise.operators.quality import run_checks
from shelfwise.plans import crawl as P
from shelfwise.sources.checkpoints import scratch_path
from shelfwise.sources.scans import resolve_month_range

from .base import Registry

R = Registry()
QUERIES, ORACLE = R.queries, R.sql

DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


def typed_nulls(schema, given) -> str:
    """The columns of ``schema`` that are not ``given``, as typed NULLs."""
    return ", ".join(
        f"CAST(NULL AS {DUCK_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in schema.fields if f.name not in given)


# --- best value per field -------------------------------------------------------------------------------------
DAILY = ("product_id", "product_title", "brand", "category", "sub_category", "snapshot_time")


def _best(field: str, order: str, lead: str | None = None, blank: str = "''") -> str:
    lead = lead or field
    return (f"first_value({field}) OVER (PARTITION BY {{keys}} ORDER BY coalesce(CAST({lead} AS VARCHAR), '') NOT IN ({blank}) DESC, "
            f"{order}, {lead} DESC NULLS LAST, {field} DESC NULLS LAST) AS {field}")


_DAILY_ORDER = ("CASE etl_source WHEN 'feed_a' THEN 1 WHEN 'feed_r' THEN 2 ELSE 3 END, "
                "snapshot_time DESC NULLS LAST, length(product_title) NULLS FIRST")


@R.add("sku_daily_best_fields", f"""
WITH best AS (
  SELECT sku_id, region, dt, {', '.join(_best(f, _DAILY_ORDER) for f in DAILY).replace('{keys}', 'sku_id, region, dt')}
  FROM sku_snapshot WHERE sku_id <> '' AND region <> '')
SELECT DISTINCT *, {typed_nulls(S.SKU_DAILY, ("sku_id", "region", "dt", *DAILY))} FROM best
""", ("sku_snapshot",))
def _(v):
    return P.sku_daily(v.sku_snapshot, ["feed_a", "feed_r"], DAILY)


_JSON_ORDER = "CASE etl_source WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END, snapshot_time DESC NULLS LAST"
# Best JSON value per key, rebuilt in key order; rows that are not JSON objects do not count.
_MERGE = """
objects AS (SELECT *, json(CASE WHEN json_valid(extra_json) AND extra_json LIKE '{{%' THEN extra_json END) AS j
            FROM crawl_json),
pairs AS (SELECT {keys}, {rank}, k, json_extract(j, '$."' || k || '"') AS val
          FROM (SELECT *, unnest(json_keys(j)) AS k FROM objects WHERE j IS NOT NULL)),
winners AS (SELECT {keys}, k, first(val ORDER BY {order}, val::VARCHAR DESC) AS val FROM pairs GROUP BY {keys}, k),
merged AS (SELECT {keys}, '{{' || string_agg(to_json(k)::VARCHAR || ':' || val::VARCHAR, ',' ORDER BY k) || '}}' AS m
           FROM winners GROUP BY {keys})
"""


@R.add("sku_daily_json", f"""
WITH {_MERGE.format(keys='sku_id', rank='etl_source, snapshot_time', order=_JSON_ORDER).strip()},
best AS (
  SELECT sku_id,
    first_value(extra_json) OVER (PARTITION BY sku_id ORDER BY coalesce(extra_json, '') NOT IN ('', '{{}}') DESC,
      {_JSON_ORDER}, extra_json DESC NULLS LAST) AS extra_json,
    first_value(snapshot_time) OVER (PARTITION BY sku_id ORDER BY {_JSON_ORDER}) AS snapshot_time
  FROM crawl_json)
SELECT DISTINCT sku_id, 'US' AS region, '2024-01-01' AS dt, coalesce(m, nullif(extra_json, '{{}}')) AS extra_json,
  snapshot_time, {typed_nulls(S.SKU_DAILY, ("sku_id", "region", "dt", "extra_json", "snapshot_time"))}
FROM best LEFT JOIN merged USING (sku_id)
""", ("crawl_json",))
def _(v):
    rows = v.stored("crawl_json").withColumns({
        "region": F.lit("US"), "dt": F.lit("2024-01-01"), "product_title": F.lit(None).cast("string")})
    return P.sku_daily(rows, ["purchase", "click"], ["extra_json", "snapshot_time"])


@R.add("json_merge_best", f"""
WITH {_MERGE.format(keys='sku_id, etl_source', rank='snapshot_time, event_id',
                    order='snapshot_time DESC, event_id DESC').strip()}
SELECT DISTINCT sku_id, etl_source, m AS extra_json FROM crawl_json LEFT JOIN merged USING (sku_id, etl_source)
""", ("crawl_json",))
def _(v):
    return merge_json(v.crawl_json, ["sku_id", "etl_source"], "extra_json", [F.col("snapshot_time"), F.col("event_id")])


_DIM_FIELDS = ("product_id", "product_title", "brand", "category", "etl_source")


def _dimension(table: str, fields) -> str:
    """SQL of the dimension over daily rows."""
    given = ("sku_id", "region", *fields, "sub_category", "first_snapshot_dt", "last_snapshot_time",
             "category_name", *[f"category_{i}_name" for i in range(1, 10)])
    latest = "snapshot_time DESC NULLS LAST"
    best = [_best(f, latest, blank="'', '{}'" if f == "extra_json" else "''") for f in fields]
    best.append(_best("sub_category", latest, "category"))
    # _best leaves the keys open; braces of its blank texts are kept.
    listed = ", ".join(best).replace("{keys}", "sku_id, region")
    return f"""
best AS (
  SELECT DISTINCT sku_id, region, {listed},
    min(dt) OVER (PARTITION BY sku_id, region) AS first_snapshot_dt,
    max(snapshot_time) OVER (PARTITION BY sku_id, region) AS last_snapshot_time
  FROM {table} WHERE sku_id <> '' AND region <> ''),
split AS (SELECT *, string_split(nullif(sub_category, ''), '>') AS s FROM best)
SELECT sku_id, region, {', '.join(fields)}, sub_category, first_snapshot_dt, last_snapshot_time,
  s[-1] AS category_name, category AS category_1_name,
  {', '.join(f's[{i + 1}] AS category_{i + 2}_name' for i in range(8))},
  {typed_nulls(S.SKU_DIM, given)}
FROM split
"""


@R.add("sku_dimension", "WITH " + _dimension("sku_snapshot", _DIM_FIELDS).strip(), ("sku_snapshot",))
def _(v):
    return P.sku_dimension(v.sku_snapshot)


@R.add("sku_dimension_incremental", "WITH " + _dimension("sku_snapshot", _DIM_FIELDS).strip(), ("sku_snapshot",))
def _(v):
    """The same dimension from a stored state to which the days are added in three parts, the last one twice."""
    rows, path = v.stored("sku_snapshot"), scratch_path(v.spark, "dimension-state")
    for part in (1, 0, 2, 2):
        P.add_day(path, rows.filter(F.crc32(F.col("dt").cast("binary")) % 3 == part))
    return P.dimension_from_state(v.spark, path)


# --- prices ---------------------------------------------------------------------------------------------------
def _at_min(price: str, attr: str, then: str) -> str:
    return (f"first({attr} ORDER BY CASE WHEN {price} > 0 THEN {price} END NULLS LAST, {then}, "
            f"{attr} DESC NULLS LAST)")


_LATEST = "snapshot_time DESC"


@R.add("price_daily", f"""
SELECT sku_id, region, dt,
  {_at_min('sku_online_price', 'product_id', _LATEST)} AS product_id,
  min(sku_online_price) FILTER (sku_online_price > 0) AS sku_online_price,
  {_at_min('sku_online_price', 'sku_online_price_currency',
           "coalesce(sku_online_price_currency, '') <> '' DESC, " + _LATEST)} AS sku_online_price_currency,
  min(sku_list_price) FILTER (sku_list_price > 0) AS sku_list_price,
  {_at_min('sku_list_price', 'sku_list_price_currency',
           "coalesce(sku_list_price_currency, '') <> '' DESC, " + _LATEST)} AS sku_list_price_currency,
  '{{"sku_online_price":"' || {_at_min('sku_online_price', 'etl_source', _LATEST)} || '","sku_list_price":"' ||
  {_at_min('sku_list_price', 'etl_source', _LATEST)} || '"}}' AS price_info
FROM sku_snapshot GROUP BY sku_id, region, dt
HAVING bool_or(sku_online_price IS NOT NULL OR sku_list_price IS NOT NULL)
""", ("sku_snapshot",))
def _(v):
    return P.price_daily(v.sku_snapshot)


def _monthly_sql(source: str) -> str:
    stats = []
    for p in ("sku_list_price", "sku_online_price"):
        stats.append(f"""
    min({p}) FILTER ({p} > 0) AS {p}, min({p}) FILTER ({p} > 0) AS {p}_min, max({p}) FILTER ({p} > 0) AS {p}_max,
    sum({p}) FILTER ({p} > 0) / nullif(count(*) FILTER ({p} > 0), 0) AS {p}_avg,
    {_at_min(p, p + '_currency', f"coalesce({p}_currency, '') <> '' DESC, dt DESC")} AS {p}_currency,
    CAST(NULL AS DOUBLE) AS {p}_midrange""")
    modes = ", ".join(f"""
  {p}_modes AS (SELECT sku_id, region, month_dt, first({p} ORDER BY n DESC, {p}) AS {p}_mode
    FROM (SELECT sku_id, region, month_dt, {p}, count(*) AS n FROM rows WHERE {p} > 0 GROUP BY ALL)
    GROUP BY sku_id, region, month_dt)""" for p in ("sku_list_price", "sku_online_price"))
    return f"""
WITH rows AS (SELECT *, strftime(CAST(dt AS DATE), '%Y-%m-01') AS month_dt FROM {source}
              WHERE sku_online_price IS NOT NULL OR sku_list_price IS NOT NULL),
  cheapest AS (SELECT *, min(sku_list_price) FILTER (sku_list_price > 0)
               OVER (PARTITION BY sku_id, region, month_dt) AS low FROM rows),
  {modes},
  stats AS (SELECT sku_id, region, month_dt,
    first(product_id ORDER BY CASE WHEN sku_list_price = low AND coalesce(product_id, '') <> '' THEN 0
                                   WHEN coalesce(product_id, '') <> '' THEN 1 ELSE 2 END,
                              dt DESC, product_id DESC NULLS LAST) AS product_id,
    {', '.join(stats)} FROM cheapest GROUP BY sku_id, region, month_dt)
SELECT * FROM stats LEFT JOIN sku_list_price_modes USING (sku_id, region, month_dt)
  LEFT JOIN sku_online_price_modes USING (sku_id, region, month_dt)"""


@R.add("price_monthly", _monthly_sql("sku_snapshot"), ("sku_snapshot",))
def _(v):
    return P.price_monthly(v.sku_snapshot)


@R.add("price_monthly_from_daily", """
WITH daily AS (
  SELECT sku_id, region, dt, min(sku_online_price) FILTER (sku_online_price > 0) AS online,
         min(sku_list_price) FILTER (sku_list_price > 0) AS listed
  FROM sku_day GROUP BY sku_id, region, dt)
SELECT sku_id, region, strftime(CAST(dt AS DATE), '%Y-%m-01') AS month_dt, min(online) AS sku_online_price,
  max(online) AS sku_online_price_max, min(listed) AS sku_list_price, max(listed) AS sku_list_price_max,
  sum(listed) / nullif(count(listed), 0) AS sku_list_price_avg
FROM daily WHERE online IS NOT NULL OR listed IS NOT NULL GROUP BY ALL
""", ("sku_day",))
def _(v):
    return P.price_monthly(P.price_daily(v.sku_day)).select(
        "sku_id", "region", "month_dt", "sku_online_price", "sku_online_price_max", "sku_list_price",
        "sku_list_price_max", "sku_list_price_avg")


@R.add("price_mode", """
WITH counted AS (
  SELECT sku_id, region, sku_list_price AS p, 0 AS kind, count(*) AS n FROM sku_snapshot WHERE sku_list_price > 0
  GROUP BY ALL
  UNION ALL
  SELECT sku_id, region, sku_online_price, 1, count(*) FROM sku_snapshot WHERE sku_online_price > 0 GROUP BY ALL)
SELECT sku_id, region, first(p ORDER BY n DESC, p) FILTER (kind = 0) AS sku_list_price_mode,
  first(p ORDER BY n DESC, p) FILTER (kind = 1) AS sku_online_price_mode
FROM counted GROUP BY sku_id, region
""", ("sku_snapshot",))
def _(v):
    return mode_low(v.sku_snapshot, ["sku_id", "region"], ["sku_list_price", "sku_online_price"])


@R.add("price_valid_min", """
SELECT sku_id, region, min(sku_list_price) FILTER (sku_list_price > 0) AS sku_list_price,
  min(sku_online_price) FILTER (sku_online_price > 0) AS sku_online_price
FROM sku_snapshot WHERE sku_list_price IS NOT NULL OR sku_online_price IS NOT NULL GROUP BY sku_id, region
""", ("sku_snapshot",))
def _(v):
    return valid_min(v.sku_snapshot, ["sku_id", "region"], ["sku_list_price", "sku_online_price"])


@R.add("month_ranges", """
WITH days AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_dt FROM orders),
overrides AS (
  SELECT strftime(o_orderdate, '%Y-%m-01') AS month_dt, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS start_dt,
         CASE WHEN strftime(o_orderdate, '%m') = '06' THEN '' ELSE strftime(o_orderdate, '%Y-%m-15') END AS end_dt
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL),
ranges AS (SELECT run_dt, strftime(date_trunc('month', CAST(run_dt AS DATE)) - INTERVAL 1 MONTH, '%Y-%m-%d') AS month_dt
           FROM days)
SELECT run_dt, month_dt,
  CASE WHEN start_dt <> '' AND end_dt <> '' THEN start_dt ELSE month_dt END AS start_dt,
  CASE WHEN start_dt <> '' AND end_dt <> '' THEN end_dt
       ELSE CAST(last_day(CAST(month_dt AS DATE)) AS VARCHAR) END AS end_dt
FROM ranges LEFT JOIN overrides USING (month_dt)
""")
def _(v):
    day = F.to_date("o_orderdate")
    month = F.date_format(day, "yyyy-MM-01")
    overrides = v.orders.filter("o_orderpriority = '1-URGENT'").groupBy(month.alias("month_dt")).agg(
        F.min(day).cast("string").alias("start_dt")).withColumn(
        "end_dt", F.when(F.substring("month_dt", 6, 2) == "06", "").otherwise(
            F.concat(F.substring("month_dt", 1, 8), F.lit("15"))))
    return resolve_month_range(v.orders.select(day.cast("string").alias("run_dt")).distinct(), overrides)


_VALID = "CASE WHEN {0} > 0 THEN {0} END"
_STATS = ("min", "max", "avg", "mode")
_LIST, _ONLINE = "sku_list_price", "sku_online_price"


def _derived(price: str, short: str) -> str:
    """Statistics of the valid daily prices of a key and month, with the lowest of the most frequent prices."""
    return f"""
{short}_counts AS (SELECT sku_id, region, dt, {price} AS x, count(*) AS n FROM sku_snapshot WHERE {price} > 0 GROUP BY ALL),
{short}_stats AS (SELECT sku_id, region, dt, min(x) AS {short}_min, max(x) AS {short}_max, sum(x * n) / sum(n) AS {short}_avg,
  first(x ORDER BY n DESC, x) AS {short}_mode FROM {short}_counts GROUP BY ALL)"""


def _apart(a: str, b: str) -> str:
    return f"coalesce(abs({a} - {b}) >= 0.001, ({a} IS NULL) <> ({b} IS NULL))"


# What the damage does to the monthly table, by the hash of the key: the same text for both engines.
_DAMAGE = {
    "drop": "h % 11 = 0", "double": "h % 11 = 1", "list_max": "h % 11 = 2", "default": "h % 11 = 3", "midrange": "h % 11 = 4",
    "mode": "h % 11 = 5", "negative": "h % 11 = 6", "currency": "h % 11 = 7",
}
_H = "(CAST(sku_id AS INT) * 31 + length(region) * 7 + CAST(substr({0}, 6, 2) AS INT) * 3 + CAST(substr({0}, 3, 2) AS INT))"


@R.add("dq_report", f"""
WITH {_derived(_LIST, "l").strip()}, {_derived(_ONLINE, "o").strip()},
keys AS (SELECT sku_id, region, dt, {_H.format("dt")} AS h,
    first(sku_list_price_currency ORDER BY {_VALID.format(_LIST)} NULLS LAST, coalesce(sku_list_price_currency, '') <> '' DESC) AS lc,
    first(sku_online_price_currency ORDER BY {_VALID.format(_ONLINE)} NULLS LAST,
      coalesce(sku_online_price_currency, '') <> '' DESC) AS oc
  FROM sku_snapshot WHERE sku_list_price IS NOT NULL OR sku_online_price IS NOT NULL GROUP BY sku_id, region, dt),
made AS (SELECT * FROM keys LEFT JOIN l_stats USING (sku_id, region, dt) LEFT JOIN o_stats USING (sku_id, region, dt)),
target AS (
  SELECT *, CASE WHEN {_DAMAGE["negative"]} THEN -1.0 WHEN {_DAMAGE["default"]} THEN l_min + 1 ELSE l_min END AS l,
    CASE WHEN {_DAMAGE["negative"]} THEN -1.0 ELSE l_min END AS t_min,
    CASE WHEN {_DAMAGE["list_max"]} THEN coalesce(l_max, 0) + 0.5 ELSE l_max END AS t_max,
    CASE WHEN {_DAMAGE["mode"]} THEN coalesce(l_mode, 0) + 2 ELSE l_mode END AS t_mode,
    CASE WHEN {_DAMAGE["midrange"]} THEN 1.0 END AS t_midrange, CASE WHEN {_DAMAGE["currency"]} THEN '' ELSE lc END AS t_lc,
    count(*) OVER (PARTITION BY sku_id, region, dt) AS n
  FROM made, generate_series(1, 2) g(copy) WHERE NOT {_DAMAGE["drop"]} AND (copy = 1 OR {_DAMAGE["double"]})),
report AS (
  SELECT 'price_has_currency' AS "check", count(*) FILTER ((l IS NOT NULL AND coalesce(t_lc, '') = '')
    OR (o_min IS NOT NULL AND coalesce(oc, '') = '')) AS violations FROM target
  UNION ALL SELECT 'not_empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM target
  UNION ALL SELECT 'complete', (SELECT count(*) FROM keys) - count(DISTINCT (sku_id, region, dt)) FROM target
  UNION ALL SELECT 'key_unique', count(*) FILTER (n > 1) FROM target
  UNION ALL SELECT 'min_max_avg', count(*) FILTER ({_apart("t_min", "l_min")} OR {_apart("t_max", "l_max")}) FROM target
  UNION ALL SELECT 'default_is_min', count(*) FILTER ({_apart("l", "t_min")}) FROM target
  UNION ALL SELECT 'midrange_is_null', count(*) FILTER (t_midrange IS NOT NULL) FROM target
  UNION ALL SELECT 'mode', count(*) FILTER ({_apart("t_mode", "l_mode")}) FROM target
  UNION ALL SELECT 'not_negative', count(*) FILTER (l < 0 OR t_min < 0) FROM target)
SELECT "check", CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM report
""", ("sku_snapshot",))
def _(v):
    daily = v.stored("sku_snapshot")
    made = P.price_monthly(daily).withColumn("h", F.expr(_H.format("month_dt").replace("substr", "substring")))
    hit = {name: F.expr(rule) for name, rule in _DAMAGE.items()}
    target = (
        made.filter(~hit["drop"])
        .withColumn("copy", F.explode(F.when(hit["double"], F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .withColumns({
            "sku_list_price": F.when(hit["negative"], -1.0).when(hit["default"], F.col("sku_list_price_min") + 1).otherwise(
                F.col("sku_list_price")),
            "sku_list_price_min": F.when(hit["negative"], -1.0).otherwise(F.col("sku_list_price_min")),
            "sku_list_price_max": F.when(hit["list_max"], F.coalesce("sku_list_price_max", F.lit(0.0)) + 0.5).otherwise(
                F.col("sku_list_price_max")),
            "sku_list_price_mode": F.when(hit["mode"], F.coalesce("sku_list_price_mode", F.lit(0.0)) + 2).otherwise(
                F.col("sku_list_price_mode")),
            "sku_list_price_midrange": F.when(hit["midrange"], 1.0).otherwise(F.col("sku_list_price_midrange")),
            "sku_list_price_currency": F.when(hit["currency"], "").otherwise(F.col("sku_list_price_currency")),
        }).drop("h", "copy")
    )
    return run_checks(target, daily.withColumn("month_dt", F.col("dt")))


# --- feeds ----------------------------------------------------------------------------------------------------
_JSON = """json_extract_string(sr, '$."site|{}"')"""


def _fact(**given: str) -> str:
    cells = []
    for f in S.SKU_FACT.fields:
        kind = DUCK_TYPES[f.dataType.simpleString()]
        cells.append(f"CAST({given.get(f.name, 'NULL')} AS {kind}) AS {f.name}")
    return ", ".join(cells)


def _no_zero(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ('', '0') THEN {c} END"


_J = {k: _JSON.format(k) for k in (
    "region", "online_price", "list_price", "online_price_currency", "sales_count", "seller",
    "expected_delivery_time")}
_UNITS = f"""CASE WHEN place = 'JP' AND {_J['sales_count']} LIKE '%過去1か月で%'
    THEN regexp_extract({_J['sales_count']}, '過去1か月で([0-9]+)', 1)
    WHEN place <> 'JP' THEN regexp_extract({_J['sales_count']}, '([0-9]+)', 1) END"""
_COMMON = dict(
    sell_count_str=_J["sales_count"], vague_sell_count="units",
    sell_count_type="CASE WHEN units IS NOT NULL THEN 'last_30_count' END",
    batch_id="batch_id", crawl_status="crawl_status", snapshot_time="snapshot_time", dt="dt", region="place",
    number_of_reviews=_no_zero("reviews"))
_MENU = _fact(**{
    **_COMMON, "sku_id": "code", "product_title": "title", "url": "url", "category": "category",
    "sub_category": "sub_category", "sku_online_price": _no_zero(_J["online_price"]),
    "sku_list_price": _no_zero(_J["list_price"]), "number_of_reviews": "NULL",
    "extra_json": f"""CASE WHEN {_J['expected_delivery_time']} <> '' THEN '{{"expected_delivery_time":"' ||
       {_J['expected_delivery_time']} || '","delivery_destination":""}}' END""", "etl_source": "'menu'"})
_DETAIL = _fact(**{
    **_COMMON, "sku_id": "code", "product_title": "title", "url": "url", "category": "category",
    "sub_category": "sub_category", "brand": "brand", "sku_online_price": _no_zero("price"),
    "sku_online_price_currency": "'EUR'", "sku_list_price": _no_zero("list_price"),
    "sku_list_price_currency": f"coalesce(nullif({_J['online_price_currency']}, ''), 'EUR')",
    "has_sku": "CASE has_variants WHEN 'YES' THEN 1 WHEN 'NO' THEN 0 END", "seller": _J["seller"],
    "imags": """CASE WHEN images_1 = images_2 OR images_2 IS NULL THEN '["' || replace(images_1, ' | ', '","') || '"]'
       WHEN images_1 IS NULL THEN '["' || replace(images_2, ' | ', '","') || '"]'
       ELSE '["' || replace(images_1, ' | ', '","') || '","' || replace(images_2, ' | ', '","') || '"]' END""",
    "etl_source": "'detail'"})
_SEARCH = _fact(**{
    **_COMMON, "sku_id": "code", "product_title": "title", "url": "url", "sku_online_price": "price",
    "sku_online_price_currency": f"nullif({_J['online_price_currency']}, '')",
    "sku_list_price": _no_zero(_J["list_price"]), "etl_source": "'search'"})
_HOST = """CASE WHEN url LIKE '%.com/%' THEN 'US' WHEN url LIKE '%.de/%' THEN 'DE' WHEN url LIKE '%.jp/%' THEN 'JP'
           ELSE 'ES' END"""


@R.add("feed_union", f"""
WITH by_json AS (SELECT *, upper({_J['region']}) AS place FROM crawl_rows WHERE {_J['region']} <> ''),
by_url AS (SELECT *, coalesce(nullif(upper({_J['region']}), ''), {_HOST}) AS place FROM crawl_rows),
j AS (SELECT *, CAST(nullif({_UNITS}, '') AS BIGINT) AS units FROM by_json),
u AS (SELECT *, CAST(nullif({_UNITS}, '') AS BIGINT) AS units FROM by_url)
SELECT {_MENU} FROM j UNION ALL SELECT {_DETAIL} FROM u UNION ALL SELECT {_SEARCH} FROM j
""", ("crawl_rows",))
def _(v):
    return _feeds(v)


def _feeds(v):
    """The SKU fact of three feeds."""
    rows = v.stored("crawl_rows")
    base = ["batch_id", "crawl_status", "snapshot_time", "dt", "sr"]
    named = {"code": "retailer_product_code", "title": "product_description"}
    menu = rows.select("code", "title", "url", "category", "sub_category", *base).withColumnsRenamed(named)
    detail = rows.select(
        "code", "title", "url", "category", "sub_category", "brand", "has_variants", *base,
        F.col("price").alias("online_price"), F.lit("EUR").alias("online_price_currency"), "list_price",
        F.lit(None).cast("string").alias("promotion"), F.col("reviews").alias("number_of_reviews"),
        F.lit(None).cast("string").alias("review_rating"), F.lit(None).cast("string").alias("product_image"),
        F.col("images_1").alias("secondary_image"), F.col("images_2").alias("aplus_images"),
        F.lit(None).cast("string").alias("in_stock")).withColumnsRenamed(named)
    search = rows.select(
        F.col("code").alias("product_code"), F.col("title").alias("product_name"), F.col("url").alias("product_url"),
        "price", F.col("reviews").alias("number_of_reviews"), F.lit(None).cast("string").alias("review_rating"),
        F.lit(None).cast("string").alias("product_image"), *base)
    return P.sku_fact({
        "menu": ("menu", menu, "menu"), "detail": ("menu_detail", detail, "detail"),
        "search": ("search", search, "search")}, "site")


# --- fact to daily to dimension ---------------------------------------------------------------------------------
_FEEDS = ("detail", "menu")
_FULL = tuple(f for f in P.BEST_FIELDS if f != "extra_json")
_FULL_ORDER = ("CASE etl_source WHEN 'detail' THEN 1 WHEN 'menu' THEN 2 ELSE 3 END, "
               "snapshot_time DESC NULLS LAST, length(product_title) NULLS FIRST")
_FULL_DAILY = f"""
fact AS ({R.sql["feed_union"]}),
usable AS (SELECT * FROM fact WHERE sku_id <> '' AND region <> ''),
{_MERGE.format(keys='sku_id, region, dt', rank='etl_source, snapshot_time', order=_FULL_ORDER.rsplit(', ', 1)[0]).strip().replace(
    'FROM crawl_json', 'FROM usable')},
chosen AS (
  SELECT DISTINCT sku_id, region, dt,
    {', '.join(_best(f, _FULL_ORDER) for f in _FULL).replace('{keys}', 'sku_id, region, dt')},
    {_best('extra_json', _FULL_ORDER, blank="'', '{}'").replace('{keys}', 'sku_id, region, dt')} FROM usable),
daily AS (
  SELECT c.* REPLACE (coalesce(m, nullif(extra_json, '{{}}')) AS extra_json),
    {typed_nulls(S.SKU_DAILY, ("sku_id", "region", "dt", *P.BEST_FIELDS))}
  FROM chosen c LEFT JOIN merged USING (sku_id, region, dt))
"""


@R.add("sku_daily_full", f"WITH {_FULL_DAILY.strip()} SELECT * FROM daily")
def _(v):
    return P.sku_daily_sliced(_feeds(v), _FEEDS)


@R.add("sku_dimension_chain", f"WITH {_FULL_DAILY.strip()}, " + _dimension(
    "daily", tuple(f for f in P.DIM_FIELDS if f != "sub_category")).strip())
def _(v):
    return P.sku_dimension_of_fact(_feeds(v), _FEEDS)


_WANTED = """
WITH work AS (SELECT CAST(doc_id AS VARCHAR) AS sku_id, CASE WHEN toxic = 0 THEN 'amazon_translation' ELSE 'other' END AS t,
              CASE quality WHEN 1 THEN '2024-02-01' ELSE '2024-01-01' END AS etl_dt FROM labels),
newest AS (SELECT max(etl_dt) AS d FROM work WHERE t = 'amazon_translation'),
asked AS (SELECT sku_id FROM work, newest WHERE t = 'amazon_translation' AND etl_dt = d),
cache AS (SELECT md5(text) AS h FROM documents JOIN labels USING (doc_id) WHERE quality = 0),
wanted AS (SELECT DISTINCT text AS product_title, source AS brand, md5(text) AS fields_hash FROM documents
           WHERE CAST(doc_id AS VARCHAR) IN (SELECT sku_id FROM asked) AND text <> '' AND source <> '')
SELECT * FROM wanted WHERE fields_hash NOT IN (SELECT h FROM cache)
"""


def _candidates(v, **options):
    work = v.labels.select(
        F.col("doc_id").cast("string").alias("sku_id"),
        F.when(F.col("toxic") == 0, "amazon_translation").otherwise("other").alias("task_type"),
        F.when(F.col("quality") == 1, "2024-02-01").otherwise("2024-01-01").alias("etl_dt"))
    dimension = v.documents.select(
        F.col("doc_id").cast("string").alias("sku_id"), F.col("text").alias("product_title"),
        F.col("source").alias("brand"))
    cache = v.documents.join(v.labels, "doc_id").select(
        F.md5("text").alias("Fields_hash"), F.when(F.col("quality") == 0, F.col("text")).otherwise("").alias(
            "Fields_in_translation"))
    return P.translation_candidates(work, dimension, cache, **options)


@R.add("translation_candidates", _WANTED)
def _(v):
    return _candidates(v)


# The quota itself is the feature here: the first 150 by hash.
@R.add("semi_anti_candidates", _WANTED + "ORDER BY fields_hash || md5(brand) LIMIT 150")
def _(v):
    return _candidates(v, quota=200, done_today=50)


# --- parsing --------------------------------------------------------------------------------------------------
_DIGITS = r"regexp_extract(sell_count_str, '([0-9]+\.?[0-9]*)', 1)"


@R.add("sales_text_parse", rf"""
WITH n AS (SELECT *, TRY_CAST(regexp_extract(sell_count_str, '過去1か月で([0-9]+\.?[0-9]*).*点以上購入', 1) AS DOUBLE) AS jp,
           TRY_CAST({_DIGITS} AS DOUBLE) AS num, lower(sell_count_str) AS t FROM sales_text),
p AS (SELECT *, CASE WHEN region = 'JP' THEN jp * CASE WHEN sell_count_str LIKE '%万点%' THEN 10000 ELSE 1 END
        ELSE num * CASE WHEN t LIKE '%k+%' OR t LIKE '%mil%' THEN 1000 WHEN t LIKE '%w+%' THEN 10000 ELSE 1 END END
        AS units FROM n)
SELECT event_id, CAST(round(units) AS BIGINT) AS sell_count,
  CASE WHEN units IS NOT NULL THEN 'last_30_count' END AS sell_count_type,
  CASE WHEN regexp_matches(t, '[0-9]+\.?[0-9]*k\s*$') THEN num * 1000
       WHEN regexp_matches(t, '[0-9]+\.?[0-9]*w\s*$') THEN num * 10000
       WHEN regexp_matches(t, '^[0-9]+\.?[0-9]*$') THEN num END AS strict_count
FROM p
""", ("sales_text",))
def _(v):
    units = parse_sales_text("sell_count_str", "region")
    return v.sales_text.select(
        "event_id", units.alias("sell_count"), sales_type(units).alias("sell_count_type"),
        parse_sales_suffix("sell_count_str").alias("strict_count"))


@R.add("region_from_url", r"""
SELECT page_id, upper(coalesce(nullif(json_region, ''),
  CASE regexp_extract(url, 'https?://[^/]*\.([a-zA-Z]+)/', 1) WHEN 'com' THEN 'US'
       ELSE regexp_extract(url, 'https?://[^/]*\.([a-zA-Z]+)/', 1) END)) AS region
FROM site_url
""", ("site_url",))
def _(v):
    return v.site_url.select("page_id", region_of("json_region", "url").alias("region"))


@R.add("json_fields", """
SELECT event_id, CASE WHEN json_valid(extra_json) THEN json_extract_string(extra_json, '$."site|region"') END AS region,
  CASE WHEN json_valid(extra_json) THEN json_extract_string(extra_json, '$.k') END AS k FROM crawl_json
""", ("crawl_json",))
def _(v):
    return v.crawl_json.select("event_id", json_field("extra_json", "site|region").alias("region"),
                               json_field("extra_json", "k").alias("k"))


@R.add("json_build", """
SELECT event_id, '{"source":"' || etl_source || '","region":"' || coalesce(r, '') || '"}' AS info,
  CASE WHEN r <> '' THEN '{"region":"' || r || '"}' END AS known
FROM (SELECT *, CASE WHEN json_valid(extra_json) THEN json_extract_string(extra_json, '$."site|region"') END AS r
      FROM crawl_json)
""", ("crawl_json",))
def _(v):
    region = json_field("extra_json", "site|region")
    return v.crawl_json.select("event_id", json_build(source="etl_source", region=region).alias("info"),
                               json_build_if_any(region=region).alias("known"))
