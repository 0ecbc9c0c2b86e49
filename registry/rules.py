"""Decision tables over listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import rules as Q
from shelfwise.operators.rules import Rule, RuleSet
from shelfwise.plans.chained import chained_mapping

from .base import Registry
from .joins import KEYS, LISTING, missing_unless

R = Registry()
QUERIES, ORACLE = R.queries, R.sql

PRICE = RuleSet(1, [
    Rule(1, {"platform": "Amazon", "item_id": ("in", ["1", "2"])}, {"price": 9.5}),
    Rule(2, {"category_1": "PROMO"}, {"price": 12}),
    Rule(3, {"item_title": ("contains", "gear")}, {"price": None}),
])
UNITS = RuleSet(2, [Rule(1, {"platform": "Suning"}, {"units": 100})])
RATIO = RuleSet(3, [Rule(1, {"brand_name": ("rlike", "#1[0-9]$")}, {"ratio": 1.25})])
STATUS = RuleSet(4, [Rule(1, {"market": "asia"}, {"status": "1"})])
BRAND = RuleSet(5, [Rule(1, {"brand_name": "Brand#2"}, {"std_brand_name": "B2", "std_category_2": ""})])
CATEGORY = RuleSet(6, [Rule(1, {"std_brand_name": "B2"}, {"std_category_2": "C2"})])
# Conditions of the price rules in SQL.
P1 = "platform = 'Amazon' AND item_id IN ('1', '2')"
P2 = "category_1 = 'PROMO'"


@R.add("rules_price", f"""
SELECT {KEYS}, CASE WHEN {P1} THEN 9.5 WHEN {P2} THEN 12 ELSE page_price END AS page_price,
  CASE WHEN {P1} THEN 9.5 WHEN {P2} THEN 12 ELSE discount_price END AS discount_price,
  CASE WHEN {P1} THEN '1,1' WHEN {P2} THEN '1,2' ELSE 'feed' END AS discount_price_src FROM listing_month
""", ("listing_month",))
def _(v):
    rows = v.listing_month.withColumn("discount_price_src", F.lit("feed"))
    out = Q.override_numeric(rows, PRICE, "price", ["page_price", "discount_price"], "discount_price_src")
    return out.select(*LISTING, "page_price", "discount_price", "discount_price_src")


_RATIO = "regexp_matches(brand_name, '#1[0-9]$')"


@R.add("rules_count_ratio", f"""
SELECT {KEYS}, CAST(trunc(CASE WHEN {_RATIO} THEN 1.25 ELSE 1 END *
    CAST(CASE WHEN platform = 'Suning' THEN 100 ELSE pfsku_unit_sales END AS DOUBLE)) AS BIGINT) AS pfsku_unit_sales,
  CASE WHEN {_RATIO} THEN '3,1' WHEN platform = 'Suning' THEN '2,1' END AS pfsku_unit_sales_src,
  CASE WHEN {_RATIO} THEN 1.25 END AS fix_count_ratio FROM listing_month
""", ("listing_month",))
def _(v):
    rows = v.listing_month.withColumn("pfsku_unit_sales_src", F.lit(None).cast("string"))
    out = Q.override_then_scale(rows, UNITS, "units", RATIO, "ratio", "pfsku_unit_sales", "pfsku_unit_sales_src",
                                "fix_count_ratio")
    return out.select(*LISTING, "pfsku_unit_sales", "pfsku_unit_sales_src", "fix_count_ratio")


@R.add("rules_status", f"""
SELECT {KEYS}, 'exclude' AS status, CASE WHEN shop_id = '2' THEN 'dwd_exclude_scope' ELSE '4,1' END AS status_src
FROM listing_month WHERE shop_id = '2' OR market = 'asia'
""", ("listing_month",))
def _(v):
    rows = v.listing_month.withColumn("exclude_flag", F.when(F.col("shop_id") == "2", 1).otherwise(0))
    return Q.exclusions(rows, STATUS, "status", "dwd_exclude_scope").select(*LISTING, "status", "status_src")


@R.add("rules_chain", f"""
SELECT {KEYS}, CASE WHEN brand_name = 'Brand#2' THEN 'B2' ELSE brand_name END AS std_brand_name,
  CASE WHEN brand_name = 'Brand#2' THEN '5,1' END AS std_brand_name_src,
  CASE WHEN brand_name = 'Brand#2' THEN 'C2' ELSE category_1 END AS std_category_2,
  CASE WHEN brand_name = 'Brand#2' THEN '6,1' END AS std_category_2_src FROM listing_month
""", ("listing_month",))
def _(v):
    rows = v.listing_month.withColumns({"std_brand_name": F.col("brand_name"), "std_category_2": F.col("category_1")})
    out = Q.apply_chain(rows, [
        {"rules": BRAND, "results": {"std_brand_name": "std_brand_name", "std_category_2": "std_category_2"},
         "src_col": {"std_brand_name": "std_brand_name_src", "std_category_2": "std_category_2_src"}},
        {"rules": CATEGORY, "results": {"std_category_2": "std_category_2"}, "src_col": "std_category_2_src"}])
    return out.select(*LISTING, "std_brand_name", "std_brand_name_src", "std_category_2", "std_category_2_src")


@R.add("rules_tiered", f"""
SELECT {KEYS}, CASE WHEN {P1} THEN '9.5' WHEN {P2} THEN '12' WHEN platform = 'Suning' AND shop_id <> '0' THEN shop_id
    ELSE brand_name END AS label,
  CASE WHEN {P1} THEN '1,1' WHEN {P2} THEN '1,2' WHEN platform = 'Suning' AND shop_id <> '0' THEN 'shop'
    ELSE 'own' END AS label_src FROM listing_month
""", ("listing_month",))
def _(v):
    rows = Q.match(v.listing_month.withColumns({"label": F.col("brand_name"), "label_src": F.lit("own")}), PRICE)
    shop = F.when((F.col("platform") == "Suning") & (F.col("shop_id") != "0"), F.col("shop_id"))
    tiers = [(F.col("_rule.price"), F.col("_rule.price_src")), Q.offer(shop, F.lit("shop"))]
    return Q.tiered(rows, "label", tiers, "label_src").select(*LISTING, "label", "label_src")


@R.add("rules_provenance", f"""
WITH m AS (SELECT *, CASE WHEN {P1} THEN '1' WHEN {P2} THEN '2' WHEN contains(item_title, 'gear') THEN '3' ELSE '__DEFAULT__' END AS first,
  nullif(concat_ws(',', CASE WHEN {P1} THEN '1' END, CASE WHEN {P2} THEN '2' END,
    CASE WHEN contains(item_title, 'gear') THEN '3' END), '') AS every FROM listing_month)
SELECT {KEYS}, '1,' || first AS src, '1,' || coalesce(every, '__DEFAULT__') AS every_src,
  '1,' || first || CASE WHEN platform = 'Suning' THEN '；2,1' ELSE '' END AS joined_src FROM m
""", ("listing_month",))
def _(v):
    every = RuleSet(1, PRICE.rules, collect_all=True)
    rows = Q.match(Q.match(Q.match(v.listing_month, PRICE, "_a"), every, "_b"), UNITS, "_c")
    suning = F.when(F.col("_c.units").isNotNull(), F.col("_c.src"))
    return rows.select(*LISTING, F.col("_a.src").alias("src"), F.col("_b.src").alias("every_src"),
                       Q.joined_sources(F.col("_a.src"), suning).alias("joined_src"))


@R.add("rules_lookup", f"""
WITH rules AS (SELECT brand_name, category_1, CAST(row_number() OVER (ORDER BY brand_name, category_1, shop_id) AS INT) AS priority,
    CASE WHEN shop_id = '3' THEN '' ELSE brand_name || '/' || shop_id END AS std_brand_name
  FROM (SELECT DISTINCT CASE WHEN platform = 'Tmall' THEN brand_name ELSE 'no ' || brand_name END AS brand_name, category_1, shop_id FROM listing_month)),
best AS (SELECT brand_name, category_1, first(std_brand_name ORDER BY priority) AS s, min(priority) AS p FROM rules GROUP BY ALL)
SELECT {KEYS}, coalesce(nullif(s, ''), brand_name) AS std_brand_name,
  CASE WHEN s <> '' THEN '9,' || p END AS std_brand_name_src FROM listing_month LEFT JOIN best USING (brand_name, category_1)
""", ("listing_month",))
def _(v):
    named = missing_unless(v.stored("listing_month"), "platform = 'Tmall'", "brand_name").select(
        "brand_name", "category_1", "shop_id").distinct()
    from shelfwise.operators.ordered import renumber

    one = named.withColumn("_all", F.lit(1))
    order = [F.col(c) for c in ("brand_name", "category_1", "shop_id")]
    rules = renumber(one, ["_all"], order, "priority").select(
        "brand_name", "category_1", F.col("priority").cast("int").alias("priority"),
        F.when(F.col("shop_id") == "3", "").otherwise(F.concat_ws("/", "brand_name", "shop_id")).alias("named"))
    rows = v.stored("listing_month").withColumn("std_brand_name", F.col("brand_name"))
    out = Q.apply_lookup(rows, rules, ["brand_name", "category_1"], {"named": "std_brand_name"}, 9,
                         "std_brand_name_src")
    return out.select(*LISTING, "std_brand_name", "std_brand_name_src")


@R.add("value_map", f"""
SELECT {KEYS}, CASE platform WHEN 'Amazon' THEN 'A' WHEN 'Suning' THEN 'S' END AS short_name FROM listing_month
""", ("listing_month",))
def _(v):
    return v.listing_month.select(*LISTING, Q.value_map("platform", {"Amazon": "A", "Suning": "S"}).alias("short_name"))


GATE = """
gate AS (SELECT category_1 AS std_category_2, upper(CASE WHEN platform = 'Suning' THEN brand_name ELSE 'no ' || brand_name END) || '! '
    AS std_brand_name, 'TMALL' AS platform, min(month_dt) AS start_time, max(month_dt) AS end_time FROM listing_month GROUP BY 1, 2),
named AS (SELECT m.*, category_1 AS std_category_2, market AS lifestage, item_title AS std_category_3,
    'name ' || item_title AS std_spu_name, CASE WHEN shop_id IN ('0', '1') THEN '104736,' || shop_id ELSE '104736,__DEFAULT__' END AS std_spu_name_src,
    CASE WHEN CAST(item_id AS INT) % 2 = 0 THEN '机器清洗' ELSE 'annotated' END AS sku_src FROM listing_month m),
gated AS (SELECT n.*, g.start_time IS NOT NULL AND (shop_id IN ('0', '1') OR sku_src <> '机器清洗') AS keep,
    coalesce(n.brand_name, '') || coalesce(lifestage, '') || coalesce(std_category_3, '') AS built
  FROM named n LEFT JOIN gate g ON n.std_category_2 = g.std_category_2 AND lower(n.platform) = lower(g.platform)
    AND lower(n.brand_name) || '! ' = lower(g.std_brand_name) AND n.month_dt BETWEEN g.start_time AND g.end_time)
"""


def gate_inputs(v):
    """Named listings and the gate table."""
    rows = v.stored("listing_month").withColumns({
        "std_category_2": F.col("category_1"), "lifestage": F.col("market"), "std_category_3": F.col("item_title"),
        "std_brand_name": F.col("brand_name"), "std_spu_name": F.concat(F.lit("name "), "item_title"),
        "std_spu_name_src": F.concat(F.lit("104736,"), F.when(F.col("shop_id").isin("0", "1"), F.col("shop_id"))
                                     .otherwise("__DEFAULT__")),
        "sku_src": F.when(F.col("item_id").cast("int") % 2 == 0, "机器清洗").otherwise("annotated"),
    })
    gate = missing_unless(v.stored("listing_month"), "platform = 'Suning'", "brand_name").groupBy("category_1", "brand_name").agg(
        F.min("month_dt").alias("start_time"), F.max("month_dt").alias("end_time")).select(
        F.col("category_1").alias("std_category_2"),
        F.concat(F.upper("brand_name"), F.lit("! ")).alias("std_brand_name"), F.lit("TMALL").alias("platform"),
        "start_time", "end_time")
    return rows, gate


@R.add("brand_gate", f"""
WITH {GATE.strip()}
SELECT {KEYS}, CASE WHEN keep THEN std_spu_name ELSE built END AS std_spu_name,
  CASE WHEN keep THEN std_spu_name_src ELSE 'brand_limit_rule' END AS std_spu_name_src FROM gated
""", ("listing_month",))
def _(v):
    rows, gate = gate_inputs(v)
    out = Q.brand_gate(rows, gate, 104736, ("JD", "Tmall", "Douyin"), "机器清洗")
    return out.select(*LISTING, "std_spu_name", "std_spu_name_src")


_WEIGHT = RuleSet(104963, [Rule(1, {"market": "asia"}, {"package": "4", "size": "2.5"}),
                           Rule(2, {"platform": "Tmall"}, {"weight": "12.5", "package": ""})])
_SEGMENT = RuleSet(104956, [Rule(1, {"std_sku_name": ("contains", "12ml")}, {"fix_std_sub_segment": "twelve"})])
_SEGMENT_CATEGORY = RuleSet(104961, [Rule(1, {"std_sub_segment": "twelve"}, {"std_category_name": "liquid", "std_segment": ""})])
_FIRST = RuleSet(104962, [Rule(1, {"std_category_name": "liquid", "shop_id": "1"}, {"fix_std_brand_name": "FIRST"})])
_SECOND = RuleSet(104840, [Rule(1, {"shop_id": ("in", ["1", "2"])}, {"std_brand_name": "SECOND"})])
_MAKER = RuleSet(104952, [Rule(1, {"std_brand_name": "FIRST"}, {"manufacturer": "Maker"})])


@R.add("chained_mapping", f"""
WITH w AS (SELECT *, CASE WHEN market = 'asia' THEN 4 ELSE CAST(sku_num AS INT) END AS package,
    CASE WHEN market <> 'asia' AND platform = 'Tmall' THEN 12.5 ELSE page_price END AS weight,
    CASE WHEN market = 'asia' THEN 2.5 ELSE 0 END AS size,
    CASE WHEN market = 'asia' THEN '104963,1' WHEN platform = 'Tmall' THEN '104963,2' END AS src FROM listing_month),
n AS (SELECT *, CASE WHEN lower(item_title) <> 'others' THEN item_title || CAST(CAST(round_even(weight, 0) AS BIGINT) AS VARCHAR) || 'ml' END AS std_sku_name FROM w),
c AS (SELECT *, contains(std_sku_name, '12ml') AS twelve FROM n),
b AS (SELECT *, CASE WHEN twelve AND shop_id = '1' THEN 'FIRST' WHEN shop_id IN ('1', '2') THEN 'SECOND' ELSE brand_name END AS brand,
    CASE WHEN twelve AND shop_id = '1' THEN '104962,1' WHEN shop_id IN ('1', '2') THEN '104840,1' END AS brand_src FROM c)
SELECT {KEYS}, package, weight, CASE WHEN src IS NOT NULL THEN weight * package END AS total_weight, src AS total_weight_src, src AS package_weight_src,
  size, CASE WHEN market = 'asia' THEN src END AS size_src, std_sku_name, std_sku_name AS sku_title, CASE WHEN twelve THEN 'twelve' END AS std_sub_segment,
  CASE WHEN twelve THEN 'liquid' ELSE category_1 END AS std_category_name, CASE WHEN twelve THEN '104961,1' END AS std_category_name_src,
  brand AS std_brand_name, brand_src AS std_brand_name_src, CASE WHEN brand = 'FIRST' THEN 'Maker' END AS manufacturer,
  CASE WHEN size <> 0 THEN size * package END AS total_size FROM b
""", ("listing_month",))
def _(v):
    none = F.lit(None).cast("string")
    rows = v.listing_month.withColumns({
        "package": F.col("sku_num").cast("int"), "weight": F.col("page_price"), "size": F.lit(0.0),
        "total_weight": F.lit(None).cast("double"), "package_weight_src": none, "total_weight_src": none, "size_src": none,
        "std_spu_name": F.col("item_title"), "pfsku_title": none, "std_sub_segment": none,
        "std_category_name": F.col("category_1"), "std_category_name_src": none, "std_brand_name": F.col("brand_name"),
        "std_brand_name_src": none, "manufacturer": none})
    out = chained_mapping(
        rows, _WEIGHT,
        [{"rules": _SEGMENT, "results": {"fix_std_sub_segment": "std_sub_segment"}},
         {"rules": _SEGMENT_CATEGORY, "results": {"std_category_name": "std_category_name"}, "src_col": "std_category_name_src"}],
        _FIRST, _SECOND, [{"rules": _MAKER, "results": {"manufacturer": "manufacturer"}}])
    return out.select(
        *LISTING, "package", "weight", "total_weight", "total_weight_src", "package_weight_src", "size", "size_src", "std_sku_name",
        "sku_title", "std_sub_segment", "std_category_name", "std_category_name_src", "std_brand_name", "std_brand_name_src",
        "manufacturer", "total_size")


# Five rules per document on pieces of its text: contained texts, some of them for one language only, and patterns.
_PIECES = """
SELECT CAST(doc_id * 5 + i AS INT) AS priority, CAST((doc_id + i) % 3 AS INT) AS set_id, lang AS wanted,
  CASE i WHEN 4 THEN 'rlike' ELSE 'contains' END AS kind, i IN (1, 3) AS one_lang,
  CASE i WHEN 4 THEN {letters} ELSE substring(text, 20 * i + 1, 7 + i) END AS piece
FROM documents {numbers} WHERE length(text) >= 20 * i + 12
"""
_PIECES_DUCK = _PIECES.format(letters="regexp_replace(substring(text, 81, 9), '[^A-Za-z]', '[^x]', 'g')",
                              numbers=", (SELECT unnest([0, 1, 2, 3, 4]) AS i)")


@R.add("rules_text_index", f"""
WITH r AS ({_PIECES_DUCK.strip()}),
hits AS (SELECT d.doc_id, r.set_id, r.priority FROM documents d JOIN r ON (NOT one_lang OR d.lang = r.wanted)
  AND CASE kind WHEN 'rlike' THEN regexp_matches(d.text, piece) ELSE contains(d.text, piece) END)
SELECT d.doc_id, '0,' || coalesce(CAST(min(priority) FILTER (set_id = 0) AS VARCHAR), '__DEFAULT__') AS src_0,
  'R' || CAST(min(priority) FILTER (set_id = 1) AS VARCHAR) AS std_1,
  '2,' || coalesce(string_agg(CAST(priority AS VARCHAR), ',' ORDER BY priority) FILTER (set_id = 2), '__DEFAULT__') AS every_2
FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id
""")
def _(v):
    """Thousands of text rules in three sets over all documents: first matches and all matches."""
    v.documents.createOrReplaceTempView("documents_for_rules")
    pieces = v.spark.sql(_PIECES.format(
        letters="regexp_replace(substring(text, 81, 9), '[^A-Za-z]', '[^x]')",
        numbers="LATERAL VIEW explode(array(0, 1, 2, 3, 4)) AS i").replace("FROM documents", "FROM documents_for_rules"))
    rules = {s: [] for s in range(3)}
    for r in pieces.toLocalIterator():  # rules are configuration
        when = {"text": (r.kind, r.piece)} | ({"lang": r.wanted} if r.one_lang else {})
        rules[r.set_id].append(Rule(r.priority, when, {"std": f"R{r.priority}"}))
    rows = v.documents.select("doc_id", "text", "lang")
    for s in range(3):
        rows = Q.match(rows, RuleSet(s, rules[s], collect_all=s == 2), f"_{s}")
    return rows.select("doc_id", F.col("_0.src").alias("src_0"), F.col("_1.std").alias("std_1"), F.col("_2.src").alias("every_2"))


# A rule per part: equality, lists, contained words, patterns and ranges, with equal priorities.
_RULES = """
SELECT p_partkey % 3 AS set_id, CAST(floor(p_partkey / 4) AS INT) AS priority,
  CASE p_partkey % 5
    WHEN 0 THEN '{"brand_name": "' || p_brand || '", "item_id": "' || CAST(p_partkey % 50 AS STRING) || '"}'
    WHEN 1 THEN '{"brand_name": ["in", ["' || p_brand || '", "' || p_type || '"]], "platform": "Tmall"}'
    WHEN 2 THEN '{"item_title": ["contains", "' || substring(p_name, 3, 5) || '"], "shop_id": "' || CAST(p_size % 4 AS STRING) || '"}'
    WHEN 3 THEN '{"item_title": ["rlike", "^' || substring(p_name, 1, 3) || '"], "market": ["not_in", ["asia", "cn"]]}'
    ELSE '{"page_price": ["between", ' || CAST(p_size AS STRING) || ', ' || CAST(p_size + 1 AS STRING) || '], "sku_num": 2}' END AS conditions,
  '{"std": "R' || CAST(p_partkey AS STRING) || '"}' AS results,
  p_partkey, p_brand, p_type, p_name, p_size
FROM part
"""


@R.add("rules_many", f"""
WITH r AS ({_RULES.replace("STRING", "VARCHAR")}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY priority, conditions, results) AS rn FROM r),
hits AS (SELECT {', '.join('l.' + k for k in LISTING)}, r.set_id, min(rn) AS rn FROM listing_month l JOIN ranked r ON CASE p_partkey % 5
    WHEN 0 THEN brand_name = p_brand AND item_id = CAST(p_partkey % 50 AS VARCHAR)
    WHEN 1 THEN brand_name IN (p_brand, p_type) AND platform = 'Tmall'
    WHEN 2 THEN contains(item_title, substring(p_name, 3, 5)) AND shop_id = CAST(p_size % 4 AS VARCHAR)
    WHEN 3 THEN starts_with(item_title, substring(p_name, 1, 3)) AND market NOT IN ('asia', 'cn')
    ELSE page_price BETWEEN p_size AND p_size + 1 AND sku_num = 2 END GROUP BY ALL),
found AS (SELECT h.*, 'R' || CAST(p_partkey AS VARCHAR) AS std, CAST(h.set_id AS VARCHAR) || ',' || CAST(priority AS VARCHAR) AS src
  FROM hits h JOIN ranked r ON h.set_id = r.set_id AND h.rn = r.rn)
SELECT {KEYS}, {', '.join(f"max(std) FILTER (set_id = {s}) AS std_{s}, max(src) FILTER (set_id = {s}) AS src_{s}" for s in range(3))}
FROM (SELECT {KEYS}, NULL AS set_id, NULL AS std, NULL AS src FROM listing_month
      UNION ALL SELECT {KEYS}, set_id, std, src FROM found) GROUP BY {KEYS}
""", ("listing_month",))
def _(v):
    sets = Q.load_rule_sets(_rules_of(v.part))
    rows = v.stored("listing_month")
    for s in sorted(sets):
        rows = Q.apply_rules(rows, sets[s], {"std": f"std_{s}"}, f"src_{s}")
    return rows.select(*LISTING, *[f"{c}_{s}" for s in range(3) for c in ("std", "src")])


def _rules_of(part):
    """The same rules from the table of parts."""
    columns = _RULES.split("SELECT", 1)[1].rsplit("FROM part", 1)[0]
    part.createOrReplaceTempView("parts_for_rules")
    return part.sparkSession.sql(f"SELECT {columns} FROM parts_for_rules")
