"""Operators on hand-made rows, with literal results."""

import json

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import bundles as B, collapse as C, forecast as O, history as H, joins as J, ordered as R
from shelfwise.operators import quality as Q
from shelfwise.plans import crawl
from shelfwise.sources.scans import conform, resolve_month_range, scope_filter, union_feeds


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_best_fields_ties_do_not_depend_on_row_order(spark):
    data = [("k", "b", "t", "2"), ("k", "a", "t", "2"), ("k", "", None, "3"), ("k", "z", "long title", "1")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, f string, title string, ts string").repartition(3)
        got = C.best_fields(df, ["k"], ["f", "title"], [F.col("ts"), *C.shortest_first("title")])
        assert rows(got) == [("k", "b", "t")]


def test_paired_field_comes_from_the_same_row(spark):
    df = spark.createDataFrame([("k", "cat", None, "1"), ("k", "", "later sub", "2")], "k string, c string, s string, ts string")
    got = C.best_fields(df, ["k"], ["c", "s"], [F.col("ts")], paired={"s": "c"})
    assert rows(got) == [("k", "cat", None)]


def test_json_merge(spark):
    data = [("k", 1, '{"a":1,"b":{"x":[1]}}'), ("k", 2, '{"a":2.50,"c":"é\\"q"}'), ("k", 3, "[1,2]"), ("k", 4, "bad"),
            ("k", 5, ""), ("k", 6, None), ("none", 1, "{}"), ("quote", 1, '{"a\\"b":null}')]
    df = spark.createDataFrame(data, "k string, o int, j string")
    got = dict(rows(C.merge_json(df, ["k"], "j", [F.col("o")])))
    assert json.loads(got["k"]) == {"a": 2.5, "b": {"x": [1]}, "c": 'é"q'}
    assert got["none"] is None and json.loads(got["quote"]) == {'a"b': None}


def test_daily_json_falls_back_to_the_best_single_value(spark):
    df = spark.createDataFrame([("s", "US", "d", "a", "1", "[1]", "t"), ("r", "US", "d", "a", "1", "{}", "t")],
                               "sku_id string, region string, dt string, etl_source string, snapshot_time string, "
                               "extra_json string, product_title string")
    got = rows(crawl.sku_daily(df, ["a"], ["extra_json"]).select("sku_id", "extra_json"), "sku_id")
    assert got == [("r", None), ("s", "[1]")]


def test_mode_is_over_the_whole_month(spark):
    # The latest row does not hold the most frequent price; prices of 0 and below never count.
    data = [("s", "US", f"2024-01-0{d}", p, None) for d, p in enumerate((5.0, 5.0, 7.0, 7.0, 0.0, 0.0, 0.0, 9.0), 1)]
    df = spark.createDataFrame(data, "sku_id string, region string, dt string, sku_list_price double, sku_online_price double")
    for c in ("product_id", "sku_list_price_currency", "sku_online_price_currency"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    got = crawl.price_monthly(df).select("sku_list_price_mode", "sku_list_price_min", "sku_list_price_max",
                                         "sku_list_price_avg", "sku_online_price_mode", "month_dt")
    assert rows(got) == [(5.0, 5.0, 9.0, 6.6, None, "2024-01-01")]


def test_price_daily_without_valid_price(spark):
    data = [("s", "US", "d", "p1", "0", None, "", "EUR", "a", "1"), ("s", "US", "d", "p2", "x", None, "USD", "", "b", "2"),
            ("gone", "US", "d", "p", None, None, "USD", "EUR", "a", "1")]
    df = spark.createDataFrame(data, "sku_id string, region string, dt string, product_id string, sku_online_price string, "
                               "sku_list_price string, sku_online_price_currency string, sku_list_price_currency string, "
                               "etl_source string, snapshot_time string")
    got = crawl.price_daily(df).select("sku_id", "product_id", "sku_online_price", "sku_online_price_currency",
                                       "sku_list_price_currency", "price_info")
    assert rows(got) == [("s", "p2", None, "USD", "EUR", '{"sku_online_price":"b","sku_list_price":"b"}')]


def test_monthly_range_override(spark):
    overrides = spark.createDataFrame([("2024-01-01", "2024-01-10", "2024-02-03")], "month_dt string, start_dt string, end_dt string")
    days = spark.createDataFrame([("2024-02-29",), ("2024-03-31",)], "run_dt string")
    assert rows(resolve_month_range(days, overrides), "run_dt") == [
        ("2024-02-29", "2024-01-01", "2024-01-10", "2024-02-03"), ("2024-03-31", "2024-02-01", "2024-02-01", "2024-02-29")]


def test_scope(spark):
    df = spark.createDataFrame([("a", "cn", "2024-01-01"), ("b", "us", "2024-02-01"), ("b", "us", None)],
                               "platform string, market string, month_dt string")
    assert scope_filter(df, "full").count() == 2
    assert scope_filter(df, "incremental", " none ").count() == 3
    assert scope_filter(df, "full", "2024-03-01", start_month="2024-02-01").count() == 1
    assert scope_filter(df, "incremental", "2024-02-01", "b", "ALL").count() == 1
    with pytest.raises(ValueError):
        scope_filter(df, "weekly")
    with pytest.raises(ValueError):
        union_feeds({}, [])
    with pytest.raises(ValueError):
        union_feeds({"a": (df, lambda d: d)}, ["b"])


def test_conform_pads_casts_and_drops(spark):
    from shelfwise.schemas import schema

    df = spark.createDataFrame([("7", "x", "gone")], "a string, b string, c string")
    got = conform(df, schema("b bigint, a int, new string"))
    assert got.dtypes == [("b", "bigint"), ("a", "int"), ("new", "string")] and rows(got) == [(None, 7, None)]


def test_listing_join_keys(spark):
    ddl = "platform string, market string, item_id string, pfsku_id string, shop_id string, month_dt string, price double"
    left = spark.createDataFrame([("AMAZON", "us", "1", "1", "s1", "m", 0.0), ("Suning", "cn", "1", "1", "s1", "m", 0.0),
                                  ("Tmall", "cn", "1", "1", "s1", "m", 0.0), ("Amazon", None, "1", "1", "s1", "m", 0.0)], ddl)
    right = spark.createDataFrame([("amazon", "us", "1", "1", "s2", "m", 1.0), ("amazon", "de", "1", "1", "s1", "m", 2.0),
                                   ("suning", "x", "1", "1", "s2", "m", 3.0), ("suning", "x", "1", "1", "s1", "m", 4.0),
                                   ("tmall", "x", "1", "1", "s2", "m", 5.0)], ddl)
    got = rows(J.listing_join(left, right, {"price": "price"}).select("platform", "market", "price"), "platform", "market")
    assert got == [("AMAZON", "us", 1.0), ("Amazon", None, None), ("Suning", "cn", 4.0), ("Tmall", "cn", 5.0)]
    assert "OR" not in J.listing_join(left, right, {"price": "price"})._jdf.queryExecution().optimizedPlan().toString()


def test_running_share_ends_at_one_for_any_slicing(spark):
    data = [("g", float(i % 7), str(i)) for i in range(200)] + [("h", 0.0, "z"), ("h", 0.0, "y"), (None, 3.0, "n")]
    df = spark.createDataFrame(data, "k string, v double, t string")
    results = []
    for slices in (1, 5):
        got = R.running_share(df, ["k"], "v", ["t"], "share", slices=slices)
        results.append(rows(got, "k", F.desc("v"), "t"))
    assert results[0] == results[1]
    shares = [r[3] for r in results[0] if r[0] == "g"]
    assert shares == sorted(shares) and shares[-1] == 1.0
    assert [r[3] for r in results[0] if r[0] == "h"] == [None, None]
    assert [r[3] for r in results[0] if r[0] is None] == [1.0]


def test_running_matches_a_window_on_a_hot_key(spark):
    from pyspark.sql import Window

    # One key holds a third of the rows and one value most of that key's rows.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("k"),
        F.when(F.col("id") % 5 == 0, F.col("id") % 11).otherwise(1).cast("bigint").alias("v"), "id")
    order = [F.col("v").desc(), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "id", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("p"))
    got = R.running(df, ["k"], order, {"s": F.col("v")}, position="p", slices=16).select("k", "id", "s", "p")
    assert rows(got, "id") == rows(want, "id")


def test_hot_group_is_cut_into_many_slices(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id"))
    cut = R.sliced(df, ["k"], [F.col("id")], 16).groupBy("_slice").count().collect()
    assert len(cut) == 16 and max(r["count"] for r in cut) < 1000


def test_first_by_key_is_exact(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("h"), "id")
    for n in (0, 1, 137, 500, 900):
        want = [r["h"] for r in df.orderBy("h").limit(n).collect()]
        assert sorted(r["h"] for r in R.first_by_key(df, "h", n, slices=5).collect()) == want


def test_first_same_and_inherit(spark):
    data = [("a", "2025-07-01", "x"), ("a", "2025-08-01", "y"), ("a", "2025-09-01", "y"), ("a", "2025-10-01", "x"),
            ("a", "2025-11-01", "x"), ("a", "2025-12-01", "x")]
    df = spark.createDataFrame(data, "k string, m string, fp string")
    first = rows(H.first_same(df, ["k"], "fp", "m", "s").select("m", "s"), "m")
    assert [s for _, s in first] == ["2025-07-01", "2025-08-01", "2025-08-01", "2025-07-01", "2025-07-01", "2025-07-01"]
    start = rows(H.inherit_if_same(df, ["k"], "fp", "m", "s", "2025-08-01", "2022-07-01").select("m", "s"), "m")
    # A later month takes the previous month's initial start, so the start moves with a longer run.
    assert [s for _, s in start] == ["2022-07-01", "2022-07-01", "2022-07-01", "2025-10-01", "2025-10-01", "2025-11-01"]


def test_first_seen_with_null_market(spark):
    from shelfwise.plans.monthly import listing_month

    df = spark.createDataFrame([("Amazon", None, "i", "p", "2024-02-01"), ("AMAZON", None, "i", "p", "2024-01-01")],
                               "platform string, market string, item_id string, pfsku_id string, month_dt string")
    assert {r["product_listing_time"] for r in listing_month(df, df).collect()} == {"2024-01-01"}


KEYS = ["platform", "item_id", "pfsku_id", "month_dt"]
PART = ("platform string, item_id string, pfsku_id string, month_dt string, sku_no int, std_category_2 string, std_category_3 string, "
        "std_brand_name string, std_spu_name string, weight double, package_num bigint")


def part(no, category, name, weight=None, packages=1, brand="B", item="1", group="x"):
    return ("T", item, "p", "m", no, group, category, brand, name, weight, packages)


def test_liquid_names(spark):
    parts = [
        part(1, B.LIQUID_CATEGORY, "液加热器", None, 2), part(2, B.LIQUID_CATEGORY, "驱蚊液45ml 装", 45.5, 1),
        part(3, B.LIQUID_CATEGORY, "无香液", None, 5), part(4, B.LIQUID_CATEGORY, "驱蚊液33ml", 33.0, 2),
        part(5, B.LIQUID_CATEGORY, "驱蚊液45ml", 45.5, 3), part(6, B.LIQUID_CATEGORY, "蚊香", 1.0, 9),
        part(7, B.LIQUID_CATEGORY, "加热器", None, 1, brand=None),
    ]
    got = B.merge_liquid(spark.createDataFrame(parts, PART), KEYS).select("sku_no", "std_brand_name", "std_spu_name",
                                                                          "weight", "package_num")
    # 45.5 rounds half to even; the part that is neither liquid nor device takes no part.
    assert rows(got, "sku_no") == [(1, "B", "驱蚊液33ml*2+46ml*4+2器", 45.5, 11), (2, None, None, None, 0)]


def test_brush_names(spark):
    parts = [part(1, B.BRUSH_CATEGORY, "刷杆", None, 2), part(2, B.BRUSH_CATEGORY, " 马桶刷 ", None, 3),
             part(3, B.BRUSH_CATEGORY, "另一刷", None, None), part(4, B.BRUSH_CATEGORY, "刷", None, 1, brand="A"),
             part(5, B.BRUSH_CATEGORY, "手柄", None, 4, brand="C")]
    got = B.merge_brush(spark.createDataFrame(parts, PART), KEYS).select("sku_no", "std_brand_name", "std_spu_name", "package_num")
    assert rows(got, "sku_no") == [(1, "B", "马桶刷*3+2", 3), (2, "A", "刷*1+1", 1), (3, "C", None, 0)]


def test_bundle_qualification(spark):
    parts = [part(1, "a", "x", item="two"), part(2, "a", "x", item="two"), part(1, "a", "x", item="one"),
             part(1, "a", "x", item="mixed"), part(2, "b", "x", item="mixed"), part(1, "洁厕剂", "x", item="toilet"),
             part(2, "洁厕剂", "x", item="toilet"), part(1, "a", "x", item="out", group="电热驱蚊"), part(2, "a", "x", item="out")]
    got = B.qualify_bundles(spark.createDataFrame(parts, PART), KEYS).select("item_id", "sku_num", "categorys")
    assert rows(got) == [("two", 2, "a")]


def features(spark, data):
    ddl = ("sku_id string, category_id string, category_name string, comments_number bigint, comments_score double, "
           "comments_number_prev1 bigint, comments_number_prev2 bigint, comments_number_prev3 bigint, comments_number_diff bigint, "
           "days_diff double")
    return spark.createDataFrame(data, ddl)


def test_review_states(spark):
    cases = [((100, None, None, None), -3), ((99, None, 5, 5), -2), ((0, None, 1, 1), -1), ((5, 0, 0, 0), 0), ((0, 3, 0, 0), 1),
             ((0, 0, None, 7), 1), ((0, 0, 2, 0), 2), ((0, 0, 0, None), 2), ((0, 0, 0, 4), 3), ((0, 0, 0, 0), 4)]
    df = features(spark, [(str(i), "862", None, c[0], 1.0, *c[1:], 0, 0.0) for i, (c, _) in enumerate(cases)])
    got = rows(df.select(F.col("sku_id").cast("int").alias("i"), O.review_state().alias("s")), "i")
    assert [s for _, s in got] == [s for _, s in cases]


def test_forecast_values(spark):
    import math

    df = features(spark, [
        ("up", "862", None, 50, 4.0, 40, 1, 1, 10, 14.0), ("down", "862", None, 50, 4.0, 60, 1, 1, -10, 0.0),
        ("unknown", "x", None, 50, 4.0, 40, 1, 1, 10, 7.0), ("null", "862", None, None, None, 1, 1, 1, None, None)])
    got = dict(rows(O.forecast(df, O.coefficients(spark), prediction_dt="d").select("sku_id", "predicted_weekly_sales")))
    factor = 0.7 + math.log1p(50) / 100 * 1.1
    assert got["up"] == round((math.log1p(10) * 10 + 20) * factor * 7 / 14)
    assert got["down"] == round((math.log1p(50) * 10 + 20) * factor)   # falls back to the total, days 0: unscaled
    assert got["null"] == 0 and "unknown" not in got


def test_calibration_branches(spark):
    ddl = ("sku_id string, category_id string, category_name string, comments_number bigint, comments_score double, "
           "predicted_weekly_sales bigint, comments_number_diff bigint, days_diff double, dt string, prediction_dt string, next_week_dt string")
    week = "2025-12-01"   # the month before 30 November is October, 31 days
    forecast = {"primary": 5, "zero": 5, "low": 10, "floor": 1, "tiny": 1, "high": 1000, "cap": 1000, "inside": 70, "none": 3, "equal": 1}
    predicted = spark.createDataFrame([(k, "c", "n", 1, 1.0, p, 4, 0.0, "d", "p", week) for k, p in forecast.items()], ddl)
    monthly = "sku_id string, month_dt string, units bigint"
    primary = spark.createDataFrame([("primary", "2025-10-01", 31), ("primary", "2025-10-01", 31), ("zero", "2025-10-01", 0),
                                     ("none", "2025-11-01", 99)], monthly)
    secondary = spark.createDataFrame([("primary", "2025-10-01", 9999), ("low", "2025-10-01", 310), ("floor", "2025-10-01", 3100),
                                       ("tiny", "2025-10-01", 1), ("high", "2025-10-01", 31), ("cap", "2025-10-01", 372),
                                       ("inside", "2025-10-01", 310), ("equal", "2025-10-01", 93)], monthly)
    got = {r["sku_id"]: (r["weekly_count"], r["weekly_count_src"], r["origin_count"], r["comments_number_diff"])
           for r in O.calibrate(predicted, primary, secondary, "A", "B").collect()}
    assert got == {
        "primary": (14, "A", 62, 0), "zero": (0, "A", 0, 0),
        "low": (70, "B", 310, 0),                       # raised to the weekly value 70
        "floor": (21, "sales_prediction", 3100, 0),     # 21-fold at most
        "tiny": (1, "sales_prediction", 1, 0),
        "high": (70, "B", 31, 0),                       # 10 times the weekly value 7
        "cap": (800, "sales_prediction", 372, 0),       # 0.8 of the forecast is below 840
        "inside": (70, "sales_prediction", 310, 0), "none": (3, "sales_prediction", None, 0),
        "equal": (21, "sales_prediction", 93, 0),       # both bounds are 21
    }


def test_weekly_features_reads_absent_weeks(spark):
    ddl = "sku_id string, product_id string, next_week_dt string, comments_number bigint, snapshot_time string"
    df = spark.createDataFrame([
        ("a", "a", "20240129", 7, "2024-01-28 12:00:00"), ("a", "a", "20240122", 4, "2024-01-21 00:00:00"),
        ("a", "a", "20240108", 2, "2024-01-07 00:00:00"), ("b", "b", "20240129", 3, "2024-01-28 00:00:00"),
        ("a", "a", "20240101", 9, "2024-01-01 00:00:00")], ddl)
    got = O.weekly_features(df).select("sku_id", "comments_number_prev1", "comments_number_prev2", "comments_number_prev3",
                                       "comments_number_diff", "days_diff")
    assert rows(got, "sku_id") == [("a", 4, None, 2, 3, 7.5), ("b", None, None, None, 3, 0.0)]


def test_quality_report_finds_what_is_wrong(spark):
    data = [("s", "US", "2024-01-02", "p", 5.0, "EUR", 4.0, "EUR"), ("t", "US", "2024-01-02", "p", 3.0, "", None, None)]
    daily = spark.createDataFrame(data, "sku_id string, region string, dt string, product_id string, sku_list_price double, "
                                  "sku_list_price_currency string, sku_online_price double, sku_online_price_currency string")
    upstream = daily.withColumn("month_dt", F.lit("2024-01-01"))
    good = crawl.price_monthly(daily)

    def report(target):
        return {r["check"]: r["violations"] for r in Q.run_checks(target, upstream).collect()}

    assert {k: v for k, v in report(good).items() if v} == {"price_has_currency": 1}
    broken = good.withColumns({
        "sku_list_price_max": F.lit(None).cast("double"), "sku_online_price_mode": F.lit(-1.0),
        "sku_list_price_midrange": F.lit(1.0), "sku_list_price": F.lit(-2.0)})
    found = report(broken.unionByName(broken.filter("sku_id = 's'")).filter("sku_id = 's'"))
    assert found == {"not_empty": 0, "key_unique": 2, "min_max_avg": 2, "default_is_min": 2, "midrange_is_null": 2, "mode": 2,
                     "not_negative": 2, "price_has_currency": 0, "complete": 1}
    assert report(good.filter("false"))["not_empty"] == 1


def test_quota_is_per_run_date(spark):
    work = spark.createDataFrame([("1", "amazon_translation", "d2"), ("2", "amazon_translation", "d2"), ("3", "amazon_translation", "d1"),
                                  ("4", "other", "d3")], "sku_id string, task_type string, etl_dt string")
    dim = spark.createDataFrame([("1", "t1", "b"), ("2", "t2", "b"), ("3", "t3", "b"), ("1", "", "b"), ("2", "t4", None)],
                                "sku_id string, product_title string, brand string")
    assert crawl.translation_candidates(work, dim).count() == 2
    assert crawl.translation_candidates(work, dim, quota=2, done_today=1).count() == 1
    assert crawl.translation_candidates(work, dim, quota=2, done_today=5).count() == 0
    cache = spark.createDataFrame([("t1", "uno"), ("t2", "")], "Fields string, Fields_in_translation string").withColumn(
        "Fields_hash", F.md5("Fields"))
    assert rows(crawl.translation_candidates(work, dim, cache).select("product_title")) == [("t2",)]


@pytest.mark.parametrize("kind, make", [
    ("int", lambda i: i), ("double", lambda i: i / 7), ("string", lambda i: f"2024-{i:04d}-long"), ("date", None), ("timestamp", None)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_join_agrees_with_all_pairs(spark, kind, make, how):
    import random
    from datetime import date, datetime, timedelta
    make = make or (lambda i: date(2024, 1, 1) + timedelta(i) if kind == "date" else datetime(2024, 1, 1) + timedelta(hours=i))
    draw = random.Random(kind + how)
    left = [(draw.choice(["a", "b", None]), None if i == 7 else make(draw.randrange(-50 if kind in ("int", "double") else 0, 90)), i)
            for i in range(120)]
    left += left[:3]
    right = []
    for i in range(60):
        at, length = draw.randrange(90), draw.choice([0, 0, 1, 2, 5, 80, -3])
        end = at + length
        right.append((draw.choice(["a", "b", None]), make(at), None if i == 9 else make(max(0, end)), i))
    a = spark.createDataFrame(left, f"k string, p {kind}, row int")
    b = spark.createDataFrame(right, f"k string, s {kind}, e {kind}, id int")
    got = sorted(map(str, ((r.k, r.p, r.row, r.s, r.e, r.id) for r in J.interval_join(a, b, ["k"], "p", "s", "e", how).collect())))
    want = []
    for k, p, row in left:
        found = [(k, p, row, s, e, i) for q, s, e, i in right
                 if k is not None and k == q and p is not None and e is not None and s <= p <= e]
        want += found or ([(k, p, row, None, None, None)] if how == "left" else [])
    assert got == sorted(map(str, want))


def test_interval_join_of_a_hot_key_compares_few_pairs(spark):
    """20,000 points and intervals of one key, half of them a point long, some very long: pairs compared are near those found."""
    n = 20_000
    points = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("p"))
    length = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 1000 == 1, 5000).otherwise(3)
    spans = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("s"), (F.col("id") + length).alias("e"))
    joined = J.interval_join(points, spans, ["k"], "p", "s", "e", "inner")
    found = joined.count()
    at = [J.axis_position(F.col(c), spans.schema[c].dataType) for c in "se"]
    width = F.when(at[0] == at[1], 0).otherwise(F.length(F.bin(at[1] - at[0])))
    tested = spans.select(F.sum(F.pow(F.lit(2.0), width) * 2)).first()[0]  # rows of two bins at most
    assert found == spans.filter("s < 20000").select(F.sum(F.least("e", F.lit(n - 1)) - F.col("s") + 1)).first()[0]
    assert tested < 5 * found < n * n / 100


def test_dimension_state_does_not_depend_on_days_order(spark, tmp_path):
    import random
    draw = random.Random(5)
    rows = [(f"s{draw.randrange(6)}", draw.choice(["US", "CN", ""]), f"2024-01-0{draw.randrange(1, 8)}", str(i % 40),
             draw.choice([None, "", "t1", "t2"]), draw.choice(["", "c1", "c2", None]), draw.choice(["x>y", "", None]),
             draw.choice(["{}", "", '{"a":1}'])) for i in range(300)]
    daily = spark.createDataFrame(rows, "sku_id string, region string, dt string, snapshot_time string, product_title string, "
                                        "category string, sub_category string, extra_json string")
    whole = sorted(map(str, crawl.sku_dimension(daily).collect()))
    days = sorted({r[2] for r in rows})
    for order in (days, days[::-1], [*days[3:], *days[:3], days[0]]):
        path = str(tmp_path / str(len(order) + (order[0] == days[0])) / order[0])
        for day in order:
            crawl.add_day(path, daily.filter(F.col("dt") == day))
        assert sorted(map(str, crawl.dimension_from_state(spark, path).collect())) == whole
        assert len(crawl._versions(spark, path)) == 1
