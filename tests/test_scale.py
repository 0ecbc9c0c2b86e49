"""Plan shapes: what must hold whatever the size of the data."""

import contextlib
import math
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfwise.operators import collapse, forecast, history, joins, prices, rules as R
from shelfwise.operators.rules import Rule, RuleSet
from shelfwise.plans import crawl
from shelfwise.sources import checkpoints, scans, sinks


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("_", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, n=1000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("sku_id"), F.lit("US").alias("region"),
        F.lit("2024-01-01").alias("dt"), F.col("id").cast("string").alias("snapshot_time"), F.lit("a").alias("etl_source"),
        F.lit("t").alias("product_title"), F.col("id").cast("string").alias("product_id"),
        (F.col("id") % 9).cast("double").alias("sku_online_price"), (F.col("id") % 7).cast("double").alias("sku_list_price"),
        F.lit("USD").alias("sku_online_price_currency"), F.lit("EUR").alias("sku_list_price_currency"))


def test_collapses_have_no_window_and_fold_before_the_shuffle(spark):
    rows = facts(spark)
    for df in (crawl.sku_daily(rows, ["a"], ["product_id", "product_title"]), crawl.price_daily(rows),
               crawl.price_monthly(rows), collapse.keep_first(rows, ["sku_id"], [F.col("dt")])):
        text = plan(df)
        assert "Window" not in text
        # In the printed plan the partial aggregate stands below (after) the exchange line that ships its rows.
        assert "partial_" in text and text.index("Exchange") < text.rindex("partial_")


def test_prices_need_no_join(spark):
    assert "Join" not in plan(crawl.price_daily(facts(spark))) + plan(crawl.price_monthly(facts(spark)))


def test_a_hot_key_reaches_the_second_step_as_one_row_per_price(spark):
    counted = prices._histogram(facts(spark), ["sku_id"], {"sku_list_price": {}})
    assert counted.filter("sku_id = 'hot'").count() == 7   # six valid prices and the invalid ones


def test_rules_stay_in_the_jvm(spark):
    rules = RuleSet(1, [Rule(1, {"sku_id": "hot"}, {"product_title": "x"})])
    text = plan(R.apply_rules(facts(spark), rules, {"product_title": "product_title"}, "src"))
    assert "Python" not in text and "Exchange" not in text


def test_filters_pass_below_rules(spark, tmp_path):
    path = str(tmp_path / "t")
    facts(spark).write.partitionBy("dt").parquet(path)
    rules = RuleSet(1, [Rule(1, {"sku_id": "hot"}, {"product_title": "x"})])
    out = R.apply_rules(spark.read.parquet(path), rules, {"product_title": "product_title"}).filter(
        "dt = '2024-01-01' AND region = 'US'").select("sku_id", "product_title")
    text = plan(out)
    assert "EqualTo(region,US)" in text and re.search(r"PartitionFilters: \[[^\]]*dt", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "sku_list_price" not in schema


def test_group_totals_split_a_hot_key(spark):
    """A third of all rows share one key; adaptive execution reads that key's rows in several tasks."""
    with settings(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }):
        # The payload does not compress, so that the sizes of the shuffled partitions differ as the row counts do.
        rows = facts(spark, 60000).withColumn("payload", F.sha2("snapshot_time", 512)).repartition(8)
        out = history.total_over(rows, ["sku_id"], "sku_online_price", "total")
        counted = out.agg(F.sum("total"), F.count(F.lit(1)), F.max("payload"))
        assert counted.collect()[0][1] == 60000
        assert "skewed" in plan(counted)


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("hot", ["hot", None])
def test_joins_with_aggregates_split_a_hot_key(spark, hot):
    """A third of all rows share one key, or have none."""
    with settings(spark, **SKEWED):
        rows = facts(spark, 60000).withColumn("payload", F.sha2("snapshot_time", 512)).withColumn(
            "sku_id", F.when(F.col("sku_id") == "hot", F.lit(hot)).otherwise(F.col("sku_id"))).repartition(8)
        totals = rows.groupBy("sku_id").agg(F.sum("sku_online_price").alias("total"))
        out = joins.enrich_by(rows, totals, ["sku_id"])
        counted = out.agg(F.count("total"), F.count(F.lit(1)), F.max("payload"))
        found, n, _ = counted.collect()[0]
        assert (found, n) == (60000 if hot else 40000, 60000)
        assert "skewed" in plan(counted)


def test_lookup_rules_split_a_hot_key(spark):
    with settings(spark, **SKEWED):
        rows = facts(spark, 60000).withColumn("payload", F.sha2("snapshot_time", 512)).repartition(8)
        table = rows.select("sku_id", F.lit(1).alias("priority"), F.lit("x").alias("title"))
        out = R.apply_lookup(rows, table, ["sku_id"], {"title": "product_title"}, 7, "src")
        counted = out.agg(F.count(F.lit(1)), F.max("payload"), F.max("src"))
        assert counted.collect()[0][0] == 60000
        assert "skewed" in plan(counted)


def test_calibration_reads_the_months_it_needs(spark, tmp_path):
    path = str(tmp_path / "monthly")
    spark.createDataFrame([(str(i), f"2024-0{m}-01", i) for i in range(4) for m in (1, 2, 3)],
                          "sku_id string, month_dt string, units long").write.partitionBy("month_dt").parquet(path)
    predicted = spark.createDataFrame(
        [(str(i), "2024-03-11", 10 * i, 1, 1.0) for i in range(4)],
        "sku_id string, next_week_dt string, predicted_weekly_sales long, comments_number_diff long, days_diff double")
    monthly = spark.read.parquet(path)
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(forecast.calibrate(predicted, monthly, monthly, "a", "b"))
    pushed = re.findall(r"PartitionFilters: \[(.*?)\], ", text)
    assert pushed and all("2024-02-01" in p for p in pushed)


def test_month_scan_is_pruned(spark, tmp_path):
    path = str(tmp_path / "daily")
    days = spark.createDataFrame([(f"2024-0{m}-{d:02d}",) for m in (1, 2, 3) for d in (1, 15)], "dt string")
    facts(spark).drop("dt").join(F.broadcast(days)).write.partitionBy("dt").parquet(path)
    monthly = crawl.price_monthly(spark.read.parquet(path), run_date="2024-03-10")
    text = plan(monthly)
    pushed = re.search(r"PartitionFilters: \[(.*?)\], ", text).group(1)
    assert "2024-02-01" in pushed and "2024-02-29" in pushed
    assert {r["month_dt"] for r in monthly.collect()} == {"2024-02-01"}


@pytest.mark.parametrize("name", ["price_daily", "sales_wide", "fixed_count", "conditional_key_join", "brand_gate"])
def test_no_nested_loop_join(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_sinks_do_not_shuffle_without_a_file_count(spark):
    df = facts(spark)
    assert sinks.layout(df) is df


def test_source_has_no_local_checkpoint_or_collect_of_tables():
    import pathlib

    code = "\n".join(p.read_text(encoding="utf8") for p in pathlib.Path(scans.__file__).parents[1].rglob("*.py"))
    assert "localCheckpoint" not in code and "toPandas" not in code and "crossJoin(df" not in code


def test_sums_do_not_depend_on_the_order_of_additions(spark):
    draw = random.Random(4)
    values = [draw.choice([1e-9, 1.1, 1e7, -1e7, 1e15, -1e15, 1e30, -1e30]) * draw.choice([1, 1, 0.3]) for _ in range(3000)]
    rows = [(i % 3, v if i % 3 else v / 1e25, i) for i, v in enumerate(values) if abs(v) < 1e25 or i % 3 == 0] + [(9, None, 0)]
    df = spark.createDataFrame(rows, "k int, v double, i int")
    seen = {tuple(sorted(map(tuple, prices.group_avg(df.repartition(n, "i"), ["k"], "v", F.lit(True)).collect()))) for n in (1, 4, 200)}
    assert len(seen) == 1
    got = dict(seen.pop())
    assert got[9] is None
    for k in (1, 2):
        exact = [Fraction(v) for g, v, _ in rows if g == k]
        assert abs(Fraction(got[k]) - sum(exact) / len(exact)) <= sum(map(abs, exact)) / len(exact) / 10**13
    odd = spark.createDataFrame([(1, math.inf), (1, 1.0), (2, math.nan), (2, 1.0)], "k int, v double")
    assert str(sorted(map(tuple, prices.group_avg(odd, ["k"], "v", F.lit(True)).collect()))) == "[(1, inf), (2, nan)]"


@pytest.mark.parametrize("join", [
    lambda df, right: joins.enrich_by(df, right, ["k"]),
    lambda df, right: joins.override(df, right, ["k"], "name", "new", "label", "src"),
])
def test_rows_with_a_null_key_are_spread(spark, join):
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_enabled="false"):
        df = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 100).alias("k"), F.lit("a").alias("name"))
        right = spark.range(200).select((F.col("id") % 50).alias("k"), F.col("id").cast("string").alias("new")).groupBy("k").agg(
            F.max("new").alias("new"))
        out = join(df, right)
        assert out.count() == 20_000
        per_task = [r.n for r in out.groupBy(F.spark_partition_id().alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(per_task) < 20_000 / 3 and len(per_task) == 8
        hit = out.filter("new IS NOT NULL" if "new" in out.columns else "src IS NOT NULL")
        assert hit.count() == df.filter("k < 50").count()


def sliced_facts(spark):
    """Keys that repeat, a hot one, NULL days, blank values and JSON objects, valid or not."""
    i = F.col("id")
    nulls = [F.lit(None).cast("string").alias(f) for f in crawl.BEST_FIELDS
             if f not in ("product_id", "product_title", "has_sku", "category", "sub_category", "extra_json", "snapshot_time")]
    return spark.range(400).select(
        F.when(i % 3 == 0, "hot").otherwise((i % 40).cast("string")).alias("sku_id"), F.when(i % 2 == 0, "US").otherwise("DE").alias("region"),
        F.when(i % 7 == 0, None).otherwise(F.concat(F.lit("2024-01-0"), i % 5)).alias("dt"),
        F.when(i % 11 == 0, "x").otherwise("a").alias("etl_source"), (i % 6).cast("string").alias("snapshot_time"),
        F.when(i % 4 == 0, "").otherwise(F.concat(F.lit("t"), i % 9)).alias("product_title"), (i % 13).cast("string").alias("product_id"),
        (i % 2).cast("int").alias("has_sku"), F.when(i % 5 == 0, "c").alias("category"), (i % 8).cast("string").alias("sub_category"),
        F.when(i % 3 == 1, F.concat(F.lit('{"a":'), i % 10, F.lit(', "k'), i % 4, F.lit('":1}'))).when(i % 3 == 2, "{}").alias("extra_json"),
        *nulls)


def test_a_fact_is_collapsed_slice_by_slice(spark):
    rows, seen = sliced_facts(spark), []
    whole = sorted(map(str, crawl.sku_daily(rows, ["a"]).collect()))
    out = crawl.sku_daily_sliced(rows, ["a"], rows=150)
    assert sorted(map(str, out.collect())) == whole
    assert "Exchange" not in plan(out)  # nothing wide is left to the caller's job
    assert sorted(map(str, crawl.sku_daily_sliced(rows, ["a"]).collect())) == whole

    def work(part):
        seen.append((part.count(), {tuple(r) for r in part.select("sku_id", "region").distinct().collect()}))
        return part

    again = checkpoints.in_slices(rows, ["sku_id", "region"], work, "test", 60)
    assert again.count() == 400 == sum(n for n, _ in seen) and len(seen) > 3
    assert sum(len(keys) for _, keys in seen) == len(set().union(*[keys for _, keys in seen]))  # no key in two slices
    folders = {f.rsplit("/", 1)[0] for f in again.inputFiles()}
    assert len(folders) == len(seen) and not any("slices" in f for f in folders)


def test_the_dimension_of_a_fact_is_made_slice_by_slice(spark):
    rows = sliced_facts(spark)
    whole = sorted(map(str, crawl.sku_dimension(crawl.sku_daily(rows, ["a"])).collect()))
    out = crawl.sku_dimension_of_fact(rows, ["a"], rows=150)
    assert sorted(map(str, out.collect())) == whole
    assert "Exchange" not in plan(out)
