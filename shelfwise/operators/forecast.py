"""Weekly sales from review counts, and calibration against monthly sales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .joins import enrich_by, period_before

STANDARD_DAYS = 7
# Reviews from which a product without history counts as an old product that was missed. Fixed value.
MISSED_FROM = 100
# Factor per review state (see review_state). Fixed values.
DECAY = {-3: 0.9, -2: 0.8, -1: 0.3, 0: 1.0, 1: 0.5, 2: 0.2, 3: 0.1, 4: 0.0}
# category id, name, base, comments weight. Fixed values.
COEFFICIENTS = (
    ("31389", "智能儿童手表", 0.5, 1.2),
    ("17410", "家庭影院", 0.3, 0.7),
    ("12347", "智能手环", 0.5, 1.0),
    ("862", "手机耳机", 0.7, 1.1),
    ("842", "蓝牙/无线耳机", 0.7, 1.1),
    ("12597", "智能健康", 0.4, 0.9),
    ("12352", "智能配饰", 0.3, 0.8),
    ("863", "蓝牙耳机", 0.7, 1.1),
    ("12348", "智能手表", 0.6, 1.0),
    ("39284", "智能饰品", 0.3, 0.8),
    ("16961", "翻译机/翻译设备", 0.2, 0.6),
    ("17413", "回音壁/Soundbar音响", 0.3, 0.7),
    ("38678", "智能戒指", 0.3, 0.8),
    ("12350", "运动跟踪器", 0.5, 1.0),
    ("43533", "运动手表", 0.6, 1.0),
    ("12417", "多功能手表", 0.6, 1.0),
)
# Names of the tables whose bound was used, as noted by calibrate. Fixed value.
FORECAST_SRC = "sales_prediction"


def coefficients(spark: SparkSession, rows: Sequence[tuple] = COEFFICIENTS) -> DataFrame:
    return spark.createDataFrame(
        list(rows), "category_id string, category_name string, base double, comments_weight double")


def weekly_features(df: DataFrame, week: str | None = None, weeks: int = 3, period: str = "next_week_dt") -> DataFrame:
    """Rows of one week (the newest by default) with review counts of the weeks before.

    Adds ``comments_number_prev1..n``, ``comments_number_diff`` (previous week missing: 0) and ``days_diff``
    (elapsed days to the previous week's snapshot, 2 digits, missing: 0). Each week is read once, and the weeks
    before are folded to one row per product. Without ``week`` one small job looks up the newest week.
    """
    week = week or df.agg(F.max(period)).first()[0]
    if week is None:
        raise ValueError("there is no week to forecast")
    # Constants, so that the scans of this week and of the weeks before are pruned by literal values.
    earlier = {n: period_before(F.lit(week), n) for n in range(1, weeks + 1)}
    current = df.filter(F.col(period) == week)
    history = df.filter(F.col(period).isin(*earlier.values())).groupBy("product_id").agg(
        *[F.max(F.when(F.col(period) == at, F.col("comments_number"))).alias(f"comments_number_prev{n}")
          for n, at in earlier.items()],
        F.max(F.when(F.col(period) == earlier[1], F.col("snapshot_time"))).alias("_before"),
    )
    seconds = F.unix_timestamp(F.col("snapshot_time").cast("timestamp")) - F.unix_timestamp(
        F.coalesce("_before", "snapshot_time").cast("timestamp"))
    return current.join(history, "product_id", "left").withColumns({
        "comments_number_diff": F.col("comments_number") - F.coalesce("comments_number_prev1", F.lit(0)),
        "days_diff": F.round(seconds.cast("double") / 86400.0, 2),
    }).drop("_before")


def review_state(missed_from: int = MISSED_FROM) -> Column:
    """-3 no history and many reviews, -2 no history and some, -1 no history and none, 0 history and reviews,
    1-4 consecutive weeks without reviews (an absent week ends the count)."""
    now, p1, p2, p3 = (F.col(c) for c in (
        "comments_number", "comments_number_prev1", "comments_number_prev2", "comments_number_prev3"))
    return (
        F.when(p1.isNull() & (now > 0), F.when(now >= missed_from, -3).otherwise(-2))
        .when(p1.isNull(), -1)
        .when(now > 0, 0)
        .when((p1 > 0) | p2.isNull(), 1)
        .when((p2 > 0) | p3.isNull(), 2)
        .when(p3 > 0, 3)
        .otherwise(4)
    )


def forecast(
    features: DataFrame, factors: DataFrame, decay: Mapping[int, float] = DECAY, prediction_dt: str | None = None,
) -> DataFrame:
    """Predicted units per product for 7 days.

    log1p(reviews) * 10 + score * 5, times the category factor, scaled from elapsed days to 7 days, times the
    decay of the review state; NaN and infinity count as 0 and the result is rounded half to even. Products of
    categories without a factor drop out.
    """
    effective = F.when(F.col("comments_number_diff") > 0, F.col("comments_number_diff")).otherwise(
        F.col("comments_number"))
    raw = F.log1p(effective) * 10 + F.col("comments_score") * 5
    factor = F.col("base") + F.log1p(F.col("comments_number")) / 100 * F.col("comments_weight")
    adjusted = raw * factor
    days = F.col("days_diff")
    weekly = F.when(days > 0, adjusted * STANDARD_DAYS / days).otherwise(adjusted)
    decayed = weekly * F.element_at(
        F.create_map(*[F.lit(x) for kv in decay.items() for x in kv]), F.col("review_state"))
    finite = F.coalesce(F.nanvl(decayed, F.lit(0.0)), F.lit(0.0))
    finite = F.when(F.abs(finite) == float("inf"), F.lit(0.0)).otherwise(finite)
    stamped = F.lit(prediction_dt) if prediction_dt else F.date_format(F.current_date(), "yyyyMMdd")
    names = factors.select("category_id", F.col("category_name").alias("_name"), "base", "comments_weight")
    return (
        features.withColumn("review_state", review_state()).join(names, "category_id")
        .withColumn("category_name", F.col("_name"))
        .withColumn("predicted_weekly_sales", F.bround(finite).cast("bigint"))
        .withColumn("prediction_dt", stamped)
        .drop("_name", "base", "comments_weight")
    )


def previous_month_of(week: Column | str) -> Column:
    """First day of the month before the month of the day before ``week``."""
    c = F.col(week) if isinstance(week, str) else week
    return F.date_format(F.add_months(F.trunc(F.date_sub(F.to_date(c), 1), "MM"), -1), "yyyy-MM-dd")


def calibrate(
    predicted: DataFrame, primary: DataFrame, secondary: DataFrame,
    primary_label: str, secondary_label: str,
    low: float = 0.9, high: float = 10, up: float = 21, down: float = 0.8,
) -> DataFrame:
    """Fit a week's forecast to the monthly sales of the month before.

    ``primary(sku_id, month_dt, units)`` wins as it is, scaled to a week (at least 1 if it sold). Else
    ``secondary`` bounds the forecast: below ``low`` of its weekly value the forecast rises to that value, but at
    most ``up``-fold; above ``high`` times it falls to that bound or to ``down`` of itself, whichever is smaller.
    Both tables are summed per SKU and month first, so rows never multiply. They are read for the months that the
    forecast asks for, as literal values: one small job looks up its weeks, of which a run has one.
    """
    rows = predicted.withColumn("_month", previous_month_of("next_week_dt"))
    months = [r["_month"] for r in rows.select("_month").distinct().collect() if r["_month"]]

    def monthly(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col("month_dt").isin(*months)).groupBy(
            F.col("sku_id").cast("string").alias("sku_id"), F.col("month_dt").alias("_month")).agg(
            F.sum("units").alias(name))

    keys = ["sku_id", "_month"]
    joined = enrich_by(enrich_by(rows, monthly(primary, "_primary"), keys), monthly(secondary, "_secondary"), keys)
    days = F.day(F.last_day(F.to_date("_month")))
    p, s, own = F.col("_primary"), F.col("_secondary"), F.col("predicted_weekly_sales")

    def weekly(units: Column, times: float = 1.0) -> Column:
        return F.round(units * 7.0 / days * F.lit(times)).cast("bigint")

    sold = F.when(s > 0, 1).otherwise(0).cast("bigint")
    floor, ceiling = F.greatest(weekly(s), sold), weekly(s, float(high))
    raised, lowered = own.cast("double") * up, own.cast("double") * down
    use_primary, use_secondary = F.coalesce(p >= 0, F.lit(False)), F.coalesce(s > 0, F.lit(False))
    too_low, too_high = own < weekly(s, low), own > ceiling
    count = (
        F.when(use_primary, F.greatest(weekly(p), F.when(p > 0, 1).otherwise(0).cast("bigint")).cast("double"))
        .when(use_secondary & too_low, F.least(raised, floor.cast("double")))
        .when(use_secondary & too_high, F.least(lowered, ceiling.cast("double")))
        .otherwise(own.cast("double"))
    )
    # The raising bound is compared before the "at least 1" rule; equal bounds count as the forecast's own.
    source = (
        F.when(use_primary, F.lit(primary_label))
        .when(use_secondary & too_low & (weekly(s).cast("double") < raised), F.lit(secondary_label))
        .when(use_secondary & ~too_low & too_high & (ceiling.cast("double") < lowered), F.lit(secondary_label))
        .otherwise(F.lit(FORECAST_SRC))
    )
    return joined.withColumns({
        "comments_number_diff": F.when(F.col("days_diff") == 0, F.lit(0)).otherwise(F.col("comments_number_diff")),
        "origin_count": F.coalesce(F.when(use_primary, p), F.when(use_secondary, s)).cast("bigint"),
        "weekly_count": count.cast("bigint"),
        "weekly_count_src": source,
    }).drop("_month", "_primary", "_secondary")


def forecast_summary(predicted: DataFrame) -> DataFrame:
    """Counts and range of the forecast, and signs of the review difference, in one row."""
    sales, diff = F.col("predicted_weekly_sales"), F.col("comments_number_diff")
    return predicted.agg(
        F.count(F.lit(1)).alias("n"), F.avg(sales).alias("avg_sales"), F.min(sales).alias("min_sales"),
        F.max(sales).alias("max_sales"), F.count_if(diff > 0).alias("n_up"), F.count_if(diff == 0).alias("n_same"),
        F.count_if(diff < 0).alias("n_down"),
    )
