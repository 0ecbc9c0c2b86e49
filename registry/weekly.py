"""Weekly forecast from review counts, and its calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import forecast as O
from shelfwise.plans import weekly as P

from .base import Registry

R = Registry()
QUERIES, ORACLE = R.queries, R.sql


def _week(n: int) -> str:
    return f"CAST(CAST(CAST(a.next_week_dt AS DATE) - INTERVAL {7 * n} DAY AS DATE) AS VARCHAR)"


_FEATURES = f"""
features AS (SELECT a.*, b.comments_number AS p1, c.comments_number AS p2, d.comments_number AS p3,
    a.comments_number - coalesce(b.comments_number, 0) AS comments_number_diff,
    round(date_diff('second', CAST(coalesce(b.snapshot_time, a.snapshot_time) AS TIMESTAMP), CAST(a.snapshot_time AS TIMESTAMP))
      / 86400.0e0, 2) AS days_diff
  FROM weekly_reviews a
  LEFT JOIN weekly_reviews b ON a.product_id = b.product_id AND b.next_week_dt = {_week(1)}
  LEFT JOIN weekly_reviews c ON a.product_id = c.product_id AND c.next_week_dt = {_week(2)}
  LEFT JOIN weekly_reviews d ON a.product_id = d.product_id AND d.next_week_dt = {_week(3)}
  WHERE a.next_week_dt = (SELECT max(next_week_dt) FROM weekly_reviews))
"""
_FORECAST = """
factors(category_id, category_name, base, comments_weight) AS (VALUES
  ('31389', '智能儿童手表', 0.5e0, 1.2e0), ('17410', '家庭影院', 0.3e0, 0.7e0), ('12347', '智能手环', 0.5e0, 1.0e0),
  ('862', '手机耳机', 0.7e0, 1.1e0), ('842', '蓝牙/无线耳机', 0.7e0, 1.1e0), ('12597', '智能健康', 0.4e0, 0.9e0),
  ('12352', '智能配饰', 0.3e0, 0.8e0), ('863', '蓝牙耳机', 0.7e0, 1.1e0), ('12348', '智能手表', 0.6e0, 1.0e0),
  ('39284', '智能饰品', 0.3e0, 0.8e0), ('16961', '翻译机/翻译设备', 0.2e0, 0.6e0), ('17413', '回音壁/Soundbar音响', 0.3e0, 0.7e0),
  ('38678', '智能戒指', 0.3e0, 0.8e0), ('12350', '运动跟踪器', 0.5e0, 1.0e0), ('43533', '运动手表', 0.6e0, 1.0e0),
  ('12417', '多功能手表', 0.6e0, 1.0e0)),
states AS (SELECT *, CASE WHEN comments_number > 0 THEN CASE WHEN p1 IS NULL THEN CASE WHEN comments_number >= 100 THEN -3 ELSE -2 END ELSE 0 END
    WHEN p1 IS NULL THEN -1 WHEN p1 > 0 THEN 1 WHEN p2 IS NULL THEN 1 WHEN p2 > 0 THEN 2 WHEN p3 IS NULL THEN 2 WHEN p3 > 0 THEN 3 ELSE 4 END AS state
  FROM features),
scored AS (SELECT s.* EXCLUDE (category_name), f.category_name,
    (ln(1 + CASE WHEN comments_number_diff > 0 THEN comments_number_diff ELSE comments_number END) * 10 + comments_score * 5)
      * (base + ln(1 + comments_number) / 100 * comments_weight) AS raw,
    CASE state WHEN -3 THEN 0.9e0 WHEN -2 THEN 0.8e0 WHEN -1 THEN 0.3e0 WHEN 0 THEN 1.0e0 WHEN 1 THEN 0.5e0 WHEN 2 THEN 0.2e0
      WHEN 3 THEN 0.1e0 ELSE 0.0e0 END AS decay
  FROM states s JOIN factors f USING (category_id)),
predicted AS (SELECT sku_id, category_id, category_name, comments_number, comments_score,
    CAST(round_even(CASE WHEN days_diff > 0 THEN raw * 7 / days_diff ELSE raw END * decay, 0) AS BIGINT) AS predicted_weekly_sales,
    comments_number_diff, days_diff, dt, '20240205' AS prediction_dt, next_week_dt FROM scored)
"""


@R.add("weekly_features", f"""
WITH {_FEATURES.strip()} SELECT sku_id, product_id, category_id, next_week_dt, comments_number, comments_score,
  p1 AS comments_number_prev1, p2 AS comments_number_prev2, p3 AS comments_number_prev3, comments_number_diff, days_diff FROM features
""", ("weekly_reviews",))
def _(v):
    return O.weekly_features(v.stored("weekly_reviews")).select(
        "sku_id", "product_id", "category_id", "next_week_dt", "comments_number", "comments_score",
        *[f"comments_number_prev{n}" for n in (1, 2, 3)], "comments_number_diff", "days_diff")


@R.add("review_states", f"""
WITH {_FEATURES.strip()}, {_FORECAST.strip()} SELECT sku_id, CAST(state AS INT) AS review_state FROM states
""", ("weekly_reviews",))
def _(v):
    return O.weekly_features(v.stored("weekly_reviews")).select("sku_id", O.review_state().alias("review_state"))


@R.add("weekly_forecast", f"""
WITH {_FEATURES.strip()}, {_FORECAST.strip()} SELECT * FROM predicted
""", ("weekly_reviews",))
def _(v):
    return P.weekly_forecast(v.stored("weekly_reviews"), prediction_dt="20240205")


@R.add("forecast_summary", f"""
WITH {_FEATURES.strip()}, {_FORECAST.strip()}
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(predicted_weekly_sales), 9) AS avg_sales, min(predicted_weekly_sales) AS min_sales,
  max(predicted_weekly_sales) AS max_sales, CAST(count(*) FILTER (comments_number_diff > 0) AS BIGINT) AS n_up,
  CAST(count(*) FILTER (comments_number_diff = 0) AS BIGINT) AS n_same, CAST(count(*) FILTER (comments_number_diff < 0) AS BIGINT) AS n_down
FROM predicted
""", ("weekly_reviews",))
def _(v):
    return O.forecast_summary(P.weekly_forecast(v.stored("weekly_reviews"))).withColumn("avg_sales", F.round("avg_sales", 9))


@R.add("forecast_calibrated", f"""
WITH {_FEATURES.strip()}, {_FORECAST.strip()},
monthly AS (SELECT sku_id, CAST(substr(next_week_dt, 1, 7) || '-01' AS VARCHAR) AS month_dt, CAST(sum(comments_number) AS BIGINT) AS units,
    CAST(max(comments_score) AS BIGINT) AS kind FROM weekly_reviews GROUP BY 1, 2),
base AS (SELECT p.*, 31 AS days, strftime(date_trunc('month', CAST(next_week_dt AS DATE) - INTERVAL 1 DAY) - INTERVAL 1 MONTH, '%Y-%m-%d') AS m FROM predicted p),
j AS (SELECT base.*, pr.units AS c, se.units AS b FROM base
  LEFT JOIN (SELECT sku_id, month_dt, units * 3 AS units FROM monthly WHERE kind = 1) pr ON base.sku_id = pr.sku_id AND pr.month_dt = base.m
  LEFT JOIN (SELECT sku_id, month_dt, units * CASE kind WHEN 2 THEN 4000 WHEN 3 THEN 1 ELSE 50 END AS units FROM monthly WHERE kind <> 1) se
    ON base.sku_id = se.sku_id AND se.month_dt = base.m),
r AS (SELECT *, CAST(round(b * 7.0e0 / days) AS BIGINT) AS bw, CAST(round(b * 7.0e0 / days * 0.9e0) AS BIGINT) AS lo, CAST(round(b * 7.0e0 / days * 10) AS BIGINT) AS hi,
    CAST(round(c * 7.0e0 / days) AS BIGINT) AS cw, predicted_weekly_sales AS f FROM j)
SELECT sku_id, category_id, category_name, comments_number, comments_score, predicted_weekly_sales,
  CASE WHEN days_diff = 0 THEN 0 ELSE comments_number_diff END AS comments_number_diff, days_diff,
  coalesce(CASE WHEN c >= 0 THEN c END, CASE WHEN b > 0 THEN b END) AS origin_count,
  CASE WHEN c >= 0 THEN greatest(cw, CASE WHEN c > 0 THEN 1 ELSE 0 END)
    WHEN b > 0 AND f < lo THEN CASE WHEN f * 21 < greatest(bw, 1) THEN f * 21 ELSE greatest(bw, 1) END
    WHEN b > 0 AND f > hi THEN CASE WHEN f * 0.8e0 < hi THEN CAST(trunc(f * 0.8e0) AS BIGINT) ELSE hi END ELSE f END AS weekly_count,
  CASE WHEN c >= 0 THEN 'monthly_sales_wide' WHEN b > 0 AND f < lo THEN CASE WHEN bw < f * 21 THEN 'monthly_sales_origin' ELSE 'sales_prediction' END
    WHEN b > 0 AND f > hi THEN CASE WHEN hi < f * 0.8e0 THEN 'monthly_sales_origin' ELSE 'sales_prediction' END ELSE 'sales_prediction' END AS weekly_count_src,
  dt, prediction_dt, next_week_dt FROM r
""", ("weekly_reviews",))
def _(v):
    month = F.concat(F.substring("next_week_dt", 1, 7), F.lit("-01")).alias("month_dt")
    monthly = v.stored("weekly_reviews").groupBy("sku_id", month).agg(
        F.sum("comments_number").alias("units"), F.max("comments_score").cast("bigint").alias("kind"))
    primary = monthly.filter("kind = 1").withColumn("units", F.col("units") * 3)
    scale = F.when(F.col("kind") == 2, 4000).when(F.col("kind") == 3, 1).otherwise(50)
    secondary = monthly.filter("kind <> 1").withColumn("units", F.col("units") * scale)
    predicted = P.weekly_forecast(v.stored("weekly_reviews"), prediction_dt="20240205")
    return P.calibrated_forecast(predicted, primary, secondary, "monthly_sales_wide", "monthly_sales_origin")
