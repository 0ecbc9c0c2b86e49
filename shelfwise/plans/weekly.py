"""Weekly sales forecast and its calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..operators.forecast import calibrate, coefficients, forecast, weekly_features
from ..sources.scans import conform


def weekly_forecast(
    reviews: DataFrame, factors: DataFrame | None = None, week: str | None = None, prediction_dt: str | None = None,
) -> DataFrame:
    """Forecast of the newest (or given) week.

    Products of categories without a factor are left out of the scan of the reviews. The factors are a table of
    settings with a row per category.
    """
    factors = coefficients(reviews.sparkSession) if factors is None else factors
    week = week or reviews.agg(F.max("next_week_dt")).first()[0]
    wanted = [r["category_id"] for r in factors.select("category_id").distinct().collect()]
    asked = reviews.filter(F.col("category_id").isin(*wanted) | (F.col("next_week_dt") != week))
    return conform(forecast(weekly_features(asked, week), factors, prediction_dt=prediction_dt), S.WEEKLY_FORECAST)


def calibrated_forecast(
    predicted: DataFrame, primary: DataFrame, secondary: DataFrame, primary_label: str, secondary_label: str,
) -> DataFrame:
    return conform(calibrate(predicted, primary, secondary, primary_label, secondary_label), S.CALIBRATED_FORECAST)
