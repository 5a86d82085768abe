"""Fixed-order forecasting: AR(1) fits, forecasts and flags as column expressions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .series import steps_between

PROBABILITY = 0.99


def z_limit(probability: float = PROBABILITY) -> float:
    """Deviations beyond which a value lies outside the interval of ``probability``."""
    return NormalDist().inv_cdf((1 + probability) / 2)


def with_lag(series: DataFrame) -> DataFrame:
    order = Window.partitionBy("series_id").orderBy("bucket")
    return series.withColumn("y_lag", F.lag("y", 1).over(order))


def fit_ar1(series: DataFrame) -> DataFrame:
    """``(series_id, n, phi, intercept, sigma, last_bucket, last_y)`` per series.

    Series that are too short, constant or not stationary have no row.
    """
    y, x = F.col("y"), F.col("y_lag")
    sse = F.greatest(F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x), F.lit(0.0))
    n = F.regr_count(y, x)
    fits = (
        with_lag(series)
        .groupBy("series_id")
        .agg(
            n.alias("n"),
            F.regr_slope(y, x).alias("phi"),
            F.regr_intercept(y, x).alias("intercept"),
            F.sqrt(F.try_divide(sse, n)).alias("sigma"),
            F.max("bucket").alias("last_bucket"),
            F.max_by("y", "bucket").alias("last_y"),
        )
    )
    return fits.where((F.abs("phi") < 1) & (F.col("sigma") > 0))


def score_in_sample(models: DataFrame, series: DataFrame) -> DataFrame:
    """One-step forecasts of the buckets the model was trained on."""
    rows = with_lag(series).join(models, "series_id").where(F.col("y_lag").isNotNull())
    forecast = F.col("intercept") + F.col("phi") * F.col("y_lag")
    return rows.select(
        "series_id", "bucket", "y", forecast.alias("forecast"), F.col("sigma").alias("se")
    )


def score_ahead(models: DataFrame, recent: DataFrame, unit: str) -> DataFrame:
    """h-step forecasts of the buckets after the training window."""
    rows = recent.join(models, "series_id").where(F.col("bucket") > F.col("last_bucket"))
    h = steps_between(F.col("last_bucket"), F.col("bucket"), unit)
    mean = F.col("intercept") / (1 - F.col("phi"))
    forecast = mean + F.pow("phi", h) * (F.col("last_y") - mean)
    variance = (1 - F.pow("phi", 2 * h)) / (1 - F.col("phi") * F.col("phi"))
    return rows.select(
        "series_id",
        "bucket",
        "y",
        forecast.alias("forecast"),
        (F.col("sigma") * F.sqrt(variance)).alias("se"),
    )


def is_outside(probability: float = PROBABILITY) -> Column:
    return F.abs((F.col("y") - F.col("forecast")) / F.col("se")) > z_limit(probability)


def detect_anomalies(scored: DataFrame, probability: float = PROBABILITY) -> DataFrame:
    """Scored buckets with their interval and the flag ``is_anomaly``."""
    half = F.col("se") * z_limit(probability)
    return scored.select(
        "*",
        (F.col("forecast") - half).alias("low"),
        (F.col("forecast") + half).alias("high"),
        is_outside(probability).alias("is_anomaly"),
    )


def anomaly_check(flags: DataFrame) -> DataFrame:
    """Number of flagged buckets."""
    return flags.agg(F.count_if("is_anomaly").alias("failed_count"))
