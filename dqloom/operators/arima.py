"""Automatic-order ARIMA fits and forecasts for many series at once.

Two-stage least squares (Hannan and Rissanen 1982): a long autoregression gives
residuals, whose lags join the regressors of the second stage. Both stages are one
aggregation of cross products per series, so Spark carries the rows; Python only solves
systems of a dozen unknowns, one row per series. The difference order follows the
stationarity statistic of Kwiatkowski et al. 1992, the order (p, q) is the one with
the lowest AIC on a common sample.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .arima_solve import choose_order, forecast_rows, solve_long
from .series import moved, phase_of, season_offsets, steps_between

MAX_ORDER = 5
# Fixed value: 5% point of the level-stationarity statistic.
KPSS_LIMIT = 0.463


def _in_order():
    return Window.partitionBy("series_id").orderBy("bucket")


def difference_order(series: DataFrame) -> DataFrame:
    """``(series_id, n, kpss, d)``: d is 1 where the level is not stationary.

    The longest series, counted first, says how many lags there are.
    """
    longest = series.groupBy("series_id").count().agg(F.max("count")).first()[0] or 0
    lags = max(1, int(4 * (longest / 100) ** 0.25))
    mean = F.avg("y").over(Window.partitionBy("series_id"))
    centered = series.withColumn("e", F.col("y") - mean)
    so_far = _in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lagged = [F.lag("e", k).over(_in_order()).alias(f"e{k}") for k in range(1, lags + 1)]
    rows = centered.select("series_id", "e", F.sum("e").over(so_far).alias("s"), *lagged)
    covariances = [f"coalesce(sum(e * e{k}), 0D)" for k in range(1, lags + 1)]
    sums = rows.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.expr("sum(s * s)").alias("ss"),
        F.expr("sum(e * e)").alias("c0"),
        F.expr(f"array({', '.join(covariances)})").alias("c"),
    )
    width = F.floor(4 * F.pow(F.col("n") / 100, 0.25))
    weights = F.transform(
        F.sequence(F.lit(1), F.lit(lags)),
        lambda k: F.when(k <= width, 2 * (1 - k / (width + 1))).otherwise(F.lit(0.0)),
    )
    terms = F.zip_with(weights, "c", lambda w, c: w * c)
    weighted = F.col("c0") + F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
    kpss = F.try_divide(F.col("ss"), F.col("n") * weighted)
    return sums.select("series_id", "n", kpss.alias("kpss")).withColumn(
        "d", F.when(F.col("kpss") > KPSS_LIMIT, 1).otherwise(0)
    )


def _lag_columns(name: str, count: int) -> list[Column]:
    return [F.lag(name, k).over(_in_order()).alias(f"{name}{k}") for k in range(1, count + 1)]


def _lag_names(name: str, count: int) -> list[str]:
    return [f"{name}{k}" for k in range(1, count + 1)]


def _weighted(coefficients: str, names: Sequence[str]) -> Column:
    """Sum of coefficient times value over the entries the coefficient array has."""
    terms = [
        f"coalesce(get({coefficients}, {i}), 0D) * {name}" for i, name in enumerate(names)
    ]
    return F.expr(" + ".join(terms))


def _stationary(series: DataFrame, orders: DataFrame) -> DataFrame:
    """``z``: the series, differenced where its ``d`` is 1."""
    joined = series.join(orders, "series_id")
    change = F.col("y") - F.lag("y", 1).over(_in_order())
    z = F.when(F.col("d") == 1, change).otherwise(F.col("y"))
    return joined.withColumn("z", z).where(F.col("z").isNotNull())


def _with_residuals(rows: DataFrame, order: int) -> DataFrame:
    """Lags of ``z`` and ``e``, the residual of the long autoregression."""
    lagged = rows.select("*", *_lag_columns("z", order)).where(F.col(f"z{order}").isNotNull())
    fitted = F.col("long_intercept") + _weighted("long_ar", _lag_names("z", order))
    return lagged.withColumn("e", F.col("z") - fitted).select("*", *_lag_columns("e", order))


def _cross_products(
    rows: DataFrame, names: Sequence[str], others: Mapping[str, Column] | None = None
) -> DataFrame:
    """``(series_id, n, gram)``: upper triangle of all products of the named columns."""
    products = [
        F.expr(f"sum({a} * {b})") for a, b in combinations_with_replacement(names, 2)
    ]
    return rows.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*products).alias("gram"),
        *[column.alias(name) for name, column in (others or {}).items()],
    )


def fit_arima(
    series: DataFrame,
    unit: str,
    max_order: int = MAX_ORDER,
    order: tuple[int, int, int] | None = None,
    seasonal: bool = True,
) -> DataFrame:
    """One model row per series of ``(series_id, bucket, y)``; ``order`` fixes (p, d, q).

    Series that are too short, constant, or fit no stationary model have no row.
    """
    # several passes follow: the cuts keep what lies behind them from being redone
    series = cut_lineage(series.select("series_id", "bucket", "y"))
    phases = season_offsets(series, unit) if seasonal and unit in PHASED else None
    season = _season_maps(series, phases)
    adjusted = _without_season(series.join(season, "series_id"), unit)

    adjusted = cut_lineage(adjusted)
    orders = difference_order(adjusted)
    orders = orders.where(F.col("n") >= max_order + 3).select("series_id", "d")
    if order:
        orders = orders.withColumn("d", F.lit(order[1]))
    rows = _stationary(adjusted, orders).withColumn("one", F.lit(1.0))

    lagged = rows.select("*", *_lag_columns("z", max_order))
    names = _lag_names("z", max_order)
    first = _cross_products(lagged.where(F.col(names[-1]).isNotNull()), ["z", "one", *names])
    long_fit = first.mapInPandas(
        solve_long(max_order),
        "series_id string, long_intercept double, long_ar array<double>",
    )

    full = _with_residuals(rows.join(long_fit, "series_id"), max_order)
    errors = _lag_names("e", max_order)
    last = {
        "last_bucket": F.max("bucket"),
        "last_y": F.max_by("y", "bucket"),
        "last_z": F.max_by(F.array("z", *names[:-1]), "bucket"),
        "last_e": F.max_by(F.array("e", *errors[:-1]), "bucket"),
        "d": F.first("d"),
        "season": F.first("season"),
        "long_intercept": F.first("long_intercept"),
        "long_ar": F.first("long_ar"),
    }
    second = cut_lineage(
        _cross_products(
            full.where(F.col(errors[-1]).isNotNull()), ["z", "one", *names, *errors], last
        )
    )
    fits = second.select("series_id", "n", "gram").mapInPandas(
        choose_order(max_order, (order[0], order[2]) if order else None),
        "series_id string, n bigint, p int, q int, intercept double, ar array<double>, "
        "ma array<double>, sigma double, aic double",
    )
    models = fits.join(second.drop("n", "gram"), "series_id")
    # one row per series: later readers do not fit again
    return cut_lineage(models.withColumn("unit", F.lit(unit)))


PHASED = ("hour", "day")


def _season_maps(series: DataFrame, phases: DataFrame | None) -> DataFrame:
    """``(series_id, season)``: offset by phase, an empty map without a season."""
    if phases is None:
        empty = F.expr("cast(map() as map<int,double>)")
        return series.select("series_id").distinct().withColumn("season", empty)
    entries = F.collect_list(F.struct("phase", "offset"))
    return phases.groupBy("series_id").agg(F.map_from_entries(entries).alias("season"))


def _offset(unit: str) -> Column:
    phase = phase_of(F.col("bucket"), unit)
    return F.coalesce(F.try_element_at(F.col("season"), phase), F.lit(0.0))


def _without_season(rows: DataFrame, unit: str) -> DataFrame:
    return rows.withColumn("y", F.col("y") - _offset(unit))


def forecast(models: DataFrame, unit: str, steps: DataFrame | int) -> DataFrame:
    """``(series_id, step, bucket, forecast, se)`` for the buckets after training.

    ``steps`` is a number of steps, or a frame ``(series_id, wanted)`` with an array of the
    steps asked for.
    """
    if isinstance(steps, int):
        every = F.sequence(F.lit(1), F.lit(steps)) if steps > 0 else F.array().cast("array<int>")
        asked = models.withColumn("wanted", every)
    else:
        asked = models.join(steps, "series_id")
    needed = asked.select(
        "series_id", "intercept", "ar", "ma", "d", "sigma", "last_y", "last_z", "last_e", "wanted"
    )
    ahead = needed.mapInPandas(
        forecast_rows, "series_id string, step bigint, mean double, se double"
    )
    dated = ahead.join(models.select("series_id", "last_bucket", "season"), "series_id")
    dated = dated.withColumn("bucket", moved(F.col("last_bucket"), F.col("step"), unit))
    return dated.select(
        "series_id", "step", "bucket", (F.col("mean") + _offset(unit)).alias("forecast"), "se"
    )


def score_ahead(models: DataFrame, recent: DataFrame, unit: str) -> DataFrame:
    """Forecasts joined to the buckets of ``recent`` that follow the training window."""
    after = recent.join(models.select("series_id", "last_bucket"), "series_id")
    after = after.where(F.col("bucket") > F.col("last_bucket"))
    steps = steps_between(F.col("last_bucket"), F.col("bucket"), unit)
    asked = after.groupBy("series_id").agg(F.array_sort(F.collect_set(steps)).alias("wanted"))
    expected = forecast(models, unit, asked).drop("step")
    return recent.select("series_id", "bucket", "y").join(expected, ["series_id", "bucket"])


def score_in_sample(models: DataFrame, series: DataFrame, unit: str) -> DataFrame:
    """One-step forecasts of the buckets in the training window of a regular series."""
    known = models.select(
        "series_id", "season", "d", "long_intercept", "long_ar",
        "intercept", "ar", "ma", "sigma", "last_bucket",
    )
    rows = series.join(known, "series_id").where(F.col("bucket") <= F.col("last_bucket"))
    adjusted = _without_season(rows.withColumn("seen", F.col("y")), unit)
    change = F.col("y") - F.lag("y", 1).over(_in_order())
    z = F.when(F.col("d") == 1, change).otherwise(F.col("y"))
    order = MAX_ORDER
    full = _with_residuals(adjusted.withColumn("z", z).where(F.col("z").isNotNull()), order)
    full = full.where(F.col(f"e{order}").isNotNull())
    step = (
        F.col("intercept")
        + _weighted("ar", _lag_names("z", order))
        + _weighted("ma", _lag_names("e", order))
    )
    # what the step does not explain is what the season-free value misses too
    expected = F.col("seen") - (F.col("z") - step)
    return full.select(
        "series_id",
        "bucket",
        F.col("seen").alias("y"),
        expected.alias("forecast"),
        F.col("sigma").alias("se"),
    )
