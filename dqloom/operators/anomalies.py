"""Anomaly rules over a dataset: which series to train, training, and flags."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import col
from ..session import cut_lineage, small_frame
from ..sources.dataset import Dataset
from . import arima
from .ar1 import PROBABILITY, detect_anomalies
from .series import (
    EARLIEST,
    MIN_SEEN,
    bucketed,
    earliest_day,
    fill_gaps,
    infer_frequency,
    pick_metric_column,
    pick_time_column,
    recent_rows,
    training_rows,
    training_window,
)


@dataclass(frozen=True)
class SeriesSpec:
    """One series per table: what to measure, per which unit, trained on which days."""

    table: str
    time_column: str
    metric: str
    unit: str
    start: dt.date
    end: dt.date

    @property
    def series_id(self) -> str:
        return model_name(self.table, self.metric)


def model_name(table: str, metric: str) -> str:
    return f"dq_arima_{table}_{metric}".replace("-", "_")


def series_columns(
    dataset: Dataset, metrics: Mapping[str, str] | None = None
) -> dict[str, tuple[str, str]]:
    """Table -> (time column, metric) for tables with both; ``metrics`` overrides the choice."""
    chosen = {}
    for table, df in dataset.tables.items():
        time_column = pick_time_column(df.schema)
        metric = (metrics or {}).get(table) or pick_metric_column(df.schema)
        if time_column and metric:
            chosen[table] = (time_column, metric)
    return chosen


def series_spec(
    df: DataFrame,
    table: str,
    time_column: str,
    metric: str,
    as_of: dt.date | None = None,
    through_max: bool = False,
    unit: str | None = None,
) -> SeriesSpec:
    """Training days and unit of one table. Two or three one-row answers reach the driver.

    The dates come back as values so that later scans get them as pushed-down ranges. The
    unit is that of the usual window; only where this holds too few different times, all
    earlier rows are looked at. Units above a day are trained on more than the usual window.
    """
    window = training_window(df, time_column, as_of, through_max).first()
    start, end = window.training_start, window.training_end
    if unit is None:
        for first in (start, min(start, EARLIEST)):
            rows = training_rows(df, time_column, metric, first, end)
            found = infer_frequency(rows, time_column).first()
            if found.seen >= MIN_SEEN:
                break
        unit = found.unit
    return SeriesSpec(table, time_column, metric, unit, earliest_day(end, unit), end)


def _by_unit(specs: Iterable[SeriesSpec]) -> dict[str, list[SeriesSpec]]:
    groups: dict[str, list[SeriesSpec]] = {}
    for spec in specs:
        groups.setdefault(spec.unit, []).append(spec)
    return groups


def training_series(dataset: Dataset, specs: Iterable[SeriesSpec]) -> DataFrame:
    """``(series_id, bucket, y)`` of all given series over their training days."""
    return reduce(
        DataFrame.unionByName,
        [
            bucketed(
                training_rows(dataset[s.table], s.time_column, s.metric, s.start, s.end),
                s.series_id,
                s.time_column,
                s.metric,
                s.unit,
            )
            for s in specs
        ],
    )


def train(dataset: Dataset, specs: Iterable[SeriesSpec], max_order: int = arima.MAX_ORDER) -> DataFrame | None:
    """Model rows of all series that could be fitted: one fit per unit, not per table."""
    fits = []
    for unit, group in _by_unit(specs).items():
        models = arima.fit_arima(fill_gaps(training_series(dataset, group), unit), unit, max_order)
        days = small_frame(
            dataset.spark,
            [(s.series_id, s.table, s.time_column, s.metric, s.start, s.end) for s in group],
            "series_id string, table_name string, time_column string, metric_column string, "
            "training_start date, training_end date",
        )
        fits.append(models.join(days, "series_id"))
    return reduce(DataFrame.unionByName, fits) if fits else None


def flag_series(
    dataset: Dataset,
    models: DataFrame,
    specs: Iterable[SeriesSpec],
    as_of: dt.date | None = None,
    probability: float = PROBABILITY,
) -> DataFrame | None:
    """``(series_id, bucket, y, forecast, se, low, high, is_anomaly)`` from ``as_of`` on.

    Buckets after training are compared with forecasts, so only recent rows are read.
    Where training reaches ``as_of``, its buckets are compared with one-step forecasts,
    which needs the training days once more. Filled gaps are never flagged.
    """
    today = F.lit(as_of) if as_of else F.current_date()
    scored = []
    for unit, group in _by_unit(specs).items():
        of_unit = models.where(F.col("unit") == unit)
        recent = reduce(
            DataFrame.unionByName,
            [
                bucketed(
                    recent_rows(dataset[s.table], s.time_column, as_of),
                    s.series_id, s.time_column, s.metric, s.unit,
                )
                for s in group
            ],
        )
        scored.append(arima.score_ahead(of_unit, cut_lineage(recent), unit))
        trained = [s for s in group if s.end >= (as_of or dt.date.today())]
        if trained:
            full = fill_gaps(training_series(dataset, trained), unit)
            seen = arima.score_in_sample(of_unit, full, unit)
            real = seen.where(F.to_date("bucket") >= today).join(
                full.where("not filled").select("series_id", "bucket"),
                ["series_id", "bucket"],
                "left_semi",
            )
            scored.append(real)
    if not scored:
        return None
    return detect_anomalies(reduce(DataFrame.unionByName, scored), probability)


def anomaly_counts(flags: DataFrame) -> DataFrame:
    """``(series_id, failed_count)``: flagged buckets per series."""
    return flags.groupBy("series_id").agg(F.count_if("is_anomaly").alias("failed_count"))


def recent_source(dataset: Dataset, table: str, time_column: str, as_of: dt.date | None) -> DataFrame:
    """Rows whose buckets can be flagged, for samples."""
    return recent_rows(dataset[table], time_column, as_of).where(col(time_column).isNotNull())
