"""Time series: column choice, training window, buckets, gaps, seasons, differences.

Rows are reduced to one value per bucket before any window runs. A trained series has at
most 91 days of buckets, 131,040 at the finest unit, or some dozens at units above a day,
whatever the size of its table, so windows partitioned by series stay small. Gaps are
filled in blocks of time, so that step holds for series of any length.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.names import col
from ..session import cut_lineage
from ..sources.catalog import role

# Parts of names that mark a metric, in order of preference.
METRIC_NAME_PARTS = (
    "sale",
    "spend",
    "cases",
    "deaths",
    "total",
    "count",
    "value",
    "amount",
    "sum",
)
TRAINING_DAYS = 90
FALLBACK_LAG_DAYS = 7

# Training of units above a day reaches back for at least so many buckets.
TRAINING_BUCKETS = 24
# Where looking back ends; Spark takes no literal date with a year of fewer digits.
EARLIEST = dt.date(1000, 1, 1)
# Fewer distinct times than this say nothing about the unit.
MIN_SEEN = 4

# Bucket units from fine to coarse: their length in seconds, or in months where the
# calendar sets it. Weeks begin on Monday.
UNIT_SECONDS = {"minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
UNIT_MONTHS = {"month": 1, "quarter": 3, "year": 12}
UNITS = (*UNIT_SECONDS, *UNIT_MONTHS)
# Days that hold any bucket of a unit.
LONGEST_DAYS = {"minute": 1, "hour": 1, "day": 1, "week": 7, "month": 31, "quarter": 92, "year": 366}
# Gaps are looked over in blocks of so many buckets and filled in pieces of so many.
BLOCK = 4096
# Bucket units -> number of phases in a season: hours of a day, days of a week.
PHASES = {"hour": 24, "day": 7}
MIN_COVERAGE = 0.8


def pick_time_column(schema: T.StructType) -> str | None:
    """First column of a time type."""
    return next((f.name for f in schema if role(f.dataType) == "time"), None)


def pick_metric_column(schema: T.StructType) -> str | None:
    """Numeric column with the most preferred name part, else the first numeric one."""
    numeric = [f.name for f in schema if role(f.dataType) == "numeric"]
    for part in METRIC_NAME_PARTS:
        for name in numeric:
            if part in name.lower():
                return name
    return numeric[0] if numeric else None


def bucket_of(time: Column, unit: str) -> Column:
    """Start of the bucket as a zone-free timestamp, whatever the session zone is."""
    day = F.to_date(time)
    if unit in UNIT_MONTHS or unit == "week":
        return F.trunc(day, unit).cast("timestamp_ntz")
    day = day.cast("timestamp_ntz")
    if unit == "day":
        return day
    moment = time.cast("timestamp_ntz")
    minutes = F.minute(moment) if unit == "minute" else F.lit(0)
    return day + F.make_dt_interval(hours=F.hour(moment), mins=minutes)


def seconds_of(moment: Column) -> Column:
    """Whole seconds of a zone-free timestamp, for differences in no zone's clock."""
    day = F.unix_date(F.to_date(moment)).cast("bigint") * 86400
    return day + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def number_of(moment: Column, unit: str) -> Column:
    """Number of the bucket of a zone-free timestamp; the next bucket has the next number."""
    if unit in UNIT_MONTHS:
        months = F.year(moment) * 12 + F.month(moment) - 1
        return F.floor(months / UNIT_MONTHS[unit]).cast("bigint")
    # 1970-01-01 was a Thursday
    shift = 3 * 86400 if unit == "week" else 0
    return F.floor((seconds_of(moment) + shift) / UNIT_SECONDS[unit]).cast("bigint")


def steps_between(start: Column, end: Column, unit: str) -> Column:
    """Number of buckets from one bucket to another."""
    return number_of(end, unit) - number_of(start, unit)


def moved(bucket: Column, steps: Column, unit: str) -> Column:
    """The bucket so many buckets later."""
    if unit in UNIT_MONTHS:
        months = (steps * UNIT_MONTHS[unit]).cast("int")
        return F.add_months(F.to_date(bucket), months).cast("timestamp_ntz")
    return bucket + F.make_dt_interval(secs=steps * UNIT_SECONDS[unit])


def earliest_day(end: dt.date, unit: str) -> dt.date:
    """First training day: 90 days before the last one, further back for coarse units."""
    usual = end - dt.timedelta(TRAINING_DAYS)
    if unit in UNIT_MONTHS:
        months = end.year * 12 + end.month - 1 - UNIT_MONTHS[unit] * TRAINING_BUCKETS
        back = max(EARLIEST, dt.date(max(months // 12, 1), months % 12 + 1, 1))
    else:
        back = end - dt.timedelta(seconds=UNIT_SECONDS[unit] * TRAINING_BUCKETS)
    return min(usual, back)


def max_date(df: DataFrame, time_column: str) -> DataFrame:
    """One row: the newest date. ``max`` of the raw column, so it runs on one column."""
    return df.agg(F.to_date(F.max(col(time_column))).alias("max_date"))


def training_window(
    df: DataFrame, time_column: str, as_of: dt.date | None = None, through_max: bool = False
) -> DataFrame:
    """One row ``(training_start, training_end)``, both included.

    By default training stops the day before ``as_of``, so scored rows were never
    trained on. ``through_max`` trains up to the newest date instead. Without any date
    the window ends a week before ``as_of``.
    """
    today = F.lit(as_of) if as_of else F.current_date()
    newest = F.col("max_date")
    end = newest if through_max else F.least(newest, F.date_sub(today, 1))
    fallback = F.date_sub(today, FALLBACK_LAG_DAYS)
    window = max_date(df, time_column).select(
        F.coalesce(F.when(newest.isNotNull(), end), fallback).alias("training_end")
    )
    start = F.date_sub("training_end", TRAINING_DAYS)
    return window.select(start.alias("training_start"), "training_end")


def training_rows(
    df: DataFrame, time_column: str, metric: str, start: dt.date, end: dt.date
) -> DataFrame:
    """Rows of the window with a metric; literal dates reach the scan as a range."""
    day = F.to_date(col(time_column))
    return df.where(day.between(F.lit(start), F.lit(end)) & measured(metric))


def measured(metric: str) -> Column:
    """Whether a row has a number: not NULL, not NaN, not infinite."""
    return F.abs(col(metric).cast("double")) < float("inf")


def recent_rows(df: DataFrame, time_column: str, as_of: dt.date | None = None) -> DataFrame:
    """Rows from ``as_of`` (today when not given) onwards."""
    today = F.lit(as_of) if as_of else F.current_date()
    return df.where(F.to_date(col(time_column)) >= today)


def frequency_coverage(df: DataFrame, time_column: str) -> DataFrame:
    """One row: share of possible buckets that hold rows, one column per unit, and ``seen``.

    Rows are first reduced to distinct minutes (``seen`` counts them), these to days with
    their hours as bits, so the coarser units count days only.
    """
    minutes = df.where(col(time_column).isNotNull()).select(
        bucket_of(col(time_column), "minute").alias("bucket")
    )
    hours = F.expr("bit_count(bit_or(shiftleft(1, hour(bucket))))")
    days = minutes.distinct().groupBy(bucket_of(F.col("bucket"), "day").alias("day")).agg(
        F.count(F.lit(1)).alias("minutes"),
        hours.alias("hours"),
        F.min("bucket").alias("first"),
        F.max("bucket").alias("last"),
    )
    found = {"minute": F.sum("minutes"), "hour": F.sum("hours"), "day": F.count(F.lit(1))}
    shares = []
    for unit in UNITS:
        some = found.get(unit)
        if some is None:
            some = F.count_distinct(bucket_of(F.col("day"), unit))
        span = steps_between(F.min("first"), F.max("last"), unit)
        shares.append((some / (span + 1)).alias(unit))
    return days.agg(*shares, F.coalesce(F.sum("minutes"), F.lit(0)).alias("seen"))


def infer_frequency(df: DataFrame, time_column: str) -> DataFrame:
    """One row ``unit``: the finest unit whose buckets are covered, and ``seen``."""
    return frequency_coverage(df, time_column).select(finest_covered().alias("unit"), "seen")


def finest_covered() -> Column:
    """Unit chosen from the shares of ``frequency_coverage``; day if there is no second time."""
    choice = F.lit("day")
    for unit in reversed(UNITS):
        choice = F.when(F.col(unit) >= MIN_COVERAGE, F.lit(unit)).otherwise(choice)
    return F.when(F.col("seen") > 1, choice).otherwise("day")


def bucketed(
    df: DataFrame, series_id: str, time_column: str, metric: str, unit: str, how: str = "avg"
) -> DataFrame:
    """``(series_id, bucket, y)``: one value per bucket that has rows."""
    value = {"avg": F.avg, "sum": F.sum}[how](col(metric).cast("double"))
    rows = df.where(col(time_column).isNotNull() & measured(metric))
    return rows.groupBy(
        F.lit(series_id).alias("series_id"), bucket_of(col(time_column), unit).alias("bucket")
    ).agg(value.alias("y"))


def fill_gaps(series: DataFrame, unit: str) -> DataFrame:
    """``(series_id, bucket, y, filled)`` with every bucket, gaps interpolated linearly.

    Each known bucket looks for the next one within its block of ``BLOCK`` buckets; the last
    of a block takes the first of the next block that has any, from the table of blocks. A
    bucket then makes the rows up to the next one, in pieces, so neither a long series
    nor a long gap is ever an array or a window. The buckets are cut off from their
    source first: they are read twice from here.
    """
    series = cut_lineage(series)
    known = series.withColumn("at", number_of(F.col("bucket"), unit))
    known = known.withColumn("block", F.floor(F.col("at") / BLOCK))
    heads = known.groupBy("series_id", "block").agg(
        F.min("at").alias("at"), F.min("bucket").alias("bucket"), F.min_by("y", "at").alias("y")
    )
    one = F.struct("at", "bucket", "y")
    blocks = Window.partitionBy("series_id").orderBy("block")
    heads = heads.select("series_id", "block", F.lead(one).over(blocks).alias("head"))
    within = Window.partitionBy("series_id", "block").orderBy("at")
    rows = known.withColumn("next", F.lead(one).over(within)).join(heads, ["series_id", "block"])
    rows = rows.withColumn("next", F.coalesce("next", "head"))
    # the last bucket of a series makes itself alone
    steps = F.coalesce(F.col("next.at") - F.col("at"), F.lit(1))
    rows = rows.withColumn("steps", steps)
    none, size = F.lit(0).cast("bigint"), F.lit(BLOCK).cast("bigint")
    far = rows.where(F.col("steps") > BLOCK)
    # the exchange keeps the pieces of one gap from being made as one run of rows
    far = far.withColumn("piece", F.explode(F.sequence(none, F.col("steps") - 1, size)))
    far = far.repartition("series_id", "piece")
    rows = rows.where(F.col("steps") <= BLOCK).withColumn("piece", none).unionByName(far)
    end = F.least(F.col("piece") + BLOCK, F.col("steps")) - 1
    rows = rows.withColumn("step", F.explode(F.sequence("piece", end)))
    rows = rows.withColumn("now", moved(F.col("bucket"), F.col("step"), unit))
    start = seconds_of(F.col("bucket"))
    position = (seconds_of(F.col("now")) - start) / (seconds_of(F.col("next.bucket")) - start)
    line = F.col("y") + (F.col("next.y") - F.col("y")) * position
    return rows.select(
        "series_id",
        F.col("now").alias("bucket"),
        F.when(F.col("step") == 0, F.col("y")).otherwise(line).alias("y"),
        (F.col("step") > 0).alias("filled"),
    )


def resample(
    df: DataFrame, series_id: str, time_column: str, metric: str, unit: str, how: str = "avg"
) -> DataFrame:
    """Regular series of a table: one value per bucket, gaps filled."""
    return fill_gaps(bucketed(df, series_id, time_column, metric, unit, how), unit)


def phase_of(bucket: Column, unit: str) -> Column:
    """Position in the season: hour of the day, or day of the week from Monday."""
    if unit == "hour":
        return F.hour(bucket)
    if unit == "day":
        return F.weekday(bucket)
    return F.lit(0)


def season_offsets(series: DataFrame, unit: str) -> DataFrame:
    """``(series_id, phase, offset)``: mean of the phase minus mean of the series."""
    phases = series.groupBy("series_id", phase_of(F.col("bucket"), unit).alias("phase")).agg(
        F.avg("y").alias("phase_mean")
    )
    means = series.groupBy("series_id").agg(F.avg("y").alias("series_mean"))
    return phases.join(means, "series_id").select(
        "series_id", "phase", (F.col("phase_mean") - F.col("series_mean")).alias("offset")
    )


def deseasonalize(series: DataFrame, unit: str) -> DataFrame:
    """The series with the additive offset of each phase taken out."""
    phase = phase_of(F.col("bucket"), unit)
    by_phase = Window.partitionBy("series_id", phase)
    mean = F.avg("y").over(Window.partitionBy("series_id"))
    return series.withColumn("y", F.col("y") - F.avg("y").over(by_phase) + mean)


def difference(series: DataFrame, d: int = 1) -> DataFrame:
    """``d`` rounds of ``y`` minus the value one bucket before; leading rows drop out."""
    order = Window.partitionBy("series_id").orderBy("bucket")
    for _ in range(d):
        change = F.col("y") - F.lag("y", 1).over(order)
        series = series.withColumn("y", change).where(F.col("y").isNotNull())
    return series
