"""Up to ten failing rows per rule, shown by the first column of their table.

The smallest ids win, so a second run shows the same rows. Every operator keeps at
most ``n`` rows per task before anything is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.names import col
from ..functions.text import spelling_key, violates
from .checks import duplicate_values, orphan_values
from .patterns import case_variants
from .series import LONGEST_DAYS, bucket_of

SAMPLE_SIZE = 10

# Types whose values survive the way to the driver and back as literals.
PUSHED_TYPES = (T.IntegralType, T.StringType, T.DateType, T.DecimalType, T.BooleanType)


def order_value(df: DataFrame, column: str) -> Column:
    """The column itself, or its JSON text where its type has no order."""
    data_type = df.schema[column].dataType
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return F.to_json(col(column))
    return col(column)


def _first(df: DataFrame, key: str, n: int, *before: Column) -> DataFrame:
    smallest = [c.asc_nulls_last() for c in (*before, order_value(df, key))]
    top = df.orderBy(*smallest).limit(n)
    return top.select(col(key).cast("string").alias("source_id_val"))


def sample_where(df: DataFrame, key: str, predicate: Column, n: int = SAMPLE_SIZE) -> DataFrame:
    return _first(df.where(predicate), key, n)


def sample_nulls(df: DataFrame, key: str, column: str, n: int = SAMPLE_SIZE) -> DataFrame:
    return sample_where(df, key, col(column).isNull(), n)


def sample_format(
    df: DataFrame, key: str, column: str, regex: str, n: int = SAMPLE_SIZE
) -> DataFrame:
    return sample_where(df, key, violates(col(column), regex), n)


def smallest_values(bad: DataFrame, n: int = SAMPLE_SIZE) -> list:
    """At most ``n`` values of a frame of failing values."""
    return [r.value for r in bad.select("value").orderBy("value").limit(n).collect()]


def sample_values(
    df: DataFrame, key: str, column: str, bad: DataFrame, n: int = SAMPLE_SIZE
) -> DataFrame:
    """First rows by (value, id) among rows holding one of the ``bad`` values.

    Each bad value has at least one row, so the ``n`` smallest values hold the answer.
    As literals they are pushed to the scan, and the table is never shuffled.
    """
    if isinstance(bad.schema["value"].dataType, PUSHED_TYPES):
        rows = df.where(col(column).isin(smallest_values(bad, n)))
    else:
        smallest = bad.select("value").orderBy("value").limit(n)
        rows = df.join(F.broadcast(smallest), col(column) == smallest["value"], "left_semi")
    return _first(rows, key, n, col(column))


def sample_duplicates(df: DataFrame, key: str, column: str, n: int = SAMPLE_SIZE) -> DataFrame:
    return sample_values(df, key, column, duplicate_values(df, column), n)


def sample_orphans(
    child: DataFrame,
    key: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    n: int = SAMPLE_SIZE,
) -> DataFrame:
    bad = orphan_values(child, column, parent, parent_column)
    return sample_values(child, key, column, bad, n)


def sample_variants(df: DataFrame, key: str, column: str, n: int = SAMPLE_SIZE) -> DataFrame:
    """First rows by (spelling key, id) among values that differ by case or outer blanks only.

    Each varied key has several rows, so the ``n`` smallest keys hold the answer; as
    literals they keep the table where it is.
    """
    found = case_variants(df, column).select("spelling_key").orderBy("spelling_key").limit(n)
    spelled = spelling_key(col(column))
    rows = df.where(spelled.isin([r.spelling_key for r in found.collect()]))
    return _first(rows, key, n, spelled)


def sample_anomalies(
    df: DataFrame,
    key: str,
    time_column: str,
    flags: DataFrame,
    unit: str,
    n: int = SAMPLE_SIZE,
) -> DataFrame:
    """Source rows in flagged buckets; ``flags`` has one row per scored bucket.

    The first and the end of the last flagged bucket reach the scan as a range of the raw column,
    a day wider on both sides because zones may shift it, so history is neither read nor moved.
    """
    flagged = flags.where("is_anomaly").select("bucket").distinct()
    length = dt.timedelta(days=LONGEST_DAYS[unit])
    low, high = flagged.agg(F.min("bucket"), F.max("bucket")).first()
    if low is None:
        return _first(df.limit(0), key, n)
    end = min(high, dt.datetime.max - length - 2 * dt.timedelta(days=1)) + length
    kind, day = df.schema[time_column].dataType, dt.timedelta(days=1)
    near = col(time_column).between(*[F.lit(t).cast("timestamp_ntz").cast(kind) for t in (low - day, end + day)])
    bucket = bucket_of(col(time_column), unit)
    rows = df.where(near).join(flagged, bucket == flagged["bucket"], "left_semi")
    return _first(rows, key, n)


def sample_table(
    df: DataFrame, key: str, predicates: Mapping[str, Column], n: int = SAMPLE_SIZE
) -> DataFrame:
    """``(rule_id, source_id_val)`` for all row predicates of a table in one scan.

    Rows that break no rule are filtered out first. The others carry the small number
    of each broken rule; the rank filter keeps ``n`` rows per rule in every task before
    the shuffle.
    """
    ids = list(predicates)
    failing = df.where(reduce(or_, predicates.values()))
    broken = F.array_compact(
        F.array(*[F.when(p, F.lit(i)) for i, p in enumerate(predicates.values())])
    )
    hits = failing.select(order_value(df, key).alias("id"), F.explode(broken).alias("rule_no"))
    rank = F.row_number().over(
        Window.partitionBy("rule_no").orderBy(F.col("id").asc_nulls_last())
    )
    kept = hits.withColumn("rank", rank).where(F.col("rank") <= n)
    names = F.array(*[F.lit(i) for i in ids])
    return kept.select(
        F.get(names, F.col("rule_no")).alias("rule_id"),
        F.col("id").cast("string").alias("source_id_val"),
    )
