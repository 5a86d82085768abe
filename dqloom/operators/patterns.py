"""Pattern profile of string columns: shapes, dominant patterns, inconsistencies."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.names import col
from ..functions.text import (
    anchored,
    has_odd_character,
    shape_mask,
    shape_regex,
    spelling_key,
    violates,
)
from ..session import small_frame

MIN_SHARE = 0.05
COVER = 0.95
# A sketch tracks so many shapes for one of the whole column; so many tasks merge sketches first.
TRACKED = 64
SKETCHES = 512


def distinct_sample(df: DataFrame, column: str, n: int = 100) -> DataFrame:
    """The ``n`` smallest distinct non-null values."""
    value = col(column)
    values = df.where(value.isNotNull()).select(value.alias("value")).distinct()
    return values.orderBy("value").limit(n)


def shape_profile(df: DataFrame, column: str) -> DataFrame:
    """``(shape, n, example)``: every shape of a column with its smallest value."""
    value = col(column)
    rows = df.where(value.isNotNull()).select(
        shape_mask(value).alias("shape"), value.alias("value")
    )
    return rows.groupBy("shape").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("example")
    )


def _shape_keys(df: DataFrame, columns: Sequence[str], with_shape: bool) -> DataFrame:
    """``(column_name, shape_key[, shape])``, one row per non-null value of each column."""
    # masks are columns of their own first, so key and shape share one evaluation
    masks = df.select("*", *[shape_mask(col(c)).alias(f"__shape_{i}") for i, c in enumerate(columns)])
    fields = []
    for i, name in enumerate(columns):
        shape = F.col(f"__shape_{i}")
        key = F.when(col(name).isNotNull(), F.xxhash64(shape))
        parts = [F.lit(name).alias("column_name"), key.alias("shape_key")]
        if with_shape:
            parts.append(shape.alias("shape"))
        fields.append(F.struct(*parts))
    return masks.select(F.inline(F.array(*fields))).where(F.col("shape_key").isNotNull())


def _frequent_keys(
    df: DataFrame, columns: Sequence[str], min_share: float, cover: float
) -> DataFrame:
    """``(column_name, shape_key, total)`` of columns whose frequent shapes may reach ``cover``.

    Shapes are counted under a 64-bit key in sketches of a fixed size, one a task, which
    ``SKETCHES`` tasks merge before the last: free text shuffles no more than a code. A sketch
    never counts a shape too low, and too high by a thirtieth of ``min_share`` at most. So no
    shape is missed here, and the exact counts follow.
    """
    tracked, most = math.ceil(TRACKED / min_share), math.ceil(2 / min_share)
    some = (
        _shape_keys(df, columns, with_shape=False)
        .withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SKETCHES)))
        .groupBy("column_name", "part")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.expr(f"approx_top_k_accumulate(shape_key, {tracked})").alias("sketch"),
        )
    )
    likely = F.filter(
        F.expr(f"approx_top_k_estimate(sketch, {most})"),
        lambda s: s["count"] >= min_share * F.col("total"),
    )
    taken = F.aggregate("likely", F.lit(0).cast("long"), lambda n, s: n + s["count"])
    return (
        some.groupBy("column_name")
        .agg(
            F.sum("total").alias("total"),
            F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"),
        )
        .select("column_name", "total", likely.alias("likely"))
        .where(taken >= cover * F.col("total"))
        .select("column_name", F.explode("likely.item").alias("shape_key"), "total")
    )


def dominant_shapes(
    df: DataFrame,
    columns: Sequence[str],
    min_share: float = MIN_SHARE,
    cover: float = COVER,
) -> DataFrame:
    """``(column_name, shape, n, share, running)``: the shapes that make a clear pattern.

    Shapes of at least ``min_share``, most frequent first, up to the one that brings
    their running share to ``cover``. Columns that never get there have no rows: they
    have no clear pattern. At most ``1 / min_share`` shapes per column reach the driver.
    """
    found = _frequent_keys(df, columns, min_share, cover).collect()
    clear = [c for c in columns if any(r.column_name == c for r in found)]
    schema = "column_name string, shape string, n bigint, share double, running double"
    if not clear:
        return small_frame(df.sparkSession, [], schema)
    keys = small_frame(
        df.sparkSession, found, "column_name string, shape_key bigint, total bigint"
    )
    shapes = (
        _shape_keys(df, clear, with_shape=True)
        .join(F.broadcast(keys), ["column_name", "shape_key"])
        .groupBy("column_name", "shape")
        .agg(F.count(F.lit(1)).alias("n"), F.first("total").alias("total"))
    )
    return _leading_shapes(shapes, min_share, cover)


def _leading_shapes(shapes: DataFrame, min_share: float, cover: float) -> DataFrame:
    """Share and running share of the frequent shapes, cut where ``cover`` is reached."""
    ranked = Window.partitionBy("column_name").orderBy(F.desc("n"), "shape")
    return (
        shapes.withColumn("share", F.col("n") / F.col("total"))
        .where(F.col("share") >= min_share)
        .withColumn("taken", F.sum("n").over(ranked.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("running", F.col("taken") / F.col("total"))
        .withColumn("reached", F.max("running").over(Window.partitionBy("column_name")))
        .where(
            (F.col("reached") >= cover)
            & ((F.col("taken") - F.col("n")) / F.col("total") < cover)
        )
        .select("column_name", "shape", "n", "share", "running")
    )


def dominant_patterns(shapes: DataFrame) -> DataFrame:
    """``(column_name, regex)`` from ``dominant_shapes``; the regex covers whole values."""
    ordered = F.sort_array(
        F.collect_list(F.struct((-F.col("n")).alias("rank"), "shape"))
    )
    return shapes.groupBy("column_name").agg(
        anchored(F.transform(ordered, lambda s: shape_regex(s["shape"]))).alias("regex")
    )


def dominant_pattern(
    df: DataFrame, column: str, min_share: float = MIN_SHARE, cover: float = COVER
) -> str | None:
    """Regex of one column, or None when it has no clear pattern."""
    shapes = dominant_shapes(df, [column], min_share, cover)
    row = dominant_patterns(shapes).first()
    return row.regex if row else None


def pattern_violations(df: DataFrame, column: str, regex: str) -> DataFrame:
    """Rows whose value does not have the pattern."""
    return df.where(violates(col(column), regex))


def case_variants(df: DataFrame, column: str) -> DataFrame:
    """``(spelling_key, variants, n)`` of values that differ only by case or outer blanks.

    A first pass over fixed-width hashes finds the keys with more than one spelling.
    Where those keys are few, Spark broadcasts them at run time, so the second pass
    shuffles the text of varied rows only.
    """
    value = col(column)
    key = spelling_key(value)
    # two hashes of different seed: 128 bits for the key and for the spelling
    key_hashes = [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2")]
    rows = df.where(value.isNotNull())
    hashed = rows.select(
        *key_hashes,
        F.xxhash64(value).alias("v1"),
        F.xxhash64(F.lit(1), value).alias("v2"),
    )
    varied = (
        hashed.groupBy("k1", "k2")
        .agg(*[f(v).alias(f"{v}_{f.__name__}") for v in ("v1", "v2") for f in (F.min, F.max)])
        .where("v1_min <> v1_max or v2_min <> v2_max")
        .select("k1", "k2")
    )
    spellings = (
        rows.select(*key_hashes, value.alias("value"))
        .join(varied, ["k1", "k2"], "left_semi")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        spellings.groupBy(spelling_key(F.col("value")).alias("spelling_key"))
        .agg(F.count(F.lit(1)).alias("variants"), F.sum("n").alias("n"))
        .where("variants > 1")
    )


def odd_characters(df: DataFrame, column: str) -> DataFrame:
    """Rows with a character that is no letter, mark, number, punctuation, symbol or space."""
    return df.where(has_odd_character(col(column)))


def length_bounds(df: DataFrame, columns: Sequence[str], k: float = 3) -> DataFrame:
    """One row: ``(low, high)`` struct per column, mean length plus and minus k deviations."""
    bounds = []
    for name in columns:
        length = F.length(col(name))
        mean, deviation = F.avg(length), F.stddev_samp(length)
        bounds.append(
            F.struct(
                (mean - k * deviation).alias("low"), (mean + k * deviation).alias("high")
            ).alias(name)
        )
    return df.agg(*bounds)


def odd_lengths(df: DataFrame, column: str, k: float = 3) -> DataFrame:
    """Rows whose length is more than ``k`` deviations from the mean length."""
    bounds = length_bounds(df, [column], k).select(col(column).alias("b"))
    low = bounds.select("b.low").scalar()
    high = bounds.select("b.high").scalar()
    length = F.length(col(column))
    return df.where((length < low) | (length > high))
