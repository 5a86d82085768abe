"""Rule families as failure counts: every check returns one ``failed_count`` row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col
from ..functions.text import is_empty, violates

# Counters per aggregation: with many more, the generated method grows past what the
# JIT compiles. Callers order predicates by column, so blocks read different columns.
BLOCK = 32


def count_failures(df: DataFrame, predicate: Column) -> DataFrame:
    return df.agg(F.count_if(predicate).alias("failed_count"))


def null_check(df: DataFrame, column: str) -> DataFrame:
    return count_failures(df, col(column).isNull())


def format_check(df: DataFrame, column: str, regex: str) -> DataFrame:
    """Rows whose value holds no match; NULL neither passes nor fails."""
    return count_failures(df, violates(col(column), regex))


def empty_check(df: DataFrame, column: str) -> DataFrame:
    return count_failures(df, is_empty(col(column)))


def fused_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """``(rule_key, failed_count)`` for all predicates of a table.

    One scan for a table of up to ``BLOCK`` predicates; wider tables are scanned in
    blocks, side by side in the same job.
    """
    items = list(predicates.items())
    blocks = [items[i : i + BLOCK] for i in range(0, len(items), BLOCK)]
    return reduce(
        DataFrame.unionByName,
        [_long_counts(df, {k: F.count_if(p) for k, p in block}) for block in blocks],
    )


def footer_null_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``(rule_key, failed_count)`` of NULLs written so that file footers can answer.

    Only for columns of atomic type: the footers of nested columns count leaves.
    """
    nulls = {
        key: F.count(F.lit(1)) - F.count(col(column)) for key, column in columns.items()
    }
    return _long_counts(df, nulls)


def _long_counts(df: DataFrame, counters: Mapping[str, Column]) -> DataFrame:
    wide = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counters.values())])
    pairs = [
        F.struct(F.lit(key).alias("rule_key"), F.col(f"c{i}").alias("failed_count"))
        for i, key in enumerate(counters)
    ]
    return wide.select(F.inline(F.array(*pairs)))


def is_atomic(data_type: T.DataType) -> bool:
    return not isinstance(
        data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, failed_count)`` of NULLs for all columns, in one scan."""
    names = list(columns) if columns is not None else df.columns
    counts = fused_counts(df, {c: col(c).isNull() for c in names})
    return counts.withColumnRenamed("rule_key", "column_name")


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)`` of non-null values found more than once.

    Values are counted before the shuffle, so a hot value travels once per task.
    """
    value = col(column)
    counts = df.where(value.isNotNull()).groupBy(value.alias("value"))
    return counts.agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def uniqueness_check(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct duplicated values, not of rows."""
    return duplicate_values(df, column).agg(F.count(F.lit(1)).alias("failed_count"))


def duplicate_rows(df: DataFrame, column: str) -> DataFrame:
    """Number of rows that share their value with another row."""
    rows = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return duplicate_values(df, column).agg(rows.alias("failed_count"))


def orphan_values(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """``(value, n)`` of non-null child values without a parent.

    Both sides are reduced to distinct values by aggregations that combine before the
    shuffle, and the anti join reuses their partitioning: hot keys on either side cost
    one row per task, and no third shuffle is needed.
    """
    value, key = col(column), col(parent_column)
    values = (
        child.where(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = parent.where(key.isNotNull()).select(key.alias("value")).distinct()
    return values.join(parents, "value", "left_anti")


def ri_check(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Number of child rows whose non-null value has no parent."""
    orphans = orphan_values(child, column, parent, parent_column)
    rows = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return orphans.agg(rows.alias("failed_count"))


def clean_sql(text: str) -> str:
    """Stored SQL without outer blanks and closing semicolons."""
    return text.strip().rstrip("; \n\t")


def sql_check(spark: SparkSession, rule_sql: str) -> DataFrame:
    """Free-form rule: any query with a ``failed_count`` column."""
    return spark.sql(clean_sql(rule_sql)).select("failed_count")
