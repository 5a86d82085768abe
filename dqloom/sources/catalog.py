"""Column catalog and the roles columns play in rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import small_frame
from .dataset import Dataset

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("ordinal", T.LongType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("is_nullable", T.StringType(), False),
        T.StructField("role", T.StringType(), False),
    ]
)


def role(data_type: T.DataType) -> str:
    """``string``, ``numeric``, ``time`` or ``other``; decimals of any precision count."""
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    return "other"


def column_catalog(dataset: Dataset) -> DataFrame:
    """One row per column, in ordinal order from 1, with type, nullability and role."""
    rows = [
        (
            table,
            ordinal,
            f.name,
            f.dataType.simpleString(),
            "YES" if f.nullable else "NO",
            role(f.dataType),
        )
        for table, df in dataset.tables.items()
        for ordinal, f in enumerate(df.schema.fields, start=1)
    ]
    return small_frame(dataset.spark, rows, CATALOG_SCHEMA)


def key_column(df: DataFrame) -> str:
    """First column: the assumed primary key and the id shown for failing rows."""
    return df.columns[0]
