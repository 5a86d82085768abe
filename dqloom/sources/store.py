"""Rules, results, samples and models kept as day-partitioned parquet.

Tables that are replaced are folders of versions. A new version is written beside the old
one and counts once its marker exists, which is created after all its files; a write that
fails leaves the table as it was. The version before is kept for readers that have begun.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote_name

_STRING, _TIME = T.StringType(), T.TimestampType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


# Nine described fields, then what the engine needs to run a rule without reading
# its SQL: a row predicate, the referenced column, the series to score, or the check.
RULE_SCHEMA = _schema(
    ("rule_id", _STRING, False),
    ("source_project_id", _STRING, False),
    ("source_dataset_id", _STRING, False),
    ("source_table_id", _STRING, False),
    ("metric_column", _STRING, False),
    ("rule_generation_timestamp", _TIME, False),
    ("rule_sql", _STRING, False),
    ("rule_family", _STRING, False),
    ("rule_description", _STRING, True),
    ("failure_predicate", _STRING, True),
    ("ref_table", _STRING, True),
    ("ref_column", _STRING, True),
    ("time_column", _STRING, True),
    ("bucket_unit", _STRING, True),
    ("engine", _STRING, True),
)
# Fields that say how the engine runs a rule; without any of them its SQL runs.
ENGINE_FIELDS = RULE_SCHEMA.fieldNames()[9:]
RULE_FIELDS = RULE_SCHEMA.fieldNames()[:9]

RESULT_SCHEMA = _schema(
    ("result_id", _STRING, False),
    ("rule_id", _STRING, False),
    ("source_dataset_id", _STRING, False),
    ("source_table_id", _STRING, False),
    ("metric_column", _STRING, False),
    ("rule_family", _STRING, False),
    ("execution_timestamp", _TIME, False),
    ("execution_duration_seconds", T.DoubleType(), True),
    ("status", _STRING, False),
    ("failed_rows", T.LongType(), True),
    ("error_message", _STRING, True),
)

SAMPLE_SCHEMA = _schema(
    ("failed_row_entry_id", _STRING, False),
    ("rule_id", _STRING, False),
    ("source_id", _STRING, True),
    ("source_project_id", _STRING, False),
    ("source_dataset_id", _STRING, False),
    ("source_table_id", _STRING, False),
    ("execution_timestamp", _TIME, False),
    ("metric_column", _STRING, False),
)


def _partitioned(df: DataFrame, time_column: str, day_column: str):
    return df.withColumn(day_column, F.to_date(time_column)).write.partitionBy(day_column)


VERSION, COMPLETE = "version-", "_complete"


def _files(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def ensure_store(spark: SparkSession, path: str, database: str | None = None) -> None:
    """Create the store folder, and a database over it when a name is given."""
    system, folder = _files(spark, path)
    system.mkdirs(folder)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_name(database)}")


def store_has(spark: SparkSession, path: str) -> bool:
    system, folder = _files(spark, path)
    return system.exists(folder)


def _versions(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Names of all versions of a table in order, and whether each is complete."""
    system, at = _files(spark, folder)
    if not system.exists(at):
        return []
    names = sorted(f.getPath().getName() for f in system.listStatus(at) if f.isDirectory())
    return [
        (n, store_has(spark, f"{folder}/{n}/{COMPLETE}")) for n in names if n.startswith(VERSION)
    ]


def current_version(spark: SparkSession, folder: str) -> str:
    """Where the newest complete version is; the folder itself if it has no versions."""
    complete = [n for n, done in _versions(spark, folder) if done]
    return f"{folder}/{complete[-1]}" if complete else folder


def replace_table(spark: SparkSession, folder: str, write: Callable[[str], None]) -> None:
    """Let ``write(path)`` make the next version, then make it the current one.

    The old version stays while the new one is written, so ``write`` may read it. Versions
    before it, and those of failed writes, are deleted in the end.
    """
    before = _versions(spark, folder)
    last = int(before[-1][0].removeprefix(VERSION).split("-")[0]) if before else 0
    name = f"{VERSION}{last + 1:09d}-{uuid.uuid4().hex[:8]}"
    write(f"{folder}/{name}")
    system, marker = _files(spark, f"{folder}/{name}/{COMPLETE}")
    system.create(marker, False).close()
    complete = [n for n, done in before if done]
    for old in {n for n, _ in before} - set(complete[-1:]):
        system, at = _files(spark, f"{folder}/{old}")
        system.delete(at, True)


def write_rules(df: DataFrame, path: str) -> None:
    """Replace the rules table, partitioned by generation day.

    The rules may have been read from the same table.
    """
    rules = _partitioned(df, "rule_generation_timestamp", "generation_date")
    replace_table(df.sparkSession, f"{path}/rules", rules.parquet)


def _read(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(current_version(spark, folder))


def read_rules(spark: SparkSession, path: str, engine_fields: bool = False) -> DataFrame:
    """All rules: the nine described columns, or those plus what the engine adds."""
    rules = _read(spark, f"{path}/rules", RULE_SCHEMA)
    return rules.select(RULE_SCHEMA.fieldNames() if engine_fields else RULE_FIELDS)


def write_results(df: DataFrame, path: str) -> None:
    """Replace the results table, by execution day: readers see one run or the other."""
    results = _partitioned(df, "execution_timestamp", "execution_date")
    replace_table(df.sparkSession, f"{path}/results", results.parquet)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, f"{path}/results", RESULT_SCHEMA).select(RESULT_SCHEMA.fieldNames())


def append_samples(df: DataFrame, path: str) -> None:
    """Add samples; the table is created by the first write and never replaced."""
    _partitioned(df, "execution_timestamp", "execution_date").mode("append").parquet(
        f"{path}/samples"
    )


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    samples = spark.read.schema(SAMPLE_SCHEMA).parquet(f"{path}/samples")
    return samples.select(SAMPLE_SCHEMA.fieldNames())


def write_models(df: DataFrame, path: str) -> None:
    """Replace the models of the series in ``df``, keep those of all other series."""
    spark = df.sparkSession
    folder = f"{path}/models"
    models = df
    if store_has(spark, folder):
        kept = read_models(spark, path).join(df.select("series_id"), "series_id", "left_anti")
        models = kept.unionByName(df, allowMissingColumns=True)
    replace_table(spark, folder, models.write.parquet)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, f"{path}/models")
