"""Datasets: named tables read from a folder of parquet or a catalog database."""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quote_name
from ..session import small_frame


@dataclass
class Dataset:
    """Tables by name. ``counting`` holds handles whose counts come from file footers."""

    spark: SparkSession
    tables: dict[str, DataFrame]
    name: str = "source_data"
    project: str = "local"
    counting: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, table: str) -> DataFrame:
        return self.tables[table]

    def with_table(self, table: str, df: DataFrame) -> Dataset:
        """Copy of the dataset with one more (or one replaced) table."""
        tables = {**self.tables, table: df}
        counting = {t: d for t, d in self.counting.items() if t != table}
        return Dataset(self.spark, tables, self.name, self.project, counting)

    def only(self, *names: str) -> Dataset:
        tables = {t: self.tables[t] for t in names}
        counting = {t: d for t, d in self.counting.items() if t in names}
        return Dataset(self.spark, tables, self.name, self.project, counting)

    def register_views(self) -> Dataset:
        """Let stored rule SQL address the tables by name."""
        for table, df in self.tables.items():
            df.createOrReplaceTempView(quote_name(table))
        return self


@contextmanager
def _footer_reader(spark: SparkSession):
    """Reads opened here use the parquet reader that answers counts from footers."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    without = ",".join(s for s in before.split(",") if s and s != "parquet")
    spark.conf.set(key, without)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _folder_tables(spark: SparkSession, directory: str) -> list[str]:
    """Names of the parquet files or folders directly below ``directory``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))


def load_dataset(
    spark: SparkSession,
    directory: str,
    names: Iterable[str] | None = None,
    name: str = "source_data",
    project: str = "local",
    footer_counts: bool = False,
) -> Dataset:
    """Tables ``<directory>/<name>.parquet``; all of them when ``names`` is not given.

    ``footer_counts`` opens a second handle per table for null rules: their counts are
    then taken from parquet footers and no column data is read.
    """
    names = list(names) if names is not None else _folder_tables(spark, directory)
    paths = {n: f"{directory.rstrip('/')}/{n}.parquet" for n in names}
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    counting: dict[str, DataFrame] = {}
    if footer_counts:
        with _footer_reader(spark):
            counting = {n: spark.read.parquet(p) for n, p in paths.items()}
    return Dataset(spark, tables, name, project, counting)


def load_database(spark: SparkSession, database: str, project: str = "local") -> Dataset:
    """Base tables of a catalog database; views are left out."""
    found = spark.catalog.listTables(database)
    names = sorted(t.name for t in found if t.tableType in ("MANAGED", "EXTERNAL"))
    tables = {
        n: spark.table(f"{quote_name(database)}.{quote_name(n)}") for n in names
    }
    return Dataset(spark, tables, database, project)


def has_table(dataset: Dataset, name: str) -> bool:
    return name in dataset.tables


def list_tables(dataset: Dataset) -> DataFrame:
    """One row per base table: ``table_name``."""
    rows = [(t,) for t in dataset.tables]
    return small_frame(dataset.spark, rows, "table_name string")


def row_counts(dataset: Dataset) -> DataFrame:
    """``(table_name, row_count)``, from footers where the dataset has such handles."""
    counts = [
        dataset.counting.get(t, df).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(t).alias("table_name"), "row_count")
        for t, df in dataset.tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
