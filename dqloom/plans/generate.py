"""Rule generation: five families derived from the catalog and from the data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import describe, quoted, quoted_value, readable
from ..functions.text import ODD_CHARACTER
from ..operators import anomalies
from ..operators.patterns import dominant_patterns, dominant_shapes, length_bounds
from ..session import cut_lineage, side_by_side, small_frame
from ..sources.catalog import column_catalog
from ..sources.dataset import Dataset, list_tables
from ..sources.store import RULE_SCHEMA

# Names of the rule families.
NULL_CHECK = "Null Check"
UNIQUENESS = "Uniqueness"
STRING_FORMATTING = "String Formatting"
ANOMALY_DETECTION = "Anomaly Detection"
REFERENTIAL_INTEGRITY = "Referential Integrity"

# How the engine counts or samples rules without a row predicate; a rule without any of
# these runs its SQL and has no samples. Variants are counted by their SQL.
DUPLICATES, ORPHANS, SERIES, VARIANTS = "duplicates", "orphans", "series", "variants"

# Tables profiled at the same time.
TABLE_WORKERS = 5

# View of flagged buckets that stored anomaly rules count in.
FLAGS_VIEW = "dq_anomaly_flags"

ForeignKey = tuple[str, str, str, str]


@dataclass
class Generated:
    """Generated rules, the models their anomaly rules refer to, if any, and what failed.

    ``errors`` has ``(table_name, step, error)``: a table that cannot be profiled or trained
    gets no such rules, and all other tables get theirs.
    """

    rules: DataFrame
    models: DataFrame | None
    errors: DataFrame | None = None


Errors = list[tuple[str, str, str]]


def _message(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def rule_id(table: Column, metric: Column, family: Column, sql: Column) -> Column:
    """Stable id: the same rule has the same id in every generation."""
    return F.sha2(F.concat_ws("|", table, metric, family, sql), 256)


def _rules(
    rows: DataFrame, dataset: Dataset, family: str, sql: Column, description: Column, **more: Column
) -> DataFrame:
    """Rows with ``table_name`` and ``column_name`` turned into rules of one family."""
    table, metric = F.col("table_name"), F.col("column_name")
    fields = {
        "rule_id": rule_id(table, metric, F.lit(family), sql),
        "source_project_id": F.lit(dataset.project),
        "source_dataset_id": F.lit(dataset.name),
        "source_table_id": table,
        "metric_column": metric,
        "rule_generation_timestamp": F.current_timestamp(),
        "rule_sql": sql,
        "rule_family": F.lit(family),
        "rule_description": description,
    }
    fields.update(more)
    return rows.select(
        *[
            fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RULE_SCHEMA.fields
        ]
    )


def _count_where(predicate: Column) -> Column:
    return F.concat(
        F.lit("SELECT count(*) AS failed_count FROM "),
        quoted(F.col("table_name")),
        F.lit(" WHERE "),
        predicate,
    )


def null_rules(catalog: DataFrame, dataset: Dataset) -> DataFrame:
    """One rule per column; nullability changes the description only."""
    predicate = F.concat(quoted(F.col("column_name")), F.lit(" IS NULL"))
    names = readable(F.col("column_name")), F.col("table_name")
    description = F.when(
        F.col("is_nullable") == "NO", describe("null_unexpected", *names)
    ).otherwise(describe("null_nullable", *names))
    return _rules(
        catalog, dataset, NULL_CHECK, _count_where(predicate), description,
        failure_predicate=predicate,
    )


def uniqueness_rules(catalog: DataFrame, dataset: Dataset) -> DataFrame:
    """One rule per table, on its first column."""
    column, table = quoted(F.col("column_name")), quoted(F.col("table_name"))
    sql = F.format_string(
        "SELECT count(*) AS failed_count FROM (SELECT %s FROM %s WHERE %s IS NOT NULL "
        "GROUP BY %s HAVING count(*) > 1)",
        column, table, column, column,
    )
    description = describe("unique", readable(F.col("column_name")), F.col("table_name"))
    rows = catalog.where("ordinal = 1")
    return _rules(rows, dataset, UNIQUENESS, sql, description, engine=F.lit(DUPLICATES))


def profile_patterns(
    dataset: Dataset, inconsistencies: bool = True, errors: Errors | None = None
) -> DataFrame:
    """``(table_name, column_name, regex, low, high)`` for every string column.

    ``regex`` is NULL without a clear pattern; such columns get length bounds instead.
    Two scans per table for its patterns (frequent shapes, then their exact counts), one
    more for the lengths of the rest. With ``errors``, a table that fails is listed there
    and left out.
    """
    spark = dataset.spark
    schema = "table_name string, column_name string, regex string, low double, high double"
    strings = column_catalog(dataset).where("role = 'string'")

    def profile(table_columns: tuple[str, list[str]]) -> list[tuple]:
        try:
            return profile_table(*table_columns)
        except Exception as error:  # noqa: BLE001 - one table never stops the others
            if errors is None:
                raise
            errors.append((table_columns[0], "patterns", _message(error)))
            return []

    def profile_table(table: str, columns: list[str]) -> list[tuple]:
        shapes = dominant_shapes(dataset[table], columns)
        regexes = {r.column_name: r.regex for r in dominant_patterns(shapes).collect()}
        unclear = [c for c in columns if c not in regexes]
        bounds = {}
        if unclear and inconsistencies:
            bounds = length_bounds(dataset[table], unclear).first().asDict()
        return [(table, c, regexes.get(c), *(bounds.get(c) or (None, None))) for c in columns]

    found = side_by_side(spark, profile, _grouped(strings).items(), TABLE_WORKERS)
    return small_frame(spark, [row for rows in found for row in rows], schema)


def _grouped(columns: DataFrame) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for row in columns.orderBy("table_name", "ordinal").collect():
        groups.setdefault(row.table_name, []).append(row.column_name)
    return groups


def format_rules(catalog: DataFrame, dataset: Dataset, patterns: DataFrame) -> DataFrame:
    """Rules for every string column: its pattern, or emptiness and inconsistencies.

    A column with a clear pattern gets one rule. Any other gets the empty-string rule
    and, where it has values, rules on characters, lengths and case variants.
    """
    columns = catalog.where("role = 'string'").join(
        patterns, ["table_name", "column_name"], "left"
    )
    column = quoted(F.col("column_name"))
    names = readable(F.col("column_name")), F.col("table_name")

    clear = columns.where("regex is not null")
    misses = F.concat(
        F.lit("NOT ("), column, F.lit(" RLIKE "), quoted_value(F.col("regex")), F.lit(")")
    )
    unclear = columns.where("regex is null")
    empty = F.format_string("%s IS NOT NULL AND length(%s) = 0", column, column)
    filled = unclear.where("low is not null")
    odd = F.concat(column, F.lit(" RLIKE "), quoted_value(F.lit(ODD_CHARACTER)))
    length = F.format_string(
        "length(%s) NOT BETWEEN %s AND %s",
        column, F.ceil("low").cast("string"), F.floor("high").cast("string"),
    )
    predicates = [
        (clear, misses, "format"),
        (unclear, empty, "empty"),
        (filled, odd, "odd_characters"),
        (filled, length, "odd_length"),
    ]
    rules = [
        _rules(
            rows, dataset, STRING_FORMATTING, _count_where(p), describe(case, *names),
            failure_predicate=p,
        )
        for rows, p, case in predicates
    ]
    variants = F.format_string(
        "SELECT count(*) AS failed_count FROM (SELECT 1 FROM %s WHERE %s IS NOT NULL "
        "GROUP BY xxhash64(lower(trim(%s))), xxhash64(1, lower(trim(%s))) "
        "HAVING min(xxhash64(%s)) <> max(xxhash64(%s)))",
        quoted(F.col("table_name")), column, column, column, column, column,
    )
    rules.append(
        _rules(
            filled, dataset, STRING_FORMATTING, variants, describe("case_variants", *names),
            engine=F.lit(VARIANTS),
        )
    )
    return reduce(DataFrame.unionByName, rules)


def reference_rules(foreign_keys: Iterable[ForeignKey], dataset: Dataset) -> DataFrame:
    """One rule per declared key whose two tables exist."""
    declared = small_frame(
        dataset.spark,
        foreign_keys,
        "table_name string, column_name string, ref_table string, ref_column string",
    )
    tables = list_tables(dataset)
    known = declared.join(tables, "table_name", "left_semi").join(
        tables.withColumnRenamed("table_name", "ref_table"), "ref_table", "left_semi"
    )
    column, key = quoted(F.col("column_name")), quoted(F.col("ref_column"))
    sql = F.format_string(
        "SELECT count(*) AS failed_count FROM %s AS c LEFT ANTI JOIN %s AS p "
        "ON c.%s = p.%s WHERE c.%s IS NOT NULL",
        quoted(F.col("table_name")), quoted(F.col("ref_table")), column, key, column,
    )
    description = describe(
        "reference",
        readable(F.col("column_name")), F.col("table_name"),
        readable(F.col("ref_column")), F.col("ref_table"),
    )
    return _rules(
        known, dataset, REFERENTIAL_INTEGRITY, sql, description,
        ref_table=F.col("ref_table"), ref_column=F.col("ref_column"), engine=F.lit(ORPHANS),
    )


def anomaly_rules(models: DataFrame, dataset: Dataset) -> DataFrame:
    """One rule per trained model, hence at most one per table."""
    rows = models.withColumnRenamed("metric_column", "column_name")
    sql = F.format_string(
        f"SELECT count(*) AS failed_count FROM {FLAGS_VIEW} WHERE series_id = %s AND is_anomaly",
        quoted_value(F.col("series_id")),
    )
    description = describe("anomaly", F.col("column_name"), F.col("time_column"))
    return _rules(
        rows, dataset, ANOMALY_DETECTION, sql, description,
        time_column=F.col("time_column"), bucket_unit=F.col("unit"), engine=F.lit(SERIES),
    )


def train_models(
    dataset: Dataset,
    as_of: dt.date | None = None,
    through_max: bool = False,
    metrics: Mapping[str, str] | None = None,
    errors: Errors | None = None,
) -> DataFrame | None:
    """Models of every table with a time column and a metric.

    With ``errors``, tables that fail and series without a model are listed there.
    """
    chosen = anomalies.series_columns(dataset, metrics)

    def spec(item: tuple[str, tuple[str, str]]) -> anomalies.SeriesSpec | None:
        table, (time_column, metric) = item
        try:
            return anomalies.series_spec(
                dataset[table], table, time_column, metric, as_of, through_max
            )
        except Exception as error:  # noqa: BLE001 - one table never stops the others
            if errors is None:
                raise
            errors.append((table, "window", _message(error)))
            return None

    specs = [s for s in side_by_side(dataset.spark, spec, chosen.items(), TABLE_WORKERS) if s]
    if errors is None:
        return anomalies.train(dataset, specs)
    models = _train_together(dataset, specs, errors)
    if not models:
        return None
    trained = reduce(DataFrame.unionByName, models)
    fitted = {r.series_id for r in trained.select("series_id").collect()}
    failed = {table for table, _, _ in errors}
    errors += [
        (s.table, "model", f"no model of {s.metric}: too few or constant numbers")
        for s in specs
        if s.series_id not in fitted and s.table not in failed
    ]
    return trained


def _train_together(dataset: Dataset, specs: list[anomalies.SeriesSpec], errors: Errors) -> list[DataFrame]:
    """Models of all series from one training; halves are tried if it fails."""
    if not specs:
        return []
    try:
        models = anomalies.train(dataset, specs)
        return [] if models is None else [cut_lineage(models)]
    except Exception as error:  # noqa: BLE001
        if len(specs) == 1:
            errors.append((specs[0].table, "model", _message(error)))
            return []
    middle = len(specs) // 2
    return _train_together(dataset, specs[:middle], errors) + _train_together(dataset, specs[middle:], errors)


def generate_rules(
    dataset: Dataset,
    foreign_keys: Iterable[ForeignKey] = (),
    as_of: dt.date | None = None,
    through_max: bool = False,
    metrics: Mapping[str, str] | None = None,
    forecasts: bool = True,
) -> Generated:
    """All rules of a dataset; write them with one ``write_rules``."""
    errors: Errors = []
    catalog = column_catalog(dataset)
    parts = [
        null_rules(catalog, dataset),
        uniqueness_rules(catalog, dataset),
        format_rules(catalog, dataset, profile_patterns(dataset, errors=errors)),
        reference_rules(foreign_keys, dataset),
    ]
    models = train_models(dataset, as_of, through_max, metrics, errors) if forecasts else None
    if models is not None:
        parts.append(anomaly_rules(models, dataset))
    failed = small_frame(dataset.spark, errors, "table_name string, step string, error string")
    return Generated(reduce(DataFrame.unionByName, parts), models, failed)
