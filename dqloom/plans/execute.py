"""Rule execution: fused scans per table, own jobs for the rest, statuses and samples."""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col, quote_name
from ..operators import anomalies, checks, samples
from ..operators.checks import fused_counts, footer_null_counts, is_atomic
from ..session import small_frame
from ..sources.catalog import key_column
from ..sources.dataset import Dataset, has_table
from ..sources.store import RESULT_SCHEMA, RULE_SCHEMA, SAMPLE_SCHEMA
from .generate import DUPLICATES, FLAGS_VIEW, ORPHANS, SERIES, VARIANTS

WORKERS = 10

# What results and samples repeat about a rule.
IDENTITY_FIELDS = (
    "rule_id",
    "source_project_id",
    "source_dataset_id",
    "source_table_id",
    "metric_column",
    "rule_family",
)

OUTCOME_SCHEMA = (
    "rule_id string, failed_count bigint, error string, seconds double, "
    "finished_at timestamp"
)


@dataclass
class RunOutcome:
    """``results`` and ``samples`` have the stored schemas; both are small."""

    results: DataFrame
    samples: DataFrame


@dataclass
class _Run:
    dataset: Dataset
    models: DataFrame | None
    as_of: dt.date | None
    pool: ThreadPoolExecutor
    limit_seconds: float | None = None
    flags: DataFrame | None = None
    # frames of failing values, kept from counting to sampling
    bad_values: dict[str, DataFrame] = field(default_factory=dict)
    kept: list[DataFrame] = field(default_factory=list)


@contextmanager
def _limited(run: _Run):
    """Cancel the Spark jobs that this thread starts within when they take too long.

    They carry a tag of their own, so jobs of other rules go on. Each block has the whole
    time, so rules that share a scan with an endless one are found by halves. The rule is an
    error at once; its tasks end with the batch of rows they are at.
    """
    if run.limit_seconds is None:
        yield
        return
    context, tag = run.dataset.spark.sparkContext, f"dqloom-{uuid.uuid4().hex}"
    over = threading.Event()

    def stop():
        over.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(run.limit_seconds, stop)
    context.addJobTag(tag)
    timer.start()
    try:
        yield
    except Exception as error:
        if over.is_set():
            raise TimeoutError(f"stopped after {run.limit_seconds:g} seconds") from error
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)


def _outcome(rule: Row, count: int | None, error: Exception | None, started: float) -> tuple:
    message = None if error is None else f"{type(error).__name__}: {error}"
    now = dt.datetime.now(dt.timezone.utc)
    return (rule.rule_id, count, message, time.time() - started, now)


# --- which rules can share a scan ------------------------------------------------


def _is_null_test(rule: Row) -> bool:
    """Plain NULL tests cannot fail on a row, and footers may answer them."""
    return rule.failure_predicate == f"{quote_name(rule.metric_column)} IS NULL"


def _predicate(df: DataFrame, rule: Row) -> Column:
    """The rule's row predicate, checked against the table without running a job."""
    predicate = F.expr(rule.failure_predicate)
    _check_boolean(df, [predicate])
    return predicate


def _check_boolean(df: DataFrame, predicates: Iterable[Column]) -> None:
    for field_ in df.select(*_named(predicates)).schema:
        if not isinstance(field_.dataType, T.BooleanType):
            raise TypeError(f"failure predicate is {field_.dataType.simpleString()}, not boolean")


def _runnable(
    run: _Run, df: DataFrame, rules: Iterable[Row]
) -> tuple[dict[str, Column], dict[str, Exception]]:
    """Predicates by rule id, and the errors of those that cannot run.

    Bad names fail at analysis. Bad regexes only fail when a row meets them, so all
    predicates are tried together on one row, and one by one if that fails.
    """
    rules = _by_column(rules)
    try:
        good = {r.rule_id: F.expr(r.failure_predicate) for r in rules}
        _check_boolean(df, good.values())
        bad: dict[str, Exception] = {}
    except Exception:  # noqa: BLE001 - one rule never stops the others
        good, bad = {}, {}
        for rule in rules:
            try:
                good[rule.rule_id] = _predicate(df, rule)
            except Exception as error:  # noqa: BLE001
                bad[rule.rule_id] = error
    tried = [r.rule_id for r in rules if r.rule_id in good and not _is_null_test(r)]
    try:
        with _limited(run):
            _try_one_row(df, [good[i] for i in tried])
    except Exception:  # noqa: BLE001
        for rule_id in tried:
            try:
                with _limited(run):
                    _try_one_row(df, [good[rule_id]])
            except Exception as error:  # noqa: BLE001
                bad[rule_id] = error
                del good[rule_id]
    return good, bad


def _try_one_row(df: DataFrame, predicates: list[Column]) -> None:
    if predicates:
        df.limit(1).select(*_named(predicates)).collect()


def _named(predicates: Iterable[Column]) -> list[Column]:
    return [p.alias(f"p{i}") for i, p in enumerate(predicates)]


def _footer_columns(run: _Run, table: str, rules: Iterable[Row]) -> dict[str, str]:
    """Null rules of a table that file footers can answer: rule id -> column."""
    if table not in run.dataset.counting:
        return {}
    fields = {f.name: f.dataType for f in run.dataset.counting[table].schema}
    return {
        r.rule_id: r.metric_column
        for r in rules
        if _is_null_test(r)
        and r.metric_column in fields
        and is_atomic(fields[r.metric_column])
    }


def table_counts(dataset: Dataset, table: str, rules: Iterable[Row]) -> DataFrame:
    """``(rule_key, failed_count)`` of all row rules of a table, one scan."""
    df = dataset[table]
    return fused_counts(df, {r.rule_id: F.expr(r.failure_predicate) for r in _by_column(rules)})


def _by_column(rules: Iterable[Row]) -> list[Row]:
    return sorted(rules, key=lambda r: r.metric_column)


def _run_footer_rules(run: _Run, table: str, rules: list[Row], columns: dict[str, str]) -> list[tuple]:
    started = time.time()
    try:
        with _limited(run):
            rows = footer_null_counts(run.dataset.counting[table], columns).collect()
    except Exception:  # noqa: BLE001 - files without statistics: count from the data
        return _run_row_rules(run, table, rules)
    counts = {r.rule_key: r.failed_count for r in rows}
    return [_outcome(r, counts[r.rule_id], None, started) for r in rules]


def _run_row_rules(run: _Run, table: str, rules: list[Row]) -> list[tuple]:
    df = run.dataset[table]
    started = time.time()
    good, bad = _runnable(run, df, rules)
    counts, broken = _count_together(run, df, good)
    bad.update(broken)
    return [_outcome(r, counts.get(r.rule_id), bad.get(r.rule_id), started) for r in rules]


def _count_together(
    run: _Run, df: DataFrame, predicates: dict[str, Column]
) -> tuple[dict[str, int], dict[str, Exception]]:
    """Counts from one job; if a row breaks it, halves are tried until the rule is found."""
    if not predicates:
        return {}, {}
    try:
        with _limited(run):
            rows = fused_counts(df, predicates).collect()
        return {r.rule_key: r.failed_count for r in rows}, {}
    except Exception as error:  # noqa: BLE001
        if len(predicates) == 1:
            return {}, dict.fromkeys(predicates, error)
    items = list(predicates.items())
    middle = len(items) // 2
    counts, broken = _count_together(run, df, dict(items[:middle]))
    more_counts, more_broken = _count_together(run, df, dict(items[middle:]))
    return {**counts, **more_counts}, {**broken, **more_broken}


# --- rules with a job of their own -----------------------------------------------


def _count_bad_values(run: _Run, rule: Row, bad: DataFrame, count: Column) -> int:
    """Failing values are kept for the samples, so a failing rule is not run twice."""
    run.bad_values[rule.rule_id] = bad.persist(StorageLevel.MEMORY_AND_DISK)
    failed = run.bad_values[rule.rule_id].agg(count.alias("failed_count")).first().failed_count
    if not failed:
        run.bad_values.pop(rule.rule_id).unpersist()
    return failed


def _count_duplicates(run: _Run, rule: Row) -> int:
    bad = checks.duplicate_values(run.dataset[rule.source_table_id], rule.metric_column)
    return _count_bad_values(run, rule, bad, F.count(F.lit(1)))


def _count_orphans(run: _Run, rule: Row) -> int:
    bad = checks.orphan_values(
        run.dataset[rule.source_table_id], rule.metric_column,
        run.dataset[rule.ref_table], rule.ref_column,
    )
    return _count_bad_values(run, rule, bad, F.coalesce(F.sum("n"), F.lit(0)))


def _count_sql(run: _Run, rule: Row) -> int:
    row = checks.sql_check(run.dataset.spark, rule.rule_sql).first()
    if row is None:
        return 0
    if row.failed_count is None:
        raise ValueError("failed_count is NULL")
    return int(row.failed_count)


def _run_single(run: _Run, rule: Row, count: Callable[[_Run, Row], int]) -> list[tuple]:
    started = time.time()
    try:
        with _limited(run):
            failed = count(run, rule)
        return [_outcome(rule, failed, None, started)]
    except Exception as error:  # noqa: BLE001
        return [_outcome(rule, None, error, started)]


def _rule_specs(models: DataFrame, rules: list[Row]) -> list[anomalies.SeriesSpec]:
    """Series of the anomaly rules, from their model rows: one row per rule."""
    names = [anomalies.model_name(r.source_table_id, r.metric_column) for r in rules]
    rows = models.where(F.col("series_id").isin(names)).select(
        "table_name", "time_column", "metric_column", "unit", "training_start", "training_end"
    )
    return [anomalies.SeriesSpec(*r) for r in rows.collect()]


def _check_spec(dataset: Dataset, spec: anomalies.SeriesSpec) -> Exception | None:
    """What keeps a series from being scored, found without a job."""
    try:
        dataset[spec.table].select(col(spec.time_column), col(spec.metric)).schema
    except Exception as error:  # noqa: BLE001 - one series never stops the others
        return error
    return None


def _flag_together(
    run: _Run, specs: list[anomalies.SeriesSpec]
) -> tuple[list[DataFrame], dict[str, int], dict[str, Exception]]:
    """Flags and counts of all series from one scoring; halves are tried if it fails."""
    if not specs:
        return [], {}, {}
    try:
        with _limited(run):
            flags = anomalies.flag_series(run.dataset, run.models, specs, run.as_of)
            flags = flags.persist(StorageLevel.MEMORY_AND_DISK)
            rows = anomalies.anomaly_counts(flags).collect()
        return [flags], {r.series_id: r.failed_count for r in rows}, {}
    except Exception as error:  # noqa: BLE001
        if len(specs) == 1:
            return [], {}, {specs[0].series_id: error}
    middle = len(specs) // 2
    some, more = _flag_together(run, specs[:middle]), _flag_together(run, specs[middle:])
    return some[0] + more[0], {**some[1], **more[1]}, {**some[2], **more[2]}


def _run_anomaly_rules(run: _Run, rules: list[Row]) -> list[tuple]:
    """All anomaly rules from one scoring of the series that can be scored."""
    started = time.time()
    try:
        if run.models is None:
            raise ValueError("no trained models were given")
        specs = {s.series_id: s for s in _rule_specs(run.models, rules)}
    except Exception as error:  # noqa: BLE001
        return [_outcome(r, None, error, started) for r in rules]
    errors = {i: e for i, s in specs.items() if (e := _check_spec(run.dataset, s)) is not None}
    flags, counts, broken = _flag_together(run, [s for i, s in specs.items() if i not in errors])
    errors.update(broken)
    if flags:
        run.flags = reduce(DataFrame.unionByName, flags)
        run.flags.createOrReplaceTempView(FLAGS_VIEW)
        run.kept += flags
    outcomes = []
    for rule in rules:
        name = anomalies.model_name(rule.source_table_id, rule.metric_column)
        error = errors.get(name) or (None if name in specs else ValueError(f"no model {name}"))
        outcomes.append(_outcome(rule, None if error else counts.get(name, 0), error, started))
    return outcomes


# --- the run ---------------------------------------------------------------------


def _submit_all(run: _Run, rules: list[Row]) -> list:
    """Independent jobs side by side; Spark shares the executors between them."""
    by_table: dict[str, list[Row]] = {}
    anomaly: list[Row] = []
    tasks: list[tuple] = []
    for rule in rules:
        if rule.failure_predicate is not None:
            by_table.setdefault(rule.source_table_id, []).append(rule)
        elif rule.engine == DUPLICATES:
            tasks.append((_run_single, rule, _count_duplicates))
        elif rule.engine == ORPHANS:
            tasks.append((_run_single, rule, _count_orphans))
        elif rule.engine == SERIES:
            anomaly.append(rule)
        else:
            tasks.append((_run_single, rule, _count_sql))
    if anomaly:
        tasks.append((_run_anomaly_rules, anomaly))
    for table, group in by_table.items():
        if not has_table(run.dataset, table):
            missing = KeyError(f"table {table}")
            tasks.append((lambda _, rs, e=missing: [_outcome(r, None, e, time.time()) for r in rs], group))
            continue
        columns = _footer_columns(run, table, group)
        from_footers = [r for r in group if r.rule_id in columns]
        from_rows = [r for r in group if r.rule_id not in columns]
        if from_footers:
            tasks.append((_run_footer_rules, table, from_footers, columns))
        if from_rows:
            tasks.append((_run_row_rules, table, from_rows))
    return [_submit(run, *task) for task in tasks]


def _submit(run: _Run, work: Callable, *args):
    return run.pool.submit(inheritable_thread_target(run.dataset.spark)(work), run, *args)


def with_status(counts: DataFrame) -> DataFrame:
    """``status`` from ``failed_count`` and ``error``."""
    return counts.withColumn(
        "status",
        F.when(F.col("error").isNotNull(), "ERROR")
        .when(F.col("failed_count") > 0, "FAIL")
        .otherwise("PASS"),
    )


def to_results(counts: DataFrame, rules: DataFrame, run_id: str) -> DataFrame:
    """Result rows of one run; ``failed_rows`` only where the rule failed."""
    joined = with_status(counts).join(rules, "rule_id")
    fields = {
        "result_id": F.sha2(F.concat_ws("|", F.lit(run_id), "rule_id"), 256),
        "execution_timestamp": F.col("finished_at"),
        "execution_duration_seconds": F.col("seconds"),
        "failed_rows": F.when(F.col("status") == "FAIL", F.col("failed_count")),
        "error_message": F.col("error"),
    }
    return joined.select(
        *[fields.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA]
    )


def failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("status").isin("FAIL", "ERROR"))


def _sample_failing(run: _Run, rules: list[Row]) -> tuple[list[tuple], dict[str, str]]:
    """At most ten ``(rule_id, source_id)`` per failing rule, and messages of failed looks."""
    by_table: dict[str, list[Row]] = {}
    waiting = []
    for rule in rules:
        if rule.failure_predicate is not None:
            by_table.setdefault(rule.source_table_id, []).append(rule)
        elif rule.rule_id in run.bad_values or rule.engine in (SERIES, VARIANTS):
            waiting.append(([rule], _submit(run, _sample_single, rule)))
    for table, group in by_table.items():
        waiting.append((group, _submit(run, _sample_rows, table, group)))
    rows: list[tuple] = []
    notes: dict[str, str] = {}
    for group, future in waiting:
        try:
            rows += future.result()
        except Exception as error:  # noqa: BLE001 - a sample never changes a status
            notes.update({r.rule_id: f"sample: {error}" for r in group})
    return rows, notes


def _sample_rows(run: _Run, table: str, rules: list[Row]) -> list[tuple]:
    df = run.dataset[table]
    predicates = {r.rule_id: F.expr(r.failure_predicate) for r in rules}
    with _limited(run):
        found = samples.sample_table(df, key_column(df), predicates)
        return [tuple(r) for r in found.collect()]


def _sample_single(run: _Run, rule: Row) -> list[tuple]:
    with _limited(run):
        found = sample_for(run, rule)
        return [] if found is None else [(rule.rule_id, r.source_id_val) for r in found.collect()]


def sample_for(run: _Run, rule: Row) -> DataFrame | None:
    """Sample of a rule with its own job; None for families without one."""
    df = run.dataset[rule.source_table_id]
    key = key_column(df)
    if rule.rule_id in run.bad_values:
        return samples.sample_values(df, key, rule.metric_column, run.bad_values[rule.rule_id])
    if rule.engine == VARIANTS:
        return samples.sample_variants(df, key, rule.metric_column)
    if rule.engine == SERIES and run.flags is not None:
        name = anomalies.model_name(rule.source_table_id, rule.metric_column)
        flags = run.flags.where(F.col("series_id") == name)
        recent = anomalies.recent_source(run.dataset, rule.source_table_id, rule.time_column, run.as_of)
        return samples.sample_anomalies(recent, key, rule.time_column, flags, rule.bucket_unit)
    return None


def _to_samples(dataset: Dataset, rows: list[tuple], results: DataFrame, rules: DataFrame) -> DataFrame:
    found = small_frame(dataset.spark, rows, "rule_id string, source_id string")
    joined = found.join(
        results.select("rule_id", "result_id", "execution_timestamp"), "rule_id"
    ).join(rules, "rule_id")
    fields = {
        "failed_row_entry_id": F.sha2(F.concat_ws("|", "result_id", F.expr("uuid()")), 256)
    }
    return joined.select(
        *[fields.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SAMPLE_SCHEMA]
    )


def run_rules(
    dataset: Dataset,
    rules: DataFrame,
    models: DataFrame | None = None,
    as_of: dt.date | None = None,
    run_id: str | None = None,
    include_pass: bool = False,
    with_samples: bool = True,
    workers: int = WORKERS,
    limit_seconds: float | None = None,
) -> RunOutcome:
    """Run every rule. Only counts, errors and sample ids come back to the driver.

    ``limit_seconds``: a rule whose jobs take longer is stopped and becomes an error.
    """
    spark = dataset.spark
    dataset.register_views()
    run_id = run_id or dt.datetime.now(dt.timezone.utc).isoformat()
    listed = rules.collect()
    by_id = {r.rule_id: r for r in listed}
    named = T.StructType([f for f in RULE_SCHEMA if f.name in IDENTITY_FIELDS])
    defined = small_frame(spark, [[r[n] for n in named.names] for r in listed], named)
    with ThreadPoolExecutor(workers) as pool:
        run = _Run(dataset, models, as_of, pool, limit_seconds)
        outcomes = [o for f in _submit_all(run, listed) for o in f.result()]
        failing = [by_id[o[0]] for o in outcomes if o[2] is None and (o[1] or 0) > 0]
        rows, notes = _sample_failing(run, failing) if with_samples else ([], {})
    for frame in [*run.bad_values.values(), *run.kept]:
        frame.unpersist()
    counts = small_frame(spark, outcomes, OUTCOME_SCHEMA)
    results = to_results(counts, defined, run_id)
    if notes:
        noted = small_frame(spark, notes.items(), "rule_id string, note string")
        results = (
            results.join(noted, "rule_id", "left")
            .withColumn("error_message", F.coalesce("error_message", "note"))
            .select(RESULT_SCHEMA.fieldNames())
        )
    sampled = _to_samples(dataset, rows, results, defined)
    return RunOutcome(results if include_pass else failures(results), sampled)
