"""One callable ``(spark, sf_dir) -> DataFrame`` per operator of the engine."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.functions.text import NAMED_FORMATS, shape_mask
from dqloom.operators import anomalies, ar1, arima, checks, patterns, samples, series
from dqloom.plans import generate, maintain, reports
from dqloom.plans.execute import failures, run_rules, table_counts
from dqloom.plans.pipeline import generate_into, run_stored
from dqloom.session import cut_lineage, shared_folder, small_frame
from dqloom.sources import catalog, store
from dqloom.sources import dataset as sources
from dqloom.sources.dataset import Dataset

from .inputs import (
    ALL_TABLES,
    CALENDAR,
    EVENTS_AS_OF,
    FOREIGN_KEYS,
    ORDERS_AS_OF,
    PRIORITY,
    RUN_TABLES,
    tables,
)

QUERIES = {}


def query(name: str, *table_names: str):
    """Register ``fn(dataset)`` as the query ``name`` over the named tables."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tables(spark, sf_dir, *table_names))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return register


def text(name: str):
    """Dates and times leave as text, which both engines print alike."""
    return F.col(name).cast("string").alias(name)


def rounded(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- sources and metadata --------------------------------------------------------


@query("s1_scan_row_counts", *ALL_TABLES)
def _(ds: Dataset):
    return sources.row_counts(ds)


@query("s2_list_tables", *ALL_TABLES)
def _(ds: Dataset):
    keys = [
        ds[t].agg(F.count(catalog.key_column(ds[t])).alias("keys")).select(F.lit(t).alias("table_name"), "keys")
        for t in ds.tables
    ]
    return sources.list_tables(ds).join(union(keys), "table_name")


def _null_counts(ds: Dataset) -> DataFrame:
    return union(
        [
            checks.null_profile(df).select(F.lit(t).alias("table_name"), "column_name", "failed_count")
            for t, df in ds.tables.items()
        ]
    )


@query("s3_column_catalog", *ALL_TABLES)
def _(ds: Dataset):
    return catalog.column_catalog(ds).join(_null_counts(ds), ["table_name", "column_name"])


@query("s4_key_columns", *ALL_TABLES)
def _(ds: Dataset):
    def one(table: str, df: DataFrame) -> DataFrame:
        key = catalog.key_column(df)
        return checks.uniqueness_check(df, key).select(
            F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "failed_count"
        )

    return union([one(t, df) for t, df in ds.tables.items()])


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/dqloom-store-{uuid.uuid4().hex}"


# --- failure counts --------------------------------------------------------------


@query("n1_null_check_orders_dirty_custkey", "orders_dirty")
def _(ds: Dataset):
    return checks.null_check(ds["orders_dirty"], "o_custkey")


@query("n2_null_check_orders_dirty_totalprice", "orders_dirty")
def _(ds: Dataset):
    return checks.null_check(ds["orders_dirty"], "o_totalprice")


for _table in ("orders_dirty", "lineitem", "embeddings", "documents"):

    @query(f"n3_null_profile_{_table}", _table)
    def _(ds: Dataset, table=_table):
        return checks.null_profile(ds[table])


@query("n3_null_profile_all_tables", *ALL_TABLES, "orders_dirty")
def _(ds: Dataset):
    return _null_counts(ds)


for _table, _column in (
    ("orders_dirty", "o_orderkey"),
    ("lineitem", "l_orderkey"),
    ("conversations", "conv_id"),
    ("documents", "doc_id"),
):

    @query(f"u1_uniqueness_{_table}", _table)
    def _(ds: Dataset, table=_table, column=_column):
        return checks.uniqueness_check(ds[table], column)

    @query(f"u1_duplicate_rows_{_table}", _table)
    def _(ds: Dataset, table=_table, column=_column):
        return checks.duplicate_rows(ds[table], column)


@query("f1_format_check_priority", "orders_dirty")
def _(ds: Dataset):
    return checks.format_check(ds["orders_dirty"], "o_orderpriority", PRIORITY)


@query("f1_format_check_document_text", "documents")
def _(ds: Dataset):
    return checks.format_check(ds["documents"], "text", "[.!?]$")


@query("f2_empty_check_priority", "orders_dirty")
def _(ds: Dataset):
    return checks.empty_check(ds["orders_dirty"], "o_orderpriority")


for _child, _column, _parent, _key in (
    ("orders_dirty", "o_custkey", "customer", "c_custkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("lineitem", "l_orderkey", "orders_dirty", "o_orderkey"),
    ("events", "user_id", "customer", "c_custkey"),
):

    @query(f"r1_ri_{_child}_{_parent}", _child, _parent)
    def _(ds: Dataset, child=_child, column=_column, parent=_parent, key=_key):
        return checks.ri_check(ds[child], column, ds[parent], key)


@query("x1_sql_rule", "lineitem", "orders_dirty")
def _(ds: Dataset):
    ds.register_views()
    return checks.sql_check(
        ds["lineitem"].sparkSession,
        "SELECT count(*) AS failed_count FROM lineitem JOIN orders_dirty "
        "ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate ; ",
    )


# --- samples ---------------------------------------------------------------------


@query("p1_sample_nulls", "orders_dirty")
def _(ds: Dataset):
    return samples.sample_nulls(ds["orders_dirty"], "o_orderkey", "o_totalprice")


for _table, _key in (("orders_dirty", "o_orderkey"), ("lineitem", "l_orderkey"), ("conversations", "conv_id")):

    @query(f"p2_sample_duplicates_{_table}", _table)
    def _(ds: Dataset, table=_table, key=_key):
        return samples.sample_duplicates(ds[table], key, key)


@query("p3_sample_orphans_orders_dirty", "orders_dirty", "customer")
def _(ds: Dataset):
    return samples.sample_orphans(ds["orders_dirty"], "o_orderkey", "o_custkey", ds["customer"], "c_custkey")


@query("p3_sample_orphans_documents", "documents", "labels")
def _(ds: Dataset):
    return samples.sample_orphans(ds["documents"], "doc_id", "doc_id", ds["labels"], "doc_id")


@query("p4_sample_format", "orders_dirty")
def _(ds: Dataset):
    return samples.sample_format(ds["orders_dirty"], "o_orderkey", "o_orderpriority", PRIORITY)


@query("p7_sample_table", "orders_dirty")
def _(ds: Dataset):
    failing = {
        "no_customer": F.col("o_custkey").isNull(),
        "no_price": F.col("o_totalprice").isNull(),
        "priority": ~F.col("o_orderpriority").rlike(PRIORITY),
        "never": F.col("o_orderkey") < 0,
    }
    return samples.sample_table(ds["orders_dirty"], "o_orderkey", failing)


# --- time series -----------------------------------------------------------------


@query("t1_t2_series_columns", "orders_dirty", "lineitem", "events")
def _(ds: Dataset):
    def one(table: str, columns: tuple[str, str]) -> DataFrame:
        time_column, metric = columns
        return ds[table].agg(
            F.max(F.to_date(time_column)).cast("string").alias("newest"),
            F.count(metric).alias("metric_values"),
        ).select(
            F.lit(table).alias("table_name"),
            F.lit(time_column).alias("time_column"),
            F.lit(metric).alias("metric_column"),
            "newest",
            "metric_values",
        )

    return union([one(t, c) for t, c in anomalies.series_columns(ds).items()])


TIMED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


@query("t3_training_window_through_max", *TIMED)
def _(ds: Dataset):
    windows = [
        series.training_window(ds[t], c, EVENTS_AS_OF, through_max=True).withColumn("table_name", F.lit(t))
        for t, c in TIMED.items()
    ]
    return union(windows).select("table_name", text("training_start"), text("training_end"))


@query("t3_training_window_before_as_of", "events", "orders")
def _(ds: Dataset):
    windows = [
        series.training_window(ds[t], TIMED[t], EVENTS_AS_OF).withColumn("table_name", F.lit(t))
        for t in ("events", "orders")
    ]
    return union(windows).select("table_name", text("training_start"), text("training_end"))


@query("t4_training_rows_orders", "orders_dirty")
def _(ds: Dataset):
    df = ds["orders_dirty"]
    window = series.training_window(df, "o_orderdate", ORDERS_AS_OF).first()
    rows = series.training_rows(df, "o_orderdate", "o_totalprice", window.training_start, window.training_end)
    return rows.select("o_orderkey", text("o_orderdate"), rounded("o_totalprice", 4))


@query("t5_recent_rows_events", "events")
def _(ds: Dataset):
    return series.recent_rows(ds["events"], "ts", EVENTS_AS_OF).select("event_id", rounded("value"))


def _frequencies(ds: Dataset, timed: dict[str, str]) -> DataFrame:
    def one(table: str, column: str) -> DataFrame:
        shares = series.frequency_coverage(ds[table], column)
        unit = series.finest_covered().alias("unit")
        return shares.select(F.lit(table).alias("table_name"), *[rounded(u) for u in series.UNITS], "seen", unit)

    return union([one(t, c) for t, c in timed.items()])


@query("t6_frequency", *TIMED)
def _(ds: Dataset):
    return _frequencies(ds, TIMED)


@query("t6_frequency_calendar", *CALENDAR)
def _(ds: Dataset):
    """Tables of a row a week, month, quarter and year."""
    return _frequencies(ds, dict.fromkeys(CALENDAR, "first_day"))


def _events_hourly(ds: Dataset, how: str = "sum") -> DataFrame:
    return series.resample(ds["events"], "events", "ts", "value", "hour", how)


@query("t7_resample_events_minutes", "events")
def _(ds: Dataset):
    filled = series.resample(ds["events"], "events", "ts", "value", "minute")
    return filled.select(text("bucket"), rounded("y", 8), "filled")


def _resampled(unit: str):
    def run(ds: Dataset):
        table = f"orders_{unit}ly"
        filled = series.resample(ds[table], table, "first_day", "order_count", unit)
        return filled.select(text("bucket"), rounded("y", 8), "filled")

    run.__doc__ = f"One bucket a {unit}, none invented where the table has one."
    return run


for _unit in ("week", "month", "quarter", "year"):
    query(f"t7_resample_{_unit}ly", f"orders_{_unit}ly")(_resampled(_unit))


@query("t7_resample_orders_by_month", "orders")
def _(ds: Dataset):
    """Months of a daily table, those of few orders left out."""
    few = ds["orders"].where("month(o_orderdate) not in (2, 3, 7)")
    filled = series.resample(few, "orders", "o_orderdate", "o_orderkey", "month")
    return filled.select(text("bucket"), rounded("y", 4), "filled")


@query("t8_deseasonalize_events", "events")
def _(ds: Dataset):
    return series.deseasonalize(_events_hourly(ds), "hour").select(text("bucket"), rounded("y", 9))


@query("t8_deseasonalize_orders_weekly", "orders")
def _(ds: Dataset):
    daily = series.resample(ds["orders"], "orders", "o_orderdate", "o_totalprice", "day")
    return series.deseasonalize(daily, "day").select(text("bucket"), rounded("y", 5))


@query("t9_difference_events", "events")
def _(ds: Dataset):
    return series.difference(_events_hourly(ds), 1).select(text("bucket"), rounded("y", 4))


@query("t10_fit_ar1_events", "events")
def _(ds: Dataset):
    return ar1.fit_ar1(_events_hourly(ds)).select(
        "series_id", "n", rounded("phi"), rounded("intercept", 4), rounded("sigma", 4),
        text("last_bucket"), rounded("last_y", 4),
    )


def _split_events(ds: Dataset) -> tuple[DataFrame, DataFrame]:
    """Hourly sums trained before the date, and those from it on."""
    df = ds["events"]
    window = series.training_window(df, "ts", EVENTS_AS_OF).first()
    past = series.training_rows(df, "ts", "value", window.training_start, window.training_end)
    trained = series.resample(past, "events", "ts", "value", "hour", "sum")
    recent = series.bucketed(series.recent_rows(df, "ts", EVENTS_AS_OF), "events", "ts", "value", "hour", "sum")
    return trained, cut_lineage(recent)


def _flags_ahead(ds: Dataset) -> DataFrame:
    trained, recent = _split_events(ds)
    return ar1.detect_anomalies(ar1.score_ahead(ar1.fit_ar1(trained), recent, "hour"))


@query("t13_forecast_ar1_events", "events")
def _(ds: Dataset):
    return _flags_ahead(ds).select(text("bucket"), rounded("forecast", 4), rounded("se", 4))


@query("t14_detect_anomalies_events", "events")
def _(ds: Dataset):
    return _flags_ahead(ds).select(
        text("bucket"), rounded("y", 4), rounded("low", 3), rounded("high", 3), "is_anomaly"
    )


@query("t14_flags_in_sample_events", "events")
def _(ds: Dataset):
    hourly = _events_hourly(ds)
    flags = ar1.detect_anomalies(ar1.score_in_sample(ar1.fit_ar1(hourly), hourly))
    return flags.where("is_anomaly").select(text("bucket"), rounded("y", 4), rounded("forecast", 3))


@query("a1_anomaly_check_events_ahead", "events")
def _(ds: Dataset):
    return ar1.anomaly_check(_flags_ahead(ds))


def _orders_flags(ds: Dataset) -> DataFrame:
    """Daily means of the newest 91 days against one-step forecasts."""
    df = ds["orders_dirty"]
    window = series.training_window(df, "o_orderdate", through_max=True).first()
    rows = series.training_rows(df, "o_orderdate", "o_totalprice", window.training_start, window.training_end)
    daily = series.resample(rows, "orders", "o_orderdate", "o_totalprice", "day")
    return ar1.detect_anomalies(ar1.score_in_sample(ar1.fit_ar1(daily), daily))


@query("a1_anomaly_check_orders_in_sample", "orders_dirty")
def _(ds: Dataset):
    return ar1.anomaly_check(_orders_flags(ds))


@query("p5_sample_anomalies", "orders_dirty")
def _(ds: Dataset):
    return samples.sample_anomalies(
        ds["orders_dirty"], "o_orderkey", "o_orderdate", _orders_flags(ds), "day"
    )


@query("t11_t12_auto_order_models", "events", "orders_dirty", "lineitem")
def _(ds: Dataset):
    """Automatic order; no SQL equivalent, numeric tests cover it."""
    models = generate.train_models(ds, through_max=True)
    return models.select(
        "series_id", "unit", "n", "p", "d", "q", rounded("intercept"), rounded("sigma"),
        text("training_start"), text("training_end"), text("last_bucket"),
    )


@query("t11_difference_order", "events")
def _(ds: Dataset):
    """The stationarity statistic and the difference order it asks for."""
    return arima.difference_order(_events_hourly(ds)).select("series_id", "n", rounded("kpss"), "d")


@query("a1_anomaly_check_auto_order", "orders_dirty")
def _(ds: Dataset):
    """Flags of automatic-order models on the newest days they were trained on."""
    spec = anomalies.series_spec(
        ds["orders_dirty"], "orders_dirty", "o_orderdate", "o_totalprice", ORDERS_AS_OF
    )
    models = anomalies.train(ds, [spec])
    flags = anomalies.flag_series(ds, models, [spec], ORDERS_AS_OF)
    return anomalies.anomaly_counts(flags)


# --- patterns --------------------------------------------------------------------


@query("g1_distinct_sample_url", "pages")
def _(ds: Dataset):
    return patterns.distinct_sample(ds["pages"], "url")


@query("g1_distinct_sample_name", "customer")
def _(ds: Dataset):
    return patterns.distinct_sample(ds["customer"], "c_name")


@query("g2_shape_mask", "documents")
def _(ds: Dataset):
    return ds["documents"].select("doc_id", F.md5(shape_mask(F.col("text"))).alias("shape_md5"))


for _table, _column in (("orders_dirty", "o_orderpriority"), ("pages", "url"), ("benchmark", "text")):

    @query(f"g3_shape_profile_{_table}", _table)
    def _(ds: Dataset, table=_table, column=_column):
        return patterns.shape_profile(ds[table], column)


G4_TABLES = {
    "orders_dirty": ["o_orderstatus", "o_orderpriority"],
    "documents": ["text", "lang", "source"],
    "part": ["p_name", "p_brand", "p_type"],
}
for _table, _columns in G4_TABLES.items():

    @query(f"g4_dominant_shapes_{_table}", _table)
    def _(ds: Dataset, table=_table, columns=_columns):
        shapes = patterns.dominant_shapes(ds[table], columns)
        return shapes.select("column_name", "shape", "n", rounded("share"), rounded("running"))


@query("g4_dominant_pattern_priority", "orders_dirty")
def _(ds: Dataset):
    shapes = patterns.dominant_shapes(ds["orders_dirty"], ["o_orderpriority"])
    return patterns.dominant_patterns(shapes)


@query("g5_pattern_violations", "orders_dirty")
def _(ds: Dataset):
    df = ds["orders_dirty"]
    regex = patterns.dominant_pattern(df, "o_orderpriority")
    return patterns.pattern_violations(df, "o_orderpriority", regex).select("o_orderkey", "o_orderpriority")


@query("g6_case_variants_priority", "orders_dirty")
def _(ds: Dataset):
    return patterns.case_variants(ds["orders_dirty"], "o_orderpriority")


@query("g6_case_variants_document_text", "documents")
def _(ds: Dataset):
    return patterns.case_variants(ds["documents"], "text")


for _table, _key, _column in (("documents", "doc_id", "text"), ("pages", "page_id", "url"), ("pages", "page_id", "html")):

    @query(f"g7_odd_characters_{_table}_{_column}", _table)
    def _(ds: Dataset, table=_table, key=_key, column=_column):
        return patterns.odd_characters(ds[table], column).select(key)

    @query(f"g8_odd_lengths_{_table}_{_column}", _table)
    def _(ds: Dataset, table=_table, key=_key, column=_column):
        return patterns.odd_lengths(ds[table], column).select(key, F.length(column).cast("bigint").alias("chars"))


@query("g9_named_formats", "documents", "customer", "conversations")
def _(ds: Dataset):
    """Every named format against three text columns, all in one scan per table."""
    frames = []
    for table, column in (("documents", "text"), ("customer", "c_name"), ("conversations", "role")):
        misses = {name: ~F.col(column).rlike(regex) for name, regex in NAMED_FORMATS.items()}
        counts = checks.fused_counts(ds[table], misses)
        frames.append(counts.select(F.lit(table).alias("table_name"), F.col("rule_key").alias("format"), "failed_count"))
    return union(frames)


# --- rule generation: each rule is shown with what it finds ----------------------


def _with_counts(ds: Dataset, rules: DataFrame) -> DataFrame:
    """Rules of a dataset with their status and failing rows."""
    results = run_rules(ds, rules, include_pass=True, with_samples=False).results
    return rules.join(results.select("rule_id", "status", "failed_rows"), "rule_id")


def _failed():
    return F.coalesce("failed_rows", F.lit(0).cast("bigint")).alias("failed_rows")


@query("k1_null_rules", *RUN_TABLES)
def _(ds: Dataset):
    rules = generate.null_rules(catalog.column_catalog(ds), ds)
    return _with_counts(ds, rules).select("rule_id", "rule_sql", "rule_description", _failed())


@query("k2_uniqueness_rules", *RUN_TABLES)
def _(ds: Dataset):
    rules = generate.uniqueness_rules(catalog.column_catalog(ds), ds)
    return _with_counts(ds, rules).select("rule_id", "rule_sql", "rule_description", _failed())


K3_TABLES = ("customer", "orders_dirty", "lineitem", "part", "labels")


@query("k3_format_rules", *K3_TABLES)
def _(ds: Dataset):
    profile = generate.profile_patterns(ds, inconsistencies=False)
    rules = generate.format_rules(catalog.column_catalog(ds), ds, profile)
    clear = profile.select(
        F.col("table_name").alias("source_table_id"),
        F.col("column_name").alias("metric_column"),
        F.col("regex").isNotNull().alias("clear"),
    )
    return _with_counts(ds, rules).join(clear, ["source_table_id", "metric_column"]).select(
        "source_table_id", "metric_column", "clear", _failed()
    )


@query("k3_format_rules_with_inconsistencies", "documents", "pages", "conversations")
def _(ds: Dataset):
    """Rules on characters, lengths and case for columns without a clear pattern."""
    rules = generate.format_rules(catalog.column_catalog(ds), ds, generate.profile_patterns(ds))
    return _with_counts(ds, rules).select(
        "source_table_id", "metric_column", "rule_description", _failed()
    )


@query("k4_anomaly_rules", "orders_dirty", "lineitem", "customer")
def _(ds: Dataset):
    """Trained models and the rules made of them: none for tables without a time column."""
    rules = generate.anomaly_rules(generate.train_models(ds, through_max=True), ds)
    return rules.select("source_table_id", "metric_column", "rule_family", "rule_description", "bucket_unit")


@query("k4_anomaly_rules_calendar", "orders_weekly", "orders_monthly", "orders_yearly")
def _(ds: Dataset):
    """Weekly and monthly tables are trained in their own unit; a few years are too short."""
    rules = generate.anomaly_rules(generate.train_models(ds, through_max=True), ds)
    return rules.select("source_table_id", "metric_column", "rule_family", "rule_description", "bucket_unit")


@query("k5_reference_rules", *RUN_TABLES)
def _(ds: Dataset):
    rules = generate.reference_rules(FOREIGN_KEYS, ds)
    return _with_counts(ds, rules).select("source_table_id", "metric_column", "rule_description", _failed())


def _base_rules(ds: Dataset) -> DataFrame:
    """Null, uniqueness and referential rules, one known format, emptiness for the rest."""
    columns = catalog.column_catalog(ds)
    known = small_frame(
        ds.spark,
        [("orders_dirty", "o_orderpriority", PRIORITY, None, None)],
        "table_name string, column_name string, regex string, low double, high double",
    )
    return union(
        [
            generate.null_rules(columns, ds),
            generate.uniqueness_rules(columns, ds),
            generate.reference_rules(FOREIGN_KEYS, ds),
            generate.format_rules(columns, ds, known),
        ]
    )


def _bad_rules(ds: Dataset) -> DataFrame:
    """A rule on a missing column and one with a broken regex."""
    like = generate.null_rules(catalog.column_catalog(ds), ds)
    missing = maintain.new_rule(like, "lineitem", "l_missing", "Null Check", "SELECT 1", None, "l_missing IS NULL")
    broken = maintain.new_rule(like, "lineitem", "l_shipmode", "String Formatting", "SELECT 2", None, "l_returnflag RLIKE '('")
    return missing.unionByName(broken)


@query("k6_descriptions", *RUN_TABLES)
def _(ds: Dataset):
    rules = _with_counts(ds, _base_rules(ds))
    return rules.groupBy("rule_family").agg(
        F.count(F.lit(1)).alias("rules"),
        F.sum(F.length("rule_description").cast("bigint")).alias("description_chars"),
        F.count_if(F.col("status") == "FAIL").alias("failing"),
    )


@query("k8_generate_rules", *RUN_TABLES)
def _(ds: Dataset):
    """All families from one call, with the failing rows of each checked column."""
    rules = generate.generate_rules(ds, FOREIGN_KEYS, forecasts=False).rules
    families = _with_counts(ds, rules).where("rule_family <> 'String Formatting'")
    return families.groupBy("rule_family").agg(
        F.count(F.lit(1)).alias("rules"), F.sum(_failed()).alias("failed_rows")
    )


# --- execution -------------------------------------------------------------------


@query("e1_fused_table_counts", "orders_dirty")
def _(ds: Dataset):
    """The counting plan of one table: every row rule in one scan."""
    rules = _base_rules(ds).where("failure_predicate is not null").collect()
    names = {r.rule_id: (r.metric_column, r.rule_family) for r in rules}
    counts = table_counts(ds, "orders_dirty", rules)
    listed = small_frame(
        ds.spark,
        [(k, *v) for k, v in names.items()], "rule_key string, metric_column string, rule_family string"
    )
    return counts.join(F.broadcast(listed), "rule_key").select("metric_column", "rule_family", "failed_count")


@query("e1_run_rules", *RUN_TABLES)
def _(ds: Dataset):
    outcome = run_rules(ds, _base_rules(ds), include_pass=True, with_samples=False)
    return outcome.results.select(
        "source_table_id", "metric_column", "rule_family", "status", _failed()
    )


@query("e2_e3_status_and_results", *RUN_TABLES)
def _(ds: Dataset):
    """Statuses with rules that cannot run; NULL failing rows shown as text."""
    rules = _base_rules(ds).unionByName(_bad_rules(ds))
    outcome = run_rules(ds, rules, include_pass=True, with_samples=False)
    return outcome.results.select(
        "source_table_id", "metric_column", "rule_family", "status",
        F.col("failed_rows").cast("string").alias("failed_rows"),
        F.col("error_message").isNotNull().alias("has_error"),
    )


def _failing_run(ds: Dataset, with_samples: bool = False):
    rules = _base_rules(ds).unionByName(_bad_rules(ds))
    return rules, run_rules(ds, rules, with_samples=with_samples)


@query("e4_failures", *RUN_TABLES)
def _(ds: Dataset):
    rules = _base_rules(ds).unionByName(_bad_rules(ds))
    everything = run_rules(ds, rules, include_pass=True, with_samples=False).results
    return failures(everything).select("source_table_id", "metric_column", "rule_family", "status")


@query("e5_collect_samples", *RUN_TABLES)
def _(ds: Dataset):
    rules, outcome = _failing_run(ds, with_samples=True)
    return reports.sample_details(outcome.samples, rules).select(
        "source_table_id", "metric_column", "rule_family", "source_id"
    )


@query("e5_samples_of_format_rules", "orders_dirty")
def _(ds: Dataset):
    """Samples of every failing format rule of a column without a clear pattern."""
    bounds = [("orders_dirty", "o_orderpriority", None, 1.0, 9.5)]
    known = small_frame(ds.spark, bounds, "table_name string, column_name string, regex string, low double, high double")
    columns = catalog.column_catalog(ds).where("column_name = 'o_orderpriority'")
    rules = generate.format_rules(columns, ds, known)
    outcome = run_rules(ds, rules)
    listed = rules.select("rule_id", F.coalesce("failure_predicate", "engine").alias("checked"))
    return outcome.samples.join(listed, "rule_id").select("checked", "source_id")


@query("s12_store_round_trip", *RUN_TABLES)
def _(ds: Dataset):
    """Rules written and read back, run, results written and read back."""
    folder = _folder(ds.spark)
    store.ensure_store(ds.spark, folder)
    store.write_rules(_base_rules(ds), folder)
    run_stored(ds, folder)
    kept = store.read_results(ds.spark, folder).join(
        store.read_rules(ds.spark, folder).select("rule_id", "rule_description"), "rule_id"
    )
    return kept.select("source_table_id", "metric_column", "rule_description", "status", "failed_rows")


@query("run_generated_and_stored", "orders_dirty", "customer", "documents", "labels")
def _(ds: Dataset):
    """The whole loop with forecasts: generate, store, run, store."""
    folder = _folder(ds.spark)
    generate_into(ds, folder, FOREIGN_KEYS, ORDERS_AS_OF)
    return run_stored(ds, folder, ORDERS_AS_OF).results.select(
        "source_table_id", "metric_column", "rule_family", "status", "failed_rows"
    )


# --- reports ---------------------------------------------------------------------


def _report(name: str, report, *columns):
    @query(name, *RUN_TABLES)
    def _(ds: Dataset):
        _, outcome = _failing_run(ds)
        result = report(outcome.results)
        return result.select(*columns) if columns else result


_report("d1_failures_by_table", reports.failures_by_table)
_report("d2_family_division", reports.family_division)
_report("d3_failed_by_metric", reports.failed_by_metric)
_report("d6_alert_lines", reports.alert_lines)
_report(
    "d7_error_alerts", reports.error_alerts,
    "source_dataset_id", "source_table_id", "metric_column", "rule_family",
)


@query("d4_rules_by_family", *RUN_TABLES)
def _(ds: Dataset):
    rules = _with_counts(ds, _base_rules(ds))
    failing = rules.where("status = 'FAIL'")
    return reports.rules_by_family(rules).join(
        reports.rules_by_family(failing).withColumnRenamed("rules", "failing"), "rule_family"
    )


@query("d5_sample_details", "orders_dirty", "customer")
def _(ds: Dataset):
    rules = generate.null_rules(catalog.column_catalog(ds), ds)
    outcome = run_rules(ds, rules)
    return reports.sample_details(outcome.samples, rules).select("source_id", "rule_sql", "rule_description")


# --- maintenance: the changed rules are run ----------------------------------------

C_TABLES = ("orders_dirty", "lineitem")


def _lineitem_rule(rules: DataFrame) -> DataFrame:
    return maintain.new_rule(
        rules, "lineitem", "l_shipdate", "Custom",
        "SELECT count(*) AS failed_count FROM lineitem WHERE l_tax > l_discount",
        "tax above discount", "l_tax > l_discount",
    )


def _key_rules(ds: Dataset) -> DataFrame:
    return generate.uniqueness_rules(catalog.column_catalog(ds), ds)


def _outcomes(ds: Dataset, rules: DataFrame) -> DataFrame:
    return _with_counts(ds, rules).select("source_table_id", "rule_family", "rule_description", _failed())


@query("c1_create_rule", *C_TABLES)
def _(ds: Dataset):
    rules = _key_rules(ds)
    created = maintain.create_rule(rules, _lineitem_rule(rules))
    again = maintain.create_rule(created, _lineitem_rule(rules))
    return _outcomes(ds, again)


@query("c2_find_rules", *C_TABLES)
def _(ds: Dataset):
    found = maintain.find_rules(_base_rules(ds), "source_table_id = 'orders_dirty' AND rule_family = 'Null Check'")
    return _outcomes(ds, found)


@query("c3_update_rule", *C_TABLES)
def _(ds: Dataset):
    rules = maintain.create_rule(_key_rules(ds), _lineitem_rule(_key_rules(ds)))
    changes = maintain.find_rules(rules, "rule_family = 'Custom'").select(
        "rule_id",
        F.lit("tax above twice the discount").alias("rule_description"),
        F.lit("SELECT count(*) AS failed_count FROM lineitem WHERE l_tax > 2 * l_discount").alias("rule_sql"),
        F.lit("l_tax > 2 * l_discount").alias("failure_predicate"),
    )
    return _outcomes(ds, maintain.update_rule(rules, changes))


@query("c3_update_sql_only", "orders_dirty")
def _(ds: Dataset):
    """New SQL alone: it is what runs, not the predicate the rule had."""
    rules = maintain.find_rules(_base_rules(ds), "rule_family = 'Null Check' AND metric_column = 'o_totalprice'")
    sql = "SELECT count(*) AS failed_count FROM orders_dirty WHERE o_totalprice IS NULL OR o_totalprice > 300000"
    changed = maintain.update_rule(rules, rules.select("rule_id", F.lit(sql).alias("rule_sql")))
    return _with_counts(ds, changed).select("source_table_id", "metric_column", "rule_sql", _failed())


@query("x1_user_rule_in_builtin_family", "lineitem")
def _(ds: Dataset):
    """Rules named after built-in families run their own SQL."""
    like = _key_rules(ds)
    sql = "SELECT count(*) AS failed_count FROM lineitem WHERE l_quantity > {}"
    rules = union([
        maintain.new_rule(like, "lineitem", "l_orderkey", family, sql.format(n))
        for family, n in (("Uniqueness", 40), ("Referential Integrity", 30), ("Anomaly Detection", 20), ("Null Check", 60))
    ])
    return _with_counts(ds, rules).select("source_table_id", "rule_family", _failed())


@query("e6_anomaly_isolation", "orders_dirty", "lineitem")
def _(ds: Dataset):
    """Two anomaly rules, the table of one gone: the other one is still counted."""
    rules = generate.anomaly_rules(models := cut_lineage(generate.train_models(ds, as_of=ORDERS_AS_OF)), ds)
    outcome = run_rules(ds.only("orders_dirty"), rules, models, ORDERS_AS_OF, include_pass=True, with_samples=False)
    return outcome.results.select("source_table_id", (F.col("status") == "ERROR").alias("is_error"))


@query("k8_generate_with_broken_table", "customer", "nation")
def _(ds: Dataset):
    """A table that cannot be read is recorded, and the others get their rules."""
    broken = ds["customer"].withColumn("c_name", F.when(F.col("c_custkey") < 0, F.col("c_name")).otherwise(F.raise_error(F.lit("unreadable"))))
    made = generate.generate_rules(Dataset(ds.spark, {**ds.tables, "broken": broken}, ds.name, ds.project, {}), forecasts=False)
    counts = made.rules.where("rule_family <> 'String Formatting'").groupBy(F.col("source_table_id").alias("table_name")).agg(F.count(F.lit(1)).alias("rules"))
    failed = made.errors.select("table_name", "step")
    return counts.join(failed, "table_name", "left")


def _null_profile_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null counts of all tables, from file footers where these have them."""
    ds = sources.load_dataset(spark, sf_dir, ALL_TABLES, footer_counts=True)
    rules = generate.null_rules(catalog.column_catalog(ds), ds)
    return _with_counts(ds, rules).select(
        F.col("source_table_id").alias("table_name"), F.col("metric_column").alias("column_name"), _failed().alias("failed_count")
    )


QUERIES["n3_null_profile_footers"] = _null_profile_footers


@query("c4_delete_rule", *C_TABLES)
def _(ds: Dataset):
    rules = _base_rules(ds)
    ids = [r.rule_id for r in maintain.find_rules(rules, "rule_family <> 'Uniqueness'").collect()]
    return _outcomes(ds, maintain.delete_rule(rules, ids))
