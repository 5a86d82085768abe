"""Reference SQL for DuckDB, one text per query, over the whole tables."""

from __future__ import annotations

from dqloom.functions.names import DESCRIPTIONS
from dqloom.functions.text import NAMED_FORMATS, ODD_CHARACTER

from .inputs import (
    ALL_TABLES,
    CALENDAR,
    EVENTS_AS_OF,
    FOREIGN_KEYS,
    ORDERS_AS_OF,
    ORDERS_DIRTY,
    PRIORITY,
    RUN_TABLES,
    columns_of,
)

ORACLE: dict[str, str] = {}

DIRTY = f"orders_dirty AS ({ORDERS_DIRTY})"


def dirty(select: str) -> str:
    return f"WITH {DIRTY} {select}"


def value(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# --- sources and metadata --------------------------------------------------------

ORACLE["s1_scan_row_counts"] = union(
    [f"SELECT {value(t)} AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES]
)
ORACLE["s2_list_tables"] = union(
    [f"SELECT {value(t)} AS table_name, count({columns_of(t)[0][0]}) AS keys FROM {t}" for t in ALL_TABLES]
)

TYPE_NAMES = """CASE {0} WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
 WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>'
 WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE {0} END"""
ROLES = """CASE {0} WHEN 'BIGINT' THEN 'numeric' WHEN 'INTEGER' THEN 'numeric' WHEN 'DOUBLE' THEN 'numeric'
 WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'time' ELSE 'other' END"""
ORACLE["s3_column_catalog"] = union(
    [
        f"SELECT {value(t)} AS table_name, CAST({i} AS BIGINT) AS ordinal, {value(c)} AS column_name, "
        f"{TYPE_NAMES.format(f'min(typeof({c}))')} AS data_type, 'YES' AS is_nullable, "
        f"{ROLES.format(f'min(typeof({c}))')} AS role, "
        f"count(*) - count({c}) AS failed_count FROM {t}"
        for t in ALL_TABLES
        for i, (c, _) in enumerate(columns_of(t), start=1)
    ]
)


def nulls(table: str, column: str) -> str:
    return f"SELECT count(*) AS failed_count FROM {table} WHERE {column} IS NULL"


def duplicates(table: str, column: str) -> str:
    return (
        f"SELECT count(*) AS failed_count FROM (SELECT {column} FROM {table} "
        f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) AS d"
    )


def orphans(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(c.{column}) AS failed_count FROM {child} AS c LEFT JOIN "
        f"(SELECT DISTINCT {key} AS k FROM {parent}) AS p ON c.{column} = p.k "
        f"WHERE c.{column} IS NOT NULL AND p.k IS NULL"
    )


def misses(table: str, column: str, regex: str) -> str:
    return f"SELECT count(*) AS failed_count FROM {table} WHERE NOT regexp_matches({column}, {value(regex)})"


def empties(table: str, column: str) -> str:
    return f"SELECT count(*) AS failed_count FROM {table} WHERE {column} IS NOT NULL AND length({column}) = 0"


ORACLE["s4_key_columns"] = union(
    [
        f"SELECT {value(t)} AS table_name, {value(columns_of(t)[0][0])} AS key_column, failed_count "
        f"FROM ({duplicates(t, columns_of(t)[0][0])}) AS u"
        for t in ALL_TABLES
    ]
)

# --- failure counts --------------------------------------------------------------

ORACLE["n1_null_check_orders_dirty_custkey"] = dirty(nulls("orders_dirty", "o_custkey"))
ORACLE["n2_null_check_orders_dirty_totalprice"] = dirty(nulls("orders_dirty", "o_totalprice"))
for _t in ("orders_dirty", "lineitem", "embeddings", "documents"):
    ORACLE[f"n3_null_profile_{_t}"] = dirty(
        union([f"SELECT {value(c)} AS column_name, count(*) - count({c}) AS failed_count FROM {_t}" for c, _ in columns_of(_t)])
    )
ORACLE["n3_null_profile_all_tables"] = dirty(
    union(
        [
            f"SELECT {value(t)} AS table_name, {value(c)} AS column_name, count(*) - count({c}) AS failed_count FROM {t}"
            for t in (*ALL_TABLES, "orders_dirty")
            for c, _ in columns_of(t)
        ]
    )
)
for _t, _c in (
    ("orders_dirty", "o_orderkey"),
    ("lineitem", "l_orderkey"),
    ("conversations", "conv_id"),
    ("documents", "doc_id"),
):
    ORACLE[f"u1_uniqueness_{_t}"] = dirty(duplicates(_t, _c))
    ORACLE[f"u1_duplicate_rows_{_t}"] = dirty(
        f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS failed_count FROM (SELECT count(*) AS n FROM {_t} "
        f"WHERE {_c} IS NOT NULL GROUP BY {_c} HAVING count(*) > 1) AS d"
    )
ORACLE["f1_format_check_priority"] = dirty(misses("orders_dirty", "o_orderpriority", PRIORITY))
ORACLE["f1_format_check_document_text"] = misses("documents", "text", "[.!?]$")
ORACLE["f2_empty_check_priority"] = dirty(empties("orders_dirty", "o_orderpriority"))
for _child, _c, _parent, _k in (
    ("orders_dirty", "o_custkey", "customer", "c_custkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("lineitem", "l_orderkey", "orders_dirty", "o_orderkey"),
    ("events", "user_id", "customer", "c_custkey"),
):
    ORACLE[f"r1_ri_{_child}_{_parent}"] = dirty(orphans(_child, _c, _parent, _k))
ORACLE["x1_sql_rule"] = dirty(
    "SELECT count(*) AS failed_count FROM lineitem JOIN orders_dirty ON l_orderkey = o_orderkey "
    "WHERE l_shipdate < o_orderdate"
)

# --- samples ---------------------------------------------------------------------


def first_ten(table: str, key: str, where: str, *before: str) -> str:
    order = ", ".join([*before, key])
    return (
        f"SELECT CAST({key} AS VARCHAR) AS source_id_val FROM {table} WHERE {where} "
        f"ORDER BY {order} LIMIT 10"
    )


def repeated(table: str, column: str) -> str:
    return f"{column} IN (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"


def orphaned(column: str, parent: str, key: str) -> str:
    return f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"


ORACLE["p1_sample_nulls"] = dirty(first_ten("orders_dirty", "o_orderkey", "o_totalprice IS NULL"))
for _t, _c in (("orders_dirty", "o_orderkey"), ("lineitem", "l_orderkey"), ("conversations", "conv_id")):
    ORACLE[f"p2_sample_duplicates_{_t}"] = dirty(first_ten(_t, _c, repeated(_t, _c)))
ORACLE["p3_sample_orphans_orders_dirty"] = dirty(
    first_ten("orders_dirty", "o_orderkey", orphaned("o_custkey", "customer", "c_custkey"), "o_custkey")
)
ORACLE["p3_sample_orphans_documents"] = first_ten("documents", "doc_id", orphaned("doc_id", "labels", "doc_id"))
PRIORITY_MISS = f"NOT regexp_matches(o_orderpriority, {value(PRIORITY)})"
ORACLE["p4_sample_format"] = dirty(first_ten("orders_dirty", "o_orderkey", PRIORITY_MISS))
ORACLE["p7_sample_table"] = dirty(
    union(
        [
            f"SELECT {value(rule)} AS rule_id, * FROM ({first_ten('orders_dirty', 'o_orderkey', where)}) AS s"
            for rule, where in (
                ("no_customer", "o_custkey IS NULL"),
                ("no_price", "o_totalprice IS NULL"),
                ("priority", PRIORITY_MISS),
                ("never", "o_orderkey < 0"),
            )
        ]
    )
)

# --- time series -----------------------------------------------------------------

ORACLE["t1_t2_series_columns"] = dirty(
    union(
        [
            f"SELECT {value(t)} AS table_name, {value(c)} AS time_column, {value(m)} AS metric_column, "
            f"CAST(CAST(max({c}) AS DATE) AS VARCHAR) AS newest, count({m}) AS metric_values FROM {t}"
            for t, c, m in (
                ("orders_dirty", "o_orderdate", "o_totalprice"),
                ("lineitem", "l_shipdate", "l_discount"),
                ("events", "ts", "value"),
            )
        ]
    )
)
TIMED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def window_row(table: str, end: str) -> str:
    return (
        f"SELECT {value(table)} AS table_name, CAST(CAST({end} - INTERVAL 90 DAY AS DATE) AS VARCHAR) AS training_start, "
        f"CAST({end} AS VARCHAR) AS training_end FROM {table}"
    )


ORACLE["t3_training_window_through_max"] = union(
    [window_row(t, f"CAST(max({c}) AS DATE)") for t, c in TIMED.items()]
)
ORACLE["t3_training_window_before_as_of"] = union(
    [
        window_row(t, f"least(CAST(max({TIMED[t]}) AS DATE), CAST(DATE '{EVENTS_AS_OF}' - INTERVAL 1 DAY AS DATE))")
        for t in ("events", "orders")
    ]
)
ORACLE["t4_training_rows_orders"] = dirty(
    f"""SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, round(o_totalprice, 4) AS o_totalprice
    FROM orders_dirty WHERE o_totalprice IS NOT NULL AND CAST(o_orderdate AS DATE)
    BETWEEN CAST(DATE '{ORDERS_AS_OF}' - INTERVAL 91 DAY AS DATE) AND CAST(DATE '{ORDERS_AS_OF}' - INTERVAL 1 DAY AS DATE)"""
)
ORACLE["t5_recent_rows_events"] = (
    f"SELECT event_id, round(value, 6) AS value FROM events WHERE CAST(ts AS DATE) >= DATE '{EVENTS_AS_OF}'"
)


UNITS = ("minute", "hour", "day", "week", "month", "quarter", "year")
CALENDAR_TABLES = ", ".join(f"{t} AS ({sql})" for t, sql in CALENDAR.items())


def coverage(unit: str, column: str) -> str:
    spot = f"date_trunc('{unit}', CAST({column} AS TIMESTAMP))"
    return (
        f"count(DISTINCT {spot}) / CAST(date_diff('{unit}', min({spot}), max({spot})) + 1 AS DOUBLE)"
    )


def seen(column: str) -> str:
    return f"count(DISTINCT date_trunc('minute', CAST({column} AS TIMESTAMP)))"


def unit_of(column: str) -> str:
    """The finest unit whose buckets are covered."""
    ladder = " ".join(f"WHEN {coverage(u, column)} >= 0.8 THEN '{u}'" for u in UNITS)
    return f"CASE WHEN {seen(column)} < 2 THEN 'day' {ladder} ELSE 'day' END"


def frequencies(timed: dict[str, str]) -> str:
    shares = lambda c: ", ".join(f"round({coverage(u, c)}, 6) AS {u}" for u in UNITS)
    return union(
        [f"SELECT {value(t)} AS table_name, {shares(c)}, {seen(c)} AS seen, {unit_of(c)} AS unit FROM {t}" for t, c in timed.items()]
    )


ORACLE["t6_frequency"] = frequencies(TIMED)
ORACLE["t6_frequency_calendar"] = f"WITH {CALENDAR_TABLES} " + frequencies(dict.fromkeys(CALENDAR, "first_day"))


def filled(source: str, time_column: str, metric: str, unit: str, how: str, where: str = "TRUE") -> str:
    """CTEs ending in ``filled(bucket, y, filled)``: every bucket, gaps interpolated."""
    return f"""raw AS (SELECT CAST(date_trunc('{unit}', {time_column}) AS TIMESTAMP) AS bucket, {how}({metric}) AS y
      FROM {source} WHERE {metric} IS NOT NULL AND {where} GROUP BY 1),
    grid AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS bucket
      FROM (SELECT min(bucket) AS lo, max(bucket) AS hi FROM raw) AS e),
    looked AS (SELECT g.bucket, r.y,
      last_value(CASE WHEN r.y IS NOT NULL THEN g.bucket END IGNORE NULLS) OVER w AS b0, last_value(r.y IGNORE NULLS) OVER w AS y0,
      first_value(CASE WHEN r.y IS NOT NULL THEN g.bucket END IGNORE NULLS) OVER v AS b1, first_value(r.y IGNORE NULLS) OVER v AS y1
      FROM grid AS g LEFT JOIN raw AS r ON g.bucket = r.bucket
      WINDOW w AS (ORDER BY g.bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             v AS (ORDER BY g.bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    filled AS (SELECT bucket, CASE WHEN y IS NOT NULL THEN y
      ELSE y0 + (y1 - y0) * ((epoch(bucket) - epoch(b0)) / (epoch(b1) - epoch(b0))) END AS y, y IS NULL AS filled FROM looked)"""


AR1 = """pairs AS (SELECT bucket, y, lag(y) OVER (ORDER BY bucket) AS x FROM {series}),
    model AS (SELECT regr_count(y, x) AS n, regr_slope(y, x) AS phi, regr_intercept(y, x) AS intercept,
      sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / regr_count(y, x)) AS sigma,
      max(bucket) AS last_bucket, arg_max(y, bucket) AS last_y FROM pairs)"""
Z = "2.5758293035489004"
EVENTS = filled("events", "ts", "value", "hour", "sum")

ORACLE["t7_resample_events_minutes"] = (
    f"WITH {filled('events', 'ts', 'value', 'minute', 'avg')} "
    "SELECT CAST(bucket AS VARCHAR) AS bucket, round(y, 8) AS y, filled FROM filled"
)
for _unit in ("week", "month", "quarter", "year"):
    ORACLE[f"t7_resample_{_unit}ly"] = (
        f"WITH {CALENDAR_TABLES}, {filled(f'orders_{_unit}ly', 'first_day', 'order_count', _unit, 'avg')} "
        "SELECT CAST(bucket AS VARCHAR) AS bucket, round(y, 8) AS y, filled FROM filled"
    )
ORACLE["t7_resample_orders_by_month"] = (
    f"WITH {filled('orders', 'o_orderdate', 'o_orderkey', 'month', 'avg', 'month(o_orderdate) NOT IN (2, 3, 7)')} "
    "SELECT CAST(bucket AS VARCHAR) AS bucket, round(y, 4) AS y, filled FROM filled"
)
SEASON = "round(y - avg(y) OVER (PARTITION BY {phase}) + avg(y) OVER (), {digits}) AS y FROM filled"
ORACLE["t8_deseasonalize_events"] = (
    f"WITH {EVENTS} SELECT CAST(bucket AS VARCHAR) AS bucket, {SEASON.format(phase='hour(bucket)', digits=9)}"
)
ORACLE["t8_deseasonalize_orders_weekly"] = (
    f"WITH {filled('orders', 'o_orderdate', 'o_totalprice', 'day', 'avg')} "
    f"SELECT CAST(bucket AS VARCHAR) AS bucket, {SEASON.format(phase='isodow(bucket)', digits=5)}"
)
ORACLE["t9_difference_events"] = (
    f"WITH {EVENTS} SELECT CAST(bucket AS VARCHAR) AS bucket, round(change, 4) AS y FROM "
    "(SELECT bucket, y - lag(y) OVER (ORDER BY bucket) AS change FROM filled) AS d WHERE change IS NOT NULL"
)
ORACLE["t10_fit_ar1_events"] = (
    f"WITH {EVENTS}, {AR1.format(series='filled')} SELECT 'events' AS series_id, CAST(n AS BIGINT) AS n, round(phi, 6) AS phi, "
    "round(intercept, 4) AS intercept, round(sigma, 4) AS sigma, CAST(last_bucket AS VARCHAR) AS last_bucket, "
    "round(last_y, 4) AS last_y FROM model"
)
BEFORE = (
    f"CAST(ts AS DATE) BETWEEN CAST(DATE '{EVENTS_AS_OF}' - INTERVAL 91 DAY AS DATE) "
    f"AND CAST(DATE '{EVENTS_AS_OF}' - INTERVAL 1 DAY AS DATE)"
)
AHEAD = f"""WITH {filled('events', 'ts', 'value', 'hour', 'sum', BEFORE)}, {AR1.format(series='filled')},
    recent AS (SELECT date_trunc('hour', ts) AS bucket, sum(value) AS y FROM events
      WHERE CAST(ts AS DATE) >= DATE '{EVENTS_AS_OF}' AND value IS NOT NULL GROUP BY 1),
    steps AS (SELECT recent.bucket, y, date_diff('hour', last_bucket, recent.bucket) AS h, model.* FROM recent, model),
    scored AS (SELECT bucket, y,
      intercept / (1 - phi) + pow(phi, h) * (last_y - intercept / (1 - phi)) AS forecast,
      sigma * sqrt((1 - pow(phi, 2 * h)) / (1 - phi * phi)) AS se FROM steps)"""
ORACLE["t13_forecast_ar1_events"] = (
    f"{AHEAD} SELECT CAST(bucket AS VARCHAR) AS bucket, round(forecast, 4) AS forecast, round(se, 4) AS se FROM scored"
)
ORACLE["t14_detect_anomalies_events"] = (
    f"{AHEAD} SELECT CAST(bucket AS VARCHAR) AS bucket, round(y, 4) AS y, round(forecast - {Z} * se, 3) AS low, "
    f"round(forecast + {Z} * se, 3) AS high, abs((y - forecast) / se) > {Z} AS is_anomaly FROM scored"
)
ORACLE["t14_flags_in_sample_events"] = (
    f"WITH {EVENTS}, {AR1.format(series='filled')} SELECT CAST(bucket AS VARCHAR) AS bucket, round(y, 4) AS y, "
    f"round(intercept + phi * x, 3) AS forecast FROM pairs, model WHERE x IS NOT NULL "
    f"AND abs((y - intercept - phi * x) / sigma) > {Z}"
)
ORACLE["a1_anomaly_check_events_ahead"] = (
    f"{AHEAD} SELECT count(*) AS failed_count FROM scored WHERE abs((y - forecast) / se) > {Z}"
)
NEWEST = (
    "CAST(o_orderdate AS DATE) >= (SELECT CAST(CAST(max(o_orderdate) AS DATE) - INTERVAL 90 DAY AS DATE) FROM orders_dirty)"
)
ORDERS = f"""WITH {DIRTY}, {filled('orders_dirty', 'o_orderdate', 'o_totalprice', 'day', 'avg', NEWEST)},
    {AR1.format(series='filled')},
    flagged AS (SELECT bucket FROM pairs, model WHERE x IS NOT NULL AND abs((y - intercept - phi * x) / sigma) > {Z})"""
ORACLE["a1_anomaly_check_orders_in_sample"] = f"{ORDERS} SELECT count(*) AS failed_count FROM flagged"
ORACLE["p5_sample_anomalies"] = f"{ORDERS} " + first_ten(
    "orders_dirty", "o_orderkey", "date_trunc('day', o_orderdate) IN (SELECT bucket FROM flagged)"
)

# --- patterns --------------------------------------------------------------------


def mask(column: str) -> str:
    for run, letter in (
        (r"\p{Nd}+", "9"),
        (r"\p{Lu}+", "A"),
        (r"\p{Ll}+", "a"),
        (r"[\p{Lo}\p{Lm}\p{Lt}\p{M}]+", "o"),
        (r"[ \t\n\x0B\f\r]+", " "),
    ):
        column = f"regexp_replace({column}, '{run}', '{letter}', 'g')"
    return column


ORACLE["g1_distinct_sample_url"] = (
    "SELECT DISTINCT url AS value FROM pages WHERE url IS NOT NULL ORDER BY url LIMIT 100"
)
ORACLE["g1_distinct_sample_name"] = (
    "SELECT DISTINCT c_name AS value FROM customer WHERE c_name IS NOT NULL ORDER BY c_name LIMIT 100"
)
ORACLE["g2_shape_mask"] = f"SELECT doc_id, md5({mask('text')}) AS shape_md5 FROM documents"
for _t, _c in (("orders_dirty", "o_orderpriority"), ("pages", "url"), ("benchmark", "text")):
    ORACLE[f"g3_shape_profile_{_t}"] = dirty(
        f"SELECT {mask(_c)} AS shape, count(*) AS n, min({_c}) AS example FROM {_t} WHERE {_c} IS NOT NULL GROUP BY 1"
    )


def dominant(table: str, column: str) -> str:
    """``(column_name, shape, n, share, running)`` of a clear pattern, else no rows."""
    return f"""SELECT {value(column)} AS column_name, shape, n, share, running FROM (
      SELECT *, max(running) OVER () AS reached FROM (
        SELECT shape, n, n / CAST(total AS DOUBLE) AS share,
          sum(n) OVER w / CAST(total AS DOUBLE) AS running, (sum(n) OVER w - n) / CAST(total AS DOUBLE) AS before
        FROM (SELECT *, sum(n) OVER () AS total FROM (
          SELECT {mask(column)} AS shape, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY 1) AS a) AS b
        WHERE n / CAST(total AS DOUBLE) >= 0.05
        WINDOW w AS (ORDER BY n DESC, shape ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS c) AS d
      WHERE reached >= 0.95 AND before < 0.95"""


for _t, _columns in {
    "orders_dirty": ["o_orderstatus", "o_orderpriority"],
    "documents": ["text", "lang", "source"],
    "part": ["p_name", "p_brand", "p_type"],
}.items():
    ORACLE[f"g4_dominant_shapes_{_t}"] = dirty(
        "SELECT column_name, shape, n, round(share, 6) AS share, round(running, 6) AS running FROM ("
        + union([dominant(_t, c) for c in _columns])
        + ") AS g"
    )


def pattern(table: str, column: str) -> str:
    """``(column_name, regex)``: the dominant shapes spelled out as one regex."""
    regex = r"regexp_replace(shape, '([\\.\[\]{}()*+?^$|])', '\\\1', 'g')"
    for letter, run in (
        ("o", r"[\p{Lo}\p{Lm}\p{Lt}\p{M}]+"),
        ("9", r"\p{Nd}+"),
        ("A", r"\p{Lu}+"),
        ("a", r"\p{Ll}+"),
        (" ", r"[ \t\n\x0B\f\r]+"),
    ):
        regex = f"replace({regex}, '{letter}', '{run}')"
    return (
        f"SELECT column_name, '^(?:' || string_agg({regex}, '|' ORDER BY n DESC, shape) || ')\\z' AS regex "
        f"FROM ({dominant(table, column)}) AS g GROUP BY column_name"
    )


ORACLE["g4_dominant_pattern_priority"] = dirty(pattern("orders_dirty", "o_orderpriority"))
ORACLE["g5_pattern_violations"] = dirty(
    f"SELECT o_orderkey, o_orderpriority FROM orders_dirty WHERE {mask('o_orderpriority')} NOT IN "
    f"(SELECT shape FROM ({dominant('orders_dirty', 'o_orderpriority')}) AS g)"
)
for _name, _t, _c in (
    ("g6_case_variants_priority", "orders_dirty", "o_orderpriority"),
    ("g6_case_variants_document_text", "documents", "text"),
):
    ORACLE[_name] = dirty(
        f"SELECT lower(trim({_c})) AS spelling_key, count(DISTINCT {_c}) AS variants, count(*) AS n FROM {_t} "
        f"WHERE {_c} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {_c}) > 1"
    )
for _t, _key, _c in (("documents", "doc_id", "text"), ("pages", "page_id", "url"), ("pages", "page_id", "html")):
    ORACLE[f"g7_odd_characters_{_t}_{_c}"] = f"SELECT {_key} FROM {_t} WHERE regexp_matches({_c}, {value(ODD_CHARACTER)})"
    ORACLE[f"g8_odd_lengths_{_t}_{_c}"] = (
        f"SELECT {_key}, CAST(length({_c}) AS BIGINT) AS chars FROM {_t}, "
        f"(SELECT avg(length({_c})) AS m, stddev_samp(length({_c})) AS s FROM {_t}) AS b "
        f"WHERE length({_c}) < m - 3 * s OR length({_c}) > m + 3 * s"
    )
ORACLE["g9_named_formats"] = union(
    [
        f"SELECT {value(t)} AS table_name, {value(name)} AS format, failed_count FROM ({misses(t, c, regex)}) AS f"
        for t, c in (("documents", "text"), ("customer", "c_name"), ("conversations", "role"))
        for name, regex in NAMED_FORMATS.items()
    ]
)

# --- rules with what they find ----------------------------------------------------

NULL, UNIQUE = "Null Check", "Uniqueness"
FORMAT, REFERENCE = "String Formatting", "Referential Integrity"


def described(case: str, *names: str) -> str:
    return value(DESCRIPTIONS[case] % names)


def readable(column: str) -> str:
    return column.replace("_", " ")


def null_sql(t: str, c: str) -> str:
    return f"SELECT count(*) AS failed_count FROM `{t}` WHERE `{c}` IS NULL"


def unique_sql(t: str, c: str) -> str:
    return (
        f"SELECT count(*) AS failed_count FROM (SELECT `{c}` FROM `{t}` WHERE `{c}` IS NOT NULL "
        f"GROUP BY `{c}` HAVING count(*) > 1)"
    )


def rule_row(t: str, c: str, family: str, sql: str, description: str, count: str) -> str:
    identity = value("|".join((t, c, family, sql)))
    return (
        f"SELECT sha256({identity}) AS rule_id, {value(sql)} AS rule_sql, {description} AS rule_description, "
        f"failed_count AS failed_rows FROM ({count}) AS q"
    )


ORACLE["k1_null_rules"] = dirty(
    union(
        [
            rule_row(t, c, NULL, null_sql(t, c), described("null_nullable", readable(c), t), nulls(t, c))
            for t in RUN_TABLES
            for c, _ in columns_of(t)
        ]
    )
)
ORACLE["k2_uniqueness_rules"] = dirty(
    union(
        [
            rule_row(t, c, UNIQUE, unique_sql(t, c), described("unique", readable(c), t), duplicates(t, c))
            for t in RUN_TABLES
            for c, _ in columns_of(t)[:1]
        ]
    )
)


def shape_rule(t: str, c: str) -> str:
    """Whether a column has a clear pattern, and its misses or its empty values."""
    kept = f"SELECT shape FROM ({dominant(t, c)}) AS g"
    return f"""SELECT {value(t)} AS source_table_id, {value(c)} AS metric_column,
      EXISTS ({kept}) AS clear, CAST(CASE WHEN EXISTS ({kept})
        THEN (SELECT count(*) FROM {t} WHERE {mask(c)} NOT IN ({kept}))
        ELSE (SELECT count(*) FROM {t} WHERE length({c}) = 0) END AS BIGINT) AS failed_rows"""


ORACLE["k3_format_rules"] = dirty(
    union(
        [
            shape_rule(t, c)
            for t in ("customer", "orders_dirty", "lineitem", "part", "labels")
            for c, kind in columns_of(t)
            if kind == "string"
        ]
    )
)


def inconsistency_rules(t: str, c: str) -> str:
    """The rules of one string column: its pattern's, or the four of a column without one."""
    kept = f"SELECT shape FROM ({dominant(t, c)}) AS g"
    bounds = (
        f"SELECT ceil(avg(length({c})) - 3 * stddev_samp(length({c}))) AS low, "
        f"floor(avg(length({c})) + 3 * stddev_samp(length({c}))) AS high FROM {t}"
    )
    variants = (
        f"SELECT count(*) FROM (SELECT lower(trim({c})) FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 "
        f"HAVING count(DISTINCT {c}) > 1) AS v"
    )
    rows = (
        ("format", f"SELECT count(*) FROM {t} WHERE {mask(c)} NOT IN ({kept})", "EXISTS"),
        ("empty", f"SELECT count(*) FROM {t} WHERE length({c}) = 0", "NOT EXISTS"),
        ("odd_characters", f"SELECT count(*) FROM {t} WHERE regexp_matches({c}, {value(ODD_CHARACTER)})", "NOT EXISTS"),
        ("odd_length", f"SELECT count(*) FROM {t}, ({bounds}) AS b WHERE length({c}) < low OR length({c}) > high", "NOT EXISTS"),
        ("case_variants", variants, "NOT EXISTS"),
    )
    return union(
        [
            f"SELECT {value(t)} AS source_table_id, {value(c)} AS metric_column, "
            f"{described(case, readable(c), t)} AS rule_description, CAST(({count}) AS BIGINT) AS failed_rows "
            f"WHERE {exists} ({kept})"
            for case, count, exists in rows
        ]
    )


ORACLE["k3_format_rules_with_inconsistencies"] = dirty(
    union(
        [
            inconsistency_rules(t, c)
            for t in ("documents", "pages", "conversations")
            for c, kind in columns_of(t)
            if kind == "string"
        ]
    )
)


def trained_unit(table: str, metric: str, column: str) -> str:
    """Unit of the newest 91 days, of all rows where those have fewer than four times."""
    rows = f"FROM {table} WHERE {metric} IS NOT NULL"
    usual = f"{rows} AND CAST({column} AS DATE) >= (SELECT CAST(CAST(max({column}) AS DATE) - INTERVAL 90 DAY AS DATE) FROM {table})"
    return f"CASE WHEN (SELECT {seen(column)} {usual}) >= 4 THEN (SELECT {unit_of(column)} {usual}) ELSE (SELECT {unit_of(column)} {rows}) END"


def trained(specs: tuple[tuple[str, str, str], ...]) -> str:
    return union(
        [
            f"SELECT {value(t)} AS source_table_id, {value(m)} AS metric_column, 'Anomaly Detection' AS rule_family, "
            f"{described('anomaly', m, c)} AS rule_description, {trained_unit(t, m, c)} AS bucket_unit FROM {t} HAVING count({c}) > 0"
            for t, m, c in specs
        ]
    )


ORACLE["k4_anomaly_rules"] = dirty(
    trained((("orders_dirty", "o_totalprice", "o_orderdate"), ("lineitem", "l_discount", "l_shipdate")))
)
ORACLE["k4_anomaly_rules_calendar"] = f"WITH {CALENDAR_TABLES} " + trained(
    tuple((t, "order_count", "first_day") for t in ("orders_weekly", "orders_monthly"))
)
KNOWN_KEYS = [k for k in FOREIGN_KEYS if k[0] in RUN_TABLES and k[2] in RUN_TABLES]
ORACLE["k5_reference_rules"] = dirty(
    union(
        [
            f"SELECT {value(t)} AS source_table_id, {value(c)} AS metric_column, "
            f"{described('reference', readable(c), t, readable(k), p)} AS rule_description, "
            f"failed_count AS failed_rows FROM ({orphans(t, c, p, k)}) AS q"
            for t, c, p, k in KNOWN_KEYS
        ]
    )
)


def base_rules(names: tuple[str, ...]) -> list[tuple[str, str, str, str, str]]:
    """``(table, column, family, description, counting SQL)`` of the rules of a full run."""
    rules = []
    for t in names:
        for i, (c, kind) in enumerate(columns_of(t)):
            rules.append((t, c, NULL, described("null_nullable", readable(c), t), nulls(t, c)))
            if i == 0:
                rules.append((t, c, UNIQUE, described("unique", readable(c), t), duplicates(t, c)))
            if c == "o_orderpriority":
                rules.append((t, c, FORMAT, described("format", readable(c), t), misses(t, c, PRIORITY)))
            elif kind == "string":
                rules.append((t, c, FORMAT, described("empty", readable(c), t), empties(t, c)))
    for t, c, p, k in KNOWN_KEYS:
        if t in names and p in names:
            text = described("reference", readable(c), t, readable(k), p)
            rules.append((t, c, REFERENCE, text, orphans(t, c, p, k)))
    return rules


def counted(names: tuple[str, ...] = RUN_TABLES) -> str:
    """CTEs ending in ``counts``: every rule of a full run with its failing rows."""
    rows = union(
        [
            f"SELECT {value(t)} AS source_table_id, {value(c)} AS metric_column, {value(family)} AS rule_family, "
            f"{text} AS rule_description, failed_count AS failed_rows FROM ({sql}) AS q"
            for t, c, family, text, sql in base_rules(names)
        ]
    )
    return f"WITH {DIRTY}, counts AS (SELECT *, CASE WHEN failed_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({rows}) AS r)"


BROKEN = (
    "SELECT 'lineitem' AS source_table_id, 'l_missing' AS metric_column, 'Null Check' AS rule_family "
    "UNION ALL SELECT 'lineitem', 'l_shipmode', 'String Formatting'"
)

ORACLE["k6_descriptions"] = f"""{counted()} SELECT rule_family, count(*) AS rules,
    CAST(sum(length(rule_description)) AS BIGINT) AS description_chars,
    CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS failing FROM counts GROUP BY rule_family"""
ORACLE["k8_generate_rules"] = f"""{counted()} SELECT rule_family, count(*) AS rules,
    CAST(sum(failed_rows) AS BIGINT) AS failed_rows FROM counts WHERE rule_family <> '{FORMAT}' GROUP BY rule_family"""

# --- execution -------------------------------------------------------------------

ORACLE["e1_fused_table_counts"] = (
    f"{counted(('orders_dirty',))} SELECT metric_column, rule_family, failed_rows AS failed_count FROM counts "
    f"WHERE rule_family <> '{UNIQUE}'"
)
ORACLE["e1_run_rules"] = (
    f"{counted()} SELECT source_table_id, metric_column, rule_family, status, failed_rows FROM counts"
)
ORACLE["e2_e3_status_and_results"] = f"""{counted()} SELECT source_table_id, metric_column, rule_family, status,
    CASE WHEN status = 'FAIL' THEN CAST(failed_rows AS VARCHAR) END AS failed_rows, FALSE AS has_error FROM counts
    UNION ALL SELECT *, 'ERROR', NULL, TRUE FROM ({BROKEN}) AS b"""
ORACLE["e4_failures"] = f"""{counted()} SELECT source_table_id, metric_column, rule_family, status FROM counts
    WHERE status = 'FAIL' UNION ALL SELECT *, 'ERROR' FROM ({BROKEN}) AS b"""


def samples_of(names: tuple[str, ...]) -> str:
    """First ten failing rows of every rule of a full run."""
    parts = []
    for t in names:
        key = columns_of(t)[0][0]
        for i, (c, kind) in enumerate(columns_of(t)):
            looks = [(NULL, f"{c} IS NULL", ())]
            if i == 0:
                looks.append((UNIQUE, repeated(t, c), ()))
            if c == "o_orderpriority":
                looks.append((FORMAT, PRIORITY_MISS, ()))
            elif kind == "string":
                looks.append((FORMAT, f"length({c}) = 0", ()))
            parts += [(t, c, family, first_ten(t, key, where, *before)) for family, where, before in looks]
    for t, c, p, k in KNOWN_KEYS:
        parts.append((t, c, REFERENCE, first_ten(t, columns_of(t)[0][0], orphaned(c, p, k), c)))
    return union(
        [
            f"SELECT {value(t)} AS source_table_id, {value(c)} AS metric_column, {value(family)} AS rule_family, "
            f"source_id_val AS source_id FROM ({sql}) AS s"
            for t, c, family, sql in parts
        ]
    )


ORACLE["e5_collect_samples"] = f"WITH {DIRTY} {samples_of(RUN_TABLES)}"
ORACLE["s12_store_round_trip"] = (
    f"{counted()} SELECT source_table_id, metric_column, rule_description, status, failed_rows FROM counts WHERE status = 'FAIL'"
)

# --- reports ---------------------------------------------------------------------

ORACLE["d1_failures_by_table"] = f"""{counted()} SELECT source_table_id, count(*) AS failed_rules,
    CAST(sum(failed_rows) AS BIGINT) AS failed_rows FROM counts WHERE status = 'FAIL' GROUP BY source_table_id"""
ORACLE["d2_family_division"] = f"""{counted()} SELECT source_table_id, rule_family, count(*) AS failed_rules
    FROM counts WHERE status = 'FAIL' GROUP BY ROLLUP (source_table_id, rule_family)"""
ORACLE["d3_failed_by_metric"] = f"""{counted()} SELECT source_table_id, metric_column,
    CAST(sum(failed_rows) AS BIGINT) AS failed_rows FROM counts WHERE status = 'FAIL' GROUP BY source_table_id, metric_column"""
ORACLE["d4_rules_by_family"] = f"""{counted()} SELECT rule_family, count(*) AS rules,
    CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS failing FROM counts GROUP BY rule_family
    HAVING count(*) FILTER (WHERE status = 'FAIL') > 0"""
ORACLE["d5_sample_details"] = dirty(
    union(
        [
            f"SELECT source_id_val AS source_id, {value(null_sql(t, c))} AS rule_sql, "
            f"{described('null_nullable', readable(c), t)} AS rule_description "
            f"FROM ({first_ten(t, columns_of(t)[0][0], f'{c} IS NULL')}) AS s"
            for t in ("orders_dirty", "customer")
            for c, _ in columns_of(t)
        ]
    )
)
ORACLE["d6_alert_lines"] = f"""{counted()} SELECT source_dataset_id, failed_columns,
    source_dataset_id || ' is failing ' || CAST(failed_columns AS VARCHAR) || ' data quality columns' AS alert
    FROM (SELECT 'source_data' AS source_dataset_id, count(DISTINCT source_table_id || '|' || metric_column) AS failed_columns
      FROM counts WHERE status = 'FAIL') AS f"""
ORACLE["d7_error_alerts"] = f"SELECT 'source_data' AS source_dataset_id, * FROM ({BROKEN}) AS b"

# --- maintenance -----------------------------------------------------------------

KEYS = [(t, columns_of(t)[0][0]) for t in ("orders_dirty", "lineitem")]


def outcome(t: str, family: str, description: str, sql: str) -> str:
    return (
        f"SELECT {value(t)} AS source_table_id, {value(family)} AS rule_family, {description} AS rule_description, "
        f"failed_count AS failed_rows FROM ({sql}) AS q"
    )


KEY_OUTCOMES = [outcome(t, UNIQUE, described("unique", readable(c), t), duplicates(t, c)) for t, c in KEYS]


def tax_rule(description: str, where: str) -> str:
    return outcome(
        "lineitem", "Custom", value(description), f"SELECT count(*) AS failed_count FROM lineitem WHERE {where}"
    )


ORACLE["c1_create_rule"] = dirty(union([*KEY_OUTCOMES, tax_rule("tax above discount", "l_tax > l_discount")]))
ORACLE["c2_find_rules"] = dirty(
    union(
        [
            outcome("orders_dirty", NULL, described("null_nullable", readable(c), "orders_dirty"), nulls("orders_dirty", c))
            for c, _ in columns_of("orders_dirty")
        ]
    )
)
ORACLE["c3_update_rule"] = dirty(
    union([*KEY_OUTCOMES, tax_rule("tax above twice the discount", "l_tax > 2 * l_discount")])
)
ORACLE["c4_delete_rule"] = dirty(union(KEY_OUTCOMES))
ORACLE["c3_update_sql_only"] = dirty(
    "SELECT 'orders_dirty' AS source_table_id, 'o_totalprice' AS metric_column, "
    "'SELECT count(*) AS failed_count FROM orders_dirty WHERE o_totalprice IS NULL OR o_totalprice > 300000' AS rule_sql, "
    "count(*) AS failed_rows FROM orders_dirty WHERE o_totalprice IS NULL OR o_totalprice > 300000"
)
ORACLE["x1_user_rule_in_builtin_family"] = union(
    [
        f"SELECT 'lineitem' AS source_table_id, '{family}' AS rule_family, count(*) AS failed_rows FROM lineitem WHERE l_quantity > {n}"
        for family, n in (("Uniqueness", 40), ("Referential Integrity", 30), ("Anomaly Detection", 20), ("Null Check", 60))
    ]
)
ORACLE["e6_anomaly_isolation"] = (
    "SELECT DISTINCT 'lineitem' AS source_table_id, true AS is_error FROM lineitem "
    "UNION ALL SELECT DISTINCT 'orders_dirty', false FROM orders"
)
ORACLE["k8_generate_with_broken_table"] = union(
    [
        f"SELECT DISTINCT {value(name)} AS table_name, CAST({len(columns_of(t)) + 1} AS BIGINT) AS rules, {step} AS step FROM {t}"
        for name, t, step in (("customer", "customer", "NULL"), ("nation", "nation", "NULL"), ("broken", "customer", "'patterns'"))
    ]
)
ORACLE["n3_null_profile_footers"] = union(
    [
        f"SELECT {value(t)} AS table_name, {value(c)} AS column_name, count(*) - count({c}) AS failed_count FROM {t}"
        for t in ALL_TABLES
        for c, _ in columns_of(t)
    ]
)
ORACLE["t11_difference_order"] = (
    f"WITH {EVENTS}, e AS (SELECT row_number() OVER (ORDER BY bucket) AS i, y - avg(y) OVER () AS e FROM filled), "
    "w AS (SELECT count(*) AS n, CAST(floor(4 * pow(count(*) / 100.0, 0.25)) AS BIGINT) AS w, sum(e * e) AS c0 FROM e), "
    "s AS (SELECT sum(q * q) AS ss FROM (SELECT sum(e) OVER (ORDER BY i) AS q FROM e) AS x), "
    "c AS (SELECT k, sum(a.e * b.e) AS p FROM w, range(1, 25) AS r(k), e AS a JOIN e AS b ON true WHERE k <= w AND a.i = b.i + k GROUP BY k), "
    "t AS (SELECT sum(2 * (1 - k / (w + 1.0)) * p) AS t FROM c, w), "
    "f AS (SELECT n, ss / (n * (c0 + t)) AS kpss FROM w, s, t) "
    "SELECT 'events' AS series_id, n, round(kpss, 6) AS kpss, CASE WHEN kpss > 0.463 THEN 1 ELSE 0 END AS d FROM f"
)
VARIED = (
    "lower(trim(o_orderpriority)) IN (SELECT lower(trim(o_orderpriority)) FROM orders_dirty WHERE o_orderpriority IS NOT NULL "
    "GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1)"
)
ORACLE["e5_samples_of_format_rules"] = dirty(
    union(
        [
            f"SELECT {value(checked)} AS checked, source_id_val AS source_id FROM ({rows}) AS q"
            for checked, rows in (
                (
                    "`o_orderpriority` IS NOT NULL AND length(`o_orderpriority`) = 0",
                    first_ten("orders_dirty", "o_orderkey", "o_orderpriority = ''"),
                ),
                (
                    "length(`o_orderpriority`) NOT BETWEEN 1 AND 9",
                    first_ten("orders_dirty", "o_orderkey", "length(o_orderpriority) NOT BETWEEN 1 AND 9"),
                ),
                ("variants", first_ten("orders_dirty", "o_orderkey", VARIED, "lower(trim(o_orderpriority))")),
            )
        ]
    )
)
