"""Tables, seeded defects and declarations shared by queries and reference SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from dqloom.sources.dataset import Dataset, load_dataset

# Columns as documented for the test tables, in order.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
ALL_TABLES = tuple(COLUMNS)


def columns_of(table: str) -> list[tuple[str, str]]:
    """``(name, type)`` of a documented table; the seeded table looks like orders."""
    text = COLUMNS["orders" if table == "orders_dirty" else table]
    return [tuple(part.split(" ", 1)) for part in text.split(", ")]


# Orders with seeded defects: every row of orders, some changed, some added again.
ORDERS_DIRTY = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 89 = 0 THEN o_custkey + 10000000
            WHEN o_orderkey % 113 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       o_orderstatus,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN CAST(o_orderdate AS DATE) = DATE '2001-07-15' THEN o_totalprice * 50
            ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderkey % 101 = 0 THEN ''
            WHEN o_orderkey % 103 = 0 THEN lower(o_orderpriority)
            ELSE o_orderpriority END AS o_orderpriority
FROM orders
UNION ALL
SELECT * FROM orders WHERE o_orderkey % 83 = 0
"""

# Orders counted by calendar unit, one row a week, month, quarter or year; the monthly table misses
# every May and October. The first day of the bucket is the time column.
CALENDAR = {
    f"orders_{name}ly": f"""
SELECT min(o_orderkey) AS first_order, CAST(date_trunc('{name}', o_orderdate) AS DATE) AS first_day, count(*) AS order_count
FROM orders WHERE {rows} GROUP BY CAST(date_trunc('{name}', o_orderdate) AS DATE)"""
    for name, rows in (("week", "true"), ("month", "month(o_orderdate) % 5 <> 0"), ("quarter", "true"), ("year", "true"))
}

PRIORITY = "^[0-9]-[A-Z]+( [A-Z]+)*$"

FOREIGN_KEYS = [
    ("orders_dirty", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders_dirty", "o_orderkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("orders_dirty", "o_clerkkey", "clerks", "k_clerkkey"),
]

# Tables of the full runs.
RUN_TABLES = ("customer", "nation", "orders_dirty", "lineitem", "documents", "labels", "conversations")

EVENTS_AS_OF = dt.date(2024, 1, 25)
ORDERS_AS_OF = dt.date(2001, 7, 10)


def tables(spark: SparkSession, sf_dir: str, *names: str) -> Dataset:
    """The named tables; ``orders_dirty`` and those of ``CALENDAR`` are derived from orders."""
    derived = {"orders_dirty": ORDERS_DIRTY} | CALENDAR
    needed = [n for n in names if n not in derived]
    if len(needed) == len(names):
        return load_dataset(spark, sf_dir, needed)
    dataset = load_dataset(spark, sf_dir, {*needed, "orders"})
    for name in (n for n in names if n in derived):
        made = spark.sql(derived[name].replace("FROM orders", "FROM {orders}"), orders=dataset["orders"])
        dataset = dataset.with_table(name, made)
    return dataset.only(*names)
