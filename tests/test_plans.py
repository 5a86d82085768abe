"""The physical plans the engine counts on, and results under skew."""

import pytest
from pyspark.sql import functions as F

from dqloom.operators import checks, patterns, samples
from dqloom.plans import generate
from dqloom.plans.execute import table_counts
from dqloom.sources.catalog import column_catalog
from dqloom.sources.dataset import load_dataset
from registry.queries import _base_rules
from registry.inputs import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_rules_of_a_table_share_one_scan(spark, sf_dir):
    ds = tables(spark, sf_dir, "lineitem")
    rules = _base_rules(ds).where("failure_predicate is not null").collect()
    assert len(rules) == 13
    assert plan(table_counts(ds, "lineitem", rules)).count("FileScan") == 1


def test_null_rules_are_answered_from_footers(spark, sf_dir):
    ds = load_dataset(spark, sf_dir, ["orders"], footer_counts=True)
    counts = checks.footer_null_counts(ds.counting["orders"], {c: c for c in ds["orders"].columns})
    assert "PushedAggregation: [COUNT(*)" in plan(counts)
    assert "FileScan" in plan(checks.null_profile(ds["orders"]))


def test_wide_tables_read_each_column_in_one_block(spark):
    df = spark.range(50).selectExpr(*[f"if(id % {i + 2} = 0, null, id) as c{i}" for i in range(80)])
    found = {r.column_name: r.failed_count for r in checks.null_profile(df).collect()}
    assert found == {f"c{i}": len(range(0, 50, i + 2)) for i in range(80)}


def test_referential_check_shuffles_distinct_values_only(spark, sf_dir, no_broadcast):
    ds = tables(spark, sf_dir, "lineitem", "orders")
    text = plan(checks.ri_check(ds["lineitem"], "l_orderkey", ds["orders"], "o_orderkey"))
    assert "LeftAnti" in text
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_count" in text


def test_samples_keep_ten_rows_per_task(spark, sf_dir):
    ds = tables(spark, sf_dir, "orders")
    one = samples.sample_where(ds["orders"], "o_orderkey", F.col("o_custkey") > 10)
    assert "TakeOrderedAndProject" in plan(one)
    many = plan(samples.sample_table(ds["orders"], "o_orderkey", {"a": F.col("o_custkey") > 1, "b": F.col("o_custkey") > 2}))
    assert many.count("WindowGroupLimit") == 2 and many.count("FileScan") == 1
    repeated = plan(samples.sample_duplicates(tables(spark, sf_dir, "lineitem")["lineitem"], "l_orderkey", "l_orderkey"))
    assert "PushedFilters: [In(l_orderkey" in repeated and "Exchange" not in repeated


def test_shape_counting_shuffles_keys_not_text(spark, sf_dir):
    ds = tables(spark, sf_dir, "documents")
    text = plan(patterns._frequent_keys(ds["documents"], ["text", "lang"], 0.05, 0.95))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("shape_key" in e or "column_name" in e for e in exchanges)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the child rows, and of the parent rows, hold one key."""
    child = spark.range(90_000).selectExpr("id", "if(id % 3 = 0, 7, id) as k", "if(id % 3 = 0, 'Hot', concat('v', id)) as s")
    parent = spark.range(60_000).selectExpr("if(id % 3 = 0, 11, id + 1000) as k")
    return child, parent


def test_hot_keys_give_whole_results(spark, skewed, no_broadcast):
    child, parent = skewed
    assert checks.uniqueness_check(child, "k").first().failed_count == 1
    # key 7 occurs 30,000 times and once more as its own id
    assert checks.duplicate_rows(child, "k").first().failed_count == 30_001
    kids = [7 if i % 3 == 0 else i for i in range(90_000)]
    parents = {11 if i % 3 == 0 else i + 1000 for i in range(60_000)}
    expected = sum(k not in parents for k in kids)
    assert checks.ri_check(child, "k", parent, "k").first().failed_count == expected
    assert [r[0] for r in samples.sample_duplicates(child, "id", "k").collect()] == [str(i) for i in (0, 3, 6, 7, 9, 12, 15, 18, 21, 24)]
    mixed = child.withColumn("s", F.when(F.col("id") % 6 == 0, "hOT").otherwise(F.col("s")))
    assert [tuple(r) for r in patterns.case_variants(mixed, "s").collect()] == [("hot", 2, 30_000)]


def test_descriptions_of_generated_rules_need_no_job(spark, sf_dir):
    ds = tables(spark, sf_dir, "lineitem")
    assert "LocalTableScan" in plan(generate.null_rules(column_catalog(ds), ds))
    assert "Exchange" not in plan(generate.null_rules(column_catalog(ds), ds))
