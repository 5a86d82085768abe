"""Generation, statuses, isolation of failing rules, and samples."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import dqloom
from dqloom.plans import generate, maintain, reports
from dqloom.plans.execute import run_rules, with_status
from dqloom.session import small_frame
from dqloom.sources import store
from dqloom.sources.catalog import column_catalog, key_column
from dqloom.sources.dataset import Dataset, has_table, load_dataset
from registry.inputs import FOREIGN_KEYS, tables


@pytest.fixture(scope="module")
def small(spark):
    """A table with odd names and every kind of defect."""
    rows = [
        (1, "A-1", "x y", dt.date(2024, 1, 1)),
        (2, "A-2", None, dt.date(2024, 1, 2)),
        (2, "b-3", "", None),
        (3, None, "it's \\ `odd`", dt.date(2024, 1, 4)),
        (None, "A-4", "X Y", dt.date(2024, 1, 5)),
    ]
    schema = "id int, `code.x` string, `a``b` string, day date"
    return Dataset(spark, {"odd table": small_frame(spark, rows, schema)})


def outcomes(outcome):
    return {
        (r.source_table_id, r.metric_column, r.rule_family, r.status): r.failed_rows
        for r in outcome.results.collect()
    }


def test_names_with_dots_blanks_and_quotes(small):
    rules = generate.generate_rules(small, forecasts=False).rules
    outcome = run_rules(small, rules, include_pass=True)
    found = outcomes(outcome)
    assert not [k for k in found if k[3] == "ERROR"]
    assert found["odd table", "a`b", "Null Check", "FAIL"] == 1
    assert found["odd table", "id", "Uniqueness", "FAIL"] == 1
    details = reports.sample_details(outcome.samples, rules)
    assert [r.source_id for r in details.where("rule_family = 'Uniqueness'").collect()] == ["2", "2"]


def test_stored_sql_gives_the_same_counts(spark, sf_dir):
    """The SQL text kept with each rule is runnable and agrees with the shared scans."""
    ds = tables(spark, sf_dir, "orders_dirty", "customer", "documents", "labels").register_views()
    rules = generate.generate_rules(ds, FOREIGN_KEYS, forecasts=False).rules
    fused = {r.rule_id: r.failed_rows or 0 for r in run_rules(ds, rules, include_pass=True, with_samples=False).results.collect()}
    for rule in rules.collect():
        assert spark.sql(rule.rule_sql).first().failed_count == fused[rule.rule_id], rule.rule_sql


def test_status_table(spark):
    rows = [("a", 0, None), ("b", 3, None), ("c", None, "boom"), ("d", 2, "boom")]
    frame = small_frame(spark, rows, "rule_id string, failed_count bigint, error string")
    assert {r.rule_id: r.status for r in with_status(frame).collect()} == {
        "a": "PASS", "b": "FAIL", "c": "ERROR", "d": "ERROR",
    }


def custom(rules, metric, sql, predicate=None, family="Custom", table="t"):
    return maintain.new_rule(rules, table, metric, family, sql, None, predicate)


def test_one_bad_rule_never_stops_the_others(spark):
    frame = small_frame(spark, [(i, str(i) if i % 7 else "x") for i in range(50)], "id int, s string")
    ds = Dataset(spark, {"t": frame})
    rules = generate.null_rules(column_catalog(ds), ds)
    bad = [
        custom(rules, "missing", "SELECT 1", "missing IS NULL"),
        custom(rules, "regex", "SELECT 2", "s RLIKE '('"),
        custom(rules, "cast", "SELECT 3", "CAST(s AS INT) > 100"),
        custom(rules, "number", "SELECT 4", "id + 1"),
        custom(rules, "nosuch", "SELECT count(*) AS failed_count FROM nowhere"),
        custom(rules, "alias", "SELECT count(*) AS n FROM t"),
        custom(rules, "null", "SELECT CAST(NULL AS BIGINT) AS failed_count"),
        custom(rules, "table", "SELECT 5", "id IS NULL", table="gone"),
        custom(rules, "nomodel", "SELECT 6", family="Anomaly Detection"),
    ]
    good = [
        custom(rules, "empty", "SELECT 1 AS failed_count FROM t WHERE id < 0"),
        custom(rules, "closed", "SELECT count(*) AS failed_count FROM t WHERE id > 47; "),
        custom(rules, "ids", "SELECT 7", "id > 45"),
    ]
    for rule in [*bad, *good]:
        rules = rules.unionByName(rule)
    found = outcomes(run_rules(ds, rules, include_pass=True))
    failed = {k[1] for k in found if k[3] == "ERROR"}
    assert failed == {"missing", "regex", "cast", "number", "nosuch", "alias", "null", "table", "nomodel"}
    assert found["t", "closed", "Custom", "FAIL"] == 2
    assert found["t", "ids", "Custom", "FAIL"] == 4
    assert ("t", "empty", "Custom", "PASS") in found
    assert ("t", "s", "Null Check", "PASS") in found


def test_samples_are_bounded_known_rows_of_failing_rules(spark, sf_dir):
    ds = tables(spark, sf_dir, "orders_dirty", "customer", "lineitem")
    rules = generate.generate_rules(ds, FOREIGN_KEYS, forecasts=False).rules
    outcome = run_rules(ds, rules)
    results = {r.rule_id: r for r in outcome.results.collect()}
    by_rule: dict = {}
    for sample in outcome.samples.collect():
        assert sample.rule_id in results
        by_rule.setdefault(sample.rule_id, []).append(sample.source_id)
    for rule in rules.where("failure_predicate is not null").collect():
        if rule.rule_id not in results:
            assert rule.rule_id not in by_rule
            continue
        ids = by_rule[rule.rule_id]
        assert len(ids) == min(10, results[rule.rule_id].failed_rows)
        df = ds[rule.source_table_id]
        failing = df.where(rule.failure_predicate).select(F.col(key_column(df)).cast("string"))
        assert set(ids) <= {r[0] for r in failing.collect()}


def test_rules_without_a_table_are_skipped(spark, sf_dir):
    ds = tables(spark, sf_dir, "orders_dirty", "customer")
    assert has_table(ds, "customer") and not has_table(ds, "nation")
    rules = generate.reference_rules(FOREIGN_KEYS, ds)
    assert [r.metric_column for r in rules.collect()] == ["o_custkey"]
    assert generate.reference_rules([], ds).count() == 0


def test_rule_ids_are_stable_and_unique(spark, sf_dir):
    ds = tables(spark, sf_dir, "customer", "documents")
    first = [r.rule_id for r in generate.generate_rules(ds, forecasts=False).rules.collect()]
    again = [r.rule_id for r in generate.generate_rules(ds, forecasts=False).rules.collect()]
    assert sorted(first) == sorted(again)
    assert len(set(first)) == len(first)


def test_not_null_columns_are_described_as_such(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("row_id", T.LongType(), False), T.StructField("x", T.LongType())])
    ds = Dataset(spark, {"t": spark.createDataFrame([(1, 2)], schema)})
    texts = [r.rule_description for r in generate.null_rules(column_catalog(ds), ds).collect()]
    assert texts[0].startswith("Checks for unexpected NULL values in the NOT NULL column 'row id'")
    assert texts[1].startswith("Counts NULL values in the nullable column 'x'")


def test_no_rules_no_results(spark, sf_dir):
    ds = tables(spark, sf_dir, "customer")
    rules = generate.null_rules(column_catalog(ds), ds).where("false")
    outcome = run_rules(ds, rules)
    assert outcome.results.count() == 0 and outcome.samples.count() == 0


def test_footer_counts_agree_with_data(spark, sf_dir, tmp_path):
    nested = spark.range(20).selectExpr(
        "id", "if(id % 3 = 0, null, id) as n", "if(id % 4 = 0, null, array(id, null)) as a", "if(id % 5 = 0, null, 'x') as s"
    )
    nested.write.parquet(str(tmp_path / "t.parquet"))
    ds = load_dataset(spark, str(tmp_path), footer_counts=True)
    rules = generate.null_rules(column_catalog(ds), ds)
    found = outcomes(run_rules(ds, rules))
    expected = {("t", c, "Null Check", "FAIL"): n for c, n in (("n", 7), ("a", 5), ("s", 4))}
    assert found == expected


def test_alert_line(spark):
    rows = [("d", "t", "a", "FAIL"), ("d", "t", "a", "FAIL"), ("d", "u", "a", "FAIL"), ("d", "u", "b", "ERROR")]
    frame = small_frame(spark, rows, "source_dataset_id string, source_table_id string, metric_column string, status string")
    assert [r.alert for r in reports.alert_lines(frame).collect()] == ["d is failing 2 data quality columns"]


def test_update_keeps_id_and_touches_time(spark, sf_dir):
    ds = tables(spark, sf_dir, "customer")
    rules = generate.uniqueness_rules(column_catalog(ds), ds)
    old = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    rules = rules.withColumn("rule_generation_timestamp", F.lit(old))
    rule = rules.first()
    changes = small_frame(spark, [(rule.rule_id, "new text")], "rule_id string, rule_description string")
    updated = maintain.update_rule(rules, changes).first()
    assert updated.rule_id == rule.rule_id and updated.rule_description == "new text"
    assert updated.rule_generation_timestamp > rule.rule_generation_timestamp
    same = maintain.update_rule(rules, changes.where("false")).first()
    assert tuple(same) == tuple(rule)


def test_store_round_trip(spark, sf_dir, tmp_path):
    ds = tables(spark, sf_dir, "orders_dirty", "customer", "documents", "labels")
    path = str(tmp_path / "store")
    dqloom.generate_into(ds, path, FOREIGN_KEYS, forecasts=False)
    rules = store.read_rules(spark, path)
    assert rules.columns == store.RULE_FIELDS
    assert list((tmp_path / "store" / "rules").glob("version-*/generation_date=*"))
    first = dqloom.run_stored(ds, path)
    samples = store.read_samples(spark, path).count()
    assert store.read_results(spark, path).count() == first.results.count() > 0
    dqloom.run_stored(ds, path)
    # results are replaced, samples are added
    assert store.read_results(spark, path).count() == first.results.count()
    assert store.read_samples(spark, path).count() == 2 * samples > 0
    # a changed rules table can be written over the one it was read from
    kept = maintain.find_rules(store.read_rules(spark, path, engine_fields=True), "rule_family = 'Uniqueness'")
    expected = kept.count()
    store.write_rules(kept, path)
    assert store.read_rules(spark, path).count() == expected
    assert store.read_samples(spark, path).join(store.read_rules(spark, path), "rule_id", "left_anti").count() > 0


def test_a_failed_write_leaves_the_former_table(spark, tmp_path):
    """Readers see the last whole version, whatever happens to the next one."""
    path, folder = str(tmp_path), tmp_path / "models"
    rows = lambda *ids: small_frame(spark, [(i, 1.0) for i in ids], "series_id string, phi double")
    store.write_models(rows("a", "b"), path)
    begun = store.read_models(spark, path)
    breaking = rows("c").withColumn("phi", F.when(F.col("series_id") == "c", F.raise_error(F.lit("half-way")).cast("double")))
    with pytest.raises(Exception, match="half-way"):
        store.write_models(breaking, path)
    (folder / "version-000000900-torn").mkdir()  # a driver that was lost before its marker
    assert sorted(r.series_id for r in store.read_models(spark, path).collect()) == ["a", "b"]
    store.write_models(rows("b", "d"), path)
    assert sorted(r.series_id for r in store.read_models(spark, path).collect()) == ["a", "b", "d"]
    assert sorted(r.series_id for r in begun.collect()) == ["a", "b"]
    for name in "efg":
        store.write_models(rows(name), path)
    versions = sorted(p.name for p in folder.iterdir() if p.name.startswith("version-"))
    assert len(versions) == 2 and not [v for v in versions if "torn" in v]
    assert store.read_models(spark, path).count() == 6


def test_tables_without_versions_are_read(spark, tmp_path):
    small_frame(spark, [("a", 1.0)], "series_id string, phi double").write.parquet(str(tmp_path / "models"))
    assert store.read_models(spark, str(tmp_path)).count() == 1
    store.write_models(small_frame(spark, [("b", 1.0)], "series_id string, phi double"), str(tmp_path))
    assert store.read_models(spark, str(tmp_path)).count() == 2


def test_an_endless_rule_is_stopped_and_the_others_finish(spark, sf_dir):
    ds = tables(spark, sf_dir, "customer")
    rules = generate.null_rules(column_catalog(ds), ds)
    endless = "SELECT count(*) AS failed_count FROM range(1000000000000000) WHERE id % 7 = 8"
    slow = maintain.new_rule(rules, "customer", "c_name", "Custom", endless, None, None)
    found = run_rules(ds, rules.unionByName(slow), include_pass=True, limit_seconds=12).results.collect()
    stopped = [r for r in found if r.rule_family == "Custom"]
    assert [r.status for r in stopped] == ["ERROR"] and "stopped after 12 seconds" in stopped[0].error_message
    assert sorted(r.status for r in found if r.rule_family != "Custom") == ["PASS"] * rules.count()


def test_database_tables_leave_views_out(spark, tmp_path):
    store.ensure_store(spark, str(tmp_path / "db"), "dq_test")
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "db" / "kept")).saveAsTable("dq_test.kept")
    spark.sql("CREATE OR REPLACE VIEW dq_test.seen AS SELECT 1 AS one")
    spark.range(1).createOrReplaceTempView("passing")
    assert list(dqloom.load_database(spark, "dq_test").tables) == ["kept"]
    spark.sql("DROP DATABASE dq_test CASCADE")


def test_command_line_job(spark, sf_dir, tmp_path, capsys):
    from dqloom.__main__ import main

    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(tmp_path / "in" / f"{name}.parquet"))
    main(["--tables", str(tmp_path / "in"), "--store", str(tmp_path / "out"), "--key", "documents.doc_id=labels.doc_id"])
    assert "source_data is failing" in capsys.readouterr().out
    families = {r.rule_family for r in store.read_results(spark, str(tmp_path / "out")).collect()}
    assert "Referential Integrity" in families
