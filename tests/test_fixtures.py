"""Known counts of the seeded table and the clean tables, at the scale under test."""

import datetime as dt

import pytest

from dqloom.operators import ar1, checks, series
from registry.inputs import PRIORITY, tables

SCALES = {"sf0.001": 0, "sf0.01": 1, "sf0.1": 2}
# Known counts at the three scales.
COUNTS = {
    "rows": (1519, 15181, 151808),
    "null_totalprice": (16, 155, 1547),
    "null_custkey": (13, 131, 1313),
    "duplicate_values": (19, 181, 1808),
    "duplicate_rows": (38, 362, 3616),
    "orphans": (17, 169, 1686),
    "empty": (15, 149, 1486),
    "format": (29, 293, 2928),
    "lineitem_keys": (1365, 13623, 136220),
    "conversations": (20, 100, 1000),
    "labels": (113, 601, 6020),
}


def test_counts(spark, sf_dir):
    ds = tables(spark, sf_dir, "orders_dirty", "customer", "lineitem", "conversations", "documents", "labels")
    dirty = ds["orders_dirty"]
    found = {
        "null_totalprice": checks.null_check(dirty, "o_totalprice"),
        "null_custkey": checks.null_check(dirty, "o_custkey"),
        "duplicate_values": checks.uniqueness_check(dirty, "o_orderkey"),
        "duplicate_rows": checks.duplicate_rows(dirty, "o_orderkey"),
        "orphans": checks.ri_check(dirty, "o_custkey", ds["customer"], "c_custkey"),
        "empty": checks.empty_check(dirty, "o_orderpriority"),
        "format": checks.format_check(dirty, "o_orderpriority", PRIORITY),
        "lineitem_keys": checks.uniqueness_check(ds["lineitem"], "l_orderkey"),
        "conversations": checks.uniqueness_check(ds["conversations"], "conv_id"),
        "labels": checks.ri_check(ds["documents"], "doc_id", ds["labels"], "doc_id"),
    }
    scale = SCALES[sf_dir.rstrip("/").rsplit("/", 1)[-1]]
    assert dirty.count() == COUNTS["rows"][scale]
    for name, frame in found.items():
        assert frame.first().failed_count == COUNTS[name][scale], name


SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def hourly(spark):
    events = tables(spark, SF001, "events")["events"]
    return events, series.resample(events, "events", "ts", "value", "hour", "sum")


def test_ar1_on_hourly_sums(hourly):
    _, hours = hourly
    model = ar1.fit_ar1(hours)
    row = model.first()
    assert (row.n, round(row.phi, 6), round(row.intercept, 6)) == (719, 0.078693, 634.605027)
    assert row.sigma == pytest.approx(261.07404, abs=1e-5)
    flags = ar1.detect_anomalies(ar1.score_in_sample(model, hours))
    assert ar1.anomaly_check(flags).first().failed_count == 9


def test_forecast_of_later_hours(hourly):
    events, _ = hourly
    as_of = dt.date(2024, 1, 25)
    past = series.training_rows(events, "ts", "value", dt.date(2024, 1, 1), dt.date(2024, 1, 24))
    trained = series.resample(past, "events", "ts", "value", "hour", "sum")
    recent = series.bucketed(series.recent_rows(events, "ts", as_of), "events", "ts", "value", "hour", "sum")
    scored = ar1.detect_anomalies(ar1.score_ahead(ar1.fit_ar1(trained), recent, "hour")).toPandas()
    assert len(scored) == 144
    assert scored.is_anomaly.sum() == 1
    assert scored.forecast.mean() == pytest.approx(691.41339, abs=1e-5)
    assert scored.se.max() == pytest.approx(265.4955, abs=1e-3)


def test_gaps_are_filled_on_a_line(hourly):
    events, _ = hourly
    rows = events.where("ts < timestamp_ntz'2024-01-10' and hour(ts) <> 3")
    filled = series.resample(rows, "events", "ts", "value", "hour").toPandas()
    assert (len(filled), filled.filled.sum()) == (216, 9)
    assert filled.y.mean() == pytest.approx(49.070546, abs=1e-6)


def test_spike_day_is_the_only_flag(spark):
    from registry.queries import _orders_flags

    flags = _orders_flags(tables(spark, SF001, "orders_dirty")).where("is_anomaly").collect()
    assert [str(r.bucket.date()) for r in flags] == ["2001-07-15"]
