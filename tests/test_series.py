"""Column choice, windows, buckets, and automatic-order fits against simulations."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.operators import anomalies, ar1, arima, series
from dqloom.plans import generate
from dqloom.plans.execute import run_rules
from dqloom.session import small_frame
from dqloom.sources import store
from dqloom.sources.dataset import Dataset
from registry.inputs import ORDERS_AS_OF, tables


def schema(text):
    return T.StructType.fromDDL(text)


@pytest.mark.parametrize(
    "columns, time_column, metric",
    [
        ("id bigint, ts timestamp, x double, day date", "ts", "id"),
        ("id bigint, day date, amount decimal(10,2), total_sales float", "day", "total_sales"),
        ("id bigint, l_discount double, l_total string", None, "l_discount"),
        ("id bigint, Value double, row_count int", None, "row_count"),
        ("name string, at timestamp_ntz", "at", None),
    ],
)
def test_column_choice(spark, columns, time_column, metric):
    assert series.pick_time_column(schema(columns)) == time_column
    assert series.pick_metric_column(schema(columns)) == metric


def test_buckets_do_not_depend_on_the_session_zone(spark):
    frame = small_frame(spark, [(dt.datetime(2024, 3, 10, 2, 30, 15),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = frame.select(*[series.bucket_of(F.col("t"), u).alias(u) for u in series.UNIT_SECONDS]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.minute == dt.datetime(2024, 3, 10, 2, 30)
    assert row.hour == dt.datetime(2024, 3, 10, 2)
    assert row.day == dt.datetime(2024, 3, 10)


def test_gaps_over_a_clock_change(spark):
    """Neither the grid nor the line may follow the session zone's clock."""
    start = dt.datetime(2024, 3, 9)
    rows = [("s", start + dt.timedelta(hours=h), float(h)) for h in range(48) if h % 5 == 0 or h == 47]
    frame = small_frame(spark, rows, "series_id string, bucket timestamp_ntz, y double")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        filled = series.fill_gaps(frame, "hour").orderBy("bucket").collect()
        unit = series.infer_frequency(frame, "bucket").first().unit
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.bucket for r in filled] == [start + dt.timedelta(hours=h) for h in range(48)]
    assert [r.y for r in filled] == pytest.approx(range(48))
    assert unit == "day"


def test_training_window_of_dates_and_of_nothing(spark):
    as_of = dt.date(2024, 6, 10)
    days = small_frame(spark, [(dt.date(2024, 5, 1),), (dt.date(2024, 7, 1),), (None,)], "d date")
    through = series.training_window(days, "d", as_of, through_max=True).first()
    assert (through.training_start, through.training_end) == (dt.date(2024, 4, 2), dt.date(2024, 7, 1))
    before = series.training_window(days, "d", as_of).first()
    assert before.training_end == dt.date(2024, 6, 9)
    empty = series.training_window(days.where("false"), "d", as_of).first()
    assert (empty.training_start, empty.training_end) == (as_of - dt.timedelta(97), as_of - dt.timedelta(7))


START = pd.Timestamp("2020-01-01")


def simulated(name, ar, ma, n=2000, mean=0.0, seed=7):
    shocks = np.random.default_rng(seed).normal(size=n + 200)
    z = np.zeros(n + 200)
    for t in range(5, n + 200):
        z[t] = shocks[t] + sum(a * z[t - i] for i, a in enumerate(ar, 1)) + sum(m * shocks[t - j] for j, m in enumerate(ma, 1))
    hours = [START + pd.Timedelta(hours=i) for i in range(n)]
    return pd.DataFrame({"series_id": name, "bucket": hours, "y": z[200:] + mean})


def responses(ar, ma, steps=6):
    psi = [1.0]
    for h in range(1, steps):
        psi.append(sum(a * psi[h - i] for i, a in enumerate(ar, 1) if i <= h) + (ma[h - 1] if h <= len(ma) else 0))
    return psi


SERIES = "series_id string, bucket timestamp_ntz, y double"


@pytest.fixture(scope="module")
def models(spark):
    walk = simulated("walk", [0.3], [])
    walk["y"] = walk.y.cumsum()
    flat = simulated("flat", [], [], 400)
    flat["y"] = 1.0
    parts = [
        simulated("ar2", [0.5, -0.3], []),
        simulated("arma", [0.6], [0.4]),
        simulated("ar1", [0.7], [], mean=10),
        walk,
        flat,
        simulated("short", [], [], 6),
    ]
    frame = spark.createDataFrame(pd.concat(parts), SERIES)
    return frame, arima.fit_arima(frame, "hour", seasonal=False)


def test_fixed_orders_recover_coefficients(spark, models):
    frame, _ = models
    ar2 = arima.fit_arima(frame.where("series_id = 'ar2'"), "hour", order=(2, 0, 0), seasonal=False).first()
    assert ar2.ar == pytest.approx([0.5, -0.3], abs=0.06)
    arma = arima.fit_arima(frame.where("series_id = 'arma'"), "hour", order=(1, 0, 1), seasonal=False).first()
    assert (arma.ar[0], arma.ma[0]) == pytest.approx((0.6, 0.4), abs=0.08)
    assert arma.sigma == pytest.approx(1.0, abs=0.05)


def test_automatic_order(models):
    _, fitted = models
    rows = {r.series_id: r for r in fitted.collect()}
    assert set(rows) == {"ar2", "arma", "ar1", "walk"}
    assert [rows[s].d for s in ("walk", "ar2", "arma", "ar1")] == [1, 0, 0, 0]
    # different orders can describe one process: its responses to a shock must agree
    for name, ar, ma in (("ar2", [0.5, -0.3], []), ("arma", [0.6], [0.4]), ("ar1", [0.7], []), ("walk", [0.3], [])):
        assert responses(rows[name].ar, rows[name].ma) == pytest.approx(responses(ar, ma), abs=0.1)
    assert all(r.p + r.q <= 5 for r in rows.values())


def test_first_order_agrees_with_the_closed_form(spark, models):
    frame, _ = models
    one = frame.where("series_id = 'ar1'")
    fixed = ar1.fit_ar1(one)
    general = arima.fit_arima(one, "hour", order=(1, 0, 0), seasonal=False)
    assert general.first().ar[0] == pytest.approx(fixed.first().phi, abs=0.01)
    # same coefficients, so the two forecasts must be the same numbers
    same = general.drop("ar", "intercept", "sigma", "last_y").join(
        fixed.select("series_id", F.array("phi").alias("ar"), "intercept", "sigma", "last_y"), "series_id"
    ).withColumn("last_z", F.array("last_y"))
    ahead = arima.forecast(same, "hour", 48)
    later = ahead.select("series_id", "bucket", F.lit(0.0).alias("y"))
    closed = ar1.score_ahead(fixed, later, "hour").select("bucket", F.col("forecast").alias("f"), F.col("se").alias("s"))
    both = ahead.join(closed, "bucket").toPandas()
    assert len(both) == 48
    assert both.forecast.to_numpy() == pytest.approx(both.f.to_numpy())
    assert both.se.to_numpy() == pytest.approx(both.s.to_numpy())


def test_in_sample_errors_have_the_fitted_size(models):
    frame, fitted = models
    scored = arima.score_in_sample(fitted, frame, "hour")
    sizes = scored.groupBy("series_id").agg(
        F.stddev_pop(F.col("y") - F.col("forecast")).alias("found"), F.first("se").alias("se")
    )
    for row in sizes.collect():
        assert row.found == pytest.approx(row.se, rel=0.01)


def test_season_is_taken_out_and_put_back(spark):
    hours = [START + pd.Timedelta(hours=i) for i in range(24 * 40)]
    noise = np.random.default_rng(3).normal(scale=0.1, size=len(hours))
    y = [10 + 5 * np.sin(h.hour / 24 * 2 * np.pi) + e for h, e in zip(hours, noise)]
    frame = spark.createDataFrame(pd.DataFrame({"series_id": "s", "bucket": hours, "y": y}), SERIES)
    fitted = arima.fit_arima(frame, "hour")
    ahead = arima.forecast(fitted, "hour", 24).toPandas().sort_values("step")
    expected = [10 + 5 * np.sin(b.hour / 24 * 2 * np.pi) for b in ahead.bucket]
    assert ahead.forecast.to_numpy() == pytest.approx(np.array(expected), abs=0.3)


@pytest.fixture(scope="module")
def spiked(spark):
    """120 days of one row per day, with a spike on the last but one."""
    values = 100 + np.random.default_rng(5).normal(size=120)
    values[118] = 200
    day = dt.datetime(2024, 1, 1)
    rows = [(i, day + dt.timedelta(i), float(v)) for i, v in enumerate(values)]
    rows += [(1000, day + dt.timedelta(118, 3600), 200.0), (1001, None, 5.0), (1002, day, None)]
    return Dataset(spark, {"daily-sales": small_frame(spark, rows, "id int, at timestamp_ntz, sale double")})


@pytest.mark.parametrize("through_max", [False, True])
def test_anomaly_rule_from_training_to_samples(spark, spiked, tmp_path, through_max):
    as_of = dt.date(2024, 4, 20)
    generated = generate.generate_rules(spiked, as_of=as_of, through_max=through_max)
    rule = generated.rules.where("rule_family = 'Anomaly Detection'").first()
    assert rule.metric_column == "sale" and rule.bucket_unit == "day"
    model = generated.models.first()
    assert model.series_id == "dq_arima_daily_sales_sale"
    store.write_models(generated.models, str(tmp_path))
    store.write_models(generated.models, str(tmp_path))
    kept = store.read_models(spark, str(tmp_path))
    assert kept.count() == 1
    outcome = run_rules(spiked, generated.rules, kept, as_of)
    found = outcome.results.where("rule_family = 'Anomaly Detection'").first()
    assert (found.status, found.failed_rows) == ("FAIL", 1)
    ids = outcome.samples.where(F.col("rule_id") == rule.rule_id).collect()
    assert sorted(r.source_id for r in ids) == ["1000", "118"]


def test_series_without_data_have_no_rule(spark):
    empty = small_frame(spark, [(1, dt.datetime(2024, 1, 1), 5.0)], "id int, at timestamp_ntz, sale double")
    generated = generate.generate_rules(Dataset(spark, {"t": empty}), as_of=dt.date(2024, 2, 1))
    assert generated.rules.where("rule_family = 'Anomaly Detection'").count() == 0
    assert generate.generate_rules(Dataset(spark, {"t": empty.drop("at")})).models is None


def test_frequency_of_sparse_tables(spark):
    """The finest covered unit, day where no second time says anything."""
    day = dt.datetime(2020, 1, 6)
    for unit, step in (("day", 1), ("week", 7), ("month", 30.4), ("quarter", 91.3), ("year", 365.25)):
        rows = [(day + dt.timedelta(int(step * i)),) for i in range(12)]
        assert series.infer_frequency(small_frame(spark, rows, "t timestamp_ntz"), "t").first().unit == unit
    for rows in ([], [(None,)], [(day,)], [(day,), (day,)]):
        assert series.infer_frequency(small_frame(spark, rows, "t timestamp_ntz"), "t").first().unit == "day"


def test_numbers_of_buckets_go_with_the_calendar(spark):
    """The next bucket has the next number, whatever its length, and moving leads to it."""
    days = spark.sql("select explode(sequence(date'1895-01-01', date'2105-01-01', interval 1 day)) as day").selectExpr("cast(day as timestamp_ntz) as t")
    for unit in series.UNITS:
        rows = days.select(series.bucket_of(F.col("t"), unit).alias("b")).distinct()
        rows = rows.select("b", series.number_of(F.col("b"), unit).alias("n"))
        jumps = {"minute": 1440, "hour": 24}.get(unit, 1)
        ahead = rows.join(rows.selectExpr("b as next", "n as n2"), F.col("n2") == F.col("n") + jumps)
        moved = series.moved(F.col("b"), F.lit(jumps).cast("bigint"), unit)
        found = ahead.agg(F.count(F.lit(1)).alias("n"), F.count_if(moved == F.col("next")).alias("same")).first()
        assert found.n == found.same == rows.count() - 1


def test_weekly_and_monthly_tables_keep_their_unit(spark):
    """No bucket is invented; training reaches back far enough; a late spike is flagged."""
    noise = np.random.default_rng(11).normal(size=60)
    weeks = [(i, dt.date(2023, 1, 2) + dt.timedelta(7 * i), 500.0 if i == 58 else 100 + float(noise[i])) for i in range(60)]
    months = [(i, dt.date(2019 + i // 12, i % 12 + 1, 1), 100 + float(noise[i])) for i in range(60)]
    ds = Dataset(spark, {n: small_frame(spark, r, "id int, day date, amount double") for n, r in (("weeks", weeks), ("months", months))})
    for table, unit, last in (("weeks", "week", weeks[57][1]), ("months", "month", months[57][1])):
        spec = anomalies.series_spec(ds[table], table, "day", "amount", last + dt.timedelta(1))
        assert spec.unit == unit and spec.end == last
        known = series.fill_gaps(anomalies.training_series(ds, [spec]), unit)
        assert known.count() >= series.TRAINING_BUCKETS and known.where("filled").isEmpty()
    as_of = weeks[57][1] + dt.timedelta(1)
    models = generate.train_models(ds.only("weeks"), as_of)
    rules = generate.anomaly_rules(models, ds)
    outcome = run_rules(ds.only("weeks"), rules, models, as_of)
    assert [(r.status, r.failed_rows) for r in outcome.results.collect()] == [("FAIL", 1)]
    assert [r.source_id for r in outcome.samples.collect()] == ["58"]


def test_gaps_are_filled_across_blocks(spark, monkeypatch):
    """Gaps within a block, over several, and at their edges, in pieces."""
    monkeypatch.setattr(series, "BLOCK", 5)
    hours = [0, 1, 4, 5, 9, 10, 31, 32, 49, 50]
    start = dt.datetime(2024, 1, 1)
    rows = [(s, start + dt.timedelta(hours=h), float(h * h)) for s in ("a", "b") for h in hours]
    filled = series.fill_gaps(small_frame(spark, rows, "series_id string, bucket timestamp_ntz, y double"), "hour")
    for s in ("a", "b"):
        found = filled.where(F.col("series_id") == s).orderBy("bucket").collect()
        assert [r.bucket for r in found] == [start + dt.timedelta(hours=h) for h in range(51)]
        assert [r.y for r in found] == pytest.approx(np.interp(range(51), hours, [h * h for h in hours]))
        assert [h for h, r in enumerate(found) if not r.filled] == hours


def test_a_sentinel_date_does_not_end_the_run(spark):
    """Millions of steps to the year 9999 are neither an array nor a window."""
    rows = [("s", dt.datetime(2024, 1, 1), 1.0), ("s", dt.datetime(9999, 12, 31), 2.0)]
    frame = small_frame(spark, rows, "series_id string, bucket timestamp_ntz, y double")
    assert len(series.fill_gaps(frame, "minute").limit(1000).collect()) == 1000
    found = series.fill_gaps(frame, "hour").agg(F.count(F.lit(1)).alias("n"), F.max("bucket").alias("last"), F.count_if(~F.col("filled")).alias("known")).first()
    assert (found.n, found.last, found.known) == ((rows[1][1] - rows[0][1]).days * 24 + 1, rows[1][1], 2)
    plan = series.fill_gaps(frame, "minute")._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(series_id" in plan and "block" in plan.split("windowspecdefinition(series_id")[1][:40]


def test_frequency_of_a_window(spark, sf_dir):
    ds = tables(spark, sf_dir, "orders", "events")
    spec = anomalies.series_spec(ds["events"], "events", "ts", "value", ORDERS_AS_OF, through_max=True)
    assert spec.unit in ("hour", "day")


def test_far_steps_cost_no_more_than_near_ones():
    """A step millions ahead equals the limit of the recursion, and near ones are unchanged."""
    from types import SimpleNamespace

    import numpy as np

    from dqloom.operators.arima_solve import _path

    for d in (0, 1):
        model = SimpleNamespace(intercept=2.0, ar=[0.6, -0.1], ma=[0.3], last_z=[5.0, 4.0], last_e=[1.0], d=d, last_y=100.0, sigma=2.0)
        near_mean, near_se = _path(model, np.arange(1, 400))
        mean, se = _path(model, np.array([3, 399, 4_200_000_000]))
        assert np.allclose(mean[:2], near_mean[[2, 398]]) and np.allclose(se[:2], near_se[[2, 398]])
        level = 2.0 / (1 - 0.6 + 0.1)
        if d:
            assert abs(mean[2] - (near_mean[-1] + (4_200_000_000 - 399) * level)) < 1e-3 * abs(mean[2])
        else:
            assert abs(mean[2] - level) < 1e-9 and abs(se[2] - near_se[-1]) < 1e-9


def test_long_error_messages_are_kept_whole(spark):
    from dqloom.plans.execute import _outcome
    from pyspark.sql import Row

    assert len(_outcome(Row(rule_id="r"), None, ValueError("x" * 5000), 0.0)[2]) > 5000


def test_shared_folder_must_be_named():
    from types import SimpleNamespace

    import pytest

    from dqloom.session import shared_folder

    with pytest.raises(RuntimeError):
        shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None)))
