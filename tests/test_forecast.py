from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sitepulse.functions.temporal import add_calendar
from sitepulse.operators import forecast, series
from tests.conftest import values


@pytest.fixture
def gappy(readings):
    """A long series with gaps of weeks, a short one and one that is too short for any lag row."""
    rng = np.random.default_rng(2)
    rows, at = [], 0
    for junction, length in ((1, 400), (2, 34), (3, 24), (4, 1)):
        hours = np.cumsum(rng.choice([1, 1, 1, 2, 9, 700], length, p=[0.5, 0.2, 0.1, 0.1, 0.08, 0.02]))
        for hour in hours:
            rows.append((at, int(hour), junction, int(rng.integers(0, 200))))
            at += 1
    return add_calendar(readings(*rows))


def expected_lags(frame):
    table = frame.toPandas().sort_values(["Junction", "DateTime"])
    table["last"] = table.groupby("Junction")["Vehicles"].shift(1)
    table["day"] = table.groupby("Junction")["Vehicles"].shift(24)
    return table.dropna()


@pytest.mark.parametrize("block_rows", [24, 31, 100, 4096])
def test_lags_equal_pandas(gappy, block_rows):
    want = expected_lags(gappy)
    found = values(
        forecast.lag_features(gappy, block_rows), "Junction", "DateTime", forecast.LAST_HOUR, forecast.YESTERDAY
    )
    assert found == sorted(
        (int(j), t.to_pydatetime(), int(a), int(b))
        for j, t, a, b in zip(want["Junction"], want["DateTime"], want["last"], want["day"])
    )


def test_block_must_hold_the_lag(gappy):
    with pytest.raises(ValueError):
        forecast.lag_features(gappy, 23)


def test_row_numbers_without_blocks(gappy):
    table = gappy.toPandas().sort_values(["Junction", "DateTime"])
    table["n"] = table.groupby("Junction").cumcount() + 1
    found = values(series.number_rows(gappy), "ID", "RowNo")
    assert found == sorted((int(i), int(n)) for i, n in zip(table["ID"], table["n"]))


def test_null_rows_leave_before_the_split(readings):
    frame = add_calendar(readings(*[(h, h, 1, None if h == 40 else h) for h in range(80)]))
    split = forecast.training_matrix(frame, block_rows=24)
    # Row 40 itself, the row after it and the row a day later lack a value: 56 - 3 rows remain.
    rows = values(split, "RowNo", "RowCount", "TrainRows", "ID", "Side")
    assert [r[0] for r in rows] == list(range(1, 54)) and {r[1:3] for r in rows} == {(53, 42)}
    assert not {40, 41, 64} & {r[3] for r in rows}


@pytest.mark.parametrize("block_rows", [24, 4096])
def test_split_of_34_readings(gappy, block_rows):
    report = {(r["Junction"], r["Side"]): r for r in forecast.split_report(forecast.training_matrix(gappy, block_rows=block_rows)).collect()}
    assert report[2, "train"]["Records"] == 8 and report[2, "test"]["Records"] == 2
    assert report[1, "train"]["Records"] == 300 and report[1, "test"]["Records"] == 76
    assert report[1, "train"]["Last"] < report[1, "test"]["First"]
    assert {j for j, _ in report} == {1, 2}


def test_split_of_plain_lags_equals_the_joint_one(gappy):
    apart = forecast.chrono_split(forecast.lag_features(gappy))
    joint = forecast.training_matrix(gappy, block_rows=30)
    assert values(apart, "ID", "RowNo", "Side") == values(joint, "ID", "RowNo", "Side")


def test_metrics(spark):
    rows = [(1, "test", 1, 2.0), (1, "test", 3, 2.0), (1, "test", 5, 6.0), (2, "test", 4, 4.0), (2, "test", 4, 4.0),
            (3, "test", 4, 5.0), (3, "test", 4, 4.0), (4, "test", 1, 1.0)]
    frame = spark.createDataFrame(rows, "Junction bigint, Side string, Vehicles bigint, Predicted double")
    found = {r["Junction"]: (r["MAE"], r["R2"]) for r in forecast.forecast_metrics(frame).collect()}
    assert found == {1: (1.0, pytest.approx(1 - 3 / 8)), 2: (0.0, 1.0), 3: (0.5, 0.0), 4: (0.0, None)}


@pytest.fixture(scope="module")
def trained(spark):
    hours = np.arange(24 * 20)
    rows = []
    for junction, level in ((1, 20), (2, 200), (3, 50)):
        length = len(hours) if junction < 3 else 30
        for h in hours[:length]:
            value = int(level * (1.5 + np.sin(h % 24 / 24 * 2 * np.pi)))
            rows.append((int(h) + junction * 10_000, datetime(2024, 1, 1) + timedelta(hours=int(h)), junction, value))
    frame = spark.createDataFrame(rows, "ID bigint, DateTime timestamp_ntz, Junction bigint, Vehicles bigint")
    split = forecast.add_site_mean(forecast.training_matrix(add_calendar(frame))).persist()
    return forecast.train_all(split, trees=10, depth=6), split


def test_pooled_forest_learns_both_levels(trained):
    model, split = trained
    metrics = {(r["Junction"], r["Side"]): r for r in forecast.forecast_metrics(forecast.predict(model, split)).collect()}
    assert metrics[1, "test"]["R2"] > 0.9 and metrics[2, "test"]["R2"] > 0.9


def test_same_seed_repeats(trained):
    model, split = trained
    again = forecast.train_all(split, trees=10, depth=6)
    assert values(forecast.predict(again, split), "ID", "Predicted") == values(forecast.predict(model, split), "ID", "Predicted")


def test_importances(trained):
    model, split = trained
    rows = forecast.feature_importance(model, split).collect()
    weights = [r["Importance"] for r in rows]
    assert {r["Feature"] for r in rows} == {*forecast.FEATURES, forecast.SITE_MEAN}
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1)


def test_one_junction_forest(trained):
    _, split = trained
    model = forecast.train_junction(split, 1, trees=10, depth=6)
    predicted = forecast.predict(model, split.where(F.col("Junction") == 1))
    row = forecast.forecast_metrics(predicted).where("Side = 'test'").first()
    assert row["R2"] > 0.9


def test_forest_per_junction(trained):
    _, split = trained
    models = forecast.train_each(split, [1, 2, 3], trees=5, depth=4)
    assert set(models) == {1, 2, 3}
    predicted = forecast.predict_each(models, split)
    assert predicted.count() == split.count()
    assert set(forecast.train_each(split, [2, 99], trees=1, depth=1)) == {2}


def test_any_number_of_named_junctions(spark):
    rows = [(j, h, j * 10 + h % 2, "train" if h < 8 else "test") for j in range(33) for h in range(10)]
    split = spark.createDataFrame(rows, "Junction bigint, h int, Vehicles bigint, Side string").selectExpr(
        "Junction", "Vehicles", "Side", "timestamp_ntz'2024-01-01' + make_dt_interval(0, h) DateTime",
        "h Hour", "0 DayOfWeek", "0 IsWeekend", "Vehicles Traffic_Last_Hour", "Vehicles Traffic_Yesterday_Same_Hour",
    )
    assert len(forecast.train_each(split, range(33), trees=1, depth=1)) == 33


def test_fit_does_not_follow_the_shuffle_setting(spark, trained):
    _, split = trained
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for partitions in ("3", "5"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            model = forecast.train_all(split, trees=3, depth=4)
            found.append(sorted(r["Predicted"] for r in forecast.predict(model, split).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert found[0] == found[1]


def test_a_junction_without_training_rows_stays(spark):
    rows = [(1, 5, "train"), (1, 7, "train"), (1, 9, "test"), (2, 3, "test")]
    split = spark.createDataFrame(rows, "Junction bigint, Vehicles bigint, Side string")
    found = {(r["Junction"], r["Vehicles"]): r["Site_Mean"] for r in forecast.add_site_mean(split).collect()}
    assert found == {(1, 5): 6.0, (1, 7): 6.0, (1, 9): 6.0, (2, 3): 6.0}


def test_rollout_equals_step_by_step(spark, trained):
    """The 24 columns give what feeding one prediction after the other to the model gives."""
    model, split = trained
    ahead = {(r["Junction"], r["Step"]): r for r in forecast.forecast_24h(model, split).collect()}
    # 30 readings leave six lag rows: too few for a forecast.
    assert set(ahead) == {(j, s) for j in (1, 2) for s in range(1, 25)}
    history = split.where("Junction = 1").orderBy("DateTime").toPandas()
    day, mean = history["Vehicles"].tolist()[-24:], history[forecast.SITE_MEAN].iloc[0]
    previous, clock = float(day[-1]), history["DateTime"].iloc[-1]
    for step in range(1, 25):
        at = clock + pd.Timedelta(hours=step)
        row = (at.hour, at.dayofweek, int(at.dayofweek >= 5), previous, float(day[step - 1]), float(mean))
        one = spark.createDataFrame(
            [row], "Hour int, DayOfWeek int, IsWeekend int, Traffic_Last_Hour double, "
            "Traffic_Yesterday_Same_Hour double, Site_Mean double",
        )
        previous = max(0.0, model.transform(one).first()["Predicted"])
        assert ahead[1, step]["DateTime"] == at.to_pydatetime()
        assert ahead[1, step]["Predicted"] == pytest.approx(previous)
        assert ahead[1, step]["Predicted"] >= 0


def test_summary_takes_the_earliest_peak(spark):
    clock = [datetime(2024, 2, 1) + timedelta(hours=h) for h in range(4)]
    rows = [(1, i + 1, t, v) for i, (t, v) in enumerate(zip(clock, [1.0, 5.0, 5.0, 3.0]))]
    frame = spark.createDataFrame(rows, "Junction bigint, Step int, DateTime timestamp_ntz, Predicted double")
    row = forecast.forecast_summary(frame).first()
    assert (row["Avg_Predicted"], row["Peak_Predicted"], row["Peak_Step"]) == (3.5, 5.0, 2)
    assert row["Peak_Time"] == clock[1]


def test_chart_rows_stop_at_n(trained):
    model, split = trained
    chart = forecast.actual_vs_predicted(forecast.predict(model, split), 10)
    assert values(chart.where("Junction = 1"), "TimeIndex") == [(i,) for i in range(1, 11)]
