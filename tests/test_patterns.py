import statistics

import numpy as np
import pandas as pd
import pytest

from sitepulse.functions.distribution import quantiles_by_key, value_counts
from sitepulse.functions.temporal import add_calendar
from sitepulse.operators import patterns, profiles
from tests.conftest import values


def test_peak_tie_takes_the_earlier_hour(readings):
    frame = add_calendar(readings((1, 9, 1, 5), (2, 7, 1, 5), (3, 8, 1, 1)))
    assert values(patterns.peak_hour(frame), "PeakHour", "PeakHourTraffic") == [(7, 5.0)]
    features = profiles.junction_features(frame).first()
    assert (features["PeakHour"], features["PeakHourTraffic"]) == (7, 5.0)


def test_patterns_of_cube_and_readings_agree(readings):
    frame = add_calendar(readings(*[(i, i * 5, i % 3, i * i % 17) for i in range(200)]))
    cube = patterns.hour_cube(frame)
    for operator in (patterns.hourly_trend, patterns.weekly_pattern, patterns.hourly_daytype, patterns.junction_detail,
                     patterns.peak_hour, patterns.heatmap, profiles.enhanced_profiles):
        assert sorted(operator(cube).collect()) == sorted(operator(frame).collect())


def test_moments_combine_cells(readings):
    counts = [int(x) for x in np.random.default_rng(3).integers(0, 500, 300)]
    frame = add_calendar(readings(*[(i, i, 1, v) for i, v in enumerate(counts)]))
    row = patterns.junction_moments(patterns.hour_cube(frame)).first()
    assert row["Records"] == 300 and row["Mean"] == pytest.approx(statistics.mean(counts))
    assert row["Std"] == pytest.approx(statistics.stdev(counts), rel=1e-12)


def test_spread_equals_pandas(readings):
    counts = pd.Series([1, 2, 2, 3, 3, 3, 4, 50, 60])
    frame = readings(*[(i, i, 1, int(v)) for i, v in enumerate(counts)], (99, 99, 1, None))
    q1, q3 = counts.quantile(0.25), counts.quantile(0.75)
    row = patterns.junction_spread(frame).first()
    assert row["IQR"] == q3 - q1 and row["Median"] == counts.median() and row["Std"] == pytest.approx(counts.std())
    assert row["Outliers"] == int(((counts < q1 - 1.5 * (q3 - q1)) | (counts > q3 + 1.5 * (q3 - q1))).sum())
    described = patterns.junction_describe(frame).first()
    assert described["Count"] == 9 and described["Mean"] == pytest.approx(counts.mean())
    box = patterns.boxplot_stats(frame).first()
    assert (box["Whisker_Low"], box["Whisker_High"]) == (1, 4)
    assert values(patterns.boxplot_outliers(frame), "Vehicles", "Readings") == [(50, 1), (60, 1)]


@pytest.mark.parametrize("counts", [[0, 1, 5, 9, 10, 10, 30, 31], [7, 7, 7], list(range(61))])
def test_histogram_equals_numpy(readings, counts):
    frame = readings(*[(i, i, 1, v) for i, v in enumerate(counts)])
    expected, edges = np.histogram(counts, bins=30)
    rows = patterns.vehicle_histogram(frame).orderBy("Bin").collect()
    assert [r["Readings"] for r in rows] == list(expected)
    assert [r["Bin_Start"] for r in rows] == pytest.approx(list(edges[:-1]))
    assert rows[-1]["Bin_End"] == pytest.approx(edges[-1])


def test_data_summary(spark, readings):
    row = patterns.data_summary(readings((1, 0, 1, 4), (2, 47, 2, 7))).first()
    assert row["total_records"] == 2 and row["num_junctions"] == 2
    assert row["date_range"]["days"] == 1 and row["date_range"]["end"] == "2024-01-02 23:00:00"
    assert tuple(row["vehicle_stats"]) == (5.5, 5.5, 4, 7)
    empty = patterns.data_summary(readings((1, 0, 1, 4)).where("false")).first()
    assert empty["total_records"] == 0 and empty["vehicle_stats"]["mean"] is None


def test_weekday_gap_weights_days_equally(readings):
    # Monday twice (10, 10), Tuesday once (40), Saturday once (50).
    frame = add_calendar(readings((1, 0, 1, 10), (2, 1, 1, 10), (3, 24, 1, 40), (4, 120, 1, 50)))
    row = patterns.weekday_weekend_gap(frame).first()
    assert tuple(row) == (25.0, 50.0, 25.0, 100.0)


def test_single_row_site(readings):
    frame = add_calendar(readings((1, 5, 1, 9)))
    row = profiles.junction_features(frame).first()
    assert row["Vehicles_std"] == 0 and row["Vehicles_mean"] == 9 and row["Hour_5_Avg"] == 9 and row["Hour_6_Avg"] == 0


def test_ratio_without_weekdays_and_with_zero_weekdays(readings):
    weekend_only = add_calendar(readings((1, 120, 1, 9)))
    assert values(profiles.weekend_ratio(weekend_only), "Weekend_Avg", "Weekday_Avg", "Weekend_Weekday_Ratio") == [
        (9.0, 0.0, 0.0)
    ]
    zero_weekday = add_calendar(readings((1, 120, 1, 9), (2, 0, 1, 0)))
    assert values(profiles.weekend_ratio(zero_weekday), "Weekend_Weekday_Ratio") == [(0.0,)]
    assert profiles.junction_features(zero_weekday).first()["Weekend_Weekday_Ratio"] == 0


def test_profile_hours_are_inclusive(readings):
    frame = add_calendar(readings(*[(h, h, 1, h) for h in range(24)]))
    row = profiles.enhanced_profiles(frame).first()
    assert row["Morning_Peak"] == 9 and row["Evening_Peak"] == 18 and row["Max_Vehicles"] == 23
    assert row["Weekend_Traffic"] == 0 and row["Weekday_Traffic"] == 11.5


def test_first_junctions_and_slices(readings):
    frame = readings(*[(j, 1, j, j) for j in range(1, 9)])
    assert values(patterns.timeseries_first(frame), "Junction") == [(j,) for j in range(1, 6)]
    assert values(patterns.junction_slice(frame, 3), "Junction") == [(3,)]
    assert values(patterns.junction_slice(frame, patterns.top_junctions(frame, 2)), "Junction") == [(7,), (8,)]


@pytest.mark.parametrize("rows_at_end, ranges", [(100_000, 256), (20, 4), (1, 2), (7, 256)])
def test_quantiles_of_all_keys_side_by_side(spark, rows_at_end, ranges):
    """Fractional values, repeated ones, a key with one value, one without any, and a null key."""
    rng = np.random.default_rng(9)
    groups = {1: rng.exponential(30, 400), 2: np.repeat([1.5, 2.5, 9.0], [30, 1, 50]), 3: [4.25], None: rng.normal(size=60), 5: []}
    rows = [(k, float(v)) for k, values_ in groups.items() for v in values_] + [(5, None), (1, None)]
    counts = value_counts(spark.createDataFrame(rows, "Junction bigint, Vehicles double"), "Junction")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    found = quantiles_by_key(counts, "Junction", probs=probs, rows_at_end=rows_at_end, ranges=ranges)
    got = {r["Junction"]: r["Quantiles"] for r in found.collect()}
    assert set(got) == set(groups) and got[5] is None
    for key, values_ in groups.items():
        if key != 5:
            assert got[key] == pytest.approx(np.quantile(values_, probs), abs=1e-12)


def test_quantiles_of_no_rows(spark):
    counts = value_counts(spark.createDataFrame([], "Junction bigint, Vehicles double"), "Junction")
    assert quantiles_by_key(counts, "Junction", probs=(0.5,)).count() == 0


def test_spread_over_many_tasks_equals_the_plain_one(spark, readings):
    frame = readings(*[(i, i % 50, i % 3, (i * 37) % 101) for i in range(400)], (1000, 5, 2, None))
    for run in (patterns.junction_spread, patterns.junction_describe, patterns.boxplot_stats, patterns.boxplot_outliers):
        plain, spread = run(frame), run(frame, spread_values=True)
        assert plain.columns == spread.columns and plain.dtypes == spread.dtypes
        assert values(plain, *plain.columns) == values(spread, *plain.columns)
