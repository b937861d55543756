import random

import pytest
from pyspark.sql import functions as F

from sitepulse.functions.distribution import quantiles, value_counts
from sitepulse.functions.numeric import one_decimal, round_half_even
from sitepulse.functions.temporal import add_calendar, date_range
from tests.conftest import values


def test_round_half_even(spark):
    row = spark.range(1).select(round_half_even(F.lit(0.125)).alias("a"), round_half_even(F.lit(0.375)).alias("b")).first()
    assert tuple(row) == (0.12, 0.38)


def test_one_decimal_equals_python(spark):
    rng = random.Random(1)
    numbers = [0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 2.25, 2.35, 99.95, 12345.65]
    numbers += [rng.randrange(100_000) / 20 for _ in range(2000)] + [rng.random() * 1000 for _ in range(2000)]
    frame = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", one_decimal(F.col("x")).alias("t"))
    assert [(r["x"], r["t"]) for r in frame.collect() if r["t"] != f"{r['x']:.1f}"] == []


def test_one_decimal_of_infinity(spark):
    assert spark.range(1).select(one_decimal(F.lit(float("inf")))).first()[0] == "inf"


def test_quartiles(readings):
    frame = readings(*[(i, i, 1, v) for i, v in enumerate([1, 2, 3, 10])], (9, 9, 1, None))
    row = quantiles(value_counts(frame, "Junction"), "Junction", probs=(0.25, 0.5, 0.75)).first()
    assert list(row["Quantiles"]) == [1.75, 2.5, 4.75]


def test_periods(readings):
    hours = {6: "Early Morning", 7: "Morning Rush", 9: "Morning Rush", 10: "Midday", 16: "Midday", 17: "Evening Rush",
             19: "Evening Rush", 20: "Night"}
    frame = add_calendar(readings(*[(h, h, 1, 1) for h in hours]), with_period=True)
    assert {row["Hour"]: row["PeriodOfDay"] for row in frame.collect()} == hours


def test_weekend_edges(readings):
    frame = add_calendar(
        readings(
            (1, "2024-01-05 23:00:00", 1, 1),
            (2, "2024-01-06 00:00:00", 1, 1),
            (3, "2024-01-07 23:00:00", 1, 1),
            (4, "2024-01-08 00:00:00", 1, 1),
        )
    )
    assert values(frame, "ID", "IsWeekend", "DayOfWeek") == [(1, 0, 4), (2, 1, 5), (3, 1, 6), (4, 0, 0)]


def test_date_range_includes_both_days(readings):
    frame = readings(
        (1, "2024-01-04 23:59:59", 1, 1),
        (2, "2024-01-05 00:00:00", 1, 1),
        (3, "2024-01-06 23:59:59", 1, 1),
        (4, "2024-01-07 00:00:00", 1, 1),
    )
    assert values(date_range(frame, "2024-01-05", "2024-01-06"), "ID") == [(2,), (3,)]


def test_date_range_reaches_the_scan(spark, readings, tmp_path):
    readings((1, 1, 1, 1)).write.parquet(str(tmp_path / "r"))
    plan = date_range(spark.read.parquet(str(tmp_path / "r")), "2024-01-05", "2024-01-06")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(DateTime" in text and "LessThan(DateTime" in text


@pytest.mark.parametrize("rows", [[], [(1, 1, 1, None)]])
def test_quantiles_without_values(readings, rows):
    found = quantiles(value_counts(readings(*rows)), probs=(0.5,)).collect() if rows else []
    assert all(row["Quantiles"] is None for row in found)
