import pytest

from sitepulse.functions.temporal import add_calendar
from sitepulse.operators import recommend, rules
from tests.conftest import values

# The advice texts.
FLYOVER = 'Priority Intersection: Consider constructing a flyover or deploying traffic police during peak hours.'
INBOUND = 'Commuter Route: Optimize signal timing for inbound traffic 08:00-10:00.'
LEISURE = 'Leisure Zone: Expect delays near shopping/recreational areas on Saturdays.'
ADAPTIVE = 'Moderate Congestion: Implement adaptive signal control systems to dynamically adjust timing based on real-time flow.'
QUIET = 'Low Traffic Zone: Maintain current signal timings. Consider reducing cycle time to improve pedestrian crossing efficiency.'
BALANCED = 'Balanced Traffic: Similar morning and evening peaks detected. Use time-of-day signal plans with consistent green time allocation.'
OUTBOUND = 'Evening Rush Dominant: Optimize signal timing for outbound traffic 17:00-19:00. Prioritize routes away from city center.'
NOTHING = 'No specific recommendations - traffic patterns are normal.'

PROFILE = "Junction bigint, Congestion_Level string, Morning_Peak double, Evening_Peak double, Weekend_Traffic double, Weekday_Traffic double"
CLUSTER_PROFILE = "Cluster int, CongestionLevel string, PeakHour int, AvgTraffic double, AvgStdDev double"


@pytest.mark.parametrize(
    "profile, texts",
    [
        (("High Congestion", 65.5, 48.3, 35.2, 52.8), [FLYOVER, INBOUND]),
        (("Low Congestion", 50.0, 45.0, 0.0, 0.0), [INBOUND, QUIET, BALANCED]),
        (("Medium Traffic", 10.0, 30.0, 9.0, 8.0), [LEISURE, ADAPTIVE, OUTBOUND]),
        (("Medium Traffic", 20.0, 20.0, 8.0, 8.0), [ADAPTIVE, BALANCED]),
        (("Level 4", 0.0, 0.0, 5.0, 0.0), []),
    ],
)
def test_advice(spark, profile, texts):
    frame = spark.createDataFrame([(1, *profile)], PROFILE)
    row = recommend.recommendations(frame).first()
    assert row["Recommendations"] == texts and row["Num_Recommendations"] == len(texts)
    export = recommend.recommendations_export(recommend.recommendations(frame)).first()
    assert export["Recommendations"] == (" | ".join(texts) or "None")
    lines = recommend.recommendation_lines(recommend.recommendations(frame))
    assert values(lines, "Line", "Recommendation") == list(enumerate(texts or [NOTHING], 1))


def test_missing_columns(spark):
    row = recommend.recommendations(spark.createDataFrame([(1, 2)], "Junction bigint, Cluster int")).first()
    assert (row["Congestion_Level"], row["Recommendations"]) == ("2", [])
    row = recommend.recommendations(spark.createDataFrame([(1,)], "Junction bigint")).first()
    assert row["Congestion_Level"] == "Unknown"


@pytest.fixture
def ruled(spark, readings):
    def make(level, rows, junctions=(1,), peak=8, mean=10.0, deviation=6.0):
        data = add_calendar(readings(*rows))
        profile = spark.createDataFrame([(0, level, peak, mean, deviation)], CLUSTER_PROFILE)
        assigned = spark.createDataFrame([(j, 0) for j in junctions], "Junction bigint, Cluster int")
        found = rules.rules(profile, data, assigned).collect()
        return {row["rule_type"]: row for row in found}, [row["rule_no"] for row in found]

    return make


MONDAY, SATURDAY = 0, 120


def test_high_level_with_all_rules(ruled):
    rows = [(1, MONDAY + 8, 1, 90), (2, MONDAY + 18, 1, 90), (3, MONDAY + 1, 1, 10), (4, MONDAY + 2, 1, 10),
            (5, SATURDAY + 2, 1, 2)]
    found, numbers = ruled("Medium-High Congestion", rows)
    assert numbers == [1, 2, 3, 4, 5]
    peak = found["Peak Hour Management"]
    assert peak["priority"] == "Critical" and peak["implementation_time"] == "07:00 - 09:00 daily"
    assert peak["specific_action"] == (
        "At Junction 1: Extend green light phase by 40-50% at 08:00. Consider implementing adaptive signal control."
    )
    assert found["Signal Timing Strategy"]["description"].endswith("High variability (σ=6.0) indicates fluctuating traffic patterns.")
    morning = found["Morning Rush Hour Strategy"]
    mean = (90 + 90 + 10 + 10 + 2) / 5
    assert f"(90.0 vehicles/hour, {(90 / mean - 1) * 100:.1f}% above average)" in morning["description"]
    weekend = found["Weekend Traffic Management"]
    assert weekend["priority"] == "Low"
    assert weekend["description"] == "Weekend traffic is 96.0% lower than weekdays (2.0 vs 50.0 vehicles/hour)."
    assert "by 20-30% on weekends" in weekend["specific_action"]


def test_low_level_with_fixed_rules_only(ruled):
    found, numbers = ruled("Low Congestion", [(1, MONDAY, 1, 5), (2, SATURDAY, 1, 5)], deviation=5.0)
    assert set(found) == {"Peak Hour Management", "Signal Timing Strategy"} and numbers == [1, 2]
    assert found["Signal Timing Strategy"]["priority"] == "Medium"
    assert "60-90 seconds. Use Fixed with Time-of-Day" in found["Signal Timing Strategy"]["specific_action"]


@pytest.mark.parametrize("peak, window", [(0, "00:00 - 01:00 daily"), (23, "22:00 - 23:00 daily")])
def test_peak_window_does_not_wrap(ruled, peak, window):
    found, _ = ruled("Low Congestion", [(1, MONDAY, 1, 5)], peak=peak)
    assert found["Peak Hour Management"]["implementation_time"] == window


def test_weekend_rule_edges(ruled):
    assert "Weekend Traffic Management" not in ruled("Low", [(1, SATURDAY, 1, 5)])[0]
    assert "Weekend Traffic Management" not in ruled("Low", [(1, SATURDAY, 1, 0), (2, MONDAY, 1, 0)])[0]
    found, _ = ruled("Low", [(1, SATURDAY, 1, 5), (2, MONDAY, 1, 0)])
    assert found["Weekend Traffic Management"]["priority"] == "Medium"
    assert "inf% higher" in found["Weekend Traffic Management"]["description"]


def test_member_list_is_short(ruled):
    found, _ = ruled("Low", [(1, MONDAY, 1, 5)], junctions=range(1, 8))
    assert "At Junction 1, Junction 2, Junction 3, Junction 4, Junction 5 and 2 others:" in (
        found["Signal Timing Strategy"]["specific_action"]
    )


def test_filters(spark):
    frame = spark.createDataFrame([(0, "High"), (1, "High"), (1, "Low")], "cluster_id int, priority string")
    assert values(rules.filter_rules(frame, ["High"]), "cluster_id") == [(0,), (1,)]
    assert values(rules.filter_rules(frame, clusters=[1]), "priority") == [("High",), ("Low",)]
    assert tuple(rules.filter_counts(frame, ["High"], [1]).first()) == (1, 3)
