"""Operating rules per cluster from its profile and the readings of its members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions.numeric import one_decimal
from sitepulse.operators.clusters import cluster_cube, first_members
from sitepulse.operators.patterns import cube_mean

RULE_FIELDS = [
    "cluster_id",
    "congestion_level",
    "rule_type",
    "priority",
    "description",
    "specific_action",
    "expected_impact",
    "implementation_time",
]
SHOWN_JUNCTIONS = 5

# Names, priorities and texts of the rules. Triples go from high over medium to low
# congestion; %s and %d are filled in.
LEVEL_PRIORITIES = ("Critical", "High", "Medium")

PEAK_TYPE = "Peak Hour Management"
PEAK_INCREASES = ("40-50%", "25-35%", "10-15%")
PEAK_EXTRAS = (
    "Consider implementing adaptive signal control",
    "Monitor traffic flow and adjust as needed",
    "Maintain standard signal timing with minor adjustments",
)
PEAK_WINDOW = "%02d:00 - %02d:00"
PEAK_DESCRIPTION = "Increase green signal duration by %s during peak hours (%s) at junctions in %s areas."
PEAK_ACTION = "At %s: Extend green light phase by %s at %02d:00. %s."
PEAK_IMPACT = "Reduce queue length and waiting time during peak congestion"

SIGNAL_TYPE = "Signal Timing Strategy"
SIGNAL_CYCLES = ("120-150 seconds", "90-120 seconds", "60-90 seconds")
SIGNAL_VARIED = (
    "Implement adaptive signal timing that responds to real-time traffic conditions. "
    "High variability (σ=%s) indicates fluctuating traffic patterns."
)
SIGNAL_STEADY = (
    "Use time-of-day signal timing plans with consistent patterns. "
    "Low variability (σ=%s) indicates predictable traffic."
)
SIGNAL_VARIED_SYSTEM = "Adaptive/Dynamic"
SIGNAL_STEADY_SYSTEM = "Fixed with Time-of-Day"
SIGNAL_ACTION = "At %s: Set signal cycle length to %s. Use %s signal control system."
SIGNAL_IMPACT = "Optimize traffic flow and minimize delays"
SIGNAL_TIME = "Continuous"

MORNING_TYPE = "Morning Rush Hour Strategy"
MORNING_ACTIONS = (
    "Deploy traffic officers and consider reversible lanes",
    "Increase signal green time by 30% for main routes",
    "Monitor traffic flow and maintain standard timing",
)
MORNING_DESCRIPTION = (
    "Morning rush hour (06:00-10:00) shows elevated traffic (%s vehicles/hour, %s%% above average)."
)
MORNING_ACTION = "At %s: %s. Prioritize routes toward city center/business districts."
MORNING_IMPACT = "Reduce morning commute delays by 15-25%"
MORNING_TIME = "06:00-10:00 on weekdays"

EVENING_TYPE = "Evening Rush Hour Strategy"
EVENING_ACTIONS = (
    "Maximize outbound route capacity and extend green times by 40%",
    "Increase signal green time by 30% for outbound routes",
    "Adjust timing to favor outbound traffic flow",
)
EVENING_DESCRIPTION = (
    "Evening rush hour (16:00-20:00) shows elevated traffic (%s vehicles/hour, %s%% above average)."
)
EVENING_ACTION = "At %s: %s. Prioritize routes away from city center/toward residential areas."
EVENING_IMPACT = "Reduce evening commute delays by 15-25%"
EVENING_TIME = "16:00-20:00 on weekdays"

WEEKEND_TYPE = "Weekend Traffic Management"
WEEKEND_LOWER = "Weekend traffic is %s%% lower than weekdays (%s vs %s vehicles/hour)."
WEEKEND_LOWER_ACTION = (
    "At %s: Reduce signal cycle lengths by 20-30%% on weekends. "
    "Consider using pedestrian-priority timing in retail/leisure areas."
)
WEEKEND_LOWER_IMPACT = "Improve pedestrian flow and reduce unnecessary delays"
WEEKEND_HIGHER = "Weekend traffic is %s%% higher than weekdays (%s vs %s vehicles/hour)."
WEEKEND_HIGHER_ACTION = (
    "At %s: Increase signal capacity on weekends. Focus on routes to shopping/entertainment districts."
)
WEEKEND_HIGHER_IMPACT = "Prevent weekend congestion buildup"
WEEKEND_TIME = "Saturdays and Sundays"


def cluster_traffic(data: DataFrame, assignments: DataFrame) -> DataFrame:
    """Per cluster: mean of all readings, of 6-10 and 16-20 o'clock, and of both day types."""
    hour, weekend = F.col("Hour"), F.col("IsWeekend") == 1
    return (
        cluster_cube(data, assignments)
        .where(F.col("Cluster").isNotNull())
        .groupBy("Cluster")
        .agg(
            cube_mean().alias("row_mean"),
            cube_mean(hour.between(6, 10)).alias("morning"),
            cube_mean(hour.between(16, 20)).alias("evening"),
            cube_mean(weekend).alias("weekend"),
            cube_mean(~weekend).alias("weekday"),
        )
    )


def member_text(assignments: DataFrame) -> DataFrame:
    """Per cluster "Junction a, Junction b" with at most five ids and the number of others.

    Only the first ids of a cluster are gathered, the rest is counted.
    """
    sizes = assignments.groupBy("Cluster").agg(F.count(F.lit(1)).alias("n"))
    shown = (
        first_members(assignments, SHOWN_JUNCTIONS)
        .groupBy("Cluster")
        .agg(F.sort_array(F.collect_list("Junction")).alias("ids"))
    )
    names = F.array_join(F.transform("ids", lambda j: F.concat(F.lit("Junction "), j.cast("string"))), ", ")
    rest = F.col("n") - SHOWN_JUNCTIONS
    text = F.when(rest > 0, F.format_string("%s and %d others", names, rest)).otherwise(names)
    return shown.join(sizes, "Cluster").select("Cluster", text.alias("members"))


def _by_level(texts: tuple[str, str, str]) -> Column:
    level, (high, medium, low) = F.col("CongestionLevel"), texts
    return F.when(level.contains("High"), high).when(level.contains("Medium"), medium).otherwise(low)


def _rule(rule_type: str, priority, description, action, impact: str, when) -> Column:
    """One rule as a struct; texts may be strings or columns."""
    values = [rule_type, priority, description, action, impact, when]
    columns = [v if isinstance(v, Column) else F.lit(v) for v in values]
    return F.struct(
        F.col("Cluster").alias("cluster_id"),
        F.col("CongestionLevel").alias("congestion_level"),
        *[c.alias(name) for c, name in zip(columns, RULE_FIELDS[2:])],
    )


def peak_hour_rule() -> Column:
    """Longer green around the peak hour; the window does not wrap at midnight."""
    peak = F.col("PeakHour").cast("int")
    window = F.format_string(PEAK_WINDOW, F.greatest(peak - 1, F.lit(0)), F.least(peak + 1, F.lit(23)))
    increase = _by_level(PEAK_INCREASES)
    return _rule(
        PEAK_TYPE,
        _by_level(LEVEL_PRIORITIES),
        F.format_string(PEAK_DESCRIPTION, increase, window, F.col("CongestionLevel")),
        F.format_string(PEAK_ACTION, F.col("members"), increase, peak, _by_level(PEAK_EXTRAS)),
        PEAK_IMPACT,
        F.concat(window, F.lit(" daily")),
    )


def signal_timing_rule() -> Column:
    """Adaptive signals where the deviation exceeds half the mean, fixed plans elsewhere."""
    varied = F.col("AvgStdDev") > F.col("AvgTraffic") * 0.5

    def either(if_varied, if_steady) -> Column:
        return F.when(varied, if_varied).otherwise(if_steady)

    deviation = one_decimal(F.col("AvgStdDev"))
    return _rule(
        SIGNAL_TYPE,
        either("High", "Medium"),
        either(F.format_string(SIGNAL_VARIED, deviation), F.format_string(SIGNAL_STEADY, deviation)),
        F.format_string(
            SIGNAL_ACTION,
            F.col("members"),
            _by_level(SIGNAL_CYCLES),
            either(SIGNAL_VARIED_SYSTEM, SIGNAL_STEADY_SYSTEM),
        ),
        SIGNAL_IMPACT,
        SIGNAL_TIME,
    )


def _rush_rule(rule_type: str, mean: Column, description: str, action: str, actions: tuple, impact: str, when: str) -> Column:
    """A rule for hours whose mean exceeds the mean of all hours by a fifth."""
    above = (F.try_divide(mean, F.col("row_mean")) - 1) * 100
    rule = _rule(
        rule_type,
        _by_level(LEVEL_PRIORITIES),
        F.format_string(description, one_decimal(mean), one_decimal(above)),
        F.format_string(action, F.col("members"), _by_level(actions)),
        impact,
        when,
    )
    return F.when((mean > F.col("row_mean") * 1.2) & (F.col("row_mean") != 0), rule)


def rush_hour_rules() -> list[Column]:
    """The morning and the evening rule."""
    return [
        _rush_rule(
            MORNING_TYPE, F.col("morning"), MORNING_DESCRIPTION, MORNING_ACTION, MORNING_ACTIONS, MORNING_IMPACT, MORNING_TIME
        ),
        _rush_rule(
            EVENING_TYPE, F.col("evening"), EVENING_DESCRIPTION, EVENING_ACTION, EVENING_ACTIONS, EVENING_IMPACT, EVENING_TIME
        ),
    ]


def weekend_rule() -> Column:
    """A rule where weekends lie a fifth below or above weekdays, and none in between."""
    weekend, weekday = F.col("weekend"), F.col("weekday")
    # No weekday traffic but some at weekends is an unlimited ratio; none on either side is no rule.
    ratio = F.when((weekday == 0) & (weekend > 0), F.lit(float("inf"))).otherwise(F.try_divide(weekend, weekday))

    def rule(priority: str, change: Column, description: str, action: str, impact: str) -> Column:
        return _rule(
            WEEKEND_TYPE,
            priority,
            F.format_string(description, one_decimal(change * 100), one_decimal(weekend), one_decimal(weekday)),
            F.format_string(action, F.col("members")),
            impact,
            WEEKEND_TIME,
        )

    lower = rule("Low", 1 - ratio, WEEKEND_LOWER, WEEKEND_LOWER_ACTION, WEEKEND_LOWER_IMPACT)
    higher = rule("Medium", ratio - 1, WEEKEND_HIGHER, WEEKEND_HIGHER_ACTION, WEEKEND_HIGHER_IMPACT)
    return F.when(ratio < 0.8, lower).when(ratio > 1.2, higher)


def rule_inputs(profiles: DataFrame, data: DataFrame, assignments: DataFrame) -> DataFrame:
    """Cluster profiles with the traffic means and member texts that the rules use."""
    # All three tables have one row per cluster.
    return profiles.join(F.broadcast(cluster_traffic(data, assignments)), "Cluster", "left").join(
        F.broadcast(member_text(assignments)), "Cluster", "left"
    )


def rules(profiles: DataFrame, data: DataFrame, assignments: DataFrame) -> DataFrame:
    """All rules of all clusters with their number inside the cluster, in reporting order."""
    candidates = F.array_compact(
        F.array(peak_hour_rule(), signal_timing_rule(), *rush_hour_rules(), weekend_rule())
    )
    return (
        rule_inputs(profiles, data, assignments)
        .select(F.posexplode(candidates).alias("at", "rule"))
        .select((F.col("at") + 1).alias("rule_no"), *[F.col(f"rule.{f}").alias(f) for f in RULE_FIELDS])
        .orderBy("cluster_id", "rule_no")
    )


def _chosen(priorities: Sequence[str] | None, clusters: Sequence[int] | None) -> Column:
    wanted = F.lit(True)
    if priorities is not None:
        wanted = wanted & F.col("priority").isin(list(priorities))
    if clusters is not None:
        wanted = wanted & F.col("cluster_id").isin(list(clusters))
    return wanted


def filter_rules(
    all_rules: DataFrame,
    priorities: Sequence[str] | None = None,
    clusters: Sequence[int] | None = None,
) -> DataFrame:
    """Rules of the given priorities and clusters; None leaves a side open."""
    return all_rules.where(_chosen(priorities, clusters))


def filter_counts(
    all_rules: DataFrame, priorities: Sequence[str] | None = None, clusters: Sequence[int] | None = None
) -> DataFrame:
    """How many rules a filter shows, and how many there are, as one row."""
    return all_rules.agg(
        F.count_if(_chosen(priorities, clusters)).alias("Shown"), F.count(F.lit(1)).alias("Total")
    )


def rules_summary(all_rules: DataFrame) -> DataFrame:
    """The report lines: cluster heading and numbered rule texts."""
    return all_rules.select(
        F.col("cluster_id"),
        F.format_string("CLUSTER %d - %s", F.col("cluster_id").cast("bigint"), F.col("congestion_level")).alias("heading"),
        "rule_no",
        F.format_string("%d. %s [Priority: %s]", F.col("rule_no"), F.col("rule_type"), F.col("priority")).alias("title"),
        "description",
        F.col("specific_action").alias("action"),
        "expected_impact",
        F.col("implementation_time").alias("when"),
    )
