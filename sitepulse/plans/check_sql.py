"""DuckDB SQL that states the expected result of every query of the catalogue that SQL can state."""

from __future__ import annotations

from sitepulse.operators.profiles import HOUR_COLUMNS, PROFILE_FEATURES
from sitepulse.plans.catalog import WEEK

# The advice texts.
FLYOVER = 'Priority Intersection: Consider constructing a flyover or deploying traffic police during peak hours.'
INBOUND = 'Commuter Route: Optimize signal timing for inbound traffic 08:00-10:00.'
LEISURE = 'Leisure Zone: Expect delays near shopping/recreational areas on Saturdays.'
ADAPTIVE = 'Moderate Congestion: Implement adaptive signal control systems to dynamically adjust timing based on real-time flow.'
QUIET = 'Low Traffic Zone: Maintain current signal timings. Consider reducing cycle time to improve pedestrian crossing efficiency.'
BALANCED = 'Balanced Traffic: Similar morning and evening peaks detected. Use time-of-day signal plans with consistent green time allocation.'
OUTBOUND = 'Evening Rush Dominant: Optimize signal timing for outbound traffic 17:00-19:00. Prioritize routes away from city center.'
NOTHING = 'No specific recommendations - traffic patterns are normal.'

# --- building blocks -----------------------------------------------------------------------

CALENDAR = """
    CAST(hour(DateTime) AS INTEGER) AS "Hour",
    CAST(isodow(DateTime) - 1 AS INTEGER) AS DayOfWeek,
    CAST(month(DateTime) AS INTEGER) AS "Month",
    CAST(isodow(DateTime) >= 6 AS INTEGER) AS IsWeekend"""

PERIOD = """
    CASE WHEN hour(DateTime) <= 6 THEN 'Early Morning' WHEN hour(DateTime) <= 9 THEN 'Morning Rush'
         WHEN hour(DateTime) <= 16 THEN 'Midday' WHEN hour(DateTime) <= 19 THEN 'Evening Rush'
         ELSE 'Night' END AS PeriodOfDay"""

RAW = """
raw AS (
  SELECT event_id AS ID, date_trunc('hour', ts)::TIMESTAMP AS DateTime, user_id % 8 + 1 AS Junction,
         CAST(floor(value) AS BIGINT) AS Vehicles
  FROM events)"""
RAW_SITES = RAW.replace("user_id % 8 + 1", "user_id")

MERGED = """,
merged AS (
  SELECT Junction, DateTime, CAST(sum(Vehicles) AS BIGINT) AS Vehicles, min(ID) AS ID
  FROM raw GROUP BY Junction, DateTime)"""

SUMMED = MERGED + f""",
r AS (SELECT *, {CALENDAR} FROM merged)"""

SHAPED = MERGED + f""",
plain AS (SELECT *, {CALENDAR} FROM merged),
r AS (
  SELECT * REPLACE (CAST(Vehicles * CASE Junction % 3
      WHEN 0 THEN CASE WHEN "Hour" BETWEEN 6 AND 10 THEN 3 ELSE 1 END
      WHEN 1 THEN (CASE WHEN "Hour" BETWEEN 16 AND 20 THEN 3 ELSE 1 END) * (CASE WHEN IsWeekend = 1 THEN 2 ELSE 1 END)
      ELSE CASE WHEN IsWeekend = 1 THEN 1 ELSE 2 END END AS BIGINT) AS Vehicles)
  FROM plain)"""

_OFFSET = "CASE {junction} % 3 WHEN 0 THEN 0 WHEN 1 THEN 100000 ELSE 300000 END"
APART = SHAPED.replace(
    "ELSE 2 END END AS BIGINT) AS Vehicles)", f"ELSE 2 END END AS BIGINT) + {_OFFSET.format(junction='Junction')} AS Vehicles)"
)
LEVEL = SUMMED.replace("CAST(sum(Vehicles) AS BIGINT) AS Vehicles", "CAST(Junction * 100 AS BIGINT) AS Vehicles")

FENCES = """,
fences AS (
  SELECT Q1, Q3, Q3 - Q1 AS IQR, Q1 - 3 * (Q3 - Q1) AS LowerBound, Q3 + 3 * (Q3 - Q1) AS UpperBound
  FROM (SELECT quantile_cont(Vehicles::DOUBLE, 0.25) AS Q1, quantile_cont(Vehicles::DOUBLE, 0.75) AS Q3 FROM {table}))"""

FIRST = (
    """,
single AS (
  SELECT DateTime, Junction, Vehicles FROM raw
  QUALIFY row_number() OVER (PARTITION BY Junction, DateTime ORDER BY ID) = 1)"""
    + FENCES.format(table="single")
    + f""",
r AS (
  SELECT DateTime, Junction, greatest(least(Vehicles::DOUBLE, UpperBound), LowerBound) AS Vehicles, {CALENDAR}, {PERIOD}
  FROM single, fences)"""
)

ASSIGNED = """,
assigned AS (SELECT DISTINCT Junction, CAST(Junction % 3 AS INTEGER) AS Cluster FROM r)"""


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round_even({expression}, {digits}) AS {name}"


def over_raw(select: str, extra: str = "", sites: bool = False) -> str:
    return f"WITH {RAW_SITES if sites else RAW}{extra} {select}"


def over_sum(select: str, extra: str = "", sites: bool = False) -> str:
    return over_raw(select, SUMMED + extra, sites)


def over_shaped(select: str, extra: str = "") -> str:
    return over_raw(select, SHAPED + extra)


def over_first(select: str) -> str:
    return over_raw(select, FIRST)


# --- junction tables -----------------------------------------------------------------------

_HOURS = ", ".join(
    f'coalesce(avg(CASE WHEN "Hour" = {h} THEN Vehicles END), 0) AS {c}' for h, c in enumerate(HOUR_COLUMNS)
)

FEATURES = f""",
hourly AS (SELECT Junction, "Hour", avg(Vehicles) AS m FROM r GROUP BY ALL),
peaks AS (
  SELECT Junction, "Hour" AS PeakHour, m AS PeakHourTraffic FROM hourly
  QUALIFY row_number() OVER (PARTITION BY Junction ORDER BY m DESC, "Hour") = 1),
features AS (
  SELECT Junction, {_HOURS},
    round_even(avg(Vehicles), 2) AS Vehicles_mean,
    coalesce(round_even(stddev_samp(Vehicles), 2), 0) AS Vehicles_std,
    min(Vehicles) AS Vehicles_min, max(Vehicles) AS Vehicles_max,
    round_even(quantile_cont(Vehicles::DOUBLE, 0.5), 2) AS Vehicles_median,
    any_value(PeakHour) AS PeakHour, any_value(PeakHourTraffic) AS PeakHourTraffic,
    coalesce(avg(CASE WHEN IsWeekend = 1 THEN Vehicles END), 0) AS Weekend_Avg,
    coalesce(avg(CASE WHEN IsWeekend = 0 THEN Vehicles END), 0) AS Weekday_Avg,
    coalesce(round_even(avg(CASE WHEN IsWeekend = 1 THEN Vehicles END)
      / nullif(avg(CASE WHEN IsWeekend = 0 THEN Vehicles END), 0), 2), 0) AS Weekend_Weekday_Ratio
  FROM r JOIN peaks USING (Junction) GROUP BY Junction)"""

_STATS = ["Vehicles_mean", "Vehicles_std", "Vehicles_median", "PeakHourTraffic"]
_RATIOS = ["Weekend_Avg", "Weekday_Avg", "Weekend_Weekday_Ratio"]


def _same(columns: list[str]) -> str:
    return ", ".join(_r(c, c) for c in columns)


SELECT_FEATURES = (
    f"SELECT Junction, Vehicles_min, Vehicles_max, PeakHour, {_same([*HOUR_COLUMNS, *_STATS, *_RATIOS])} FROM features"
)

PROFILES = """,
profiles AS (
  SELECT Junction, avg(Vehicles) AS Avg_Vehicles, max(Vehicles) AS Max_Vehicles,
    coalesce(avg(CASE WHEN "Hour" BETWEEN 8 AND 10 THEN Vehicles END), 0) AS Morning_Peak,
    coalesce(avg(CASE WHEN "Hour" BETWEEN 17 AND 19 THEN Vehicles END), 0) AS Evening_Peak,
    coalesce(avg(CASE WHEN IsWeekend = 1 THEN Vehicles END), 0) AS Weekend_Traffic,
    coalesce(avg(CASE WHEN IsWeekend = 0 THEN Vehicles END), 0) AS Weekday_Traffic
  FROM r GROUP BY Junction)"""

LABELLED = ASSIGNED + PROFILES + """,
ranked AS (
  SELECT Cluster, row_number() OVER (ORDER BY avg(Avg_Vehicles), Cluster) AS pos
  FROM profiles JOIN assigned USING (Junction) GROUP BY Cluster),
labelled AS (
  SELECT p.*, Cluster,
    CASE pos WHEN 1 THEN 'Low Congestion' WHEN 2 THEN 'Medium Traffic' WHEN 3 THEN 'High Congestion' END AS Congestion_Level
  FROM profiles p JOIN assigned USING (Junction) JOIN ranked USING (Cluster))"""

_CLUSTER_HOURS = ", ".join(f"avg({c}) AS {c}" for c in HOUR_COLUMNS)
_PEAKS = "greatest(" + ", ".join(HOUR_COLUMNS) + ")"
_AT_PEAK = "CASE " + " ".join(f"WHEN {c} = {_PEAKS} THEN {h}" for h, c in enumerate(HOUR_COLUMNS)) + " END"

CLUSTER_PROFILES = ASSIGNED + FEATURES + f""",
shapes AS (
  SELECT Cluster, count(*) AS NumJunctions, avg(Vehicles_mean) AS AvgTraffic, avg(Vehicles_std) AS AvgStdDev,
    avg(Vehicles_max) AS AvgMaxTraffic, avg(Weekend_Weekday_Ratio) AS AvgWeekendWeekdayRatio, {_CLUSTER_HOURS}
  FROM features JOIN assigned USING (Junction) GROUP BY Cluster),
cluster_profiles AS (
  SELECT Cluster, NumJunctions, AvgTraffic, AvgStdDev, AvgMaxTraffic, CAST({_AT_PEAK} AS INTEGER) AS PeakHour,
    {_PEAKS} AS PeakHourAvgTraffic, AvgWeekendWeekdayRatio,
    CASE row_number() OVER (ORDER BY AvgTraffic, Cluster) WHEN 1 THEN 'Low Congestion'
      WHEN 2 THEN 'Medium Congestion' WHEN 3 THEN 'High Congestion' END AS CongestionLevel
  FROM shapes)"""

# --- scores --------------------------------------------------------------------------------

_SCALED = ", ".join(
    f"coalesce(({c} - (SELECT avg({c}) FROM profiles)) / nullif((SELECT stddev_pop({c}) FROM profiles), 0), 0) AS {c}"
    for c in PROFILE_FEATURES
)
SCALED = PROFILES + f""",
scaled AS (SELECT Junction, CAST(Junction % 3 AS INTEGER) AS Cluster, {_SCALED} FROM profiles)"""

_GAP = " + ".join(f"(x.{c} - y.{c}) ** 2" for c in PROFILE_FEATURES)

SILHOUETTE = SCALED + f""",
sums AS (
  SELECT x.Junction, x.Cluster, y.Cluster AS facing, sum(sqrt({_GAP})) AS total, count(*) AS n
  FROM scaled x, scaled y GROUP BY ALL),
parts AS (
  SELECT Junction, max(CASE WHEN facing = Cluster THEN total / nullif(n - 1, 0) END) AS a,
    min(CASE WHEN facing <> Cluster THEN total / n END) AS b FROM sums GROUP BY Junction)"""
SELECT_SILHOUETTE = (
    "SELECT round_even(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS Silhouette FROM parts"
)

_CENTRE = ", ".join(f"avg({c}) AS {c}" for c in PROFILE_FEATURES)
DAVIES = SCALED + f""",
centre AS (SELECT Cluster, {_CENTRE} FROM scaled GROUP BY Cluster),
radius AS (
  SELECT x.Cluster, avg(sqrt({_GAP})) AS s FROM scaled x JOIN centre y USING (Cluster) GROUP BY x.Cluster),
worst AS (
  SELECT x.Cluster, max((rx.s + ry.s) / sqrt({_GAP})) AS w
  FROM centre x JOIN radius rx USING (Cluster), centre y JOIN radius ry ON ry.Cluster = y.Cluster
  WHERE x.Cluster <> y.Cluster GROUP BY x.Cluster)"""
SELECT_DAVIES = "SELECT round_even(avg(w), 6) AS Davies_Bouldin FROM worst"

# --- forecasting ---------------------------------------------------------------------------

LAGGED = """,
lagged AS (
  SELECT * FROM (
    SELECT *, lag(Vehicles, 1) OVER w AS Traffic_Last_Hour, lag(Vehicles, 24) OVER w AS Traffic_Yesterday_Same_Hour
    FROM r WINDOW w AS (PARTITION BY Junction ORDER BY DateTime))
  WHERE Traffic_Last_Hour IS NOT NULL AND Traffic_Yesterday_Same_Hour IS NOT NULL)"""

SPLIT = LAGGED + """,
split AS (
  SELECT *, CASE WHEN RowNo <= TrainRows THEN 'train' ELSE 'test' END AS Side FROM (
    SELECT *, CAST(floor(RowCount * 0.8::DOUBLE) AS BIGINT) AS TrainRows FROM (
      SELECT *, row_number() OVER (PARTITION BY Junction ORDER BY DateTime) AS RowNo,
        count(*) OVER (PARTITION BY Junction) AS RowCount FROM lagged)))"""

# --- advice --------------------------------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


ADVISED = LABELLED + f""",
advised AS (
  SELECT *, [x FOR x IN [
      CASE WHEN Congestion_Level = 'High Congestion' THEN {_text(FLYOVER)} END,
      CASE WHEN Morning_Peak > Evening_Peak THEN {_text(INBOUND)} END,
      CASE WHEN Weekend_Traffic > 0 AND Weekday_Traffic > 0 AND Weekend_Traffic > Weekday_Traffic
           THEN {_text(LEISURE)} END,
      CASE WHEN Congestion_Level = 'Medium Traffic' THEN {_text(ADAPTIVE)} END,
      CASE WHEN Congestion_Level = 'Low Congestion' THEN {_text(QUIET)} END,
      CASE WHEN Morning_Peak > 0 AND Evening_Peak > 0
            AND abs(Morning_Peak - Evening_Peak) / greatest(Morning_Peak, Evening_Peak) < 0.15
           THEN {_text(BALANCED)} END,
      CASE WHEN Evening_Peak > Morning_Peak THEN {_text(OUTBOUND)} END
    ] IF x IS NOT NULL] AS texts
  FROM labelled)"""

JOINED = "CASE WHEN len(texts) > 0 THEN array_to_string(texts, ' | ') ELSE 'None' END AS Recommendations"

# --- rules ---------------------------------------------------------------------------------


def _level(high: str, medium: str, low: str) -> str:
    return (
        f"CASE WHEN CongestionLevel LIKE '%High%' THEN '{high}' "
        f"WHEN CongestionLevel LIKE '%Medium%' THEN '{medium}' ELSE '{low}' END"
    )


def _one(expression: str) -> str:
    return f"printf('%.1f', {expression})"


_RULE_COLUMNS = (
    "rule_no, cluster_id, congestion_level, rule_type, priority, description, specific_action, expected_impact, "
    "implementation_time"
)
_WINDOW = "printf('%02d:00 - %02d:00', greatest(PeakHour - 1, 0), least(PeakHour + 1, 23))"
_EXTRA = _level("40-50%", "25-35%", "10-15%")
_VARIED = "AvgStdDev > AvgTraffic * 0.5"


def _rush(at: int, part: str, hours: str, column: str, action: str, goal: str) -> str:
    return f"""
  SELECT {at} AS pos, Cluster AS cluster_id, CongestionLevel AS congestion_level,
    '{part} Rush Hour Strategy' AS rule_type, {_level('Critical', 'High', 'Medium')} AS priority,
    '{part} rush hour ({hours}) shows elevated traffic (' || {_one(column)} || ' vehicles/hour, '
      || {_one(f'({column} / row_mean - 1) * 100')} || '% above average).' AS description,
    'At ' || members || ': ' || {action} || '. Prioritize routes {goal}.' AS specific_action,
    'Reduce {part.lower()} commute delays by 15-25%' AS expected_impact,
    '{hours} on weekdays' AS implementation_time
  FROM inputs WHERE {column} > row_mean * 1.2::DOUBLE"""


def _weekend(change: str, word: str, condition: str, priority: str, action: str, impact: str) -> str:
    return f"""
  SELECT 5 AS pos, Cluster, CongestionLevel, 'Weekend Traffic Management', '{priority}',
    'Weekend traffic is ' || {_one(f'({change}) * 100')} || '% {word} than weekdays (' || {_one('weekend')} || ' vs '
      || {_one('weekday')} || ' vehicles/hour).',
    'At ' || members || ': {action}', '{impact}', 'Saturdays and Sundays'
  FROM inputs WHERE {condition}"""


RULES = CLUSTER_PROFILES + f""",
traffic AS (
  SELECT Cluster, avg(Vehicles) AS row_mean,
    avg(CASE WHEN "Hour" BETWEEN 6 AND 10 THEN Vehicles END) AS morning,
    avg(CASE WHEN "Hour" BETWEEN 16 AND 20 THEN Vehicles END) AS evening,
    avg(CASE WHEN IsWeekend = 1 THEN Vehicles END) AS weekend,
    avg(CASE WHEN IsWeekend = 0 THEN Vehicles END) AS weekday
  FROM r JOIN assigned USING (Junction) GROUP BY Cluster),
lists AS (SELECT Cluster, list(Junction ORDER BY Junction) AS ids FROM assigned GROUP BY Cluster),
member_texts AS (
  SELECT Cluster, array_to_string(['Junction ' || j FOR j IN ids[1:5]], ', ')
    || CASE WHEN len(ids) > 5 THEN ' and ' || (len(ids) - 5) || ' others' ELSE '' END AS members FROM lists),
inputs AS (SELECT * FROM cluster_profiles JOIN traffic USING (Cluster) JOIN member_texts USING (Cluster)),
candidates AS (
  {_rush(3, 'Morning', '06:00-10:00', 'morning', _level(
      'Deploy traffic officers and consider reversible lanes',
      'Increase signal green time by 30% for main routes',
      'Monitor traffic flow and maintain standard timing'), 'toward city center/business districts')}
  UNION ALL {_rush(4, 'Evening', '16:00-20:00', 'evening', _level(
      'Maximize outbound route capacity and extend green times by 40%',
      'Increase signal green time by 30% for outbound routes',
      'Adjust timing to favor outbound traffic flow'), 'away from city center/toward residential areas')}
  UNION ALL {_weekend('1 - weekend / weekday', 'lower', 'weekend / nullif(weekday, 0) < 0.8::DOUBLE', 'Low',
      'Reduce signal cycle lengths by 20-30% on weekends. Consider using pedestrian-priority timing in retail/leisure areas.',
      'Improve pedestrian flow and reduce unnecessary delays')}
  UNION ALL {_weekend('weekend / weekday - 1', 'higher', 'weekend / nullif(weekday, 0) > 1.2::DOUBLE', 'Medium',
      'Increase signal capacity on weekends. Focus on routes to shopping/entertainment districts.',
      'Prevent weekend congestion buildup')}
  UNION ALL SELECT 1, Cluster, CongestionLevel, 'Peak Hour Management', {_level('Critical', 'High', 'Medium')},
    'Increase green signal duration by ' || {_EXTRA} || ' during peak hours (' || {_WINDOW} || ') at junctions in '
      || CongestionLevel || ' areas.',
    'At ' || members || ': Extend green light phase by ' || {_EXTRA} || ' at ' || printf('%02d', PeakHour) || ':00. '
      || {_level('Consider implementing adaptive signal control', 'Monitor traffic flow and adjust as needed',
                 'Maintain standard signal timing with minor adjustments')} || '.',
    'Reduce queue length and waiting time during peak congestion', {_WINDOW} || ' daily'
  FROM inputs
  UNION ALL SELECT 2, Cluster, CongestionLevel, 'Signal Timing Strategy',
    CASE WHEN {_VARIED} THEN 'High' ELSE 'Medium' END,
    CASE WHEN {_VARIED}
      THEN 'Implement adaptive signal timing that responds to real-time traffic conditions. High variability (σ='
        || {_one('AvgStdDev')} || ') indicates fluctuating traffic patterns.'
      ELSE 'Use time-of-day signal timing plans with consistent patterns. Low variability (σ='
        || {_one('AvgStdDev')} || ') indicates predictable traffic.' END,
    'At ' || members || ': Set signal cycle length to '
      || {_level('120-150 seconds', '90-120 seconds', '60-90 seconds')} || '. Use '
      || CASE WHEN {_VARIED} THEN 'Adaptive/Dynamic' ELSE 'Fixed with Time-of-Day' END || ' signal control system.',
    'Optimize traffic flow and minimize delays', 'Continuous'
  FROM inputs),
rules AS (
  SELECT CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY pos) AS INTEGER) AS rule_no, * EXCLUDE (pos)
  FROM candidates)"""


def _rules(where: str = "true") -> str:
    return over_shaped(f"SELECT {_RULE_COLUMNS} FROM rules WHERE {where}", RULES)


_DAYS = ", ".join(f"coalesce(round_even(avg(CASE WHEN DayOfWeek = {d} THEN Vehicles END), 6), 0) AS Day_{d}" for d in range(7))
_AVG = _r("avg(Vehicles)", "Avg_Vehicles")
_SPREAD = """,
q AS (
  SELECT Junction, quantile_cont(Vehicles::DOUBLE, 0.25) AS Q1, quantile_cont(Vehicles::DOUBLE, 0.5) AS Median,
    quantile_cont(Vehicles::DOUBLE, 0.75) AS Q3 FROM r GROUP BY Junction),
m AS (
  SELECT Junction, count(*) AS n, round_even(avg(Vehicles), 6) AS Mean, round_even(stddev_samp(Vehicles), 6) AS Std,
    min(Vehicles) AS Min, max(Vehicles) AS Max FROM r GROUP BY Junction),
flagged AS (
  SELECT r.Junction, r.Vehicles, r.Vehicles BETWEEN Q1 - 1.5 * (Q3 - Q1) AND Q3 + 1.5 * (Q3 - Q1) AS inside
  FROM r JOIN q USING (Junction))"""
_BY_JUNCTION = "FROM q JOIN m USING (Junction) JOIN "

SQL: dict[str, str] = {
    # sources and sinks
    "load_readings": over_raw("SELECT ID, DateTime, Junction, Vehicles FROM raw"),
    "load_readings_without_id": over_raw("SELECT DateTime, Junction, Vehicles FROM raw"),
    "read_processed": over_sum("SELECT * FROM r"),
    "write_roundtrip": over_first("SELECT * FROM r"),
    # cleaning
    "load_readings_mixed_headers": over_raw("SELECT ID, DateTime, Junction, Vehicles FROM raw"),
    "dedup_first_null_id": over_raw(
        """SELECT * FROM (SELECT * REPLACE (CASE WHEN ID % 3 <> 0 THEN ID END AS ID) FROM raw)
           QUALIFY row_number() OVER (PARTITION BY Junction, DateTime ORDER BY ID NULLS LAST, Vehicles) = 1"""
    ),
    "prepare_without_id": over_first("SELECT * FROM r"),
    "process_traffic_data": over_sum("SELECT * FROM r"),
    "preprocess_pipeline": over_raw(SELECT_FEATURES, FIRST + FEATURES),
    "date_range_stored": over_first(
        f"SELECT * FROM r WHERE CAST(DateTime AS DATE) BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}'"
    ),
    "outlier_bounds_double": "WITH v AS (SELECT value AS Vehicles FROM events)" + FENCES.format(table="v") + " SELECT * FROM fences",
    "null_count": over_raw("SELECT count(*) AS Nulls FROM raw WHERE ID % 3 = 0 OR Vehicles IS NULL"),
    "fill_gaps": over_raw(
        """SELECT ID, DateTime, Junction, coalesce(v,
             last_value(v IGNORE NULLS) OVER (PARTITION BY Junction ORDER BY DateTime, ID
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             first_value(v IGNORE NULLS) OVER (PARTITION BY Junction ORDER BY DateTime, ID
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS Vehicles FROM gaps""",
        ", gaps AS (SELECT *, CASE WHEN ID % 3 <> 0 THEN Vehicles END AS v FROM raw)",
    ),
    "duplicate_count": over_raw(
        "SELECT CAST(sum(n - 1) AS BIGINT) AS Duplicates FROM (SELECT count(*) AS n FROM raw GROUP BY Junction, DateTime)"
    ),
    "dedup_sum": over_raw("SELECT * FROM merged", MERGED),
    "dedup_first": over_raw(
        "SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY Junction, DateTime ORDER BY ID) = 1"
    ),
    "outlier_bounds": over_raw("SELECT * FROM fences", FENCES.format(table="raw")),
    "outlier_count": over_raw(
        "SELECT count(*) AS Outliers FROM raw, fences WHERE Vehicles < LowerBound OR Vehicles > UpperBound",
        FENCES.format(table="raw"),
    ),
    "cap_outliers": over_raw(
        """SELECT ID, DateTime, Junction, greatest(least(Vehicles::DOUBLE, UpperBound), LowerBound) AS Vehicles
           FROM raw, fences""",
        FENCES.format(table="raw"),
    ),
    # calendar and slices
    "temporal_features": over_raw(f"SELECT *, {CALENDAR} FROM raw"),
    "period_of_day": over_first("SELECT * FROM r"),
    "date_range_slice": over_sum(f"SELECT * FROM r WHERE CAST(DateTime AS DATE) BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}'"),
    "timeseries_first5": over_sum(
        """SELECT Junction, DateTime, Vehicles FROM r
           WHERE Junction IN (SELECT DISTINCT Junction FROM r ORDER BY Junction LIMIT 5)"""
    ),
    "junction_slice": over_sum(
        """SELECT * FROM r WHERE Junction =
             (SELECT Junction FROM r GROUP BY Junction ORDER BY sum(Vehicles) DESC, Junction LIMIT 1)"""
    ),
    "cluster_slice": over_sum("SELECT r.* FROM r JOIN assigned USING (Junction) WHERE Cluster IN (0, 2)", ASSIGNED),
    # patterns
    "feature_stats": over_sum(
        """SELECT count(DISTINCT "Hour") AS Unique_Hours, count(DISTINCT DayOfWeek) AS Unique_Days,
             count(DISTINCT "Month") AS Unique_Months, CAST(sum(IsWeekend) AS BIGINT) AS Weekend_Records,
             round_even(sum(IsWeekend) * 100.0::DOUBLE / count(*), 6) AS Weekend_Pct FROM r"""
    ),
    "junction_volume": over_sum(
        """SELECT Junction, CAST(sum(Vehicles) AS BIGINT) AS Total_Vehicles, round_even(avg(Vehicles), 2) AS Avg_Vehicles,
             max(Vehicles) AS Max_Vehicles FROM r GROUP BY Junction"""
    ),
    "top_junctions": over_sum(
        """SELECT Junction, CAST(sum(Vehicles) AS BIGINT) AS Total_Vehicles, round_even(avg(Vehicles), 2) AS Avg_Vehicles,
             max(Vehicles) AS Max_Vehicles FROM r GROUP BY Junction ORDER BY Total_Vehicles DESC, Junction LIMIT 10""",
        sites=True,
    ),
    "overall_stats": over_sum(
        f"""SELECT count(*) AS Records, CAST(sum(Vehicles) AS BIGINT) AS Total_Vehicles, {_AVG},
             min(DateTime) AS "First", max(DateTime) AS "Last" FROM r"""
    ),
    "data_summary": over_first(
        """SELECT count(*) AS total_records, count(DISTINCT Junction) AS num_junctions,
             strftime(min(DateTime), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(DateTime), '%Y-%m-%d %H:%M:%S') AS "end",
             CAST(floor(epoch(max(DateTime) - min(DateTime)) / 86400) AS BIGINT) AS days,
             round_even(avg(Vehicles), 2) AS mean, round_even(quantile_cont(Vehicles, 0.5), 2) AS median,
             CAST(trunc(min(Vehicles)) AS BIGINT) AS min, CAST(trunc(max(Vehicles)) AS BIGINT) AS max FROM r"""
    ),
    "hourly_trend": over_sum(f'SELECT "Hour", Junction, {_AVG} FROM r GROUP BY ALL'),
    "peak_hour": over_sum(f"SELECT Junction, PeakHour, {_same(['PeakHourTraffic'])} FROM peaks", FEATURES),
    "weekly_pattern": over_sum(f"SELECT DayOfWeek, {_AVG} FROM r GROUP BY ALL"),
    "weekday_weekend_gap": over_sum(
        """SELECT round_even(d, 6) AS Weekday_Avg, round_even(e, 6) AS Weekend_Avg, round_even(abs(d - e), 6) AS Difference,
             round_even(abs(d - e) / nullif(d, 0) * 100, 6) AS Difference_Pct
           FROM (SELECT avg(CASE WHEN DayOfWeek < 5 THEN m END) AS d, avg(CASE WHEN DayOfWeek >= 5 THEN m END) AS e
                 FROM (SELECT DayOfWeek, avg(Vehicles) AS m FROM r GROUP BY DayOfWeek))"""
    ),
    "junction_spread": over_sum(
        f"""SELECT Junction, Mean, Median, Std, Q3 - Q1 AS IQR, Outliers {_BY_JUNCTION}
             (SELECT Junction, count(*) FILTER (NOT inside) AS Outliers FROM flagged GROUP BY Junction) USING (Junction)""",
        _SPREAD,
    ),
    "junction_describe": over_sum(
        'SELECT Junction, n AS "Count", Mean, Std, Min, Q1, Median, Q3, Max FROM q JOIN m USING (Junction)', _SPREAD
    ),
    "boxplot_stats": over_sum(
        f"""SELECT Junction, Q1, Median, Q3, Whisker_Low, Whisker_High, Outliers, Mean {_BY_JUNCTION}
             (SELECT Junction, min(Vehicles) FILTER (inside) AS Whisker_Low, max(Vehicles) FILTER (inside) AS Whisker_High,
                count(*) FILTER (NOT inside) AS Outliers FROM flagged GROUP BY Junction) USING (Junction)""",
        _SPREAD,
    ),
    "boxplot_outliers": over_sum(
        "SELECT Junction, Vehicles, count(*) AS Readings FROM flagged WHERE NOT inside GROUP BY ALL", _SPREAD
    ),
    "hourly_overall": over_sum(f'SELECT "Hour", {_AVG} FROM r GROUP BY ALL'),
    "hourly_daytype": over_sum(f'SELECT IsWeekend, "Hour", {_AVG} FROM r GROUP BY ALL'),
    "hourly_by_cluster": over_sum(
        f'SELECT Cluster, "Hour", {_AVG} FROM r JOIN assigned USING (Junction) GROUP BY ALL', ASSIGNED
    ),
    "heatmap_hour_dow": over_sum(f'SELECT "Hour", {_DAYS} FROM r GROUP BY "Hour"'),
    "heatmap_by_junction": over_sum(f'SELECT Junction, "Hour", {_DAYS} FROM r GROUP BY Junction, "Hour"'),
    "heatmap_by_cluster": over_sum(
        f'SELECT Cluster, "Hour", {_DAYS} FROM r JOIN assigned USING (Junction) GROUP BY Cluster, "Hour"', ASSIGNED
    ),
    "cluster_distribution": over_sum(
        """SELECT Cluster, count(*) AS NumJunctions, round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM assigned), 6)
             AS Percentage FROM assigned GROUP BY Cluster""",
        ASSIGNED,
        sites=True,
    ),
    "cluster_member_curves": over_sum(
        f"""SELECT Cluster, Junction, "Hour", {_AVG} FROM r JOIN (
              SELECT * FROM assigned QUALIFY row_number() OVER (PARTITION BY Cluster ORDER BY Junction) <= 5) USING (Junction)
            GROUP BY ALL""",
        ASSIGNED,
        sites=True,
    ),
    "vehicle_histogram": over_sum(
        """SELECT Junction, Bin, round_even(lo + Bin * (hi - lo) / 30, 6) AS Bin_Start,
             round_even(lo + (Bin + 1) * (hi - lo) / 30, 6) AS Bin_End, coalesce(n, 0) AS Readings, Mean
           FROM ranges CROSS JOIN bins LEFT JOIN filled USING (Junction, Bin)""",
        """,
bins AS (SELECT CAST(range AS INTEGER) AS Bin FROM range(30)),
ranges AS (
  SELECT Junction, CASE WHEN min(Vehicles) = max(Vehicles) THEN min(Vehicles) - 0.5::DOUBLE ELSE min(Vehicles)::DOUBLE END AS lo,
    CASE WHEN min(Vehicles) = max(Vehicles) THEN max(Vehicles) + 0.5::DOUBLE ELSE max(Vehicles)::DOUBLE END AS hi,
    round_even(avg(Vehicles), 6) AS Mean FROM r GROUP BY Junction),
filled AS (
  SELECT Junction, CAST(least(floor((Vehicles - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS Bin, count(*) AS n
  FROM r JOIN ranges USING (Junction) GROUP BY ALL)""",
    ),
    "weekly_by_junction": over_sum(f"SELECT Junction, DayOfWeek, {_AVG} FROM r GROUP BY ALL"),
    "junction_detail": over_shaped(
        """SELECT Junction, Records, round_even(a, 6) AS Avg_Vehicles, round_even(s, 6) AS Std_Vehicles, Max_Vehicles,
             round_even(d, 6) AS Weekday_Avg, round_even(e, 6) AS Weekend_Avg,
             CASE WHEN e > d THEN 'leisure zone' ELSE 'commuter route' END AS Verdict
           FROM (SELECT Junction, count(*) AS Records, avg(Vehicles) AS a, stddev_samp(Vehicles) AS s,
                   max(Vehicles) AS Max_Vehicles, avg(CASE WHEN IsWeekend = 0 THEN Vehicles END) AS d,
                   avg(CASE WHEN IsWeekend = 1 THEN Vehicles END) AS e FROM r GROUP BY Junction)"""
    ),
    "overview_metrics": over_shaped(
        """SELECT (SELECT count(*) FROM assigned) AS Total_Junctions, (SELECT count(*) FROM r) AS Total_Records,
             (SELECT count(*) FROM cluster_profiles) AS Num_Clusters, (SELECT count(*) FROM rules) AS Num_Rules""",
        RULES,
    ),
    "profile_points": over_shaped(
        f"""SELECT Junction, Max_Vehicles, {_same(['Avg_Vehicles', 'Morning_Peak', 'Evening_Peak'])}, Cluster,
              Congestion_Level FROM labelled""",
        LABELLED,
    ),
    "cluster_profile_bars": over_shaped(
        f"SELECT Cluster, CongestionLevel, PeakHour, NumJunctions, {_same(['AvgTraffic', 'AvgStdDev'])} FROM cluster_profiles",
        CLUSTER_PROFILES,
    ),
    "display_profiles": over_shaped(
        """SELECT Cluster, CongestionLevel AS "Congestion Level", NumJunctions AS Junctions,
             round_even(AvgTraffic, 1) AS "Avg Traffic", PeakHour || ':00' AS "Peak Hour" FROM cluster_profiles""",
        CLUSTER_PROFILES,
    ),
    # junction tables
    "junction_hour_pivot": over_sum(f"SELECT Junction, {_same(HOUR_COLUMNS)} FROM features", FEATURES),
    "junction_stats": over_sum(
        f"SELECT Junction, Vehicles_min, Vehicles_max, PeakHour, {_same(_STATS)} FROM features", FEATURES
    ),
    "weekend_ratio": over_sum(f"SELECT Junction, {_same(_RATIOS)} FROM features", FEATURES),
    "junction_features": over_sum(SELECT_FEATURES, FEATURES),
    "junction_features_sites": over_sum(SELECT_FEATURES, FEATURES, sites=True),
    "junction_profiles": over_sum(
        f"SELECT Junction, Max_Vehicles, {_same(['Avg_Vehicles', 'Morning_Peak', 'Evening_Peak'])} FROM profiles", PROFILES
    ),
    "enhanced_profiles": over_sum(
        f"""SELECT Junction, Max_Vehicles,
              {_same(['Avg_Vehicles', 'Morning_Peak', 'Evening_Peak', 'Weekend_Traffic', 'Weekday_Traffic'])} FROM profiles""",
        PROFILES,
        sites=True,
    ),
    "junction_lookup": over_shaped(
        f"""SELECT Junction, Cluster, CongestionLevel, PeakHour, {_same(['AvgTraffic'])}
            FROM assigned JOIN cluster_profiles USING (Cluster)""",
        CLUSTER_PROFILES,
    ),
    # clusters
    "standardized_features": over_sum(f"SELECT Junction, {_same(PROFILE_FEATURES)} FROM scaled", SCALED, sites=True),
    "cluster_labels": over_shaped("SELECT Junction, Cluster, Congestion_Level FROM labelled", LABELLED),
    "cluster_profiles": over_shaped(
        f"""SELECT Cluster, NumJunctions, PeakHour, CongestionLevel, {_same(
            ['AvgTraffic', 'AvgStdDev', 'AvgMaxTraffic', 'PeakHourAvgTraffic', 'AvgWeekendWeekdayRatio'])}
            FROM cluster_profiles""",
        CLUSTER_PROFILES,
    ),
    "cluster_centers": over_shaped(
        f"""SELECT Cluster, Congestion_Level AS Label, {', '.join(_r(f'avg({c})', c) for c in PROFILE_FEATURES)}
            FROM labelled GROUP BY Cluster, Congestion_Level""",
        LABELLED,
    ),
    "silhouette": over_sum(SELECT_SILHOUETTE, SILHOUETTE),
    "silhouette_sites": over_sum(SELECT_SILHOUETTE, SILHOUETTE, sites=True),
    "davies_bouldin": over_sum(SELECT_DAVIES, DAVIES),
    "davies_bouldin_sites": over_sum(SELECT_DAVIES, DAVIES, sites=True),
    # forecasting
    "lag_features": over_sum("SELECT * FROM lagged", LAGGED),
    "lag_features_sites": over_sum("SELECT * FROM lagged", LAGGED, sites=True),
    "chrono_split": over_sum("SELECT Junction, DateTime, RowNo, RowCount, Side FROM split", SPLIT),
    "split_report": over_sum(
        """SELECT Junction, Side, count(*) AS Records, min(DateTime) AS "First", max(DateTime) AS "Last"
           FROM split GROUP BY ALL""",
        SPLIT,
        sites=True,
    ),
    "forecast_metrics": over_sum(
        """SELECT Junction, Side, count(*) AS Records, round_even(avg(abs(Vehicles - p)), 6) AS MAE,
             CASE WHEN count(*) > 1 THEN round_even(1 - sum((Vehicles - p) ** 2) / nullif(var_pop(Vehicles) * count(*), 0), 6)
               END AS R2
           FROM (SELECT *, Traffic_Yesterday_Same_Hour::DOUBLE AS p FROM split) GROUP BY Junction, Side""",
        SPLIT,
    ),
    "actual_vs_predicted": over_sum(
        """SELECT Junction, RowNo - TrainRows AS TimeIndex, DateTime, Vehicles AS Actual,
             Traffic_Yesterday_Same_Hour::DOUBLE AS Predicted
           FROM split WHERE Side = 'test' AND RowNo - TrainRows <= 200""",
        SPLIT,
    ),
    # recommendations
    "recommendations": over_shaped(
        """SELECT Junction, Congestion_Level, CAST(len(texts) AS INTEGER) AS Num_Recommendations,
             array_to_string(texts, chr(10)) AS Recommendations FROM advised""",
        ADVISED,
    ),
    "recommendation_lines": over_shaped(
        f"""SELECT Junction, Congestion_Level, CAST(pos AS INTEGER) AS Line,
              coalesce(texts[pos], {_text(NOTHING)}) AS Recommendation
            FROM (SELECT *, unnest(range(1, greatest(len(texts), 1) + 1)) AS pos FROM advised)""",
        ADVISED,
    ),
    "recommendations_export": over_shaped(
        f"""SELECT Junction, Congestion_Level, CAST(len(texts) AS INTEGER) AS Num_Recommendations, {JOINED} FROM advised""",
        ADVISED,
    ),
    "recommendation_history": over_shaped(
        f"""SELECT Junction, Congestion_Level AS Cluster, {_same(['Morning_Peak', 'Evening_Peak'])},
              array_to_string(texts, chr(10)) AS Recommendations FROM advised""",
        ADVISED,
    ),
    "recommendation_log": over_shaped(
        f"""SELECT Run, Junction, Congestion_Level AS Cluster, {_same(['Morning_Peak', 'Evening_Peak'])},
              array_to_string(texts, chr(10)) AS Recommendations
            FROM advised, (SELECT unnest(['monday', 'tuesday']) AS Run)
            WHERE Run = 'monday' OR Junction <= 4""",
        ADVISED,
    ),
    "junction_report": over_shaped(
        f"""SELECT Junction, Congestion_Level, {_r('Avg_Vehicles', 'Avg_Traffic')},
              {_same(['Morning_Peak', 'Evening_Peak'])}, {JOINED} FROM advised""",
        ADVISED,
    ),
    # rules
    "rule_peak_hour": _rules("rule_type = 'Peak Hour Management'"),
    "rule_signal_timing": _rules("rule_type = 'Signal Timing Strategy'"),
    "rule_rush_hour": _rules("rule_type IN ('Morning Rush Hour Strategy', 'Evening Rush Hour Strategy')"),
    "rule_weekend": _rules("rule_type = 'Weekend Traffic Management'"),
    "rules": _rules(),
    "rules_sites": over_sum(f"SELECT {_RULE_COLUMNS} FROM rules", RULES, sites=True),
    "rules_filtered": _rules("priority IN ('Critical', 'High') AND cluster_id IN (0, 1)"),
    "rules_shown": over_shaped(
        """SELECT count(*) FILTER (priority IN ('Critical', 'High') AND cluster_id IN (0, 1)) AS Shown, count(*) AS Total
           FROM rules""",
        RULES,
    ),
    "rules_summary": over_shaped(
        """SELECT cluster_id, 'CLUSTER ' || cluster_id || ' - ' || congestion_level AS heading, rule_no,
             rule_no || '. ' || rule_type || ' [Priority: ' || priority || ']' AS title, description,
             specific_action AS action, expected_impact, implementation_time AS "when" FROM rules""",
        RULES,
    ),
}


def _over(rows: str, select: str, extra: str = "") -> str:
    return over_raw(select, rows + extra)


_LAST = "(SELECT Junction, max(DateTime) AS t, count(*) AS n FROM split GROUP BY Junction) WHERE n >= 24"
_EXACT = """SELECT Junction, Side, count(*) AS Records, 0::DOUBLE AS MAE, CASE WHEN count(*) > 1 THEN 1::DOUBLE END AS R2
    FROM split GROUP BY Junction, Side"""
_SUMMARY = f"""SELECT Junction, Junction * 100::DOUBLE AS Avg_Predicted, Junction * 100::DOUBLE AS Peak_Predicted,
    CAST(1 AS INTEGER) AS Peak_Step, t + INTERVAL 1 HOUR AS Peak_Time FROM {_LAST}"""
# Two junctions whose count hangs on the hour and is highest before noon.
STEP = SUMMED.replace(
    "CAST(sum(Vehicles) AS BIGINT) AS Vehicles", "CAST(Junction * 100 + (hour(DateTime) + 12) % 24 AS BIGINT) AS Vehicles"
)


def _over_step(select: str) -> str:
    return f"WITH {RAW.replace('user_id % 8 + 1', 'user_id % 2 + 1')}{STEP}{SPLIT} {select}"


_STEPS = f"""SELECT Junction, CAST(s AS INTEGER) AS Step, t + to_hours(s) AS DateTime,
    (Junction * 100 + (hour(t + to_hours(s)) + 12) % 24)::DOUBLE AS Predicted
  FROM (SELECT *, unnest(range(1, 25)) AS s FROM {_LAST})"""

# The split of a tree of depth 1 over all training rows, from its definition: the borders are half-way between values,
# all of at most 32 of them, else where the cumulative count passes another 32nd part.
STUMP = SPLIT + """,
long AS (
  SELECT Junction, Vehicles::DOUBLE AS y, unnest([0, 1, 2, 3, 4]) AS f,
    unnest(["Hour", DayOfWeek, IsWeekend, Traffic_Last_Hour, Traffic_Yesterday_Same_Hour])::DOUBLE AS v
  FROM split WHERE Side = 'train'),
counted AS (SELECT Junction, f, v, count(*) AS n, sum(y) AS s FROM long GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER line AS no, sum(n) OVER line AS upto, sum(s) OVER line AS left_sum,
    sum(n) OVER own AS whole, sum(s) OVER own AS total, count(*) OVER own AS different
  FROM counted WINDOW own AS (PARTITION BY Junction, f), line AS (PARTITION BY Junction, f ORDER BY v ROWS UNBOUNDED PRECEDING)),
dealt AS (SELECT *, CASE WHEN different <= 32 THEN no ELSE (upto - 1) * 32 // whole END AS bin FROM ranked),
following AS (
  SELECT *, lead(v) OVER line AS next_v, lead(bin) OVER line AS next_bin
  FROM dealt WINDOW line AS (PARTITION BY Junction, f ORDER BY v)),
cuts AS (
  SELECT *, left_sum * left_sum / upto + (total - left_sum) * (total - left_sum) / (whole - upto) AS score
  FROM following WHERE bin <> next_bin),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY Junction ORDER BY score DESC, f, v) = 1),
good AS (
  SELECT * FROM best WHERE score - total * total / whole > 1e-9 * greatest(total * total / whole, 1))"""
_RULES_UNNUMBERED = _RULE_COLUMNS.replace("rule_no, cluster_id, ", "")

SQL |= {
    "kmeans_a_apart": _over(
        APART,
        f"""SELECT Junction, Max_Vehicles, Congestion_Level, {_same(
            ['Avg_Vehicles', 'Morning_Peak', 'Evening_Peak', 'Weekend_Traffic', 'Weekday_Traffic'])} FROM labelled""",
        LABELLED,
    ),
    "kmeans_b_apart": _over(
        APART,
        f"""SELECT Junction, NumJunctions, PeakHour, CongestionLevel, {_same(
            ['AvgTraffic', 'AvgStdDev', 'AvgMaxTraffic', 'PeakHourAvgTraffic', 'AvgWeekendWeekdayRatio'])}
            FROM cluster_profiles JOIN assigned USING (Cluster)""",
        CLUSTER_PROFILES,
    ),
    "k_selection_apart": _over(APART, SELECT_SILHOUETTE.replace("SELECT", "SELECT CAST(3 AS INTEGER) AS k,", 1), SILHOUETTE),
    # The values of the events as they are; sums of fractions depend on their order in the last digits.
    "junction_spread_double": """
        WITH r AS (SELECT user_id % 8 + 1 AS Junction, value AS Vehicles FROM events),
        q AS (SELECT Junction, quantile_cont(Vehicles, 0.25) AS Q1, quantile_cont(Vehicles, 0.5) AS Median,
                quantile_cont(Vehicles, 0.75) AS Q3, avg(Vehicles) AS Mean, stddev_samp(Vehicles) AS Std FROM r GROUP BY Junction)
        SELECT Junction, round_even(any_value(Mean), 6) AS Mean, round_even(any_value(Median), 6) AS Median,
          round_even(any_value(Std), 6) AS Std, round_even(any_value(Q3 - Q1), 6) AS IQR,
          count(*) FILTER (Vehicles < Q1 - 1.5 * (Q3 - Q1) OR Vehicles > Q3 + 1.5 * (Q3 - Q1)) AS Outliers
        FROM r JOIN q USING (Junction) GROUP BY Junction
    """,
    "boxplot_stats_double": """
        WITH r AS (SELECT user_id % 8 + 1 AS Junction, value AS Vehicles FROM events),
        q AS (SELECT Junction, quantile_cont(Vehicles, 0.25) AS Q1, quantile_cont(Vehicles, 0.5) AS Median,
                quantile_cont(Vehicles, 0.75) AS Q3, avg(Vehicles) AS Mean FROM r GROUP BY Junction),
        f AS (SELECT *, Vehicles BETWEEN Q1 - 1.5 * (Q3 - Q1) AND Q3 + 1.5 * (Q3 - Q1) AS inside FROM r JOIN q USING (Junction))
        SELECT Junction, round_even(any_value(Q1), 6) AS Q1, round_even(any_value(Median), 6) AS Median,
          round_even(any_value(Q3), 6) AS Q3, min(Vehicles) FILTER (inside) AS Whisker_Low,
          max(Vehicles) FILTER (inside) AS Whisker_High, count(*) FILTER (NOT inside) AS Outliers,
          round_even(any_value(Mean), 6) AS Mean
        FROM f GROUP BY Junction
    """,
    "cluster_scores_apart": _over(
        APART, f"SELECT * FROM ({SELECT_SILHOUETTE}), ({SELECT_DAVIES})", SILHOUETTE + DAVIES.removeprefix(SCALED)
    ),
    "predict_cluster_apart": _over(
        APART,
        "SELECT Junction, min(Junction) OVER (PARTITION BY Junction % 3) AS Smallest FROM (SELECT DISTINCT Junction FROM r)",
    ),
    "model_roundtrip_apart": _over(
        APART, "SELECT Junction, CongestionLevel FROM cluster_profiles JOIN assigned USING (Cluster)", CLUSTER_PROFILES
    ),
    "silhouette_squared_sites": over_sum(SELECT_SILHOUETTE, SILHOUETTE.replace("sqrt", ""), sites=True),
    "rf_train_step": _over_step(_EXACT),
    "feature_importance_step": _over_step(
        """SELECT Junction, unnest(['Hour', 'DayOfWeek', 'IsWeekend']) AS Feature, unnest([1::DOUBLE, 0, 0]) AS Importance
           FROM (SELECT DISTINCT Junction FROM split)"""
    ),
    "forecast_24h_step": _over_step(_STEPS),
    "forecast_summary_step": _over_step(
        f"""SELECT Junction, avg(Predicted) AS Avg_Predicted, max(Predicted) AS Peak_Predicted,
              arg_max(Step, Predicted) AS Peak_Step, arg_max(DateTime, Predicted) AS Peak_Time
            FROM ({_STEPS}) GROUP BY Junction"""
    ),
    "forest_stump_sites": f"WITH {RAW_SITES}{SUMMED}{STUMP}"
    + """
        SELECT w.Junction, ['Hour', 'DayOfWeek', 'IsWeekend', 'Traffic_Last_Hour', 'Traffic_Yesterday_Same_Hour'][f + 1] AS Feature,
          (v + next_v) / 2 AS Threshold, round_even(mean, 6) AS Mean, round_even(left_sum / upto, 6) AS Left_Mean,
          round_even((good.total - left_sum) / (whole - upto), 6) AS Right_Mean
        FROM (SELECT Junction, avg(Vehicles) AS mean FROM split WHERE Side = 'train' GROUP BY Junction) w
        LEFT JOIN good USING (Junction)
    """,
    "rf_train_level": _over(LEVEL, _EXACT, SPLIT),
    "rf_train_each_level": _over(LEVEL, _EXACT, SPLIT),
    "actual_vs_predicted_level": _over(
        LEVEL,
        """SELECT Junction, RowNo - TrainRows AS TimeIndex, DateTime, Vehicles AS Actual, Vehicles::DOUBLE AS Predicted
           FROM split WHERE Side = 'test' AND RowNo - TrainRows <= 200""",
        SPLIT,
    ),
    "forecast_24h_level": _over(
        LEVEL,
        f"""SELECT Junction, CAST(s AS INTEGER) AS Step, t + to_hours(s) AS DateTime, Junction * 100::DOUBLE AS Predicted
            FROM (SELECT *, unnest(range(1, 25)) AS s FROM {_LAST})""",
        SPLIT,
    ),
    "forecast_summary_level": _over(LEVEL, _SUMMARY, SPLIT),
    "feature_importance_total": """
        SELECT 'DayOfWeek,Hour,IsWeekend,Site_Mean,Traffic_Last_Hour,Traffic_Yesterday_Same_Hour' AS Features, 1::DOUBLE AS Total
    """,
    "complete_analysis_apart": f"WITH {RAW.replace(' AS Vehicles', ' + ' + _OFFSET.format(junction='(user_id % 8 + 1)') + ' AS Vehicles')}"
    + FIRST
    + RULES
    + f" SELECT {_RULES_UNNUMBERED} FROM rules",
    "advise_apart": _over(
        APART,
        """SELECT Junction, Congestion_Level, CAST(len(texts) AS INTEGER) AS Num_Recommendations,
             array_to_string(texts, chr(10)) AS Recommendations FROM advised""",
        ADVISED,
    ),
    "run_pattern_analysis": f"SELECT * FROM ({SQL['peak_hour']}) JOIN ({SQL['junction_spread']}) USING (Junction)",
    "run_ml_engine_level": _over(
        LEVEL,
        f"""SELECT * FROM ({_SUMMARY}) JOIN (SELECT * FROM ({_EXACT}) WHERE Side = 'test') USING (Junction)""",
        SPLIT,
    ),
}
