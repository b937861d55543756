"""One row per junction: the feature matrix and the short profile that clustering works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions.distribution import quantiles, value_counts
from sitepulse.functions.numeric import round_half_even
from sitepulse.operators.patterns import HOURS, as_cube, cube_mean, junction_moments, mean_by

HOUR_COLUMNS = [f"Hour_{h}_Avg" for h in HOURS]
PROFILE_FEATURES = ["Avg_Vehicles", "Max_Vehicles", "Morning_Peak", "Evening_Peak"]
MATRIX_FEATURES = [
    *HOUR_COLUMNS,
    "Vehicles_mean",
    "Vehicles_std",
    "Vehicles_max",
    "PeakHourTraffic",
    "Weekend_Weekday_Ratio",
]


def _zero(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0))


def junction_hour_pivot(data: DataFrame) -> DataFrame:
    """Mean per hour as the columns Hour_0_Avg to Hour_23_Avg; hours without readings are 0."""
    means = mean_by(data, "Junction", "Hour")
    wide = means.groupBy("Junction").pivot("Hour", HOURS).agg(F.first("Avg_Vehicles"))
    return wide.select(
        "Junction", *[F.coalesce(F.col(str(h)), F.lit(0.0)).alias(f"Hour_{h}_Avg") for h in HOURS]
    )


def junction_features(readings: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """The feature matrix: 24 hourly means, mean / std / min / max / median, peak hour and day types.

    Statistics are rounded to two decimals, hourly means and the peak are not; what a junction
    lacks is 0. Everything but the median comes from the hour cube; the median comes from value
    counts. Pass ``cube`` when it has already been computed.
    """
    cells = as_cube(readings) if cube is None else cube
    median = quantiles(value_counts(readings, "Junction"), "Junction", probs=(0.5,)).select(
        "Junction", F.col("Quantiles")[0].alias("_median")
    )
    # Highest mean first, then the earliest hour.
    peak = F.expr("array_max(transform(HourMeans, x -> struct(x.mean AS mean, -x.hour AS back)))")
    by_hour = F.expr("map_from_entries(transform(HourMeans, x -> struct(x.hour, x.mean)))")
    ratio = F.try_divide(F.col("Weekend_Avg"), F.col("Weekday_Avg"))
    return (
        junction_moments(cells)
        .join(median, "Junction", "left")
        .withColumns({"_peak": peak, "_hours": by_hour})
        .select(
            "Junction",
            *[F.expr(f"coalesce(_hours[{h}], 0D) AS {name}") for h, name in enumerate(HOUR_COLUMNS)],
            _zero(round_half_even(F.col("Mean"))).alias("Vehicles_mean"),
            _zero(round_half_even(F.col("Std"))).alias("Vehicles_std"),
            _zero("Min").alias("Vehicles_min"),
            _zero("Max").alias("Vehicles_max"),
            _zero(round_half_even(F.col("_median"))).alias("Vehicles_median"),
            F.expr("coalesce(-_peak.back, 0) AS PeakHour"),
            F.expr("coalesce(_peak.mean, 0D) AS PeakHourTraffic"),
            _zero("Weekend_Avg").alias("Weekend_Avg"),
            _zero("Weekday_Avg").alias("Weekday_Avg"),
            _zero(round_half_even(ratio)).alias("Weekend_Weekday_Ratio"),
        )
    )


def junction_stats(readings: DataFrame) -> DataFrame:
    """The statistics and peak columns of the feature matrix."""
    return junction_features(readings).select(
        "Junction",
        "Vehicles_mean",
        "Vehicles_std",
        "Vehicles_min",
        "Vehicles_max",
        "Vehicles_median",
        "PeakHour",
        "PeakHourTraffic",
    )


def weekend_ratio(data: DataFrame) -> DataFrame:
    """Weekend mean, weekday mean and their ratio; 0 where a side or the divisor is missing."""
    weekend = F.col("IsWeekend") == 1
    return (
        as_cube(data)
        .groupBy("Junction")
        .agg(cube_mean(weekend).alias("_end"), cube_mean(~weekend).alias("_day"))
        .select(
            "Junction",
            _zero("_end").alias("Weekend_Avg"),
            _zero("_day").alias("Weekday_Avg"),
            _zero(round_half_even(F.try_divide(F.col("_end"), F.col("_day")))).alias("Weekend_Weekday_Ratio"),
        )
    )


def junction_profiles(data: DataFrame) -> DataFrame:
    """Mean, maximum, and the means of 8-10 and 17-19 o'clock (both ends included) per junction."""
    return enhanced_profiles(data).drop("Weekend_Traffic", "Weekday_Traffic")


def enhanced_profiles(data: DataFrame) -> DataFrame:
    """The junction profile with weekend and weekday means, all from one aggregate."""
    hour, weekend = F.col("Hour"), F.col("IsWeekend") == 1
    return (
        as_cube(data)
        .groupBy("Junction")
        .agg(
            cube_mean().alias("Avg_Vehicles"),
            F.max("Max").alias("Max_Vehicles"),
            _zero(cube_mean(hour.between(8, 10))).alias("Morning_Peak"),
            _zero(cube_mean(hour.between(17, 19))).alias("Evening_Peak"),
            _zero(cube_mean(weekend)).alias("Weekend_Traffic"),
            _zero(cube_mean(~weekend)).alias("Weekday_Traffic"),
        )
    )
