"""Calendar columns of a reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALENDAR = ["Hour", "DayOfWeek", "Month", "IsWeekend"]


def calendar_columns(clock: Column) -> dict[str, Column]:
    """Hour 0-23, DayOfWeek with Monday = 0, Month 1-12 and IsWeekend 0/1."""
    day = F.weekday(clock)
    return {
        "Hour": F.hour(clock),
        "DayOfWeek": day,
        "Month": F.month(clock),
        "IsWeekend": (day >= 5).cast("int"),
    }


def period_of_day(hour: Column) -> Column:
    """Name of the part of the day; every period includes its upper hour."""
    return (
        F.when(hour <= 6, "Early Morning")
        .when(hour <= 9, "Morning Rush")
        .when(hour <= 16, "Midday")
        .when(hour <= 19, "Evening Rush")
        .when(hour <= 23, "Night")
    )


def add_calendar(readings: DataFrame, with_period: bool = False) -> DataFrame:
    """Append the calendar columns derived from DateTime."""
    out = readings.withColumns(calendar_columns(F.col("DateTime")))
    return out.withColumn("PeriodOfDay", period_of_day(F.col("Hour"))) if with_period else out


def date_range(readings: DataFrame, first: str, last: str) -> DataFrame:
    """Readings of the calendar days first..last, both included.

    A half-open range on the clock itself; over a scanned column it reaches the scan.
    """
    return readings.where(within_days(F.col("DateTime"), first, last))


def within_days(clock: Column, first: str, last: str) -> Column:
    """Is the clock time in the calendar days first..last? Holds alike before and after truncating it to hours."""
    start = F.lit(first).cast("date").cast("timestamp_ntz")
    stop = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    return (clock >= start) & (clock < stop)
