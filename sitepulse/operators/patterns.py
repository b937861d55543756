"""When and where traffic occurs: averages by hour, day and junction, and spreads.

Every mean here is a sum over a count, so ``hour_cube`` first condenses readings to at most 168
cells per junction. Each pattern takes either processed readings or that cube; an analysis that
needs several patterns computes the cube once and never returns to the readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.functions.distribution import quantile_array, quantiles, quantiles_by_key, value_counts
from sitepulse.functions.numeric import round_half_even

HOURS = list(range(24))
DAYS = list(range(7))


def hour_cube(readings: DataFrame) -> DataFrame:
    """Count, sum, extremes and squared spread per (Junction, Hour, DayOfWeek, IsWeekend)."""
    return readings.groupBy("Junction", "Hour", "DayOfWeek", "IsWeekend").agg(
        F.count(F.lit(1)).alias("Records"),
        F.count("Vehicles").alias("Readings"),
        F.sum("Vehicles").alias("Total"),
        F.min("Vehicles").alias("Min"),
        F.max("Vehicles").alias("Max"),
        (F.var_pop("Vehicles") * F.count("Vehicles")).alias("Squares"),
    )


def as_cube(data: DataFrame) -> DataFrame:
    """The cube of readings; a cube is returned unchanged."""
    return data if {"Total", "Readings", "Squares"} <= set(data.columns) else hour_cube(data)


def cube_mean(where: Column | None = None) -> Column:
    """Mean vehicles over cube cells, optionally only over those that satisfy a condition."""
    total, readings = F.col("Total"), F.col("Readings")
    if where is not None:
        total, readings = F.when(where, total), F.when(where, readings)
    return F.try_divide(F.sum(total).cast("double"), F.sum(readings).cast("double"))


def mean_by(data: DataFrame, *keys: str) -> DataFrame:
    """Mean vehicles (Avg_Vehicles) per combination of cube keys."""
    return as_cube(data).groupBy(*keys).agg(cube_mean().alias("Avg_Vehicles"))


# --- summaries -----------------------------------------------------------------------------


def feature_stats(readings: DataFrame) -> DataFrame:
    """Distinct hours, days and months, and the number and share of weekend rows."""
    cells = readings.groupBy("Hour", "DayOfWeek", "Month", "IsWeekend").agg(F.count(F.lit(1)).alias("n"))
    weekend = F.coalesce(F.sum(F.when(F.col("IsWeekend") == 1, F.col("n"))), F.lit(0))
    return cells.agg(
        F.count_distinct("Hour").alias("Unique_Hours"),
        F.count_distinct("DayOfWeek").alias("Unique_Days"),
        F.count_distinct("Month").alias("Unique_Months"),
        weekend.alias("Weekend_Records"),
        F.try_divide(weekend * 100.0, F.sum("n").cast("double")).alias("Weekend_Pct"),
    )


def junction_volume(readings: DataFrame) -> DataFrame:
    """Total, mean and maximum per junction, busiest first."""
    return (
        readings.groupBy("Junction")
        .agg(
            F.sum("Vehicles").alias("Total_Vehicles"),
            round_half_even(F.avg("Vehicles")).alias("Avg_Vehicles"),
            F.max("Vehicles").alias("Max_Vehicles"),
        )
        .orderBy(F.desc("Total_Vehicles"), "Junction")
    )


def top_junctions(readings: DataFrame, n: int = 10) -> DataFrame:
    """The n busiest junctions by total vehicles; equal totals in junction order."""
    return junction_volume(readings).limit(n)


def overall_stats(readings: DataFrame) -> DataFrame:
    """Records, total, mean and clock range, as one row."""
    return readings.agg(
        F.count(F.lit(1)).alias("Records"),
        F.sum("Vehicles").alias("Total_Vehicles"),
        F.avg("Vehicles").alias("Avg_Vehicles"),
        F.min("DateTime").alias("First"),
        F.max("DateTime").alias("Last"),
    )


def data_summary(readings: DataFrame) -> DataFrame:
    """One nested row: total_records, num_junctions, date_range and vehicle_stats.

    Without readings total_records is 0 and the other values are null. ``days`` counts whole
    24-hour periods between the first and the last reading.
    """
    per_junction = readings.groupBy("Junction").agg(
        F.count(F.lit(1)).alias("records"),
        F.count("Vehicles").alias("readings"),
        F.sum("Vehicles").alias("total"),
        F.min("Vehicles").alias("low"),
        F.max("Vehicles").alias("high"),
        F.min("DateTime").alias("first"),
        F.max("DateTime").alias("last"),
    )
    overall = per_junction.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.count("Junction").alias("num_junctions"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.try_divide(F.sum("total").cast("double"), F.sum("readings").cast("double")).alias("mean"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    median = quantiles(value_counts(readings), probs=(0.5,)).select(F.col("Quantiles")[0]).scalar()
    clock = "yyyy-MM-dd HH:mm:ss"
    return overall.select(
        "total_records",
        "num_junctions",
        F.struct(
            F.date_format("first", clock).alias("start"),
            F.date_format("last", clock).alias("end"),
            F.timestamp_diff("DAY", F.col("first"), F.col("last")).alias("days"),
        ).alias("date_range"),
        F.struct(
            round_half_even(F.col("mean")).alias("mean"),
            round_half_even(median).alias("median"),
            F.col("low").cast("bigint").alias("min"),
            F.col("high").cast("bigint").alias("max"),
        ).alias("vehicle_stats"),
    )


# --- hourly and weekly shapes --------------------------------------------------------------


def hourly_trend(data: DataFrame) -> DataFrame:
    """Mean per (Hour, Junction)."""
    return mean_by(data, "Hour", "Junction")


def hourly_overall(data: DataFrame) -> DataFrame:
    """Mean per hour over all rows."""
    return mean_by(data, "Hour")


def hourly_daytype(data: DataFrame) -> DataFrame:
    """Mean per hour, weekdays and weekends apart."""
    return mean_by(data, "IsWeekend", "Hour")


def weekly_pattern(data: DataFrame) -> DataFrame:
    """Mean per day of the week over all junctions."""
    return mean_by(data, "DayOfWeek")


def weekly_by_junction(data: DataFrame) -> DataFrame:
    """Mean per (Junction, DayOfWeek)."""
    return mean_by(data, "Junction", "DayOfWeek")


def peak_hour(data: DataFrame) -> DataFrame:
    """Hour with the highest mean per junction (the earliest on ties) and that mean."""
    best = F.max(F.struct("Avg_Vehicles", (-F.col("Hour")).alias("back")))
    return (
        hourly_trend(data)
        .where(F.col("Avg_Vehicles").isNotNull())
        .groupBy("Junction")
        .agg(best.alias("best"))
        .select(
            "Junction",
            (-F.col("best.back")).alias("PeakHour"),
            F.col("best.Avg_Vehicles").alias("PeakHourTraffic"),
        )
    )


def weekday_weekend_gap(data: DataFrame) -> DataFrame:
    """Weekday and weekend level as unweighted means of the daily means, and their difference."""
    weekday = F.avg(F.when(F.col("DayOfWeek") < 5, F.col("Avg_Vehicles")))
    weekend = F.avg(F.when(F.col("DayOfWeek") >= 5, F.col("Avg_Vehicles")))
    levels = weekly_pattern(data).agg(weekday.alias("Weekday_Avg"), weekend.alias("Weekend_Avg"))
    gap = F.abs(F.col("Weekday_Avg") - F.col("Weekend_Avg"))
    return levels.withColumns(
        {"Difference": gap, "Difference_Pct": F.try_divide(gap, F.col("Weekday_Avg")) * 100}
    )


def heatmap(data: DataFrame, *by: str) -> DataFrame:
    """Mean per hour and day of the week, days as columns Day_0 (Monday) to Day_6, gaps as 0.

    ``by`` adds leading keys, such as Junction for the heatmaps of all junctions at once.
    """
    means = mean_by(data, *by, "Hour", "DayOfWeek")
    wide = means.groupBy(*by, "Hour").pivot("DayOfWeek", DAYS).agg(F.first("Avg_Vehicles"))
    return wide.select(*by, "Hour", *[F.coalesce(F.col(str(d)), F.lit(0.0)).alias(f"Day_{d}") for d in DAYS])


def timeseries_first(readings: DataFrame, n: int = 5) -> DataFrame:
    """Clock series of the n junctions with the lowest ids."""
    chosen = readings.select("Junction").distinct().orderBy("Junction").limit(n)
    # At most n one-column rows, hence the broadcast.
    return readings.join(F.broadcast(chosen), "Junction", "left_semi").select("Junction", "DateTime", "Vehicles")


def junction_slice(readings: DataFrame, junctions: int | DataFrame) -> DataFrame:
    """Readings of one junction, or of the junctions listed in a table."""
    if isinstance(junctions, DataFrame):
        return readings.join(junctions.select("Junction"), "Junction", "left_semi")
    return readings.where(F.col("Junction") == junctions)


# --- spread of the counts ------------------------------------------------------------------


_QUARTILES = (0.25, 0.5, 0.75)


def _spread(readings: DataFrame, factor: float = 1.5, spread_values: bool = False) -> tuple[DataFrame, DataFrame]:
    """Quartiles, fences and moments per junction, and the value counts they all come from.

    The different values of a junction meet in one task, which suits whole counts; with ``spread_values``
    they are ranked over many, for fractional values of which there may be as many as readings.
    """
    counts = value_counts(readings, "Junction")
    quartiles = [] if spread_values else [quantile_array(_QUARTILES).alias("q")]
    shape = counts.groupBy("Junction").agg(
        *quartiles,
        F.expr("coalesce(sum(if(Vehicles IS NULL, 0, Readings)), 0) AS Count"),
        F.expr("double(sum(Vehicles * Readings)) / sum(if(Vehicles IS NULL, null, Readings)) AS Mean"),
        F.min("Vehicles").alias("Min"),
        F.max("Vehicles").alias("Max"),
    )
    if spread_values:
        ranked = quantiles_by_key(counts, "Junction", probs=_QUARTILES)
        ranked = ranked.select(F.col("Junction").alias("_junction"), F.col("Quantiles").alias("q"))
        shape = shape.join(ranked, F.col("Junction").eqNullSafe(F.col("_junction"))).drop("_junction")
    q1, q3 = F.col("q")[0], F.col("q")[2]
    return (
        shape.select(
            "*",
            q1.alias("Q1"),
            F.col("q")[1].alias("Median"),
            q3.alias("Q3"),
            (q3 - q1).alias("IQR"),
            (q1 - factor * (q3 - q1)).alias("Low"),
            (q3 + factor * (q3 - q1)).alias("High"),
        ).drop("q"),
        counts,
    )


def _spread_detail(readings: DataFrame, spread_values: bool = False) -> DataFrame:
    """The spread with deviation, whisker ends and number of outliers."""
    shape, counts = _spread(readings, spread_values=spread_values)
    inside = F.col("Vehicles").between(F.col("Low"), F.col("High"))
    squares = F.col("Readings") * F.pow(F.col("Vehicles") - F.col("Mean"), F.lit(2))
    deviation = F.sqrt(F.sum(squares) / F.when(F.col("Count") > 1, F.col("Count") - 1))
    return (
        counts.join(shape, "Junction")
        .groupBy(*shape.columns)
        .agg(
            deviation.alias("Std"),
            F.min(F.when(inside, F.col("Vehicles"))).alias("Whisker_Low"),
            F.max(F.when(inside, F.col("Vehicles"))).alias("Whisker_High"),
            F.sum(F.when(~inside, F.col("Readings")).otherwise(0)).alias("Outliers"),
        )
    )


def junction_spread(readings: DataFrame, spread_values: bool = False) -> DataFrame:
    """Mean, median, standard deviation, IQR and number of readings beyond 1.5 IQR per junction."""
    return _spread_detail(readings, spread_values).select("Junction", "Mean", "Median", "Std", "IQR", "Outliers")


def junction_describe(readings: DataFrame, spread_values: bool = False) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per junction."""
    return _spread_detail(readings, spread_values).select("Junction", "Count", "Mean", "Std", "Min", "Q1", "Median", "Q3", "Max")


def boxplot_stats(readings: DataFrame, spread_values: bool = False) -> DataFrame:
    """Quartiles, whisker ends (extreme readings within 1.5 IQR), outlier count and mean per junction."""
    return _spread_detail(readings, spread_values).select(
        "Junction", "Q1", "Median", "Q3", "Whisker_Low", "Whisker_High", "Outliers", "Mean"
    )


def boxplot_outliers(readings: DataFrame, spread_values: bool = False) -> DataFrame:
    """The values drawn as single points in a box plot, with how often each occurs."""
    shape, counts = _spread(readings, spread_values=spread_values)
    return (
        counts.join(shape.select("Junction", "Low", "High"), "Junction")
        .where(~F.col("Vehicles").between(F.col("Low"), F.col("High")))
        .select("Junction", "Vehicles", "Readings")
    )


def vehicle_histogram(readings: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum per junction, empty ones included, and the mean.

    Bins are closed on the left, the last one on both sides. A junction with a single value gets
    bins from half below to half above it.
    """
    counts = value_counts(readings, "Junction").where(F.col("Vehicles").isNotNull())
    ranges = counts.groupBy("Junction").agg(
        F.min("Vehicles").cast("double").alias("low"),
        F.max("Vehicles").cast("double").alias("high"),
        (F.sum(F.col("Vehicles") * F.col("Readings")).cast("double") / F.sum("Readings")).alias("Mean"),
    )
    flat = F.col("low") == F.col("high")
    ranges = ranges.select(
        "Junction",
        "Mean",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    position = F.floor((F.col("Vehicles") - F.col("low")) * bins / (F.col("high") - F.col("low")))
    filled = (
        counts.join(ranges, "Junction")
        .groupBy("Junction", F.least(position, F.lit(bins - 1)).cast("int").alias("Bin"))
        .agg(F.sum("Readings").alias("Readings"))
    )
    width = (F.col("high") - F.col("low")) / bins
    frame = ranges.withColumn("Bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(filled, ["Junction", "Bin"], "left").select(
        "Junction",
        "Bin",
        (F.col("low") + F.col("Bin") * width).alias("Bin_Start"),
        (F.col("low") + (F.col("Bin") + 1) * width).alias("Bin_End"),
        F.coalesce("Readings", F.lit(0)).alias("Readings"),
        "Mean",
    )


def junction_detail(data: DataFrame) -> DataFrame:
    """Records, mean, deviation, maximum, day-type means and their verdict per junction."""
    cells = as_cube(data)
    stats = junction_moments(cells)
    weekend = F.coalesce(F.col("Weekend_Avg") > F.col("Weekday_Avg"), F.lit(False))
    return stats.select(
        "Junction",
        "Records",
        F.col("Mean").alias("Avg_Vehicles"),
        F.col("Std").alias("Std_Vehicles"),
        F.col("Max").alias("Max_Vehicles"),
        "Weekday_Avg",
        "Weekend_Avg",
        F.when(weekend, "leisure zone").otherwise("commuter route").alias("Verdict"),
    )


def junction_moments(cube: DataFrame) -> DataFrame:
    """Counts, mean, sample deviation, extremes, day-type means and hourly means per junction.

    The deviation adds the spread inside the cells and the spread between their means. HourMeans
    is an array of (mean, hour) structs, one for each hour with readings.
    """
    site = Window.partitionBy("Junction")  # at most 168 cells
    mean = F.try_divide(F.sum("Total").over(site).cast("double"), F.sum("Readings").over(site).cast("double"))
    between = F.expr("Readings * pow(try_divide(double(Total), double(Readings)) - _mean, 2)")
    # The window has brought each junction together, so neither aggregate shuffles again.
    by_hour = (
        cube.withColumn("_mean", mean)
        .groupBy("Junction", "Hour")
        .agg(
            F.sum("Records").alias("Records"),
            F.sum("Readings").alias("Readings"),
            F.sum("Total").alias("Total"),
            F.sum(F.col("Squares") + between).alias("Squares"),
            F.min("Min").alias("Min"),
            F.max("Max").alias("Max"),
            F.expr("sum(if(IsWeekend = 1, Total, null)) AS EndTotal"),
            F.expr("sum(if(IsWeekend = 1, Readings, null)) AS EndReadings"),
            F.expr("sum(if(IsWeekend = 0, Total, null)) AS DayTotal"),
            F.expr("sum(if(IsWeekend = 0, Readings, null)) AS DayReadings"),
            cube_mean().alias("_hour_mean"),
        )
    )

    def share(total: str, readings: str, name: str) -> Column:
        return F.expr(f"try_divide(double(sum({total})), double(sum({readings}))) AS {name}")

    return by_hour.groupBy("Junction").agg(
        F.sum("Records").alias("Records"),
        F.sum("Readings").alias("Readings"),
        share("Total", "Readings", "Mean"),
        F.expr("if(sum(Readings) > 1, sqrt(sum(Squares) / (sum(Readings) - 1)), null) AS Std"),
        F.min("Min").alias("Min"),
        F.max("Max").alias("Max"),
        share("EndTotal", "EndReadings", "Weekend_Avg"),
        share("DayTotal", "DayReadings", "Weekday_Avg"),
        F.expr(
            "collect_list(if(_hour_mean IS NULL, null, struct(_hour_mean AS mean, Hour AS hour))) AS HourMeans"
        ),
    )
