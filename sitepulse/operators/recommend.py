"""Advice per junction from its congestion level and traffic profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The advice texts.
FLYOVER = (
    "Priority Intersection: Consider constructing a flyover or deploying traffic police during peak hours."
)
INBOUND = "Commuter Route: Optimize signal timing for inbound traffic 08:00-10:00."
LEISURE = "Leisure Zone: Expect delays near shopping/recreational areas on Saturdays."
ADAPTIVE = (
    "Moderate Congestion: Implement adaptive signal control systems to dynamically adjust timing based on "
    "real-time flow."
)
QUIET = (
    "Low Traffic Zone: Maintain current signal timings. Consider reducing cycle time to improve pedestrian "
    "crossing efficiency."
)
BALANCED = (
    "Balanced Traffic: Similar morning and evening peaks detected. Use time-of-day signal plans with consistent "
    "green time allocation."
)
OUTBOUND = (
    "Evening Rush Dominant: Optimize signal timing for outbound traffic 17:00-19:00. Prioritize routes away from "
    "city center."
)
NOTHING = "No specific recommendations - traffic patterns are normal."


def advice(level: Column, morning: Column, evening: Column, weekend: Column, weekday: Column) -> Column:
    """The texts that apply, as an array in their fixed order."""
    imbalance = F.try_divide(F.abs(morning - evening), F.greatest(morning, evening))
    conditions = [
        (level == "High Congestion", FLYOVER),
        (morning > evening, INBOUND),
        ((weekend > 0) & (weekday > 0) & (weekend > weekday), LEISURE),
        (level == "Medium Traffic", ADAPTIVE),
        (level == "Low Congestion", QUIET),
        ((morning > 0) & (evening > 0) & (imbalance < 0.15), BALANCED),
        (evening > morning, OUTBOUND),
    ]
    return F.array_compact(F.array(*[F.when(condition, F.lit(text)) for condition, text in conditions]))


def _inputs(profiles: DataFrame) -> dict[str, Column]:
    """What the advice of a profile depends on, with stand-ins for columns it lacks."""

    def number(name: str) -> Column:
        return (F.col(name) if name in profiles.columns else F.lit(0.0)).cast("double")

    if "Congestion_Level" in profiles.columns:
        level = F.col("Congestion_Level")
    elif "Cluster" in profiles.columns:
        level = F.col("Cluster").cast("string")
    else:
        level = F.lit("Unknown")
    peaks = ("Morning_Peak", "Evening_Peak", "Weekend_Traffic", "Weekday_Traffic")
    return {"Congestion_Level": level, **{name: number(name) for name in peaks}}


def _advised(profiles: DataFrame) -> DataFrame:
    inputs = _inputs(profiles)
    return profiles.select("Junction", *[column.alias(name) for name, column in inputs.items()]).withColumn(
        "Recommendations", advice(*[F.col(name) for name in inputs])
    )


def recommendations(profiles: DataFrame) -> DataFrame:
    """Advice of every junction as an array, with its length.

    Peaks and day-type means that the profiles lack count as 0; the level falls back to Cluster,
    then to "Unknown".
    """
    return _advised(profiles).select(
        "Junction", "Congestion_Level", F.size("Recommendations").alias("Num_Recommendations"), "Recommendations"
    )


HISTORY = (
    "Junction bigint, Cluster string, Morning_Peak double, Evening_Peak double, Recommendations array<string>, Run string"
)


def recommendation_history(profiles: DataFrame) -> DataFrame:
    """What went into and came out of each piece of advice; ``append_history`` keeps a log of it."""
    return _advised(profiles).select(
        "Junction", F.col("Congestion_Level").alias("Cluster"), "Morning_Peak", "Evening_Peak", "Recommendations"
    )


def append_history(history: DataFrame, path: str, run: str) -> None:
    """Add the rows of one run to the log at ``path``.

    A run has a folder of its own, which is replaced as a whole, so a run that is repeated or retried is there once.
    """
    (
        history.withColumn("Run", F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("Run")
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str, *runs: str) -> DataFrame:
    """The log, or the named runs of it, of which only the folders are read."""
    log = spark.read.schema(HISTORY).parquet(path)
    return log.where(F.col("Run").isin(list(runs))) if runs else log


def recommendation_lines(recommended: DataFrame) -> DataFrame:
    """The report: one numbered line per text, and a single default line for a junction without advice."""
    return recommended.select(
        "Junction", "Congestion_Level", F.posexplode_outer("Recommendations").alias("at", "text")
    ).select(
        "Junction",
        "Congestion_Level",
        (F.coalesce("at", F.lit(0)) + 1).alias("Line"),
        F.coalesce("text", F.lit(NOTHING)).alias("Recommendation"),
    )


def joined_text(texts: Column) -> Column:
    """The texts as one field, or "None"."""
    return F.when(F.size(texts) > 0, F.array_join(texts, " | ")).otherwise("None")


def recommendations_export(recommended: DataFrame) -> DataFrame:
    """Recommendations with the texts joined into one field, ready for CSV."""
    return recommended.withColumn("Recommendations", joined_text(F.col("Recommendations")))


def junction_report(profiles: DataFrame) -> DataFrame:
    """The downloadable report row, for every junction at once."""
    inputs = _inputs(profiles)
    return profiles.select(
        "Junction",
        inputs["Congestion_Level"].alias("Congestion_Level"),
        F.col("Avg_Vehicles").alias("Avg_Traffic"),
        "Morning_Peak",
        "Evening_Peak",
        joined_text(advice(*inputs.values())).alias("Recommendations"),
    )
