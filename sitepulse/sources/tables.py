"""Writing results and reading them back."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.functions.temporal import date_range
from sitepulse.operators.recommend import joined_text
from sitepulse.sources.readings import CLOCK_FORMAT

_CALENDAR = "Hour int, DayOfWeek int, Month int, IsWeekend int"
_HOURS = ", ".join(f"Hour_{h}_Avg double" for h in range(24))

# Column types of the tables an analysis writes, so that reading them back needs no inference.
SCHEMAS = {
    "processed_sum": f"Junction bigint, DateTime timestamp_ntz, Vehicles bigint, ID bigint, {_CALENDAR}",
    "processed_first": f"DateTime timestamp_ntz, Junction bigint, Vehicles double, {_CALENDAR}, PeriodOfDay string",
    "junction_features": (
        f"Junction bigint, {_HOURS}, Vehicles_mean double, Vehicles_std double, Vehicles_min double, "
        "Vehicles_max double, Vehicles_median double, PeakHour int, PeakHourTraffic double, Weekend_Avg double, "
        "Weekday_Avg double, Weekend_Weekday_Ratio double"
    ),
    "cluster_assignments": "Junction bigint, Cluster int",
    "cluster_profiles": (
        "Cluster int, NumJunctions bigint, AvgTraffic double, AvgStdDev double, AvgMaxTraffic double, PeakHour int, "
        "PeakHourAvgTraffic double, AvgWeekendWeekdayRatio double, CongestionLevel string"
    ),
    "rules": (
        "rule_no int, cluster_id int, congestion_level string, rule_type string, priority string, description string, "
        "specific_action string, expected_impact string, implementation_time string"
    ),
    "recommendations": "Junction bigint, Congestion_Level string, Num_Recommendations int, Recommendations string",
}


def write_csv(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a folder of CSV parts with header lines; text arrays become one joined field."""
    arrays = [name for name, kind in table.dtypes if kind == "array<string>"]
    flat = table.withColumns({c: joined_text(F.col(c)) for c in arrays})
    (
        flat.write.mode(mode)
        .option("header", True)
        .option("timestampFormat", CLOCK_FORMAT)
        .option("timestampNTZFormat", CLOCK_FORMAT)
        .option("escape", '"')
        .csv(path)
    )


def write_readings(processed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write processed readings as Parquet by month, so that later analyses can skip months.

    Rebalancing gathers a month into files of even size; a month with most of the rows is split.
    """
    (
        processed.withColumn("ReadingMonth", F.date_format("DateTime", "yyyy-MM"))
        .hint("rebalance", F.col("ReadingMonth"))
        .write.mode(mode)
        .partitionBy("ReadingMonth")
        .parquet(path)
    )


def write_buckets(
    table: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Write a table in buckets of ``keys``, sorted inside a bucket, and read it back as a table of the session.

    Grouping and joining by the keys then needs no exchange of these rows. As many buckets as a shuffle has
    partitions unless stated; the files are at ``path``, and the session's catalogue names them.
    """
    spark = table.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"buckets_{uuid.uuid4().hex}"
    placed = table.repartition(count, *keys)  # one writer for each bucket
    writer = placed.write.format("parquet").option("path", path).bucketBy(count, *keys).sortBy(*keys, *order)
    writer.saveAsTable(name)
    return spark.table(name)


def read_readings(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Read what ``write_readings`` wrote, all of it or the days first..last.

    The range is put on the month folders as well, so that other months are never listed or read.
    """
    readings = spark.read.parquet(path).withColumn("ReadingMonth", F.col("ReadingMonth").cast("string"))
    if first is not None and last is not None:
        readings = date_range(readings.where(F.col("ReadingMonth").between(first[:7], last[:7])), first, last)
    return readings.drop("ReadingMonth")


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a CSV table written by ``write_csv`` with its known schema."""
    return (
        spark.read.schema(SCHEMAS[name])
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", CLOCK_FORMAT)
        .csv(path)
    )


def read_processed(spark: SparkSession, path: str, policy: str = "sum") -> DataFrame:
    """Read processed readings written as CSV by either preparation."""
    return read_table(spark, path, f"processed_{policy}")


def load_results(spark: SparkSession, folder: str) -> dict[str, DataFrame | bool]:
    """The tables of a finished analysis; {"loaded": False} when one of them is missing."""
    names = {
        "timeseries": "processed_first",
        "junction_features": "junction_features",
        "cluster_assignments": "cluster_assignments",
        "cluster_profiles": "cluster_profiles",
        "rules": "rules",
    }
    try:
        tables = {name: read_table(spark, os.path.join(folder, name), schema) for name, schema in names.items()}
    except AnalysisException:
        return {"loaded": False}
    return {**tables, "loaded": True}
