"""Raw readings: one row per junction and clock time with a vehicle count."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.functions.temporal import within_days

CLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss"
#: Columns that every file of readings must have.
NEEDED = ("DateTime", "Junction", "Vehicles")


def load_readings(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "csv",
    drop_id: bool = False,
    lenient: bool = False,
    vehicles_type: str = "bigint",
    keep_file_order: bool = False,
) -> DataFrame:
    """Read readings from CSV with a header, or from Parquet. A file without DateTime, Junction or Vehicles is an error.

    CSV columns are matched by the header names of their own file, in any order, and typed here, so no
    inference pass runs over the data. Whole counts are read exactly: a fraction fails the query unless
    ``vehicles_type`` is "double". A clock text that does not parse fails the query; ``lenient`` turns it
    into null. ``keep_file_order`` adds SourceOrder, which rises with the name of the file and with the line
    in it, for inputs that have no ID to say which of two copies came first.
    """
    if fmt == "csv":
        raw = _read_csv(spark, path, keep_file_order)
    elif fmt == "parquet":
        raw = _with_file(spark.read.parquet(path), keep_file_order)
    else:
        raise ValueError(f"unknown format {fmt!r}: use csv or parquet")
    clock = F.col("DateTime")
    count = F.col("Vehicles")
    if vehicles_type != "double":
        # A column with gaps is often exported as 15.0 rather than 15; decimals keep long integers whole.
        exact = count.cast("decimal(38,9)")
        cut = F.raise_error(F.concat(F.lit("Vehicles is no whole count: "), count.cast("string")))
        count = F.when(exact.isNull() | (exact == F.floor(exact)), exact).otherwise(cut.cast("decimal(38,9)"))
    typed = {
        "Vehicles": count.cast(vehicles_type),
        "Junction": F.col("Junction").cast("bigint"),
    }
    if dict(raw.dtypes)["DateTime"] == "string":
        clock = F.try_to_timestamp(clock, F.lit(CLOCK_FORMAT)) if lenient else F.to_timestamp(clock, CLOCK_FORMAT)
    typed["DateTime"] = clock.cast("timestamp_ntz")
    if "ID" in raw.columns:
        typed["ID"] = F.col("ID").cast("bigint")
    readings = raw.withColumns(typed)
    if keep_file_order:
        readings = _in_file_order(readings)
    return readings.drop("ID") if drop_id else readings


def _with_file(table: DataFrame, wanted: bool) -> DataFrame:
    return table.select("*", F.col("_metadata.file_path").alias("_file")) if wanted else table


def _in_file_order(readings: DataFrame) -> DataFrame:
    """SourceOrder in place of the file name: files by name, then lines."""
    files = [(re.sub("^file:/+", "file:/", file), i) for i, file in enumerate(sorted(readings.inputFiles()))]
    numbers = readings.sparkSession.createDataFrame(files, "_file string, _number bigint")
    # The number of a row rises inside a file, whichever pieces the file is read in.
    line = readings.withColumns(
        {"_line": F.monotonically_increasing_id(), "_file": F.regexp_replace("_file", "^file:/+", "file:/")}
    )
    order = F.expr("cast(_number as decimal(10,0)) * 9223372036854775807 + _line").alias("SourceOrder")
    kept = [c for c in readings.columns if c != "_file"]
    return line.join(numbers, "_file", "left").select(*kept, order)


def _headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """The different header lines of the CSV files at ``path``, each with the files that have it.

    One job whatever the number of files: a task takes one piece of a file and stops behind its first line.
    Empty files have no header. What comes to the driver are file names, which it has listed anyway.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                if batch.column("start")[at].as_py() > 0:
                    return
                if batch.column("value")[at].as_py().strip():
                    yield batch.slice(at, 1).select(["value", "file"])
                    return

    # With so high a cost of opening a file, no two pieces share a task.
    setting = "spark.sql.files.openCostInBytes"
    usual = spark.conf.get(setting)
    try:
        spark.conf.set(setting, spark.conf.get("spark.sql.files.maxPartitionBytes"))
        found = lines.mapInArrow(first_line, "value string, file string").groupBy("value")
        rows = found.agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    finally:
        spark.conf.set(setting, usual)
    # The names of files are as in an address; a reader takes them plain.
    return sorted((row["value"], [unquote(file) for file in row["files"]]) for row in rows)


def _read_csv(spark: SparkSession, path: str, keep_file: bool) -> DataFrame:
    """All files of a CSV folder as text columns by name.

    Spark takes the header of one file for all, so files are read together where their headers are alike. A
    file that lacks one of the needed columns is an error.
    """
    together = spark.read.option("header", True).csv(path)
    headers = _headers(spark, path) if len(together.inputFiles()) > 1 else [(None, None)]
    groups = [(next(csv.reader([line])), files) if line is not None else (together.columns, files) for line, files in headers]
    for columns, files in groups:
        missing = [c for c in NEEDED if c not in columns]
        if missing:
            where = path if files is None else f"{files[0]} and {len(files) - 1} more files"
            raise ValueError(f"no column {', '.join(missing)} in {where}")
    if len(groups) < 2:
        return _with_file(together, keep_file)
    tables = [_with_file(spark.read.option("header", True).csv(files), keep_file) for _, files in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def clock_range(readings: DataFrame) -> DataFrame:
    """First and last clock time of the readings, as one row."""
    return readings.agg(F.min("DateTime").alias("First"), F.max("DateTime").alias("Last"))


def readings_from_events(
    events: DataFrame, sites: int | None = 8, days: tuple[str, str] | None = None
) -> DataFrame:
    """View an event log as readings: the hour of ``ts``, and ``floor(value)`` as the count.

    With ``sites`` the users are folded onto that many busy junctions with dense hourly series;
    with ``None`` every user is a junction of its own, so the number of junctions grows with the data.
    ``days`` keeps the calendar days first..last; as whole days they hold for ``ts`` as for its hour, so
    the range reaches the scan.
    """
    if days:
        events = events.where(within_days(F.col("ts"), *days))
    user = F.col("user_id")
    return events.select(
        F.col("event_id").alias("ID"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("DateTime"),
        (F.pmod(user, F.lit(sites)) + 1 if sites else user).cast("bigint").alias("Junction"),
        F.floor("value").cast("bigint").alias("Vehicles"),
    )
