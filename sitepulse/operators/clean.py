"""Repair and reduction of raw readings: gaps, duplicates, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.functions.distribution import quantiles, quantiles_by_range, value_counts
from sitepulse.session import scratch_folder

KEY = ["Junction", "DateTime"]


def null_count(readings: DataFrame) -> DataFrame:
    """Nulls over all columns, as one row."""
    per_column = [F.count_if(F.col(c).isNull()) for c in readings.columns]
    total = per_column[0]
    for count in per_column[1:]:
        total = total + count
    return readings.agg(total.alias("Nulls"))


def fill_gaps(
    readings: DataFrame, columns: Sequence[str] = ("Vehicles",), order: str = "ID", pieces: int | None = None
) -> DataFrame:
    """Fill nulls from the previous value of the same junction, else from the next one.

    Readings are ordered by (DateTime, order) inside a junction; values never cross junctions.
    ``order`` must be a number that no two copies of a reading share. Readings without a junction or a
    clock time pass as they are and give no values.

    A junction or a single clock time may hold a large part of all rows, so the readings are cut along
    (Junction, DateTime, order) into ``pieces`` of even size, as many as a shuffle has partitions unless
    stated, and written once with the number of their piece below the shared folder. What a piece
    passes on is one row per junction in it: its first and last values, carried from piece to piece. Only where a
    junction has a null in a piece are the rows of both put in order; all others are read back as they are. Filling
    from the next value only concerns rows before the first value of a junction, so that one value serves them all.
    """
    spark = readings.sparkSession
    count = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = readings.repartitionByRange(count, *KEY, order).withColumn("_piece", F.spark_partition_id())
    path = scratch_folder(spark, "gaps")
    cut.write.parquet(path)
    placed = spark.read.schema(cut.schema).parquet(path)

    keyed = F.col("Junction").isNotNull() & F.col("DateTime").isNotNull()
    part = ["_piece", "Junction"]

    def place(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct("DateTime", order))

    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    ends = (
        placed.where(keyed)
        .groupBy(*part)
        .agg(
            F.max(missing).alias("_gap"),
            *[F.min_by(c, place(c)).alias(f"_first_{c}") for c in columns],
            *[F.max_by(c, place(c)).alias(f"_last_{c}") for c in columns],
        )
    )
    line = Window.partitionBy("Junction").orderBy("_piece")
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = ends.select(
        *part,
        "_gap",
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_before_{c}") for c in columns],
        *[F.first(f"_first_{c}", ignorenulls=True).over(whole).alias(f"_opening_{c}") for c in columns],
    )
    gapped = carried.where("_gap").drop("_gap")
    sound = placed.join(gapped.select(*part), part, "left_anti")
    inside = Window.partitionBy(*part).orderBy("DateTime", order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def repaired(c: str) -> Column:
        so_far = F.last(F.when(keyed, F.col(c)), ignorenulls=True).over(inside)
        return F.when(keyed, F.coalesce(so_far, f"_before_{c}", f"_opening_{c}")).otherwise(F.col(c))

    filled = placed.join(gapped, part).withColumns({c: repaired(c) for c in columns})
    return sound.select(*readings.columns).union(filled.select(*readings.columns))


def duplicate_count(readings: DataFrame) -> DataFrame:
    """Rows beyond the first of each (Junction, DateTime); null keys count as equal."""
    return (
        readings.groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("Duplicates"))
    )


def merge_duplicates(readings: DataFrame, order: str = "ID") -> DataFrame:
    """One row per (Junction, DateTime) with the counts added up and the first ID kept.

    Readings without a junction or clock time are dropped; a key with null counts only sums to 0.
    """
    kept = {"Vehicles": F.coalesce(F.sum("Vehicles"), F.lit(0))}
    if "ID" in readings.columns:
        first = F.min("ID") if order == "ID" else F.min_by("ID", F.when(F.col("ID").isNotNull(), F.col(order)))
        kept["ID"] = first
    return (
        readings.where(F.col("Junction").isNotNull() & F.col("DateTime").isNotNull())
        .groupBy(*KEY)
        .agg(*[column.alias(name) for name, column in kept.items()])
    )


def keep_first(readings: DataFrame, order: str | None = "ID") -> DataFrame:
    """The row with the lowest ``order`` of each (Junction, DateTime), whole.

    Rows without an ``order`` come after those that have one; ties, and tables without the column, are
    settled by the other columns, so that the kept row is always one of the rows given. An aggregate rather than a
    ranking window: copies are dropped before the shuffle, so a key with very many copies costs nothing
    extra.
    """
    others = [c for c in readings.columns if c not in KEY]
    rank = [F.col(order).isNull().alias("_unknown"), F.col(order).alias("_order")] if order in others else []
    return (
        readings.groupBy(*KEY)
        .agg(F.min(F.struct(*rank, *others)).alias("_row"))
        .select(*[F.col(c) if c in KEY else F.col("_row")[c].alias(c) for c in readings.columns])
    )


def outlier_bounds(readings: DataFrame, factor: float = 3.0, spread_values: bool = False) -> DataFrame:
    """Quartiles of Vehicles over all rows and the fences factor x IQR beyond them, as one row.

    The different values meet in one task, which suits whole counts; ``spread_values`` ranks them over
    many tasks, for fractional values of which there may be as many as rows.
    """
    q = F.col("Quantiles")
    found = quantiles_by_range if spread_values else quantiles
    return (
        found(value_counts(readings), probs=(0.25, 0.75))
        .select(q[0].alias("Q1"), q[1].alias("Q3"), (q[1] - q[0]).alias("IQR"))
        .select(
            "*",
            (F.col("Q1") - factor * F.col("IQR")).alias("LowerBound"),
            (F.col("Q3") + factor * F.col("IQR")).alias("UpperBound"),
        )
    )


def _fences(readings: DataFrame, factor: float, spread_values: bool = False):
    return outlier_bounds(readings, factor, spread_values).select(F.struct("LowerBound", "UpperBound")).scalar()


def outlier_count(readings: DataFrame, factor: float = 3.0) -> DataFrame:
    """Rows outside the fences, as one row."""
    fences = _fences(readings, factor)
    outside = (F.col("Vehicles") < fences["LowerBound"]) | (F.col("Vehicles") > fences["UpperBound"])
    return readings.agg(F.count_if(outside).alias("Outliers"))


def cap_outliers(readings: DataFrame, factor: float = 3.0) -> DataFrame:
    """Clip Vehicles to the fences; null counts stay null."""
    fences = _fences(readings, factor)
    value = F.col("Vehicles").cast("double")
    clipped = F.greatest(F.least(value, fences["UpperBound"]), fences["LowerBound"])
    return readings.withColumn("Vehicles", F.when(value.isNotNull(), clipped))
