"""Exact quantiles through value counts.

A count per (key, value) collapses repeated values before the shuffle and spreads a hot key over
its values. What reaches one task afterwards is the number of *different* counts a junction has
shown, which the capacity of a road limits, not the number of its readings.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.session import scratch_folder


def value_counts(readings: DataFrame, *keys: str, value: str = "Vehicles") -> DataFrame:
    """Rows (keys, value, Readings): how often each value occurs; null is a value as well."""
    return readings.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("Readings"))


def quantiles(counts: DataFrame, *keys: str, probs: Sequence[float], value: str = "Vehicles") -> DataFrame:
    """Linear-interpolation quantiles of the non-null values per key, as the array column Quantiles."""
    return counts.groupBy(*keys).agg(quantile_array(probs, value).alias("Quantiles"))


def quantile_array(probs: Sequence[float], value: str = "Vehicles") -> Column:
    """The aggregate of value counts behind ``quantiles``."""
    return F.percentile(value, F.array(*[F.lit(float(p)) for p in probs]), F.col("Readings"))


def quantiles_by_range(
    counts: DataFrame, *, probs: Sequence[float], value: str = "Vehicles", rows_at_end: int = 100_000, ranges: int = 256
) -> DataFrame:
    """As ``quantiles`` without keys, for values of which there may be as many as readings.

    The range that holds a rank is cut into ``ranges`` parts by approximate borders and counted, again and
    again, until at most ``rows_at_end`` different values are left to be ranked. The driver sees
    one count per part; the result is exact whatever the borders are.
    """
    rows = counts.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"), "Readings")
    spark = counts.sparkSession
    total = rows.agg(F.sum("Readings")).first()[0]
    if not total:
        return spark.createDataFrame([(None,)], "Quantiles array<double>")

    def at_rank(rank: int) -> float:
        """The value of a rank counted from 0."""
        inside, skipped = rows, 0
        while True:
            found = inside.agg(
                F.count(F.lit(1)).alias("n"),
                F.percentile_approx("v", [i / ranges for i in range(1, ranges)], 10_000).alias("borders"),
            ).first()
            borders = sorted(set(found["borders"]))
            if found["n"] <= rows_at_end:
                running = F.sum("Readings").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
                return inside.withColumn("upto", running).where(F.col("upto") > rank - skipped).agg(F.min("v")).first()[0]
            part = F.size(F.filter(F.array(*[F.lit(b) for b in borders]), lambda b: b < F.col("v")))
            for row in sorted(inside.groupBy(part.alias("part")).agg(F.sum("Readings").alias("n")).collect()):
                if skipped + row["n"] > rank:
                    break
                skipped += row["n"]
            low = borders[row["part"] - 1] if row["part"] else None
            high = borders[row["part"]] if row["part"] < len(borders) else None
            if low is not None:
                inside = inside.where(F.col("v") > low)
            if high is not None:
                inside = inside.where(F.col("v") <= high)

    found = []
    for p in probs:
        place = p * (total - 1)
        low = at_rank(math.floor(place))
        high = at_rank(math.ceil(place)) if place > math.floor(place) else low
        share = place - math.floor(place)
        found.append(low * (1 - share) + high * share)
    return spark.createDataFrame([(found,)], "Quantiles array<double>")


def _written(table: DataFrame, name: str) -> DataFrame:
    """A small table of a round, written and read back, so that plans don't grow from round to round."""
    path = scratch_folder(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def quantiles_by_key(
    counts: DataFrame,
    *keys: str,
    probs: Sequence[float],
    value: str = "Vehicles",
    rows_at_end: int = 100_000,
    ranges: int = 256,
) -> DataFrame:
    """As ``quantiles``, for values of which a key may have as many as readings.

    The ranks of all keys are looked for side by side. Each is known to lie in a span of its key's values, at first in
    all of them. A span of at most ``rows_at_end`` different values is ranked in one task; a larger one is cut
    into ``ranges`` parts by approximate borders, the parts are counted, and the span becomes the part with the rank.
    The result is exact whatever the borders are. A key without values gets null.
    """
    rows = counts.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v"), "Readings")
    totals = counts.groupBy(*keys).agg(F.sum(F.when(F.col(value).isNotNull(), F.col("Readings"))).alias("total"))
    places = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("total") - 1)).alias("place")) for i, p in enumerate(probs)])
    wanted = _written(totals.select(*keys, F.explode(places).alias("w")).select(*keys, "w.*"), "quantile-places")
    ends = F.explode(F.array(F.floor("place"), F.ceil("place")))
    open_ = wanted.where("place IS NOT NULL").select(*keys, ends.alias("rank")).distinct()
    targets = _written(
        open_.select("*", F.lit(0).cast("bigint").alias("skipped"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")),
        "quantile-targets",
    )

    def same(a: DataFrame, b: DataFrame, *names: str) -> Column:
        found = F.lit(True)
        for name in names:
            found = found & a[name].eqNullSafe(b[name])
        return found

    def with_spans(spans: DataFrame) -> DataFrame:
        """The values inside the spans; a span of a key is told by the number of readings before it."""
        renamed = spans.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in spans.columns if c not in keys])
        match = F.lit(True)
        for k in keys:
            match = match & rows[k].eqNullSafe(renamed[f"_{k}"])
        inside = (F.col("low").isNull() | (F.col("v") > F.col("low"))) & (F.col("high").isNull() | (F.col("v") <= F.col("high")))
        return rows.join(renamed, match & inside).drop(*[f"_{k}" for k in keys])

    def with_targets(parts: DataFrame, *columns: str | Column) -> DataFrame:
        """Targets with the row of their span whose readings [before, upto) hold their rank."""
        held = (targets["rank"] >= parts["before"]) & (targets["rank"] < parts["upto"])
        own = [targets[c] for c in (*keys, "rank")]
        return targets.join(parts, same(targets, parts, *keys, "skipped") & held).select(*own, *columns)

    span = [*keys, "skipped"]
    line = Window.partitionBy(*span)
    found: DataFrame | None = None
    while True:
        spans = targets.select(*span, "low", "high").distinct()
        sizes = _written(with_spans(spans).groupBy(*span, "low", "high").agg(F.count(F.lit(1)).alias("n")), "quantile-spans")
        ranked = with_spans(sizes.where(F.col("n") <= rows_at_end)).withColumn(
            "upto", F.col("skipped") + F.sum("Readings").over(line.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        )
        known = _written(with_targets(ranked.withColumn("before", F.col("upto") - F.col("Readings")), ranked["v"]), "quantile-values")
        found = known if found is None else found.union(known)
        large = sizes.where(F.col("n") > rows_at_end)
        if large.isEmpty():
            break
        steps = [i / ranges for i in range(1, ranges)]
        borders = with_spans(large).groupBy(*span, "low", "high").agg(
            F.array_sort(F.array_distinct(F.percentile_approx("v", steps, 10_000))).alias("borders")
        )
        part = F.size(F.filter("borders", lambda b: b < F.col("v")))
        counted = with_spans(_written(borders, "quantile-borders")).groupBy(*span, "low", "high", "borders", part.alias("part"))
        running = F.sum("n").over(line.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
        parts = counted.agg(F.sum("Readings").alias("n")).withColumn("upto", F.col("skipped") + running)
        parts = parts.withColumn("before", F.col("upto") - F.col("n"))
        # Without a border on a side, the span ends where it did.
        low = F.coalesce(F.get("borders", F.col("part") - 1), parts["low"])
        high = F.coalesce(F.get("borders", F.col("part")), parts["high"])
        targets = _written(
            with_targets(parts, parts["before"].alias("skipped"), low.alias("low"), high.alias("high")), "quantile-targets"
        )
    at_low, at_high = (found.select(*keys, F.col("rank").alias(f"{n}_rank"), F.col("v").alias(n)) for n in ("a", "b"))
    both = wanted.join(at_low, same(wanted, at_low, *keys) & (F.floor("place") == F.col("a_rank")), "left").select(
        *[wanted[k] for k in keys], "i", "place", "a"
    )
    both = both.join(at_high, same(both, at_high, *keys) & (F.ceil("place") == F.col("b_rank")), "left").select(
        *[both[k] for k in keys], "i", (F.col("a") * (1 - (F.col("place") - F.floor("place"))) + F.col("b") * (F.col("place") - F.floor("place"))).alias("q")
    )
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("i", "q"))), lambda x: x["q"])
    return both.groupBy(*keys).agg(F.when(F.count("q") > 0, in_order).alias("Quantiles"))
