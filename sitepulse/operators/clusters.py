"""Tables about given cluster assignments (Junction, Cluster): labels, profiles, shapes, scores."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.functions.numeric import round_half_even
from sitepulse.operators.patterns import as_cube, cube_mean
from sitepulse.operators.profiles import HOUR_COLUMNS, PROFILE_FEATURES
from sitepulse.session import spread

# Names of the congestion levels, from least to most traffic.
PROFILE_LABELS = ("Low Congestion", "Medium Traffic", "High Congestion")
MATRIX_LABELS_3 = ("Low Congestion", "Medium Congestion", "High Congestion")
MATRIX_LABELS_4 = (
    "Low Congestion",
    "Medium-Low Congestion",
    "Medium-High Congestion",
    "High Congestion",
)

# Junctions per block of the pairwise silhouette. Larger blocks are copied less often; distances are
# formed for a few rows at a time, so that two blocks fit in a task.
BLOCK_ROWS = 8192
ROWS_AT_A_TIME = 512
#: Share of the vectors' squares below which a squared distance is formed from differences; pairs of a step of that.
CLOSE, NEAR_PAIRS = 1e-3, 1 << 16


def matrix_labels(k: int) -> tuple[str, ...]:
    """Level names for k clusters of the feature matrix; other k than 3 and 4 are only numbered."""
    return {3: MATRIX_LABELS_3, 4: MATRIX_LABELS_4}.get(k, ())


# --- labels and profiles -------------------------------------------------------------------


def with_levels(table: DataFrame, mean: str, labels: Sequence[str], label: str) -> DataFrame:
    """Name the clusters of a table with one row per Cluster, in ascending order of a mean.

    Beyond the given names a cluster is called "Level i". The rows pass through one sorted array,
    which k bounds, so what led to the table is computed once.
    """
    names = F.array(*[F.lit(x) for x in labels]) if labels else F.array().cast("array<string>")
    rows = F.struct(F.col(mean).alias("_mean"), F.col("Cluster").alias("_cluster"), F.struct(*table.columns).alias("row"))
    order = table.where(F.col("Cluster").isNotNull()).agg(F.sort_array(F.collect_list(rows)).alias("order"))
    level = F.coalesce(F.try_element_at(names, F.col("at") + 1), F.format_string("Level %d", F.col("at") + 1))
    return order.select(F.posexplode("order").alias("at", "item")).select("item.row.*", level.alias(label))


def label_profiles(profiles: DataFrame, assignments: DataFrame, labels: Sequence[str] = PROFILE_LABELS) -> DataFrame:
    """Junction profiles with Cluster and Congestion_Level, ranked by mean Avg_Vehicles."""
    joined = profiles.join(assignments.select("Junction", "Cluster"), "Junction", "left")
    means = joined.groupBy("Cluster").agg(F.avg("Avg_Vehicles").alias("mean"))
    # One row per cluster, hence the broadcast.
    levels = with_levels(means, "mean", labels, "Congestion_Level").drop("mean")
    return joined.join(F.broadcast(levels), "Cluster", "left").select(
        *profiles.columns, "Cluster", "Congestion_Level"
    )


def cluster_centers(labelled: DataFrame) -> DataFrame:
    """Cluster centres in vehicles, which are the feature means of the members, with their label."""
    return labelled.groupBy("Cluster", F.col("Congestion_Level").alias("Label")).agg(
        *[F.avg(c).alias(c) for c in PROFILE_FEATURES]
    )


def cluster_profiles(features: DataFrame, assignments: DataFrame, n_clusters: int = 3) -> DataFrame:
    """Size, mean statistics, peak hour and congestion level per cluster of the feature matrix.

    The hourly shape is the unweighted mean over member junctions.
    """
    members = features.join(assignments.select("Junction", "Cluster"), "Junction", "left").where(
        F.col("Cluster").isNotNull()
    )
    shape = ", ".join(HOUR_COLUMNS)
    peak = F.expr(f"array_max(transform(array({shape}), (mean, hour) -> struct(mean, -hour AS back)))")
    profiles = (
        members.groupBy("Cluster")
        .agg(
            F.count(F.lit(1)).alias("NumJunctions"),
            F.avg("Vehicles_mean").alias("AvgTraffic"),
            F.avg("Vehicles_std").alias("AvgStdDev"),
            F.avg("Vehicles_max").alias("AvgMaxTraffic"),
            F.avg("Weekend_Weekday_Ratio").alias("AvgWeekendWeekdayRatio"),
            *[F.expr(f"avg({c}) AS {c}") for c in HOUR_COLUMNS],
        )
        .withColumn("_peak", peak)
        .select(
            "Cluster",
            "NumJunctions",
            "AvgTraffic",
            "AvgStdDev",
            "AvgMaxTraffic",
            (-F.col("_peak.back")).alias("PeakHour"),
            F.col("_peak.mean").alias("PeakHourAvgTraffic"),
            "AvgWeekendWeekdayRatio",
        )
    )
    return with_levels(profiles, "AvgTraffic", matrix_labels(n_clusters), "CongestionLevel")


# --- shapes and slices ---------------------------------------------------------------------


def cluster_cube(data: DataFrame, assignments: DataFrame) -> DataFrame:
    """Hour-cube cells with the cluster of their junction; a junction without one keeps null."""
    return as_cube(data).join(assignments.select("Junction", "Cluster"), "Junction", "left")


def hourly_by_cluster(data: DataFrame, assignments: DataFrame) -> DataFrame:
    """Mean per (Cluster, Hour), every reading counting once."""
    return (
        cluster_cube(data, assignments)
        .where(F.col("Cluster").isNotNull())
        .groupBy("Cluster", "Hour")
        .agg(cube_mean().alias("Avg_Vehicles"))
    )


def cluster_slice(readings: DataFrame, assignments: DataFrame, clusters: Sequence[int]) -> DataFrame:
    """Readings of the junctions that belong to the given clusters."""
    chosen = assignments.where(F.col("Cluster").isin(list(clusters))).select("Junction")
    return readings.join(chosen, "Junction", "left_semi")


def cluster_distribution(assignments: DataFrame) -> DataFrame:
    """Junctions per cluster and their share of all."""
    sizes = assignments.groupBy("Cluster").agg(F.count(F.lit(1)).alias("NumJunctions"))
    total = assignments.agg(F.count(F.lit(1)).alias("n")).scalar()
    return sizes.withColumn("Percentage", F.try_divide(F.col("NumJunctions") * 100.0, total.cast("double")))


def first_members(assignments: DataFrame, n: int = 5) -> DataFrame:
    """The n members with the lowest junction ids of every cluster."""
    line = Window.partitionBy("Cluster").orderBy("Junction")
    return assignments.withColumn("_at", F.row_number().over(line)).where(F.col("_at") <= n).drop("_at")


def cluster_member_curves(data: DataFrame, assignments: DataFrame, max_junctions: int = 5) -> DataFrame:
    """Hourly means of the first members of every cluster."""
    chosen = first_members(assignments, max_junctions).select("Junction", "Cluster")
    return (
        as_cube(data)
        .join(chosen, "Junction")
        .groupBy("Cluster", "Junction", "Hour")
        .agg(cube_mean().alias("Avg_Vehicles"))
    )


def junction_lookup(assignments: DataFrame, profiles: DataFrame) -> DataFrame:
    """Cluster, congestion level and mean traffic of the cluster of every junction."""
    return assignments.join(profiles, "Cluster").select("Junction", "Cluster", "CongestionLevel", "AvgTraffic", "PeakHour")


def profile_points(labelled: DataFrame) -> DataFrame:
    """Chart points per junction: mean against maximum, morning against evening, with the label."""
    return labelled.select("Junction", *PROFILE_FEATURES, "Cluster", "Congestion_Level")


def cluster_profile_bars(profiles: DataFrame) -> DataFrame:
    """Chart bars per cluster: traffic, peak hour, variability and size."""
    return profiles.select("Cluster", "CongestionLevel", "AvgTraffic", "PeakHour", "AvgStdDev", "NumJunctions")


def overview_metrics(readings: DataFrame, assignments: DataFrame, profiles: DataFrame, rules: DataFrame) -> DataFrame:
    """Numbers of junctions, records, clusters and rules, as one row."""
    junctions = assignments.select("Junction").distinct().agg(F.count("Junction")).scalar()
    clusters = profiles.select("Cluster").distinct().agg(F.count("Cluster")).scalar()
    n_rules = rules.agg(F.count(F.lit(1))).scalar()
    return readings.agg(F.count(F.lit(1)).alias("Total_Records")).select(
        junctions.alias("Total_Junctions"), "Total_Records", clusters.alias("Num_Clusters"), n_rules.alias("Num_Rules")
    )


# --- scores --------------------------------------------------------------------------------


def moments_of(table: DataFrame, columns: Sequence[str]) -> tuple[list[float], list[float]]:
    """Means and population deviations: one row of two numbers per column, fetched like any fitted scaler."""
    row = table.agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.avg, F.stddev_pop) for c in columns]).first()
    return list(row[: len(columns)]), list(row[len(columns) :])


def scaled_column(column: Column, mean: float, deviation: float) -> Column:
    return (column - F.lit(mean)) / F.lit(deviation) if deviation else F.lit(0.0)


def standardize(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as (x - mean) / population deviation; a column without variance becomes 0."""
    means, deviations = moments_of(table, columns)
    return table.withColumns({c: scaled_column(F.col(c), m, d) for c, m, d in zip(columns, means, deviations)})


def pair_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x and of y, as (x, y).

    They come from one product of matrices; pairs so close that it loses digits are formed anew from their differences.
    """
    lengths = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)
    squares = lengths - 2 * (x @ y.T)
    near = np.flatnonzero(squares < CLOSE * lengths)
    for at in range(0, len(near), NEAR_PAIRS):
        some = near[at : at + NEAR_PAIRS]
        i, j = np.divmod(some, len(y))
        squares.ravel()[some] = ((x[i] - y[j]) ** 2).sum(axis=1)
    return np.sqrt(squares)


def silhouette_parts(points: DataFrame, label_sets: dict[int, str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Silhouette of every junction for several labelings, keyed by their number in ``label_sets``.

    ``points`` has Junction, the array column ``vector`` and one label column per entry.
    The score needs the Euclidean distance between any two junctions. Junctions are hashed into
    blocks of about ``block_rows``; a task receives two blocks, forms their distance matrix in
    memory and returns only the sums per (junction, cluster), so no pair becomes a row and no
    task or driver holds all junctions. All labelings share the distances.
    """
    numbers, names = list(label_sets), list(label_sets.values())
    n = F.count(F.lit(1))
    # A few thousand junctions are still cut into some blocks, to share the work.
    wanted = F.greatest(F.ceil(n / block_rows), F.least(F.ceil(n / 256), F.lit(6)), F.lit(1))
    blocks = points.agg(wanted.cast("int")).scalar()
    placed = points.select(
        "Junction", "vector", F.array(*[F.col(c).cast("int") for c in names]).alias("labels")
    ).withColumn("_blocks", blocks)
    own = F.pmod(F.xxhash64("Junction"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    # Two blocks meet once, with the sums of both sides.
    dealt = placed.select("Junction", "vector", "labels", own.alias("block"), other.alias("other")).select(
        "Junction", "vector", "labels", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")
    )

    def sums(group: pd.DataFrame) -> pd.DataFrame:
        columns = ["Junction", "number", "Cluster", "distance"]
        first = group["block"] == group["a"]
        ours = group[first]
        theirs = ours if group["a"].iloc[0] == group["b"].iloc[0] else group[~first]
        if ours.empty or theirs.empty:
            return pd.DataFrame(columns=columns)
        x, y = np.stack(ours["vector"]), np.stack(theirs["vector"])
        our_labels, their_labels = np.stack(ours["labels"]), np.stack(theirs["labels"])
        junctions, facing = ours["Junction"].to_numpy(), theirs["Junction"].to_numpy()
        parts, back = [], {}
        for start in range(0, len(x), ROWS_AT_A_TIME):
            some = slice(start, start + ROWS_AT_A_TIME)
            distances = pair_distances(x[some], y)
            for at, number in enumerate(numbers):
                for cluster in np.unique(their_labels[:, at]):
                    total = distances[:, their_labels[:, at] == cluster].sum(axis=1)
                    parts.append(
                        pd.DataFrame({"Junction": junctions[some], "number": number, "Cluster": cluster, "distance": total})
                    )
                if theirs is not ours:
                    for cluster in np.unique(our_labels[some, at]):
                        total = distances[our_labels[some, at] == cluster].sum(axis=0)
                        back[number, cluster] = back.get((number, cluster), 0.0) + total
        for (number, cluster), total in back.items():
            parts.append(pd.DataFrame({"Junction": facing, "number": number, "Cluster": cluster, "distance": total}))
        return pd.concat(parts)[columns]

    totals = (
        spread(dealt, "a", "b")
        .groupBy("a", "b")
        .applyInPandas(sums, "Junction bigint, number int, Cluster int, distance double")
        .groupBy("Junction", "number", "Cluster")
        .agg(F.sum("distance").alias("distance"))
    )
    return _scores(points, label_sets, totals)


def squared_silhouette_parts(points: DataFrame, label_sets: dict[int, str]) -> DataFrame:
    """As ``silhouette_parts`` with squared distances, in time linear in the junctions.

    The squared distances of a point to a cluster add up to size * |x|^2 - 2 x * sum(y) + sum(|y|^2), so one
    row per cluster stands for its members. That row goes to every task: k rows per labeling.
    """
    sets = F.array(*[F.struct(F.lit(n).alias("number"), F.col(c).cast("int").alias("own")) for n, c in label_sets.items()])
    member = points.select("Junction", "vector", F.explode(sets).alias("s")).select("Junction", "vector", "s.number", "s.own")
    square = F.aggregate("vector", F.lit(0.0), lambda t, v: t + v * v)
    sums = (
        member.select("number", F.col("own").alias("Cluster"), square.alias("square"), F.posexplode("vector").alias("axis", "v"))
        .groupBy("number", "Cluster", "axis")
        .agg(F.sum("v").alias("total"), F.sum("square").alias("squares"), F.count(F.lit(1)).alias("size"))
        .groupBy("number", "Cluster")
        .agg(
            F.transform(F.sort_array(F.collect_list(F.struct("axis", "total"))), lambda x: x["total"]).alias("totals"),
            F.max("squares").alias("squares"),
            F.max("size").alias("size"),
        )
    )
    product = F.aggregate(F.zip_with("vector", "totals", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    totals = member.join(F.broadcast(sums), "number").select(
        "Junction", "number", "Cluster", (F.col("size") * square - 2 * product + F.col("squares")).alias("distance")
    )
    return _scores(points, label_sets, totals)


def _scores(points: DataFrame, label_sets: dict[int, str], totals: DataFrame) -> DataFrame:
    """Scores from the sums of distances (Junction, number, Cluster, distance)."""
    member = points.select(
        "Junction",
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("number"), F.col(c).cast("int").alias("own")) for n, c in label_sets.items()])
        ).alias("s"),
    ).select("Junction", "s.number", "s.own")
    sizes = member.groupBy("number", F.col("own").alias("Cluster")).agg(F.count(F.lit(1)).alias("size"))
    same = F.col("Cluster") == F.col("own")
    scored = (
        totals.join(sizes, ["number", "Cluster"])
        .join(member, ["Junction", "number"])
        .groupBy("Junction", "number", "own")
        .agg(
            F.max(F.when(same, F.try_divide(F.col("distance"), F.col("size") - 1))).alias("inner"),
            F.min(F.when(~same, F.col("distance") / F.col("size"))).alias("nearest"),
            F.max(F.when(same, F.col("size"))).alias("size"),
        )
    )
    value = F.try_divide(F.col("nearest") - F.col("inner"), F.greatest("inner", "nearest"))
    return scored.select(
        "Junction",
        F.col("own").alias("Cluster"),
        "number",
        # Alone in its cluster, or among identical points: 0. Without a second cluster: null.
        F.when(F.col("nearest").isNotNull(), F.when(F.col("size") == 1, 0.0).otherwise(F.coalesce(value, F.lit(0.0)))).alias(
            "Silhouette"
        ),
    )


def silhouette(
    table: DataFrame, columns: Sequence[str], block_rows: int = BLOCK_ROWS, distance: str = "euclidean"
) -> DataFrame:
    """Mean silhouette of a table with Junction, Cluster and feature columns, as one row.

    ``distance`` is "euclidean", over all pairs, or "squared", over squared distances and linear. Null when there is one cluster, or as many clusters as junctions.
    """
    points = table.select("Junction", "Cluster", F.array(*[F.col(c).cast("double") for c in columns]).alias("vector"))
    if distance == "squared":
        parts = squared_silhouette_parts(points, {0: "Cluster"})
    elif distance == "euclidean":
        parts = silhouette_parts(points, {0: "Cluster"}, block_rows)
    else:
        raise ValueError(f"unknown distance {distance!r}: use euclidean or squared")
    return (
        parts.groupBy("Cluster")
        .agg(F.sum("Silhouette").alias("total"), F.count(F.lit(1)).alias("n"))
        .agg(
            F.when(F.count(F.lit(1)) < F.sum("n"), F.try_divide(F.sum("total"), F.sum("n").cast("double"))).alias("Silhouette")
        )
    )


def davies_bouldin(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Davies-Bouldin index of a table with Junction, Cluster and feature columns, as one row.

    Null when there is one cluster, or as many clusters as junctions.
    """
    points = table.select("Junction", "Cluster", *[F.col(c).cast("double") for c in columns])
    centres = points.groupBy("Cluster").agg(*[F.avg(c).alias(f"_c_{c}") for c in columns])
    gap = F.sqrt(sum((F.pow(F.col(c) - F.col(f"_c_{c}"), F.lit(2)) for c in columns), F.lit(0.0)))
    # Centres and radii are one row per cluster: comparing them as one array is bounded by k.
    radii = (
        points.join(F.broadcast(centres), "Cluster")
        .groupBy("Cluster")
        .agg(
            F.avg(gap).alias("radius"),
            F.count(F.lit(1)).alias("size"),
            F.first(F.array(*[F.col(f"_c_{c}") for c in columns])).alias("centre"),
        )
        .agg(F.collect_list(F.struct("Cluster", "radius", "centre")).alias("all"), F.sum("size").alias("n"))
    )

    def apart(a, b):
        squares = F.zip_with(a["centre"], b["centre"], lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))

    worst = F.transform(
        "all",
        lambda a: F.array_max(
            F.transform(
                F.filter("all", lambda b: b["Cluster"] != a["Cluster"]),
                # Centres that coincide contribute nothing.
                lambda b: F.coalesce(F.try_divide(a["radius"] + b["radius"], apart(a, b)), F.lit(0.0)),
            )
        ),
    )
    mean = F.aggregate(worst, F.lit(0.0), lambda total, w: total + w) / F.size("all")
    return radii.select(
        F.when((F.size("all") > 1) & (F.size("all") < F.col("n")), mean).alias("Davies_Bouldin")
    )


def display_profiles(profiles: DataFrame) -> DataFrame:
    """The overview table of clusters: one decimal for traffic, the peak hour as "H:00"."""
    return profiles.select(
        "Cluster",
        F.col("CongestionLevel").alias("Congestion Level"),
        F.col("NumJunctions").alias("Junctions"),
        round_half_even(F.col("AvgTraffic"), 1).alias("Avg Traffic"),
        F.format_string("%d:00", F.col("PeakHour").cast("int")).alias("Peak Hour"),
    )
