"""K-Means over junctions: restarts, choice of k, scores, prediction, persistence.

All restarts, of all numbers of clusters, go through the junctions together: a step is one aggregate over the junctions,
whose result has a row per centre and column. Start centres are drawn by hashes of junctions, so they don't
depend on how junctions are spread.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.functions.hashing import mixed
from sitepulse.operators.clusters import (
    davies_bouldin,
    moments_of,
    scaled_column,
    silhouette,
    silhouette_parts,
    squared_silhouette_parts,
    standardize,
)

#: Junctions whose distances to all centres a task holds at a time.
ROWS = 1024
#: Sums are kept in whole steps of this part of a deviation, so the order of additions doesn't matter.
STEP = 2.0**-32


@dataclass
class ClusterModel:
    """Centres in standardized columns, and the moments that standardize them."""

    columns: list[str]
    k: int
    inertia: float
    means: list[float]
    deviations: list[float]
    centers: list[list[float]]

    def assign(self, table: DataFrame) -> DataFrame:
        """(Junction, Cluster) for every row of a junction table with the model's columns: the nearest centre, the first of equals."""
        if self.k == 1:
            return table.select("Junction", F.lit(0).alias("Cluster"))
        place = [scaled_column(F.col(c), m, d) for c, m, d in zip(self.columns, self.means, self.deviations)]
        scaled = table.select("Junction", F.array(*place).alias("at"))

        def distance(center: list[float]) -> Column:
            gaps = F.zip_with("at", F.array(*[F.lit(float(v)) for v in center]), lambda a, b: (a - b) * (a - b))
            return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)

        distances = scaled.select("Junction", F.array(*[distance(c) for c in self.centers]).alias("all"))
        nearest = F.array_position("all", F.array_min("all")) - 1
        return distances.select("Junction", nearest.cast("int").alias("Cluster"))

    def save(self, path: str, profiles: DataFrame) -> None:
        """Write the model and the cluster profiles below ``path``."""
        spark = profiles.sparkSession
        row = (self.columns, self.k, self.inertia, self.means, self.deviations, self.centers)
        spark.createDataFrame([row], _MODEL).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "model"))
        profiles.write.mode("overwrite").parquet(os.path.join(path, "profiles"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> tuple[ClusterModel, DataFrame]:
        """The model and the cluster profiles written by ``save``."""
        row = spark.read.schema(_MODEL).parquet(os.path.join(path, "model")).first()
        return ClusterModel(**row.asDict()), spark.read.parquet(os.path.join(path, "profiles"))


_MODEL = (
    "columns array<string>, k int, inertia double, means array<double>, deviations array<double>, "
    "centers array<array<double>>"
)


@dataclass
class _Run:
    """One restart: its number of clusters, its seed and what it has come to."""

    k: int
    seed: int
    centers: list[np.ndarray] = field(default_factory=list)
    cost: float = np.inf
    settled: bool = False


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances as (points, centres)."""
    gaps = (points**2).sum(axis=1)[:, None] - 2 * points @ centers.T + (centers**2).sum(axis=1)
    return np.maximum(gaps, 0.0)


def _chances(junctions: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number in (0, 1) for each junction, another for each seed and step."""
    return (mixed(junctions, seed, step) + 0.5) / 2.0**64


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part.column(0).to_numpy(zero_copy_only=False), np.array(part.column(1).to_pylist(), float)


def _draw(points: DataFrame, runs: list[_Run], step: int) -> None:
    """One more start centre for every run that lacks one.

    A junction's chance is its squared distance to the nearest centre so far: among waiting times of that
    rate, made from its hash, the shortest wins. The first centre has equal chances. Where all junctions
    stand on centres, any may be drawn again.
    """
    open_runs = [(i, run.seed, np.array(run.centers)) for i, run in enumerate(runs) if len(run.centers) == step and step < run.k]

    def shortest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for junctions, at in _batches(batches):
            for i, seed, centers in open_runs:
                wait = -np.log(_chances(junctions, seed, step))
                if step:
                    rate = _distances(at, centers).min(axis=1)
                    wait = np.where(rate > 0, wait / np.maximum(rate, 1e-300), 1e300 * (1 + wait))
                least = np.lexsort((junctions, wait))[0]
                found = (float(wait[least]), int(junctions[least]), at[least].tolist())
                best[i] = min(best.get(i, found), found)
        rows = [(i, *found) for i, found in best.items()]
        columns = list(zip(*rows)) or [()] * 4
        types = (pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], ["run", "wait", "Junction", "at"])

    drawn = points.mapInArrow(shortest, "run int, wait double, Junction bigint, at array<double>")
    first = drawn.groupBy("run").agg(F.min(F.struct("wait", "Junction", "at")).alias("f")).collect()  # a row per run
    for row in first:
        runs[row["run"]].centers.append(np.array(row["f"]["at"]))


def _move(points: DataFrame, runs: list[_Run]) -> None:
    """Every centre of every open run to the mean of the junctions nearest to it; those without any stay."""
    moving = [run for run in runs if not run.settled]
    centers = np.concatenate([np.array(run.centers) for run in moving])
    starts = np.cumsum([0] + [run.k for run in moving])
    width = centers.shape[1] + 2

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centers), width), np.int64)
        for _, at in _batches(batches):
            whole = np.rint(at / STEP).astype(np.int64)
            distances = _distances(at, centers)
            for a, b in zip(starts, starts[1:]):
                nearest = distances[:, a:b].argmin(axis=1)
                cost = np.rint(distances[np.arange(len(at)), a + nearest] / STEP).astype(np.int64)
                np.add.at(sums, a + nearest, np.column_stack([np.ones(len(at), np.int64), cost, whole]))
        used = np.flatnonzero(sums[:, 0])
        for at in range(0, len(used), ROWS):
            own = used[at : at + ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array(list(sums[own]), pa.list_(pa.int64()))], ["center", "sums"]
            )

    parts = points.mapInArrow(add, "center int, sums array<bigint>")
    cells = parts.select("center", F.posexplode("sums").alias("place", "value"))
    # Decimals hold sums of any number of junctions exactly.
    total = cells.groupBy("center", "place").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
    found = np.zeros((len(centers), width), object)
    for row in total.collect():  # a row per centre and column
        found[row["center"], row["place"]] = int(row["value"])
    for run, a, b in zip(moving, starts, starts[1:]):
        fresh = [
            np.array([float(v) * STEP / n for v in rest]) if n else old
            for old, (n, _, *rest) in zip(run.centers, found[a:b])
        ]
        run.cost = float(sum(found[a:b, 1])) * STEP
        run.settled = all((new == old).all() for new, old in zip(fresh, run.centers))
        run.centers = fresh


def _best_runs(points: DataFrame, ks: Sequence[int], restarts: int, seed: int, max_iter: int) -> dict[int, _Run]:
    """The cheapest of the restarts of each k."""
    runs = [_Run(k, seed + i) for k in ks for i in range(restarts)]
    for step in range(max(ks)):
        _draw(points, runs, step)
    for _ in range(max_iter):
        if all(run.settled for run in runs):
            break
        _move(points, runs)
    return {k: min((run for run in runs if run.k == k), key=lambda run: run.cost) for k in ks}


@dataclass
class _Scaled:
    """Standardized junction vectors, cached for the steps, and their moments."""

    vectors: DataFrame
    means: list[float]
    deviations: list[float]
    n: int


def _scale(table: DataFrame, columns: Sequence[str]) -> _Scaled:
    means, deviations = moments_of(table, columns)
    place = [scaled_column(F.col(c), m, d) for c, m, d in zip(columns, means, deviations)]
    vectors = table.select("Junction", F.array(*place).alias("vector")).persist()
    return _Scaled(vectors, means, deviations, vectors.count())


def fit_clusters(
    table: DataFrame, columns: Sequence[str], k: int = 3, restarts: int = 20, seed: int = 42, max_iter: int = 300
) -> ClusterModel:
    """K-Means on the standardized columns of a junction table, the best of several restarts.

    The result depends on the table and the seed only, not on partitions. Columns must not hold nulls.
    """
    scaled = _scale(table, columns)
    try:
        if not 1 <= k <= scaled.n:
            raise ValueError(f"k must be between 1 and the number of junctions ({scaled.n}), not {k}")
        if k == 1:
            # Every column that varies adds its variance of one per junction.
            varying = sum(1 for deviation in scaled.deviations if deviation > 0)
            center = [0.0] * len(columns)
            return ClusterModel(list(columns), 1, float(varying * scaled.n), scaled.means, scaled.deviations, [center])
        run = _best_runs(scaled.vectors, [k], restarts, seed, max_iter)[k]
        centers = [c.tolist() for c in run.centers]
        return ClusterModel(list(columns), k, run.cost, scaled.means, scaled.deviations, centers)
    finally:
        scaled.vectors.unpersist()


def choose_k(
    table: DataFrame,
    columns: Sequence[str],
    max_clusters: int = 10,
    restarts: int = 10,
    seed: int = 42,
    distance: str = "euclidean",
) -> DataFrame:
    """Inertia and silhouette for k = 2 up to min(max_clusters, junctions - 1), as (k, Inertia, Silhouette).

    ``distance`` "euclidean" compares all pairs of junctions; "squared" scores squared distances, whose
    means follow from sums per cluster, in time linear in the junctions.
    """
    scaled = _scale(table, columns)
    try:
        tried = range(2, min(max_clusters + 1, scaled.n))
        if not tried:
            raise ValueError(f"choosing k needs at least 3 junctions, not {scaled.n}")
        best = _best_runs(scaled.vectors, list(tried), restarts, seed, 300)
        models = {k: np.array(run.centers) for k, run in best.items()}

        def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for junctions, at in _batches(batches):
                labels = [pa.array(_distances(at, c).argmin(axis=1), pa.int32()) for c in models.values()]
                vectors = pa.array(list(at), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(junctions), vectors, *labels], ["Junction", "vector", *names])

        names = [f"k{k}" for k in tried]
        schema = "Junction bigint, vector array<double>, " + ", ".join(f"{n} int" for n in names)
        points = scaled.vectors.mapInArrow(label, schema)
        parts = {"euclidean": silhouette_parts, "squared": squared_silhouette_parts}[distance]
        scores = (
            parts(points, {k: f"k{k}" for k in tried})
            .groupBy(F.col("number").alias("k"))
            .agg(F.avg("Silhouette").alias("Silhouette"))
            .collect()  # one row per k
        )
    finally:
        scaled.vectors.unpersist()
    found = {row["k"]: row["Silhouette"] for row in scores}
    rows = [(k, best[k].cost, found[k]) for k in tried]
    return table.sparkSession.createDataFrame(rows, "k int, Inertia double, Silhouette double")


def best_k(choice: DataFrame) -> int:
    """The k with the highest silhouette, the smallest on ties."""
    return choice.orderBy(F.desc("Silhouette"), "k").first()["k"]


def cluster_scores(table: DataFrame, columns: Sequence[str], assignments: DataFrame) -> DataFrame:
    """Silhouette and Davies-Bouldin index of assignments on the standardized columns, as one row."""
    scaled = standardize(table.select("Junction", *columns), columns).join(assignments.select("Junction", "Cluster"), "Junction")
    shape = silhouette(scaled, columns).scalar()
    return davies_bouldin(scaled, columns).select(shape.alias("Silhouette"), "Davies_Bouldin")
