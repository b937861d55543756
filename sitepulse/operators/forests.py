"""A random forest of its own for each of any number of junctions, and forests as plain arrays.

Features are cut into bins at quantiles of the junction's own values, and every tree weighs rows by a hash of junction,
row number and tree, so the same data give the same forest however they are spread. Junctions of up to
``block_rows`` training rows are grown side by side, each in the task that has its rows. Larger ones are grown level by
level: every block of rows adds up its part of the counts keyed by (junction, tree, node, feature, bin), Spark adds
the parts, and each node takes its best split, for all of these junctions in one job per level.

A tree is a row of arrays in level order: feature (-1 for a leaf), threshold, place of the left child (the right one
follows it), mean, and what the split gains.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sitepulse.functions.hashing import mixed
from sitepulse.session import scratch_folder, spread
from sitepulse.sources.tables import write_buckets

FOREST = (
    "Junction bigint, Tree int, Feature array<int>, Threshold array<double>, Left array<int>, "
    "Mean array<double>, Gain array<double>"
)
#: Training rows that one task holds of a junction.
BLOCK_ROWS = 1 << 16
BINS = 32
#: A split must gain this share of the node's sum of squares, so that rounding alone makes none.
LEAST_GAIN = 1e-9
#: Rows of a batch times trees is what a step of the roll-out holds in memory.
STATES = 1024

# Cumulative chances of 0, 1, ... draws of a row when as many rows are drawn as there are.
_DRAWS = np.cumsum([np.exp(-1.0)] + [np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(1, 12)])


def bag_weights(junction: int, row_no: np.ndarray, trees: int, seed: int | None) -> np.ndarray:
    """How often each tree has each row, as (trees, rows); the junction's first row is in every tree.

    Without a seed every tree has every row once.
    """
    if seed is None:
        return np.ones((trees, len(row_no)), np.int64)
    drawn = mixed(seed, junction, np.arange(trees)[:, None], row_no[None, :])
    weights = np.searchsorted(_DRAWS, drawn / 2.0**64, side="right").astype(np.int64)
    weights[:, row_no == 1] = np.maximum(weights[:, row_no == 1], 1)
    return weights


def thresholds_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Borders between bins, half-way between neighbouring values: between all of few values, else at quantiles."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) <= bins:
        bin_of = np.arange(len(distinct))
    else:
        bin_of = (np.cumsum(counts) - 1) * bins // len(values)
    last = np.flatnonzero(np.diff(bin_of))
    return (distinct[last] + distinct[last + 1]) / 2


@dataclass
class Nodes:
    """Nodes of several trees, one entry each; the children of node h are 2 h and 2 h + 1, the root is 1."""

    tree: np.ndarray
    place: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    mean: np.ndarray
    gain: np.ndarray


def best_splits(counts: list[np.ndarray], sums: list[np.ndarray], leaves: bool) -> tuple[np.ndarray, ...]:
    """Feature, bin, gain and mean of nodes from their weights and sums per feature as (nodes, bins).

    Rows up to the bin go left. The first of equal splits wins, by feature, then by bin. With ``leaves``, or
    where nothing is gained, the feature is -1.
    """
    weight, total = counts[0].sum(axis=1), sums[0].sum(axis=1)
    best = np.full(len(weight), -np.inf)
    feature, cut = np.full(len(weight), -1), np.zeros(len(weight), np.int64)
    for f, (w, s) in enumerate(zip(counts, sums)):
        if w.shape[1] < 2 or leaves:
            continue
        left, left_sum = w.cumsum(axis=1)[:, :-1], s.cumsum(axis=1)[:, :-1]
        right, right_sum = weight[:, None] - left, total[:, None] - left_sum
        both = (left > 0) & (right > 0)
        score = np.where(both, left_sum**2 / np.maximum(left, 1) + right_sum**2 / np.maximum(right, 1), -np.inf)
        at = score.argmax(axis=1)
        found = score[np.arange(len(at)), at]
        better = found > best
        best, feature, cut = np.where(better, found, best), np.where(better, f, feature), np.where(better, at, cut)
    return _chosen(best, feature, cut, weight, total)


def _chosen(best: np.ndarray, feature: np.ndarray, cut: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature, bin, gain and mean of nodes with their best splits; the feature is -1 where nothing is gained."""
    whole = total**2 / weight
    gain = best - whole
    feature[~(gain > LEAST_GAIN * np.maximum(whole, 1))] = -1
    return feature, cut, np.where(feature >= 0, gain, 0.0), total / weight


def best_of_cells(x: np.ndarray, slot: np.ndarray, w: np.ndarray, s: np.ndarray, nodes: int) -> tuple[np.ndarray, ...]:
    """As ``best_splits``, for weights and sums in whole numbers, from the bins (features, entries) of a level's entries.

    All features go in one pass, and only bins that hold something are looked at. Sums run on over all nodes and
    lose what came before a node, which is exact in whole numbers alone.
    """
    features, size = len(x), int(x.max(initial=0)) + 1
    key = ((np.arange(features)[:, None] * nodes + slot) * size + x).ravel()
    counts = np.bincount(key, np.tile(w, features), features * nodes * size)
    held = np.flatnonzero(counts)
    own, own_sum = counts[held], np.bincount(key, np.tile(s, features), len(counts))[held]
    line = held // size  # feature and node; every node has entries
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    left, left_sum = own.cumsum(), own_sum.cumsum()
    weight, total = np.bincount(slot, w, nodes), np.bincount(slot, s, nodes)
    runs = np.diff(np.append(first, len(held)))
    left -= np.repeat((left - own)[first], runs)
    left_sum -= np.repeat((left_sum - own_sum)[first], runs)
    right, right_sum = np.repeat(np.tile(weight, features), runs) - left, np.repeat(np.tile(total, features), runs) - left_sum
    score = np.where(right > 0, left_sum**2 / left + right_sum**2 / np.maximum(right, 1), -np.inf)
    found = np.maximum.reduceat(score, first)
    at = np.zeros(len(first), np.int64)
    top = np.flatnonzero(score == np.repeat(found, runs))[::-1]
    at[line[top]] = held[top] % size  # the first of equal bins is written last
    found, at = found.reshape(features, nodes), at.reshape(features, nodes)
    feature = found.argmax(axis=0)
    chosen = np.arange(nodes)
    return _chosen(found[feature, chosen], feature, at[feature, chosen], weight, total)


def grow(x: np.ndarray, bins: list[int], y: np.ndarray, weights: np.ndarray, depth: int) -> Nodes:
    """All trees of a junction from its binned features (rows, features), a level at a time."""
    tree, place = np.arange(len(weights)), np.ones(len(weights), np.int64)
    slot, row = np.nonzero(weights)
    w = weights[slot, row].astype(float)
    # Whole numbers whose sums over all trees a float holds exactly.
    exact = bool((y == np.rint(y)).all()) and float((w * np.abs(y[row])).sum()) < 2.0**53
    across = np.ascontiguousarray(x.T)
    levels: list[Nodes] = []
    for level in range(depth + 1):
        if exact and level < depth:
            feature, cut, gain, mean = best_of_cells(across[:, row], slot, w, w * y[row], len(tree))
        else:
            counts, sums = [], []
            for f, size in enumerate(bins):
                key = slot * size + x[row, f]
                counts.append(np.bincount(key, w, len(tree) * size).reshape(len(tree), size))
                sums.append(np.bincount(key, w * y[row], len(tree) * size).reshape(len(tree), size))
            feature, cut, gain, mean = best_splits(counts, sums, level == depth)
        levels.append(Nodes(tree, place, feature, cut, mean, gain))
        goes_on = feature >= 0
        if not goes_on.any():
            break
        stays = goes_on[slot]
        slot, row, w = slot[stays], row[stays], w[stays]
        right = x[row, feature[slot]] > cut[slot]
        slot = 2 * (np.cumsum(goes_on) - 1)[slot] + right
        tree, place = np.repeat(tree[goes_on], 2), (2 * place[goes_on][:, None] + [0, 1]).ravel()
    return Nodes(*(np.concatenate([getattr(n, name) for n in levels]) for name in Nodes.__annotations__))


def as_table(junction: int, nodes: Nodes, thresholds: list[np.ndarray], schema: pa.Schema) -> pa.Table:
    """One row of arrays per tree."""
    order = np.lexsort((nodes.place, nodes.tree))
    tree, place, feature, cut = (a[order] for a in (nodes.tree, nodes.place, nodes.feature, nodes.bin))
    inner = feature >= 0
    first_border = np.cumsum([0, *map(len, thresholds)])
    borders = np.concatenate([*thresholds, [0.0]])  # the last one is for leaves
    border = borders[np.where(inner, first_border[np.maximum(feature, 0)] + cut, len(borders) - 1)]
    numbers, starts, at = np.unique(tree, return_index=True, return_inverse=True)
    width = 2 * int(place.max(initial=0)) + 2
    child = np.searchsorted(at * width + place, at * width + 2 * place) - starts[at]
    offsets = pa.array(np.append(starts, len(tree)), pa.int32())
    lists = {
        "Feature": feature,
        "Threshold": border,
        "Left": np.where(inner, child, -1),
        "Mean": nodes.mean[order],
        "Gain": nodes.gain[order],
    }
    plain = {"Junction": np.full(len(numbers), junction), "Tree": numbers}
    columns = [
        pa.array(plain[f.name]).cast(f.type)
        if f.name in plain
        else pa.ListArray.from_arrays(offsets, pa.array(lists[f.name]).cast(f.type.value_type)).cast(f.type)
        for f in schema
    ]
    return pa.table(columns, schema=schema)


@dataclass
class Forest:
    """Trees one after the other in flat arrays; ``left`` counts from the first node of all."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    mean: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees for rows of features, given as (rows, features)."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                break
            right = x[rows, np.maximum(feature, 0)] > self.threshold[node]
            node = np.where(inner, self.left[node] + right, node)
        return self.mean[node].sum(axis=1) / len(self.roots)


def _joined(trees: pa.Table, depth: int = 64) -> Forest:
    def flat(name: str) -> np.ndarray:
        return np.concatenate([chunk.flatten().to_numpy() for chunk in trees.column(name).chunks])

    sizes = np.concatenate([chunk.value_lengths().to_numpy() for chunk in trees.column("Feature").chunks]).astype(np.int64)
    roots = np.cumsum(sizes) - sizes
    left = flat("Left") + np.repeat(roots, sizes)
    return Forest(roots, flat("Feature"), flat("Threshold"), left, flat("Mean"), depth)


def flat_forest(model: RandomForestRegressionModel, spark) -> Forest:
    """The trees of a fitted model, read from what it saves: at most trees x 2^(depth + 1) nodes."""
    path = scratch_folder(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID",
        "nodeData.id",
        F.col("nodeData.prediction").alias("mean"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )
    table = nodes.toPandas().sort_values(["treeID", "id"]).reset_index(drop=True)
    _, roots = np.unique(table["treeID"], return_index=True)
    inner = table["left"].to_numpy() >= 0
    start = roots[np.searchsorted(np.unique(table["treeID"]), table["treeID"])]
    # Children get neighbouring places: nodes are put in the order in which their parents refer to them.
    children = np.stack([table["left"] + start, table["right"] + start], axis=1)[inner].ravel()
    order = np.concatenate([roots, children])
    place = np.empty(len(table), np.int64)
    place[order] = np.arange(len(order))
    feature = np.where(inner, table["feature"], -1)[order]
    left = place[np.where(inner, table["left"] + start, 0)][order]
    threshold, mean = table["threshold"].fillna(0.0).to_numpy()[order], table["mean"].to_numpy()[order]
    return Forest(place[roots], feature, threshold, left, mean, model.getMaxDepth())


# --- training ------------------------------------------------------------------------------


def _arrow(spark, schema: str) -> tuple[StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = spark.createDataFrame([], schema).schema
    return kinds, to_arrow_schema(kinds)


def _small_forests(rows: DataFrame, features: list[str], trees: int, depth: int, seed: int | None, bins: int) -> DataFrame:
    kinds, arrow = _arrow(rows.sparkSession, FOREST)

    def fit(table: pa.Table) -> pa.Table:
        junction = table.column("Junction")[0].as_py()
        raw = np.stack([table.column(f).to_numpy().astype(float) for f in features], axis=1)
        borders = [thresholds_of(raw[:, f], bins) for f in range(len(features))]
        x = np.stack([np.searchsorted(b, raw[:, f]) for f, b in enumerate(borders)], axis=1)
        weights = bag_weights(junction, table.column("RowNo").to_numpy(), trees, seed)
        y = table.column("Vehicles").to_numpy().astype(float)
        nodes = grow(x, [len(b) + 1 for b in borders], y, weights, depth)
        return as_table(junction, nodes, borders, arrow)

    return spread(rows, "Junction").groupBy("Junction").applyInArrow(fit, kinds)


def feature_borders(rows: DataFrame, features: list[str], bins: int) -> DataFrame:
    """(Junction, Borders): per feature the borders between bins, from counts of the different values."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).cast("double").alias("v")) for i, f in enumerate(features)]))
    counts = rows.select("Junction", each.alias("e")).groupBy("Junction", "e.f", "e.v").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("Junction", "f")
    line = own.orderBy("v")
    ranked = counts.select(
        "Junction",
        "f",
        "v",
        F.row_number().over(line).alias("no"),
        F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(own).alias("whole"),
        F.count(F.lit(1)).over(own).alias("different"),
    )
    dealt = ranked.withColumn("bin", F.expr(f"if(different <= {bins}, no, (upto - 1) * {bins} div whole)"))
    following = dealt.withColumns({"next_v": F.lead("v").over(line), "next_bin": F.lead("bin").over(line)})
    border = F.when(F.col("bin") != F.col("next_bin"), (F.col("v") + F.col("next_v")) / 2)
    per_feature = following.groupBy("Junction", "f").agg(F.sort_array(F.collect_list(border)).alias("b"))
    lists = F.sort_array(F.collect_list(F.struct("f", "b")))
    return per_feature.groupBy("Junction").agg(F.transform(lists, lambda x: x["b"]).alias("Borders"))


_NODE = "Junction bigint, Tree int, Place bigint, Feature int, Bin int, Mean double, Gain double"


def _level_counts(blocks: DataFrame, nodes: DataFrame, level: int, trees: int, seed: int | None) -> DataFrame:
    """(Junction, Tree, Place, f, bin, w, s): weights and sums of the nodes of a level, from all blocks."""
    kinds, arrow = _arrow(blocks.sparkSession, "Junction bigint, Tree int, Place bigint, f int, bin int, w double, s double")
    width = 1 << level

    def count(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return arrow.empty_table()
        junction = rows.column("Junction")[0].as_py()
        x = np.array(rows.column("X").to_pylist(), np.int64)
        y = rows.column("Vehicles").to_numpy().astype(float)
        weights = bag_weights(junction, rows.column("RowNo").to_numpy(), trees, seed)
        tree, row = np.nonzero(weights)
        w, place = weights[tree, row].astype(float), np.ones(len(tree), np.int64)
        split = np.full((trees, max(width, 2)), -1)
        cut = np.zeros((trees, max(width, 2)), np.int64)
        at = known.column("Tree").to_numpy(), known.column("Place").to_numpy()
        split[at], cut[at] = known.column("Feature").to_numpy(), known.column("Bin").to_numpy()
        for _ in range(level):  # down to this level, without the rows that end in a leaf before
            f = split[tree, place]
            goes_on = f >= 0
            tree, row, w, place, f = (a[goes_on] for a in (tree, row, w, place, f))
            place = 2 * place + (x[row, f] > cut[tree, place])
        node = tree * 2 * width + place
        out = []
        for f in range(x.shape[1]):
            size = int(x[:, f].max()) + 1
            key, inverse = np.unique(node * size + x[row, f], return_inverse=True)
            n, b = key // size, key % size
            columns = [
                np.full(len(key), junction), n // (2 * width), n % (2 * width), np.full(len(key), f), b,
                np.bincount(inverse, w, len(key)), np.bincount(inverse, w * y[row], len(key)),
            ]
            out.append(pa.table([pa.array(c).cast(t.type) for c, t in zip(columns, arrow)], schema=arrow))
        return pa.concat_tables(out)

    shared = blocks.select("Junction", "Block").distinct().join(nodes.withColumnRenamed("Junction", "J"), F.col("Junction") == F.col("J")).drop("J")
    parts = blocks.groupBy("Junction", "Block").cogroup(
        shared.select(F.col("Junction").alias("j"), F.col("Block").alias("b"), "Tree", "Place", "Feature", "Bin").groupBy("j", "b")
    )
    added = parts.applyInArrow(count, kinds).groupBy("Junction", "Tree", "Place", "f", "bin")
    return added.agg(F.sum("w").alias("w"), F.sum("s").alias("s"))


def _level_splits(counts: DataFrame, features: int, bins: int, leaves: bool) -> DataFrame:
    """The nodes of a level; a task sees one tree of a junction at a time, at most 2^level nodes x features x bins."""
    kinds, arrow = _arrow(counts.sparkSession, _NODE)

    def choose(table: pa.Table) -> pa.Table:
        places, slot = np.unique(table.column("Place").to_numpy(), return_inverse=True)
        feature, cell = table.column("f").to_numpy(), table.column("bin").to_numpy()
        grids = []
        for name in ("w", "s"):
            grid = np.zeros((features, len(places), bins))
            grid[feature, slot, cell] = table.column(name).to_numpy()
            grids.append(list(grid))
        chosen, cut, gain, mean = best_splits(*grids, leaves)
        first = [np.full(len(places), table.column(c)[0].as_py()) for c in ("Junction", "Tree")]
        columns = [*first, places, chosen, cut, mean, gain]
        return pa.table([pa.array(c).cast(t.type) for c, t in zip(columns, arrow)], schema=arrow)

    return counts.groupBy("Junction", "Tree").applyInArrow(choose, kinds)


def _large_forests(
    rows: DataFrame, features: list[str], trees: int, depth: int, seed: int | None, bins: int, block_rows: int
) -> DataFrame:
    spark = rows.sparkSession
    borders = feature_borders(rows, features, bins)
    def bin_of(place: int, feature: str) -> Column:
        return F.size(F.filter(F.col("Borders")[place], lambda border: border < F.col(feature)))

    binned = F.array(*[bin_of(i, f) for i, f in enumerate(features)])
    block = F.floor((F.col("RowNo") - 1) / block_rows).cast("int")
    # Bucketed, so that the rows stay where they are in every level.
    blocks = write_buckets(
        rows.join(borders, "Junction").select("Junction", block.alias("Block"), "RowNo", "Vehicles", binned.alias("X")),
        scratch_folder(spark, "forest-blocks"),
        ["Junction", "Block"],
    )
    nodes = spark.createDataFrame([], _NODE)
    for level in range(depth + 1):
        counts = _level_counts(blocks, nodes.where("Feature >= 0"), level, trees, seed)
        path = scratch_folder(spark, "forest-level")
        _level_splits(counts, len(features), bins, level == depth).write.parquet(path)
        fresh = spark.read.schema(_NODE).parquet(path)
        nodes = nodes.union(fresh)
        if fresh.where("Feature >= 0").isEmpty():
            break
    kinds, arrow = _arrow(spark, FOREST)

    def assemble(table: pa.Table) -> pa.Table:
        columns = (table.column(c).to_numpy() for c in ("Tree", "Place", "Feature", "Bin", "Mean", "Gain"))
        own = [np.array(b) for b in table.column("Borders")[0].as_py()]
        return as_table(table.column("Junction")[0].as_py(), Nodes(*columns), own, arrow)

    return nodes.join(borders, "Junction").groupBy("Junction", "Tree").applyInArrow(assemble, kinds)


def train_sites(
    split: DataFrame,
    features: list[str],
    trees: int = 100,
    depth: int = 10,
    seed: int | None = 42,
    bins: int = BINS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """A row per junction and tree, for every junction with a training side; see ``FOREST`` for the columns.

    ``split`` comes from ``forecast.training_matrix``. The number of jobs depends on the depth alone. ``seed`` draws
    the rows of each tree; without one every tree has all of them.
    """
    train = split.where(F.col("Side") == "train").select("Junction", "RowNo", "TrainRows", "Vehicles", *features)
    small = _small_forests(train.where(F.col("TrainRows") <= block_rows), features, trees, depth, seed, bins)
    large = train.where(F.col("TrainRows") > block_rows)
    if large.isEmpty():
        return small
    return small.union(_large_forests(large.drop("TrainRows"), features, trees, depth, seed, bins, block_rows))


# --- use -----------------------------------------------------------------------------------


def predict_sites(forests: DataFrame, rows: DataFrame, features: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of the junctions that have a forest, with Predicted; a task sees ``block_rows`` rows of a junction at a time."""
    spark = rows.sparkSession
    placed = rows.withColumn("_block", F.floor((F.col("RowNo") - 1) / block_rows))
    shared = placed.select("Junction", "_block").distinct().join(forests, "Junction")
    kinds = StructType([*rows.schema.fields, StructField("Predicted", DoubleType())])

    def predict(own: pa.Table, trees: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)
        if not own.num_rows or not trees.num_rows:
            return arrow.empty_table()
        x = np.stack([own.column(f).to_numpy().astype(float) for f in features], axis=1)
        forest = _joined(trees)
        guess = np.concatenate([forest.predict(x[at : at + STATES]) for at in range(0, len(x), STATES)])
        return own.drop_columns(["_block"]).append_column("Predicted", pa.array(guess)).cast(arrow)

    trees = shared.select(F.col("Junction").alias("j"), F.col("_block").alias("b"), "Feature", "Threshold", "Left", "Mean")
    own = spread(placed, "Junction", "_block").groupBy("Junction", "_block")
    return own.cogroup(spread(trees, "j", "b").groupBy("j", "b")).applyInArrow(predict, kinds)


def site_importance(forests: DataFrame, features: list[str]) -> DataFrame:
    """Importance of each feature per junction: its share of what the splits of a tree gain, averaged over the trees.

    A forest without any split has none; its features get 0.
    """

    def gain_of(place: int) -> Column:
        add = lambda total, x: total + F.when(x["Feature"] == place, x["Gain"]).otherwise(0.0)
        return F.aggregate(F.arrays_zip("Feature", "Gain"), F.lit(0.0), add)

    gains = [gain_of(i) for i in range(len(features))]
    whole = F.aggregate("Gain", F.lit(0.0), lambda a, b: a + b)
    shares = [F.when(whole > 0, g / whole).otherwise(0.0) for g in gains]
    summed = forests.groupBy("Junction").agg(*[F.sum(s).alias(f"_{i}") for i, s in enumerate(shares)])
    total = sum((F.col(f"_{i}") for i in range(len(features))), F.lit(0.0))
    each = F.explode(
        F.array(
            *[
                F.struct(F.lit(f).alias("Feature"), F.when(total > 0, F.col(f"_{i}") / total).otherwise(0.0).alias("Importance"))
                for i, f in enumerate(features)
            ]
        )
    )
    return summed.select("Junction", each.alias("e")).select("Junction", "e.*")


def roll(forest: Forest, calendar: np.ndarray, day: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Counts of the next steps, as (rows, steps): each is predicted from the one before and from the day before.

    ``calendar`` is (rows, steps, 3), ``day`` the last counts, oldest first, and ``rest`` further features.
    """
    out = np.empty(day.shape)
    previous = day[:, -1]
    for step in range(day.shape[1]):
        x = np.column_stack([calendar[:, step], previous, day[:, step], rest])
        previous = np.maximum(forest.predict(x), 0.0)
        out[:, step] = previous
    return out


_AHEAD = "Junction bigint, LastTime timestamp_ntz, Ahead array<double>"


def _arrays(table: pa.Table | pa.RecordBatch, rest: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    days = np.array(table.column("Day").to_pylist(), float)
    calendar = np.stack([np.array(table.column(c).to_pylist(), float) for c in ("Hours", "Weekdays", "Weekends")], axis=2)
    others = [table.column(c).to_numpy(zero_copy_only=False).astype(float) for c in rest]
    return calendar, days, np.stack(others, axis=1) if rest else np.empty((len(days), 0))


def roll_all(forest: Forest, state: DataFrame, rest: list[str]) -> DataFrame:
    """The next steps of all junctions by one forest: (Junction, LastTime, Ahead)."""
    kinds, arrow = _arrow(state.sparkSession, _AHEAD)
    shared = state.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STATES):
                part = batch.slice(at, STATES)
                ahead = roll(shared.value, *_arrays(part, rest))
                columns = [part.column("Junction"), part.column("LastTime"), pa.array(list(ahead), arrow.field(2).type)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return state.mapInArrow(run, kinds)


def roll_each(forests: DataFrame, state: DataFrame) -> DataFrame:
    """The next steps of every junction by its own forest: (Junction, LastTime, Ahead)."""
    kinds, arrow = _arrow(state.sparkSession, _AHEAD)

    def run(own: pa.Table, trees: pa.Table) -> pa.Table:
        if not own.num_rows or not trees.num_rows:
            return arrow.empty_table()
        ahead = roll(_joined(trees), *_arrays(own, []))
        columns = [own.column("Junction"), own.column("LastTime"), pa.array(list(ahead), arrow.field(2).type)]
        return pa.table([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    trees = forests.select(F.col("Junction").alias("j"), "Feature", "Threshold", "Left", "Mean")
    return spread(state, "Junction").groupBy("Junction").cogroup(spread(trees, "j").groupBy("j")).applyInArrow(run, kinds)
