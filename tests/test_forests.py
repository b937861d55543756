"""Forests of many junctions against a plain version of the same algorithm, grown row by row."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitepulse.operators import forecast, forests
from sitepulse.sources.tables import write_buckets
from tests.conftest import values

FEATURES = forecast.FEATURES


@pytest.fixture(scope="module")
def split(spark):
    """Junctions 1 and 4 with many rows, 2 with few, 3 without training rows."""
    rnd = np.random.default_rng(5)
    rows = []
    for junction, size, train in ((1, 130, 104), (2, 12, 9), (3, 1, 0), (4, 90, 72)):
        for i in range(size):
            x = (i % 24, i // 24 % 7, int(i // 24 % 7 > 4), int(rnd.integers(0, 80)), int(rnd.integers(0, 500)))
            y = int(10 * x[0] + x[3] + rnd.integers(0, 30))
            clock = datetime(2024, 1, 1) + timedelta(hours=i)
            rows.append((junction, clock, y, *x, i + 1, size, train, "train" if i < train else "test"))
    names = "Junction bigint, DateTime timestamp_ntz, Vehicles bigint, " + ", ".join(f"{f} int" for f in FEATURES)
    frame = spark.createDataFrame(rows, names + ", RowNo bigint, RowCount bigint, TrainRows bigint, Side string")
    return frame.persist()


def plain_forest(rows, trees, depth, seed, bins):
    """Nested (feature, threshold, left, right) or means, by trying every border for every node."""
    x = np.array([[r[f] for f in FEATURES] for r in rows], float)
    y = np.array([r["Vehicles"] for r in rows], float)
    borders = []
    for f in range(x.shape[1]):
        ordered, found = np.sort(x[:, f]), []
        different = sorted(set(ordered))
        for a, b in zip(different, different[1:]):
            upto_a, upto_b = (ordered <= a).sum() - 1, (ordered <= b).sum() - 1
            if len(different) <= bins or upto_a * bins // len(ordered) != upto_b * bins // len(ordered):
                found.append((a + b) / 2)
        borders.append(found)
    weights = forests.bag_weights(rows[0]["Junction"], np.array([r["RowNo"] for r in rows]), trees, seed)
    gains = np.zeros((trees, x.shape[1]))

    def node(tree, mine, level):
        w = weights[tree][mine]
        mean, whole = (w * y[mine]).sum() / w.sum(), (w * y[mine]).sum() ** 2 / w.sum()
        best = (whole + 1e-9 * max(whole, 1), None, None)
        for f in range(x.shape[1]) if level < depth else ():
            for border in borders[f]:
                left = x[mine, f] <= border
                if w[left].sum() and w[~left].sum():
                    score = sum((w[s] * y[mine][s]).sum() ** 2 / w[s].sum() for s in (left, ~left))
                    if score > best[0]:
                        best = (score, f, border)
        if best[1] is None:
            return mean
        gains[tree, best[1]] += best[0] - whole
        left = x[mine, best[1]] <= best[2]
        return best[1], best[2], node(tree, mine[left], level + 1), node(tree, mine[~left], level + 1)

    return [node(t, np.flatnonzero(weights[t]), 0) for t in range(trees)], gains


def walk(tree, x):
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("seed, depth, bins, block_rows", [(7, 6, 32, 1 << 16), (7, 6, 32, 20), (None, 3, 8, 50), (1, 1, 4, 10)])
def test_forests_equal_plain_growing(spark, split, seed, depth, bins, block_rows):
    trained = forests.train_sites(split, FEATURES, 5, depth, seed, bins, block_rows).persist()
    assert {r["Junction"] for r in trained.collect()} == {1, 2, 4}
    predicted = {(r["Junction"], r["RowNo"]): r["Predicted"] for r in forests.predict_sites(trained, split, FEATURES, 40).collect()}
    weights = {(r["Junction"], r["Feature"]): r["Importance"] for r in forests.site_importance(trained, FEATURES).collect()}
    for junction, size in ((1, 130), (2, 12), (4, 90)):
        rows = split.where(f"Junction = {junction}").orderBy("RowNo").collect()
        trees, gains = plain_forest([r for r in rows if r["Side"] == "train"], 5, depth, seed, bins)
        for row in rows:
            expected = np.mean([walk(t, [row[f] for f in FEATURES]) for t in trees])
            assert predicted.pop((junction, row["RowNo"])) == pytest.approx(expected, abs=1e-9)
        shares = np.array([g / g.sum() if g.sum() else g for g in gains]).sum(axis=0)
        for f, share in zip(FEATURES, shares / shares.sum()):
            assert weights[junction, f] == pytest.approx(share, abs=1e-9)
    assert not predicted


def test_levels_give_what_a_task_gives(spark, split):
    """Blocks of ten rows or one task for all, and any number of partitions: the same trees."""
    usual, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for block_rows, partitions in ((1 << 16, "1"), (10, "1"), (25, "7")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            trained = forests.train_sites(split.repartition(int(partitions)), FEATURES, 4, 5, 3, 16, block_rows)
            rows = trained.orderBy("Junction", "Tree").collect()
            found.append([(r["Junction"], r["Tree"], r["Feature"], r["Threshold"], r["Left"], r["Mean"]) for r in rows])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert found[0] == found[1] == found[2]


def test_borders_of_tasks_and_of_all_blocks(spark, split):
    train = split.where("Side = 'train'")
    for bins in (2, 5, 32):
        for row in forests.feature_borders(train, FEATURES, bins).collect():
            own = train.where(F.col("Junction") == row["Junction"]).toPandas()
            plain = [forests.thresholds_of(own[f].to_numpy(float), bins).tolist() for f in FEATURES]
            assert row["Borders"] == plain


def test_bags_hold_about_all_rows():
    weights = forests.bag_weights(3, np.arange(1, 2001), 50, 42)
    assert weights.shape == (50, 2000) and weights.mean() == pytest.approx(1, abs=0.02)
    assert (weights == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    assert (forests.bag_weights(3, np.arange(1, 5), 200, 1)[:, 0] > 0).all()
    assert not (weights == forests.bag_weights(4, np.arange(1, 2001), 50, 42)).all()


def test_rollout_by_own_forest_equals_step_by_step(spark, split):
    trained = forests.train_sites(split, FEATURES, 3, 4).persist()
    ahead = {(r["Junction"], r["Step"]): r for r in forecast.forecast_sites(trained, split).collect()}
    assert {j for j, _ in ahead} == {1, 4}  # the others have fewer than 24 rows
    for junction in (1, 4):
        rows = split.where(f"Junction = {junction}").orderBy("RowNo").collect()
        trees, _ = plain_forest([r for r in rows if r["Side"] == "train"], 3, 4, 42, 32)
        day, clock = [float(r["Vehicles"]) for r in rows[-24:]], rows[-1]["DateTime"]
        previous = day[-1]
        for step in range(1, 25):
            at = clock + timedelta(hours=step)
            x = (at.hour, at.weekday(), int(at.weekday() >= 5), previous, day[step - 1])
            previous = max(0.0, np.mean([walk(t, x) for t in trees]))
            assert ahead[junction, step]["DateTime"] == at
            assert ahead[junction, step]["Predicted"] == pytest.approx(previous, abs=1e-9)


def test_flat_forest_equals_the_fitted_model(spark, split):
    rows = split.withColumn(forecast.SITE_MEAN, F.lit(100.0))
    model = forecast.train_all(rows, trees=7, depth=5)
    flat = forests.flat_forest(model.stages[-1], spark)
    names = model.stages[0].getInputCols()
    for row in forecast.predict(model, rows).collect():
        assert flat.predict(np.array([[row[c] for c in names]], float))[0] == pytest.approx(row["Predicted"], abs=1e-9)


def test_many_junctions_take_as_many_jobs_as_few(spark):
    def jobs(junctions):
        frame = spark.range(junctions * 12).selectExpr(
            "id % {0} AS Junction".format(junctions), "id div {0} + 1 AS RowNo".format(junctions), "12L AS RowCount", "9L AS TrainRows",
            "id * 7 % 50 AS Vehicles", *[f"id * {k} % 13 AS {f}" for k, f in enumerate(FEATURES, 3)],
            "if(id div {0} < 9, 'train', 'test') AS Side".format(junctions),
        )
        spark.sparkContext.setJobGroup(f"fit-{junctions}", "fit")
        rows = forests.train_sites(frame, FEATURES, trees=3, depth=4).collect()
        spark.sparkContext.setJobGroup("other", "other")
        assert len(rows) == 3 * junctions
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{junctions}"))

    assert jobs(300) == jobs(3)


def test_training_an_empty_table(spark, split):
    nothing = split.where("false")
    trained = forests.train_sites(nothing, FEATURES, trees=2, depth=2)
    assert trained.count() == 0 and forests.predict_sites(trained, split, FEATURES).count() == 0


def test_bucketed_rows_stay_where_they_are(spark, split, tmp_path):
    table = write_buckets(split, str(tmp_path / "b"), ["Junction"], ["RowNo"], buckets=3)
    assert values(table, "Junction", "RowNo") == values(split, "Junction", "RowNo")
    plan = table.groupBy("Junction").agg(F.sum("Vehicles"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_forests_of_small_junctions_are_shared_among_tasks(spark):
    rows = [(j, n, 40, "train" if n <= 32 else "test", (n * j) % 7, n % 24, n % 7, n % 2, n % 5, n % 3) for j in range(1, 41) for n in range(1, 41)]
    split = spark.createDataFrame(rows, "Junction bigint, RowNo bigint, RowCount bigint, Side string, Vehicles bigint, " + ", ".join(f"{f} bigint" for f in FEATURES))
    split = split.withColumn("TrainRows", F.lit(32).cast("bigint"))
    trained = forests.train_sites(split, FEATURES, trees=2, depth=3)
    assert trained.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    predicted = forests.predict_sites(trained.persist(), split, FEATURES)
    assert predicted.count() == len(rows)
    assert predicted.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_splits_from_held_bins_are_those_from_all_bins():
    rng = np.random.default_rng(5)
    for rows in (1, 2, 30, 400):
        x = np.stack([rng.integers(0, n, rows) for n in (24, 7, 1, 3, 30)], axis=1)
        y, weights = rng.integers(0, 50, rows).astype(float), forests.bag_weights(1, np.arange(1, rows + 1), 20, 3)
        slot, row = np.nonzero(weights)
        w = weights[slot, row].astype(float)
        bins = (24, 7, 1, 3, 30)
        grids = [[np.bincount(slot * b + x[row, f], v, 20 * b).reshape(20, b) for f, b in enumerate(bins)] for v in (w, w * y[row])]
        plain = forests.best_splits(*grids, False)
        quick = forests.best_of_cells(x.T[:, row], slot, w, w * y[row], 20)
        inner = plain[0] >= 0
        assert (plain[0] == quick[0]).all() and (plain[1] == quick[1])[inner].all()
        assert (plain[2] == quick[2]).all() and (plain[3] == quick[3]).all()
