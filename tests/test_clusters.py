import numpy as np
import pytest

from sitepulse.functions.temporal import add_calendar
from sitepulse.operators import clusters, kmeans, profiles
from tests.conftest import values

COLUMNS = ["a", "b"]


def table(spark, points, labels=None):
    rows = [(i, *map(float, p), int(labels[i]) if labels is not None else 0) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "Junction bigint, a double, b double, Cluster int")


def expected_silhouette(points, labels):
    points, labels, scores = np.asarray(points, float), np.asarray(labels), []
    for i, own in enumerate(labels):
        distance = np.linalg.norm(points - points[i], axis=1)
        inner = distance[labels == own].sum() / max((labels == own).sum() - 1, 1)
        nearest = min(distance[labels == c].mean() for c in set(labels) - {own})
        scores.append(0 if (labels == own).sum() == 1 else (nearest - inner) / max(inner, nearest))
    return float(np.mean(scores))


@pytest.mark.parametrize("block_rows", [3, 7, 2048])
def test_silhouette_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(5)
    points, labels = rng.normal(size=(40, 2)), rng.integers(0, 3, 40)
    labels[0] = 7  # a cluster of one
    found = clusters.silhouette(table(spark, points, labels), COLUMNS, block_rows).first()[0]
    assert found == pytest.approx(expected_silhouette(points, labels), abs=1e-12)


def test_squared_silhouette_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    points, labels = rng.normal(size=(30, 2)), rng.integers(0, 3, 30)
    gaps = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(labels):
        inner = gaps[i][labels == own].sum() / max((labels == own).sum() - 1, 1)
        nearest = min(gaps[i][labels == c].mean() for c in set(labels) - {own})
        scores.append((nearest - inner) / max(inner, nearest))
    found = clusters.silhouette(table(spark, points, labels), COLUMNS, distance="squared").first()[0]
    assert found == pytest.approx(float(np.mean(scores)), abs=1e-9)


def test_davies_bouldin_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    points, labels = rng.normal(size=(30, 2)), rng.integers(0, 4, 30)
    centres = {c: points[labels == c].mean(axis=0) for c in set(labels)}
    radius = {c: np.linalg.norm(points[labels == c] - centres[c], axis=1).mean() for c in centres}
    worst = [
        max((radius[c] + radius[d]) / np.linalg.norm(centres[c] - centres[d]) for d in centres if d != c) for c in centres
    ]
    assert clusters.davies_bouldin(table(spark, points, labels), COLUMNS).first()[0] == pytest.approx(np.mean(worst))


@pytest.mark.parametrize("labels", [[0, 0, 0, 0], [0, 1, 2, 3]])
def test_scores_are_null_without_a_partition(spark, labels):
    frame = table(spark, [(0, 0), (1, 0), (5, 5), (6, 5)], labels)
    assert clusters.silhouette(frame, COLUMNS).first()[0] is None
    assert clusters.davies_bouldin(frame, COLUMNS).first()[0] is None


def test_standardize(spark):
    frame = clusters.standardize(table(spark, [(1, 5), (2, 5), (3, 5)]), COLUMNS)
    a = np.array([row["a"] for row in frame.orderBy("Junction").collect()])
    assert a.mean() == pytest.approx(0) and a.std() == pytest.approx(1)
    assert values(frame, "b") == [(0.0,)] * 3


def test_labels_follow_means_and_run_out(spark):
    means = spark.createDataFrame([(0, 30.0), (1, 10.0), (2, 20.0), (3, 40.0)], "Cluster int, mean double")
    three = clusters.with_levels(means, "mean", clusters.PROFILE_LABELS, "level")
    assert values(three, "Cluster", "level") == [
        (0, "High Congestion"), (1, "Low Congestion"), (2, "Medium Traffic"), (3, "Level 4")
    ]
    four = clusters.with_levels(means, "mean", clusters.matrix_labels(4), "level")
    assert dict(values(four, "Cluster", "level"))[0] == "Medium-High Congestion"
    five = clusters.with_levels(means, "mean", clusters.matrix_labels(5), "level")
    assert dict(values(five, "Cluster", "level")) == {1: "Level 1", 2: "Level 2", 0: "Level 3", 3: "Level 4"}


def blobs(spark, n=30):
    rng = np.random.default_rng(7)
    truth = np.arange(n) % 3
    return table(spark, rng.normal(size=(n, 2)) * 0.1 + np.array([[0, 0], [10, 0], [0, 10]])[truth]), truth


def test_kmeans_finds_separate_groups_and_repeats(spark):
    frame, truth = blobs(spark)
    model = kmeans.fit_clusters(frame, COLUMNS, 3, restarts=5)
    found = [c for _, c in values(model.assign(frame), "Junction", "Cluster")]
    assert len(set(zip(truth, found))) == 3
    again = kmeans.fit_clusters(frame.repartition(3), COLUMNS, 3, restarts=5)
    assert values(again.assign(frame), "Junction", "Cluster") == values(model.assign(frame), "Junction", "Cluster")
    assert again.inertia == pytest.approx(model.inertia)


def test_clusters_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(11)
    frame = table(spark, rng.normal(size=(300, 2))).persist()
    found = []
    for partitions in (1, 7, 50):
        model = kmeans.fit_clusters(frame.repartition(partitions), COLUMNS, 4, restarts=3)
        choice = kmeans.choose_k(frame.repartition(partitions), COLUMNS, max_clusters=4, restarts=2, distance="squared")
        found.append((values(model.assign(frame), "Junction", "Cluster"), values(choice, "k", "Inertia")))
    for assigned, costs in found[1:]:
        assert assigned == found[0][0]
        assert costs == [(k, pytest.approx(cost)) for k, cost in found[0][1]]


def test_restarts_are_plain_lloyd_steps(spark):
    """Every run ends where moving centres to means changes nothing, and the best of more runs costs no more."""
    rng = np.random.default_rng(12)
    points = rng.normal(size=(120, 2))
    frame = table(spark, points).persist()
    scaled = (points - points.mean(axis=0)) / points.std(axis=0)
    costs = []
    for restarts in (1, 8):
        model = kmeans.fit_clusters(frame, COLUMNS, 5, restarts=restarts)
        labels = np.array([c for _, c in values(model.assign(frame), "Junction", "Cluster")])
        means = np.array([scaled[labels == c].mean(axis=0) for c in range(5)])
        assert np.allclose(means, model.centers, atol=1e-8)
        assert model.inertia == pytest.approx(((scaled - means[labels]) ** 2).sum(), rel=1e-6)
        costs.append(model.inertia)
    assert costs[1] <= costs[0] + 1e-9


def test_start_centres_follow_squared_distances(spark):
    """Over many seeds the second centre falls on far junctions as often as their distances say."""
    frame = table(spark, [(0, 0), (0, 0), (1, 0), (3, 0)]).selectExpr("Junction", "array(a, b) AS vector").persist()
    runs = [kmeans._Run(2, seed) for seed in range(600)]
    kmeans._draw(frame, runs, 0)
    kmeans._draw(frame, runs, 1)
    first = [run.centers[0][0] for run in runs]
    assert first.count(0) / 600 == pytest.approx(0.5, abs=0.07)
    after_zero = [run.centers[1][0] for run in runs if run.centers[0][0] == 0]
    assert after_zero.count(0) == 0
    assert after_zero.count(3) / len(after_zero) == pytest.approx(0.9, abs=0.06)


def test_all_junctions_on_one_place(spark):
    frame = table(spark, [(2, 2)] * 4)
    model = kmeans.fit_clusters(frame, COLUMNS, 2, restarts=2)
    assert model.inertia == 0 and {c for _, c in values(model.assign(frame), "Junction", "Cluster")} == {0}


def test_silhouettes_of_all_k_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(30, 2))
    frame = table(spark, points)
    scaled = (points - points.mean(axis=0)) / points.std(axis=0)
    for row in kmeans.choose_k(frame, COLUMNS, max_clusters=4, restarts=2).collect():
        model = kmeans.fit_clusters(frame, COLUMNS, row["k"], restarts=2)
        labels = [c for _, c in values(model.assign(frame), "Junction", "Cluster")]
        assert row["Silhouette"] == pytest.approx(expected_silhouette(scaled, labels))
        assert row["Inertia"] == pytest.approx(model.inertia)


def test_inertia_is_that_of_population_scaling(spark):
    frame, _ = blobs(spark)
    model = kmeans.fit_clusters(frame, COLUMNS, 3, restarts=3)
    scaled = clusters.standardize(frame, COLUMNS).drop("Cluster").join(model.assign(frame), "Junction").toPandas()
    spread = sum(((g[COLUMNS] - g[COLUMNS].mean()) ** 2).to_numpy().sum() for _, g in scaled.groupby("Cluster"))
    assert model.inertia == pytest.approx(spread)


def test_choice_of_k(spark):
    frame, _ = blobs(spark)
    choice = kmeans.choose_k(frame, COLUMNS, max_clusters=5, restarts=2)
    assert [row["k"] for row in choice.orderBy("k").collect()] == [2, 3, 4, 5]
    assert kmeans.best_k(choice) == 3
    inertia = [row["Inertia"] for row in choice.orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)


def test_k_limits(spark):
    frame = table(spark, [(0, 0), (1, 1), (5, 5), (9, 1)])
    with pytest.raises(ValueError):
        kmeans.fit_clusters(frame, COLUMNS, 5, restarts=1)
    with pytest.raises(ValueError):
        kmeans.fit_clusters(frame, COLUMNS, 0, restarts=1)
    with pytest.raises(ValueError):
        kmeans.choose_k(frame.limit(2), COLUMNS)
    model = kmeans.fit_clusters(frame, COLUMNS, 4, restarts=2)
    assigned = model.assign(frame)
    assert assigned.select("Cluster").distinct().count() == 4
    scores = kmeans.cluster_scores(frame, COLUMNS, assigned).first()
    assert tuple(scores) == (None, None)
    one = kmeans.fit_clusters(frame, COLUMNS, 1, restarts=1)
    assert values(one.assign(frame), "Cluster") == [(0,)] * 4


def test_model_roundtrip(spark, tmp_path):
    frame, _ = blobs(spark)
    model = kmeans.fit_clusters(frame, COLUMNS, 3, restarts=2)
    model.save(str(tmp_path / "model"), frame.groupBy("Cluster").count())
    loaded, stored = kmeans.ClusterModel.load(spark, str(tmp_path / "model"))
    assert loaded.columns == COLUMNS and loaded.k == 3 and loaded.inertia == pytest.approx(model.inertia)
    assert values(loaded.assign(frame), "Junction", "Cluster") == values(model.assign(frame), "Junction", "Cluster")
    assert stored.columns == ["Cluster", "count"]


def test_cluster_profile_peak_is_unweighted(readings):
    # Junction 1 peaks at 8 with many readings, junction 2 at 9 with a single higher one.
    rows = [(i, 24 * i + 8, 1, 10) for i in range(20)] + [(100, 9, 2, 50)]
    frame = add_calendar(readings(*rows))
    features = profiles.junction_features(frame)
    together = features.select("Junction").selectExpr("Junction", "0 AS Cluster")
    row = clusters.cluster_profiles(features, together, 1).first()
    assert (row["NumJunctions"], row["PeakHour"], row["PeakHourAvgTraffic"], row["CongestionLevel"]) == (2, 9, 25.0, "Level 1")


def test_member_curves_take_the_first_ids(readings):
    frame = add_calendar(readings(*[(j, 5, j, j) for j in range(1, 9)]))
    together = frame.selectExpr("Junction", "0 AS Cluster")
    assert values(clusters.cluster_member_curves(frame, together, 3), "Junction") == [(1,), (2,), (3,)]


def test_distances_by_a_product_keep_their_digits():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (40, 34)), rng.normal(50, 1e-6, (40, 34)), np.zeros((2, 34))])
    y = np.concatenate([x[20:60], rng.normal(50, 1e-3, (30, 34))])
    plain = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
    found = clusters.pair_distances(x, y)
    assert np.allclose(found, plain, rtol=1e-10, atol=0) and (found[plain == 0] == 0).all()


def test_blocks_of_the_silhouette_are_dealt_by_number(spark):
    rows = [(i, [float(i % 9), float(i % 5)], i % 3) for i in range(60)]
    parts = clusters.silhouette_parts(spark.createDataFrame(rows, "Junction bigint, vector array<double>, Cluster int"), {0: "Cluster"}, 10)
    assert "REPARTITION_BY_NUM" in parts._jdf.queryExecution().executedPlan().toString()
