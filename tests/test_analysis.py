import os

import numpy as np
import pytest

from sitepulse.plans import analysis
from sitepulse.sources import readings as source
from sitepulse.sources import tables
from sitepulse.sources.readings import load_readings
from tests.conftest import values


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Six junctions in three levels, with a copy, a gap and an outlier, as a CSV file."""
    rng = np.random.default_rng(11)
    lines, at = ["DateTime,Junction,Vehicles,ID"], 0
    for day in range(1, 11):
        for hour in range(24):
            for junction in range(1, 7):
                value = int((junction % 3 + 1) * 30 * (1.5 + np.sin(hour / 24 * 2 * np.pi)) + rng.integers(0, 5))
                text = "" if (day, hour, junction) == (3, 4, 2) else str(100_000 if at == 77 else value)
                lines.append(f"2024-01-{day:02d} {hour:02d}:00:00,{junction},{text},{at}")
                at += 1
    lines.append(f"2024-01-01 00:00:00,1,500,{at}")
    path = tmp_path_factory.mktemp("raw") / "readings.csv"
    path.write_text("\n".join(lines))
    return str(path)


def test_first_policy(spark, raw):
    tablesets = analysis.preprocess(spark, raw)
    series = tablesets["timeseries"]
    assert series.count() == 6 * 240
    row = series.selectExpr("max(Vehicles) AS high", "count(Vehicles) AS n").first()
    assert row["high"] < 1000 and row["n"] == 6 * 240
    assert tablesets["junction_features"].count() == 6
    with pytest.raises(ValueError):
        analysis.prepare(load_readings(spark, raw), "last")


def test_sum_policy(spark, raw, tmp_path):
    found = analysis.process_readings(spark, raw, str(tmp_path / "out"))
    total = load_readings(spark, raw).selectExpr("sum(Vehicles) AS s").first()["s"]
    assert found["processed"].selectExpr("sum(Vehicles) AS s").first()["s"] == total
    assert tables.read_processed(spark, str(tmp_path / "out")).count() == 6 * 240
    assert found["junction_volume"].count() == 6


def test_complete_analysis_with_output(spark, raw, tmp_path):
    folder = str(tmp_path / "results")
    results = analysis.complete_analysis(load_readings(spark, raw), output=folder)
    by_level = dict(values(results["cluster_profiles"], "CongestionLevel", "NumJunctions"))
    assert by_level == {"Low Congestion": 2, "Medium Congestion": 2, "High Congestion": 2}
    members = {}
    for junction, cluster in values(results["cluster_assignments"], "Junction", "Cluster"):
        members.setdefault(cluster, set()).add(junction % 3)
    assert all(len(kinds) == 1 for kinds in members.values())
    assert results["cluster_scores"].first()["Silhouette"] > 0.5
    loaded = tables.load_results(spark, folder)
    assert loaded["loaded"] and loaded["timeseries"].count() == 6 * 240
    assert sorted(loaded["rules"].collect()) == sorted(results["rules"].collect())
    assert values(loaded["cluster_assignments"], "Junction", "Cluster") == values(
        results["cluster_assignments"], "Junction", "Cluster"
    )
    assert os.path.isdir(os.path.join(folder, "models", "clustering", "model"))
    assert {"timeseries_first", "hourly_by_cluster", "hourly_daytype", "cluster_distribution", "heatmap"} <= set(results)


def test_automatic_k(spark, raw):
    features = analysis.preprocess(spark, raw)["junction_features"].persist()
    model, found = analysis.cluster_matrix(features, auto_select_k=True)
    assert model.k == 3 and found["k_selection"].count() == 4


def test_learn_and_advise(spark, raw):
    processed = analysis.prepare(load_readings(spark, raw), "sum").persist()
    found = analysis.learn(processed, forest={"trees": 5, "depth": 4})
    assert found["forecast_24h"].count() == 6 * 24 and found["forecast_summary"].count() == 6
    assert found["cluster_centers"].count() == 3
    advised = analysis.advise(processed, found["labelled_profiles"])
    assert advised.count() == 6 and advised.where("Num_Recommendations = 0").count() == 0


def test_pattern_tables(spark, raw):
    processed = analysis.prepare(load_readings(spark, raw), "sum")
    found = analysis.pattern_analysis(processed)
    assert found["hourly_trend"].count() == 6 * 24 and found["peak_hour"].count() == 6


def test_readings_without_id_keep_the_first_of_the_file(spark, tmp_path):
    path = tmp_path / "readings.csv"
    lines = [f"2024-01-0{d} {h:02d}:00:00,{j},{j * 10 + h}" for d in (1, 6) for h in range(24) for j in (1, 2, 3)]
    path.write_text("DateTime,Junction,Vehicles\n" + "\n".join(lines) + "\n2024-01-01 00:00:00,1,999\n2024-01-01 05:00:00,2,\n")
    found = analysis.preprocess(spark, str(path))["timeseries"]
    assert found.count() == 144 and found.where("Vehicles > 100 or Vehicles is null").count() == 0
    results = analysis.complete_analysis(source.load_readings(spark, str(path), drop_id=True), n_clusters=2)
    assert results["timeseries"].count() == 144 and results["rules"].count() > 0


def test_one_scan_of_the_readings(spark, capsys):
    from sitepulse.plans.catalog import QUERIES

    for name in ("recommendations", "rules"):
        QUERIES[name](spark, "/root/testdata/sf0.001").explain("formatted")
        assert capsys.readouterr().out.count("events.parquet") <= 1
