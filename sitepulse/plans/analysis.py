"""The two whole analyses and their stages, as dictionaries of DataFrames.

They differ in what they do with duplicate readings: ``policy="sum"`` adds them up and leaves
nulls and outliers alone, ``policy="first"`` fills gaps, keeps the first copy and caps outliers.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.functions.temporal import add_calendar
from sitepulse.operators import clean, clusters, forecast, kmeans, patterns, profiles, recommend, rules
from sitepulse.session import scratch_folder
from sitepulse.sources.readings import load_readings
from sitepulse.sources.tables import write_csv, write_readings


def in_order(readings: DataFrame, order: str = "ID") -> tuple[DataFrame, str]:
    """Readings with a column that says which of two copies came first: ``order``, else the place in the file."""
    for name in (order, "SourceOrder"):
        if name in readings.columns:
            return readings, name
    return readings.withColumn("SourceOrder", F.monotonically_increasing_id()), "SourceOrder"


def prepare(readings: DataFrame, policy: str = "sum", cap: bool = True, order: str = "ID") -> DataFrame:
    """Cleaned readings with calendar columns.

    For ``first`` every column but junction and clock is filled where it has nulls; readings without
    ``order`` are taken in the order of their file.
    """
    if policy == "sum":
        return add_calendar(clean.merge_duplicates(readings, order))
    if policy != "first":
        raise ValueError(f"unknown policy {policy!r}: use sum or first")
    readings, order = in_order(readings, order)
    filled = [c for c in readings.columns if c not in (*clean.KEY, order)]
    nulls = readings.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in filled]).first()
    gaps = [c for c in filled if nulls[c]]
    if gaps:
        readings = clean.fill_gaps(readings, gaps, order)
    single = clean.keep_first(readings, order).drop("ID", "SourceOrder")
    return add_calendar(clean.cap_outliers(single) if cap else single, with_period=True)


def stored(table: DataFrame, folder: str | None, name: str) -> DataFrame:
    """A table that several stages read: written and read back, so that a lost executor costs no repeat.

    It goes below ``folder``, else below the shared folder of the cluster; a session that names none
    caches it instead.
    """
    spark = table.sparkSession
    if folder is not None:
        path = os.path.join(folder, name)
    elif spark.conf.get("spark.checkpoint.dir", None):
        path = scratch_folder(spark, name)
    else:
        return table.persist()
    if "DateTime" in table.columns:
        write_readings(table, path)
    else:
        table.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select(*table.columns)


def process_readings(spark: SparkSession, path: str, output: str | None = None, fmt: str = "csv") -> dict[str, DataFrame]:
    """Load, merge duplicates by sum, derive the calendar, summarise; optionally write the result."""
    processed = prepare(load_readings(spark, path, fmt=fmt), "sum")
    if output:
        write_csv(processed, output)
    return {"processed": processed, "junction_volume": patterns.junction_volume(processed)}


def preprocess(spark: SparkSession, path: str, fmt: str = "csv", order: str = "ID") -> dict[str, DataFrame]:
    """Load, fill, keep the first copy, cap, derive the calendar and build the feature matrix."""
    raw = load_readings(spark, path, fmt=fmt)
    if order not in raw.columns:
        raw = load_readings(spark, path, fmt=fmt, keep_file_order=True)
    timeseries = prepare(raw, "first", order=order)
    return {"timeseries": timeseries, "junction_features": profiles.junction_features(timeseries)}


def pattern_analysis(processed: DataFrame) -> dict[str, DataFrame]:
    """Hourly, weekly and spread tables of processed readings; the hour cube is computed once."""
    cube = stored(patterns.hour_cube(processed), None, "cube")
    return {
        "hourly_trend": patterns.hourly_trend(cube),
        "peak_hour": patterns.peak_hour(cube),
        "weekly_pattern": patterns.weekly_pattern(cube),
        "weekday_weekend_gap": patterns.weekday_weekend_gap(cube),
        "junction_spread": patterns.junction_spread(processed),
        "junction_describe": patterns.junction_describe(processed),
        "boxplot_stats": patterns.boxplot_stats(processed),
    }


def cluster_matrix(
    features: DataFrame, n_clusters: int = 3, auto_select_k: bool = False
) -> tuple[kmeans.ClusterModel, dict[str, DataFrame]]:
    """K-Means on the feature matrix: assignments, profiles and scores."""
    columns = [c for c in profiles.MATRIX_FEATURES if c in features.columns]
    tables = {}
    if auto_select_k:
        tables["k_selection"] = kmeans.choose_k(features, columns)
        n_clusters = kmeans.best_k(tables["k_selection"])
    model = kmeans.fit_clusters(features, columns, n_clusters)
    assignments = model.assign(features)
    tables |= {
        "cluster_assignments": assignments,
        "cluster_profiles": clusters.cluster_profiles(features, assignments, n_clusters),
        "cluster_scores": kmeans.cluster_scores(features, columns, assignments),
    }
    return model, tables


def cluster_profiles_of(processed: DataFrame, n_clusters: int = 3) -> tuple[kmeans.ClusterModel, DataFrame]:
    """K-Means on the four profile columns and the labelled profiles, with the day-type means."""
    table = stored(profiles.enhanced_profiles(processed), None, "profiles")
    model = kmeans.fit_clusters(table, profiles.PROFILE_FEATURES, n_clusters)
    return model, clusters.label_profiles(table, model.assign(table))


def learn(processed: DataFrame, n_clusters: int = 3, forest: dict | None = None) -> dict[str, DataFrame]:
    """Profile clusters and a forest for all junctions, with their results."""
    _, labelled = cluster_profiles_of(processed, n_clusters)
    split = stored(forecast.add_site_mean(forecast.training_matrix(processed)), None, "split")
    model = forecast.train_all(split, **(forest or {}))
    predicted = forecast.predict(model, split)
    ahead = forecast.forecast_24h(model, split)
    return {
        "labelled_profiles": labelled,
        "cluster_centers": clusters.cluster_centers(labelled),
        "forecast_metrics": forecast.forecast_metrics(predicted),
        "feature_importance": forecast.feature_importance(model, split),
        "actual_vs_predicted": forecast.actual_vs_predicted(predicted),
        "forecast_24h": ahead,
        "forecast_summary": forecast.forecast_summary(ahead),
    }


def chart_tables(
    timeseries: DataFrame, assignments: DataFrame, cluster_profiles: DataFrame, cube: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The data behind the six standard charts."""
    cells = patterns.as_cube(timeseries) if cube is None else cube
    return {
        "timeseries_first": patterns.timeseries_first(timeseries),
        "hourly_by_cluster": clusters.hourly_by_cluster(cells, assignments),
        "hourly_daytype": patterns.hourly_daytype(cells),
        "cluster_distribution": clusters.cluster_distribution(assignments),
        "cluster_profile_bars": clusters.cluster_profile_bars(cluster_profiles),
        "heatmap": patterns.heatmap(cells),
    }


def optimization_rules(
    cluster_profiles: DataFrame, timeseries: DataFrame, assignments: DataFrame, export: str | None = None
) -> DataFrame:
    """All rules, optionally written as CSV."""
    table = rules.rules(cluster_profiles, timeseries, assignments)
    if export:
        write_csv(table, export)
    return table


def advise(processed: DataFrame, labelled: DataFrame | None = None, export: str | None = None) -> DataFrame:
    """Recommendations of every junction, optionally written as CSV; clusters first when needed."""
    if labelled is None:
        _, labelled = cluster_profiles_of(processed)
    table = recommend.recommendations(labelled)
    if export:
        write_csv(table, export)
    return table


def complete_analysis(
    readings: DataFrame,
    n_clusters: int = 3,
    auto_select_k: bool = False,
    output: str | None = None,
    order: str = "ID",
) -> dict[str, DataFrame]:
    """Prepare, build features, cluster, chart data and rules.

    With ``output`` everything is exported there, and so are the tables that several stages read.
    """
    timeseries = stored(prepare(readings, "first", order=order), output and os.path.join(output, "work"), "timeseries")
    cube = stored(patterns.hour_cube(timeseries), output and os.path.join(output, "work"), "hour_cube")
    features = stored(
        profiles.junction_features(timeseries, cube), output and os.path.join(output, "work"), "junction_features"
    )
    model, clustered = cluster_matrix(features, n_clusters, auto_select_k)
    assignments = clustered["cluster_assignments"]
    table = optimization_rules(
        clustered["cluster_profiles"], cube, assignments, output and os.path.join(output, "rules")
    )
    results = {
        "timeseries": timeseries,
        "junction_features": features,
        "data_summary": patterns.data_summary(timeseries),
        **clustered,
        **chart_tables(timeseries, assignments, clustered["cluster_profiles"], cube),
        "rules": table,
        "rules_summary": rules.rules_summary(table),
    }
    if output:
        for name in ("timeseries", "junction_features", "cluster_assignments", "cluster_profiles"):
            export = results[name]
            if name == "timeseries":
                export = export.select(
                    "DateTime", "Junction", "Vehicles", "Hour", "DayOfWeek", "Month", "IsWeekend", "PeriodOfDay"
                )
            write_csv(export, os.path.join(output, name))
        model.save(os.path.join(output, "models", "clustering"), clustered["cluster_profiles"])
    return results
