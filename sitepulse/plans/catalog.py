"""Every query by name, over the given tables.

The event log stands in for readings: its hours, its users as junctions, its values as counts.
Most queries fold the users onto eight busy junctions; those named "_sites" take every user as a
junction, so that tables per junction grow with the data. Queries about clusters that are checked
against SQL use the fixed assignment Junction mod 3, so that no model is involved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.functions.numeric import round_half_even
from sitepulse.functions.temporal import add_calendar
from sitepulse.operators import clean, clusters, forecast, kmeans, patterns, profiles, recommend, rules
from sitepulse.plans import analysis
from sitepulse.session import scratch_folder
from sitepulse.sources.readings import clock_range, load_readings, readings_from_events
from sitepulse.sources.tables import read_processed, read_readings, write_csv, write_readings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WEEK = ("2024-01-08", "2024-01-14")
PROFILE_COLUMNS = [*profiles.PROFILE_FEATURES, "Weekend_Traffic", "Weekday_Traffic"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def named(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


# --- inputs --------------------------------------------------------------------------------


def _raw(spark: SparkSession, folder: str, sites: int | None = 8) -> DataFrame:
    return readings_from_events(spark.read.parquet(f"{folder}/events.parquet"), sites)


def _processed(spark: SparkSession, folder: str, sites: int | None = 8) -> DataFrame:
    return analysis.prepare(_raw(spark, folder, sites), "sum")


def _first(spark: SparkSession, folder: str) -> DataFrame:
    return analysis.prepare(_raw(spark, folder), "first")


def _shaped(spark: SparkSession, folder: str) -> DataFrame:
    """Processed readings with rush hours and weekends, which the event log does not have."""
    hour, weekend, kind = F.col("Hour"), F.col("IsWeekend") == 1, F.pmod("Junction", F.lit(3))
    factor = (
        F.when(kind == 0, F.when(hour.between(6, 10), 3).otherwise(1))
        .when(kind == 1, F.when(hour.between(16, 20), 3).otherwise(1) * F.when(weekend, 2).otherwise(1))
        .otherwise(F.when(weekend, 1).otherwise(2))
    )
    return _processed(spark, folder).withColumn("Vehicles", F.col("Vehicles") * factor)


def _assigned(readings: DataFrame) -> DataFrame:
    return readings.select("Junction").distinct().withColumn("Cluster", F.pmod("Junction", F.lit(3)).cast("int"))


def _with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, folder).withColumn(
        "Vehicles", F.when(F.pmod("ID", F.lit(3)) != 0, F.col("Vehicles"))
    )


def _rounded(table: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round what depends on the order of additions, so that two engines agree on it."""
    return table.withColumns({c: round_half_even(F.col(c), digits) for c in columns})


def _kept(table: DataFrame) -> DataFrame:
    """A table that a query reads more than once: written to scratch and read back."""
    path = scratch_folder(table.sparkSession, "kept")
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    table = _kept(profiles.enhanced_profiles(_shaped(spark, folder)))
    return clusters.label_profiles(table, _assigned(table))


def _cluster_profiles(readings: DataFrame) -> DataFrame:
    features = _kept(profiles.junction_features(readings))
    return clusters.cluster_profiles(features, _assigned(features))


OFFSETS = (0, 100_000, 300_000)


def _offset() -> Column:
    """Three levels, by Junction mod 3, so far apart that only this partition into three is good."""
    kind = F.pmod("Junction", F.lit(3))
    return F.when(kind == 0, OFFSETS[0]).when(kind == 1, OFFSETS[1]).otherwise(OFFSETS[2]).cast("bigint")


def _apart(spark: SparkSession, folder: str) -> DataFrame:
    return _shaped(spark, folder).withColumn("Vehicles", F.col("Vehicles") + _offset())


def _level(spark: SparkSession, folder: str) -> DataFrame:
    """Processed readings whose count is 100 times the junction's number, so that forecasts must be exact."""
    return _processed(spark, folder).withColumn("Vehicles", (F.col("Junction") * 100).cast("bigint"))


# --- sources and sinks ---------------------------------------------------------------------


@named("load_readings")
def load_readings_csv(spark, folder):
    path = scratch_folder(spark, "raw")
    write_csv(_raw(spark, folder), path)
    return load_readings(spark, path)


@query
def load_readings_without_id(spark, folder):
    path = scratch_folder(spark, "raw")
    write_csv(_raw(spark, folder), path)
    return load_readings(spark, path, drop_id=True)


@query
def load_readings_mixed_headers(spark, folder):
    """Two writers with different column orders."""
    path, raw = scratch_folder(spark, "raw"), _raw(spark, folder)
    write_csv(raw.where("ID % 2 = 0").select("DateTime", "Junction", "Vehicles", "ID"), path)
    write_csv(raw.where("ID % 2 = 1").select("ID", "Vehicles", "DateTime", "Junction"), path, "append")
    return load_readings(spark, path)


@named("read_processed")
def read_processed_csv(spark, folder):
    path = scratch_folder(spark, "processed")
    write_csv(_processed(spark, folder), path)
    return read_processed(spark, path, "sum")


@query
def write_roundtrip(spark, folder):
    path = scratch_folder(spark, "timeseries")
    write_readings(_first(spark, folder), path)
    return spark.read.parquet(path).drop("ReadingMonth")


# --- cleaning ------------------------------------------------------------------------------


@query
def dedup_first_null_id(spark, folder):
    """Every third reading has lost its ID."""
    return clean.keep_first(_raw(spark, folder).withColumn("ID", F.when(F.pmod("ID", F.lit(3)) != 0, F.col("ID"))))


@query
def null_count(spark, folder):
    return clean.null_count(_with_gaps(spark, folder))


@query
def fill_gaps(spark, folder):
    return clean.fill_gaps(_with_gaps(spark, folder))


@query
def duplicate_count(spark, folder):
    return clean.duplicate_count(_raw(spark, folder))


@query
def dedup_sum(spark, folder):
    return clean.merge_duplicates(_raw(spark, folder))


@query
def dedup_first(spark, folder):
    return clean.keep_first(_raw(spark, folder))


@query
def outlier_bounds_double(spark, folder):
    readings = spark.read.parquet(f"{folder}/events.parquet").select(F.col("value").alias("Vehicles"))
    return clean.outlier_bounds(readings, spread_values=True)


@query
def outlier_bounds(spark, folder):
    return clean.outlier_bounds(_raw(spark, folder))


@query
def outlier_count(spark, folder):
    return clean.outlier_count(_raw(spark, folder))


@query
def cap_outliers(spark, folder):
    return clean.cap_outliers(_raw(spark, folder))


# --- calendar and slices -------------------------------------------------------------------


@query
def temporal_features(spark, folder):
    return add_calendar(_raw(spark, folder))


@query
def period_of_day(spark, folder):
    return _first(spark, folder)


@query
def date_range_slice(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    return analysis.prepare(readings_from_events(events, days=WEEK), "sum")


@query
def date_range_stored(spark, folder):
    path = scratch_folder(spark, "timeseries")
    write_readings(_first(spark, folder), path)
    return read_readings(spark, path, *WEEK)


@query
def timeseries_first5(spark, folder):
    return patterns.timeseries_first(_processed(spark, folder))


@query
def junction_slice(spark, folder):
    processed = _processed(spark, folder)
    return patterns.junction_slice(processed, patterns.top_junctions(processed, 1))


@query
def cluster_slice(spark, folder):
    processed = _processed(spark, folder)
    return clusters.cluster_slice(processed, _assigned(processed), [0, 2])


# --- patterns ------------------------------------------------------------------------------


@query
def feature_stats(spark, folder):
    return _rounded(patterns.feature_stats(_processed(spark, folder)), "Weekend_Pct")


@query
def junction_volume(spark, folder):
    return patterns.junction_volume(_processed(spark, folder))


@query
def top_junctions(spark, folder):
    return patterns.top_junctions(_processed(spark, folder, None))


@query
def overall_stats(spark, folder):
    return _rounded(patterns.overall_stats(_processed(spark, folder)), "Avg_Vehicles")


@query
def data_summary(spark, folder):
    return patterns.data_summary(_first(spark, folder)).select(
        "total_records", "num_junctions", "date_range.start", "date_range.end", "date_range.days", "vehicle_stats.*"
    )


@query
def hourly_trend(spark, folder):
    return _rounded(patterns.hourly_trend(_processed(spark, folder)), "Avg_Vehicles")


@query
def peak_hour(spark, folder):
    return _rounded(patterns.peak_hour(_processed(spark, folder)), "PeakHourTraffic")


@query
def weekly_pattern(spark, folder):
    return _rounded(patterns.weekly_pattern(_processed(spark, folder)), "Avg_Vehicles")


@query
def weekday_weekend_gap(spark, folder):
    gap = patterns.weekday_weekend_gap(_processed(spark, folder))
    return _rounded(gap, *gap.columns)


def _fractional(spark: SparkSession, folder: str) -> DataFrame:
    """The values of the events as they are, of which there are nearly as many as rows."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select((F.pmod("user_id", F.lit(8)) + 1).cast("bigint").alias("Junction"), F.col("value").alias("Vehicles"))


@query
def junction_spread_double(spark, folder):
    return _rounded(patterns.junction_spread(_fractional(spark, folder), spread_values=True), "Mean", "Median", "Std", "IQR")


@query
def boxplot_stats_double(spark, folder):
    found = patterns.boxplot_stats(_fractional(spark, folder), spread_values=True)
    return _rounded(found, "Q1", "Median", "Q3", "Mean")


@query
def junction_spread(spark, folder):
    return _rounded(patterns.junction_spread(_processed(spark, folder)), "Mean", "Std")


@query
def junction_describe(spark, folder):
    return _rounded(patterns.junction_describe(_processed(spark, folder)), "Mean", "Std")


@query
def boxplot_stats(spark, folder):
    return _rounded(patterns.boxplot_stats(_processed(spark, folder)), "Mean")


@query
def boxplot_outliers(spark, folder):
    return patterns.boxplot_outliers(_processed(spark, folder))


@query
def hourly_overall(spark, folder):
    return _rounded(patterns.hourly_overall(_processed(spark, folder)), "Avg_Vehicles")


@query
def hourly_daytype(spark, folder):
    return _rounded(patterns.hourly_daytype(_processed(spark, folder)), "Avg_Vehicles")


@query
def hourly_by_cluster(spark, folder):
    processed = _kept(patterns.hour_cube(_processed(spark, folder)))
    return _rounded(clusters.hourly_by_cluster(processed, _assigned(processed)), "Avg_Vehicles")


@query
def heatmap_hour_dow(spark, folder):
    table = patterns.heatmap(_processed(spark, folder))
    return _rounded(table, *[c for c in table.columns if c.startswith("Day_")])


@query
def heatmap_by_junction(spark, folder):
    table = patterns.heatmap(_processed(spark, folder), "Junction")
    return _rounded(table, *[c for c in table.columns if c.startswith("Day_")])


@query
def heatmap_by_cluster(spark, folder):
    processed = _kept(patterns.hour_cube(_processed(spark, folder)))
    table = patterns.heatmap(clusters.cluster_cube(processed, _assigned(processed)), "Cluster")
    return _rounded(table, *[c for c in table.columns if c.startswith("Day_")])


@query
def cluster_distribution(spark, folder):
    return _rounded(clusters.cluster_distribution(_assigned(_raw(spark, folder, None))), "Percentage")


@query
def cluster_member_curves(spark, folder):
    processed = _processed(spark, folder, None)
    return _rounded(clusters.cluster_member_curves(processed, _assigned(processed)), "Avg_Vehicles")


@query
def vehicle_histogram(spark, folder):
    return _rounded(patterns.vehicle_histogram(_processed(spark, folder)), "Bin_Start", "Bin_End", "Mean")


@query
def weekly_by_junction(spark, folder):
    return _rounded(patterns.weekly_by_junction(_processed(spark, folder)), "Avg_Vehicles")


@query
def junction_detail(spark, folder):
    return _rounded(
        patterns.junction_detail(_shaped(spark, folder)), "Avg_Vehicles", "Std_Vehicles", "Weekday_Avg", "Weekend_Avg"
    )


@query
def overview_metrics(spark, folder):
    shaped = _kept(_shaped(spark, folder))
    assigned, profile = _assigned(shaped), _cluster_profiles(shaped)
    return clusters.overview_metrics(shaped, assigned, profile, rules.rules(profile, shaped, assigned))


@query
def profile_points(spark, folder):
    return _rounded(clusters.profile_points(_labelled(spark, folder)), "Avg_Vehicles", "Morning_Peak", "Evening_Peak")


@query
def cluster_profile_bars(spark, folder):
    bars = clusters.cluster_profile_bars(_cluster_profiles(_shaped(spark, folder)))
    return _rounded(bars, "AvgTraffic", "AvgStdDev")


@query
def display_profiles(spark, folder):
    return clusters.display_profiles(_cluster_profiles(_shaped(spark, folder)))


# --- junction tables -----------------------------------------------------------------------


def _rounded_features(table: DataFrame) -> DataFrame:
    exact = {"Junction", "PeakHour", "Vehicles_min", "Vehicles_max"}
    return _rounded(table, *[c for c in table.columns if c not in exact])


@query
def junction_hour_pivot(spark, folder):
    return _rounded(profiles.junction_hour_pivot(_processed(spark, folder)), *profiles.HOUR_COLUMNS)


@query
def junction_stats(spark, folder):
    return _rounded_features(profiles.junction_stats(_processed(spark, folder)))


@query
def weekend_ratio(spark, folder):
    return _rounded_features(profiles.weekend_ratio(_processed(spark, folder)))


@query
def junction_features(spark, folder):
    return _rounded_features(profiles.junction_features(_processed(spark, folder)))


@query
def junction_features_sites(spark, folder):
    return _rounded_features(profiles.junction_features(_processed(spark, folder, None)))


@query
def junction_profiles(spark, folder):
    table = profiles.junction_profiles(_processed(spark, folder))
    return _rounded(table, "Avg_Vehicles", "Morning_Peak", "Evening_Peak")


@query
def enhanced_profiles(spark, folder):
    table = profiles.enhanced_profiles(_processed(spark, folder, None))
    return _rounded(table, *[c for c in PROFILE_COLUMNS if c != "Max_Vehicles"])


@query
def junction_lookup(spark, folder):
    shaped = _shaped(spark, folder)
    return _rounded(clusters.junction_lookup(_assigned(shaped), _cluster_profiles(shaped)), "AvgTraffic")


# --- clusters ------------------------------------------------------------------------------


def _standardized(spark: SparkSession, folder: str, sites: int | None = 8) -> DataFrame:
    table = profiles.junction_profiles(_processed(spark, folder, sites))
    return clusters.standardize(table, profiles.PROFILE_FEATURES)


def _with_cluster(table: DataFrame) -> DataFrame:
    return table.withColumn("Cluster", F.pmod("Junction", F.lit(3)).cast("int"))


@query
def standardized_features(spark, folder):
    return _rounded(_standardized(spark, folder, None), *profiles.PROFILE_FEATURES)


@query
def cluster_labels(spark, folder):
    return _labelled(spark, folder).select("Junction", "Cluster", "Congestion_Level")


@query
def cluster_profiles(spark, folder):
    table = _cluster_profiles(_shaped(spark, folder))
    return _rounded(
        table, "AvgTraffic", "AvgStdDev", "AvgMaxTraffic", "PeakHourAvgTraffic", "AvgWeekendWeekdayRatio"
    )


@query
def cluster_centers(spark, folder):
    return _rounded(clusters.cluster_centers(_labelled(spark, folder)), *profiles.PROFILE_FEATURES)


@query
def silhouette(spark, folder):
    table = _with_cluster(_standardized(spark, folder))
    return _rounded(clusters.silhouette(table, profiles.PROFILE_FEATURES), "Silhouette")


@query
def silhouette_squared_sites(spark, folder):
    table = _with_cluster(_standardized(spark, folder, None))
    return _rounded(clusters.silhouette(table, profiles.PROFILE_FEATURES, distance="squared"), "Silhouette")


@query
def silhouette_sites(spark, folder):
    table = _with_cluster(_standardized(spark, folder, None))
    return _rounded(clusters.silhouette(table, profiles.PROFILE_FEATURES), "Silhouette")


@query
def davies_bouldin(spark, folder):
    table = _with_cluster(_standardized(spark, folder))
    return _rounded(clusters.davies_bouldin(table, profiles.PROFILE_FEATURES), "Davies_Bouldin")


@query
def davies_bouldin_sites(spark, folder):
    table = _with_cluster(_standardized(spark, folder, None))
    return _rounded(clusters.davies_bouldin(table, profiles.PROFILE_FEATURES), "Davies_Bouldin")


@query
def kmeans_a(spark, folder):
    _, labelled = analysis.cluster_profiles_of(_shaped(spark, folder))
    return labelled


@query
def kmeans_b(spark, folder):
    features = _kept(profiles.junction_features(_shaped(spark, folder)))
    _, tables = analysis.cluster_matrix(features)
    return tables["cluster_assignments"].join(tables["cluster_profiles"], "Cluster")


@query
def kmeans_a_apart(spark, folder):
    _, labelled = analysis.cluster_profiles_of(_apart(spark, folder))
    return _rounded(labelled.drop("Cluster"), *[c for c in PROFILE_COLUMNS if c != "Max_Vehicles"])


@query
def kmeans_b_apart(spark, folder):
    _, tables = analysis.cluster_matrix(_kept(profiles.junction_features(_apart(spark, folder))))
    joined = tables["cluster_assignments"].join(tables["cluster_profiles"], "Cluster").drop("Cluster")
    return _rounded(joined, *[c for c, kind in joined.dtypes if kind == "double"])


@query
def k_selection_apart(spark, folder):
    """The best number of clusters and its score."""
    table = _kept(profiles.enhanced_profiles(_apart(spark, folder)))
    choice = kmeans.choose_k(table, profiles.PROFILE_FEATURES)
    return _rounded(choice.orderBy(F.desc("Silhouette"), "k").limit(1).select("k", "Silhouette"), "Silhouette")


@query
def predict_cluster_apart(spark, folder):
    """Clusters by their smallest junction, as their numbers have no meaning."""
    found = _predicted(_kept(_apart(spark, folder)))
    return found.join(found.groupBy("Cluster").agg(F.min("Junction").alias("Smallest")), "Cluster").select("Junction", "Smallest")


@query
def model_roundtrip_apart(spark, folder):
    return _reloaded(profiles.junction_features(_apart(spark, folder))).select("Junction", "CongestionLevel")


@query
def kmeans_sites(spark, folder):
    table = _kept(profiles.enhanced_profiles(_processed(spark, folder, None)))
    return kmeans.fit_clusters(table, profiles.PROFILE_FEATURES).assign(table)


@query
def cluster_scores_sites(spark, folder):
    """Scores of a fitted clustering of all users as junctions."""
    features = _kept(profiles.junction_features(_processed(spark, folder, None)))
    return analysis.cluster_matrix(features)[1]["cluster_scores"]


@query
def cluster_scores_apart(spark, folder):
    """The same for three levels far apart, which leave only one good clustering."""
    table = _kept(profiles.enhanced_profiles(_apart(spark, folder)))
    model = kmeans.fit_clusters(table, profiles.PROFILE_FEATURES)
    scores = kmeans.cluster_scores(table, profiles.PROFILE_FEATURES, model.assign(table))
    return _rounded(scores, "Silhouette", "Davies_Bouldin")


@query
def k_selection(spark, folder):
    features = _kept(profiles.junction_features(_shaped(spark, folder)))
    return kmeans.choose_k(features, profiles.MATRIX_FEATURES)


@query
def predict_cluster(spark, folder):
    """Assign the junctions of the second half of the clock range with a model of the first half."""
    return _predicted(_kept(_shaped(spark, folder)))


def _predicted(readings: DataFrame) -> DataFrame:
    clock = clock_range(readings).first()
    half = F.col("DateTime") < F.lit(clock["First"] + (clock["Last"] - clock["First"]) / 2).cast("timestamp_ntz")
    known = _kept(profiles.junction_features(readings.where(half)))
    return kmeans.fit_clusters(known, profiles.MATRIX_FEATURES).assign(profiles.junction_features(readings.where(~half)))


@query
def model_roundtrip(spark, folder):
    return _reloaded(profiles.junction_features(_shaped(spark, folder)))


def _reloaded(features: DataFrame) -> DataFrame:
    """Assignments by a model that was saved and loaded."""
    spark, features = features.sparkSession, _kept(features)
    model, tables = analysis.cluster_matrix(features)
    path = scratch_folder(spark, "clustering")
    model.save(path, tables["cluster_profiles"])
    loaded, stored_profiles = kmeans.ClusterModel.load(spark, path)
    return loaded.assign(features).join(stored_profiles, "Cluster").select("Junction", "Cluster", "CongestionLevel")


# --- forecasting ---------------------------------------------------------------------------


def _split(spark: SparkSession, folder: str, sites: int | None = 8) -> DataFrame:
    return forecast.training_matrix(_processed(spark, folder, sites))


def _persistence(spark: SparkSession, folder: str) -> DataFrame:
    """A prediction without a model: the count 24 rows earlier."""
    return _split(spark, folder).withColumn("Predicted", F.col(forecast.YESTERDAY).cast("double"))


def _forest_of(readings: DataFrame, **settings) -> tuple:
    """The pooled forest of some readings and their split table."""
    split = _kept(forecast.add_site_mean(forecast.training_matrix(readings)))
    return forecast.train_all(split, **settings), split


def fitted_forest(spark: SparkSession, folder: str) -> tuple:
    return _forest_of(_shaped(spark, folder))


@query
def lag_features(spark, folder):
    return forecast.lag_features(_processed(spark, folder))


@query
def lag_features_sites(spark, folder):
    return forecast.lag_features(_processed(spark, folder, None))


@query
def chrono_split(spark, folder):
    return _split(spark, folder).select("Junction", "DateTime", "RowNo", "RowCount", "Side")


@query
def split_report(spark, folder):
    return forecast.split_report(_split(spark, folder, None))


@query
def forecast_metrics(spark, folder):
    return _rounded(forecast.forecast_metrics(_persistence(spark, folder)), "MAE", "R2")


@query
def actual_vs_predicted(spark, folder):
    return forecast.actual_vs_predicted(_persistence(spark, folder))


@query
def rf_train(spark, folder):
    model, split = fitted_forest(spark, folder)
    return forecast.forecast_metrics(forecast.predict(model, split))


def site_forests(spark: SparkSession, folder: str, sites: int | None = 8) -> tuple[DataFrame, DataFrame]:
    """A forest for each junction and the rows it was made from."""
    readings = _shaped(spark, folder) if sites else _processed(spark, folder, None)
    split = _kept(forecast.training_matrix(readings))
    return _kept(forecast.train_sites(split)), split


@query
def rf_train_each(spark, folder):
    trained, split = site_forests(spark, folder)
    return forecast.forecast_metrics(forecast.predict_sites(trained, split))


@query
def rf_train_sites(spark, folder):
    """As above, with every user as a junction."""
    trained, split = site_forests(spark, folder, None)
    return forecast.forecast_metrics(forecast.predict_sites(trained, split))


@query
def forecast_24h_sites(spark, folder):
    return forecast.forecast_sites(*site_forests(spark, folder, None))


@query
def feature_importance_sites(spark, folder):
    trained, _ = site_forests(spark, folder, None)
    return forecast.importance_sites(trained)


@query
def forest_stump_sites(spark, folder):
    """The first split of each junction's forest when every tree has all rows, on the counts as they are."""
    split = _kept(forecast.training_matrix(_processed(spark, folder, None)))
    stumps = forecast.train_sites(split, trees=1, depth=1, seed=None)
    at = F.col("Feature")[0]
    feature = F.when(at >= 0, F.element_at(F.array(*[F.lit(f) for f in forecast.FEATURES]), at + 1))
    return _rounded(
        stumps.select(
            "Junction",
            feature.alias("Feature"),
            F.when(at >= 0, F.col("Threshold")[0]).alias("Threshold"),
            F.col("Mean")[0].alias("Mean"),
            F.when(at >= 0, F.col("Mean")[1]).alias("Left_Mean"),
            F.when(at >= 0, F.col("Mean")[2]).alias("Right_Mean"),
        ),
        "Mean",
        "Left_Mean",
        "Right_Mean",
    )


CALENDAR_FEATURES = forecast.FEATURES[:3]


def _stepped(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Forests of two junctions whose count hangs on the hour, highest before noon; every tree has all rows."""
    level = F.col("Junction") * 100 + F.pmod(F.col("Hour") + 12, F.lit(24))
    readings = _processed(spark, folder, 2).withColumn("Vehicles", level.cast("bigint"))
    split = _kept(forecast.training_matrix(readings))
    return _kept(forecast.train_sites(split, CALENDAR_FEATURES, seed=None)), split


@query
def rf_train_step(spark, folder):
    trained, split = _stepped(spark, folder)
    return forecast.forecast_metrics(forecast.predict_sites(trained, split, CALENDAR_FEATURES))


@query
def feature_importance_step(spark, folder):
    return _rounded(forecast.importance_sites(_stepped(spark, folder)[0], CALENDAR_FEATURES), "Importance")


@query
def forecast_24h_step(spark, folder):
    return forecast.forecast_sites(*_stepped(spark, folder))


@query
def forecast_summary_step(spark, folder):
    return forecast.forecast_summary(forecast.forecast_sites(*_stepped(spark, folder)))


@query
def feature_importance(spark, folder):
    return forecast.feature_importance(*fitted_forest(spark, folder))


@query
def actual_vs_predicted_rf(spark, folder):
    model, split = fitted_forest(spark, folder)
    return forecast.actual_vs_predicted(forecast.predict(model, split))


@query
def forecast_24h(spark, folder):
    return forecast.forecast_24h(*fitted_forest(spark, folder))


@query
def forecast_summary(spark, folder):
    return forecast.forecast_summary(forecast.forecast_24h(*fitted_forest(spark, folder)))


# With a constant count per junction every forecast is exact, whatever the trees draw.
SMALL_FOREST = {"trees": 10, "depth": 6}


@query
def rf_train_level(spark, folder):
    model, split = _forest_of(_level(spark, folder), **SMALL_FOREST)
    return forecast.forecast_metrics(forecast.predict(model, split))


@query
def rf_train_each_level(spark, folder):
    split = _kept(forecast.training_matrix(_level(spark, folder)))
    models = forecast.train_each(split, range(1, 9), trees=2, depth=2)
    return forecast.forecast_metrics(forecast.predict_each(models, split))


@query
def actual_vs_predicted_level(spark, folder):
    model, split = _forest_of(_level(spark, folder), **SMALL_FOREST)
    return forecast.actual_vs_predicted(forecast.predict(model, split))


@query
def forecast_24h_level(spark, folder):
    return forecast.forecast_24h(*_forest_of(_level(spark, folder), **SMALL_FOREST))


@query
def forecast_summary_level(spark, folder):
    return forecast.forecast_summary(forecast.forecast_24h(*_forest_of(_level(spark, folder), **SMALL_FOREST)))


@query
def feature_importance_total(spark, folder):
    """The features of the forest, and what their importances add up to."""
    found = forecast.feature_importance(*_forest_of(_apart(spark, folder), **SMALL_FOREST))
    names = F.array_join(F.sort_array(F.collect_list("Feature")), ",").alias("Features")
    return _rounded(found.agg(names, F.sum("Importance").alias("Total")), "Total")


# --- recommendations -----------------------------------------------------------------------


@query
def recommendations(spark, folder):
    table = recommend.recommendations(_labelled(spark, folder))
    return table.withColumn("Recommendations", F.array_join("Recommendations", "\n"))


@query
def recommendation_lines(spark, folder):
    return recommend.recommendation_lines(recommend.recommendations(_labelled(spark, folder)))


@query
def recommendations_export(spark, folder):
    return recommend.recommendations_export(recommend.recommendations(_labelled(spark, folder)))


@query
def recommendation_history(spark, folder):
    table = recommend.recommendation_history(_labelled(spark, folder))
    return _rounded(
        table.withColumn("Recommendations", F.array_join("Recommendations", "\n")), "Morning_Peak", "Evening_Peak"
    )


@query
def recommendation_log(spark, folder):
    """A log of two runs, the second of some junctions and repeated."""
    labelled, path = _kept(_labelled(spark, folder)), scratch_folder(spark, "history")
    recommend.append_history(recommend.recommendation_history(labelled), path, "monday")
    for _ in range(2):
        recommend.append_history(recommend.recommendation_history(labelled.where("Junction <= 4")), path, "tuesday")
    table = recommend.read_history(spark, path)
    return _rounded(
        table.withColumn("Recommendations", F.array_join("Recommendations", "\n")), "Morning_Peak", "Evening_Peak"
    )


@query
def junction_report(spark, folder):
    return _rounded(recommend.junction_report(_labelled(spark, folder)), "Avg_Traffic", "Morning_Peak", "Evening_Peak")


# --- rules ---------------------------------------------------------------------------------


def _rules(spark: SparkSession, folder: str) -> DataFrame:
    shaped = _kept(_shaped(spark, folder))
    return analysis.optimization_rules(_cluster_profiles(shaped), shaped, _assigned(shaped))


def _rules_of(*types: str) -> Query:
    return lambda spark, folder: _rules(spark, folder).where(F.col("rule_type").isin(list(types)))


QUERIES["rule_peak_hour"] = _rules_of(rules.PEAK_TYPE)
QUERIES["rule_signal_timing"] = _rules_of(rules.SIGNAL_TYPE)
QUERIES["rule_rush_hour"] = _rules_of(rules.MORNING_TYPE, rules.EVENING_TYPE)
QUERIES["rule_weekend"] = _rules_of(rules.WEEKEND_TYPE)
QUERIES["rules"] = _rules


@query
def rules_sites(spark, folder):
    readings = _processed(spark, folder, None)
    return rules.rules(_cluster_profiles(readings), readings, _assigned(readings))


@query
def rules_filtered(spark, folder):
    return rules.filter_rules(_rules(spark, folder), ["Critical", "High"], [0, 1])


@query
def rules_shown(spark, folder):
    return rules.filter_counts(_rules(spark, folder), ["Critical", "High"], [0, 1])


@query
def rules_summary(spark, folder):
    return rules.rules_summary(_rules(spark, folder))


# --- whole analyses ------------------------------------------------------------------------


@query
def complete_analysis(spark, folder):
    """The rules at the end of the whole analysis, with K-Means clusters."""
    return analysis.complete_analysis(_raw(spark, folder))["rules"]


@query
def advise(spark, folder):
    """The recommendations at the end of the whole profile analysis, with K-Means clusters."""
    return analysis.advise(_processed(spark, folder)).withColumn(
        "Recommendations", F.array_join("Recommendations", "\n")
    )



@query
def complete_analysis_apart(spark, folder):
    """The same on readings of three levels far apart; numbers of clusters and rules have no meaning."""
    readings = _raw(spark, folder).withColumn("Vehicles", F.col("Vehicles") + _offset())
    return analysis.complete_analysis(readings)["rules"].drop("rule_no", "cluster_id")


@query
def advise_apart(spark, folder):
    return analysis.advise(_apart(spark, folder)).withColumn("Recommendations", F.array_join("Recommendations", "\n"))


def _raw_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "raw")
    write_csv(_raw(spark, folder), path)
    return path


@query
def process_traffic_data(spark, folder):
    return analysis.process_readings(spark, _raw_csv(spark, folder))["processed"]


@query
def preprocess_pipeline(spark, folder):
    features = analysis.preprocess(spark, _raw_csv(spark, folder))["junction_features"]
    return _rounded(features, *[c for c, kind in features.dtypes if kind == "double"])


@query
def prepare_without_id(spark, folder):
    """Files whose names and lines are in the order of the IDs, which they don't hold."""
    path = scratch_folder(spark, "raw")
    write_csv(_raw(spark, folder).orderBy("ID").drop("ID"), path)
    return analysis.preprocess(spark, path)["timeseries"]


@query
def run_pattern_analysis(spark, folder):
    found = analysis.pattern_analysis(_processed(spark, folder))
    joined = found["peak_hour"].join(found["junction_spread"], "Junction")
    return _rounded(joined, *[c for c, kind in joined.dtypes if kind == "double"])


@query
def run_ml_engine(spark, folder):
    """The whole profile and forecast analysis on the counts as they are, with its default forest."""
    found = analysis.learn(_processed(spark, folder))
    return found["forecast_summary"].join(found["forecast_metrics"].where("Side = 'test'"), "Junction")


@query
def run_ml_engine_level(spark, folder):
    found = analysis.learn(_level(spark, folder), forest=SMALL_FOREST)
    return found["forecast_summary"].join(found["forecast_metrics"].where("Side = 'test'"), "Junction")
