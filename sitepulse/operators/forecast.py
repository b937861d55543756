"""Next-hour forecasting: lag features, chronological split, random forest, 24-hour roll-out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions.temporal import calendar_columns
from sitepulse.operators import forests
from sitepulse.operators.series import BLOCK, add_lags, number_rows

LAST_HOUR = "Traffic_Last_Hour"
YESTERDAY = "Traffic_Yesterday_Same_Hour"
LAGS = {LAST_HOUR: 1, YESTERDAY: 24}
FEATURES = ["Hour", "DayOfWeek", "IsWeekend", LAST_HOUR, YESTERDAY]
SITE_MEAN = "Site_Mean"
HORIZON = 24


def _lagged(processed: DataFrame, block_rows: int) -> DataFrame:
    return add_lags(processed, LAGS, block_rows=block_rows).dropna("any")


def lag_features(processed: DataFrame, block_rows: int = 4096) -> DataFrame:
    """Vehicles one and 24 rows earlier in the junction's series; rows with any null are dropped.

    Lags count rows, not hours: over a gap in the series they reach further back.
    """
    return _lagged(processed, block_rows).drop(BLOCK)


def chrono_split(lagged: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Append RowNo, TrainRows and Side: the earliest share of each junction is "train", the rest "test"."""
    numbered = number_rows(lagged, BLOCK if BLOCK in lagged.columns else None)
    train_rows = F.floor(F.col("RowCount") * F.lit(train_share))
    return (
        numbered.withColumn("TrainRows", train_rows)
        .withColumn("Side", F.when(F.col("RowNo") <= F.col("TrainRows"), "train").otherwise("test"))
        .drop(BLOCK)
    )


def training_matrix(processed: DataFrame, train_share: float = 0.8, block_rows: int = 4096) -> DataFrame:
    """Lag features and split in one go; the split reuses the blocks that the lags were cut into."""
    return chrono_split(_lagged(processed, block_rows), train_share)


def split_report(split: DataFrame) -> DataFrame:
    """Size and clock range of both sides per junction."""
    return split.groupBy("Junction", "Side").agg(
        F.count(F.lit(1)).alias("Records"), F.min("DateTime").alias("First"), F.max("DateTime").alias("Last")
    )


# --- model ---------------------------------------------------------------------------------


def add_site_mean(split: DataFrame) -> DataFrame:
    """Mean of the training side per junction, which lets one pooled forest tell junctions apart."""
    train = split.where(F.col("Side") == "train")
    means = train.groupBy("Junction").agg(F.avg("Vehicles").alias(SITE_MEAN))
    overall = train.agg(F.avg("Vehicles").alias("mean")).scalar()
    # A junction too short to have a training side gets the mean of all training rows.
    return split.join(means, "Junction", "left").withColumn(SITE_MEAN, F.coalesce(F.col(SITE_MEAN), overall))


def _fit(
    train: DataFrame, features: list[str], trees: int, depth: int, seed: int, partitions: int
) -> PipelineModel:
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="Vehicles",
        predictionCol="Predicted",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        featureSubsetStrategy="all",
    )
    # Trees depend on how rows are spread over partitions. Hashing into a stated number of them, each
    # in clock order, makes the same data give the same forest on any cluster.
    needed = train.select("Junction", "DateTime", "Vehicles", *features)
    ordered = needed.repartition(partitions, "Junction", "DateTime").sortWithinPartitions("Junction", "DateTime")
    model = forest.fit(assembler.transform(ordered))
    return PipelineModel(stages=[assembler, model])


def train_all(
    split: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42, partitions: int = 8
) -> PipelineModel:
    """One forest for all junctions, on the five features and the junction's training mean.

    The number of Spark jobs does not depend on the number of junctions. ``partitions`` is part of the
    model's definition, as the seed is: choose it by the size of the data, not of the cluster. ``split`` comes from
    ``training_matrix`` followed by ``add_site_mean``.
    """
    return _fit(split.where(F.col("Side") == "train"), [*FEATURES, SITE_MEAN], trees, depth, seed, partitions)


def train_junction(
    split: DataFrame, junction: int, trees: int = 100, depth: int = 10, seed: int = 42, partitions: int = 1
) -> PipelineModel:
    """A forest of one junction on the five features."""
    side = (F.col("Side") == "train") & (F.col("Junction") == junction)
    return _fit(split.where(side), FEATURES, trees, depth, seed, partitions)


def train_each(
    split: DataFrame,
    junctions: Sequence[int],
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    parallelism: int = 8,
    partitions: int = 1,
) -> dict[int, PipelineModel]:
    """A forest of its own for each of the named junctions, fitted side by side.

    Every fit is a series of Spark jobs, so this is for junctions of interest; ``train_all`` covers any
    number at the cost of one fit. A named junction without training rows gets no forest.
    """
    wanted = split.where((F.col("Side") == "train") & F.col("Junction").isin(list(junctions)))
    known = sorted(row["Junction"] for row in wanted.select("Junction").distinct().collect())  # at most those named
    with ThreadPool(min(parallelism, max(len(known), 1))) as pool:
        models = pool.map(lambda junction: train_junction(split, junction, trees, depth, seed, partitions), known)
    return dict(zip(known, models))


def predict_each(models: dict[int, PipelineModel], split: DataFrame) -> DataFrame:
    """Rows of the junctions that have a forest of their own, with Predicted from it."""
    parts = [predict(model, split.where(F.col("Junction") == junction)) for junction, model in models.items()]
    return reduce(DataFrame.unionByName, parts)


def predict(model: PipelineModel, split: DataFrame) -> DataFrame:
    """Rows of the split with the column Predicted."""
    return model.transform(split).drop("features")


def forecast_metrics(predicted: DataFrame) -> DataFrame:
    """MAE and R2 per junction and side.

    R2 of a constant series is 1 when it is predicted exactly, else 0, and null for a single row.
    """
    actual, guess = F.col("Vehicles").cast("double"), F.col("Predicted")
    n = F.count(F.lit(1))
    sums = predicted.groupBy("Junction", "Side").agg(
        n.alias("Records"),
        F.avg(F.abs(actual - guess)).alias("MAE"),
        F.sum(F.pow(actual - guess, F.lit(2))).alias("_error"),
        (F.var_pop(actual) * n).alias("_spread"),
    )
    r2 = F.when(F.col("_spread") > 0, 1 - F.col("_error") / F.col("_spread")).when(F.col("_error") == 0, 1.0).otherwise(0.0)
    return sums.withColumn("R2", F.when(F.col("Records") > 1, r2)).drop("_error", "_spread")


def _forest(model: PipelineModel) -> RandomForestRegressionModel:
    return model.stages[-1]


def feature_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Importance of each feature, highest first. ``rows`` only supplies the session."""
    names = model.stages[0].getInputCols()
    weights = _forest(model).featureImportances.toArray()
    pairs = [(name, float(weight)) for name, weight in zip(names, weights)]
    table = rows.sparkSession.createDataFrame(pairs, "Feature string, Importance double")
    return table.orderBy(F.desc("Importance"), "Feature")


def actual_vs_predicted(predicted: DataFrame, n: int = 200) -> DataFrame:
    """The first n test rows of each junction with actual and predicted counts."""
    step = F.col("RowNo") - F.col("TrainRows")
    return (
        predicted.where((F.col("Side") == "test") & (step <= n))
        .select("Junction", step.alias("TimeIndex"), "DateTime", F.col("Vehicles").alias("Actual"), "Predicted")
    )


def last_day(split: DataFrame) -> DataFrame:
    """Per junction with at least 24 rows: its last clock time and last 24 counts, oldest first."""
    carried = [c for c in (SITE_MEAN,) if c in split.columns]
    return (
        split.where((F.col("RowCount") >= HORIZON) & (F.col("RowNo") > F.col("RowCount") - HORIZON))
        .groupBy("Junction", *carried)
        .agg(
            F.max("DateTime").alias("LastTime"),
            F.transform(
                F.sort_array(F.collect_list(F.struct("RowNo", F.col("Vehicles").cast("double").alias("v")))),
                lambda x: x["v"],
            ).alias("Day"),
        )
    )


def roll_out_state(split: DataFrame) -> DataFrame:
    """``last_day`` with the calendar of the next 24 hours, by the true clock."""
    steps = F.sequence(F.lit(1), F.lit(HORIZON))

    def ahead(name: str) -> Column:
        clock = lambda hours: F.col("LastTime") + F.make_dt_interval(hours=hours)
        return F.transform(steps, lambda hours: calendar_columns(clock(hours))[name])

    return last_day(split).withColumns(
        {"Hours": ahead("Hour"), "Weekdays": ahead("DayOfWeek"), "Weekends": ahead("IsWeekend")}
    )


def _by_step(rolled: DataFrame) -> DataFrame:
    return rolled.select("Junction", "LastTime", F.posexplode("Ahead").alias("at", "Predicted")).select(
        "Junction",
        (F.col("at") + 1).alias("Step"),
        (F.col("LastTime") + F.make_dt_interval(hours=F.col("at") + 1)).alias("DateTime"),
        "Predicted",
    )


def forecast_24h(model: PipelineModel, split: DataFrame) -> DataFrame:
    """Recursive forecast of the next 24 hours for every junction with at least 24 rows.

    Each step predicts from the previous step's prediction and from the count 24 rows before it.
    Predictions below 0 become 0. Calendar features follow the true clock. The trees are read once as arrays, and
    a task takes many junctions through all steps, so the plan is one narrow stage.
    """
    rest = [c for c in model.stages[0].getInputCols() if c not in FEATURES]
    state = roll_out_state(split)
    return _by_step(forests.roll_all(forests.flat_forest(_forest(model), split.sparkSession), state, rest))


def train_sites(split: DataFrame, features: Sequence[str] = tuple(FEATURES), **forest) -> DataFrame:
    """A forest of its own for every junction, as rows of arrays: see ``forests.train_sites`` for the arguments."""
    return forests.train_sites(split, list(features), **forest)


def predict_sites(trained: DataFrame, split: DataFrame, features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Rows of the junctions that have a forest of their own, with Predicted from it."""
    return forests.predict_sites(trained, split, list(features))


def importance_sites(trained: DataFrame, features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Importance of each feature for each junction that has a forest of its own."""
    return forests.site_importance(trained, list(features))


def forecast_sites(trained: DataFrame, split: DataFrame) -> DataFrame:
    """As ``forecast_24h``, each junction by its own forest; those without one are left out.

    A forest may have been trained on the first of ``FEATURES`` only.
    """
    return _by_step(forests.roll_each(trained, roll_out_state(split)))


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """Mean and peak of the forecast per junction; the earliest step wins a tie."""
    best = F.max(F.struct("Predicted", (-F.col("Step")).alias("back"), "DateTime"))
    return (
        forecast.groupBy("Junction")
        .agg(F.avg("Predicted").alias("Avg_Predicted"), best.alias("best"))
        .select(
            "Junction",
            "Avg_Predicted",
            F.col("best.Predicted").alias("Peak_Predicted"),
            (-F.col("best.back")).alias("Peak_Step"),
            F.col("best.DateTime").alias("Peak_Time"),
        )
    )
