"""Rider-type and duration models: Spark ML pipelines on trips joined with their district.

Rows that are equal in all a model reads may stand as one, with their number in `row_count` (`counted`). Fits,
weights and evaluations take such tables and give what they give for the single rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions import scalars
from tripweave.operators.relational import row_sample, with_district
from tripweave.session import split_size
from tripweave.sources import contracts as C, files

# what is known when a vehicle is taken, and what its return adds
AT_PICKUP, AT_DROPOFF = C.AT_PICKUP, C.AT_DROPOFF

ROWS = "row_count"
FIT_SPLIT_BYTES = 8 << 20  # of a table of counted rows, which take ten bytes there and eighty as a model's blocks
FOREST_BINS = 32           # Spark's own number of values a forest tells apart in a column
FOREST_DRAWS = 1 << 21     # a forest's bootstrap draws single rows up to here, and groups of equal rows beyond
EXACT_VALUES = 100_000     # a column with no more values has its quantiles from the count of each


def model_input(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Cleaned trips with district and label: 1.0 casual, 0.0 subscriber."""
    return with_district(trips, stations, how="inner").withColumn("label", scalars.is_casual(F.col("rider_type")))


def counted(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Equal rows as one, with their number: `columns`, label and `row_count`."""
    return rows.groupBy(*_read(columns), "label").agg(F.sum(_count(rows)).alias(ROWS))


def _count(rows: DataFrame) -> Column:
    return F.col(ROWS) if ROWS in rows.columns else F.lit(1)


def _weighed_by(rows: DataFrame) -> dict[str, str]:
    return {"weightCol": ROWS} if ROWS in rows.columns else {}


def _read(columns: list[str]) -> list[str]:
    """The table's columns behind the names of features."""
    return ["district" if c == "district_vec" else c for c in columns]


# --- feature stages --------------------------------------------------------------------------

def district_index() -> StringIndexer:
    """Districts by falling frequency; one that was not seen in training gets an index of its own."""
    return StringIndexer(inputCol="district", outputCol="district_idx", handleInvalid="keep")


def district_one_hot() -> OneHotEncoder:
    return OneHotEncoder(inputCols=["district_idx"], outputCols=["district_vec"])


def assembled(columns: list[str], output: str = "assembled") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=output)


def standardised(column: str = "assembled", output: str = "features") -> StandardScaler:
    """Unit standard deviation; the mean stays, so sparse vectors stay sparse."""
    return StandardScaler(inputCol=column, outputCol=output)


def _index_of(rows: DataFrame) -> StringIndexerModel:
    """`district_index` fitted to counted rows."""
    named = rows.where(F.col("district").isNotNull()).groupBy("district").agg(F.sum(_count(rows)).alias("n"))
    labels = [r["district"] for r in named.orderBy(F.desc("n"), "district").collect()]
    bare = district_index()
    return StringIndexerModel.from_labels(labels, inputCol=bare.getInputCol(), outputCol=bare.getOutputCol(),
                                          handleInvalid=bare.getHandleInvalid())


def _scale_of(rows: DataFrame) -> ElementwiseProduct:
    """`standardised` fitted to counted rows: each stands for so many in the standard deviation."""
    found = rows.agg(Summarizer.metrics("variance").summary(F.col("assembled"), F.col(ROWS).cast("double")).alias("s"),
                     F.sum(ROWS).alias("n"), F.sum(F.col(ROWS).cast("double") ** 2).alias("squares")).first()
    n = found["n"]
    # Summarizer divides by n - squares / n, which is what unbiased means for weights that are not counts
    unbiased = (n - found["squares"] / n) / (n - 1) if n > 1 else 0.0
    spread = [math.sqrt(max(v * unbiased, 0.0)) for v in found["s"]["variance"].toArray().tolist()]
    return ElementwiseProduct(scalingVec=Vectors.dense([1 / s if s > 0 else 0.0 for s in spread]),
                              inputCol="assembled", outputCol="features")


# --- fitting ---------------------------------------------------------------------------------

def _fit(train: DataFrame, columns: list[str], kind: str = "lr", threshold: float = 0.5, trees: int = 30,
         depth: int = 8, seed: int = 42, regroup: bool = True) -> PipelineModel:
    """Fit on the different rows and their numbers, which are few if the columns have few values.

    A `weight` in `train` weighs rows beside their number; it must depend on label and `columns` alone. With
    `regroup` off, a table of counted rows is taken as it is.
    """
    if kind not in ("lr", "rf"):
        raise ValueError("kind is 'lr' or 'rf'")
    with split_size(train.sparkSession, FIT_SPLIT_BYTES):
        if kind == "rf":
            train = _snapped(train, [c for c in _read(columns) if train.schema[c].dataType.typeName() == "double"])
        rows = train
        if regroup or kind == "rf" or ROWS not in train.columns:
            weighed = ["weight"] if "weight" in train.columns else []
            rows = counted(train, [*columns, *weighed]).persist()
        try:
            stages = [_index_of(rows)]
            stages.append(district_one_hot().fit(stages[0].transform(rows)))
            stages.append(assembled(columns))
            vectors = PipelineModel(stages).transform(_shares(rows) if kind == "rf" else rows)
            if kind == "rf":
                forest = RandomForestClassifier(labelCol="label", featuresCol="assembled", numTrees=trees, maxDepth=depth,
                                                maxBins=FOREST_BINS, seed=seed, weightCol="share")
                return PipelineModel([*stages, forest.fit(vectors)])
            stages.append(_scale_of(vectors))
            weight = F.col(ROWS) * F.col("weight") if "weight" in rows.columns else F.col(ROWS)
            line = LogisticRegression(labelCol="label", threshold=threshold, weightCol="row_weight")
            return PipelineModel([*stages, line.fit(stages[-1].transform(vectors).select(
                "features", "label", weight.cast("double").alias("row_weight")))])
        finally:
            if rows is not train:
                rows.unpersist()


def _snapped(rows: DataFrame, columns: list[str], bins: int = FOREST_BINS) -> DataFrame:
    """Columns of more than `bins` values moved to the nearest of `bins` quantiles.

    A forest puts its thresholds halfway between neighbouring values it sees. Halfway between two quantiles is
    where values are told apart here, so a row goes down the trees as its own values would.
    """
    if not columns:
        return rows
    found = rows.agg(*[F.approx_count_distinct(c, 0.01).alias(c) for c in columns]).first()
    at, n = F.array(*[F.lit((i + 0.5) / bins) for i in range(bins)]), _count(rows).cast("bigint")
    # above that many values, few rows are equal, and counts say little
    quantiles = {c: F.percentile(c, at, n) if found[c] <= EXACT_VALUES else F.percentile_approx(c, at, 10_000)
                 for c in columns if found[c] > bins}
    if not quantiles:
        return rows
    kept = rows.agg(*[q.alias(c) for c, q in quantiles.items()]).first()
    return rows.withColumns({c: _nearest(F.col(c), sorted(set(kept[c]))) for c in quantiles})


def _nearest(x: Column, values: list[float]) -> Column:
    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(values[low])
        mid = (low + high) // 2
        return F.when(x <= (values[mid] + values[mid + 1]) / 2.0, among(low, mid)).otherwise(among(mid + 1, high))

    return F.when(x.isNull() | F.isnan(x), x).otherwise(among(0, len(values) - 1))


def _shares(rows: DataFrame, draws: int = FOREST_DRAWS) -> DataFrame:
    """The rows a bootstrap draws from, with weight `share`: all counted rows singly, if they are `draws` or fewer.

    Beyond, equal rows form groups of one size, which are drawn together. The shares always sum to the number of
    rows, and there are at most `draws` shares more than different rows, however many rows there are.
    """
    total = rows.agg(F.sum(ROWS)).first()[0] or 0
    pieces = F.ceil(F.col(ROWS) / max(1, math.ceil(total / draws)))
    dealt = rows.withColumn("share", F.col(ROWS) / pieces).withColumn("_piece", F.explode(F.sequence(F.lit(1), pieces)))
    return dealt.drop("_piece").repartition(rows.sparkSession.sparkContext.defaultParallelism)


def fit_numeric(train: DataFrame, columns: list[str]) -> PipelineModel:
    """A bare logistic regression on numeric columns."""
    return Pipeline(stages=[assembled(columns, "features"), LogisticRegression(labelCol="label", weightCol=ROWS)]).fit(
        counted(train, columns))


def fit_pickup(train: DataFrame, kind: str = "lr", extra: list[str] | None = None, **settings) -> PipelineModel:
    """Rider type from what is known at pickup. `extra` adds columns, for instance a suspected leak."""
    return _fit(train, [*AT_PICKUP, *(extra or [])], kind, **settings)


def fit_dropoff(train: DataFrame, kind: str = "lr", **settings) -> PipelineModel:
    """Rider type from what is known at the return of the vehicle."""
    return _fit(train, AT_DROPOFF, kind, regroup=False, **settings)


def with_class_weights(train: DataFrame, column: str = "weight") -> DataFrame:
    """Each row weighs the share of the opposite class."""
    share = train.agg(F.sum(F.col("label") * _count(train)) / F.sum(_count(train))).first()[0]
    return train.withColumn(column, F.when(F.col("label") == 1, 1 - share).otherwise(share))


def fit_weighted(train: DataFrame) -> PipelineModel:
    return fit_pickup(with_class_weights(train))


def fit_duration(trips: DataFrame) -> PipelineModel:
    """Linear regression of the duration on distance, electric and rider type."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=["distance_km", "electric", "label"], outputCol="features"),
        LinearRegression(labelCol="duration_min")]).fit(trips)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_or_train(spark: SparkSession, path: str, history: Callable[[], DataFrame],
                  fit: Callable[[DataFrame], PipelineModel] = fit_dropoff, sample: float | None = None,
                  keep: bool = False) -> PipelineModel:
    """A saved model, or the same pipeline trained now (on a sample if asked) when there is none."""
    if files.path_exists(spark, f"{path}/metadata"):
        return PipelineModel.load(path)
    rows = history()
    model = fit(row_sample(rows, sample) if sample else rows)
    if keep:
        save(model, path)
    return model


# --- evaluation ------------------------------------------------------------------------------

def area_under_roc(predictions: DataFrame, score: str = "rawPrediction", bins: int = 0) -> float:
    """Area under the ROC curve; `bins` = 0 keeps every distinct score, which makes it exact."""
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=score, numBins=bins,
                                         **_weighed_by(predictions)).evaluate(predictions)


def accuracy(predictions: DataFrame) -> float:
    return MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy",
                                             **_weighed_by(predictions)).evaluate(predictions)


def evaluate(predictions: DataFrame, score: str = "rawPrediction") -> tuple[float, float]:
    return area_under_roc(predictions, score), accuracy(predictions)


def by_label(predictions: DataFrame, metric: str, label: float = 1.0) -> float:
    """`metric` is "recallByLabel" or "precisionByLabel"."""
    return MulticlassClassificationEvaluator(labelCol="label", metricName=metric, metricLabel=label,
                                             **_weighed_by(predictions)).evaluate(predictions)


def confusion(predictions: DataFrame) -> DataFrame:
    """One row per true class, one column per predicted class."""
    table = predictions.groupBy("label").pivot("prediction", [0.0, 1.0]).agg(
        F.sum(_count(predictions))).fillna(0)
    return table.select("label", F.col("`0.0`").alias("predicted_0"), F.col("`1.0`").alias("predicted_1"))


def precision_recall(predictions: DataFrame) -> DataFrame:
    """Precision and recall of class 1 from counts; NULL when nothing was predicted or present."""
    n = _count(predictions)
    hit, said, true = F.col("prediction") * F.col("label") * n, F.col("prediction") * n, F.col("label") * n
    return predictions.agg(F.try_divide(F.sum(hit), F.sum(said)).alias("precision"),
                           F.try_divide(F.sum(hit), F.sum(true)).alias("recall"))


def threshold_report(predictions: DataFrame, thresholds: list[float]) -> DataFrame:
    """Precision and recall of class 1 when it is predicted above each threshold.

    A threshold does not change the fitted model, only the reading of its probabilities, so all of
    them are judged on one model in one pass.
    """
    chance = vector_to_array("probability")[1]
    true = F.col("label") == 1

    def rows(such: Column) -> Column:
        return F.sum(F.when(such, F.col(ROWS)).otherwise(0))

    counts = predictions.select(chance.alias("chance"), "label", _count(predictions).alias(ROWS)).agg(
        rows(true).alias("true"),
        *[rows(F.col("chance") > t).alias(f"said_{i}") for i, t in enumerate(thresholds)],
        *[rows((F.col("chance") > t) & true).alias(f"hit_{i}") for i, t in enumerate(thresholds)])
    lines = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"said_{i}").alias("said"),
                               F.col(f"hit_{i}").alias("hit")) for i, t in enumerate(thresholds)])
    return counts.select("true", F.inline(lines)).select(
        "threshold", F.try_divide("hit", "true").alias("recall"), F.try_divide("hit", "said").alias("precision"))


def importances(model: PipelineModel, predictions: DataFrame, k: int = 5) -> list[tuple[str, float]]:
    """The k largest feature importances of a forest, named from the vector column's metadata."""
    forest = model.stages[-1]
    groups = predictions.schema[forest.getFeaturesCol()].metadata["ml_attr"]["attrs"].values()
    names = {attr["idx"]: attr["name"] for group in groups for attr in group}
    weights = forest.featureImportances.toArray()
    ranked = sorted(names.items(), key=lambda item: (-weights[item[0]], item[0]))
    return [(name, float(weights[i])) for i, name in ranked[:k]]


def regression_scores(predictions: DataFrame) -> tuple[float, float]:
    """(RMSE, R2) of duration predictions, from one pass over them."""
    error, actual = F.col("prediction") - F.col("duration_min"), F.col("duration_min")
    squares, spread = predictions.agg(F.avg(error * error), F.var_pop(actual)).first()
    return squares ** 0.5, 1 - squares / spread
