"""The classifier: feature pipeline, cross-validation, scoring and model files."""

from __future__ import annotations

import logging

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.habitability import decode_label
from ..operators.joins import key_hash
from ..schemas import NUMERIC_FEATURES
from ..sinks.staged import replace, settle
from . import trees

LOG = logging.getLogger(__name__)
SEED = 42
TRAIN_SHARE = 0.85
IMPORTANCE_THRESHOLD = 0.01
HASH_SPACE = 2**32
FOLD_RANGES = 256
# A fit holds every row once for each task, with its weight in each tree.
ROWS_PER_TASK = 131_072
FEW_TASKS, FEW_ROWS = 24, 2_048  # small tables are still dealt to this many tasks


def indexer(column: str, output: str) -> StringIndexer:
    """Rank categories by frequency, ties by name; unseen values get one more index."""
    return StringIndexer(inputCol=column, outputCol=output, handleInvalid="keep")


def feature_stages() -> list:
    # The columns and their order, as stored models have them.
    return [
        indexer("star_type", "star_type_idx"),
        indexer("planet_type", "planet_type_idx"),
        indexer("label", "label_index"),
        OneHotEncoder(inputCol="star_type_idx", outputCol="star_type_vec"),
        OneHotEncoder(inputCol="planet_type_idx", outputCol="planet_type_vec"),
        VectorAssembler(
            inputCols=["star_type_vec", "planet_type_vec", *NUMERIC_FEATURES],
            outputCol="features_raw",
            handleInvalid="keep",
        ),
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True),
    ]


def forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features", labelCol="label_index", seed=SEED, **params
    )


def build_pipeline(classifier: RandomForestClassifier | None = None) -> Pipeline:
    return Pipeline(stages=[*feature_stages(), classifier or forest()])


def spread(rows: DataFrame, key: str = "name") -> DataFrame:
    """The rows in partitions of about ``ROWS_PER_TASK``, dealt by the hash of the key and in its order.

    A forest draws its bootstrap by partition and row.  Partitions that follow from the rows alone
    bound what a task holds, and files and cores do not change the draw.
    """
    n = rows.count()
    tasks = max(min(FEW_TASKS, -(-n // FEW_ROWS)), -(-n // ROWS_PER_TASK), 1)
    return rows.repartition(tasks, key_hash(key)).sortWithinPartitions(key)


def fit(planets: DataFrame, classifier: RandomForestClassifier | None = None, key: str = "name") -> PipelineModel:
    """Features and forest of ``build_pipeline``; the forest reads vectors that are ``spread``."""
    features = Pipeline(stages=feature_stages()).fit(planets)
    vectors = features.transform(planets).select(key, "label_index", "features")
    return PipelineModel([*features.stages, (classifier or forest()).fit(spread(vectors, key))])


# The settings of the search.
GRID_TREES = [50, 100, 200]
GRID_DEPTH = [4, 6, 8]
GRID_MIN_INSTANCES = [1, 2]


def full_grid(classifier: RandomForestClassifier) -> list:
    """The 18 settings of the search."""
    return (
        ParamGridBuilder()
        .addGrid(classifier.numTrees, GRID_TREES)
        .addGrid(classifier.maxDepth, GRID_DEPTH)
        .addGrid(classifier.minInstancesPerNode, GRID_MIN_INSTANCES)
        .build()
    )


def labelled(planets: DataFrame) -> DataFrame:
    return planets.filter(F.col("label").isNotNull())


def with_split(planets: DataFrame, key: str = "name", share: float = TRAIN_SHARE) -> DataFrame:
    """Mark rows ``train`` or ``test`` by a hash of the key, whatever the partitioning."""
    limit = int(share * HASH_SPACE)
    return planets.withColumn(
        "split", F.when(key_hash(key) < limit, "train").otherwise("test")
    )


def train_test(planets: DataFrame, key: str = "name") -> tuple[DataFrame, DataFrame]:
    marked = with_split(planets, key)
    train, test = (marked.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    return train, test


def with_folds(planets: DataFrame, folds: int = 5, key: str = "name", label: str = "label") -> DataFrame:
    """Add ``fold``: 0 to ``folds`` - 1, each with the same number of rows of a label, give or take one.

    Rows are numbered by the hash of their key inside a label, in ``FOLD_RANGES`` ranges of the hash
    that follow one another, so that no task sorts all rows of a frequent label.
    """
    marked = planets.withColumns({"_hash": key_hash(key)}).withColumn(
        "_range", F.floor(F.col("_hash") * FOLD_RANGES / HASH_SPACE)
    )
    before = Window.partitionBy("_label").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy(F.col(label).alias("_label"), "_range").agg(F.count("*").alias("_n"))
    offsets = counts.select(
        "_label", F.col("_range").alias("_own"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    number = F.row_number().over(Window.partitionBy(label, "_range").orderBy("_hash", key))
    joined = marked.withColumn("_number", number).join(
        offsets, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_range") == F.col("_own"))
    )
    fold = ((F.col("_offset") + F.col("_number") - 1) % folds).cast("int")
    return joined.select(*planets.columns, fold.alias("fold"))


def random_train_test(planets: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The seeded random split; its rows depend on the partitioning of the input."""
    train, test = planets.randomSplit([TRAIN_SHARE, 1 - TRAIN_SHARE], seed=seed)
    return train, test


def _stage(model: PipelineModel, matches):
    return next(stage for stage in model.stages if matches(stage))


def label_order(model: PipelineModel) -> list[str]:
    """Labels by class index, from the indexer that produced the label column."""
    found = _stage(
        model,
        lambda s: isinstance(s, StringIndexerModel) and s.getOutputCol() == "label_index",
    )
    return list(found.labels)


def forest_of(model: PipelineModel) -> RandomForestClassificationModel:
    return _stage(model, lambda s: isinstance(s, RandomForestClassificationModel))


def with_predicted_label(
    model: PipelineModel, predictions: DataFrame, output: str = "predicted_label"
) -> DataFrame:
    return predictions.withColumn(output, decode_label("prediction", label_order(model)))


def score(model: PipelineModel, planets: DataFrame) -> DataFrame:
    return with_predicted_label(model, model.transform(planets))


def slot_names(assembled: DataFrame, column: str = "features_raw") -> list[str]:
    """Names of the vector slots, from the metadata that the assembler wrote."""
    groups = assembled.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((slot for group in groups for slot in group), key=lambda slot: slot["idx"])
    return [slot["name"] for slot in slots]


def feature_importance(
    model: PipelineModel, planets: DataFrame, threshold: float = IMPORTANCE_THRESHOLD
) -> DataFrame:
    """Slots whose importance is above the threshold, with their names.

    Importances are computed from the table of the forest's nodes; a slot that no tree uses has zero.
    """
    spark = planets.sparkSession
    names = spark.createDataFrame(
        list(enumerate(slot_names(model.transform(planets)))), "slot int, feature string"
    )
    found = trees.importances(trees.node_table(spark, forest_of(model))).withColumnRenamed("feature", "slot")
    ranked = names.join(found, "slot", "left").withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    return ranked.filter(F.col("importance") > threshold)


def save_model(model: PipelineModel, *paths: str) -> None:
    """Replace the model of every destination; a failed save leaves the earlier one."""
    spark = SparkSession.active()
    for path in paths:
        replace(spark, path, model.write().save)


def load_model(spark: SparkSession, *paths: str) -> PipelineModel | None:
    """The first model that loads, in the given order; None if there is none."""
    for path in paths:
        try:
            settle(spark, path)
            return PipelineModel.read().session(spark).load(path)
        except Exception as error:  # a missing path, an unreachable store or a broken file
            LOG.warning("no model at %s: %s", path, type(error).__name__)
    return None
