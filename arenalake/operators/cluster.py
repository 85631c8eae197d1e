"""K-Means on pointer positions."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.schema import FEATURES, MODEL_COLUMNS, PREDICTION

POSITION = ["x", "y"]
CLUSTERS = 2  # fixed value
SEED = 1  # fixed value
#: Partitions of the points of a fit, whatever those of the input are.
FIT_PARTITIONS = 8


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=POSITION, outputCol=FEATURES)


def fit_clusters(rows: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> PipelineModel:
    """Assembler and K-Means as one pipeline. Only x and y are read.

    Equal positions are first added up to one weighted point: the centres are
    the same weighted means, and each iteration goes over the distinct positions
    of the map instead of over all events. The points are dealt out by their position and sorted, so
    that the seeded choice of first centres does not depend on how the input is partitioned.
    """
    points = rows.groupBy(*POSITION).agg(F.count("*").cast("double").alias("weight"))
    points = points.repartition(FIT_PARTITIONS, *POSITION).sortWithinPartitions(*POSITION)
    kmeans = KMeans(
        k=k, seed=seed, featuresCol=FEATURES, predictionCol=PREDICTION, weightCol="weight"
    )
    return Pipeline(stages=[assembler(), kmeans]).fit(points)


def predict(model: PipelineModel, rows: DataFrame, keep_features: bool = False) -> DataFrame:
    """Add ``prediction``, replacing model columns of an earlier run.

    Works on a stream. ``keep_features`` keeps the vector column.
    """
    scored = model.transform(rows.drop(*MODEL_COLUMNS))
    return scored if keep_features else scored.drop(FEATURES)


def silhouette(model: PipelineModel, rows: DataFrame) -> float:
    evaluator = ClusteringEvaluator(
        featuresCol=FEATURES, predictionCol=PREDICTION, metricName="silhouette"
    )
    return evaluator.evaluate(predict(model, rows.select(*POSITION), keep_features=True))
