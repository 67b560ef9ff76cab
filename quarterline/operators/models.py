"""Classifiers on the datasets, re-aimed at Spark ML (M2, M4, M5).

The reference trains small torch networks in one process.  Here the same
tasks use ``MultilayerPerceptronClassifier`` (L-BFGS over a distributed
``treeAggregate``; the driver only holds the weights): a 13-16-8 network
on single rows and a network over the flattened k x 13 window for
sequences.  Spark's MLP uses sigmoid hidden units and a softmax output,
so the numbers are not the reference's; the task is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.schemas import FEATURE_COLUMNS

# The reference's layer widths (13-16-8-1 feed-forward; 15
# hidden units for the sequence model) and seeds.
ROW_HIDDEN = [16, 8]
SEQUENCE_HIDDEN = [15]
ROW_SEED = 35
SEQUENCE_SEED = 76


def _mlp(n_inputs: int, hidden: Sequence[int], seed: int, max_iter: int, features: str) -> list:
    scaler = StandardScaler(inputCol=features, outputCol="__scaled", withMean=True, withStd=True)
    mlp = MultilayerPerceptronClassifier(
        featuresCol="__scaled", labelCol="label", layers=[n_inputs, *hidden, 2], seed=seed, maxIter=max_iter,
        blockSize=128,
    )
    return [scaler, mlp]


def fit_row_classifier(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, max_iter: int = 200,
                       seed: int = ROW_SEED) -> PipelineModel:
    """Feed-forward classifier on one row of features (M2)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="__features", handleInvalid="skip")
    stages = [assembler, *_mlp(len(features), ROW_HIDDEN, seed, max_iter, "__features")]
    return Pipeline(stages=stages).fit(train)


def fit_sequence_classifier(train: DataFrame, n_inputs: int, max_iter: int = 200,
                            seed: int = SEQUENCE_SEED) -> PipelineModel:
    """Classifier over a flattened window ``seq_features`` (M4)."""
    to_vec = VectorAssembler(inputCols=["seq_features_vec"], outputCol="__features", handleInvalid="skip")
    stages = [to_vec, *_mlp(n_inputs, SEQUENCE_HIDDEN, seed, max_iter, "__features")]
    return Pipeline(stages=stages).fit(_seq_vectors(train))


def _seq_vectors(df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("seq_features_vec", array_to_vector("seq_features"))


def parameter_count(model: PipelineModel) -> int:
    """Number of trained weights and biases of the network (A5).

    The reference's 13-16-8-1 network has 369; the Spark form 13-16-8-2
    (two-class softmax output) has 378.
    """
    return sum(len(stage.weights) for stage in model.stages if hasattr(stage, "weights"))


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], sequence: bool = False) -> DataFrame:
    """Probability of class 1 and the hard prediction (M5)."""
    data = _seq_vectors(df) if sequence else df
    out = model.transform(data)
    return out.select(
        *keep,
        vector_to_array("probability")[1].alias("probability"),
        F.col("prediction").cast("double").alias("prediction"),
    )


def store_model(model: PipelineModel, rows: DataFrame, path: str) -> None:
    """Save a fitted model (its stages hold layers, seed and weights) beside the rows it was fitted and is judged on,
    with their splits, so that another session evaluates the same thing (M2, M4)."""
    model.write().overwrite().save(f"{path}/model")
    rows.write.mode("overwrite").parquet(f"{path}/rows")


def stored_scores(spark: SparkSession, path: str, keep: Sequence[str], sequence: bool = False) -> DataFrame:
    """Scores of a stored model on the rows stored with it."""
    return score(PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/rows"), keep, sequence)


def probability_logit(probability: str = "probability") -> Column:
    """The logit of a probability, kept off the ends that a float can't tell from 0 and 1."""
    p = F.least(F.greatest(F.col(probability), F.lit(1e-15)), F.lit(1 - 1e-15))
    return F.log(p / (F.lit(1.0) - p))
