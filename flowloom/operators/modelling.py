"""Text classifier on Spark ML: fit on train, choose by macro F1 on val, report on test."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.operators.evaluation import argmax, confusion_matrix, eval_metrics
from flowloom.operators.tokens import SEPARATOR
from flowloom.plans.staging import stage_table

REGULARISATION = (0.0, 0.01, 0.1)


FEATURES = 1 << 18


def text_features(features: int = FEATURES) -> Pipeline:
    """Tokens, hashed counts and weights; nothing in it depends on the grid."""
    return Pipeline(
        stages=[
            RegexTokenizer(
                inputCol="inputs", outputCol="tokens", pattern=SEPARATOR, toLowercase=False
            ),
            HashingTF(inputCol="tokens", outputCol="counts", numFeatures=features),
            IDF(inputCol="counts", outputCol="weights"),
        ]
    )


def predict(model: PipelineModel, rows: DataFrame, key: list[str]) -> DataFrame:
    """``key…, y_true, y_pred`` by arg-max over the raw scores."""
    logits = vector_to_array(F.col("rawPrediction"))
    return model.transform(rows).select(
        *key, F.col("labels").alias("y_true"), argmax(logits).alias("y_pred")
    )


def fit_select(
    dataset: DataFrame, key: list[str], grid: tuple[float, ...] = REGULARISATION,
    features: int = FEATURES, iterations: int = 20,
) -> tuple[PipelineModel, float, float]:
    """Best model of the grid by macro F1 on ``val``; returns model, its setting and its F1.

    Features are fitted once and their vectors written once; each fit is a
    distributed optimisation over the vectors of ``train``, and only one metric
    per fit comes back to the driver.
    """
    train = dataset.where(F.col("split") == "train")
    prepared = text_features(features).fit(train)
    used = dataset.where(F.col("split").isin("train", "val"))
    vectors = stage_table(prepared.transform(used).select(*key, "split", "labels", "weights"), "vectors")
    best: tuple[PipelineModel, float, float] | None = None
    for reg in grid:
        regression = LogisticRegression(
            featuresCol="weights", labelCol="labels", family="multinomial", regParam=reg,
            maxIter=iterations,
        )
        model = regression.fit(vectors.where(F.col("split") == "train"))
        f1 = eval_metrics(predict(model, vectors.where(F.col("split") == "val"), key)).first()["f1"] or 0.0
        if best is None or f1 > best[2]:
            best = (PipelineModel(stages=[*prepared.stages, model]), reg, f1)
    return best


def score_splits(model: PipelineModel, dataset: DataFrame, key: list[str]) -> DataFrame:
    """``split, key…, y_true, y_pred`` of the ``val`` and ``test`` rows."""
    rows = dataset.where(F.col("split").isin("val", "test"))
    return predict(model, rows, ["split", *[c for c in key if c != "split"]])


def report(model: PipelineModel, dataset: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Metrics by split, and the confusion matrix by split, of ``val`` and ``test``."""
    scored = stage_table(score_splits(model, dataset, key), "scored")
    return eval_metrics(scored, ["split"]), confusion_matrix(scored, ["split"])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
