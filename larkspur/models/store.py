"""Persist a fitted model with its dictionaries, and load both for scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from larkspur.models.linear import VECTOR, Fit


def save_model(fit: Fit, dictionary: DataFrame, path: str) -> None:
    assembler = VectorAssembler(inputCols=fit.features, outputCol=VECTOR)
    PipelineModel(stages=[assembler, fit.model]).write().overwrite().save(f"{path}/model")
    dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/dictionary")
