"""A baseline model on vectors: standardised logistic regression, chosen threshold, run record."""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from quern.functions import logs
from quern.operators.metrics import auroc, best_threshold, confusion, with_rates


def features(rows: DataFrame, vector: str) -> DataFrame:
    return rows.withColumn("raw_features", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))


def train(rows: DataFrame, vector: str, label: str = "label", max_iter: int = 30, reg: float = 0.01) -> PipelineModel:
    """Fit on train rows alone; the scaling comes from them, and positives weigh neg / max(pos, 1)."""
    counts = rows.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    weight = counts["n"] / max(counts["p"], 1)
    weighed = features(rows, vector).withColumn("weight", F.when(F.col(label) == 1, float(weight)).otherwise(1.0)).withColumn(label, F.col(label).cast("double"))
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)
    model = LogisticRegression(labelCol=label, weightCol="weight", maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[scaler, model]).fit(weighed)


def predict(model: PipelineModel, rows: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``score``, with the model's own scaling."""
    return model.transform(features(rows, vector)).select(*keep, F.element_at(vector_to_array("probability"), 2).alias("score"))


def run_record(version: str, validation: DataFrame, test: DataFrame, config: dict) -> dict:
    """The threshold is chosen on validation; test is used once. Run ids never repeat."""
    threshold = best_threshold(validation).first()["threshold"]
    metrics = with_rates(confusion(test, threshold)).first().asDict() | {"auroc": auroc(test).first()["auroc"]}
    stamp = datetime.datetime.now(datetime.timezone.utc).strftime("run-%Y%m%dT%H%M%SZ")
    return {"run_id": f"{stamp}-{uuid.uuid4().hex[:8]}", "dataset_version": version, "config": json.loads(json.dumps(config, default=str)), "selected_threshold": threshold, "metrics": metrics}


def save(model: PipelineModel, predictions: DataFrame, record: dict, folder: str) -> None:
    """A run's folder: the model, its predictions, and the record that names both. A run is written once."""
    spark = predictions.sparkSession
    model.write().save(f"{folder}/model")
    predictions.write.mode("errorifexists").parquet(f"{folder}/predictions")
    if not logs.create_text(spark, f"{folder}/run.json", logs.as_json(record)):
        raise FileExistsError(f"{folder} holds a run")


def load(folder: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/model")
