"""Learned matchers of Spark's own library: training, calibration, importance, ablation, persistence."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .policy import accept, entity_stats


def train(pairs: DataFrame, columns: list[str], label: str = "y", kind: str = "gbt", validation: str | None = None, **params) -> PipelineModel:
    """gbt: boosted trees with early stopping on the rows where `validation` is true; forest and linear for comparison."""
    if kind == "gbt":
        fixed = {"maxDepth": 8, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "maxIter": 100, "seed": 7}
        model = GBTClassifier(labelCol=label, featuresCol="features", **{**fixed, **params})
        if validation:
            model = model.setValidationIndicatorCol(validation)
    elif kind == "forest":
        model = RandomForestClassifier(labelCol=label, featuresCol="features", **{"numTrees": 50, "maxDepth": 8, "minInstancesPerNode": 5, "seed": 7, **params})
    elif kind == "linear":
        model = LogisticRegression(labelCol=label, featuresCol="features", **{"regParam": 0.01, **params})
    else:
        raise ValueError(f"no model of kind {kind!r}")
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep"), model]).fit(pairs)


def predict(model: PipelineModel, pairs: DataFrame, name: str = "p") -> DataFrame:
    scored = model.transform(pairs)
    return scored.withColumn(name, vector_to_array("probability")[1]).select(*pairs.columns, name)


def importance(model: PipelineModel, columns: list[str]) -> dict[str, float]:
    gains = model.stages[-1].featureImportances.toArray()
    return dict(sorted(zip(columns, map(float, gains), strict=True), key=lambda x: -x[1]))


def platt(scored: DataFrame, p: str = "p", y: str = "y"):
    """A logistic curve over the logit of the score; returns a function that adds `calibrated`."""
    clipped = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    logit = lambda df: df.withColumn("logit", array_to_vector(F.array(F.log(clipped(F.col(p)) / (1 - clipped(F.col(p)))))))
    fitted = LogisticRegression(featuresCol="logit", labelCol=y, regParam=1e-6, standardization=False).fit(logit(scored))
    return lambda df: fitted.transform(logit(df)).withColumn("calibrated", vector_to_array("probability")[1]).select(*df.columns, "calibrated")


def isotonic_model(scored: DataFrame, p: str = "p", y: str = "y") -> IsotonicRegressionModel:
    """A rising curve of pooled steps, linear between them, level beyond its ends."""
    return IsotonicRegression(featuresCol=p, labelCol=y, predictionCol="calibrated").fit(scored)


def isotonic(scored: DataFrame, p: str = "p", y: str = "y"):
    """The curve as a function that adds `calibrated`."""
    return isotonic_model(scored, p, y).transform


def calibrated(calibrator: IsotonicRegressionModel, scored: DataFrame, raw: str = "raw") -> DataFrame:
    """scored with p, by a fitted curve over the raw score."""
    return calibrator.copy({calibrator.featuresCol: raw}).transform(scored).withColumn("p", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "calibrated"))).drop("calibrated")


def stage2(scored: DataFrame, columns: list[str], entities: str = "s1") -> DataFrame:
    """p2: a second model over entity statistics and features, trained on one half of the entities for the other."""
    stats = entity_stats(scored).withColumn("half", F.pmod(F.xxhash64(entities), F.lit(2)))
    inputs = ["p", "rank_p", "p_max", "p_2nd", "p_margin", "p_rel", "p_sum", "n_p50", "n_p20", *columns]
    out = None
    for half in (0, 1):
        model = train(stats.where(F.col("half") != half), inputs, maxIter=20, maxDepth=4)
        part = predict(model, stats.where(F.col("half") == half), "p2")
        out = part if out is None else out.unionByName(part)
    return out.drop("half")


def ablation(train_set: DataFrame, test_set: DataFrame, groups: dict[str, list[str]], measure, **params) -> list[dict]:
    """A model for each growing list of feature groups, and its measure on the test set."""
    used: list[str] = []
    out = []
    for name, columns in groups.items():
        used = used + columns
        out.append({"group": name, "n_features": len(used), "value": measure(predict(train(train_set, used, **params), test_set))})
    return out


def score_candidates(model: PipelineModel, calibrator: IsotonicRegressionModel | None, features: DataFrame, policy: dict) -> tuple[DataFrame, DataFrame]:
    """Scored rows (s1, cand, p...) and the accepted ones."""
    scored = calibrated(calibrator, predict(model, features, "raw")) if calibrator else predict(model, features, "p")
    stats = entity_stats(scored)
    ok = accept(policy, F.col("p"), is_s3=F.col("b_is_s3") if "b_is_s3" in stats.columns else F.lit(0), p_rel=F.col("p_rel"), p_max=F.col("p_max"))
    return stats, stats.where(ok)


def save(model: PipelineModel, spec: dict, path: str, calibrator: IsotonicRegressionModel | None = None) -> None:
    """The folders of the model and its calibrator, and its specification, a text file that Spark writes."""
    model.write().overwrite().save(f"{path}/model")
    if calibrator:
        calibrator.write().overwrite().save(f"{path}/calibrator")
    spec = {**spec, "calibrated": calibrator is not None}
    _active().createDataFrame([(json.dumps(spec, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")


def load(path: str) -> tuple[PipelineModel, dict, IsotonicRegressionModel | None]:
    spec = json.loads(_active().read.text(f"{path}/spec").first()["value"])
    return PipelineModel.load(f"{path}/model"), spec, IsotonicRegressionModel.load(f"{path}/calibrator") if spec["calibrated"] else None


def _active():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()
