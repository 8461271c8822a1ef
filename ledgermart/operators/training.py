"""Model families on Spark ML: preparation, parameter search, evaluation and artifacts."""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed
from . import mlprep
from .monitoring import LABEL, MODEL, SCORE
from .registry import metrics_by_split, version_name

# fixed values: names under which a model family is known
FAMILIES = {
    "logistic_regression": ("logistic_regression", "logistic", "lr"),
    "random_forest": ("random_forest", "randomforest", "rf"),
    "xgboost": ("xgboost", "xgb", "boost"),
}
MAX_SELECTED = 50

# fixed values: searched parameter values
SEARCH_SPACES: dict[str, dict[str, list]] = {
    "logistic_regression": {
        "C": [0.001, 0.01, 0.1, 1, 10, 100],
        "penalty": ["l1", "l2", "elasticnet"],
        "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9],
        "max_iter": [1000, 2000],
        "class_weight": [None, "balanced"],
    },
    "random_forest": {
        "n_estimators": [50, 100, 200, 300],
        "max_depth": [3, 5, 7, 10, None],
        "min_samples_leaf": [1, 2, 5, 10],
        "max_features": ["sqrt", "log2", 0.3, 0.5],
        "bootstrap": [True, False],
        "class_weight": [None, "balanced"],
    },
    "xgboost": {
        "n_estimators": [50, 100, 200, 300],
        "max_depth": [3, 4, 5, 6, 7],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "subsample": [0.6, 0.8, 1.0],
        "colsample_bytree": [0.6, 0.8, 1.0],
        "gamma": [0, 0.1, 0.5, 1],
        "min_child_weight": [1, 3, 5, 7],
        "scale_pos_weight": [1, 2, 3],
    },
}
DEFAULTS: dict[str, dict] = {
    "logistic_regression": {"C": 1, "penalty": "l2", "max_iter": 1000},
    "random_forest": {"n_estimators": 100, "max_depth": None},
    "xgboost": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3},
}
DEEPEST_TREE = 30


def family(model_type: str) -> str:
    """The family that a name or alias stands for."""
    for name, aliases in FAMILIES.items():
        if model_type.lower() in aliases:
            return name
    raise ValueError(f"unsupported model type {model_type!r}")


# --- preparation ---------------------------------------------------------------------------------


@dataclass
class Preparation:
    """Fitted steps from feature-store columns to a vector, and the names of its entries."""

    stages: list
    feature_names: list[str]
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)

    def apply(self, rows: DataFrame) -> DataFrame:
        return PipelineModel(stages=self.stages).transform(rows)


def _vector_stages(expressions: dict[str, str]) -> list:
    """Select the expressions under plain names and assemble them in order."""
    names = [f"_x{i}" for i in range(len(expressions))]
    selected = ", ".join(f"{e} AS {n}" for e, n in zip(expressions.values(), names))
    return [
        SQLTransformer(statement=f"SELECT *, {selected} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol="features"),
    ]


def _regression_preparation(train: DataFrame, label: str) -> Preparation:
    """Medians, indicators, standard scores, then the columns with the largest F statistics."""
    columns = mlprep.regression_columns(train.columns)
    texts = mlprep.text_columns(train, columns)
    numbers = mlprep.numeric_columns(train, columns)
    fill = mlprep.fit_medians(train, numbers)
    known = train.select(*[F.expr(mlprep.text_or(c, mlprep.UNKNOWN_LEVEL)).alias(c) for c in texts])
    expressions = {c: mlprep.number_or(c, fill[c]) for c in numbers}
    for column, levels in mlprep.fit_levels(known, texts).items():
        filled = mlprep.text_or(column, mlprep.UNKNOWN_LEVEL)
        expressions |= mlprep.one_hot(column, levels, filled)
    plain = train.select(label, *[F.expr(e).alias(f"_x{i}") for i, e in enumerate(expressions.values())])
    internal = plain.columns[1:]
    scale = mlprep.fit_scale(plain, internal)
    # one rule for any width: the largest F first, columns without one last
    ranked = mlprep.f_statistics(plain, internal, label).orderBy(F.desc_nulls_last("f_statistic"), "feature")
    chosen = {r.feature for r in ranked.limit(MAX_SELECTED).collect()}
    scaled = {
        name: mlprep.standardized(expression, *scale[column])
        for column, (name, expression) in zip(internal, expressions.items())
        if column in chosen
    }
    return Preparation(_vector_stages(scaled), list(scaled), numbers, texts)


def _forest_preparation(train: DataFrame, label: str) -> Preparation:
    """Medians for numbers; most frequent level, then level codes for text."""
    columns = mlprep.forest_columns(train.columns)
    texts = mlprep.text_columns(train, columns)
    numbers = mlprep.numeric_columns(train, columns)
    fill, common = mlprep.fit_medians(train, numbers), mlprep.fit_modes(train, texts)
    expressions = {c: mlprep.number_or(c, fill[c]) for c in numbers}
    for column, levels in mlprep.fit_levels(train, texts).items():
        filled = mlprep.text_or(column, common[column])
        expressions[column] = mlprep.level_code(column, levels, filled)
    return Preparation(_vector_stages(expressions), list(expressions), numbers, texts)


def _boosting_preparation(train: DataFrame, label: str) -> Preparation:
    """A sentinel for missing numbers; missing text is a level of its own."""
    columns = mlprep.boosting_columns(train.columns)
    texts = mlprep.text_columns(train, columns)
    numbers = mlprep.numeric_columns(train, columns)
    expressions = {c: mlprep.number_or(c, mlprep.MISSING_NUMBER) for c in numbers}
    named = train.select(*[F.expr(mlprep.text_or(c, mlprep.MISSING_LEVEL)).alias(c) for c in texts])
    for column, levels in mlprep.fit_levels(named, texts).items():
        filled = mlprep.text_or(column, mlprep.MISSING_LEVEL)
        expressions[column] = mlprep.level_code(column, levels, filled)
    return Preparation(_vector_stages(expressions), list(expressions), numbers, texts)


_PREPARATIONS = {
    "logistic_regression": _regression_preparation,
    "random_forest": _forest_preparation,
    "xgboost": _boosting_preparation,
}


def fit_preparation(model_type: str, train: DataFrame, label: str = "label") -> Preparation:
    """Fit the preparation of a model family on training rows only."""
    return _PREPARATIONS[family(model_type)](train, label)


# --- estimators ----------------------------------------------------------------------------------


def base_estimator(model_type: str, seed: int = 88, label: str = "label"):
    """Classifier of a family; parameters are set by ``parameter_map``."""
    common = {"featuresCol": "features", "labelCol": label}
    kind = family(model_type)
    if kind == "logistic_regression":
        return LogisticRegression(standardization=False, **common)
    if kind == "random_forest":
        return RandomForestClassifier(seed=seed, **common)
    return GBTClassifier(seed=seed, **common)


def _weight_column(parameters: dict) -> str:
    if parameters.get("class_weight"):
        return "weight_balanced"
    return f"weight_{parameters.get('scale_pos_weight', 1)}"


def _subset(value) -> str:
    """Feature-subset setting; the whole set has a name, shares are numbers."""
    return value if isinstance(value, str) else "all" if value == 1 else str(value)


def parameter_map(model_type: str, estimator, parameters: dict, rows: int) -> dict:
    """Spark ML parameters that stand for the given ones.

    ``C`` weighs the loss summed over rows, ``regParam`` the penalty against their mean.
    """
    kind = family(model_type)
    known = {*DEFAULTS[kind], *SEARCH_SPACES[kind], "l1_ratio", "class_weight"}
    if unknown := sorted(set(parameters) - known):
        raise ValueError(f"no parameters of {kind}: {unknown}")
    p = {**DEFAULTS[kind], **parameters}
    if kind == "logistic_regression":
        mixture = {"l1": 1.0, "l2": 0.0}.get(p["penalty"], p.get("l1_ratio", 0.5))
        values = {
            "regParam": 1.0 / (p["C"] * rows),
            "elasticNetParam": float(mixture),
            "maxIter": p["max_iter"],
        }
    elif kind == "random_forest":
        values = {
            "numTrees": p["n_estimators"],
            "maxDepth": DEEPEST_TREE if p["max_depth"] is None else p["max_depth"],
            "minInstancesPerNode": p.get("min_samples_leaf", 1),
            "featureSubsetStrategy": _subset(p.get("max_features", "sqrt")),
            "bootstrap": p.get("bootstrap", True),
        }
    else:
        values = {
            "maxIter": p["n_estimators"],
            "maxDepth": p["max_depth"],
            "stepSize": p["learning_rate"],
            "subsamplingRate": p.get("subsample", 1.0),
            "featureSubsetStrategy": _subset(p.get("colsample_bytree", 1.0)),
            "minInfoGain": float(p.get("gamma", 0.0)),
            "minInstancesPerNode": p.get("min_child_weight", 1),
        }
    values["weightCol"] = _weight_column(p)
    return {estimator.getParam(name): value for name, value in values.items()}


def with_class_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """Add the weights a search can choose from: even, balanced, and heavier positives."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    positives = counts.where(F.col(label) == 1).agg(F.sum("n")).scalar()
    total = counts.agg(F.sum("n")).scalar()
    is_positive = F.col(label) == 1
    balanced = total / (2.0 * F.when(is_positive, positives).otherwise(total - positives))
    heavier = {
        f"weight_{k}": F.when(is_positive, float(k)).otherwise(1.0)
        for k in SEARCH_SPACES["xgboost"]["scale_pos_weight"]
    }
    return rows.withColumns({"weight_balanced": F.coalesce(balanced, F.lit(1.0)), **heavier})


def drawn_parameters(model_type: str, draws: int, seed: int) -> list[dict]:
    """Different parameter combinations drawn at random from the family's space."""
    space = SEARCH_SPACES[family(model_type)]
    combinations = list(itertools.product(*space.values()))
    chosen = random.Random(seed).sample(combinations, min(draws, len(combinations)))
    return [dict(zip(space, values)) for values in chosen]


# --- training ------------------------------------------------------------------------------------


@dataclass
class TrainedModel:
    """A fitted pipeline with what the registry wants to know about it."""

    model_type: str
    version: str
    pipeline: PipelineModel
    preparation: Preparation
    parameters: dict
    cv_mean: float | None
    cv_std: float | None
    seconds: float


def train_model(
    train: DataFrame,
    model_type: str,
    training_date: str,
    draws: int = 10,
    folds: int = 3,
    seed: int = 88,
    parallelism: int = 2,
    parameters: dict | None = None,
) -> TrainedModel:
    """Fit the preparation, search parameters by cross-validated AUC, refit the best on all rows.

    With ``parameters`` given there is no search.  The prepared vectors are computed once and kept.
    """
    started = time.time()
    kind = family(model_type)
    preparation = fit_preparation(kind, train)
    folded = mlprep.with_folds(with_class_weights(train), folds, seed)
    weights = [c for c in folded.columns if c.startswith("weight_")]
    label = F.col("label").cast("double").alias("label")
    prepared = checkpointed(preparation.apply(folded).select("features", label, "fold", *weights))
    rows, estimator = prepared.count(), base_estimator(kind, seed)
    if parameters is not None:
        chosen, mean, std = parameters, None, None
        best = estimator.fit(prepared, parameter_map(kind, estimator, parameters, rows))
    else:
        candidates = drawn_parameters(kind, draws, seed)
        search = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=[parameter_map(kind, estimator, c, rows) for c in candidates],
            evaluator=BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC"),
            numFolds=folds,
            foldCol="fold",
            parallelism=parallelism,
        ).fit(prepared)
        place = max(range(len(candidates)), key=search.avgMetrics.__getitem__)
        chosen, mean, std = candidates[place], search.avgMetrics[place], search.stdMetrics[place]
        best = search.bestModel
    pipeline = PipelineModel(stages=[*preparation.stages, best])
    return TrainedModel(
        kind,
        version_name(kind, training_date),
        pipeline,
        preparation,
        chosen,
        mean,
        std,
        time.time() - started,
    )


def scored_rows(rows: DataFrame, model: TrainedModel) -> DataFrame:
    """Training, test and out-of-time rows with the model's score, in monitoring columns."""
    scored = model.pipeline.transform(rows)
    return scored.select(
        F.lit(model.version).alias(MODEL),
        "split",
        F.col("label").alias(LABEL),
        vector_to_array(F.col("probability"))[1].alias(SCORE),
    )


def feature_importance(spark: SparkSession, model: TrainedModel) -> DataFrame:
    """Importance per feature: tree importances, or absolute coefficients."""
    last = model.pipeline.stages[-1]
    vector = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    values = [(n, abs(float(v))) for n, v in zip(model.preparation.feature_names, vector.toArray())]
    table = spark.createDataFrame(values, "feature string, importance double")
    return table.select(F.lit(model.version).alias(MODEL), "feature", "importance").orderBy(
        F.desc("importance")
    )


def registry_row(rows: DataFrame, model: TrainedModel, training_date: str) -> DataFrame:
    """One registry row: split sizes and rates, metrics, parameters, cross-validation, time."""
    scored = scored_rows(rows, model)
    sizes = scored.groupBy(MODEL).agg(
        *[
            measure(F.when(F.col("split") == split, F.col(LABEL))).alias(f"{name}_{split}")
            for split in ("train", "test", "oot")
            for name, measure in (("rows", F.count), ("rate", F.avg))
        ]
    )
    facts = {
        "model_type": model.model_type,
        "training_date": training_date,
        "parameters": str(model.parameters),
        "feature_count": len(model.preparation.feature_names),
        "cv_score": model.cv_mean,
        "cv_std": model.cv_std,
        "training_seconds": model.seconds,
    }
    joined = sizes.join(metrics_by_split(scored), MODEL)
    kinds = {"cv_score": "double", "cv_std": "double", "training_date": "date"}
    return joined.withColumns(
        {k: F.lit(v).cast(kinds[k]) if k in kinds else F.lit(v) for k, v in facts.items()}
    )


def save_model(model: TrainedModel, root: str) -> str:
    """Write the pipeline under its version; returns where."""
    path = f"{root}/models/{model.version}"
    model.pipeline.write().overwrite().save(path)
    return path


def model_types(wanted: Sequence[str] | None = None) -> list[str]:
    return [family(m) for m in (wanted or FAMILIES)]
