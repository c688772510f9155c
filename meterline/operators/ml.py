"""Classifiers with MLlib: typing, pipelines, scoring, and out-of-fold predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import written
from .sample import assign_folds

T = TypeVar("T")


def feature_kinds(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """(texts, booleans, numbers) among the features."""
    kinds = dict(df.dtypes)
    texts = [c for c in features if kinds[c] == "string"]
    flags = [c for c in features if kinds[c] == "boolean"]
    return texts, flags, [c for c in features if c not in texts and c not in flags]


def prepare_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Texts become indices (names descending, unknown ones kept), numbers and booleans doubles."""
    texts, flags, numbers = feature_kinds(df, features)
    df = df.withColumns({c: F.col(c).cast("double") for c in [*flags, *numbers]}) if flags or numbers else df
    if not texts:
        return df
    indexer = StringIndexer(inputCols=texts, outputCols=[f"{c}_ix" for c in texts], stringOrderType="alphabetDesc", handleInvalid="keep")
    out = indexer.fit(df).transform(df).drop(*texts)
    return out.withColumnsRenamed({f"{c}_ix": c for c in texts})


def _assembly(numbers: Sequence[str], flags: Sequence[str], others: Sequence[str]) -> list[Estimator]:
    """Means stand in for missing numbers, medians for missing booleans."""
    stages: list[Estimator] = []
    for columns, strategy in ((list(numbers), "mean"), (list(flags), "median")):
        if columns:
            stages.append(Imputer(inputCols=columns, outputCols=columns, strategy=strategy))
    return [*stages, VectorAssembler(inputCols=[*numbers, *flags, *others], outputCol="features", handleInvalid="keep")]


def gbt_pipeline(label: str, numbers: Sequence[str], flags: Sequence[str] = (), others: Sequence[str] = (), seed: int = 7, **settings) -> Pipeline:
    return Pipeline(stages=[*_assembly(numbers, flags, others), GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **settings)])


def rf_pipeline(label: str, numbers: Sequence[str], flags: Sequence[str] = (), others: Sequence[str] = (), trees: int = 100, depth: int = 9, categories: int = 0, seed: int = 7, **settings) -> Pipeline:
    stages = _assembly(numbers, flags, others)
    source = "features"
    if categories:
        stages.append(VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=categories, handleInvalid="keep"))
        source = "indexed"
    return Pipeline(stages=[*stages, RandomForestClassifier(labelCol=label, featuresCol=source, numTrees=trees, maxDepth=depth, seed=seed, **settings)])


def probability(column: str = "probability") -> Column:
    """The probability of class 1."""
    return F.get(vector_to_array(column), F.lit(1))


def predict(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    scored = model.transform(df).withColumn(name, probability())
    return scored.select(*df.columns, name)


def score(model: PipelineModel, df: DataFrame, label: str, name: str = "score", keep_labels: bool = True, rescore_negatives: bool = False) -> DataFrame:
    """Unlabelled rows get the model's probability, labelled ones their label; with rescore_negatives only positives keep
    theirs; without keep_labels every row gets the model's."""
    out = predict(model, df, name)
    if not keep_labels:
        return out
    own = F.when(F.col(label) == 1, 1.0) if rescore_negatives else F.col(label).cast("double")
    return out.withColumn(name, F.coalesce(own, F.col(name)))


def at_once(spark: SparkSession, fits: Sequence[Callable[[], T]], most: int = 4) -> list[T]:
    """Results of the fits, `most` of which run at a time; Spark shares its executors among their jobs."""
    with ThreadPoolExecutor(max_workers=most) as pool:
        return list(pool.map(inheritable_thread_target(spark)(lambda f: f()), fits))


def cross_val_predict(pipeline: Callable[[], Pipeline], df: DataFrame, key: str, label: str, k: int = 5, name: str = "score", seed: int = 7) -> DataFrame:
    """Each labelled row, its fold, and its score by a model that hasn't seen that fold: k fits, side by side. df is computed
    and written once, each fold in files of its own, so that a fit reads the others' files only."""
    kept = written(assign_folds(df.where(F.col(label).isNotNull()), key, k, seed), ["fold"])
    models = at_once(df.sparkSession, [lambda i=i: pipeline().fit(kept.where(F.col("fold") != i)) for i in range(k)])
    return reduce(DataFrame.unionByName, [predict(m, kept.where(F.col("fold") == i), name) for i, m in enumerate(models)])


def safe_fit(pipeline: Pipeline, df: DataFrame, label: str) -> PipelineModel | None:
    """None where one class has no rows."""
    classes = {r[0] for r in df.where(F.col(label).isNotNull()).select(F.col(label).cast("int")).distinct().limit(3).collect()}
    return pipeline.fit(df.where(F.col(label).isNotNull())) if len(classes) > 1 else None


def safe_score(model: PipelineModel | None, df: DataFrame, label: str, name: str = "score", fallback: str = "empty", **settings) -> DataFrame:
    """Without a model: no rows, or (fallback='label') the label itself."""
    if model is not None:
        return score(model, df, label, name, **settings)
    out = df.withColumn(name, F.col(label).cast("double"))
    return out if fallback == "label" else out.limit(0)


# Members of the soft vote and their weights, by minutes of an interval.
ENSEMBLES: dict[int, dict[str, float]] = {
    15: {"lr": 1, "gbt": 2, "rf": 1},
    30: {"svc": 1, "lr": 2, "rf": 1},
    60: {"lr": 1, "gbt": 2, "rf": 1},
}


def fit_ensembles(df: DataFrame, by: str, groups: Sequence, label: str, features: Sequence[str], seed: int = 7, members: dict[int, dict[str, float]] = ENSEMBLES) -> dict:
    """Models per group, those of `members` for it; groups that lack a class have none. lr: logistic regression; gbt:
    boosted trees; rf: forest; svc: a linear support vector machine with a logistic curve over its margin, which makes
    it a probability. Labelled rows are computed and written once, in files by group; a group's features are assembled once
    for all of its members, and members are fitted side by side."""
    kept = written(df.where(F.col(label).isNotNull() & F.col(by).isin(list(groups))).select(by, label, *features), [by])
    classes: dict = {}
    for g, y in kept.select(by, F.col(label).cast("int")).distinct().collect():
        classes.setdefault(g, set()).add(y)
    kinds = {
        "lr": lambda: [LogisticRegression(labelCol=label, maxIter=30)],
        "gbt": lambda: [GBTClassifier(labelCol=label, maxIter=10, seed=seed)],
        "rf": lambda: [RandomForestClassifier(labelCol=label, numTrees=30, seed=seed)],
        "svc": lambda: [LinearSVC(labelCol=label, maxIter=30, rawPredictionCol="_margin", predictionCol="_side"), LogisticRegression(labelCol=label, featuresCol="_margin", maxIter=30)],
    }
    out: dict = {}
    for g in groups:
        if len(classes.get(g, ())) < 2:
            continue
        rows = kept.where(F.col(by) == g)
        base = Pipeline(stages=_assembly(features, (), ())).fit(rows)
        ready = written(base.transform(rows).select("features", label))
        fits = at_once(df.sparkSession, [lambda k=k: Pipeline(stages=kinds[k]()).fit(ready) for k in members[g]])
        out[g] = {k: PipelineModel(stages=[*base.stages, *m.stages]) for k, m in zip(members[g], fits, strict=True)}
    return out


def score_ensembles(models: dict, df: DataFrame, by: str, name: str = "score", members: dict[int, dict[str, float]] = ENSEMBLES) -> DataFrame:
    """Weighted mean of the group's models; rows of groups without models score 0."""
    out = df.where(~F.coalesce(F.col(by).isin(list(models)), F.lit(False))).withColumn(name, F.lit(0.0))
    for g, own in models.items():
        part = df.where(F.col(by) == g)
        for k in own:
            part = predict(own[k], part, f"_{k}")
        vote = sum((members[g][k] * F.col(f"_{k}") for k in own), F.lit(0.0)) / sum(members[g].values())
        out = out.unionByName(part.withColumn(name, vote).drop(*[f"_{k}" for k in own]))
    return out
