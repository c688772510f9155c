"""Fitted pipelines as SQL text, so that any engine can score with them and check what Spark says."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LinearSVCModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import ImputerModel, VectorAssembler, VectorIndexerModel


def number(x: float) -> str:
    """A literal of type double in every dialect."""
    text = repr(float(x))
    return f"({text if 'e' in text else text + 'e0'})"


def _tree(node, inputs: Sequence[str], leaf) -> str:
    """A fitted tree as nested CASE; leaf gives the value of a leaf."""
    if node.subtreeDepth() == 0:
        return number(leaf(node))
    split = node.split()
    x = inputs[split.featureIndex()]
    if hasattr(split, "threshold") and split.getClass().getSimpleName() == "ContinuousSplit":
        test = f"{x} <= {number(split.threshold())}"
    else:
        test = f"{x} in ({', '.join(number(c) for c in split.leftCategories())})"
    return f"case when {test} then {_tree(node.leftChild(), inputs, leaf)} else {_tree(node.rightChild(), inputs, leaf)} end"


def _share(node) -> float:
    """The share of class 1 in a leaf."""
    stats = list(node.impurityStats().stats())
    return stats[1] / sum(stats)


def _linear(weights: Sequence[float], inputs: Sequence[str], intercept: float) -> str:
    return " + ".join([number(intercept), *(f"{number(w)} * {x}" for w, x in zip(weights, inputs, strict=True))])


def probability_sql(model: PipelineModel) -> str:
    """The probability of class 1 as an expression over the pipeline's input columns, which have to be doubles.

    Imputers, assemblers and indexers of vectors may come first; boosted trees, forests, logistic regression, or a support
    vector machine with a logistic curve over its margin come last. A stage of another kind is a ValueError."""
    filled: dict[str, str] = {}
    inputs: list[str] = []
    margin: list[str] | None = None
    for stage in model.stages:
        if isinstance(stage, ImputerModel):
            row = stage.surrogateDF.first()
            for source, name in zip(stage.getInputCols(), stage.getOutputCols(), strict=True):
                filled[name] = f"case when {source} is null or isnan({source}) then {number(row[source])} else {source} end"
        elif isinstance(stage, VectorAssembler):
            inputs = [filled.get(c, c) for c in stage.getInputCols()]
        elif isinstance(stage, VectorIndexerModel):
            for at, values in stage.categoryMaps.items():
                known = " ".join(f"when {inputs[at]} = {number(v)} then {number(i)}" for v, i in values.items())
                inputs[at] = f"case {known} else {number(len(values))} end"
        elif isinstance(stage, GBTClassificationModel):
            total = " + ".join(f"{number(w)} * ({_tree(t._java_obj.rootNode(), inputs, lambda n: n.prediction())})" for t, w in zip(stage.trees, stage.treeWeights, strict=True))
            return f"1e0 / (1e0 + exp(-2e0 * ({total})))"
        elif isinstance(stage, RandomForestClassificationModel):
            return f"({' + '.join(f'({_tree(t._java_obj.rootNode(), inputs, _share)})' for t in stage.trees)}) / {number(stage.getNumTrees)}"
        elif isinstance(stage, LinearSVCModel):
            m = f"({_linear(stage.coefficients, inputs, stage.intercept)})"
            margin = [f"(-{m})", m]
        elif isinstance(stage, LogisticRegressionModel):
            return f"1e0 / (1e0 + exp(-({_linear(stage.coefficients, margin or inputs, stage.intercept)})))"
        else:
            raise ValueError(f"no SQL for {type(stage).__name__}")
    raise ValueError("the pipeline has no classifier")
