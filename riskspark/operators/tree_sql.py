"""Boosted trees as SQL expressions: scores without vectors, inside Spark's generated code.

Every tree becomes nested ``CASE`` branches over numeric columns, with the training medians in place of missing values; the
weighted sum of the trees gives the probability. Several models can be scored in one pass over a table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.operators.project import align_features
from riskspark.operators.ranks import quoted


def _columns(features: Sequence[str], medians: Sequence[float]) -> tuple[list[str], list[str]]:
    """SQL names of the slots of the training vector: features with medians filled in, then 0/1 "was missing" columns.

    The value columns hold no NaN; ``tree_columns`` makes them.
    """
    values = [f"coalesce({quoted(f)}, {float(m)!r}D)" for f, m in zip(features, medians)]
    return values, [quoted(f) for f in features]


def _branch(node, values: list[str], names: list[str], edges: Sequence[Sequence[float]] | None) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    split, n = node.split(), len(values)
    at, limit = split.featureIndex(), split.threshold()
    # A missing flag is 0 or 1, so its threshold only asks whether the value is there.
    if at >= n:
        below = f"{names[at - n]} IS NOT NULL" if 0 <= limit < 1 else str(limit >= 1).lower()
    elif edges is None:
        below = f"{values[at]} <= {limit!r}D"
    else:
        # Bins up to the threshold end at an edge.
        edge = edges[at][min(max(math.floor(limit) + 1, 0), len(edges[at]) - 1)]
        below = f"{values[at]} < {edge!r}D" if math.isfinite(edge) else str(edge > 0).lower()
    return f"CASE WHEN {below} THEN {_branch(node.leftChild(), values, names, edges)} ELSE {_branch(node.rightChild(), values, names, edges)} END"


def tree_expressions(
    trees: GBTClassificationModel, features: Sequence[str], medians: Sequence[float], edges: Sequence[Sequence[float]] | None = None
) -> list[str]:
    """One SQL expression per tree, its weight included. ``edges`` are those of the bins that the trees were fitted on, if any."""
    values, names = _columns(features, medians)
    return [
        f"{float(w)!r}D * {_branch(tree._java_obj.rootNode(), values, names, edges)}" for w, tree in zip(trees.treeWeights, trees.trees)
    ]


def probability(expressions: Sequence[str]) -> Column:
    """Probability of class 1 from the trees' sum, as the trained model computes it."""
    margin = F.expr(" + ".join(f"({e})" for e in expressions))
    return F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(2.0) * margin))


def model_expressions(model: PipelineModel) -> tuple[list[str], list[str]]:
    """(features, tree expressions) of a pipeline made by ``models.train_model``."""
    imputer, trees = model.stages[0], model.stages[-1]
    features = list(imputer.getInputCols())
    found = imputer.surrogateDF.first()
    edges = next((s.getSplitsArray() for s in model.stages if isinstance(s, Bucketizer)), None)
    return features, tree_expressions(trees, features, [found[c] for c in features], edges)


def score_with_sql(df: DataFrame, models: PipelineModel | Mapping[str, PipelineModel], score: str = "score") -> DataFrame:
    """The scores of one model, or a column for each of several, next to the other columns; features are dropped.

    Every feature of every model must be present; text is read as numbers, NaN and null are missing.
    """
    named = {score: models} if isinstance(models, PipelineModel) else dict(models)
    compiled = {name: model_expressions(m) for name, m in named.items()}
    features = list(dict.fromkeys(f for fs, _ in compiled.values() for f in fs))
    numeric = align_features(df, features)
    keep = [c for c in df.columns if c not in features and c not in named]
    return numeric.select(*keep, *[probability(e).alias(name) for name, (_, e) in compiled.items()])
