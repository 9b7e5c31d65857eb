"""Scoring rows by trees, and accuracy.

Shallow small models become conditions of the plan: no join, no Python. Deep ones, and many
trees, would make plans that Spark cannot compile, so rows walk down the node table instead.
Both give the same labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.operators.columns import col
from coppice.operators.nodetable import accuracies_by_nodes, predict_each_by_nodes
from coppice.operators.treemodel import TreeModel

#: Depth and number of nodes up to which a model is compiled into the plan.
COMPILED_DEPTH, COMPILED_NODES = 30, 2000


def compiles(model: TreeModel) -> bool:
    return model.depth <= COMPILED_DEPTH and model.size <= COMPILED_NODES


def walk(df: DataFrame, model: TreeModel, trees: list[int], name: str = "prediction") -> DataFrame:
    """Every row with each of ``trees``: ``(..., tree_id, prediction)``, by the node table."""
    return predict_each_by_nodes(df, model.to_table(df.sparkSession), name, model.label_type, trees)


def predict(
    df: DataFrame, model: TreeModel, name: str = "prediction", tree_id: int | None = None
) -> DataFrame:
    """Add the label given by one tree, the first by default."""
    chosen = model.tree_ids[0] if tree_id is None else tree_id
    if compiles(model):
        return df.withColumn(name, model.prediction(df, chosen))
    return walk(df, model, [chosen], name).drop("tree_id")


def predict_each(df: DataFrame, model: TreeModel, name: str = "prediction") -> DataFrame:
    """Every row with every tree: ``(…, tree_id, prediction)``."""
    if not compiles(model):
        return walk(df, model, model.tree_ids, name)
    answers = F.array(
        *[F.struct(F.lit(t).alias("tree_id"), model.prediction(df, t).alias(name)) for t in model.tree_ids]
    )
    return df.select("*", F.inline(answers))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "target") -> DataFrame:
    """Share of rows whose prediction equals the label."""
    hit = F.coalesce(col(prediction) == col(label), F.lit(False))
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"))


def tree_accuracies(df: DataFrame, model: TreeModel, label: str = "target") -> DataFrame:
    """Accuracy of each tree on the same rows, in one pass over them."""
    if not compiles(model):
        return accuracies_by_nodes(df, model.to_table(df.sparkSession), label)
    hits = {
        t: F.coalesce(model.prediction(df, t) == col(label), F.lit(False)) for t in model.tree_ids
    }
    shares = df.agg(*[F.avg(hit.cast("double")).alias(f"a{t}") for t, hit in hits.items()])
    entries = [
        F.struct(F.lit(t).alias("tree_id"), F.col(f"a{t}").alias("accuracy")) for t in hits
    ]
    return shares.select(F.inline(F.array(*entries)))
