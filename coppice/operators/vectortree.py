"""Trees over feature vectors with MLlib: fit, predict, evaluate, compare criteria."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.operators.columns import col
from coppice.operators.encode import assemble
from coppice.operators.growth import grow_nodes
from coppice.operators.nodetable import predict_by_nodes
from coppice.operators.profile import row_counts
from coppice.session import deal_rows


def with_vector(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """Feature vector, and the label as a double, next to the other columns."""
    staged = df if label is None else df.withColumn("_label", col(label).cast("double"))
    return assemble(staged, features, "_features")


def fit_vector_tree(
    df: DataFrame,
    features: Sequence[str],
    label: str = "target",
    criterion: str = "entropy",
    max_depth: int = 5,
    max_bins: int = 256,
) -> DecisionTreeClassificationModel:
    """Fit a tree on numeric columns.

    Candidates are quantile bins, ``max_bins`` per feature; memory per node grows with
    features, bins and labels, so an unbounded number of bins does not scale. For
    every observed value as a candidate use ``coppice.operators.tree``, and for a tree without
    a depth limit (MLlib stops at 30) ``coppice.operators.growth``.

    MLlib holds its input in memory by partition. Equal rows become one with their number as its
    weight where that halves the table; other tables are dealt out by their number of rows.
    """
    rows = df.select(*[col(c) for c in dict.fromkeys(features)], col(label).alias("_label"))
    n_rows, different = row_counts(rows)
    if 2 * different <= n_rows:
        weighted = rows.groupBy(*[col(c) for c in rows.columns]).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    else:
        weighted = deal_rows(rows, n_rows).withColumn("_weight", F.lit(1.0))
    learner = DecisionTreeClassifier(
        labelCol="_label",
        featuresCol="_features",
        weightCol="_weight",
        impurity=criterion,
        maxDepth=max_depth,
        maxBins=max_bins,
    )
    return learner.fit(with_vector(weighted, features, "_label").select("_features", "_label", "_weight"))


def predict_vector(
    df: DataFrame,
    model: DecisionTreeClassificationModel,
    features: Sequence[str],
    name: str = "prediction",
) -> DataFrame:
    scored = model.transform(with_vector(df, features))
    return scored.select(*[col(c) for c in df.columns], F.col("prediction").alias(name))


def vector_accuracy(df: DataFrame, prediction: str = "prediction", label: str = "target") -> float:
    evaluator = MulticlassClassificationEvaluator(
        labelCol="_label", predictionCol="_prediction", metricName="accuracy"
    )
    return evaluator.evaluate(
        df.select(col(label).cast("double").alias("_label"), col(prediction).alias("_prediction"))
    )


def compare_criteria(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = "target",
    settings: Sequence[tuple[str, int | None]] = (("gini", None), ("entropy", 3)),
    max_bins: int = 256,
) -> DataFrame:
    """Holdout accuracy per ``(criterion, max_depth)`` as a table.

    Trees with a depth are binned; ``None`` grows one without a limit, which asks ``<=`` of every
    value of a number.
    """
    result = []
    for criterion, depth in settings:
        if depth is None:
            nodes = grow_nodes(train, features, label, criterion, category_values=0)
            scored = predict_by_nodes(test, nodes.df, label_type="double")
        else:
            scored = predict_vector(test, fit_vector_tree(train, features, label, criterion, depth, max_bins), features)
        result.append((criterion, depth, vector_accuracy(scored, label=label)))
    return train.sparkSession.createDataFrame(result, "criterion string, max_depth int, accuracy double")
