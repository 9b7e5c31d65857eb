"""Trees grown and kept in tables against the brute-force recursion and the model in memory."""

import random

import pytest
from pyspark.sql import functions as F

from coppice.operators import growth, nodetable
from coppice.operators.growth import grow_nodes
from coppice.operators.tree import train_tree
from coppice.operators.treemodel import TreeModel
from tests.brute_force import grow, kinds, score
from tests.test_tree import FEATURES, as_df, make_rows


@pytest.mark.parametrize("criterion, missing, cells", [("gini", 0.0, 40), ("entropy", 0.2, 40), ("gini", 0.2, 10_000), ("entropy", 0.0, 10_000)])
def test_unlimited_tree_against_brute_force(spark, criterion, missing, cells):
    rows = make_rows(3, missing=missing)
    nodes = grow_nodes(as_df(spark, rows), FEATURES, "y", criterion, local_cells=cells).df
    whole = TreeModel.from_table(nodes)
    assert whole.collapsed().nested(0) == grow(rows, FEATURES, "y", max_depth=None, criterion=criterion)
    assert whole.depth > 8 and len({n.node_id for n in whole.nodes()}) == whole.size


def test_segments_of_many_values(spark, monkeypatch):
    monkeypatch.setattr(growth, "SEGMENT_VALUES", 8)
    rows = make_rows(4, missing=0.1)
    nodes = grow_nodes(as_df(spark, rows), FEATURES, "y", "entropy", max_depth=3, local_cells=0).df
    assert TreeModel.from_table(nodes).collapsed().nested(0) == grow(rows, FEATURES, "y", max_depth=3)


def test_batches_cut_between_nodes(spark, monkeypatch):
    monkeypatch.setattr(growth, "BATCH_CELLS", 30)
    rows = make_rows(1)
    nodes = grow_nodes(as_df(spark, rows), FEATURES, "y", "gini", local_cells=50).df
    assert TreeModel.from_table(nodes).collapsed().nested(0) == grow(rows, FEATURES, "y", max_depth=None, criterion="gini")


@pytest.mark.parametrize("cells", [0, 10_000])
def test_many_labels(spark, cells):
    """Counts are rows per label that occurs, so labels cost nothing where they are not."""
    rng = random.Random(2)
    rows = [{"a": float(rng.randint(0, 400)), "b": rng.choice("uvw"), "y": rng.randint(0, 5000)} for _ in range(300)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "a double, b string, y int")
    nodes = grow_nodes(df, ["a", "b"], "y", "gini", max_depth=2, local_cells=cells).df
    assert TreeModel.from_table(nodes).collapsed().nested(0) == grow(rows, ["a", "b"], "y", max_depth=2, criterion="gini")


def test_weights_and_awkward_tables(spark):
    rows = make_rows(6)
    df = as_df(spark, rows)
    often = df.withColumn("w", F.lit(3)).union(df.limit(0).withColumn("w", F.lit(1)))
    thrice = df.union(df).union(df)
    a, b = (TreeModel.from_table(grow_nodes(x, FEATURES, "y", max_depth=3, weight=w).df) for x, w in ((often, "w"), (thrice, None)))
    assert a.nested(0) == b.nested(0) and [n.n for n in a.nodes()] == [n.n for n in b.nodes()]
    empty = grow_nodes(df.filter("false"), FEATURES, "y").df
    assert empty.count() == 0
    assert nodetable.predict_by_nodes(df, empty).filter("prediction IS NOT NULL").count() == 0
    assert nodetable.collapsed(empty).df.count() == 0 and nodetable.with_texts(empty).df.count() == 0
    one = grow_nodes(df.filter("y = '0'"), FEATURES, "y").df
    assert [(r.label, r.depth) for r in one.collect()] == [("0", 0)]
    assert nodetable.predict_by_nodes(df, one).filter("prediction = '0'").count() == len(rows)


@pytest.mark.parametrize("seed", range(2))
def test_collapsed_tables_and_texts(spark, seed):
    rows = make_rows(seed, missing=0.1, labels=2)
    model = train_tree(as_df(spark, rows), FEATURES, "y", max_depth=6, collapse=False)
    kept = nodetable.collapsed(model.to_table(spark)).df
    wanted = model.collapsed()
    assert wanted.size < model.size
    assert TreeModel.from_table(kept).nodes() == wanted.nodes()
    paths = wanted.paths(0)
    assert {(r.node_id, r.path) for r in kept.collect()} == set(paths.items())
    texts = {r.node_id: r.text for r in nodetable.with_texts(kept).df.collect()}
    assert texts == {i: repr(wanted.nested(0, i)) for i in paths}


@pytest.mark.parametrize("most", [nodetable.WALK_NODES, 0])
def test_scores_of_node_tables(spark, monkeypatch, most):
    monkeypatch.setattr(nodetable, "WALK_NODES", most)
    monkeypatch.setattr(nodetable, "STORED_LEVELS", 3)
    rows = make_rows(7, missing=0.2)
    nodes = grow_nodes(as_df(spark, rows), FEATURES, "y", "gini", max_depth=7).df
    others = make_rows(8, missing=0.3)
    scored = nodetable.predict_by_nodes(as_df(spark, others).withColumn("_op", F.lit(1)).drop("_op"), nodes).collect()
    tree, types = grow(rows, FEATURES, "y", max_depth=7, criterion="gini"), kinds(rows, FEATURES)
    key = ["a", "b", "c", "d", "e", "y", "s"]
    assert sorted(map(str, ((*[r[k] for k in key], r.prediction) for r in scored))) == sorted(
        map(str, ((*[r[k] for k in key], score(r, tree, types)) for r in others))
    )


@pytest.mark.parametrize("most", [nodetable.WALK_NODES, 60, 0])
def test_many_trees_in_batches(spark, monkeypatch, most):
    """Each tree by itself, whatever batches of trees go to the executors together."""
    monkeypatch.setattr(nodetable, "WALK_NODES", most)
    rows = make_rows(9, missing=0.1)
    df = as_df(spark, rows)
    trees = [grow_nodes(df.filter(F.col("s") == s), FEATURES, "y", max_depth=4).df.withColumn("tree_id", F.lit(s + 3)) for s in range(3)]
    nodes = trees[0].union(trees[1]).union(trees[2])
    scored = nodetable.predict_each_by_nodes(df, nodes).select("tree_id", "y", "prediction").collect()
    assert len(scored) == 3 * len(rows)
    shares = {r.tree_id: r.accuracy for r in nodetable.accuracies_by_nodes(df, nodes, "y").collect()}
    for s in range(3):
        own = [r for r in rows if r["s"] == s]
        tree, types = grow(own, FEATURES, "y", max_depth=4, criterion="gini"), kinds(own, FEATURES)
        wanted = sorted((r["y"], score(r, tree, types)) for r in rows)
        assert sorted((r.y, r.prediction) for r in scored if r.tree_id == s + 3) == wanted
        assert shares[s + 3] == pytest.approx(sum(a == b for a, b in wanted) / len(rows))
    assert nodetable.accuracies_by_nodes(df, nodes.limit(0), "y").count() == 0
    assert nodetable.predict_each_by_nodes(df, nodes, trees=[4]).select("tree_id").distinct().collect()[0][0] == 4
