"""Distributed training against the brute-force recursion."""

import random

import pytest
from pyspark.sql import functions as F

from coppice.operators.score import accuracy, compiles, predict, predict_each, tree_accuracies, walk
from coppice.operators.tree import _Training, train_tree, train_trees
from coppice.operators.treemodel import TreeModel, model_from_rows
from tests.brute_force import grow, kinds, score

SCHEMA = "a double, b double, c string, d int, e double, y string, s int"
FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(autouse=True)
def small_buckets(monkeypatch):
    monkeypatch.setattr("coppice.operators.tree.ROWS_PER_BUCKET", 5)


def make_rows(seed, n=120, labels=3, missing=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = round(rng.gauss(0, 1), 2)
        row = {
            "a": a,
            "b": a,  # ties with a
            "c": rng.choice(["x", "y", "z", "w"]),
            "d": rng.randint(0, 6),
            "e": 1.0,  # constant
            "y": str(min(labels - 1, int((a > 0.3) + (rng.random() < 0.3)))),
            "s": i % 3,
        }
        for f in ("a", "c", "d"):
            if rng.random() < missing:
                row[f] = None
        rows.append(row)
    return rows


def as_df(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("criterion", ["entropy", "gini"])
def test_matches_brute_force(spark, seed, criterion):
    rows = make_rows(seed)
    model = train_tree(as_df(spark, rows), FEATURES, "y", criterion=criterion, max_depth=4)
    assert model.nested(0) == grow(rows, FEATURES, "y", max_depth=4, criterion=criterion)


@pytest.mark.parametrize("seed", range(2))
def test_missing_values_answer_no(spark, seed):
    rows = make_rows(seed + 50, missing=0.2)
    model = train_tree(as_df(spark, rows), FEATURES, "y", max_depth=3)
    assert model.nested(0) == grow(rows, FEATURES, "y", max_depth=3)


@pytest.mark.parametrize("labels", [2, 3])
@pytest.mark.parametrize("buckets", [3, 16])
def test_bucketed_search_is_exhaustive(spark, labels, buckets):
    """Few and coarse buckets, on numbers and on text with many values."""
    rng = random.Random(buckets)
    rows = make_rows(7, 200, labels, missing=0.05)
    for r in rows:
        r["c"] = f"t{rng.randint(0, 40)}"
    df = as_df(spark, rows)
    options = dict(direct_rows=0, direct_values=5, buckets=buckets, max_depth=3)
    model = train_tree(df, FEATURES, "y", **options)
    assert model.nested(0) == grow(rows, FEATURES, "y", max_depth=3)


def test_bucketed_search_with_opened_buckets_kept_distributed(spark, monkeypatch):
    monkeypatch.setattr("coppice.operators.tree.LOCAL_BUCKETS", 0)
    monkeypatch.setattr("coppice.operators.tree.BROADCAST_ROWS", 0)
    monkeypatch.setattr("coppice.operators.tree.ROWS_PER_BUCKET", 10)
    rows = make_rows(13, 200)
    options = dict(direct_rows=0, direct_values=5, max_depth=2)
    model = train_tree(as_df(spark, rows), FEATURES, "y", **options)
    assert model.nested(0) == grow(rows, FEATURES, "y", max_depth=2)


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_opened_buckets_walked_in_segments(spark, monkeypatch, broadcast):
    """Labels without signal leave buckets open; the values of one are dealt to many tasks."""
    monkeypatch.setattr("coppice.operators.tree.SEGMENT_VALUES", 15)
    monkeypatch.setattr("coppice.operators.tree.BROADCAST_ROWS", broadcast)
    rng = random.Random(5)
    rows = make_rows(17, 240)
    for r in rows:
        r |= {"a": rng.random(), "b": rng.randint(0, 90) / 4, "c": f"t{rng.randint(0, 50)}", "y": rng.choice("pqr")}
    options = dict(direct_rows=0, direct_values=5, buckets=2, max_depth=3)
    model = train_tree(as_df(spark, rows), FEATURES, "y", **options)
    assert model.nested(0) == grow(rows, FEATURES, "y", max_depth=3)


def test_segments_give_the_counts_of_one_walk(spark, monkeypatch):
    """No group of the walk holds many values, though all lie in two buckets without signal."""
    df = spark.range(20_000).select(F.rand(1).alias("a"), (F.rand(2) < 0.5).cast("string").alias("y"))
    df = df.withColumn("a", F.round("a", 4))
    parts = []
    upto = _Training._upto

    def seen(self, counted, keys, n_values):
        out = upto(self, counted, keys, n_values)
        if "part" in out.columns:
            parts.append(out.groupBy(*keys, "part").count().agg(F.max("count"), F.count("*")).first())
        return out

    monkeypatch.setattr(_Training, "_upto", seen)
    options = dict(direct_rows=0, direct_values=5, buckets=2, max_depth=2)
    whole = train_tree(df, ["a"], "y", **options)
    assert not parts
    monkeypatch.setattr("coppice.operators.tree.SEGMENT_VALUES", 500)
    assert train_tree(df, ["a"], "y", **options).nested(0) == whole.nested(0)
    assert parts and max(most for most, _ in parts) < 2000 and parts[0][1] > 20


def test_bucketed_search_with_many_labels(spark):
    rows = make_rows(11, 200)
    rng = random.Random(3)
    for r in rows:
        r["y"] = str(int(r["b"] * 2) + rng.randint(0, 2))
    df = as_df(spark, rows)
    model = train_tree(df, FEATURES, "y", direct_rows=0, direct_values=5, buckets=8, max_depth=3)
    assert model.nested(0) == grow(rows, FEATURES, "y", max_depth=3)


@pytest.mark.parametrize("bucketed", [False, True])
def test_shard_trees_equal_trees_trained_alone(spark, bucketed):
    rows = make_rows(21, 150)
    # d is continuous in shard 0 only
    for i, r in enumerate(rows):
        if r["s"] == 0:
            r["d"] = i
    options = dict(direct_rows=0, direct_values=5, buckets=4) if bucketed else {}
    model = train_trees(as_df(spark, rows), FEATURES, "y", shard="s", max_depth=3, **options)
    assert model.shards == {0: "0", 1: "1", 2: "2"}
    for shard in range(3):
        part = [r for r in rows if r["s"] == shard]
        assert model.nested(shard) == grow(part, FEATURES, "y", max_depth=3)


def test_unlimited_depth_and_checkpoints(spark):
    rng = random.Random(5)
    rows = [
        dict(a=float(i), b=0.0, c="x", d=0, e=1.0, y=str(rng.randint(0, 1)), s=0) for i in range(24)
    ]
    model = train_tree(as_df(spark, rows), ["a"], "y", criterion="gini", max_depth=None)
    expected = grow(rows, ["a"], "y", max_depth=None, criterion="gini")
    assert model.nested(0) == expected
    assert max(n.depth for n in model.nodes()) > 6


def test_small_cases(spark):
    def tree(rows, schema, features, **options):
        return train_tree(spark.createDataFrame(rows, schema), features, "y", **options).nested(0)

    assert tree([(1.0, "k"), (2.0, "k")], "a double, y string", ["a"]) == "k"
    assert tree([(1.0, "b"), (2.0, "a")], "a double, y string", ["a"], min_samples=3) == "a"
    assert tree([(1.0, "b"), (1.0, "a"), (1.0, "a")], "a double, y string", ["a"]) == "a"
    # Equal impurity: the last feature and its largest value.
    twins = [(1.0, 1.0, "n"), (2.0, 2.0, "p")]
    assert tree(twins, "a double, b double, y string", ["a", "b"]) == {"b = 2.0": ["p", "n"]}
    # 15 distinct numbers are categories, 16 are not.
    few = [(float(i), "p" if i == 7 else "n") for i in range(15)]
    assert tree(few, "a double, y string", ["a"]) == {"a = 7.0": ["p", "n"]}
    many = [(float(i), "p" if i < 7 else "n") for i in range(16)]
    assert tree(many, "a double, y string", ["a"]) == {"a <= 6.0": ["p", "n"]}
    # Text is a category, however many values it has.
    texts = [(f"v{i:02d}", "p" if i == 3 else "n") for i in range(40)]
    assert tree(texts, "a string, y string", ["a"]) == {"a = v03": ["p", "n"]}
    # Integer labels keep their type when scoring.
    df = spark.createDataFrame([(1.0, 0), (2.0, 1)], "a double, y int")
    scored = predict(df, train_tree(df, ["a"], "y"))
    assert scored.schema["prediction"].dataType.simpleString() == "int"
    assert scored.filter("prediction = y").count() == 2


def test_node_table_round_trip_and_scores(spark, tmp_path):
    rows = make_rows(31, 150, missing=0.1)
    df = as_df(spark, rows)
    model = train_trees(df, FEATURES, "y", shard="s", max_depth=4)
    path = str(tmp_path / "model")
    model.save(spark, path)
    again = TreeModel.load(spark, path)
    assert again.nodes() == model.nodes()
    assert again.text_lines()[0].startswith("tree\t")

    types = kinds(rows, FEATURES)
    expected = {t: [score(r, model.nested(t), types) for r in rows] for t in model.tree_ids}
    numbered = spark.createDataFrame(
        [(i, *r.values()) for i, r in enumerate(rows)], "i int, " + SCHEMA
    )
    for r in predict_each(numbered, again).select("i", "tree_id", "prediction").collect():
        assert r["prediction"] == expected[r["tree_id"]][r["i"]]
    first = predict(numbered, again).select("i", "prediction").collect()
    assert all(r["prediction"] == expected[0][r["i"]] for r in first)
    shares = {r["tree_id"]: r["accuracy"] for r in tree_accuracies(df, again, "y").collect()}
    for t, predicted in expected.items():
        hits = sum(p == r["y"] for p, r in zip(predicted, rows)) / len(rows)
        assert shares[t] == pytest.approx(hits)
    one = accuracy(predict(df, again), label="y").first()["accuracy"]
    assert one == pytest.approx(shares[0])


def test_leaf_only_tree_scores_everything(spark):
    model = model_from_rows([(0, 1, 0, None, None, None, None, None, None, "q", 3)])
    df = spark.range(3)
    assert [r["prediction"] for r in predict(df, model).collect()] == ["q"] * 3


def test_value_with_blanks(spark):
    df = spark.createDataFrame([("new york", "p"), ("oslo", "n")], "a string, y string")
    model = train_tree(df, ["a"], "y")
    assert predict(df, model).filter("prediction = y").count() == 2


def test_lineitem_on_both_paths(spark, table):
    df = table("lineitem")
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
    direct = train_tree(df, features, "l_returnflag", max_depth=3)
    bucketed = train_tree(
        df, features, "l_returnflag", max_depth=3, direct_rows=0, direct_values=8, buckets=32
    )
    assert direct.nodes() == bucketed.nodes()


def test_nan_is_missing(spark):
    df = spark.createDataFrame(
        [(float("nan"), "p"), (1.0, "n"), (2.0, "n")], "a double, y string"
    )
    model = train_tree(df, ["a"], "y")
    assert predict(df, model).filter(F.col("prediction") == F.col("y")).count() >= 2


def test_stored_model_keeps_label_type_and_shards(spark, tmp_path):
    rows = [(i % 2, float(i), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "shard int, a double, y int")
    model = train_trees(df, ["a"], "y", shard="shard", max_depth=2)
    model.save(spark, str(tmp_path / "model"))
    again = TreeModel.load(spark, str(tmp_path / "model"))
    assert again == model
    assert predict(df, again).schema["prediction"].dataType.simpleString() == "int"


def chain(levels: int) -> TreeModel:
    """A tree that asks ``a <= 0``, ``a <= 1``, ... and ends with a leaf for each."""
    rows = []
    for d in range(levels):
        rows.append((0, 2 * d + 1, d, "a", "<=", float(d), None, 2 * d + 2, 2 * d + 3, None, 1))
        rows.append((0, 2 * d + 2, d + 1, None, None, None, None, None, None, f"leaf{d}", 1))
    rows.append((0, 2 * levels + 1, levels, None, None, None, None, None, None, "rest", 1))
    return model_from_rows(rows)


def test_deep_trees_walk_the_node_table(spark):
    model = chain(60)
    assert not compiles(model)
    df = spark.createDataFrame([(float(i),) for i in range(-1, 70, 7)] + [(None,), (float("nan"),)], "a double")
    got = {str(r.a): r.prediction for r in predict(df, model).collect()}
    expected = {str(float(i)): f"leaf{max(i, 0)}" if i < 60 else "rest" for i in range(-1, 70, 7)}
    assert got == expected | {"None": "rest", "nan": "rest"}
    assert chain(1200).prediction(df) is not None  # no limit of Python calls


def test_walk_equals_compiled_conditions(spark):
    rows = [(float(i % 7), "xyz"[i % 3], i % 4, "pq"[i % 2]) for i in range(200)] + [(None, None, None, "p")]
    df = spark.createDataFrame(rows, "a double, t string, b int, y string")
    model = train_trees(df.withColumn("s", F.lit(1)), ["a", "t", "b"], "y", shard="s", max_depth=4)
    key = lambda frame: sorted(map(str, frame.collect()))
    assert key(walk(df, model, model.tree_ids)) == key(predict_each(df, model).select(*df.columns, "tree_id", "prediction"))


def test_integers_beyond_doubles_are_refused(spark):
    df = spark.createDataFrame([(2**60 + i, str(i // 30)) for i in range(60)], "k long, y string")
    with pytest.raises(ValueError, match="k holds integers"):
        train_tree(df, ["k"], "y")


@pytest.mark.parametrize("seed", range(2))
def test_equal_rows_are_held_once(spark, monkeypatch, seed):
    rows = [r for r in make_rows(seed + 80, 120, missing=0.1) for _ in range(5)]
    held, level = [], _Training._level
    monkeypatch.setattr(_Training, "_level", lambda self, at: held.append(at.count()) or level(self, at))
    options = dict(direct_rows=0, direct_values=5, buckets=4, max_depth=3)
    model = train_tree(as_df(spark, rows), FEATURES, "y", **options)
    assert model.nested(0) == grow(rows, FEATURES, "y", max_depth=3)
    assert held[0] <= 120
    shards = train_trees(as_df(spark, rows), FEATURES, "y", shard="s", **options)
    for tree_id, shard in shards.shards.items():
        part = [r for r in rows if str(r["s"]) == shard]
        assert shards.nested(tree_id) == grow(part, FEATURES, "y", max_depth=3)


def test_training_cuts_scans_into_several_parts_a_core(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    path = str(tmp_path / "rows")
    spark.range(5 * cores).selectExpr("id % 7 as f", "id % 2 as y").repartition(5 * cores).write.parquet(path)
    train_tree(spark.read.parquet(path), ["f"], "y", max_depth=1)
    # Spark takes a further file where only its bytes, not the cost of opening it, still fit.
    assert spark.read.parquet(path).rdd.getNumPartitions() >= 2 * cores


def test_one_pass_tells_kinds_of_many_rows(spark):
    rows = spark.range(3000).selectExpr("id % 900 / 4 as a", "CASE WHEN id % 3 > 0 THEN id % 5 / 2 END as b", "id % 2 as y")
    options = dict(direct_rows=0, direct_values=32, buckets=16)
    training = _Training(rows, ["a", "b"], "y", None, "entropy", 3, 2, 10, 32, 0, 16, False)
    training._prepare()
    assert [f.continuous for f in training.features] == [True, False]
    assert training.overall["m1"] == 1000
    assert train_tree(rows, ["a", "b"], "y", **options).text_lines() == train_tree(rows, ["a", "b"], "y").text_lines()
