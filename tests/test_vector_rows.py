"""What the binned tree gets to hold: equal rows once, others dealt out by number."""

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from coppice import session
from coppice.operators import sampling, vectortree


def _fitted(monkeypatch, df, features):
    given = []
    fit = DecisionTreeClassifier.fit
    monkeypatch.setattr(DecisionTreeClassifier, "fit", lambda self, rows: given.append(rows) or fit(self, rows))
    model = vectortree.fit_vector_tree(df, features, "y", max_depth=3)
    return model, [r["count"] for r in given[0].groupBy(F.spark_partition_id()).count().collect()]


def test_equal_rows_are_held_once_and_weigh_the_same(spark, monkeypatch):
    df = spark.range(40_000).selectExpr("cast(id % 7 as double) a", "cast(id % 5 as double) b", "id % 7 * 3 + id % 5 > 9 AND id % 11 > 2 y")
    df = df.withColumn("y", F.col("y").cast("int"))
    model, sizes = _fitted(monkeypatch, df, ["a", "b"])
    assert sum(sizes) == df.select("a", "b", "y").distinct().count() < 100
    plain = DecisionTreeClassifier(labelCol="_label", featuresCol="_features", impurity="entropy", maxDepth=3, maxBins=256)
    expected = plain.fit(vectortree.with_vector(df, ["a", "b"], "y"))
    assert model.toDebugString.split("\n")[1:] == expected.toDebugString.split("\n")[1:]


def test_different_rows_are_dealt_out_by_number(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 1000)
    df = spark.range(20_000).selectExpr("cast(id as double) a", "cast(id > 7000 as int) y").coalesce(1)
    _, sizes = _fitted(monkeypatch, df, ["a"])
    assert sum(sizes) == 20_000 and max(sizes) <= 1100


def test_tags_part_rows_as_the_keyed_split(spark):
    df = spark.range(1000).selectExpr("IF(id % 10 = 0, NULL, cast(id as string)) k")
    train, test = sampling.keyed_split(df, "k", 0.7, 42)
    tagged = df.withColumn("part", sampling.tag_keyed("k", 0.7, 42))
    for name, part in (("train", train), ("test", test)):
        assert {r["k"] for r in tagged.filter(F.col("part") == name).collect()} == {r["k"] for r in part.collect()}
    assert tagged.filter("part IS NULL").isEmpty()
