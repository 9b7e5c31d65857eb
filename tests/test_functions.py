import random

from pyspark.sql import functions as F

from coppice.functions import numeric, text, timeofday


def evaluate(spark, values, schema, *expressions):
    df = spark.createDataFrame([(v,) for v in values], f"x {schema}")
    return [tuple(r) for r in df.select(*expressions).collect()]


def test_exact_even_rounding_equals_python(spark):
    rng = random.Random(1)
    values = [i / 20 for i in range(-400, 400)] + [i / 3600 for i in range(0, 90000, 37)]
    values += [rng.uniform(-1000, 1000) for _ in range(500)] + [0.25, 0.75, 7.35, 7.45, -0.05]
    for digits in (0, 1, 2):
        got = evaluate(spark, values, "double", numeric.round_exact_even("x", digits))
        assert [g[0] for g in got] == [round(v, digits) for v in values]


def test_tag_value_of_all_forms(spark):
    forms = ['{"primary_tags":"4"}', '"{""primary_tags"":""4""}"', '{""primary_tags"":""4""}', "{}", None]
    assert [r[0] for r in evaluate(spark, forms, "string", text.tag_value("x"))] == ["4", "4", "4", None, None]


def test_list_and_clean_up(spark):
    values = ["4,5,6", "4", "", None]
    got = evaluate(
        spark, values, "string", text.list_delimiter("x"), text.item_count(text.list_delimiter("x"))
    )
    assert got == [("4-5-6", 3), ("4", 1), ("", 1), (None, None)]
    line = ' [["a b", "c"]]\n'
    assert evaluate(spark, [line], "string", text.strip_list_marks("x")) == [("ab,c",)]
    assert evaluate(spark, ["a\\'b\"c"], "string", text.strip_tag_quotes("x")) == [("abc",)]
    assert evaluate(spark, ["it's \"x\""], "string", text.strip_quotes("x")) == [("its x",)]
    assert evaluate(spark, ["a-b-c"], "string", text.token("x", "-", 1), text.token("x", "-", -1)) == [("b", "c")]


def test_times_of_day(spark):
    values = ["08:30:15", "2020-01-02 08:30:15", "8:30:15", "00:00:00", "noon", "12:30", None]
    got = [r[0] for r in evaluate(spark, values, "string", timeofday.seconds_of_day("x"))]
    assert got == [30615, 30615, 30615, 0, None, None, None]


def test_opening_hours(spark):
    df = spark.createDataFrame(
        [("08:00:00", "12:21:00", "18:00:00", "01:00:00"), ("00:00:00",) * 4, (None,) * 4],
        "f1 string, t1 string, f2 string, t2 string",
    )
    got = df.select(
        timeofday.opening_hours("f1", "t1", "f2", "t2"),
        timeofday.opening_hours("f1", "t1", "f2", "t2", digits=1, binary=True, wrap_midnight=True),
    ).collect()
    assert [tuple(r) for r in got] == [(-12.65, round(11.35, 1)), (0.0, 0.0), (None, None)]


def test_impurities(spark):
    counts = [F.lit(3), F.lit(1), F.lit(0)]
    row = spark.range(1).select(
        numeric.impurity(counts), numeric.impurity(counts, "gini"),
        numeric.split_impurity([F.lit(2), F.lit(0)], [F.lit(0), F.lit(0)]),
    ).first()
    assert abs(row[0] - 0.8112781244591328) < 1e-12
    assert abs(row[1] - 0.375) < 1e-12
    assert row[2] == 0.0
