import statistics

import pytest
from pyspark.sql import functions as F

from coppice.functions import text, timeofday
from coppice.operators import columns, encode, impute, ordering, profile, sampling
from coppice.sources import readers, writers


@pytest.mark.parametrize("window_rows", [10, 10_000])
def test_order_statistics_with_a_hot_value(spark, window_rows):
    """A third of the rows share one value, and some are missing."""
    values = [float(i) for i in range(400)] + [123.0] * 300 + [None] * 50 + [float("nan")] * 5
    other = [i % 7 for i in range(len(values))]
    df = spark.createDataFrame(list(zip(values, other)), "a double, b int").repartition(4)
    held = sorted(v for v in values if v is not None and v == v)
    found = ordering.order_statistics(
        df, ["a"], {"a": [0, 200, 399, 699]}, window_rows=window_rows, sketch_error=0.01
    )
    assert found["a"] == [held[i] for i in (0, 200, 399, 699)]
    medians = impute.exact_medians(df, ["a", "b"], window_rows=window_rows)
    assert medians["a"] == statistics.median(held)
    assert medians["b"] == statistics.median(other)


def test_order_statistics_of_an_interval_that_stays_wide(spark):
    """One value holds most rows and the rank lies among many others next to it."""
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("a"))
    ranks = [1999, 2000, 2450]
    found = ordering.order_statistics(df, ["a"], {"a": ranks}, window_rows=5, sketch_error=0.2)
    assert found["a"] == [0, 2000, 2450]


def test_order_statistics_keep_long_integers(spark):
    df = spark.createDataFrame([(2**52 + i,) for i in range(9)], "a bigint")
    assert ordering.order_statistics(df, ["a"], {"a": [4]})["a"] == [2**52 + 4]


@pytest.mark.parametrize("window_rows", [10, 10_000])
def test_order_statistics_and_counts_share_a_pass(spark, window_rows):
    """Medians and counts of conditions, also with a sketch whose bounds miss the middle."""
    df = spark.range(2000).select((F.col("id") * 7 % 2000).alias("a"), (F.col("id") % 3).alias("b"))
    conditions = {"low": F.col("a") < 20, "one": F.col("b") == 1, "never": F.lit(None).cast("boolean")}
    met = {"low": 20, "one": 667, "never": 0}
    sketches = [None] + [
        ordering.MiddleSketch({"a": 2000}, {"a": bounds}) for bounds in [(990, 1010), (0, 10), (0, 1999)]
    ]
    for sketch in sketches:
        found = ordering.order_statistics_and_counts(df, ["a"], conditions, window_rows=window_rows, sketch=sketch)
        assert found == ({"a": [999, 1000]}, met)
    assert ordering.order_statistics_and_counts(df, [], conditions) == ({}, met)


def test_fill_values_are_learned_together(spark):
    """Frequent texts and medians of all columns take two passes, whatever the number of columns."""
    rows = [("a" if i < 61 else f"b{i}", "x" if i < 59 else None, i if i % 4 else None, i / 8) for i in range(100)]
    df = spark.createDataFrame(rows, "p string, q string, i int, d double").repartition(4)
    kept = {"p": "a", "d": 49 / 8}
    assert impute.learn_fill(df, {"string": "frequent", "int": "median_lower", "double": "median_lower"}).values == kept | {"i": 50}
    mixed = impute.learn_fill(df, {"string": "frequent", "int": "median", "double": "median_approx"})
    assert mixed.values == kept | {"i": 50.0} and mixed.doubles == ("i",)
    nothing = df.filter(F.lit(False))
    assert impute.learn_fill(nothing, {"string": "frequent", "int": "median_lower", "double": "median_approx"}).values == {}

    def jobs(columns: int) -> int:
        wide = df.select("*", *[F.col("d").alias(f"d{k}") for k in range(columns)])
        tell = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
        before = tell()
        impute.learn_fill(wide, {"string": "frequent", "double": "median_lower"})
        return tell() - before

    assert jobs(1) == jobs(12)


def test_frequent_values_of_a_small_share(spark):
    """One of very many values reaches a twentieth, another nearly; the sketch keeps a few hundred."""
    rare = F.concat(F.lit("r"), F.col("id").cast("string"))
    df = spark.range(20_000).select(
        F.when(F.col("id") % 20 == 3, "even").when(F.col("id") % 21 == 1, "fewer").otherwise(rare).alias("t")
    )
    assert impute.frequent_values(df, ["t"], 0.05) == {"t": "even"}
    assert impute.frequent_values(df, ["t"], 0.051) == {}


def test_row_index_is_total_and_ordered(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 400, 5).otherwise(F.col("id")).alias("k"))
    numbered = ordering.row_index(df.repartition(7), [F.desc("k"), "id"])
    got = [r["id"] for r in numbered.orderBy("row_index").collect()]
    assert got == [r["id"] for r in df.orderBy(F.desc("k"), "id").collect()]
    assert numbered.agg(F.min("row_index"), F.max("row_index")).first() == (1, 1000)
    unordered = ordering.row_index(spark.range(0, 50, 1, 4))
    assert sorted(r["row_index"] for r in unordered.collect()) == list(range(1, 51))


def test_exact_sample_with_equal_keys(spark):
    """All rows share one hash: the cut goes through the tie."""
    df = spark.range(101).select(F.lit("same").alias("key"), "id")
    sample, rest = sampling.exact_sample(df, 0.5, "key")
    assert sample.count() == 50 and rest.count() == 51
    assert sample.unionByName(rest).distinct().count() == 101
    everything, nothing = sampling.exact_sample(df, 500, "key")
    assert everything.count() == 101 and nothing.count() == 0


def test_keyed_shares(spark):
    df = spark.range(11000).withColumn("split", sampling.tag_split("id"))
    share = df.filter("split = 'Test'").count() / 11000
    assert abs(share - 2 / 11) < 0.015
    train, test = sampling.keyed_split(df, "id")
    assert train.count() + test.count() == 11000
    again, _ = sampling.keyed_split(df.repartition(9), "id")
    assert again.exceptAll(train).isEmpty()


def test_values_per_key_chunks_hot_keys_only(spark):
    df = spark.range(300).select(F.when(F.col("id") < 290, "hot").otherwise("cold").alias("k"), "id")
    listed = sampling.values_per_key(df, "k", "id", chunk_rows=50).collect()
    sizes = {(r["k"], r["chunk"]): len(r["values"]) for r in listed}
    assert sum(sizes.values()) == 300
    assert sizes["cold", 0] == 10 and len(sizes) == 7


def test_frequent_values_need_their_share(spark):
    rows = [("a" if i < 6 else "b", "x" if i < 5 else f"y{i}", None) for i in range(10)]
    df = spark.createDataFrame(rows, "p string, q string, r string")
    assert impute.frequent_values(df, ["p", "q", "r"]) == {"p": "a"}


def test_modes_take_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("b", 1), ("a", 1), (None, None)], "s string, i int")
    assert impute.modes(df, ["s", "i"]) == {"s": "a", "i": 1}


def test_fill_keeps_types(spark):
    df = spark.createDataFrame([(None, None, None), (1, 2.0, "x")], "i int, d double, s string")
    plan = impute.learn_fill(df, {"int": "median_approx", "double": "median", "string": "mode"})
    filled = plan.apply(df)
    assert filled.dtypes == df.dtypes
    assert [tuple(r) for r in filled.collect()] == [(1, 2.0, "x"), (1, 2.0, "x")]


@pytest.mark.parametrize("small", [0, 100])
@pytest.mark.parametrize("order", ["frequency", "alphabet"])
def test_codes(spark, small, order):
    train = spark.createDataFrame(
        [("b", "q"), ("b", "q"), ("a", "r"), ("c", None)], "s string, t string"
    )
    test = spark.createDataFrame([("a", "q"), ("b", "zzz"), ("c", "r"), (None, None)], "s string, t string")
    coded = encode.learn_codes(train, order=order, small=small).apply(test)
    expected = {"frequency": [1.0, 0.0, 2.0, 3.0], "alphabet": [0.0, 1.0, 2.0, 3.0]}[order]
    got = sorted(tuple(r) for r in coded.collect())
    assert got == sorted(zip(expected, [0.0, 2.0, 1.0, 2.0]))
    assert coded.columns == ["s", "t"]


def test_profile_of_types(spark):
    df = spark.createDataFrame([(1, 2.0, "x", None)], "i int, d double, s string, z string")
    assert profile.columns_by_type(df) == {"int": ["i"], "double": ["d"], "string": ["s", "z"]}
    assert profile.columns_of_type(df, "string") == ["s", "z"]
    assert profile.column_type(df, "d") == "double"
    assert profile.missing_in(df, "z") == 1
    assert profile.row_count(df) == 1


def test_feature_kinds_count_missing_as_a_value(spark):
    rows = [(float(i), float(i) if i else None) for i in range(15)] + [(0.0, 99.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert profile.feature_kinds(df) == {"a": "categorical", "b": "continuous"}


def test_partition_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "a double")
    yes, no = columns.partition_rows(df, "a", 1.0, continuous=True)
    assert yes.count() == 1 and no.count() == 2


def test_csv_keeps_quotes_commas_and_time_text(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [('a "quoted", b', "08:00:00", "2020-01-01 10:00:00", 1)], "s string, t string, c string, n int"
    )
    writers.write_csv(df, path, single_file=True)
    read = readers.read_csv(spark, path)
    assert [tuple(r) for r in read.collect()] == [tuple(r) for r in df.collect()]
    assert dict(read.dtypes)["t"] == "string" and dict(read.dtypes)["c"] == "string"
    assert readers.read_csv(spark, path, timestamps=True).dtypes[2][1].startswith("timestamp")


def test_positional_read_drops_headers_anywhere(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,gender\n1,"m, x"\nid,gender\n2,\n')
    read = readers.read_positional(spark, str(tmp_path / "t.csv"), ["id", "gender"], "gender")
    assert sorted(tuple(r) for r in read.collect()) == [("1", "m, x"), ("2", None)]


def test_zip_rows_and_cell(spark):
    left = spark.range(5).select((F.col("id") * 2).alias("a"))
    right = spark.range(4).select((-F.col("id")).alias("b"))
    zipped = sorted(tuple(r) for r in ordering.zip_rows(left, right, ["a"], ["b"]).collect())
    assert zipped == [(0, -3), (2, -2), (4, -1), (6, 0)]
    assert ordering.cell(left, 3, "a", ["a"]).first()[0] == 6


def test_order_statistics_of_integers_beyond_doubles(spark):
    rows = [(2**60 + i, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "a long, b double")
    assert ordering.order_statistics(df, ["a", "b"], {"a": [4, 5], "b": [3]}) == {"a": [2**60 + 4, 2**60 + 5], "b": [3.0]}
    assert ordering.order_statistics(df, ["a"], {"a": [4]}, window_rows=2)["a"] == [2**60 + 4]


def test_mode_fill_gives_means_of_integers(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (None, "x")], "a int, t string")
    plan = impute.learn_fill(df, {"string": "mode", "int": "median", "double": "median"})
    assert sorted(map(tuple, plan.apply(df).collect())) == [(1.0, "x"), (1.5, "x"), (2.0, "x")]


def test_columns_without_values_have_no_median(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert impute.approximate_medians(df, ["a", "b"]).keys() == {"b"}
    assert impute.approximate_medians(df, ["a"]) == {}


def test_null_is_a_hot_key_too(spark):
    df = spark.createDataFrame([(None, i) for i in range(300)] + [(1, 5)], "k int, v int")
    listed = sampling.values_per_key(df, "k", "v", chunk_rows=50).collect()
    assert max(len(r["values"]) for r in listed) <= 60
    assert sorted(v for r in listed for v in r["values"]) == sorted([*range(300), 5])


def test_bad_dates_and_times_are_null(spark):
    df = spark.createDataFrame([("",), ("soon",), ("1970-01-03",), ("1970-01-02 05:06:07",)], "t string")
    assert [r[0] for r in df.select(text.epoch_days("t")).collect()] == [None, None, 2.0, 1.0]
    clock = spark.createDataFrame([("99:99:99",), ("23:59:59",), ("7:00:00",)], "t string")
    assert [r[0] for r in clock.select(timeofday.seconds_of_day("t")).collect()] == [None, 86399, 25200]


def test_node_statistics_count_every_label(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "z"), (2, None)], "g int, y string")
    rows = {r.g: r for r in profile.node_statistics(df, "g", "y").collect()}
    assert (rows[1].n, rows[1].pure, rows[1].majority) == (3, False, "a")
    assert abs(rows[1].impurity - 1.584962500721156) < 1e-12
    assert (rows[2].n, rows[2].pure, rows[2].impurity) == (1, True, 0.0)
    gini = profile.node_statistics(df, "g", "y", "gini").filter("g = 1").first()
    assert abs(gini.impurity - 2 / 3) < 1e-12


def test_decimals_are_numbers(spark):
    df = spark.range(100).select(F.col("id").cast("decimal(10,2)").alias("a"))
    assert profile.feature_kinds(df) == {"a": "continuous"}


def test_row_numbers_of_shuffled_rows(spark):
    df = spark.range(500).repartition(7).groupBy("id").count()
    numbered = ordering.row_index(df)
    assert sorted(r.row_index for r in numbered.collect()) == list(range(1, 501))


def test_values_per_key_chunks_do_not_show_the_layout(spark):
    rows = [(None if i % 5 == 0 else "hot", i * 7 % 400) for i in range(400)] + [("cold", 1), ("cold", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    found = []
    for parts in (1, 5):
        listed = sampling.values_per_key(df.repartition(parts), "k", "v", chunk_rows=50).collect()
        found.append({(r.k, r.chunk): r["values"] for r in listed})
    assert found[0] == found[1] and max(map(len, found[0].values())) == 50
    for key in (None, "hot"):
        whole = [v for (k, _), some in sorted(found[0].items(), key=lambda c: (str(c[0][0]), c[0][1])) if k == key for v in some]
        assert whole == sorted(v for k, v in rows if k == key)
    assert found[0]["cold", 0] == [1] and found[0]["none", 0] == []


def test_row_numbers_of_files_do_not_depend_on_splits(spark, tmp_path):
    for i, n in enumerate([300, 7, 120]):
        spark.range(1000 * i, 1000 * i + n).coalesce(1).write.parquet(str(tmp_path / "t" / f"part={i}"))
    df = spark.read.parquet(str(tmp_path / "t")).select("id")
    wanted = {v: n + 1 for n, v in enumerate([*range(300), *range(1000, 1007), *range(2000, 2120)])}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("134217728", "700"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert {r.id: r.row_index for r in ordering.row_index(df).collect()} == wanted
            even = ordering.row_index(df.filter("id % 2 = 0"), name="n")
            assert {r.id: r.n for r in even.collect()} == {v: n + 1 for n, v in enumerate(v for v in wanted if v % 2 == 0)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    again = ordering.zip_rows(df, df.withColumnRenamed("id", "other"))
    assert again.filter("id <> other").isEmpty() and again.count() == len(wanted)
    assert ordering.row_index(df.limit(0)).count() == 0
    assert ordering.row_index(df.orderBy(F.desc("id"))).filter("row_index = 1").first().id == 2119


def test_hot_values_that_were_not_learned(spark, monkeypatch):
    monkeypatch.setattr(encode, "DICTIONARY_HEAD", 2)
    monkeypatch.setattr(encode, "HOT_SHARE", 0.05)
    learned = spark.createDataFrame([(f"v{i % 40}",) for i in range(400)], "t string")
    codes = encode.learn_codes(learned, small=0)
    rows = [("new",)] * 900 + [("v7",)] * 300 + [(f"v{i % 45}",) for i in range(90)] + [(None,)] * 200
    df = spark.createDataFrame(rows, "t string")
    hot = encode._hot_values(df, ["t"])["t"]
    assert {"new", "v7"} <= set(hot) and len(hot) <= 20
    ranked = {v: float(i) for i, v in enumerate(sorted(f"v{i}" for i in range(40)))}
    got = codes.apply(df, keep=True).collect()
    assert len(got) == len(rows) and all(r.t_index == ranked.get(r.t, 40.0) for r in got)
    assert codes.apply(df.limit(0)).count() == 0


def test_heavy_middles_are_settled_by_counts(spark, monkeypatch):
    df = spark.range(3000).selectExpr("cast(id % 3 as int) a", "IF(id % 5 = 0, 2.5D, -0.0D) b", "cast(id as double) c", "id % 2 + 1152921504606846976 d")
    listed = []
    explode = ordering.F.array
    monkeypatch.setattr(ordering.F, "array", lambda *entries: listed.append(len(entries)) or explode(*entries))
    values = impute.learn_fill(df, {"int": "median_lower", "double": "median_lower"}).values
    assert values["a"] == 1 and values["b"] == 0.0 and values["c"] == 1499.0 and values["d"] == 2**60
    # Only columns without a heavy middle are counted by value.
    assert listed[-1] <= 2


def test_heavy_middle_and_conditions(spark):
    df = spark.range(100).selectExpr("IF(id < 80, 7D, id) a")
    sketch = ordering.MiddleSketch({"a": 100}, {"a": (7.0, 7.0)})
    conditions = {"high": ordering.F.col("a") > 90, "none": ordering.F.col("a") < 0}
    assert ordering.order_statistics_and_counts(df, ["a"], conditions, sketch=sketch) == ({"a": [7.0, 7.0]}, {"high": 9, "none": 0})
    wrong = ordering.MiddleSketch({"a": 100}, {"a": (81.0, 81.0)})
    assert ordering.order_statistics_and_counts(df, ["a"], conditions, sketch=wrong) == ({"a": [7.0, 7.0]}, {"high": 9, "none": 0})
