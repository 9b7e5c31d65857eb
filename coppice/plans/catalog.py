"""Queries over the given tables, one or more per operator.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. All read whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.functions import numeric, text, timeofday
from coppice.operators import columns, encode, impute, nodetable, ordering, profile, sampling, score, vectortree
from coppice.operators.growth import grow_nodes
from coppice.operators.tree import train_tree, train_trees
from coppice.operators.treemodel import TreeModel
from coppice.plans import flow
from coppice.plans.schemas import RAW_COLUMNS, TIME_COLUMNS, VECTOR_COLUMNS, WEEKDAYS, raw_schema
from coppice.plans.wide import wide_table
from coppice.session import ScratchTable, scratch_path, write_scratch
from coppice.sources import readers, writers
from coppice.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = "CID X LOC_NUM X VENDOR"
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
LINE_LABEL = "l_returnflag"
TREE_DEPTH = 5


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with missing cells (the given tables have none)."""
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END").alias("o_custkey"),
        F.expr("CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE o_orderpriority END").alias("o_orderpriority"),
        F.expr("CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderstatus END").alias("o_orderstatus"),
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN cast('NaN' as double) "
               "ELSE o_totalprice END").alias("o_totalprice"),
    )


def gappy_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr("CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END").alias("p_size"),
        F.expr("CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END").alias("p_retailprice"),
    )


def near_share(df: DataFrame, hit: F.Column, share: float) -> DataFrame:
    """Number of rows, and whether a random draw hit about the expected share of them."""
    n, hits = F.count(F.lit(1)), F.count_if(hit)
    error = 6 * F.sqrt(F.lit(share * (1 - share)) / n)
    return df.agg(n.alias("n_rows"), (F.abs(hits / n - share) <= error).alias("near"))


def key_column() -> F.Column:
    return columns.col(KEY).alias("row_key")


# Sources and sinks ----------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    """Headered CSV written, then read through a glob; fields hold commas and quotes."""
    df = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.concat("o_orderstatus", F.lit(', "'), "o_orderpriority", F.lit('"')).alias("remark"),
    )
    path = scratch_path(spark, "csv")
    writers.write_csv(df, path)
    return readers.read_csv(spark, f"{path}/part*.csv", df.schema)


@query
def csv_positional(spark, sf_dir):
    """Fields by position; header rows anywhere are found by content."""
    df = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = scratch_path(spark, "positional")
    writers.write_csv(df, path)
    read = readers.read_positional(spark, path, ["key", "name", "segment"], "name", "c_name")
    return read.select(F.col("key").cast("bigint"), "name", "segment")


@query
def plain_lines(spark, sf_dir):
    """Lines cut at every comma; headers among them and short ones dropped."""
    rows = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name", F.col("s_nationkey").cast("string").alias("s_nationkey")
    )
    header = rows.filter("s_suppkey % 50 = 1").select(F.lit("customer_id").alias("s_suppkey"), F.lit("name").alias("s_name"), F.lit("nation").alias("s_nationkey"))
    path = scratch_path(spark, "lines")
    writers.write_lines(rows.union(header), path, "s_suppkey", "s_name", "s_nationkey")
    writers.write_lines(rows, f"{path}-short", "s_suppkey")
    lines = readers.filter_min_fields(readers.read_lines(spark, [path, f"{path}-short"]), ",", 2)
    cut = readers.split_lines(lines, ["s_suppkey", "s_name", "s_nationkey"], header_token="customer_id")
    return cut.select(F.col("s_suppkey").cast("bigint"), "s_name", F.col("s_nationkey").cast("int"))


@query
def tag_union(spark, sf_dir):
    """Two tables stacked, each row tagged by origin."""
    customer = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey as key", "c_name as name", "c_acctbal as balance"
    )
    supplier = load(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as key", "s_name as name", "s_acctbal as balance"
    )
    return readers.tagged_union({"train": customer, "test": supplier})


# Projections ------------------------------------------------------------------------


@query
def project_rename_drop(spark, sf_dir):
    df = load(spark, sf_dir, "orders")
    picked = columns.project(df, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    renamed = columns.rename(picked, {"o_totalprice": "price"})
    added = columns.with_columns(renamed, {"double_price": F.col("price") * 2})
    return columns.drop(added, "o_orderstatus")


@query
def cast_columns(spark, sf_dir):
    """Named columns to double; text that is no number becomes null."""
    df = load(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "event_type", "value"
    )
    return columns.cast_columns(df, ["user_id", "event_type"])


@query
def split_by_predicate(spark, sf_dir):
    """Rows on both sides of a continuous and of a categorical question."""
    df = load(spark, sf_dir, "lineitem")
    below = columns.split_question(F.col("l_quantity"), 25.0, continuous=True)
    equal = columns.split_question(F.col("l_linestatus"), "F", continuous=False)
    return df.agg(
        F.count_if(below).alias("below"), F.count_if(~below).alias("above"),
        F.count_if(equal).alias("equal"), F.count_if(~equal).alias("other"),
    )


# Profiles -----------------------------------------------------------------------------


@query
def null_counts(spark, sf_dir):
    return profile.missing_counts(gappy_orders(spark, sf_dir))


@query
def null_total(spark, sf_dir):
    return profile.missing_total(gappy_orders(spark, sf_dir))


@query
def row_width_hist(spark, sf_dir):
    return profile.row_width_histogram(load(spark, sf_dir, "documents"), "text")


@query
def sum_per_key(spark, sf_dir):
    return profile.sum_by(load(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")


@query
def label_counts(spark, sf_dir):
    return profile.count_by(load(spark, sf_dir, "lineitem"), LINE_LABEL)


@query
def feature_types(spark, sf_dir):
    return profile.feature_kind_table(
        load(spark, sf_dir, "lineitem"),
        features=[*LINE_FEATURES, "l_linenumber", "l_suppkey"],
    )


@query
def candidate_splits(spark, sf_dir):
    return profile.candidate_splits(load(spark, sf_dir, "lineitem"), LINE_FEATURES)


@query
def sorted_values(spark, sf_dir):
    return ordering.sorted_distinct(load(spark, sf_dir, "part"), "p_name")


@query
def preview(spark, sf_dir):
    """First rows by key."""
    return ordering.first_rows(load(spark, sf_dir, "customer").orderBy("c_custkey"), 10)


@query
def cell_lookup(spark, sf_dir):
    return ordering.cell(load(spark, sf_dir, "customer"), 88, "c_mktsegment", ["c_custkey"])


@query
def node_stats(spark, sf_dir):
    """Purity, majority label and entropy per group."""
    stats = profile.node_statistics(load(spark, sf_dir, "lineitem"), "l_linestatus", LINE_LABEL)
    return stats.withColumn("impurity", F.round("impurity", 6))


# Missing values -------------------------------------------------------------------------


@query
def fill_constant(spark, sf_dir):
    wide = wide_table(spark, sf_dir).select(key_column(), *TIME_COLUMNS)
    return impute.fill_constant(wide, TIME_COLUMNS)


@query
def heavy_hitter_fill(spark, sf_dir):
    """Text columns get their value of at least 60 percent of rows, if there is one."""
    names = ["gender", "language", "location_type", "vendor_category_en", "vendor_tag"]
    wide = wide_table(spark, sf_dir).select(key_column(), *names)
    return impute.apply_fill(wide, impute.frequent_values(wide, names))


@query
def median_impute_approx(spark, sf_dir):
    """Sketched medians: how many cells they fill, and that their rank error is small."""
    df = gappy_part(spark, sf_dir)
    medians = impute.approximate_medians(df, ["p_size", "p_retailprice"])
    checks = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNull()).alias("filled"),
            (
                (F.count_if(F.col(c) < F.lit(v)) <= 0.505 * F.count(c))
                & (F.count_if(F.col(c) > F.lit(v)) <= 0.505 * F.count(c))
            ).alias("close"),
        )
        for c, v in medians.items()
    ]
    return df.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


@query
def median_impute_lower(spark, sf_dir):
    df = gappy_part(spark, sf_dir)
    medians = impute.exact_medians(df, ["p_size", "p_retailprice"], lower=True)
    return impute.apply_fill(df, medians)


@query
def median_impute_exact(spark, sf_dir):
    """Mean of the two middle values; integers become doubles first."""
    df = columns.cast_columns(gappy_part(spark, sf_dir), ["p_size"])
    return impute.apply_fill(df, impute.exact_medians(df, ["p_size", "p_retailprice"]))


@query
def median_impute_narrowed(spark, sf_dir):
    """The same on lineitem, with the interval search of very large tables."""
    df = load(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    medians = impute.exact_medians(df, names, window_rows=2000)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", *[F.lit(medians[c]).alias(c) for c in names]
    )


@query
def mode_impute(spark, sf_dir):
    df = gappy_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    return impute.apply_fill(df, impute.modes(df, ["o_custkey", "o_orderpriority", "o_orderstatus"]))


@query
def typed_fill_mode(spark, sf_dir):
    """Modes for text, means of the two middle values for numbers, which become doubles."""
    df = gappy_orders(spark, sf_dir)
    plan = impute.learn_fill(df, flow.MODE_FILL, skip=["o_orderkey"])
    return plan.apply(df)


@query
def split_features_label(spark, sf_dir):
    """Feature part and label part of the training rows, counted and summed apart."""
    train, _ = sampling.keyed_split(load(spark, sf_dir, "orders"), "o_orderkey", 0.7, 42)
    features, label = sampling.features_and_label(
        train.select("o_totalprice", "o_custkey", "o_orderstatus"), "o_orderstatus"
    )
    left = features.agg(F.count(F.lit(1)).alias("n_features"), F.sum("o_custkey").alias("custkeys"))
    right = label.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_label"))
    return right.crossJoin(left)  # one row on the left side


@query
def wide_fill(spark, sf_dir):
    """Every column of the raw table by type: constant, frequent text, lower median."""
    wide = flow.clean_lists(wide_table(spark, sf_dir))
    plan = flow.learn_missing(wide, flow.EXACT_FILL)
    return columns.rename(plan.apply(wide), {KEY: "row_key"})


# Scalar functions -------------------------------------------------------------------------


@query
def list_delim_replace(spark, sf_dir):
    names = ["vendor_tag", "vendor_tag_name"]
    wide = wide_table(spark, sf_dir).select(key_column(), *[text.list_delimiter(c).alias(c) for c in names])
    return wide.select("*", *[text.item_count(c).cast("bigint").alias(f"{c}_sum") for c in names])


@query
def json_tag_extract(spark, sf_dir):
    """Tag values from plain and from doubled quotes, and the tag without quotes."""
    doubled = F.concat(F.lit('"'), F.replace("primary_tags", F.lit('"'), F.lit('""')), F.lit('"'))
    return wide_table(spark, sf_dir).select(
        key_column(),
        text.tag_value("primary_tags").alias("tag"),
        text.tag_value(doubled).alias("tag_of_doubled"),
        text.strip_tag_quotes("primary_tags").alias("stripped"),
    )


@query
def json_props_extract(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        text.strip_tag_quotes("props").alias("stripped"),
    )


@query
def line_cleanup(spark, sf_dir):
    line = F.concat(
        F.lit('  [["'), F.col("o_orderkey").cast("string"), F.lit('", "'), "o_orderpriority",
        F.lit("\", 'x' ]] "),
    )
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", text.strip_list_marks(line).alias("bare"), text.strip_quotes(line).alias("unquoted")
    )


@query
def date_part_text(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return load(spark, sf_dir, "events").select(
        "event_id",
        text.date_text(stamp).alias("day"),
        timeofday.time_text("ts").alias("clock"),
        timeofday.seconds_of_day(stamp).alias("seconds"),
        text.epoch_days("ts").alias("days"),
        text.number_text("value").alias("value_text"),
    )


@query
def opening_hours(spark, sf_dir):
    """Hours per weekday with both kinds of rounding, and with closes after midnight."""
    wide = timeofday.add_weekday_seconds(wide_table(spark, sf_dir))
    wide = timeofday.add_weekday_seconds(wide, "_wrapped_seconds", wrap_midnight=True)
    hours = {
        **timeofday.weekday_hours("_2", digits=2),
        **timeofday.weekday_hours("_1", digits=1, binary=True),
        **timeofday.weekday_hours("_wrapped", digits=2, seconds_suffix="_wrapped_seconds"),
    }
    return wide.select(key_column(), *[h.alias(n) for n, h in hours.items()])


@query
def rounding_modes(spark, sf_dir):
    """Half up against exact half even on twentieths, and base-2 logarithms."""
    x = F.col("l_orderkey") / F.lit(20.0)
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        numeric.round_exact_even(x, 1).alias("even"),
        numeric.round_half_up(x, 1).alias("half_up"),
        F.round(F.log2(F.col("l_quantity")), 6).alias("log2"),
    )


# Samples and order -----------------------------------------------------------------------


@query
def hash_split_counts(spark, sf_dir):
    tagged = load(spark, sf_dir, "orders").withColumn("split", sampling.tag_split("o_orderkey", 7))
    return profile.count_by(tagged, "split", "n_rows")


@query
def hash_split_train(spark, sf_dir):
    tagged = load(spark, sf_dir, "orders").withColumn("split", sampling.tag_split("o_orderkey", 7))
    return sampling.with_tag(tagged, "Train").select("o_orderkey")


@query
def keyed_split(spark, sf_dir):
    """70 percent of rows by key, features and label apart."""
    train, _ = sampling.keyed_split(load(spark, sf_dir, "orders"), "o_orderkey", 0.7, 42)
    return train.select("o_orderkey", "o_orderstatus")


@query
def random_split(spark, sf_dir):
    """Spark's random split: all rows, and whether the train share is near 70 percent."""
    parts = sampling.random_split(load(spark, sf_dir, "orders"))
    both = readers.tagged_union(dict(zip(["train", "test"], parts)))
    return near_share(both, F.col("split") == "train", 0.7)


@query
def random_tags(spark, sf_dir):
    """Two rows in eleven by a random draw per row."""
    tagged = load(spark, sf_dir, "orders").withColumn("split", sampling.tag_split_random(3))
    return near_share(tagged, F.col("split") == "Test", 2 / 11)


@query
def exact_sample(spark, sf_dir):
    """A quarter of the customers, exactly."""
    return sampling.exact_sample(load(spark, sf_dir, "customer"), 0.25, "c_custkey", 5)[0]


@query
def exact_sample_rest(spark, sf_dir):
    return sampling.exact_sample(load(spark, sf_dir, "customer"), 0.25, "c_custkey", 5)[1]


@query
def shuffle_positions(spark, sf_dir):
    shuffled = sampling.shuffle_rows(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 9)
    return shuffled.select("o_orderkey", "position")


@query
def shuffle_rows(spark, sf_dir):
    return sampling.shuffle_rows_random(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 1)


@query
def synth_labels(spark, sf_dir):
    label = sampling.synthetic_label(0.1, key="o_orderkey", seed=3)
    return load(spark, sf_dir, "orders").select("o_orderkey", label.alias("target"))


@query
def synth_labels_random(spark, sf_dir):
    """Labels by random draw, counted per value."""
    labelled = load(spark, sf_dir, "orders").withColumn("target", sampling.synthetic_label(0.1, seed=3))
    return near_share(labelled, F.col("target") == 1, 0.1)


@query
def positional_zip(spark, sf_dir):
    """n-th order with n-th event."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    events = load(spark, sf_dir, "events").select("event_id", "value", "ts")
    zipped = ordering.zip_rows(
        orders, events, [F.desc("o_totalprice"), "o_orderkey"], ["value", "event_id"]
    )
    return zipped.select("o_orderkey", "event_id")


@query
def file_order_zip(spark, sf_dir):
    """Rows of one file joined with made-up labels by position in the file."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    n_rows = orders.count()
    labels = readers.generated_table(
        spark, n_rows, {"target": sampling.synthetic_label(0.1, key="id", seed=4)}
    )
    return profile.count_by(ordering.zip_rows(orders, labels), "target", "n_rows")


@query
def collect_per_key(spark, sf_dir):
    listed = sampling.values_per_key(load(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")
    joined = F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
    return listed.select("o_custkey", "chunk", joined.alias("order_keys"))


@query
def collect_per_hot_key(spark, sf_dir):
    """Lists of keys with many rows, cut into chunks of the sorted values."""
    listed = sampling.values_per_key(
        load(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice", chunk_rows=500
    )
    return listed.select(
        "l_returnflag", "chunk", F.size("values").cast("bigint").alias("n_values"),
        F.array_min("values").alias("least"), F.array_max("values").alias("largest"),
    )


# Encoding ------------------------------------------------------------------------------------


@query
def index_by_frequency(spark, sf_dir):
    df = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return encode.learn_codes(df).apply(df)


@query
def index_alphabetic(spark, sf_dir):
    df = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return encode.learn_codes(df, order="alphabet").apply(df)


@query
def index_many_values(spark, sf_dir):
    """Codes from dictionaries kept as tables."""
    df = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    codes = encode.learn_codes(df, small=0)
    return codes.apply(df, keep=True).drop("c_name")


@query
def index_unseen(spark, sf_dir):
    """Codes learned on one part; values it lacks get one code more."""
    df = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    codes = encode.learn_codes(df.filter("p_brand < 'Brand#2'"))
    return codes.apply(df)


@query
def assemble_features(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
    vectors = encode.assemble(df, names)
    parts = vectors.select("l_orderkey", vector_to_array("features").alias("v"))
    return parts.select("l_orderkey", *[F.get("v", F.lit(i)).alias(n) for i, n in enumerate(names)])


@query
def wide_features(spark, sf_dir):
    """The engineered columns of the raw table."""
    wide = flow.clean_lists(wide_table(spark, sf_dir)).withColumn("row_key", columns.col(KEY))
    return flow.engineer(wide, keep=["row_key"])


@query
def wide_numeric(spark, sf_dir):
    """The raw table as numbers: hours, counts, days, and codes for text."""
    wide = flow.clean_lists(wide_table(spark, sf_dir))
    shaped = flow.numeric_features(wide).select(key_column(), *VECTOR_COLUMNS)
    types = dict(shaped.dtypes)
    names = [c for c in VECTOR_COLUMNS if types[c] == "string"]
    coded = encode.learn_codes(shaped, names).apply(shaped)
    return columns.cast_columns(coded, VECTOR_COLUMNS)


# Trees -----------------------------------------------------------------------------------------


def node_columns(model: TreeModel, spark: SparkSession) -> DataFrame:
    return model.to_table(spark).select(
        F.col("tree_id").cast("int"), "path", "depth", "feature", "op", "value_num", "value_str",
        "label", "n",
    )


def line_tree(spark, sf_dir, **options) -> tuple[DataFrame, TreeModel]:
    df = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", *LINE_FEATURES, LINE_LABEL)
    options = {"max_depth": TREE_DEPTH, "collapse": False, **options}
    return df, train_tree(df, LINE_FEATURES, LINE_LABEL, **options)


def shard_model(spark, sf_dir) -> tuple[DataFrame, TreeModel]:
    df = load(spark, sf_dir, "lineitem").withColumn("shard", F.expr("l_suppkey % 3"))
    model = train_trees(
        df, LINE_FEATURES, LINE_LABEL, shard="shard", max_depth=TREE_DEPTH, collapse=False
    )
    return df, model


@query
def best_root_split(spark, sf_dir):
    """The best single question about the label of lineitem."""
    _, model = line_tree(spark, sf_dir, max_depth=1)
    return node_columns(model, spark).filter("path = ''").select("feature", "op", "value_num", "value_str", "n")


@query
def tree_nodes(spark, sf_dir):
    return node_columns(line_tree(spark, sf_dir)[1], spark)


@query
def tree_nodes_bucketed(spark, sf_dir):
    """The same tree by the search for features with many values."""
    options = dict(direct_rows=0, direct_values=32, buckets=64)
    return node_columns(line_tree(spark, sf_dir, **options)[1], spark)


@query
def tree_nodes_gini(spark, sf_dir):
    return node_columns(line_tree(spark, sf_dir, criterion="gini")[1], spark)


@query
def shard_trees(spark, sf_dir):
    """One tree per shard, in shared passes."""
    return node_columns(shard_model(spark, sf_dir)[1], spark)


@query
def tree_stored(spark, sf_dir):
    """The node table written, read back, merged where answers are equal, and rendered."""
    _, model = line_tree(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.save(spark, path)
    kept = nodetable.collapsed(spark.read.parquet(path)).df
    return nodetable.with_texts(kept).df.select("path", "depth", "question", "label", "n", "text")


@query
def tree_score(spark, sf_dir):
    """Rows per label and prediction."""
    df, model = line_tree(spark, sf_dir)
    return score.predict(df, model).groupBy(LINE_LABEL, "prediction").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def tree_score_each(spark, sf_dir):
    """Every row with the tree of every shard."""
    df, model = shard_model(spark, sf_dir)
    scored = score.predict_each(df, model)
    return scored.groupBy("tree_id", LINE_LABEL, "prediction").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def tree_accuracy(spark, sf_dir):
    """Accuracy of each shard's tree on all rows."""
    df, model = shard_model(spark, sf_dir)
    return score.tree_accuracies(df, model, LINE_LABEL).select(
        "tree_id", F.round("accuracy", 8).alias("accuracy")
    )


@query
def prediction_sink(spark, sf_dir):
    """Rows and predictions written as CSV and read back."""
    df, model = line_tree(spark, sf_dir)
    path = scratch_path(spark, "predictions")
    writers.write_predictions(
        df.select("l_orderkey", *LINE_FEATURES), model.prediction(df), path, "target", "csv"
    )
    read = readers.read_csv(spark, path)
    return read.groupBy("target").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("keys"))


#: Features of few values, so that the bins of MLlib hold one value each.
BINNED_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linestatus"]
#: Features of at most 32 values, for MLlib's own number of bins.
COARSE_FEATURES = ["l_linenumber", "quantity_pair", "l_discount", "l_tax", "l_linestatus"]


def line_vectors(spark, sf_dir, features=BINNED_FEATURES) -> tuple[DataFrame, DataFrame]:
    """Train and test part of lineitem as numbers, by key."""
    lines = load(spark, sf_dir, "lineitem").withColumn("quantity_pair", F.ceil(F.col("l_quantity") / 2).cast("double"))
    part = sampling.tag_keyed(F.concat_ws("-", "l_orderkey", "l_linenumber"), 0.7, 42)
    codes = encode.learn_codes(lines.select(*features, LINE_LABEL))
    stored = write_scratch(codes.apply(lines.select(part.alias("part"), *features, LINE_LABEL)), "line-vectors")
    return stored.filter("part = 'train'").drop("part"), stored.filter("part = 'test'").drop("part")


def label_pairs(scored: DataFrame) -> DataFrame:
    """Rows of the holdout for each label and prediction."""
    return scored.groupBy(LINE_LABEL, "prediction").agg(F.count(F.lit(1)).alias("n_rows"))


def vector_holdout(spark, sf_dir, features, criterion: str, depth: int, max_bins: int) -> DataFrame:
    train, test = line_vectors(spark, sf_dir, features)
    model = vectortree.fit_vector_tree(train, features, LINE_LABEL, criterion, depth, max_bins)
    return label_pairs(vectortree.predict_vector(test, model, features))


@query
def vector_tree(spark, sf_dir):
    """Binned entropy tree of depth 4 on the holdout."""
    return vector_holdout(spark, sf_dir, BINNED_FEATURES, "entropy", 4, 256)


@query
def vector_tree_default(spark, sf_dir):
    """Binned entropy tree with MLlib's own depth and number of bins."""
    return vector_holdout(spark, sf_dir, COARSE_FEATURES, "entropy", 5, 32)


@query
def vector_tree_gini(spark, sf_dir):
    """Gini tree without a depth limit on the holdout."""
    train, test = line_vectors(spark, sf_dir)
    nodes = grow_nodes(train, BINNED_FEATURES, LINE_LABEL, "gini", category_values=0)
    return label_pairs(nodetable.predict_by_nodes(test, nodes.df, label_type="double"))


@query
def impurity_compare(spark, sf_dir):
    """Accuracy on the holdout of a gini tree without limit and of entropy at depth 3."""
    train, test = line_vectors(spark, sf_dir)
    settings = [("gini", None), ("entropy", 3)]
    compared = vectortree.compare_criteria(train, test, BINNED_FEATURES, LINE_LABEL, settings)
    return compared.withColumn("accuracy", F.round("accuracy", 8))


# The whole job -------------------------------------------------------------------------------------


@query
def flagship(spark, sf_dir):
    """Clean, fill, engineer, train on the training rows, score all: accuracy per part."""
    result = flow.run_flow(
        wide_table(spark, sf_dir), sampling.tag_split(columns.col(KEY), 1), flow.EXACT_FILL, max_depth=TREE_DEPTH
    )
    return result.kept_summary().withColumn("accuracy", F.round("accuracy", 8))


@query
def vector_flow(spark, sf_dir):
    """The same job with codes, vectors and the binned tree."""
    result = flow.run_vector_flow(
        wide_table(spark, sf_dir), sampling.tag_split(columns.col(KEY), 1), flow.FAST_FILL
    )
    return result.kept_summary()


@query
def stream_scoring(spark, sf_dir):
    """Raw rows scored as a stream of CSV files by a tree trained in batch."""
    wide = wide_table(spark, sf_dir)
    raw, out = scratch_path(spark, "raw-csv"), scratch_path(spark, "scored")
    writers.write_csv(wide, raw)
    fill = flow.learn_missing(flow.clean_lists(wide), flow.EXACT_FILL)
    engineered = ScratchTable(flow.engineer(fill.apply(flow.clean_lists(wide))), "engineered")
    features = [c for c in engineered.df.columns if c != flow.LABEL]
    model = train_tree(engineered.df, features, flow.LABEL, max_depth=TREE_DEPTH)
    engineered.drop()
    stream = scoring.read_csv_stream(spark, raw, raw_schema())
    scored = scoring.score_stream(stream, fill, model, keep=[KEY])
    scoring.write_stream(scored, out).awaitTermination()
    return spark.read.parquet(out).groupBy("target", "prediction").agg(F.count(columns.col(KEY)).alias("n_rows"))


__all__ = ["QUERIES", "RAW_COLUMNS", "WEEKDAYS"]
