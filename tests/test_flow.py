import os

from pyspark.sql import functions as F

from coppice.operators import sampling, vectortree
from coppice.operators.score import predict
from coppice.operators.tree import train_tree
from coppice.plans import flow
from coppice.plans.schemas import ENGINEERED_COLUMNS, RAW_COLUMNS, TIME_COLUMNS, VECTOR_COLUMNS
from coppice.plans.wide import wide_table
from coppice.session import write_scratch
from tests.conftest import DATA


def test_column_lists():
    assert len(RAW_COLUMNS) == 73 and RAW_COLUMNS[58] == "primary_tags" and RAW_COLUMNS[69] == "location_number_obj"
    assert len(ENGINEERED_COLUMNS) == 41 and len(VECTOR_COLUMNS) == 41 and len(TIME_COLUMNS) == 28
    assert RAW_COLUMNS[30:34] == [
        "sunday_from_time1", "sunday_to_time1", "sunday_from_time2", "sunday_to_time2"
    ]


def test_unlabelled_rows_go_through_a_learned_flow(spark):
    """Fill values, codes and tree come from the training rows; test rows have no target."""
    wide = write_scratch(flow.clean_lists(wide_table(spark, DATA)), "wide")
    train = wide.filter(F.col("id") < 60)
    test = wide.filter(F.col("id") >= 60).drop("target").withColumn("gender", F.lit("Unseen"))
    fill = flow.learn_missing(train)
    shaped = flow.engineer(fill.apply(test))
    assert shaped.columns == ENGINEERED_COLUMNS[:-1]
    model = train_tree(
        flow.engineer(fill.apply(train)), ["latitude_x", "longitude_y", "gender"], "target", max_depth=3
    )
    scored = predict(shaped, model)
    assert scored.count() == test.count()
    assert scored.filter("prediction IS NULL").isEmpty()


def test_binned_tree_is_close_to_the_exhaustive_one(spark):
    wide = write_scratch(wide_table(spark, DATA), "wide")
    split = sampling.tag_split(F.col("`CID X LOC_NUM X VENDOR`"))
    exact = {r["split"]: r["accuracy"] for r in flow.run_flow(wide, split, max_depth=3).summary().collect()}
    binned = {r["split"]: r["accuracy"] for r in flow.run_vector_flow(wide, split, max_depth=3).summary().collect()}
    for part in ("Train", "Test"):
        assert exact[part] > 0.8
        assert abs(exact[part] - binned[part]) < 0.08


def test_stored_rows_of_a_flow_are_deleted(spark):
    wide = write_scratch(wide_table(spark, DATA), "wide")
    result = flow.run_flow(wide, sampling.tag_split(F.col("`CID X LOC_NUM X VENDOR`")), max_depth=1)
    expected = {r["split"]: r["n_rows"] for r in result.summary().collect()}
    assert os.path.isdir(result.stored.path)
    kept = result.kept_summary()
    assert not os.path.exists(result.stored.path)
    assert {r["split"]: r["n_rows"] for r in kept.collect()} == expected
    loose = flow.run_flow(wide, sampling.tag_split(F.col("`CID X LOC_NUM X VENDOR`")), max_depth=1, store=False)
    assert loose.stored is None and {r["split"]: r["n_rows"] for r in loose.kept_summary().collect()} == expected


def test_vector_tree_keeps_input_columns(spark, table):
    df = table("lineitem").withColumn("y", (F.col("l_quantity") > 20).cast("int"))
    model = vectortree.fit_vector_tree(df, ["l_quantity", "l_tax"], "y", max_depth=2)
    scored = vectortree.predict_vector(df, model, ["l_quantity", "l_tax"])
    assert scored.columns == [*df.columns, "prediction"]
    assert vectortree.vector_accuracy(scored, label="y") > 0.95


def test_last_fill_values_of_the_vector_flow_read_stored_rows(spark, monkeypatch):
    read = []
    learn = flow.learn_fill
    monkeypatch.setattr(flow, "learn_fill", lambda df, *args, **kwargs: read.append(df.inputFiles()) or learn(df, *args, **kwargs))
    result = flow.run_vector_flow(wide_table(spark, DATA), sampling.tag_split(F.col("`CID X LOC_NUM X VENDOR`")), max_depth=1)
    assert read[-1] and all(result.stored.path in f for f in read[-1])
    result.drop()
