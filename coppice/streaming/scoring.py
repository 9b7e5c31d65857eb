"""Row-wise steps on a stream of files: clean, fill, engineer, predict.

The steps are stateless column expressions, so the same functions serve batch and
stream; no watermark or state is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from coppice.operators.impute import FillPlan
from coppice.operators.score import predict
from coppice.operators.treemodel import TreeModel
from coppice.plans.flow import clean_lists, engineer
from coppice.session import scratch_path


def read_csv_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Headered CSV files as they arrive in a folder."""
    return (
        spark.readStream.option("header", True).option("escape", '"').schema(schema).csv(folder)
    )


def score_stream(
    rows: DataFrame, fill: FillPlan, model: TreeModel, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw rows to engineered columns and a prediction; ``keep`` carries the row's key along."""
    return predict(engineer(fill.apply(clean_lists(rows)), keep=keep), model)


def write_stream(scored: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append scored rows to a parquet folder, each input file once; ends when all is read."""
    place = checkpoint or scratch_path(scored.sparkSession, "stream")
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .start()
    )
