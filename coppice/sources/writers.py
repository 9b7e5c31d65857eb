"""Table sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Headered CSV, replacing what is there; quotes inside fields are doubled.

    ``single_file`` sends all rows through one task: for small results only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_predictions(
    df: DataFrame, prediction: Column, path: str, name: str = "target", form: str = "parquet"
) -> None:
    """Input rows plus their predicted label."""
    scored = df.withColumn(name, prediction)
    if form == "csv":
        write_csv(scored, path)
    else:
        scored.write.mode("overwrite").format(form).save(path)


def write_lines(df: DataFrame, path: str, *columns: str, delimiter: str = ",") -> None:
    """Rows as delimited text lines without header or quoting."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns or df.columns]
    df.select(F.concat_ws(delimiter, *texts).alias("value")).write.mode("overwrite").text(path)
