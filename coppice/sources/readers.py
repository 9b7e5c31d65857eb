"""Table sources: headered, positional and plain comma-split text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coppice.plans.schemas import text_schema


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    timestamps: bool = False,
) -> DataFrame:
    """Headered CSV from a file, a folder or a glob.

    Give a schema for large inputs: without one Spark reads the data twice. Quotes
    inside fields are doubled. Inference leaves dates and times as text unless
    ``timestamps`` is set, so that clean-up steps see what the file holds.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        return reader.schema(schema).csv(path)
    reader = reader.option("inferSchema", True)
    if not timestamps:
        # A pattern no value meets keeps time-like columns as text.
        never = "'never'yyyy"
        reader = reader.option("timestampFormat", never).option("timestampNTZFormat", never)
        reader = reader.option("preferDate", False)
    return reader.csv(path)


def read_positional(
    spark: SparkSession,
    path: str | list[str],
    names: list[str],
    header_column: str,
    header_text: str | None = None,
) -> DataFrame:
    """CSV whose fields are taken by position; header rows are found by content.

    A row is a header if field ``header_column`` holds ``header_text`` (by default its
    own name), wherever it stands: concatenated files have several.
    """
    rows = spark.read.option("escape", '"').schema(text_schema(names)).csv(path)
    value = F.col(f"`{header_column}`")
    return rows.filter(value.isNull() | (value != (header_text or header_column)))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines as column ``value``."""
    return spark.read.text(path)


def split_lines(
    lines: DataFrame, names: list[str], header_token: str | None = None, delimiter: str = ","
) -> DataFrame:
    """Cut lines at every delimiter, quoted or not, into text columns.

    Lines that hold ``header_token`` are headers and dropped.
    """
    stripped = lines.select(F.trim("value", F.lit(" \t\n\r\f\v")).alias("value"))
    if header_token is not None:
        stripped = stripped.filter(~F.contains("value", F.lit(header_token)))
    fields = F.split("value", "\\Q" + delimiter + "\\E", -1)
    return stripped.select(fields.alias("fields")).select(
        *[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )


def filter_min_fields(lines: DataFrame, delimiter: str, at_least: int) -> DataFrame:
    """Keep lines with at least this many delimited fields."""
    width = F.size(F.split("value", "\\Q" + delimiter + "\\E", -1))
    return lines.filter(width >= at_least)


def tagged_union(tables: dict[str, DataFrame], tag: str = "split") -> DataFrame:
    """Stack tables with equal columns and tag every row with its table's name."""
    parts = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def generated_table(spark: SparkSession, rows: int, columns: dict[str, Column]) -> DataFrame:
    """A table from row ids and expressions over ``id``, built by the executors."""
    return spark.range(rows).select(*[c.alias(name) for name, c in columns.items()])
