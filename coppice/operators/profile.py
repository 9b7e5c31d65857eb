"""Schema and data profiles: one aggregate over all columns, never a job per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coppice.functions.numeric import impurity, missing_to_null, total
from coppice.operators.columns import col

# Fixed value: up to this many distinct values a number counts as a category.
CATEGORY_VALUES = 15

_TYPE_CLASSES = {
    "string": "string", "double": "double", "float": "double", "int": "int", "bigint": "int",
    "smallint": "int", "tinyint": "int",
}


def type_class(data_type: str) -> str:
    """``string``, ``double``, ``int`` or the type itself."""
    return _TYPE_CLASSES.get(data_type, data_type)


def is_number(data_type: str) -> bool:
    """Whether values of the type are compared as numbers; decimals are, too."""
    return type_class(data_type) in ("int", "double") or data_type.startswith("decimal")


def columns_by_type(df: DataFrame) -> dict[str, list[str]]:
    """Column names grouped by type class (schema only, no job)."""
    groups: dict[str, list[str]] = {}
    for name, data_type in df.dtypes:
        groups.setdefault(type_class(data_type), []).append(name)
    return groups


def columns_of_type(df: DataFrame, wanted: str) -> list[str]:
    return columns_by_type(df).get(wanted, [])


def column_type(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]


def row_counts(df: DataFrame) -> tuple[int, int]:
    """Rows, and about how many different ones, in one pass without a shuffle of rows."""
    found = df.agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*[col(c) for c in df.columns])).alias("different")
    ).first()
    return found["rows"], found["different"]


def long_form(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """A one-row table turned into ``(name, value)`` rows."""
    entries = [F.struct(F.lit(c).alias(name), col(c).alias(value)) for c in columns]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def is_missing(c: Column, data_type: str) -> Column:
    return c.isNull() | F.isnan(c) if data_type in ("double", "float") else c.isNull()


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, missing)`` for each column; NaN counts as missing."""
    names = list(columns or df.columns)
    types = dict(df.dtypes)
    counted = df.agg(*[F.count_if(is_missing(col(c), types[c])).alias(c) for c in names])
    return long_form(counted, names, "column_name", "missing")


def missing_in(df: DataFrame, column: str) -> int:
    """Missing cells of one column, reading that column only."""
    return missing_counts(df, [column]).first()["missing"]


def missing_total(df: DataFrame) -> DataFrame:
    """Missing cells of the table as ``(n_rows, missing)``."""
    types = dict(df.dtypes)
    per_row = total([is_missing(col(c), types[c]).cast("bigint") for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(per_row), F.lit(0)).alias("missing")
    )


def row_count(df: DataFrame) -> int:
    return df.count()


def row_width_histogram(lines: DataFrame, column: str = "value", delimiter: str = ",") -> DataFrame:
    """Rows per number of delimited fields."""
    width = F.size(F.split(col(column), "\\Q" + delimiter + "\\E", -1)).cast("bigint")
    return lines.groupBy(width.alias("width")).agg(F.count(F.lit(1)).alias("n_rows"))


def count_by(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, e.g. per label."""
    return df.groupBy(col(column)).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    return df.groupBy(col(key)).agg(F.sum(col(value)).alias(name))


def feature_cell(c: str, data_type: str) -> tuple[Column, Column]:
    """A feature's value as ``(num, str)``: one of them is null by type."""
    kind = type_class(data_type)
    if is_number(data_type):
        return missing_to_null(col(c), data_type).cast("double"), F.lit(None).cast("string")
    if kind in ("string", "boolean", "date"):
        return F.lit(None).cast("double"), col(c).cast("string")
    raise TypeError(f"feature {c} has type {data_type}: make it a number, date or text first")


def distinct_values(df: DataFrame, features: Sequence[str], threshold: int) -> dict[str, int]:
    """Distinct values per feature, missing counted as one more.

    Exact up to ``threshold``; above it only known to be above. A sketch of the
    default size has room for far more values than ``2 * threshold + 2`` before it
    could report that few, so it rules out most features in one pass without a
    shuffle; the rest are few-valued and counted exactly.
    """
    types = dict(df.dtypes)
    cells = {f: missing_to_null(col(f), types[f]) for f in features}
    sketched = df.agg(
        *[F.approx_count_distinct(cells[f]).alias(f"d{i}") for i, f in enumerate(features)],
        *[F.count_if(cells[f].isNull()).alias(f"m{i}") for i, f in enumerate(features)],
    ).first()
    estimate = {f: sketched[f"d{i}"] for i, f in enumerate(features)}
    has_missing = {f: sketched[f"m{i}"] > 0 for i, f in enumerate(features)}
    few = [f for f in features if estimate[f] <= 2 * threshold + 2]
    if few:
        exact = df.agg(*[F.count_distinct(cells[f]).alias(f"d{i}") for i, f in enumerate(few)]).first()
        estimate.update({f: exact[f"d{i}"] for i, f in enumerate(few)})
    return {f: estimate[f] + int(has_missing[f]) for f in features}


def feature_kinds(
    df: DataFrame, features: Sequence[str] | None = None, label: str | None = None,
    threshold: int = CATEGORY_VALUES,
) -> dict[str, str]:
    """``categorical`` for text and few-valued numbers, else ``continuous``."""
    names = [f for f in (features or df.columns) if f != label]
    types = dict(df.dtypes)
    numbers = [f for f in names if is_number(types[f])]
    counts = distinct_values(df, numbers, threshold) if numbers else {}
    return {
        f: "continuous" if counts.get(f, 0) > threshold else "categorical" for f in names
    }


def feature_kind_table(df: DataFrame, **options) -> DataFrame:
    """Feature kinds as a table ``(feature, kind)``."""
    kinds = feature_kinds(df, **options)
    entries = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.lit(k).alias("kind")) for f, k in kinds.items()]
    )
    return df.sparkSession.range(1).select(F.explode(entries).alias("e")).select("e.*")


def candidate_splits(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distinct observed values per feature as ``(feature, num, str, n)``."""
    types = dict(df.dtypes)
    entries = []
    for f in features:
        num, text = feature_cell(f, types[f])
        entries.append(F.struct(F.lit(f).alias("feature"), num.alias("num"), text.alias("str")))
    return (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .filter("num IS NOT NULL OR str IS NOT NULL")
        .groupBy("feature", "num", "str")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def node_statistics(
    df: DataFrame, group: str, label: str, criterion: str = "entropy"
) -> DataFrame:
    """Size, purity, majority label and impurity of the rows of each group.

    Any number of labels; rows without one are left out. Equal counts give the smallest
    label.
    """
    counted = (
        df.filter(col(label).isNotNull())
        .groupBy(col(group).alias("_group"), col(label).alias("_label"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    n, c = F.col("_n").cast("double"), F.col("_c").cast("double")
    if criterion == "entropy":
        # Over counts c of a sum n: log2(n) - sum(c * log2(c)) / n.
        term, found = F.sum(c * F.log2(c)), F.log2(n) - F.col("_term") / n
    else:
        term, found = F.sum(c * c), 1 - F.col("_term") / (n * n)
    summed = counted.groupBy("_group").agg(
        F.sum("_c").alias("_n"),
        F.count(F.lit(1)).alias("_kinds"),
        F.min(F.struct((-F.col("_c")).alias("negative"), "_label")).alias("_best"),
        term.alias("_term"),
    )
    return summed.select(
        F.col("_group").alias(group),
        F.col("_n").alias("n"),
        (F.col("_kinds") == 1).alias("pure"),
        F.col("_best._label").alias("majority"),
        F.greatest(found, F.lit(0.0)).alias("impurity"),
    )
