"""Column operators: select, drop, rename, cast, and the two-way row split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Column reference for names that hold blanks or dots."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[col(n) for n in names])


def drop(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))


def cast_columns(df: DataFrame, names: Iterable[str], data_type: str = "double") -> DataFrame:
    """Cast the named columns in one projection; text that is no number gives null."""
    wanted = set(names)
    return df.select(
        *[
            col(n).try_cast(data_type).alias(n) if n in wanted else col(n)
            for n in df.columns
        ]
    )


def split_question(feature: Column, value: object, continuous: bool) -> Column:
    """True on the "yes" side: at most ``value``, or equal to it. Missing is "no"."""
    answer = feature <= F.lit(value) if continuous else feature == F.lit(value)
    return F.coalesce(answer, F.lit(False))


def partition_rows(
    df: DataFrame, feature: str, value: object, continuous: bool
) -> tuple[DataFrame, DataFrame]:
    """Rows that answer the question with yes, and the others."""
    yes = split_question(col(feature), value, continuous)
    return df.filter(yes), df.filter(~yes)
