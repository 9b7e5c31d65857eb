"""Splits, samples, shuffles and made-up labels.

Keyed variants depend on a key and a seed only: they repeat on any cluster, on any
layout of the same rows, and need no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.functions.numeric import hash_fraction_bits, hash_unit
from coppice.operators.columns import col
from coppice.operators.ordering import first_by_hash, row_index

# A draw from 0..10 that is at most 1 marks a test row (2 in 11).
TEST_DRAWS = 11
TEST_AT_MOST = 1

BROADCAST_ROWS = 1_000_000


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    """Spark's own random split; repeats only for the same layout of the input."""
    return df.randomSplit(list(weights), seed)


def keyed_split(
    df: DataFrame, key: str, train_share: float = 0.7, seed: int | str = 42
) -> tuple[DataFrame, DataFrame]:
    """Random split by hash of a key."""
    in_train = hash_unit(col(key), seed) < F.lit(train_share)
    return df.filter(in_train), df.filter(~in_train)


def tag_keyed(key: Column | str, train_share: float = 0.7, seed: int | str = 42) -> Column:
    """``train`` or ``test``, as ``keyed_split`` parts the rows."""
    key = col(key) if isinstance(key, str) else key
    in_train = hash_unit(key, seed) < F.lit(train_share)
    return F.when(in_train, "train").when(~in_train, "test")


def tag_split(key: Column | str, seed: int | str = 0) -> Column:
    """``Test`` for two keys in eleven, ``Train`` for the others."""
    draw = F.pmod(hash_fraction_bits(key, seed), F.lit(TEST_DRAWS))
    return F.when(draw <= TEST_AT_MOST, "Test").otherwise("Train")


def tag_split_random(seed: int = 0) -> Column:
    """As ``tag_split``, from a row-wise random draw."""
    draw = F.floor(F.rand(seed) * TEST_DRAWS)
    return F.when(draw <= TEST_AT_MOST, "Test").otherwise("Train")


def with_tag(df: DataFrame, tag: str, column: str = "split") -> DataFrame:
    """Rows of one tag, without the tag."""
    return df.filter(col(column) == tag).drop(column)


def exact_sample(
    df: DataFrame, size: int | float, key: str, seed: int | str = 0
) -> tuple[DataFrame, DataFrame]:
    """Sample without replacement of an exact size (or share), and the rest.

    A share is rounded to rows, ties to even.
    """
    rows = round(size * df.count()) if isinstance(size, float) else size
    return first_by_hash(df, key, rows, seed)


def features_and_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The feature columns and the label column of a part."""
    return df.drop(label), df.select(col(label))


def shuffle_rows(df: DataFrame, key: str, seed: int | str = 0, name: str = "position") -> DataFrame:
    """Random order by keyed hash, as a position column from 1."""
    return row_index(df, [hash_fraction_bits(col(key), seed), col(key)], name)


def shuffle_rows_random(df: DataFrame, seed: int = 0) -> DataFrame:
    """Rows in random order."""
    return df.orderBy(F.rand(seed))


def synthetic_label(share: float = 0.1, key: Column | str | None = None, seed: int = 0) -> Column:
    """1.0 with the given probability, else 0.0; by key if one is given."""
    draw = F.rand(seed) if key is None else hash_unit(key, seed)
    return F.when(draw < share, F.lit(1.0)).otherwise(F.lit(0.0))


def values_per_key(
    df: DataFrame, key: str, value: str, name: str = "values", chunk_rows: int = 100_000
) -> DataFrame:
    """Values listed per key, sorted, as ``(key, chunk, values)``.

    A list is one cell, so the sorted values of a key are cut every ``chunk_rows`` values: the
    chunks are the same on any layout of the rows, and ascend. Missing values are in no list;
    a key without any other has an empty one.
    """
    pairs = df.select(col(key).alias(key), col(value).alias(value))
    hot = (
        pairs.groupBy(col(key)).agg(F.count(col(value)).alias("count")).filter(F.col("count") > chunk_rows)
        .select(col(key).alias("_hot"), F.lit(True).alias("_is_hot"))
    )
    n_hot = hot.limit(BROADCAST_ROWS + 1).count()
    if n_hot == 0:
        chunked = pairs.withColumn("chunk", F.lit(0).cast("bigint"))
    else:

        def side(table: DataFrame) -> DataFrame:
            return F.broadcast(table) if n_hot <= BROADCAST_ROWS else table

        # Null is a key like any other.
        marked = pairs.join(side(hot), col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
        listed = F.col("_is_hot").isNotNull() & col(value).isNotNull()
        # The range shuffle also cuts by value, so no task gets a whole hot key.
        numbered = row_index(marked.filter(listed).drop("_is_hot"), [col(key), col(value)], "_row")
        first = numbered.groupBy(col(key).alias("_hot")).agg(F.min("_row").alias("_first"))
        placed = numbered.join(side(first), col(key).eqNullSafe(F.col("_hot")))
        chunk = F.floor((F.col("_row") - F.col("_first")) / chunk_rows).cast("bigint")
        rest = marked.filter(~listed).select(col(key), col(value), F.lit(0).cast("bigint").alias("chunk"))
        chunked = placed.select(col(key), col(value), chunk.alias("chunk")).union(rest)
    return chunked.groupBy(col(key), "chunk").agg(
        F.sort_array(F.collect_list(col(value))).alias(name)
    )
