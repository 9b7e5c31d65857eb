"""Global row numbers, joins by position, and exact order statistics at scale."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.functions.numeric import hash_fraction_bits, missing_to_null
from coppice.functions.text import as_column
from coppice.operators.columns import col
from coppice.session import scratch_root, write_scratch

#: Files whose offsets are sent to all executors.
BROADCAST_FILES = 200_000
_PARTITION_BITS = 33  # monotonically_increasing_id: partition number above, row below


def _add_offsets(df: DataFrame, name: str, part: str, position: str) -> DataFrame:
    """Row number = rows in earlier partitions + position within the partition."""
    sizes = df.groupBy(part).agg((F.max(position) + 1).alias("_size"))
    # One row per partition of the input, so a single window task is enough.
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        part, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    joined = df.join(F.broadcast(offsets), part)
    return joined.withColumn(name, F.col("_offset") + F.col(position) + 1).drop(
        part, position, "_offset"
    )


def _shuffles(df: DataFrame) -> bool:
    """Whether the plan of ``df`` moves rows between tasks, or reads no files at all."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Exchange" in plan or "FileScan" not in plan


def _plan_nodes(df: DataFrame) -> list[str]:
    """Names of the logical operators of ``df`` down to its table; empty if it joins or unites some."""
    node, names = df._jdf.queryExecution().analyzed(), []
    while True:
        names.append(node.nodeName())
        children = node.children()
        if children.size() != 1:
            return names if children.size() == 0 else []
        node = children.head()


def _file_places(df: DataFrame) -> DataFrame | None:
    """``df`` with the file (``_file``) and the row in it (``_place``), if a scan can tell them."""
    if not set(_plan_nodes(df)) <= {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}:
        return None
    try:
        place = F.col("_metadata.row_index").alias("_place")
        return df.select("*", F.col("_metadata.file_path").alias("_file"), place)
    except AnalysisException:  # formats without row numbers, and tables that are no files
        return None


def _number_by_files(df: DataFrame, placed: DataFrame, name: str) -> DataFrame:
    """Rows by the path of their file and their place in it, whatever splits the scan makes."""
    if "Filter" in _plan_nodes(df):
        return row_index(placed, ["_file", "_place"], name).drop("_file", "_place")
    # A whole scan: places have no gaps, so only the sizes of files are needed.
    sizes = placed.groupBy("_file").agg((F.max("_place") + 1).alias("_size"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    offsets = sizes.select("_file", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    few = offsets.count() <= BROADCAST_FILES
    joined = placed.join(F.broadcast(offsets) if few else offsets, "_file")
    return joined.withColumn(name, F.col("_offset") + F.col("_place") + 1).drop("_file", "_place", "_offset")


def row_index(
    df: DataFrame, order_by: Sequence[Column | str] | None = None, name: str = "row_index"
) -> DataFrame:
    """Number all rows from 1 without moving them into one task.

    With ``order_by``: one range shuffle, a sorted table in the scratch folder,
    then partition offsets. Add enough columns to make the order total; they also
    let the range shuffle cut through a key that holds many rows.

    Without: the order of the stored rows. Scans of files that know the rows' places (Parquet)
    are numbered by path and place, so numbers do not depend on how the files are split or on
    retries; a filter in between takes a range shuffle by them. Of anything else only a file
    scan repeats its order, so rows that come out of a shuffle are written first.
    """
    by_file = None if order_by else _file_places(df)
    if by_file is not None:
        return _number_by_files(df, by_file, name)
    order = [as_column(c) for c in order_by] if order_by else []
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    tagged = placed.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1)).alias(
            "_position"
        ),
    )
    if order or _shuffles(df):
        tagged = write_scratch(tagged, "row-index")
    return _add_offsets(tagged, name, "_part", "_position")


def zip_rows(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[Column | str] | None = None,
    right_order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Pair the n-th row of one table with the n-th row of the other."""
    numbered = row_index(left, left_order)
    other = row_index(right, right_order)
    return numbered.join(other, "row_index").drop("row_index")


def cell(df: DataFrame, row: int, column: str, order_by: Sequence[Column | str]) -> DataFrame:
    """One cell by row number (from 0) and column name."""
    if all(isinstance(c, str) for c in order_by):
        df = df.select(*[col(c) for c in dict.fromkeys([column, *order_by])])
    return df.orderBy(*[as_column(c) for c in order_by]).offset(row).limit(1).select(col(column))


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).distinct().orderBy(col(column))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Preview of n rows."""
    return df.limit(n)


@dataclass
class MiddleSketch:
    """What a first pass knows of numeric columns: how many values, and bounds of the middle."""

    sizes: dict[str, int]
    bounds: dict[str, tuple]


def order_statistics(
    df: DataFrame,
    columns: Sequence[str],
    ranks: dict[str, Sequence[int]] | None = None,
    window_rows: int = 1_000_000,
    sketch_error: float = 0.001,
) -> dict[str, list]:
    """Exact values at given ranks (from 0, missing values excluded) of numeric columns.

    Default ranks are the two middle ones. Quantile sketches with a guaranteed error
    narrow an interval around the ranks, for all columns at once, until it holds few
    rows; only those are counted per value and walked in order.
    """
    return order_statistics_and_counts(df, columns, {}, ranks, window_rows, sketch_error)[0]


def order_statistics_and_counts(
    df: DataFrame,
    columns: Sequence[str],
    conditions: Mapping[str, Column],
    ranks: dict[str, Sequence[int]] | None = None,
    window_rows: int = 1_000_000,
    sketch_error: float = 0.001,
    sketch: MiddleSketch | None = None,
) -> tuple[dict[str, list], dict[str, int]]:
    """``order_statistics``, and in the same pass how many rows meet each of ``conditions``.

    A ``sketch`` of the columns' middle saves the passes that count values and find the first
    interval; its bounds are checked by counts like any others. Where both bounds are one value
    that covers the ranks, those counts are the answer, and the column is not counted by value.
    """
    types = dict(df.dtypes)
    values = {c: missing_to_null(col(c), types[c]) for c in columns}
    met = [f"_met{k}" for k in range(len(conditions))]
    base = df.select(
        *[v.alias(c) for c, v in values.items()],
        *[F.coalesce(condition, F.lit(False)).alias(m) for condition, m in zip(conditions.values(), met)],
    )
    if sketch is not None:
        sizes = sketch.sizes
    elif columns:
        sizes = base.agg(*[F.count(col(c)).alias(c) for c in columns]).first().asDict()
    wanted: dict[str, list[int]] = {}
    for c in columns:
        n = sizes[c]
        if n:
            wanted[c] = list(ranks[c]) if ranks else [(n - 1) // 2, n // 2]
    interval = {c: (None, None) for c in wanted}
    before = dict.fromkeys(wanted, 0)
    inside = {c: sizes[c] for c in wanted}

    def within(c: str, bounds: tuple) -> Column:
        low, high = bounds
        keep = col(c).isNotNull()
        if low is not None:
            keep = keep & (col(c) >= F.lit(low))
        if high is not None:
            keep = keep & (col(c) <= F.lit(high))
        return keep

    guessed = sketch.bounds if sketch is not None and ranks is None else {}
    one_value = [c for c in wanted if c in guessed and guessed[c][0] == guessed[c][1]]
    wide = [c for c in wanted if inside[c] > window_rows or c in one_value]
    proposed = {c: guessed[c] for c in wide if c in guessed}
    if len(proposed) < len(wide):
        proposed = {}
    result: dict[str, list] = {c: [] for c in columns}
    times: dict[str, int] | None = None
    whole = {c: types[c] in ("int", "bigint", "smallint", "tinyint") for c in columns}
    while wide:
        if not proposed:
            masked = base.select(*[F.when(within(c, interval[c]), col(c)).alias(c) for c in wide])
            marks = {}
            for c in wide:
                low = (min(wanted[c]) - before[c]) / inside[c] - 2 * sketch_error
                high = (max(wanted[c]) - before[c] + 1) / inside[c] + 2 * sketch_error
                marks[c] = (max(low, 0.0), min(high, 1.0))
            points = sorted({p for pair in marks.values() for p in pair})
            sketched = masked.approxQuantile(wide, points, sketch_error)
            proposed = {
                c: tuple(quantiles[points.index(p)] for p in marks[c])
                for c, quantiles in zip(wide, sketched)
            }
        counts = base.agg(
            *[F.count_if(col(c) < F.lit(proposed[c][0])).alias(f"{i}_before") for i, c in enumerate(wide)],
            *[F.count_if(within(c, proposed[c])).alias(f"{i}_inside") for i, c in enumerate(wide)],
            *([F.count_if(m).alias(m) for m in met] if times is None else []),
        ).first()
        if times is None:
            times = {name: counts[m] for name, m in zip(conditions, met)}
        still_wide = []
        for i, c in enumerate(wide):
            below, held = counts[f"{i}_before"], counts[f"{i}_inside"]
            covers = below <= min(wanted[c]) and max(wanted[c]) < below + held
            low, high = proposed[c]
            # Bounds of integers that are doubles may stand for several neighbours beyond 2**53.
            if covers and low == high and (isinstance(low, int) or not whole[c]):
                result[c] = [low if whole[c] else float(low) + 0.0] * len(wanted.pop(c))
            elif covers and held < inside[c]:
                shrunk = held <= inside[c] // 2
                interval[c], before[c], inside[c] = proposed[c], below, held
                # Repeated values may keep an interval large; counting folds them.
                if held > window_rows and shrunk:
                    still_wide.append(c)
        wide, proposed = still_wide, {}

    if not wanted:
        if times is None:
            # No column has values: conditions are counted alone.
            counts = base.agg(*[F.count_if(m).alias(m) for m in met]).first() if met else {}
            times = {name: counts[m] for name, m in zip(conditions, met)}
        return result, times
    names = list(wanted)
    met = met if times is None else []
    # Integers keep their type: doubles would merge neighbours beyond 2**53. Bounds compare
    # as doubles on both sides of them, which keeps the order.
    entries = []
    for i, c in enumerate(names):
        value = F.when(within(c, interval[c]), col(c))
        entries.append(
            F.struct(
                F.lit(i).alias("i"),
                (F.lit(None) if whole[c] else value).cast("double").alias("v"),
                (value if whole[c] else F.lit(None)).cast("bigint").alias("w"),
            )
        )
    # Conditions are counted as columns after the others, with one value.
    for k, m in enumerate(met):
        one = F.when(F.col(m), F.lit(1).cast("bigint"))
        entries.append(F.struct(F.lit(len(names) + k).alias("i"), F.lit(None).cast("double").alias("v"), one.alias("w")))
    counted = (
        base.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .filter("v IS NOT NULL OR w IS NOT NULL")
        .groupBy("i", "v", "w")
        .count()
    )
    if max(inside[c] for c in names) > window_rows:
        counted = _near_ranks(counted, wanted, before, len(met))
    else:
        counted = counted.withColumns({"part": F.lit(0), "skipped": F.lit(0).cast("bigint")})
    walk = Window.partitionBy("i", "part").orderBy("v", "w")
    running = counted.withColumn("upto", F.col("skipped") + F.sum("count").over(walk))
    hits = None
    for i, c in enumerate(names):
        for rank in wanted[c]:
            position = rank - before[c]
            hit = (F.col("i") == i) & (F.col("upto") > position) & (
                F.col("upto") - F.col("count") <= position
            )
            hits = hit if hits is None else hits | hit
    found = running.filter(hits | (F.col("i") >= len(names))).collect()
    for i, c in enumerate(names):
        for rank in wanted[c]:
            position = rank - before[c]
            value = next(
                r["w" if whole[c] else "v"] for r in found
                if r["i"] == i and r["upto"] > position >= r["upto"] - r["count"]
            )
            result[c].append(value)
    if times is None:
        counted_conditions = {r["i"] - len(names): r["count"] for r in found if r["i"] >= len(names)}
        times = {name: counted_conditions.get(k, 0) for k, name in enumerate(conditions)}
    return result, times


def _near_ranks(
    counted: DataFrame, wanted: dict[str, list[int]], before: dict[str, int], n_conditions: int = 0
) -> DataFrame:
    """Of very many ``(i, v, w, count)``, the range partitions that hold the wanted ranks.

    The ``n_conditions`` columns after the wanted ones have one row each, which stays.

    ``skipped`` tells how many rows of the column lie in its earlier partitions.
    """
    placed = counted.repartitionByRange("i", "v", "w").withColumn("part", F.spark_partition_id())
    stored = write_scratch(placed, "ranks")
    # One row per column and partition.
    sizes = stored.groupBy("i", "part").agg(F.sum("count").alias("n")).orderBy("i", "part").collect()
    keep, skipped = [], dict.fromkeys(range(len(wanted) + n_conditions), 0)
    for r in sizes:
        start = skipped[r["i"]]
        skipped[r["i"]] = start + r["n"]
        if r["i"] >= len(wanted):
            keep.append((r["i"], r["part"], start))
            continue
        c = list(wanted)[r["i"]]
        if any(start <= rank - before[c] < start + r["n"] for rank in wanted[c]):
            keep.append((r["i"], r["part"], start))
    table = stored.sparkSession.createDataFrame(keep, "i int, part int, skipped bigint")
    return stored.join(F.broadcast(table), ["i", "part"])


def first_by_hash(
    df: DataFrame, key: str, size: int, seed: int | str = 0
) -> tuple[DataFrame, DataFrame]:
    """Exactly ``size`` rows, the smallest by keyed hash, and the remaining rows.

    The cut-off is an exact order statistic, so both parts are plain filters. Only
    when rows share the cut-off hash are those few numbered.
    """
    scratch_root(df.sparkSession)
    hashed = df.withColumn("_hash", hash_fraction_bits(col(key), seed))
    if size <= 0:
        return df.filter(F.lit(False)), df
    total = df.count()
    if size >= total:
        return df, df.filter(F.lit(False))
    cut = order_statistics(hashed, ["_hash"], {"_hash": [size - 1]})["_hash"][0]
    place = hashed.agg(
        F.count_if(F.col("_hash") < cut).alias("below"), F.count_if(F.col("_hash") == cut).alias("at")
    ).first()
    below, at = hashed.filter(F.col("_hash") < cut), hashed.filter(F.col("_hash") > cut)
    if place["below"] + place["at"] == size:
        return hashed.filter(F.col("_hash") <= cut).drop("_hash"), at.drop("_hash")
    ties = row_index(hashed.filter(F.col("_hash") == cut), [col(key), *map(col, df.columns)], "_rank")
    needed = size - place["below"]
    chosen = below.unionByName(ties.filter(F.col("_rank") <= needed).drop("_rank"))
    rest = at.unionByName(ties.filter(F.col("_rank") > needed).drop("_rank"))
    return chosen.drop("_hash"), rest.drop("_hash")
