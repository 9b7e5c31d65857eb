"""Missing values: statistics for all columns in one pass, applied in one projection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.functions.numeric import missing_to_null
from coppice.operators.columns import cast_columns, col
from coppice.operators.ordering import MiddleSketch, order_statistics, order_statistics_and_counts
from coppice.operators.profile import columns_by_type

# Fill for times of day, and the share a frequent text must have.
MISSING_TIME = "00:00:00"
FREQUENT_SHARE = 0.60


def apply_fill(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    """Replace missing cells by the column's fill value, keeping its type."""
    types = dict(df.dtypes)
    return df.select(
        *[
            F.coalesce(missing_to_null(col(c), types[c]), F.lit(fill[c]).cast(types[c])).alias(c)
            if fill.get(c) is not None
            else col(c)
            for c in df.columns
        ]
    )


def fill_constant(df: DataFrame, columns: Sequence[str], value: object = MISSING_TIME) -> DataFrame:
    return apply_fill(df, dict.fromkeys(columns, value))


@dataclass
class _Survey:
    """What one pass over a table tells of its columns."""

    rows: int
    candidates: dict[str, list]
    middle: MiddleSketch
    medians: dict[str, object]


def _survey(
    df: DataFrame,
    texts: Sequence[str] = (),
    exact: Sequence[str] = (),
    rough: Sequence[str] = (),
    share: float = FREQUENT_SHARE,
    relative_error: float = 0.001,
) -> _Survey:
    """One aggregate for all columns: candidates for frequent values of ``texts``, sizes and bounds
    of the middle of ``exact``, sketched lower-middle values of ``rough``.

    The sketch of frequent values errs by less than a quarter of ``share``, so no value that
    reaches the share is lost, and at most ``2 / share`` values seem to come near it.
    """
    types = dict(df.dtypes)
    kept, tracked = math.ceil(2 / share), max(64, math.ceil(16 / share))
    accuracy = math.ceil(1 / relative_error)
    picked, parts = [], [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(texts):
        picked.append(col(c).alias(f"t{i}"))
        parts.append(F.expr(f"approx_top_k(t{i}, {kept}, {tracked})").alias(f"t{i}"))
    for i, c in enumerate(exact):
        picked.append(missing_to_null(col(c), types[c]).alias(f"e{i}"))
        points = [0.5 - 2 * relative_error, 0.5 + 2 * relative_error]
        parts.append(F.count(f"e{i}").alias(f"n{i}"))
        parts.append(F.percentile_approx(f"e{i}", points, accuracy).alias(f"e{i}"))
    for i, c in enumerate(rough):
        picked.append(missing_to_null(col(c), types[c]).alias(f"r{i}"))
        parts.append(F.percentile_approx(f"r{i}", 0.5, accuracy).alias(f"r{i}"))
    found = df.select(*picked).agg(*parts).first()
    return _Survey(
        rows=found["rows"],
        candidates={c: [r["item"] for r in found[f"t{i}"] if r["item"] is not None] for i, c in enumerate(texts)},
        middle=MiddleSketch(
            sizes={c: found[f"n{i}"] for i, c in enumerate(exact)},
            bounds={c: tuple(found[f"e{i}"]) for i, c in enumerate(exact) if found[f"e{i}"]},
        ),
        medians={c: found[f"r{i}"] for i, c in enumerate(rough) if found[f"r{i}"] is not None},
    )


def _second_pass(
    df: DataFrame, survey: _Survey, exact: Sequence[str] = (), share: float = FREQUENT_SHARE
) -> tuple[dict[str, list], dict[str, object]]:
    """Exact middle values of ``exact``, and the candidates that do reach the share."""
    listed = [(c, v) for c, values in survey.candidates.items() for v in values]
    conditions = {str(k): col(c) == F.lit(v) for k, (c, v) in enumerate(listed)}
    if not conditions and not exact:
        return {}, {}
    if exact:
        middle, times = order_statistics_and_counts(df, exact, conditions, sketch=survey.middle)
    else:
        counted = df.agg(*[F.count_if(condition).alias(k) for k, condition in conditions.items()]).first()
        middle, times = {}, counted.asDict()
    frequent: dict[str, list] = {}
    for k, (c, v) in enumerate(listed):
        if times[str(k)] >= share * survey.rows:
            frequent.setdefault(c, []).append((-times[str(k)], v))
    return middle, {c: min(found)[1] for c, found in frequent.items()}


def frequent_values(
    df: DataFrame, columns: Sequence[str], share: float = FREQUENT_SHARE
) -> dict[str, object]:
    """Per column, the value held by at least ``share`` of all rows, if there is one.

    One pass keeps candidates per column, a second counts them exactly: neither shuffles, and
    a value below the share is never used.
    """
    if not columns:
        return {}
    return _second_pass(df, _survey(df, texts=columns, share=share), share=share)[1]


def approximate_medians(
    df: DataFrame, columns: Sequence[str], relative_error: float = 0.001
) -> dict[str, object]:
    """Lower-middle values within a rank error, for all columns in one pass.

    A column without values has no median and stays as it is.
    """
    return _survey(df, rough=columns, relative_error=relative_error).medians if columns else {}


def exact_medians(
    df: DataFrame, columns: Sequence[str], lower: bool = False, window_rows: int = 1_000_000
) -> dict[str, object]:
    """Mean of the two middle values, or the lower one."""
    middle = order_statistics(df, columns, window_rows=window_rows)
    return {c: _middle(pair, lower) for c, pair in middle.items() if pair}


def _middle(pair: Sequence, lower: bool) -> object:
    return pair[0] if lower else (pair[0] + pair[1]) / 2


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column; equal counts give the smallest value.

    Columns are handled by type class; values of all columns of a class are counted
    in one shuffle.
    """
    types = dict(df.dtypes)
    result: dict[str, object] = {}
    for data_type in sorted({types[c] for c in columns}):
        group = [c for c in columns if types[c] == data_type]
        entries = [
            F.struct(F.lit(i).alias("i"), missing_to_null(col(c), data_type).alias("v"))
            for i, c in enumerate(group)
        ]
        counted = (
            df.select(F.explode(F.array(*entries)).alias("e"))
            .select("e.*")
            .filter("v IS NOT NULL")
            .groupBy("i", "v")
            .count()
        )
        best = counted.groupBy("i").agg(
            F.min(F.struct((-F.col("count")).alias("negative"), F.col("v"))).alias("best")
        )
        result.update({group[r["i"]]: r["best"]["v"] for r in best.collect()})
    return result


#: Strategies that share a first pass of sketches and a second one of exact counts; ``mode`` has its own.
STRATEGIES = ("frequent", "median_approx", "median", "median_lower", "mode")


@dataclass
class FillPlan:
    """Fill values learned from one table, to be used on any table.

    ``doubles`` are columns that become doubles first, because the mean of two middle
    values need not be an integer.
    """

    values: dict[str, object] = field(default_factory=dict)
    doubles: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        return apply_fill(cast_columns(df, self.doubles) if self.doubles else df, self.values)


def learn_fill(
    df: DataFrame,
    by_type: Mapping[str, str],
    constants: Mapping[str, object] | None = None,
    skip: Sequence[str] = (),
) -> FillPlan:
    """Learn fill values with one strategy per type class.

    ``by_type`` maps ``string`` / ``int`` / ``double`` to a name in ``STRATEGIES``;
    columns in ``constants`` get their constant instead. All columns are learned together: one
    pass of sketches and one of exact counts, whatever their number.
    """
    plan = FillPlan(dict(constants or {}))
    groups = columns_by_type(df)
    names: dict[str, list[str]] = {strategy: [] for strategy in STRATEGIES}
    for kind, strategy in by_type.items():
        names[strategy] += [c for c in groups.get(kind, []) if c not in plan.values and c not in skip]
    plan.doubles = tuple(c for c in groups.get("int", []) if c in names["median"])
    exact = names["median"] + names["median_lower"]
    if names["frequent"] or exact or names["median_approx"]:
        survey = _survey(df, names["frequent"], exact, names["median_approx"])
        middle, frequent = _second_pass(df, survey, exact)
        plan.values |= survey.medians | frequent
        plan.values |= {c: _middle(pair, c in names["median_lower"]) for c, pair in middle.items() if pair}
    if names["mode"]:
        plan.values |= modes(df, names["mode"])
    return plan
