"""Rounding and impurity formulas as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from coppice.functions.text import as_column


def missing_to_null(c: Column, data_type: str) -> Column:
    """NaN counts as missing; only floating-point columns can hold it."""
    return F.when(~F.isnan(c), c) if data_type in ("double", "float") else c


def round_half_up(c: Column | str, digits: int) -> Column:
    return F.round(as_column(c), digits)


def round_exact_even(c: Column | str, digits: int) -> Column:
    """Round the stored binary value, ties to even, as Python's ``round`` does.

    ``F.bround`` looks at the shortest decimal text instead, so 7.35 (stored as
    7.3499...) would become 7.4. The sign of ``x * 2 * 10^digits - (2m + 1)`` is
    computed without rounding error by splitting ``x`` into two halves.
    """
    x = as_column(c).cast("double")
    scale = float(10**digits)
    spread = x * F.lit(134217729.0)  # 2^27 + 1
    high = spread - (spread - x)
    low = x - high
    step = F.floor(x * F.lit(scale)).cast("double")
    excess = (high * F.lit(2 * scale) - (step * 2 + 1)) + low * F.lit(2 * scale)
    up = (excess > 0) | ((excess == 0) & (F.pmod(step, F.lit(2.0)) == 1))
    return (F.when(up, step + 1).otherwise(step)) / F.lit(scale)


def total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def x_log2_x(c: Column) -> Column:
    value = c.cast("double")
    return F.when(value > 0, value * F.log2(value)).otherwise(F.lit(0.0))


def impurity_term(c: Column, criterion: str = "entropy") -> Column:
    """What one label's count contributes to ``combined_mass``."""
    if criterion == "entropy":
        return x_log2_x(c)
    if criterion == "gini":
        return c.cast("double") * c.cast("double")
    raise ValueError(f"unknown criterion: {criterion}")


def combined_mass(n: Column, terms: Column, criterion: str = "entropy") -> Column:
    """Rows times impurity, from the number of rows and the sum of the terms."""
    if criterion == "entropy":
        return x_log2_x(n) - terms
    return F.when(n > 0, n.cast("double") - terms / n).otherwise(F.lit(0.0))


def impurity_mass(counts: Sequence[Column], criterion: str = "entropy") -> Column:
    """Rows times impurity of a group, from its counts per label.

    The sum over the groups of a partition, divided by all rows, is the weighted
    impurity. An empty group weighs nothing.
    """
    terms = total([impurity_term(c, criterion) for c in counts])
    return combined_mass(total(counts), terms, criterion)


def impurity(counts: Sequence[Column], criterion: str = "entropy") -> Column:
    """Impurity of one group, from its counts per label."""
    return impurity_mass(counts, criterion) / total(counts)


def split_impurity(
    below: Sequence[Column], above: Sequence[Column], criterion: str = "entropy"
) -> Column:
    """Weighted impurity of the two sides of a split."""
    mass = impurity_mass(below, criterion) + impurity_mass(above, criterion)
    return mass / (total(below) + total(above))


def hash_fraction_bits(c: Column | str, seed: int | str = 0) -> Column:
    """52 uniform bits from a key and a seed, exact in a double and in a bigint.

    Comes from md5, so other engines can repeat it.
    """
    text = F.concat_ws(":", F.lit(str(seed)), as_column(c).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def hash_unit(c: Column | str, seed: int | str = 0) -> Column:
    """A uniform number in [0, 1) that depends on key and seed only."""
    return hash_fraction_bits(c, seed).cast("double") / F.lit(float(2**52))
