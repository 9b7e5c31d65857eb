"""Times of day and opening hours as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.functions.numeric import round_exact_even, round_half_up
from coppice.functions.text import as_column
from coppice.plans.schemas import WEEKDAYS

DAY_SECONDS = 86400


def time_text(c: Column | str) -> Column:
    """``HH:mm:ss`` from a timestamp."""
    return F.date_format(as_column(c), "HH:mm:ss")


def seconds_of_day(c: Column | str) -> Column:
    """Seconds since midnight from ``HH:mm:ss`` text, with or without a date before it.

    Text that is no time of day gives null.
    """
    clock = F.substring_index(as_column(c), " ", -1)
    # Counted from the end, so that hours of one digit work too.
    part = [
        text.try_cast("bigint")
        for text in (
            F.substring_index(clock, ":", 1), F.substring(clock, -5, 2), F.substring(clock, -2, 2)
        )
    ]
    whole = F.length(clock).between(7, 8)
    in_range = part[0].between(0, 23) & part[1].between(0, 59) & part[2].between(0, 59)
    return F.when(whole & in_range, part[0] * 3600 + part[1] * 60 + part[2])


def _span(start: Column, end: Column, wrap_midnight: bool) -> Column:
    span = seconds_of_day(end) - seconds_of_day(start)
    if wrap_midnight:
        return F.when(span < 0, span + DAY_SECONDS).otherwise(span)
    return span


def opening_seconds(
    from1: Column | str,
    to1: Column | str,
    from2: Column | str,
    to2: Column | str,
    wrap_midnight: bool = False,
) -> Column:
    first = _span(as_column(from1), as_column(to1), wrap_midnight)
    second = _span(as_column(from2), as_column(to2), wrap_midnight)
    return first + second


def hours_from_seconds(seconds: Column | str, digits: int = 2, binary: bool = False) -> Column:
    """Rounded hours; ``binary`` rounds ties of the stored value to even, not half up."""
    hours = as_column(seconds) / F.lit(3600.0)
    return round_exact_even(hours, digits) if binary else round_half_up(hours, digits)


def opening_hours(
    from1: Column | str,
    to1: Column | str,
    from2: Column | str,
    to2: Column | str,
    digits: int = 2,
    binary: bool = False,
    wrap_midnight: bool = False,
) -> Column:
    """Hours covered by two opening intervals.

    A close after midnight counts negative unless ``wrap_midnight`` is set.
    """
    return hours_from_seconds(opening_seconds(from1, to1, from2, to2, wrap_midnight), digits, binary)


def add_weekday_seconds(
    df: DataFrame, suffix: str = "_seconds", wrap_midnight: bool = False
) -> DataFrame:
    """Opening seconds of all seven days as columns ``day + suffix``.

    Rounding mentions its input many times; with the seconds as columns of their own
    the texts are parsed once and plans stay small.
    """
    return df.withColumns(
        {
            day + suffix: opening_seconds(
                f"{day}_from_time1",
                f"{day}_to_time1",
                f"{day}_from_time2",
                f"{day}_to_time2",
                wrap_midnight,
            )
            for day in WEEKDAYS
        }
    )


def weekday_hours(
    suffix: str, digits: int = 2, binary: bool = False, seconds_suffix: str = "_seconds"
) -> dict[str, Column]:
    """``{day + suffix: hours}`` over the columns of ``add_weekday_seconds``."""
    return {
        day + suffix: hours_from_seconds(day + seconds_suffix, digits, binary) for day in WEEKDAYS
    }
