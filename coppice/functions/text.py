"""String clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def list_delimiter(c: Column | str, old: str = ",", new: str = "-") -> Column:
    """``a,b,c`` to ``a-b-c``."""
    return F.replace(as_column(c), F.lit(old), F.lit(new))


def item_count(c: Column | str, delimiter: str = "-") -> Column:
    """Number of items of a delimited list; an empty text holds one item."""
    pattern = "\\Q" + delimiter + "\\E"
    return F.size(F.split(as_column(c), pattern, -1))


def token(c: Column | str, delimiter: str = " ", index: int = 0) -> Column:
    """Item ``index`` of a delimited text; negative indexes count from the end."""
    if index in (0, -1):
        return F.substring_index(as_column(c), delimiter, 1 if index == 0 else -1)
    return F.split_part(as_column(c), F.lit(delimiter), F.lit(index + 1 if index >= 0 else index))


def tag_value(c: Column | str, key: str = "primary_tags") -> Column:
    """Value of ``key`` in JSON-like text, whether its quotes are single or doubled."""
    pattern = rf'"*{key}"*\s*:\s*"*([^"{{}}]*?)"*\s*\}}'
    found = F.regexp_extract(as_column(c), pattern, 1)
    return F.when(found != "", found)


def strip_tag_quotes(c: Column | str) -> Column:
    """Remove backslashes and both kinds of quotes."""
    return F.translate(as_column(c), "\\'\"", "")


def strip_quotes(c: Column | str) -> Column:
    """Remove both kinds of quotes."""
    return F.translate(as_column(c), "'\"", "")


def strip_list_marks(c: Column | str) -> Column:
    """Outer trim, then drop leading ``[``, trailing ``]``, all blanks and double quotes."""
    trimmed = F.trim(as_column(c), F.lit(" \t\n\r\f\v"))
    unbracketed = F.rtrim(F.ltrim(trimmed, F.lit("[")), F.lit("]"))
    return F.translate(unbracketed, ' "', "")


def number_text(c: Column | str) -> Column:
    """Text form of a number."""
    return as_column(c).cast("string")


def date_text(c: Column | str) -> Column:
    """Date part, as text, of ``yyyy-MM-dd HH:mm:ss`` text."""
    return token(as_column(c), " ", 0)


def epoch_days(c: Column | str) -> Column:
    """Days since 1970-01-01 as a double, from a date, a timestamp or its text; else null."""
    return F.unix_date(as_column(c).try_cast("date")).cast("double")
