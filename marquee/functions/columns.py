"""Column expressions shared by the operators. All of them are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType

from marquee.specs import BRACKETS_AND_QUOTES, LIST_SEPARATOR, NULL_TOKEN


def null_token(column: Column) -> Column:
    return F.nullif(column, F.lit(NULL_TOKEN))


def split_list(column: Column) -> Column:
    """Comma separated text to an array; NULL stays NULL and '' becomes ['']."""
    return F.split(F.trim(column), LIST_SEPARATOR)


def strip_brackets(column: Column) -> Column:
    return F.regexp_replace(column, BRACKETS_AND_QUOTES, "")


def parse_characters(column: Column, parse: str = "comma") -> Column:
    """Role names of a credit, stored as ``["a","b"]``.

    ``comma`` drops brackets and quotes and splits on commas, so a name that contains a comma
    becomes two items. ``json`` parses the text and keeps such a name whole.
    """
    if parse == "comma":
        return split_list(strip_brackets(null_token(column)))
    if parse == "json":
        return F.from_json(null_token(column), ArrayType(StringType()))
    raise ValueError(f"parse must be 'comma' or 'json', not {parse!r}")


def number(df: DataFrame, name: str, kind: DataType) -> Column:
    """Column ``name`` as ``kind``; text that is no such number becomes NULL instead of an error.

    A column that already has the type is returned bare, so that a filter on it still reaches the
    scan as a pushed filter or a partition filter.
    """
    column = F.col(name)
    return column if df.schema[name].dataType == kind else column.try_cast(kind)


def comparable(df: DataFrame, name: str, kind: DataType) -> Column:
    """Like ``number``, but any numeric column stays bare: comparing needs no narrowing."""
    if isinstance(df.schema[name].dataType, NumericType):
        return F.col(name)
    return F.col(name).try_cast(kind)


def strictly_between(column: Column, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return (column > low) & (column < high)


def alive_flag(birth: Column, death: Column) -> Column:
    """Born and died: False. Born and not died: True. Birth unknown: NULL."""
    return F.when(birth.isNotNull(), death.isNull())


def adult_flag(column: Column) -> Column:
    """Zero is False; everything else, NULL included, is True."""
    return F.coalesce(column != 0, F.lit(True))
