"""One definition of "blank", used by every filter, key and split."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T


def is_blank(column: Column | str, data_type: T.DataType = T.StringType()) -> Column:
    """True for NULL, and for strings that hold only spaces. Never NULL itself."""
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(data_type, T.StringType):
        return F.coalesce(F.trim(column) == "", F.lit(True))
    return column.isNull()


def blank(df: DataFrame, name: str) -> Column:
    return is_blank(F.col(name), df.schema[name].dataType)


def not_blank(df: DataFrame, name: str) -> Column:
    return ~blank(df, name)


def all_filled(df: DataFrame, names: list[str]) -> Column:
    return reduce(and_, [not_blank(df, n) for n in names], F.lit(True))


def all_blank(df: DataFrame, names: list[str]) -> Column:
    return reduce(and_, [blank(df, n) for n in names], F.lit(True))


def any_null(names: list[str]) -> Column:
    return reduce(or_, [F.col(n).isNull() for n in names], F.lit(False))


def blank_to_null(column: Column) -> Column:
    """NULL for a blank string, else the string without outer spaces."""
    return F.nullif(F.trim(column), F.lit(""))


def as_text(column: Column) -> Column:
    """String form of a key part, with blanks folded to the empty string."""
    return F.coalesce(F.trim(column.cast("string")), F.lit(""))
