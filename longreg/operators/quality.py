"""Column checks, counted in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.blank import blank


def is_uuid(name: str) -> Column:
    return F.col(name).rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")


def is_uuid4(name: str) -> Column:
    """Random (version 4) UUID in canonical form."""
    return F.col(name).rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")


def is_iso_date(name: str) -> Column:
    """A real calendar date as yyyy-MM-dd."""
    return F.col(name).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(name, "yyyy-MM-dd").isNotNull()


def is_numeric_id(name: str, width: int | None = None) -> Column:
    return F.col(name).rlike(f"^[0-9]{{{width}}}$" if width else "^[0-9]+$")


def is_castable(name: str, data_type: str) -> Column:
    return F.col(name).try_cast(data_type).isNotNull()


def quality_checks(df: DataFrame, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """One row per rule (column, condition): rows checked, blank, and failed. Blank
    values are counted apart and never fail."""
    aggregates = []
    for i, (column, valid) in enumerate(rules.values()):
        empty = blank(df, column)
        aggregates += [F.count_if(empty).alias(f"b{i}"),
                       F.count_if(~empty & ~F.coalesce(valid, F.lit(False))).alias(f"f{i}")]
    counted = df.agg(F.count(F.lit(1)).alias("n"), *aggregates)
    entries = [F.struct(F.lit(name).alias("rule"), F.lit(column).alias("column"), F.col("n").alias("rows"),
                        F.col(f"b{i}").alias("blank"), F.col(f"f{i}").alias("failed"))
               for i, (name, (column, _)) in enumerate(rules.items())]
    return counted.select(F.inline(F.array(*entries)))
