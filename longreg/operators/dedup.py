"""Top-1 per key and duplicate handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.blank import all_filled, as_text
from .order import oldest_first
from .shape import require
from .skew import attach_group_values


def top_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of each key. Spark limits each key to one row per task before the
    shuffle (WindowGroupLimit), so hot keys do not pile up."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def drop_duplicates(df: DataFrame, cols: list[str], order: list | None = None) -> DataFrame:
    """One row per combination of `cols` (NULLs equal). The survivor is the first row
    by `order`, or by the content of the remaining columns: never an arbitrary one."""
    require(df, cols)
    if order is None:
        order = [F.col(c).asc_nulls_first() for c in df.columns if c not in cols] or [F.lit(0)]
    # The hash leads the sort key only to make comparisons cheap; the columns decide.
    hashed = df.withColumn("_hash", F.xxhash64(*cols))
    return top_per_key(hashed, ["_hash", *cols], order).drop("_hash")


def duplicate_groups(df: DataFrame, keys: list[str], allow_blank: bool = False) -> DataFrame:
    """Keys that occur more than once: count, newest row, ids of the oldest row."""
    rows = df if allow_blank else df.where(all_filled(df, keys))
    oldest = F.min_by(F.struct("entity_id", "group_id", "site_id"), oldest_first())
    return (rows.groupBy(*[as_text(F.col(k)).alias(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("duplicate_count"),
                 F.max_by("row_id", oldest_first()).alias("latest_row_id"),
                 oldest.alias("_ids"))
            .where("duplicate_count > 1")
            .select(*keys, "duplicate_count", "latest_row_id", "_ids.*"))


def renumber_duplicates(df: DataFrame, keys: list[str], as_of, allow_blank: bool = False) -> DataFrame:
    """Rows that share the keys take the ids of their oldest row, and all but the
    newest are marked superseded."""
    parts = {f"_k{i}": as_text(F.col(k)) for i, k in enumerate(keys)}
    if not allow_blank:
        parts = {n: F.when(all_filled(df, keys), c) for n, c in parts.items()}
    ids = ["entity_id", "group_id", "site_id"]
    grouped = attach_group_values(
        df.withColumns(parts), list(parts),
        [F.min_by(F.struct(*ids), oldest_first()).alias("_ids"),
         F.max_by("row_id", oldest_first()).alias("_latest"),
         F.count(F.lit(1)).alias("_n")], spread=["row_id"])
    is_group = F.coalesce(F.col("_n") > 1, F.lit(False))
    made = {i: F.when(is_group, F.coalesce(F.nullif(F.col(f"_ids.{i}"), F.lit("")), F.col(i)))
            .otherwise(F.col(i)) for i in ids}
    made["superseded_on"] = F.when(is_group & (F.col("row_id") != F.col("_latest")),
                                   F.lit(as_of)).otherwise(F.col("superseded_on"))
    return grouped.withColumns(made).drop("_ids", "_latest", "_n", *parts)
