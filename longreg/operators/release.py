"""Publication: pseudonymised projection and subsets by code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.blank import not_blank
from .clean import active_only
from .shape import forbid_columns, require, select_required
from .skew import HASH, hash_of, lookup_join


def release_projection(df: DataFrame, columns: list[str], deny=()) -> DataFrame:
    """Only the released columns; fails if one is missing or one is denied."""
    out = select_required(df, columns)
    forbid_columns(out, deny)
    return out


def _groups_of(code: Column, groups: dict[str, tuple[str, ...]]) -> Column:
    """Array of the group names that a code belongs to."""
    names: dict[str, list[str]] = {}
    for name, codes in groups.items():
        for c in codes:
            names.setdefault(c, []).append(name)
    none = F.array().cast("array<string>")
    if not names:
        return none
    table = F.create_map(*[x for c in sorted(names)
                           for x in (F.lit(c), F.array(*[F.lit(n) for n in names[c]]))])
    return F.coalesce(F.try_element_at(table, code), none)


def subset_by_codes(df: DataFrame, col: str, groups: dict[str, tuple[str, ...]],
                    complete: str | None = "complete") -> DataFrame:
    """Every row once per subset it belongs to, in `release_group`. One pass over the
    data for all subsets; write it with `partition_by=["release_group"]`."""
    require(df, [col])
    found = _groups_of(F.trim(F.col(col).cast("string")), groups)
    if complete:
        found = F.concat(F.array(F.lit(complete)), found)
    return df.select("*", F.explode(found).alias("release_group"))


def restrict_by_backbone(src: DataFrame, backbone: DataFrame, col: str, codes,
                         active: bool = True) -> DataFrame:
    """Source rows whose entity has one of the codes in the backbone. Never duplicates."""
    require(backbone, ["entity_id", col])
    rows = active_only(backbone) if active else backbone
    allowed = (rows.where(F.col(col).cast("string").isin(list(codes)) & not_blank(rows, "entity_id"))
               .select("entity_id").distinct().withColumn("_allowed", F.lit(True)))
    return (lookup_join(src, allowed, ["entity_id"], spread=["row_id"])
            .where("_allowed").drop("_allowed"))


def subset_by_backbone(src: DataFrame, backbone: DataFrame, col: str,
                       groups: dict[str, tuple[str, ...]], active: bool = True,
                       complete: str | None = "complete") -> DataFrame:
    """All subsets of a source by a backbone attribute in one join: each row once per
    subset, as in `subset_by_codes`."""
    require(backbone, ["entity_id", col])
    rows = active_only(backbone) if active else backbone
    code = F.trim(F.col(col).cast("string"))
    names = sorted(name for name, codes in groups.items() if codes)
    has = [F.max(code.isin(list(groups[name]))).alias(f"_g{i}") for i, name in enumerate(names)]
    # One flag per configured group, formed before the shuffle; grouped as the join deals its rows.
    flags = (rows.where(code.isin(sorted({c for codes in groups.values() for c in codes})))
             .groupBy(hash_of(["entity_id"]).alias(HASH), "entity_id").agg(F.first(F.lit(True)).alias("_any"), *has))
    per_entity = flags.select(HASH, "entity_id", F.array_compact(F.array(
        *[F.when(F.col(f"_g{i}"), F.lit(name)) for i, name in enumerate(names)]).cast("array<string>")).alias("_groups"))
    found = F.coalesce(F.col("_groups"), F.array().cast("array<string>"))
    if complete:
        found = F.concat(F.array(F.lit(complete)), found)
    return (lookup_join(src, per_entity, ["entity_id"], spread=["row_id"])
            .select(*src.columns, F.explode(found).alias("release_group")))
