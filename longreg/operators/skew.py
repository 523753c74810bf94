"""Lookup joins that hold when one key owns a large share of the rows.

Rows are thought of as PIECES pieces of equal size, at least four per shuffle partition. A key that
holds more than one piece is "hot". There are fewer hot keys than pieces, so their lookup rows are
broadcast under that bound. All other keys fit in one partition and are joined by key; rows that have
a hot key or none go along in that join, dealt by what varies within the key, so that it spreads them.
Lookup rows that are grouped by hash and key already are not shuffled again.

Keys travel behind a 64-bit hash of themselves. The hash leads every sort, where it
decides almost all comparisons, and stands for the key in the hot list; the key columns
still decide equality.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.blank import any_null
from ..functions.keys import packed, unpacked

PIECES = 1000
HASH = "_hash"
#: Bits of a filter, whatever the number of its keys: at most 2**20 words of 64 bits are broadcast.
FILTER_BITS = 1 << 26


def hash_of(keys: list[str]) -> Column:
    """Hash of the key, NULL when a part is NULL."""
    return F.when(~any_null(keys), F.xxhash64(*keys))


def pieces(df: DataFrame) -> int:
    return max(PIECES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str],
                weight: str | None = None, total: Column | None = None) -> DataFrame:
    """Left join to `right`, which holds one row per key; adds its other columns.

    `spread` names columns that vary within a key (a row id). `weight` names a column
    of `right` with the number of left rows of the key, when the caller knows it, and
    `total` is their sum, if that is cheaper to get elsewhere.
    Both sides may bring the key hash along in `_hash`.
    """
    left_columns = [c for c in left.columns if c != HASH]
    values = [c for c in right.columns if c not in keys and c not in (weight, HASH)]
    hashed = lambda df: df if HASH in df.columns else df.withColumn(HASH, hash_of(keys))
    left, right = hashed(left), hashed(right)

    rows, whole = weight or "_rows", pieces(left)
    counts = right if weight else (left.where(F.col(HASH).isNotNull()).groupBy(HASH)
                                   .agg(F.count(F.lit(1)).alias("_rows")))
    total = counts.agg(F.sum(rows).alias("n")).scalar() if total is None else total
    hot = counts.withColumn("_pieces", F.ceil(F.col(rows) * whole / total)).where("_pieces > 1")
    marked = left
    if not weight:
        names = F.broadcast(hot.select(F.col(HASH).alias("_hot"), "_pieces"))
        hot = right.join(names, F.col(HASH) == F.col("_hot"), "left_semi")
        marked = left.join(names, F.col(HASH) == F.col("_hot"), "left")
    on = lambda prefix, at: [F.col(at) == F.col(f"{prefix}_hash"), *[F.col(k) == F.col(f"{prefix}_{k}") for k in keys]]
    named = lambda df, prefix: [F.col(HASH).alias(f"{prefix}_hash"), *[F.col(k).alias(f"{prefix}_{k}") for k in keys]]
    few = F.broadcast(hot.select(*named(hot, "_h"), F.struct(F.lit(True), *values).alias("_few")))
    known = marked.join(few, on("_h", HASH), "left")
    apart = F.col("_few").isNotNull() | F.col(HASH).isNull()
    if not weight:
        apart = apart | F.col("_pieces").isNotNull()
    dealt = known.select(*left_columns, "_few", F.when(apart, F.xxhash64(*spread)).otherwise(F.col(HASH)).alias("_at"))
    # Naming the weight here makes Spark read the grouped rows above again instead of grouping twice; so does the order of
    # the columns, which becomes that of the aggregates: Spark takes groups with other orders for different ones.
    told = F.col(weight or HASH).alias("_r_told")
    again = [told if c == weight else F.col(c) for c in right.columns if c == weight or c in values]
    joined = dealt.join(right.select(*named(right, "_r"), *again, *([] if weight else [told])), on("_r", "_at"), "left").where(
        F.col("_r_told").isNull() | (F.col("_r_told") >= -2**63))
    return joined.select(*left_columns, *[F.when(F.col("_few").isNotNull(), F.col(f"_few.{v}")).otherwise(F.col(v)).alias(v) for v in values])


def _word(hashed: Column) -> tuple[Column, Column]:
    """The word and the bit of a hash in a filter."""
    at = F.coalesce(hashed, F.lit(0)).bitwiseAND(F.lit(FILTER_BITS - 1))
    return F.shiftright(at, 6), at.bitwiseAND(F.lit(63)).cast("int")


def key_filter(keys: DataFrame, name: str) -> DataFrame:
    """Words with the bits of the hashes in column `name`. A hash whose bit is not set is surely not among
    them; one whose bit is set may be. It only saves shuffles, so it need not grow with the keys."""
    word, bit = _word(F.col(name))
    return (keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word")
            .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")))


def with_filter(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Add `_may`: whether the hash in column `name` may be one of the filter `keys`."""
    word, bit = _word(F.col(name))
    placed = rows.withColumns({"_at": word, "_bit": bit})
    found = placed.join(F.broadcast(keys), F.col("_at") == F.col("_word"), "left")
    may = F.coalesce(F.expr("getbit(_bits, _bit)") == 1, F.lit(False))
    return found.withColumn("_may", may).drop("_at", "_bit", "_word", "_bits")


def rare_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: Column, ids=()) -> DataFrame:
    """`lookup_join` with a `right` that has few of the keys: left rows whose key is surely not there, or is hot,
    stay where they are, and only the others are shuffled. `left` and `right` bring the key hash along in
    `_hash`; `ids` names columns of `left` that travel packed."""
    left_columns = [c for c in left.columns if c != HASH]
    values = [c for c in right.columns if c not in (*keys, weight, HASH)]
    named = lambda df, prefix: [F.col(HASH).alias(f"{prefix}_hash"), *[F.col(k).alias(f"{prefix}_{k}") for k in keys]]
    on = lambda prefix: [F.col(HASH) == F.col(f"{prefix}_hash"), *[F.col(k) == F.col(f"{prefix}_{k}") for k in keys]]
    # Names all columns, and keeps the keys that the joins keep, so that grouped rows are made once for all of them.
    there = right.where(functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in (HASH, *keys)]) & functools.reduce(
        Column.__or__, [F.col(v).isNotNull() for v in values], F.col(weight) > 0))
    known = with_filter(left, key_filter(there, HASH), HASH)
    hot = right.where(F.ceil(F.col(weight) * pieces(left) / total) > 1)
    few = F.broadcast(hot.select(*named(hot, "_h"), F.struct(F.lit(True), *values).alias("_few")))
    known = known.join(few, on("_h"), "left")
    moves = F.col("_may") & F.col("_few").isNull()
    stay = known.where(~moves).select(*left_columns, *[F.col(f"_few.{v}").alias(v) for v in values])
    slim = known.where(moves).select(HASH, *[packed(F.col(c)).alias(c) if c in ids else F.col(c) for c in left_columns])
    met = slim.join(right.select(*named(right, "_r"), F.col(weight).alias("_r_told"), *values), on("_r"), "left").where(
        F.col("_r_told").isNull() | (F.col("_r_told") > 0))
    return stay.unionByName(met.select(*[unpacked(F.col(c)).alias(c) if c in ids else F.col(c) for c in left_columns], *values))


def attach_group_values(df: DataFrame, keys: list[str], aggregates: list, spread: list[str]) -> DataFrame:
    """Add per-group aggregates to every row, like a window over the whole group but
    pre-aggregated before the shuffle, so no group is ever gathered in one task."""
    hashed = df.withColumn(HASH, hash_of(keys))
    some = hashed.where(F.col(HASH).isNotNull())
    grouped = some.groupBy(HASH, *keys).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    total = some.agg(F.count(F.lit(1)).alias("n")).scalar()
    return lookup_join(hashed, grouped, keys, spread, weight="_rows", total=total)
