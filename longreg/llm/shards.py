"""Searching blocks of queries in shards of vectors, and merging what they find."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from longreg.sources.tables import stage

from .common import bounded_batches

Found = tuple[np.ndarray, np.ndarray]  # ids and scores


def usable(vectors: DataFrame, nonzero: bool) -> DataFrame:
    """Staged (_key, vec_id, embedding as doubles) of the rows that take part, each with a key of its own.

    Vectors that are null, empty or zero (if `nonzero`), or hold null or non-finite components, are
    left out, and rows without an id, which could not be named. Rows with equal ids are vectors of
    their own. Vectors of other lengths are searched apart.
    """
    x = F.col("embedding").cast("array<double>")
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    if nonzero:
        good &= F.exists("embedding", lambda v: v != 0)
    kept = vectors.where("vec_id is not null").select(F.monotonically_increasing_id().alias("_key"), "vec_id", x.alias("embedding"))
    return stage(kept.where(F.coalesce(good, F.lit(False)) & (F.size("embedding") > 0)), "vectors")


def search(vectors: DataFrame, is_query, k: int, score_type: str, index: Callable[[np.ndarray, np.ndarray], Callable[[np.ndarray, np.ndarray], Iterable[Found]]],
           per_shard: int, per_block: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query row, ties to smaller vec_id.

    `index(places, matrix)` indexes a shard of about per_shard vectors, in the order of their ids, and
    returns what finds the best of each of some queries there, but for its own place. A task holds one shard and
    one block of about per_block queries. A shard is indexed anew for each block, so a lost task is
    repeated from its inputs alone.
    """
    count, queries = vectors.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-count // per_shard)), max(1, -(-queries // per_block))
    part = lambda n, seed: F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    length = F.size("embedding")
    held = vectors.select("_key", "vec_id", "embedding", length.alias("length"), part(shards, 1).alias("shard"), each(blocks).alias("block"))
    asked = vectors.where(is_query).select(F.col("_key").alias("_query"), F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"),
                                           length.alias("_length"), part(blocks, 2).alias("_block"), each(shards).alias("_shard"))
    bounded_batches(vectors.sparkSession)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            left = left.sort_values(["vec_id", "_key"])
            ids, places = left["vec_id"].to_numpy("int64"), {key: i for i, key in enumerate(left["_key"])}
            find = index(np.arange(len(ids)), np.stack(left["embedding"]))
            own = np.array([places.get(key, -1) for key in right["_query"]])
            for key, query_id, (at, scores) in zip(right["_query"], right["query_id"], find(np.stack(right["query"]), own)):
                rows += [(key, query_id, i, s) for i, s in zip(ids[at].tolist(), scores.tolist())]
        return pd.DataFrame(rows, columns=["_query", "query_id", "vec_id", "score"])

    found = held.groupBy("shard", "block", "length").cogroup(asked.groupBy("_shard", "_block", "_length")).applyInPandas(
        run, f"_query long, query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best_of(ids: np.ndarray, scores: np.ndarray, query_id: int, k: int) -> Found:
    """The k highest scores but for the query's own place, ties to smaller places."""
    other = ids != query_id
    ids, scores = ids[other], scores[other]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Groups:
    """Equal vectors of a shard as one: distinct rows, and their ids in order. Of each, the
    k + 1 smallest ids are enough for any query."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.rows, inverse = np.unique(matrix + 0.0, axis=0, return_inverse=True)
        order = np.lexsort((ids, inverse.ravel()))
        starts = np.searchsorted(inverse.ravel()[order], np.arange(len(self.rows) + 1))
        self.ids = [ids[order[a:min(b, a + k + 1)]] for a, b in zip(starts, starts[1:])]

    def expand(self, rows: np.ndarray, scores: np.ndarray) -> Found:
        ids = [self.ids[r] for r in rows]
        return (np.concatenate(ids), np.repeat(scores, [len(i) for i in ids])) if ids else (np.empty(0, np.int64), scores)
