"""Exact top-k by inner product: best-first search in M-trees, one a shard.

Inner product becomes a metric by one more component: with m the largest norm of a shard,
x' = (x, sqrt(m^2 - |x|^2)) and q' = (q, 0), the highest product q.x is at the least distance
|q' - x'|. Nodes are pages of entries under a routing vector. Every entry stores the radius
that covers what is below it and its distance to the routing vector of its page, so that by
the triangle inequality most entries are passed over before their distance is computed.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from . import shards

#: Queries that go through a tree together. What they hold is at most this times a shard's vectors.
TOGETHER = 256


@dataclass
class Page:
    route: int  # row of the routing vector
    rows: np.ndarray  # rows of the entries: vectors of a leaf, routing vectors of the pages below
    to_route: np.ndarray  # distances from the entries to the routing vector
    radii: np.ndarray  # of what is below the entries; zero in a leaf
    below: list[Page] | None  # None: a leaf


class MTree:
    def __init__(self, rows: np.ndarray, page: int = 64, fan: int = 16, seed: int = 9):
        self.rows = rows
        squares = (rows * rows).sum(1)
        self.top = float(squares.max())
        self.points = np.c_[rows, np.sqrt(self.top - squares)]
        self.page, self.fan, self.rng = page, fan, np.random.default_rng(seed)
        self.root, _ = self._build(np.arange(len(rows)))

    def _distances(self, points: np.ndarray, to: np.ndarray) -> np.ndarray:
        return np.sqrt(((points - to) ** 2).sum(-1))

    def _build(self, at: np.ndarray) -> tuple[Page, float]:
        """The page over the rows `at` and its covering radius."""
        middle = self.points[at].mean(0)
        route = int(at[np.argmin(self._distances(self.points[at], middle))])
        to_route = self._distances(self.points[at], self.points[route])
        if len(at) <= self.page:
            return Page(route, at, to_route, np.zeros(len(at)), None), float(to_route.max())
        fan = min(self.fan, -(-len(at) // self.page) + 1)
        pivots = self.points[self.rng.choice(at, fan, replace=False)]
        owner = np.argmin(np.stack([self._distances(self.points[at], p) for p in pivots]), 0)
        parts = [at[owner == i] for i in range(fan) if (owner == i).any()]
        if len(parts) == 1:  # no pivot parts them: by distance instead
            parts = np.array_split(at[np.argsort(to_route, kind="stable")], fan)
        built = [self._build(part) for part in parts]
        routes = np.array([page.route for page, _ in built])
        return (Page(route, routes, self._distances(self.points[routes], self.points[route]),
                     np.array([r for _, r in built]), [page for page, _ in built]), float(to_route.max()))

    def highest(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each query, the rows and products of the k highest products, and of all that equal the last.

        The queries go through the tree together: a page is opened once, for those whose reach it
        is within, the page nearest to any of them first. Each query has a reach of its own.
        """
        totals = (queries * queries).sum(1) + self.top
        best = np.full((len(queries), k), -np.inf)  # highest products so far, the least of them first
        reach = np.full(len(queries), np.inf)  # the distance beyond which products are below the least wanted (whole numbers)
        found = []

        def distances(rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
            """From queries to routing vectors."""
            squares = totals[asked, None] - 2 * (queries[asked] @ self.rows[rows].T)
            return np.sqrt(np.maximum(squares, 0.0))

        tie, everyone = itertools.count(), np.arange(len(queries))
        heap = [(0.0, next(tie), self.root, everyone, np.zeros(len(queries)), distances(np.array([self.root.route]), everyone)[:, 0])]
        while heap:
            _, _, page, asked, closest, to_query = heapq.heappop(heap)
            open_to = closest <= reach[asked]
            asked, to_query = asked[open_to], to_query[open_to]
            near = np.abs(to_query[:, None] - page.to_route) - page.radii <= reach[asked, None]
            asked, near, to_query = asked[near.any(1)], near[near.any(1)], to_query[near.any(1)]
            entries = np.flatnonzero(near.any(0))
            if not len(entries):
                continue
            near = near[:, entries]
            if page.below is None:
                products = queries[asked] @ self.rows[page.rows[entries]].T
                one, entry = np.nonzero(near & (products >= best[asked, :1]))
                found.append((asked[one], page.rows[entries[entry]], products[one, entry]))
                both = np.c_[best[asked], np.where(near, products, -np.inf)]
                kept = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                kept[:, ::-1].sort(axis=1)
                best[asked] = kept[:, ::-1]
                least = best[asked, 0]
                full = asked[least > -np.inf]
                # Squares of distances are whole; beyond 2^53 a distance may be off by a share of the norms.
                reach[full] = np.sqrt(np.maximum(0.0, totals[full] - 2 * best[full, 0])) * (1 + 1e-9) + 1e-6 + 2e-7 * np.sqrt(totals[full])
                continue
            away = distances(page.rows[entries], asked)
            nearest = np.maximum(0.0, away - page.radii[entries])
            near &= nearest <= reach[asked, None]
            for j, i in enumerate(entries.tolist()):
                at = np.flatnonzero(near[:, j])
                if len(at):
                    heapq.heappush(heap, (float(nearest[at, j].min()), next(tie), page.below[i], asked[at], nearest[at, j], away[at, j]))
        one, rows, products = map(np.concatenate, zip(*found))
        kept = products >= best[one, 0]
        order = np.argsort(one[kept], kind="stable")
        one, rows, products = (x[kept][order] for x in (one, rows, products))
        ends = np.searchsorted(one, np.arange(1, len(queries)))
        return list(zip(np.split(rows, ends), np.split(products, ends)))


def highest_products(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, per_shard: int = 8192, per_block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest inner products of floor(scale * x).

    Exact; products are whole numbers, summed in double precision, which holds them up to
    2^53. See shards.usable for vectors that take no part; zero vectors do.
    """

    def index(places: np.ndarray, matrix: np.ndarray):
        groups = shards.Groups(places, matrix, k)
        tree = MTree(groups.rows)

        def find(queries: np.ndarray, own: np.ndarray) -> Iterator[shards.Found]:
            for at in range(0, len(queries), TOGETHER):
                # One more, as the query's own may be among them.
                found = tree.highest(queries[at:at + TOGETHER], k + 1)
                for (rows, scores), place in zip(found, own[at:]):
                    yield shards.best_of(*groups.expand(rows, scores.astype(np.int64)), place, k)

        return find

    whole = shards.usable(vectors, nonzero=False).withColumn(
        "embedding", F.transform("embedding", lambda x: F.floor(x * scale).cast("double")))
    return shards.search(whole, is_query, k, "long", index, per_shard, per_block)
