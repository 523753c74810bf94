"""Approximate nearest neighbours by hierarchical navigable small-world graphs, one a shard.

A graph is a few flat arrays: per layer, the neighbours of its nodes. Vectors are inserted one
by one; each is linked to those near it that are not nearer to one another, so that links go
in all directions. A search walks greedily down the layers and keeps the best few in the last.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame

from . import shards


class Graph:
    def __init__(self, unit: np.ndarray, links: int = 12, width: int = 48, seed: int = 5):
        """`unit`: vectors of length one. `links`: neighbours a node has above the last layer,
        where it has twice as many. `width`: candidates kept while inserting."""
        self.x, self.width = unit.astype(np.float32), width
        n = len(unit)
        rng = np.random.default_rng(seed)
        self.levels = np.minimum((-np.log(1 - rng.random(n)) / np.log(links)).astype(int), 12)
        self.most = [2 * links] + [links] * int(self.levels.max())
        self.near = [np.full((n, m), -1, np.int32) for m in self.most[:1]]
        # Above the last layer few nodes are left, which have places of their own.
        self.place = [np.arange(n)]
        for level in range(1, len(self.most)):
            here = self.levels >= level
            self.place.append(np.where(here, np.cumsum(here) - 1, -1))
            self.near.append(np.full((int(here.sum()), links), -1, np.int32))
        self.entry = 0
        for node in range(1, n):
            self._insert(node)

    def _neighbours(self, node: int, level: int) -> np.ndarray:
        row = self.near[level][self.place[level][node]]
        return row[row >= 0]

    def walk(self, query: np.ndarray, entries: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The `width` most similar nodes met, best first."""
        seen = {node for _, node in entries}
        open_ = [(-s, node) for s, node in entries]
        heapq.heapify(open_)
        best = list(entries)
        heapq.heapify(best)
        while open_:
            s, node = heapq.heappop(open_)
            if len(best) >= width and -s < best[0][0]:
                break
            new = [i for i in self._neighbours(node, level).tolist() if i not in seen]
            if not new:
                continue
            seen.update(new)
            for s, i in zip((self.x[new] @ query).tolist(), new):
                if len(best) < width:
                    heapq.heappush(best, (s, i))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, i))
                else:
                    continue
                heapq.heappush(open_, (-s, i))
        return sorted(best, reverse=True)

    def _spread(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """The nearest that are not nearer to one chosen before; then the nearest of the rest."""
        nodes = [i for _, i in near]
        among = self.x[nodes] @ self.x[nodes].T
        chosen: list[int] = []
        for at, (s, _) in enumerate(near):
            if len(chosen) < most and (not chosen or among[at, chosen].max() < s):
                chosen.append(at)
        taken = set(chosen)
        chosen += [at for at in range(len(near)) if at not in taken][:most - len(chosen)]
        return [nodes[at] for at in chosen]

    def _link(self, node: int, other: int, level: int) -> None:
        row = self.near[level][self.place[level][node]]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = other
            return
        nodes = [*row.tolist(), other]
        near = sorted(zip((self.x[nodes] @ self.x[node]).tolist(), nodes), reverse=True)
        row[:] = self._spread(near, len(row))

    def _insert(self, node: int) -> None:
        query, top = self.x[node], self.levels[self.entry]
        near = [(float(self.x[self.entry] @ query), self.entry)]
        for level in range(top, self.levels[node], -1):
            near = self.walk(query, near, 1, level)
        for level in range(min(top, self.levels[node]), -1, -1):
            near = self.walk(query, near, self.width, level)
            chosen = self._spread(near, self.most[level])
            self.near[level][self.place[level][node], :len(chosen)] = chosen
            for other in chosen:
                self._link(other, node, level)
        if self.levels[node] > top:
            self.entry = node

    def nearest(self, query: np.ndarray, width: int) -> np.ndarray:
        query = query.astype(np.float32)
        near = [(float(self.x[self.entry] @ query), self.entry)]
        for level in range(self.levels[self.entry], 0, -1):
            near = self.walk(query, near, 1, level)
        return np.array([i for _, i in self.walk(query, near, width, 0)])


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 5, width: int = 64, per_shard: int = 4096, per_block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found by cosine.

    Every vector is indexed, in the graph of its shard; every query searches all shards.
    Scores are formed anew from the original vectors in double precision. See shards.usable
    for vectors that take no part.
    """

    def index(places: np.ndarray, matrix: np.ndarray):
        groups = shards.Groups(places, matrix, k)
        norms = np.sqrt((groups.rows * groups.rows).sum(1))
        graph = Graph(groups.rows / norms[:, None])

        def find_one(query: np.ndarray, own: int) -> shards.Found:
            norm = np.sqrt((query * query).sum())
            rows = graph.nearest(query / norm, width)
            scores = (groups.rows[rows] * query).sum(1) / (norms[rows] * norm)
            return shards.best_of(*groups.expand(rows, scores), own, k)

        return lambda queries, own: map(find_one, queries, own)

    return shards.search(shards.usable(vectors, nonzero=True), is_query, k, "double", index, per_shard, per_block)
