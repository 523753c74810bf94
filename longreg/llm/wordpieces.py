"""Token counts by greedy longest match, in one pass over each word.

The vocabulary is a trie over bytes. Each node has a failure link, where matching goes on
when no child fits, and the number of pieces that are complete when the link is taken. So a
word's count is found without backing up and without building its pieces.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Memo, bounded_batches, lookup, words_of

REMEMBERED = 400_000


class Automaton:
    def __init__(self, vocabulary: set[bytes]):
        self.children: list[dict[int, int]] = [{}]
        ends = {}
        for piece in sorted(vocabulary - {b""}):
            node = 0
            for byte in piece:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                node = self.children[node][byte]
            ends[node] = True
        # Breadth first: a node's link needs those of shorter prefixes. None: no way to go on.
        self.link: list[int | None] = [None] * len(self.children)
        self.popped = [0] * len(self.children)
        level = [0]
        while level:
            below = []
            for parent in level:
                for byte, node in self.children[parent].items():
                    below.append(node)
                    if node in ends:
                        self.link[node], self.popped[node] = 0, 1
                        continue
                    at, count = self.link[parent], self.popped[parent]
                    while at is not None and byte not in self.children[at]:
                        count += self.popped[at]
                        at = self.link[at]
                    if at is not None:
                        self.link[node], self.popped[node] = self.children[at][byte], count
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of a word; a word that can't be cut into pieces whole counts as one."""
        node, count, children, link, popped = 0, 0, self.children, self.link, self.popped
        for byte in word:
            while byte not in children[node]:
                count += popped[node]
                node = link[node]
                if node is None:
                    return 1
            node = children[node][byte]
        while node:
            count += popped[node]
            node = link[node]
            if node is None:
                return 1
        return count


def byte_strings(vocabulary: dict[str, int]) -> set[bytes]:
    """The byte strings of a byte-level vocabulary, marks of word ends dropped.

    Byte-level files write printable Latin-1 bytes as themselves and the others, in order, as
    the characters from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    tokens = (token.removesuffix("</w>") for token in vocabulary if not token.startswith("<|"))
    return {bytes(byte_of[c] for c in token) for token in tokens if token and all(c in byte_of for c in token)}


@functools.lru_cache(maxsize=1)  # one for the life of a worker
def _counter(tokenizer_path: str) -> Memo:
    with open(tokenizer_path, encoding="utf-8") as file:
        automaton = Automaton(byte_strings(json.load(file)["model"]["vocab"]))
    return Memo(automaton.count, REMEMBERED)


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Adds n_words and n_tokens to documents, replacing columns of these names.

    Words are runs of anything but ASCII white space with A-Z lower-cased; pieces are byte
    strings. Null and empty texts count zero. The file lies where the tokenizers are installed
    on every executor.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("n_words long, n_tokens long")
    def count(texts: pd.Series) -> pd.DataFrame:
        memo = _counter(tokenizer_path)
        found = [lookup(memo, words_of(text), np.int64) for text in texts]
        return pd.DataFrame({"n_words": [len(f) for f in found], "n_tokens": [int(f.sum()) for f in found]})

    kept = [c for c in docs.columns if c not in ("n_words", "n_tokens")]
    return docs.select(*kept, count("text").alias("_n")).select(*kept, "_n.n_words", "_n.n_tokens")
