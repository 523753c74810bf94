"""Quality classifier: supervised subword embeddings.

A document is the average of the vectors of its features: its words as they are written, their
character n-grams, all hashed into a fixed number of buckets, and one constant. A linear layer
and softmax follow. Vectors and layer are learned together by stochastic gradient descent in
numpy, on a sample of labelled rows whose size is a parameter. The layer is linear, so after
training each bucket's vector is reduced to its share of the score, and a word's share is
computed once and remembered.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Memo, bounded_batches, lookup


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 16
    shortest: int = 2
    longest: int = 3
    again: int = 8  # features that a repeated word counts as
    sample: int = 8192  # labelled rows that are learned from, at most
    epochs: int = 6
    rate: float = 0.5
    seed: int = 1


def bucket(feature: str, s: Settings) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % s.buckets


def features_of(word: bytes, s: Settings) -> np.ndarray:
    """Buckets of a word and its character n-grams, with marks at its ends."""
    text = word.decode("utf-8", "replace")
    framed = f"<{text}>"
    grams = [framed[i:i + n] for n in range(s.shortest, s.longest + 1) for i in range(len(framed) - n + 1)]
    return np.fromiter((bucket(g, s) for g in (f"={text}", *grams)), np.int64)


def repeats(words: list[bytes]) -> int:
    """Word pairs of equal words. They are one feature, as no list of word pairs could hold them."""
    return sum(map(operator.eq, words, words[1:]))


def document_features(text: str | None, s: Settings, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of a document; weights sum to one. At most s.buckets of them."""
    words = (text or "").encode("utf-8", "replace").split()
    counts = Counter(words)
    found = [memo[word] for word in counts]
    weight = np.repeat(np.fromiter(counts.values(), np.float64, len(counts)), np.array([len(f) for f in found], np.int64))
    total = np.bincount(np.concatenate([*found, [bucket("</s>", s), bucket("<again>", s)]]).astype(np.int64),
                        np.r_[weight, 1, s.again * repeats(words)])
    at = np.flatnonzero(total)
    return at.astype(np.int32), (total[at] / total.sum()).astype(np.float32)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], s: Settings) -> np.ndarray:
    """Score of each bucket: how much the logit of label 1 exceeds that of label 0."""
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    layer = np.zeros((s.dim, 2), np.float32)
    steps, done = max(1, s.epochs * len(rows)), 0
    for _ in range(s.epochs):
        for i in rng.permutation(len(rows)):
            label, at, weight = rows[i]
            hidden = weight @ vectors[at]
            logits = hidden @ layer
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            rate = s.rate * (1 - done / steps)
            back = layer @ p
            layer -= rate * np.outer(hidden, p)
            # As usual for averaged vectors, each gets the whole gradient in proportion to its
            # share of the largest.
            vectors[at] -= np.outer(rate * weight / weight.max(), back)
            done += 1
    return vectors @ (layer[:, 1] - layer[:, 0])


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> np.ndarray:
    """Learn from labels (doc_id, label) and the documents they belong to.

    The sample is the s.sample rows with the smallest hash of doc_id. Null ids, null labels and
    labels without a document are not learned from; of several labels of an id the largest
    counts. With no row left every text scores one half.
    """
    bounded_batches(docs.sparkSession)
    sample = (labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id").limit(s.sample))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most s.sample rows

    def extract(frames):
        memo = Memo(lambda word: features_of(word, s), 50_000)
        for frame in frames:
            found = [document_features(text, s, memo) for text in frame["text"]]
            yield pd.DataFrame({"one": 1, "doc_id": frame["doc_id"], "label": frame["label"].astype("int32"),
                                "at": [f[0] for f in found], "weight": [f[1] for f in found]})

    rows = texts.mapInPandas(extract, "one int, doc_id long, label int, at array<int>, weight array<float>")

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        # One task: at most s.sample rows of at most s.buckets numbers.
        frame = frame.assign(size=frame["at"].map(len)).sort_values(["doc_id", "size"])
        scores = train([(int(n), np.asarray(at), np.asarray(w)) for n, at, w in zip(frame["label"], frame["at"], frame["weight"])], s)
        return pd.DataFrame({"scores": [scores.astype("<f4").tobytes()]})

    model = rows.groupBy("one").applyInPandas(learn, "scores binary").first()
    return np.frombuffer(model["scores"], "<f4") if model else np.zeros(s.buckets, np.float32)


def score(docs: DataFrame, scores: np.ndarray, s: Settings = Settings()) -> DataFrame:
    """Adds score, the probability of label 1, to documents. Whole texts are read; a null or
    empty text has the constant feature alone. Clashing columns named score are replaced."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scores)  # 4 bytes a bucket
    columns = [c for c in docs.columns if c != "score"]

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        memo = word_scores(shared.value, s)
        constant, again = (float(shared.value[bucket(f, s)]) for f in ("</s>", "<again>"))
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            words = (text or "").encode("utf-8", "replace").split()
            found, pairs = lookup(memo, words, np.complex128).sum(), s.again * repeats(words)
            out[i] = (found.real + constant + again * pairs) / (found.imag + 1 + pairs)
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return docs.select(*columns, probability("text").alias("score"))


_remembered: tuple[np.ndarray, Memo] | None = None


def word_scores(scores: np.ndarray, s: Settings) -> Memo:
    """word -> summed score of its features + i * their number, remembered by the worker while
    the model stays the same."""
    global _remembered
    if _remembered is None or not np.array_equal(_remembered[0], scores):
        _remembered = scores, Memo(lambda word: complex(
            scores[at := features_of(word, s)].sum(dtype=np.float64), len(at)), 400_000)
    return _remembered[1]
