"""Hidden Markov language model.

A state emits a class of words, the class emits the word by its share of the class. The most
frequent words are classes of their own; the others share classes by their last bytes. So
the model's tables have a fixed size, while the counts of words, which decide the classes and
the shares, cover all training texts and are kept as a table.

Texts are encoded once: tasks number the words of their batches, the numbers are joined to the
counts, and every text becomes a list of classes. Each round of Baum-Welch is a scan of these
lists in which tasks form expected counts, which Spark adds up. The scaled forward recursion
over whole texts then gives their exact likelihood.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from longreg.sources.tables import stage

from .common import bounded_batches, lookup, words_of

END = b"\n"  # no word holds it


@dataclass(frozen=True)
class Settings:
    states: int = 8
    own: int = 1 << 15  # most frequent words that are classes of their own
    shared: int = 1 << 12  # classes of all other words
    rounds: int = 4
    prior: float = 4.0  # uses of a class by the average state that are added to those counted
    segment: int = 0  # tokens; longer training texts are cut, and go on from the average state; 0: none is cut
    seed: int = 3


def shared_class(word: bytes, s: Settings) -> int:
    return xxhash.xxh3_64_intdigest(word[-4:]) % s.shared


def _chunks(frames: Iterator[pd.DataFrame], column: str, most: int) -> Iterator[pd.DataFrame]:
    """Frames put together until the values of a column are `most` characters or numbers long."""
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += int(frame[column].str.len().sum())
        if size >= most:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


#: Lists of more classes are put together apart from shorter ones.
LONG = 2000


def _chunks_alike(frames: Iterator[pd.DataFrame], column: str, most: int) -> Iterator[pd.DataFrame]:
    """The rows of frames, put together until a column's lists are `most` numbers long. Recursions go side by
    side for as many steps as the longest list has, so a few long lists don't go along with many short ones."""
    held, sizes = {True: [], False: []}, {True: 0, False: 0}
    for frame in frames:
        lengths = frame[column].str.len()
        for long in held:
            at = (lengths > LONG) == long
            if not at.any():
                continue
            held[long].append(frame[at])
            sizes[long] += int(lengths[at].sum())
            if sizes[long] >= most:
                yield pd.concat(held[long], ignore_index=True)
                held[long], sizes[long] = [], 0
    yield from (pd.concat(rest, ignore_index=True) for rest in held.values() if rest)


def _numbered(docs: DataFrame, trained: Column, s: Settings) -> DataFrame:
    """Staged batches: the words of a batch with their training counts (doc null), and its texts
    as numbers of these words."""
    bounded_batches(docs.sparkSession)

    def run(frames):
        for place, frame in enumerate(_chunks(frames, "text", 20_000_000)):
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            texts = [lookup(number, [*words_of(text), END], np.int32) for text in frame["text"]]
            number.default_factory = None  # it refers to the dict, which then could not go at once
            trained = [at for at, train in zip(texts, frame["_train"]) if train]
            counts = np.bincount(np.concatenate([*trained, np.empty(0, np.int32)]), minlength=len(number))
            # The partition and the place in it tell batches apart; a partition has under 2^31 of them.
            batch = (int(frame["_part"].iloc[0]) << 31) + place
            yield pd.DataFrame({"kind": 0, "batch": batch, "doc_id": frame["doc_id"].astype("Int64"), "train": frame["_train"],
                                "ids": texts, "word": None, **{c: pd.array([None] * len(frame), "Int64") for c in ("n", "number", "shared")}})
            yield pd.DataFrame({"kind": 1, "batch": batch, "doc_id": pd.array([None] * len(number), "Int64"), "train": None,
                                "ids": None, "word": list(number), "n": pd.array(counts, "Int64"),
                                "number": pd.array(list(number.values()), "Int64"),
                                "shared": pd.array([shared_class(w, s) for w in number], "Int64")})

    schema = "kind int, batch long, doc_id long, train boolean, ids array<int>, word binary, n long, number int, shared int"
    return stage(docs.select("doc_id", "text", trained.alias("_train"), F.spark_partition_id().alias("_part")).mapInPandas(run, schema), "hmm-batches", ["kind"])


def _encoded(batches: DataFrame, counts: DataFrame, own: DataFrame, class_total: np.ndarray,
             words: int, types: int, s: Settings) -> DataFrame:
    """Staged texts as lists of classes, with what depends on the counts alone."""
    known = batches.where("kind = 1").select(F.col("batch").alias("_batch"), "word", "number", "shared")
    counted = known.join(counts, "word", "left").join(F.broadcast(own), "word", "left").select(
        "_batch", "number", F.coalesce("own", F.col("shared") + s.own).alias("class"), F.coalesce("n", F.lit(0)).alias("n"))
    texts = batches.where("kind = 0").select("batch", "doc_id", "train", "ids")
    totals = counts.sparkSession.sparkContext.broadcast(class_total)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("number")  # 0, 1, ...
        kinds, n = right["class"].to_numpy("int32"), right["n"].to_numpy("float64")
        inside = np.log10(n + 1) - np.log10(totals.value[kinds])
        base = np.log10(n + 1) - np.log10(float(words) + (types + 1))
        seen = (n > 0).astype(np.int64)
        return pd.DataFrame({"doc_id": left["doc_id"].astype("Int64"), "train": left["train"], "classes": [kinds[i] for i in left["ids"]],
                             "inside": [inside[i].sum() for i in left["ids"]], "base_score": [base[i].sum() for i in left["ids"]],
                             "n_known": [seen[i].sum() for i in left["ids"]]})

    schema = "doc_id long, train boolean, classes array<int>, inside double, base_score double, n_known long"
    return stage(texts.groupBy("batch").cogroup(counted.groupBy("_batch")).applyInPandas(run, schema), "hmm-texts")


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states: chance of the class in the state

    def smoothed(self) -> Model:
        """Single precision for the recursions; every chance is over zero."""
        return Model(*(np.ascontiguousarray(np.maximum(x, 1e-30), np.float32) for x in (self.start, self.move, self.emit)))


def first_model(weights: np.ndarray, s: Settings) -> Model:
    """States that differ by chance: every class favours some states. Texts that use the same
    words pull them together in the rounds that follow, as states tend to stay."""
    rng = np.random.default_rng(s.seed)
    emit = weights[:, None] * rng.gamma(0.5, 1, (len(weights), s.states)) + 1e-12
    move = np.full((s.states, s.states), 0.1 / s.states) + 0.9 * np.eye(s.states)
    return Model(np.full(s.states, 1 / s.states), move, emit / emit.sum(0))


class Steps:
    """Lists side by side, longest first, laid out step by step: the numbers at one step lie together."""

    def __init__(self, lists: list[np.ndarray]):
        lengths = np.array([len(x) for x in lists])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.longest = int(lengths[0])
        #: How many lists reach each step, and where its numbers begin.
        self.active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(self.longest), "right")
        self.begins = np.r_[0, np.cumsum(self.active)]
        at = np.repeat(-np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())  # place in its list
        self.flat = np.empty(len(at), np.int32)
        self.flat[self.begins[at] + np.repeat(np.arange(len(lengths)), lengths)] = np.concatenate([lists[i] for i in self.order])

    def __iter__(self) -> Iterator[slice]:
        begins = self.begins.tolist()
        return map(slice, begins, begins[1:])


def log_likelihoods(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 likelihood of each list of classes, by the scaled forward recursion, all side by side."""
    model = model.smoothed()
    if not sum(map(len, texts)):
        return np.zeros(len(texts))
    steps = Steps(texts)
    emit, scales = model.emit[steps.flat], np.empty(len(steps.flat), np.float32)
    forward = None
    for at in steps:
        now = emit[at]
        now *= model.start if forward is None else forward[:len(now)] @ model.move
        scale = scales[at] = now.sum(1)
        now /= scale[:, None]
        forward = now
    out = np.zeros(len(texts))
    logs = np.log10(scales)
    for at in steps:
        out[:at.stop - at.start] += logs[at]
    back = np.empty_like(out)
    back[steps.order] = out
    return back


def expected_counts(texts: list[np.ndarray], model: Model, average: np.ndarray, segment: int):
    """(start, move, emit) summed over texts: the expected uses of states at the start, of moves,
    and of states with each class."""
    model, average = model.smoothed(), average.astype(np.float32)
    segment = segment or max(map(len, texts))
    parts = [(t[i:i + segment], i == 0) for t in texts for i in range(0, len(t), segment)]
    steps = Steps([p[0] for p in parts])
    begins = np.array([p[1] for p in parts])[steps.order]
    k = len(average)
    emit = model.emit[steps.flat]
    forward, scales = np.empty_like(emit), np.empty((len(emit), 1), np.float32)
    now = np.where(begins[:, None], model.start, average)
    for t, at in enumerate(steps):
        n = at.stop - at.start
        np.multiply(now[:n] @ model.move if t else now[:n], emit[at], out=forward[at])
        now = forward[at]
        scale = scales[at] = now.sum(1, keepdims=True)
        now /= scale
    # What is left of the chances: those of the next step, over its scale.
    emit /= scales
    gamma, moves, move = forward.copy(), np.zeros((k, k)), np.ascontiguousarray(model.move.T)
    onward, after = None, 0
    for at in reversed(list(steps)):
        if after:
            # The lists that go on are the first ones of this step.
            on = slice(at.start, at.start + after)
            moves += forward[on].T @ onward
            back = onward @ move
            gamma[on] *= back
            onward = emit[at]
            onward[:after] *= back
        else:
            onward = emit[at]
        after = at.stop - at.start
    used = np.stack([np.bincount(steps.flat, gamma[:, i], len(model.emit)) for i in range(k)], 1)
    return gamma[:len(begins)][begins].sum(0, dtype=np.float64), moves * model.move, used


def baum_welch_round(texts: DataFrame, model: Model, average: np.ndarray, weights: np.ndarray, s: Settings) -> tuple[Model, np.ndarray]:
    """One round over all training texts. The counts that come back have the model's fixed size."""
    shared = texts.sparkSession.sparkContext.broadcast((model, average))
    classes, k = len(weights), s.states

    def run(frames):
        # One sum a task: rows for the classes, then the start, then one a state for its moves.
        total = np.zeros((classes + 1 + k, k))
        for frame in _chunks_alike(frames, "classes", 500_000):
            start, moves, used = expected_counts(list(frame["classes"]), *shared.value, s.segment)
            total[:classes] += used
            total[classes] += start
            total[classes + 1:] += moves
        at = np.flatnonzero(total.any(1))
        yield pd.DataFrame({"row": at, **{f"s{i}": total[at, i] for i in range(k)}})

    schema = "row int, " + ", ".join(f"s{i} double" for i in range(k))
    found = (texts.where("train").select("classes").mapInPandas(run, schema)
             .groupBy("row").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]).toPandas())
    total = np.zeros((classes + 1 + k, k))
    total[found["row"].to_numpy()] = found[[f"s{i}" for i in range(k)]].to_numpy()
    emit, start, moves = total[:classes], total[classes] + 1, total[classes + 1:] + 1
    use = emit.sum(0)
    average = (use + 1) / (use + 1).sum()
    # A class keeps its overall share; which states use it is drawn to the average, the more so
    # the less often it occurs.
    emit = weights[:, None] * (emit + s.prior * average) / (emit.sum(1, keepdims=True) + s.prior)
    return Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emit / emit.sum(0)), average


def scored(docs: DataFrame, trained: Column, s: Settings = Settings(), watch: Callable | None = None) -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score) of every document.

    `trained` marks the rows to learn from. Tokens are the words, A-Z lower-cased, and one end.
    base_score is the log10 probability by add-one counts, score the model's. In both, all
    words that training never saw and that share a class are one event. Null and empty texts
    have the end alone; rows with equal ids are scored one by one; without training rows all
    classes are equally likely. Other columns are ignored.
    """
    batches = _numbered(docs, trained, s)
    counts = stage(batches.where("kind = 1").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "hmm-counts")
    words, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("n"), "word").limit(s.own).collect()  # s.own rows at most
    own = counts.sparkSession.createDataFrame([(r["word"], i) for i, r in enumerate(top)], "word binary, own int")
    # Of every class: what its words' n + 1 add up to, and one more for words never seen.
    total = np.ones(s.own + s.shared)
    total[:len(top)] = [r["n"] + 1 for r in top]
    rest = counts.join(F.broadcast(own), "word", "left_anti")

    @F.pandas_udf("int")
    def kind(words: pd.Series) -> pd.Series:
        return words.map(lambda w: s.own + shared_class(bytes(w), s))

    for r in rest.groupBy(kind("word").alias("kind")).agg(F.sum(F.col("n") + 1).alias("n")).collect():
        total[r["kind"]] += r["n"]
    texts = _encoded(batches, counts, own, total, words, types, s)
    weights = total.copy()
    weights[len(top):s.own] = 0
    model, average = first_model(weights, s), np.full(s.states, 1 / s.states)
    for _ in range(s.rounds if words else 0):
        model, average = baum_welch_round(texts, model, average, weights, s)
        if watch:
            watch(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames):
        for frame in _chunks_alike(frames, "classes", 1_000_000):
            lists = list(frame["classes"])
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].astype("Int64"), "trained": frame["train"], "n_tokens": [len(t) for t in lists],
                "n_known": frame["n_known"], "train_tokens": words, "base_score": frame["base_score"],
                "score": frame["inside"].to_numpy() + log_likelihoods(lists, shared.value)})

    bounded_batches(docs.sparkSession)
    return texts.mapInPandas(run, "doc_id long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
