"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed capacity.

Best fit decreasing depends on the lengths alone, and these are whole numbers up to the
capacity. So the plan is made from the counts of pieces by length, at most `capacity` rows,
and is exactly the one that placing the pieces one by one gives: equal pieces are placed
together, and open bins with equal room are kept as one run. Pieces then look up their place
by their rank among the pieces of their length, which is counted in salted parts, so that
no length's pieces meet in one task.
"""

from __future__ import annotations

import functools
import itertools
import operator
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from longreg.sources.tables import stage

from .common import bounded_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Tails cut off before a word is looked up. The tokenizer ends a piece between a letter
#: and a run of these, and no special token ends with one.
TAIL = b".,;:!?#$%&*)"
#: Words and stems a worker remembers between batches.
REMEMBERED = 700_000
#: Lower-case letters of Latin-1. The tokenizer leaves them as they are and in one piece, so neither
#: its normaliser nor its pattern is asked.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def _stem(word: bytes) -> bytes:
    """A word in lower case without its tail, if that may be cut off."""
    stem = word if b"<|" in word else word.rstrip(TAIL)
    # A letter may end in a mark once it is in lower case.
    return stem if stem.decode("utf-8", "replace")[-1:].lower()[-1:].isalpha() else word


class WordIds:
    """The ids of words, as little-endian 32-bit numbers, remembered within a bounded size.

    The tokenizer drops white space and never joins text across it, so the ids of a text
    are those of its words one after the other. A batch's unknown words are encoded at once.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        #: The same merges, for stems in plain letters.
        self.merges = Tokenizer.from_file(tokenizer_path)
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        """Makes `self.words` hold all of `words`."""
        unknown = list(words - self.words.keys())
        if len(self.words) + len(unknown) > REMEMBERED:
            self.words = {w: self.words[w] for w in words.intersection(self.words)}
        # What may spell a special token counts only as it is spelt.
        low = [word if b"<|" in word else word.lower() for word in unknown]
        stems = [word.rstrip(TAIL) for word in low]
        plain = [match is not None for match in map(PLAIN.fullmatch, stems)]
        stems = [stem if known else _stem(word) for stem, known, word in zip(stems, plain, low)]
        tails = [word[len(stem):] for stem, word in zip(stems, low)]
        parts, letters = {*stems, *tails}, set(itertools.compress(stems, plain))
        new = parts - self.stems.keys()
        if len(self.stems) + len(new) > REMEMBERED:
            self.stems = {p: self.stems[p] for p in parts.intersection(self.stems)}
        self._encode(self.merges, list(new & letters))
        self._encode(self.tokenizer, list(new - letters))
        found = self.stems.__getitem__
        self.words.update(zip(unknown, map(operator.add, map(found, stems), map(found, tails))))

    def _encode(self, tokenizer, parts: list[bytes]) -> None:
        texts = [part.decode("utf-8", "replace") for part in parts]
        encodings = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        self.stems.update(zip(parts, (struct.pack(f"<{len(e)}I", *e.ids) for e in encodings)))

    def of(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        texts = [(text or "").encode("utf-8", "replace").split() for text in texts]
        self.learn(set().union(*texts))
        return (b"".join(map(self.words.__getitem__, words)) for words in texts)


@functools.lru_cache(maxsize=1)  # one for the life of a worker
def word_ids(tokenizer_path: str) -> WordIds:
    return WordIds(tokenizer_path)


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32 of the ids) of one document's ids."""
    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
        part = ids[at:at + 4 * capacity]
        yield piece, at // 4, len(part) // 4, zlib.crc32(part)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """One row per piece of every document. A null or empty text is the end id alone."""
    bounded_batches(docs.sparkSession)

    def run(frames):
        encoder, end = word_ids(tokenizer_path), np.asarray([end_id], "<u4").tobytes()
        for frame in frames:
            rows = [(doc, *piece) for doc, ids in zip(frame["doc_id"], encoder.of(frame["text"]))
                    for piece in pieces_of(ids + end, capacity)]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, PIECES)


class Rooms:
    """Runs of open bins by remaining room, under a segment tree that finds the tightest.

    Node i covers the leaves below it and says whether any holds a run; leaf `room` holds
    the runs of bins with exactly that room, oldest first.
    """

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.base)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, room: int, held: int) -> None:
        i = self.base + room
        self.any[i] = held
        while i > 1:
            i //= 2
            held = self.any[2 * i] | self.any[2 * i + 1]
            if self.any[i] == held:
                return
            self.any[i] = held

    def add(self, room: int, first: int, bins: int) -> None:
        if room not in self.runs:
            self.runs[room] = []
            self._mark(room, 1)
        self.runs[room].append((first, bins))

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least `least` that an open bin has, in logarithmic time."""
        i = self.base + least
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.base
            i //= 2
        return None

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop(0)
        if not self.runs[room]:
            del self.runs[room]
            self._mark(room, 0)
        return run


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first bin, pieces per bin, offset): where the pieces of each
    length go, by rank. A bin that a length fits best keeps being its tightest until the
    length no longer fits, so the bin takes as many as fit before the next one is opened."""
    rooms, plan, opened = Rooms(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            each = (room or capacity) // length
            if room is None:
                room, first, bins = capacity, opened, -(-left // each)
                opened += bins
            else:
                first, bins = rooms.take(room)
            full = min(bins, left // each)
            rest = left - full * each if full < bins else 0
            plan.append((length, rank, first, each, capacity - room))
            if full and room - each * length:
                rooms.add(room - each * length, first, full)
            if rest and room - rest * length:
                rooms.add(room - rest * length, first + full, 1)
            if bins > full + bool(rest):
                rooms.add(room, first + full + bool(rest), bins - full - bool(rest))
            placed = full * each + rest
            rank, left = rank + placed, left - placed
    return plan


def pack_pieces(pieces: DataFrame, capacity: int = 4096, salts: int = 64) -> DataFrame:
    """Adds sequence_id and offset to staged pieces (doc_id, piece, length, ...).

    The driver holds one count per length and the plan, whose size depends on the capacity
    and not on the number of pieces. Pieces of equal length are interchangeable; they are
    ranked by (salt, doc_id, piece), so repeated rows each get a place of their own.
    """
    spark = pieces.sparkSession
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "_salt").count().toPandas().sort_values(["length", "_salt"])
    counts["first"] = counts.groupby("length")["count"].cumsum() - counts["count"]
    plan = best_fit_plan(counts.groupby("length")["count"].sum().to_dict(), capacity)
    firsts = {(int(n), int(s)): int(f) for n, s, f in zip(counts["length"], counts["_salt"], counts["first"])}
    by_length: dict[int, np.ndarray] = {
        n: part.to_numpy("int64")[:, 1:] for n, part in
        pd.DataFrame(plan, columns=["length", "rank", "bin", "each", "offset"]).groupby("length")}

    ranked = salted.withColumn("_rank", F.row_number().over(
        Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1)

    columns = pieces.columns

    def place(frames):
        for frame in frames:
            sequence, offset = np.zeros(len(frame), "int64"), np.zeros(len(frame), "int64")
            for (length, salt), at in frame.groupby(["length", "_salt"]).indices.items():
                rank = frame["_rank"].to_numpy("int64")[at] + firsts[length, salt]
                rule = by_length[length]
                row = rule[np.searchsorted(rule[:, 0], rank, "right") - 1]
                sequence[at] = row[:, 1] + (rank - row[:, 0]) // row[:, 2]
                offset[at] = row[:, 3] + (rank - row[:, 0]) % row[:, 2] * length
            yield frame[columns].assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"{c} {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    bounded_batches(spark)
    return ranked.mapInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Tokenise, cut and pack whole documents: one row per piece with its place.

    A null or empty text is a piece of one id. Rows with equal ids are packed one by one; a
    null doc_id stays null. Other columns are ignored. Without documents there are no rows.
    """
    return pack_pieces(stage(tokenized_pieces(docs, tokenizer_path, end_id, capacity), "pieces"), capacity)
