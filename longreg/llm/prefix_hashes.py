"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, modulo two primes, the polynomial of its first i code points
for every i. The hash of any span is the difference of two entries over a power of the base, so
spans are compared in constant time, and the longest common extension from two places is found
by binary search.

A fingerprint samples the prefix array: the text is cut where the hash of a short window is a
multiple of the wanted length, so that cuts move with the text, and the fingerprint lists length
and hash of each segment. From these, spans from cut to cut of two fingerprints are compared as those
of texts are. The cuts are made at two resolutions, chosen by length, so that texts of up to
twice the length have one in common. The likeness of two fingerprints is the share of code points
in common runs of segments.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from longreg.sources.tables import stage

from .common import bounded_batches, packed

#: The two largest primes below 2^31, whose residues multiply within 64 bits, and bases.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (911_382_323, 972_663_749)
INVERSES = tuple(pow(b, -1, p) for b, p in zip(BASES, PRIMES))
#: A fingerprint's finer resolution makes segments of 1/32 to 1/16 of the text, of this length at least.
SEGMENTS, SHORTEST = 32, 4
#: Shorter common runs count as chance, unless they make up a quarter of the shorter text.
LEAST_RUN = 12
KEPT = 1 << 16


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out[:n]


@functools.lru_cache(maxsize=8)
def _kept_powers(base: int, prime: int) -> np.ndarray:
    return _powers(base, prime, KEPT)


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo prime; those of long texts are not kept."""
    return _kept_powers(base, prime)[:n] if n <= KEPT else _powers(base, prime, n)


class PrefixHashes:
    """Prefix arrays of a text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
        self.n = len(codes)
        self.sums = []
        for base, prime in zip(BASES, PRIMES):
            sums = np.zeros(self.n + 1, np.int64)
            np.cumsum(codes * powers(base, prime, self.n) % prime, out=sums[1:])
            sums %= prime
            self.sums.append(sums)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Hash of the code points from start to end, wherever they lie."""
        first, second = ((int(s[end]) - int(s[start])) * pow(i, start, p) % p for s, i, p in zip(self.sums, INVERSES, PRIMES))
        return first, second

    def spans(self, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
        prime, sums = PRIMES[which], self.sums[which]
        return (sums[ends] - sums[starts]) % prime * powers(INVERSES[which], prime, self.n + 1)[starts] % prime

    def same(self, start: int, other: PrefixHashes, place: int, length: int) -> bool:
        return self.span(start, start + length) == other.span(place, place + length)

    def common_extension(self, other: PrefixHashes, start: int = 0, place: int = 0) -> int:
        """Number of code points that agree from start here and place there on."""
        low, high = 0, min(self.n - start, other.n - place)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(start + low, other, place + low, middle - low):
                low = middle
            else:
                high = middle - 1
        return low


def resolution(n: int) -> int:
    """Wanted length of a segment: a power of two, at least 1/32 and less than 1/16 of the text."""
    unit = SHORTEST
    while unit * SEGMENTS < n:
        unit *= 2
    return unit


def cuts(hashes: PrefixHashes, unit: int) -> list[int]:
    """Ends of the segments. A cut is made where the window's hash is a multiple of unit, half a
    unit after the last cut at the earliest and four units after it at the latest."""
    window = min(max(SHORTEST, unit // 4), 32)
    starts = np.arange(max(hashes.n - window + 1, 0))
    hits = np.flatnonzero(hashes.spans(starts, starts + window, 0) % unit == 0) if len(starts) else starts
    out, last = [], 0
    while True:
        k = int(np.searchsorted(hits, last + max(unit // 2, 1)))
        last = min(int(hits[k]) if k < len(hits) else hashes.n, last + 4 * unit)
        if last >= hashes.n:
            return [*out, hashes.n] if hashes.n else []
        out.append(last)


class Segments:
    """Segments of one resolution, and the prefix array sampled at their ends."""

    def __init__(self, lengths: list[int], hashes: list[tuple[int, int]], sums: list[tuple[int, int]] | None = None):
        self.keys = [(n, *h) for n, h in zip(lengths, hashes)]
        self.ends, self.places = [0, *accumulate(lengths)], {}
        for k, key in enumerate(self.keys):
            self.places.setdefault(key, []).append(k)
        self.sums = sums or self._sums()

    def _sums(self) -> list[tuple[int, int]]:
        """The text's prefix array at the ends, from the segments alone."""
        sums = [(0, 0)]
        for (_, *hashed), at in zip(self.keys, self.ends):
            sums.append(tuple((s + h * pow(b, at, p)) % p for s, h, b, p in zip(sums[-1], hashed, BASES, PRIMES)))
        return sums

    def same(self, i: int, other: Segments, j: int, count: int) -> bool:
        """Equal lengths and hashes of `count` segments from i here and from j there."""
        a, b, c, d = self.ends[i], self.ends[i + count], other.ends[j], other.ends[j + count]
        return b - a == d - c and all(
            (self.sums[i + count][m] - self.sums[i][m]) * pow(base, c, p) % p == (other.sums[j + count][m] - other.sums[j][m]) * pow(base, a, p) % p
            for m, (base, p) in enumerate(zip(BASES, PRIMES)))

    def common_run(self, i: int, other: Segments, j: int) -> int:
        """Number of segments that agree from i here and j there on, by binary search."""
        low, high = 0, min(len(self.keys) - i, len(other.keys) - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def covered(self, other: Segments) -> int:
        """Code points of this text in runs that the other has too, longest runs from the left."""
        i = total = 0
        least = min(LEAST_RUN, self.ends[-1] // 4, other.ends[-1] // 4)
        while i < len(self.keys):
            run = max((self.common_run(i, other, j) for j in other.places.get(self.keys[i], ())), default=0)
            length = self.ends[i + run] - self.ends[i]
            total += length if length >= least else 0
            i += max(run, 1)
        return total


class Fingerprint:
    """Length, hash and segments of a text. `str` gives its text form, `parse` reads it."""

    def __init__(self, n: int, whole: tuple[int, int], segments: dict[int, Segments]):
        self.n, self.whole, self.segments = n, whole, segments

    @classmethod
    def of(cls, hashes: PrefixHashes) -> Fingerprint:
        finer, segments = resolution(hashes.n), {}
        for unit in (finer, 2 * finer):
            ends = np.array(cuts(hashes, unit), np.int64)
            starts = np.concatenate([np.zeros(min(len(ends), 1), np.int64), ends[:-1]])
            found = [hashes.spans(starts, ends, m).tolist() for m in range(2)]
            sums = list(zip(*(s[np.concatenate([[0], ends])].tolist() for s in hashes.sums)))
            segments[unit] = Segments((ends - starts).tolist(), list(zip(*found)), sums)
        return cls(hashes.n, hashes.span(0, hashes.n), segments)

    def __str__(self) -> str:
        lists = [f"{unit}:" + ",".join(f"{n:x}.{a << 31 | b:x}" for n, a, b in s.keys) for unit, s in self.segments.items()]
        return "|".join([f"{self.n}:{self.whole[0] << 31 | self.whole[1]:016x}", *lists])

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        split = lambda h: (int(h, 16) >> 31, int(h, 16) & (1 << 31) - 1)
        head, *lists = text.split("|")
        segments = {}
        for part in lists:
            unit, _, listed = part.partition(":")
            pairs = [s.split(".") for s in listed.split(",")] if listed else []
            segments[int(unit)] = Segments([int(n, 16) for n, _ in pairs], [split(h) for _, h in pairs])
        n, _, whole = head.partition(":")
        return cls(int(n), split(whole), segments)

    def likeness(self, other: Fingerprint) -> float:
        """Share of code points of both texts that lie in common runs: 1 for equal texts, also
        empty ones, 0 where lengths differ so much that the texts share no resolution."""
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        shared = min(set(self.segments) & set(other.segments), default=None)
        if shared is None:
            return 0.0
        mine, theirs = self.segments[shared], other.segments[shared]
        return (mine.covered(theirs) + theirs.covered(mine)) / (self.n + other.n)


def fingerprint_text(text: str | None) -> str:
    return str(Fingerprint.of(PrefixHashes(text or "")))


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """Adds fingerprint to documents, replacing a column of that name; null texts count as empty."""
    bounded_batches(docs.sparkSession)
    made = F.pandas_udf(lambda texts: texts.map(fingerprint_text), "string")
    return packed(docs.drop("fingerprint"), "text").select("_row.*", made(F.coalesce("text", F.lit(""))).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two columns of fingerprints, NULL where one is NULL."""

    @F.pandas_udf("double")
    def alike(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else Fingerprint.parse(x).likeness(Fingerprint.parse(y))
                          for x, y in zip(first, second)], dtype="float64")

    return alike(a, b)


class Read:
    """A text that has been read: its prefix arrays and its fingerprint, each made once."""

    def __init__(self, doc_id, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.hashes = PrefixHashes(self.text)
        self.fingerprint = Fingerprint.of(self.hashes)


def edited_text(text: str, after: str) -> str:
    """The last quarter of a text gives way to as many code points from the beginning of the next."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + after[:quarter]


def compared(doc: Read, after: Read) -> tuple:
    edited = edited_text(doc.text, after.text)
    hashes = PrefixHashes(edited)
    changed = Fingerprint.of(hashes)
    return (doc.doc_id, len(doc.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), str(doc.fingerprint), str(changed),
            doc.fingerprint.likeness(changed), doc.fingerprint.likeness(after.fingerprint),
            doc.hashes.common_extension(hashes), doc.hashes.common_extension(after.hashes))


RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "same_edited", "same_next"]
TYPES = ["long", "string", "string", "string", "double", "double", "long", "long"]


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are; one row per row
    of docs, with the columns doc_id and RESULT. same_edited and same_next are the code points in which
    the text agrees with the edited and the next text from the beginning on.

    The next document is that of the next larger doc_id (after the last: the first); null ids come
    first, and rows of one id follow each other by the digest of their text. Null texts are empty. A
    single document is its own next one.

    Texts are shuffled once, into ranges of that order, which may split the rows of one id. A task
    goes through its range with two texts in memory. Only the last document of a range meets the first
    of the next range in a second step, one row a range. In between, both fingerprints lie in one
    column, which compresses better, as they have most segments in common.
    """
    bounded_batches(docs.sparkSession)
    order = ["doc_id", "_digest", "_n"]
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"_digest": F.unhex(F.sha2("text", 256)), "_n": F.monotonically_increasing_id()})
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", F.spark_partition_id().alias("_range"))  # text: pandas turns integers beside nulls into doubles
    prints = ["fingerprint", "edited_fingerprint"]
    made = ", ".join([f"{n} {t}" for n, t in zip(RESULT, TYPES) if n not in prints] + ["_prints string"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", *RESULT]

    def joined(rows: list[tuple], place=None, first=None, last=None) -> pd.DataFrame:
        shorter = [(*r[:3], None if r[3] is None else f"{r[3]} {r[4]}", *r[5:], place, first, last) for r in rows]
        names = [*columns[:3], "_prints", *columns[5:], "_range", "_first", "_last"]
        return pd.DataFrame(shorter, columns=names, dtype=object)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = before = where = None
        for batch in batches:
            rows = []
            for doc_id, text, place in zip(batch["doc_id"], batch["text"], batch["_range"]):
                here = Read(None if pd.isna(doc_id) else doc_id, text)
                if before is None:
                    first, where = here.text, place
                else:
                    rows.append(compared(before, here))
                before = here
            yield joined(rows)
        if before is not None:
            yield joined([(before.doc_id, *[None] * len(RESULT))], where, first, before.text)

    walked = stage(ranges.mapInPandas(walk, f"doc_id string, {made}, _range int, _first string, _last string"), "fingerprints")
    ends = walked.where("_range is not null")
    every = Window.orderBy("_range")  # one number a range
    follow = ends.select("_range").withColumn("_next", F.coalesce(F.lead("_range").over(every), F.first("_range").over(every)))
    meet = (ends.select("doc_id", "_range", "_last").join(follow, "_range")
            .join(ends.select(F.col("_range").alias("_next"), F.col("_first").alias("_after")), "_next"))

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["doc_id"], batch["_last"], batch["_after"])
            found = joined([compared(Read(None if pd.isna(d) else d, a), Read(None, b)) for d, a, b in rows])
            yield found.drop(columns=["_range", "_first", "_last"])

    closed = meet.select("doc_id", "_last", "_after").mapInPandas(close, f"doc_id string, {made}")
    whole = walked.where("_range is null").select(*closed.columns).unionByName(closed).withColumn("doc_id", F.col("doc_id").cast(id_type))
    return whole.withColumns({n: F.split_part("_prints", F.lit(" "), F.lit(i)) for i, n in enumerate(prints, 1)}).select(*columns)
