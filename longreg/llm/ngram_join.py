"""Exact Jaccard self-join of documents on word n-grams by vertical partitioning.

All n-grams have one global order, that of their 64-bit hashes. It is cut into fragments, and
every document's set is cut with it. For sets of like size, a similarity of at least t leaves
at most D n-grams that only one of two documents has. With D + m fragments in which either has
n-grams, m fragments are the same in both. So documents meet under the hashes of their
fragments, not of single n-grams, and those that have less than m fragments in common with many
others need not be compared for these: a phrase that many documents share does not make them
meet. Pairs that met are compared by their profiles first, the number of n-grams in each
of many narrow fragments: profiles differ by no more than the sets do, so no link is lost.
The rest are counted exactly: partial overlaps fragment by fragment, then their sum per pair.

Links are asked for as connected groups, so documents that met need not all be paired. Those
that met under a key of a few are; under a key of many, one is paired with each first. Only
what that leaves unconnected is searched for pairs in full, in the order that lets the fewest
meet.
"""

from __future__ import annotations

import bisect
import functools
import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from longreg.sources.tables import stage

from .common import bounded_batches, packed, words_of
from .components import connected_components

#: Ratio of the largest to the smallest set that are cut into as many fragments.
SPAN = 1.5
#: Expected n-grams in a fragment when overlaps are counted.
COUNTED = 256
#: Bits of the filter that keeps fragments which only one document has out of a shuffle. Its
#: size is fixed; when it is full it keeps nothing out, and results are the same.
FILTER_BITS = 1 << 26
#: 64-bit words of the filter in one row.
BLOCK = 1 << 12
LARGEST = 1 << 40
#: Documents that meet under one key are all paired if they are no more than this.
FEW = 32
#: Keys that two similar sets share at least, if they have as many n-grams in common.
AGREE = 5
#: Ratio of neighbouring steps of set sizes.
STEP = 1.02


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (multiply and shift twice)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E6C63D0676A9A99)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E6D62D06F6A9A9B)
    return x ^ (x >> np.uint64(32))


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """The sorted hashes of a text's distinct word n-grams. Fewer words are one gram together."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(n, len(h))
    grams = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        grams = _mixed(grams ^ h[i:len(h) - n + 1 + i]) * np.uint64(3)
    return np.unique(grams)


class Cut:
    """How sets are cut for a similarity of at least num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.starts, self.rules = num, den, [1], []
        # Two different sets that are similar have num / (den - num) n-grams in common at least.
        self.agree = max(1, min(AGREE, num // (den - num))) if num < den else AGREE
        while self.starts[-1] < LARGEST:
            low = self.starts[-1]
            high = max(low + 1, int(low * SPAN))
            spare = ((high - 1) * (den - num)) // num  # most n-grams that only one of two sets has
            # Fragments may be empty in both sets. Some more fragments make up for that; a
            # set with more empty ones than spared for also meets others by its first n-grams.
            empty = 0
            for _ in range(4):
                fragments = spare + self.agree + empty
                expected = fragments * (1 - 1 / fragments) ** low
                empty = int(expected + 2 * expected ** 0.5) + (spare > 0)
            self.starts.append(high)
            self.rules.append((spare + self.agree + empty, empty))

    def spans_of(self, size: int) -> range:
        """The spans under which a set meets others: those of the smaller set of any pair."""
        least = -(-size * self.num // self.den)
        return range(bisect.bisect_right(self.starts, least) - 1, bisect.bisect_right(self.starts, size))

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """Keys of which two different sets share `agree` at least if they are similar enough."""
        found, size = [], len(grams)
        for span in self.spans_of(size) if size else ():
            fragments, empty = self.rules[span]
            at = ((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            content = np.add.reduceat(_mixed(grams), first)
            found.append(_mixed(content ^ _mixed(at[first] * np.uint64(1 << 10) + np.uint64(span))))
            if fragments - len(first) > empty:
                prefix = size - -(-size * self.num // self.den) + self.agree
                found.append(_mixed(grams[:prefix] + np.uint64(span + 1)))
        return np.concatenate(found) if found else np.empty(0, np.uint64)


@functools.cache
def cut_for(num: int, den: int) -> Cut:
    return Cut(num, den)


def _class_of(grams: np.ndarray) -> int | None:
    """A number for the set itself, the same for equal sets."""
    if not len(grams):
        return None
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def profile(grams: np.ndarray) -> np.ndarray:
    """How many n-grams lie in each of 2^level equal parts of their order, two to four on average; at most 255."""
    level = max(0, len(grams).bit_length() - 2)
    at = grams >> np.uint64(64 - level) if level else np.zeros(len(grams), np.uint64)
    return np.minimum(np.bincount(at.astype(np.int64), minlength=1 << level), 255).astype(np.uint8)


def apart_at_least(a: np.ndarray, b: np.ndarray) -> int:
    """N-grams that only one of two sets has, by their profiles: never more than there are."""
    parts = min(len(a), len(b))
    # Counts of joined parts are held to 255 as well, so both are what the coarser profile holds.
    a, b = (np.minimum(x.reshape(parts, -1).sum(1, dtype=np.int64), 255) for x in (a, b))
    return int(np.abs(a - b).sum())


def sets_of(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, size, cls, profile) of every document."""
    bounded_batches(docs.sparkSession)

    def run(frames):
        for frame in frames:
            sets = [ngram_set(text, n) for text in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].astype("Int64"), "size": [len(s) for s in sets],
                "cls": pd.array([_class_of(s) for s in sets], "Int64"),
                "profile": [profile(s).tobytes() if len(s) else None for s in sets]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, size long, cls long, profile binary")


def _bits(values: DataFrame) -> np.ndarray:
    """A bitmap of the hashes of values (h), FILTER_BITS long whatever their number. It is put
    together in BLOCK words at a time, so the driver gets few rows and no more bytes than the bitmap has."""
    words = values.groupBy(F.floor(F.pmod("h", F.lit(FILTER_BITS)) / 64).alias("w")).agg(F.bit_or(F.expr(
        f"shiftleft(1L, cast(pmod(h, {FILTER_BITS}) % 64 as int))")).alias("bits"))

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        block = np.zeros(BLOCK, np.int64)
        at = frame["w"].to_numpy("int64")
        block[at % BLOCK] = frame["bits"].to_numpy("int64")
        return pd.DataFrame({"block": [int(at[0]) // BLOCK], "words": [block.tobytes()]})

    out = np.zeros((FILTER_BITS // 64 // BLOCK, BLOCK), np.int64)
    for row in words.groupBy(F.floor(F.col("w") / BLOCK)).applyInPandas(joined, "block long, words binary").collect():
        out[row.block] = np.frombuffer(row.words, np.int64)
    return out.ravel()


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = np.asarray(hashes, np.int64) % FILTER_BITS
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def _keys(docs: DataFrame, n: int, num: int, den: int, among: np.ndarray | None = None) -> DataFrame:
    """(cls, size, key) of every document's keys, or of those that the bitmap has.

    Keys are as many bytes as the texts, so they are made anew where they are wanted and not stored.
    """
    spark = docs.sparkSession
    bits = None if among is None else spark.sparkContext.broadcast(among)
    bounded_batches(spark)

    def run(frames):
        cut = cut_for(num, den)
        for frame in frames:
            rows = {}
            for text in frame["text"]:
                grams = ngram_set(text, n)
                cls = _class_of(grams)
                if cls is not None and cls not in rows:  # equal sets have equal keys
                    keys = np.unique(cut.keys(grams)).view(np.int64)
                    rows[cls] = (cls, len(grams), keys if bits is None else keys[_has(bits.value, keys)])
            yield pd.DataFrame(list(rows.values()), columns=["cls", "size", "keys"])

    made = docs.select("text").mapInPandas(run, "cls long, size long, keys array<long>")
    return made.select("cls", "size", F.explode("keys").alias("key"))


def _met(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(key, cls, size, classes) of the classes that share a key with another class, of so many."""
    shared = stage(_keys(docs, n, num, den).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared-keys")
    likely = _keys(docs, n, num, den, _bits(shared.select(F.col("key").alias("h"))))
    held = stage(likely.groupBy("key", "cls").agg(F.max("size").alias("size")), "held-keys")
    several = held.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    return stage(held.join(several, "key"), "met")


def _level(size: Column) -> Column:
    """2^level fragments are counted apart for sets of this size."""
    return F.greatest(F.lit(0), F.ceil(F.log2(size / COUNTED))).cast("int")


def _counted_sets(docs: DataFrame, members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(cls, level, fragment, grams): the sets of the classes in members (doc_id, cls), cut for
    counting at the levels at which they may be paired."""
    spark = docs.sparkSession
    wanted = stage(members.select(F.col("doc_id").alias("_d"), F.col("cls").alias("_c")), "counted-ids")
    bits = spark.sparkContext.broadcast(_bits(wanted.select(F.xxhash64("_d").alias("h"))))

    @F.pandas_udf("boolean")
    def likely(hashes: pd.Series) -> pd.Series:
        return pd.Series(_has(bits.value, hashes.to_numpy()))

    texts = docs.where(likely(F.xxhash64("doc_id"))).select("doc_id", "text").join(
        wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_d"))).select("_c", "text")
    bounded_batches(spark)

    def run(frames):
        for frame in frames:
            rows = []
            for cls, text in zip(frame["_c"], frame["text"]):
                grams = ngram_set(text, n)
                if _class_of(grams) != cls:  # another row with this id
                    continue
                smallest = -(-len(grams) * num // den)
                for level in {max(0, int(np.ceil(np.log2(s / COUNTED)))) for s in (len(grams), smallest)}:
                    at = grams >> np.uint64(64 - level) if level else np.zeros(len(grams), np.uint64)
                    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    rows += [(cls, level, int(at[i]), part.view(np.int64))
                             for i, part in zip(first, np.split(grams, first[1:]))]
            yield pd.DataFrame(rows, columns=["cls", "level", "fragment", "grams"]).astype(
                {"cls": "int64", "level": "int32", "fragment": "int64"})

    cut = texts.mapInPandas(run, "cls long, level int, fragment long, grams array<long>")
    return stage(cut.dropDuplicates(["cls", "level", "fragment"]), "counted-sets")


def _likely(pairs: DataFrame, profiles: DataFrame, num: int, den: int) -> DataFrame:
    """Those of pairs (a, size_a, b, size_b) that sizes and profiles (cls, profile) leave possible, once each."""
    close = (F.least("size_a", "size_b") * den >= F.greatest("size_a", "size_b") * num)

    @F.pandas_udf("long")
    def apart(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([apart_at_least(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) for x, y in zip(a, b)], dtype="int64")

    of = lambda side: profiles.select(F.col("cls").alias(side), F.col("profile").alias(f"profile_{side}"))
    known = pairs.where(close).distinct().join(of("a"), "a").join(of("b"), "b")
    both = F.col("size_a") + F.col("size_b")
    possible = (both - apart("profile_a", "profile_b")) * (num + den) >= 2 * both * num
    return known.where(possible).select("a", "size_a", "b", "size_b")


def _links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of pairs (a, size_a, b, size_b) that are similar enough.

    Every fragment's overlap is counted on its own; a pair's are added up.
    """
    pairs = pairs.withColumn("level", _level(F.least("size_a", "size_b")))
    left = sets.select(F.col("cls").alias("a"), "level", "fragment", F.col("grams").alias("grams_a"))
    right = sets.select(F.col("cls").alias("b"), "level", "fragment", F.col("grams").alias("grams_b"))
    partial = pairs.join(left, ["a", "level"]).join(right, ["b", "level", "fragment"]).select(
        "a", "b", "size_a", "size_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("part"))
    common = F.sum("part")
    return (partial.groupBy("a", "b", "size_a", "size_b").agg(common.alias("common"))
            .where(F.col("common") * den >= (F.col("size_a") + F.col("size_b") - F.col("common")) * num).select("a", "b"))


def _still_apart(met: DataFrame, joined: DataFrame) -> DataFrame:
    """Those of met whose key holds several of the components so far (node, component), with label."""
    labels = joined.select(F.col("node").alias("cls"), F.col("component").alias("label"))
    labelled = met.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    apart = labelled.groupBy("key").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b").select("key")
    return stage(labelled.join(apart, "key"), "apart")


def _under_many(met: DataFrame, agree: int) -> tuple[DataFrame, DataFrame]:
    """(few, many): met for keys of more than FEW classes, without classes that have less than `agree` such
    keys. Similar classes that share only such keys share as many of them, so the others need no search here.
    few is for keys that have no more than FEW classes now."""
    # A class has no more keys than its text is long, so a window holds them.
    held = F.count(F.lit(1)).over(Window.partitionBy("cls"))
    enough = lambda rows: rows.withColumn("_n", held).where(F.col("_n") >= agree).drop("_n")
    kept = enough(met.where(F.col("classes") > FEW)).drop("classes")
    left = kept.groupBy("key").agg(F.count(F.lit(1)).alias("classes"))
    again = stage(kept.join(left, "key"), "met-again")
    return again.where(F.col("classes") <= FEW), stage(enough(again.where(F.col("classes") > FEW)), "met-many")


def _within_few(met: DataFrame) -> DataFrame:
    """All pairs of classes that share a key which few have."""
    few = met.where(F.col("classes") <= FEW)
    a, b = (few.select("key", F.col("cls").alias(c), F.col("size").alias(f"size_{c}")) for c in "ab")
    return a.join(b, "key").where("a < b").select("a", "size_a", "b", "size_b")


def _to_central(met: DataFrame) -> DataFrame:
    """Pairs of every class with the class of each of its keys that meets most others.

    Copies that differ from their original in several places each may not be similar to one
    another, but the original is to all of them, and it shares most keys.
    """
    meets = F.sum("classes").over(Window.partitionBy("cls"))
    one = met.withColumn("meets", meets).groupBy("key").agg(F.max(F.struct("meets", "cls", "size")).alias("o"))
    a, b = F.struct("cls", "size"), F.struct("o.cls", "o.size")
    pair = F.struct(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))
    return met.join(one, "key").where(F.col("cls") != F.col("o.cls")).select(pair.alias("p")).select(
        F.col("p.x.cls").alias("a"), F.col("p.x.size").alias("size_a"), F.col("p.y.cls").alias("b"), F.col("p.y.size").alias("size_b"))


def _across(apart: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of unconnected classes that may be similar.

    Here the n-grams are ordered by how few classes have them. Two sets of given sizes need so
    many n-grams in common that one of them is among the first few of both. A copy's own
    changes come first in this order, so copies of one text that differ in too much from one
    another do not meet. The first few are fewer the more is known of the other's size, so
    they are taken per step of its size.
    """
    members = apart.groupBy("cls").agg(F.max("size").alias("size"), F.max("label").alias("label"))
    grams = members.join(sets, "cls").where(F.col("level") == _level(F.col("size"))).select(
        "cls", "size", "label", F.explode("grams").alias("gram"))
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Those that no other class has come before all of these.
    own = Window.partitionBy("cls")
    place = F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("n", "gram"))
    log_step = float(np.log(STEP))
    step = lambda size: F.floor(F.log(size) / log_step)
    others = F.explode(F.sequence(step(F.floor(F.col("size") * num / den)) - 1, step(F.ceil(F.col("size") * den / num)) + 1))
    least = F.greatest(F.ceil(F.col("size") * num / den), F.floor(F.pow(F.lit(STEP), F.col("other"))))
    first = F.col("size") - F.ceil((F.col("size") + least) * num / (num + den)) + 1
    placed = (grams.join(shared, "gram").withColumn("place", place)
              .where((F.col("place") <= F.col("size") - F.ceil(F.col("size") * num / den) + 1))
              .withColumn("own", step(F.col("size"))).withColumn("other", others).where(F.col("place") <= first))
    key = ["gram", "small", "large"]
    posted = stage(placed.select("gram", F.least("own", "other").alias("small"), F.greatest("own", "other").alias("large"),
                                 "cls", "size", "label", "place"), "postings")
    several = posted.groupBy(*key).agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b").select(*key)
    left = posted.join(several, key)
    a = left.select(*key, *[F.col(c).alias(f"{c}_a") for c in ("cls", "size", "label", "place")])
    b = left.select(*key, *[F.col(c).alias(f"{c}_b") for c in ("cls", "size", "label", "place")])
    common = F.ceil((F.col("size_a") + F.col("size_b")) * num / (num + den))
    near = (F.col("place_a") <= F.col("size_a") - common + 1) & (F.col("place_b") <= F.col("size_b") - common + 1)
    return a.join(b, key).where(near & (F.col("label_a") < F.col("label_b"))).select(
        F.col("cls_a").alias("a"), "size_a", F.col("cls_b").alias("b"), "size_b")


def _grouped(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, size, cls, component, component_id) of every row: cls is the set's own number,
    component that of its group. Both are null for rows without words."""
    base = stage(sets_of(docs, n), "ngram-sets")
    met = _met(docs, n, num, den)
    of_set = base.where("cls is not null").groupBy("cls")
    reps = of_set.agg(F.min("doc_id").alias("doc_id"))
    profiles = stage(of_set.agg(F.min("profile").alias("profile")).join(met.select("cls").distinct(), "cls"), "profiles")
    few, many = _under_many(met, cut_for(num, den).agree)
    paired = _within_few(met).unionByName(_within_few(few)).unionByName(_to_central(many))
    pairs = stage(_likely(paired, profiles, num, den), "pairs")
    counted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(many.select("cls")).distinct()
    sets = _counted_sets(docs, counted.join(reps, "cls"), n, num, den)
    joined = connected_components(_links(pairs, sets, num, den))
    apart = _still_apart(many, joined)
    if not apart.isEmpty():
        across = _likely(_across(apart, sets, num, den), profiles, num, den)
        # What is connected already goes on as links to the component's smallest class.
        known = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
        joined = connected_components(known.unionByName(_links(across, sets, num, den)))
    groups = reps.join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    least = groups.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = groups.join(least, "component").select(F.col("cls").alias("_c"), "component", "component_id")
    return base.join(of_class, F.col("cls") == F.col("_c"), "left").select(
        "doc_id", "size", "cls", "component",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def similar_groups(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, size, component_id) of every row of docs (doc_id, text).

    Documents link if den * common >= num * joint of their sets of distinct word n-grams, and
    form the connected groups of all links; component_id is a group's smallest doc_id. Null
    and empty texts link with nothing, not even each other. Rows with equal ids are rows of
    their own; a row without an id counts in its group, and its component_id is null only if
    no row of the group has an id. Columns other than these two are ignored.
    """
    return _grouped(docs, n, num, den).select("doc_id", "size", "component_id")


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each similar group, the one with the smallest id, with the columns of docs.

    Of rows with the same id in a group one stays; rows with the same id in different groups
    are decided on apart. Rows without words are groups of their own and all stay, as do rows
    without an id.
    """
    @F.pandas_udf("long")
    def class_of(texts: pd.Series) -> pd.Series:
        return pd.Series([_class_of(ngram_set(text, n)) for text in texts], dtype="Int64")

    # Else Spark moves tests of the set's number before the join, where it is made of all texts.
    class_of = class_of.asNondeterministic()
    rows = stage(_grouped(docs, n, num, den).where("doc_id is not null"), "ngram-groups")
    heads = rows.where("doc_id = component_id")
    ids = stage(rows.groupBy(F.col("doc_id").alias("_d")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("_head"))
        .where("_head").select("_d", "_rows"), "kept-ids")
    # Both parts read the same columns, so the texts are shuffled once.
    of = lambda these: packed(docs, "doc_id").join(
        ids.where(these).select("_d").hint("shuffle_hash"), F.col("doc_id") == F.col("_d")).select("_row", "doc_id")
    # An id alone does not say which of its rows is meant; the set's number does.
    several = of("_rows > 1").select("_row", "doc_id", class_of(F.col("_row")["text"]).alias("cls"))
    first = heads.where("cls is not null").groupBy("doc_id", "component").agg(F.min("cls").alias("cls")).select("doc_id", "cls")
    chosen = several.join(first, ["doc_id", "cls"]).dropDuplicates(["doc_id", "cls"])
    return (of("_rows = 1").select("_row").unionByName(chosen.select("_row"))
            .unionByName(several.where("cls is null").select("_row"))
            .select("_row.*").unionByName(docs.where("doc_id is null")))
