"""Choosing documents that look like a target: importance resampling on hashed n-grams.

Texts are read as UTF-8. A table of 256 bytes lower-cases A-Z and blanks the other ASCII bytes
that are no letters or digits; what is left splits into words. The crc32 of a run of words goes
on from that of the run without its last word, so a run of any length costs one word's bytes.
Features are hashed into buckets, counted by task and added up; the gain of a bucket is the
log ratio of its smoothed shares in target and documents. A document's weight is the sum of
its features' gains; with Gumbel noise added, the highest scores are a sample without replacement
by these weights.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from longreg.sources.tables import stage

from .common import bounded_batches

BUCKETS = 10_000
LONGEST = 3
#: Bytes of a long text that are split into words at once.
PIECE = 1 << 20
#: Fixed rule: letters and digits stay, A-Z in lower case, and all bytes of other scripts.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_lists(text: bytes | None, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    data, start = (text or b"").translate(TABLE), 0
    while start < len(data):
        end = start + piece
        if end < len(data):
            blank = data.rfind(b" ", start, end)
            blank = blank if blank > start else data.find(b" ", end)
            end = blank if blank > start else len(data)
        yield data[start:end].split()
        start = end


def buckets_of(text: bytes | None, piece: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs that end in them), list by list: runs of up to LONGEST words.
    Runs go on over the end of a list: the last words of the one before are seen again."""
    tail: list[bytes] = []
    for words in word_lists(text, piece):
        seen, new = [*tail, *words], len(words)
        spaced = [b" " + w for w in seen]
        found, runs = [], list(map(crc32, seen))
        for length in range(1, LONGEST + 1):
            if length > 1:
                runs = list(map(crc32, spaced[length - 1:], runs))
            found += runs[max(len(runs) - new, 0):]
        yield new, np.array(found, np.uint32) % BUCKETS
        tail = seen[1 - LONGEST:]


def feature_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n) of the column text: one counter a task, at most BUCKETS rows of each are shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                for _, buckets in buckets_of(text):
                    counts.update(buckets.tolist())
        yield pd.DataFrame({"bucket": np.fromiter(counts.keys(), np.int32, len(counts)), "n": np.fromiter(counts.values(), np.int64, len(counts))})

    binary = texts.select(F.col("text").cast("binary").alias("text"))
    return binary.mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, by bucket; in doubles."""
    size, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_raw + size) / ((float(s) + 1) * (all_target + size))))
                     for s, t in zip(raw, target)], np.int64)


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gains of all BUCKETS buckets, from all rows of both tables."""
    both = (feature_counts(docs).withColumn("_of", F.lit(0)).unionByName(feature_counts(target).withColumn("_of", F.lit(1))))
    counts = np.zeros((2, BUCKETS), np.int64)
    for row in both.collect():  # at most two rows a bucket
        counts[row["_of"], row["bucket"]] = row["n"]
    return gains(*counts)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; a null text has no words."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = features = weight = 0
            for new, buckets in buckets_of(text):
                words, features, weight = words + new, features + len(buckets), weight + int(gain[buckets].sum())
            rows.append((words, features, weight))
        return pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    return docs.select("doc_id", weigh(F.col("text").cast("binary")).alias("_w")).select("doc_id", "_w.*")


def gumbel(doc_id: str, seed: int) -> Column:
    """floor(1000 times a Gumbel number) from the hash of seed and id; a null id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def with_rank(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds rank, from 1 in `order`, without a task that sees all rows: rows are dealt by ranges of
    the order, ranked in their range, and ranges are shifted by what lies before them. `order` has
    to end in a column that differs from row to row, so that any range can be split."""
    ranges = stage(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    shift = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (ranges.withColumn("_own", own).join(shift.drop("_rows"), "_range")
            .withColumn("rank", F.col("_own") + F.col("_before")).drop("_own", "_before", "_range"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs.

    Of the N rows with at least `least_words` words, the floor(percent * N / 100) highest scores
    are drawn and ranked from 1, ties to the smaller doc_id (null last, then fewer features); the
    others have no rank. Null texts have no words, features and weight 0. Rows with equal ids are
    documents of their own with equal noise. Without target, gains are those of an empty target.

    A sketch's bound, 1 % of the rows too low and checked by counting, keeps most rows out of the
    ranking; should it be too high, all are ranked.
    """
    bounded_batches(docs.sparkSession)
    scored = weighed(docs, bucket_gains(docs, target)).withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    rows = stage(scored.withColumn("_n", F.monotonically_increasing_id()), "importance")
    long = F.col("n_words") >= least_words
    n, bound = rows.where(long).agg(F.count(F.lit(1)), F.percentile_approx("score", max(0.0, 0.99 - percent / 100), 1000)).first()
    draw = percent * n // 100
    near = long if bound is None else long & (F.col("score") >= bound)
    if rows.where(near).count() < draw:
        near = long
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("_n")]
    ranked = with_rank(rows.where(near), order).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, F.col("rank").cast("long")).unionByName(rows.where(~near).select(*columns, F.lit(None).cast("long").alias("rank")))
