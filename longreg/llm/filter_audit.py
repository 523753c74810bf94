"""What every order of a set of filters removes, counted with wide packed integers.

A document's mask has one bit per filter that it fails. From the mask, and from whether the
document is good or toxic, follows all that happens to it in every order of the filters: kept,
removed or removed before, at each step. For every mask this is written into one big integer,
a field of 64 bits per order, step and count. Multiplied by the documents that have the mask and
added up per part, the integers hold all counts at once. A field never exceeds the documents of
its part, which are fewer than 2^63, so no field runs over into the next, and the sum is
unpacked by reading its bytes.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from longreg.operators.skew import attach_group_values, lookup_join
from longreg.sources.tables import stage

from .common import bounded_batches

LETTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARKS = re.compile(rb"[#$%&*|]")


def text_mask(text: bytes | None, n_chars: int | None) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails; null is the empty text."""
    text = text or b""
    words = text.split()
    few, dull = len(words) < 200, 100 * len(set(words)) < 50 * len(words)
    loud = 100 * (len(text) - len(text.translate(None, UPPER))) > 3 * (n_chars or 0)
    return few | dull << 1 | loud << 2 | bool(MARKS.search(text)) << 3


def text_masks(text: Column | str) -> Column:
    @F.pandas_udf("int")
    def mask(texts: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([text_mask(t, n) for t, n in zip(texts, sizes)], dtype="int32")

    column = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return mask(column.cast("binary"), F.length(column))


@functools.lru_cache(maxsize=4)
def steps(letters: str) -> tuple[list[str], np.ndarray]:
    """All orders of the letters, and the index of the filter at each (order, step)."""
    orders = ["".join(order) for order in permutations(letters)]
    return orders, np.array([[letters.index(c) for c in order] for order in orders])


def outcomes(letters: str, mask: int, good: bool, toxic: bool) -> np.ndarray:
    """(order, step, count) of 0 and 1: what happens to one document of this mask."""
    at = steps(letters)[1]
    fails = (mask >> at) & 1
    before = np.cumsum(fails, axis=1) - fails
    removed = fails * (before == 0)
    alone = np.broadcast_to(np.array([mask == 1 << i for i in range(len(letters))])[at], at.shape)
    return np.stack([(before + fails) == 0, removed, fails * (before > 0), alone, removed * good, removed * toxic], axis=2)


@functools.lru_cache(maxsize=None)  # four per mask
def packed_outcomes(letters: str, mask: int, good: bool, toxic: bool) -> int:
    return int.from_bytes(outcomes(letters, mask, good, toxic).astype("<u8").tobytes(), "little")


def unpacked(total: int, letters: str) -> np.ndarray:
    shape = (*steps(letters)[1].shape, len(COUNTS))
    return np.frombuffer(total.to_bytes(8 * int(np.prod(shape)), "little"), "<u8").reshape(shape).astype(np.int64)


def audit_rows(counted: Iterable[tuple[int, bool, bool, int]], letters: str) -> pd.DataFrame:
    """The audit of one part from (mask, good, toxic, documents)."""
    table = unpacked(sum(packed_outcomes(letters, m, g, t) * n for m, g, t, n in counted), letters)
    orders, at = steps(letters)
    shares = np.zeros(len(letters), np.int64)
    np.add.at(shares, at, table[:, :, COUNTS.index("removed")])
    flat = table.reshape(-1, len(COUNTS))
    return pd.DataFrame({"filter_order": np.repeat(orders, len(letters)),
                         "step": np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders)),
                         **{c: flat[:, i] for i, c in enumerate(COUNTS)}, "shapley": shares[at].ravel()})


def audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Audit of (part, mask, good, toxic), one row per document: for every part, order of the
    letters and step, the documents kept after it, removed by it, failing its filter but removed
    before, and failing its filter only; the good and the toxic that it removes; and what its filter
    removes summed over all orders. Steps that remove nothing have their row; no rows in, none out.

    Documents are counted by mask before anything is shuffled, so a part brings at most four rows
    per mask to the task that adds its integers.
    """
    counted = masks.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    schema = ", ".join(["part string, filter_order string, step int", *[f"{c} long" for c in (*COUNTS, "shapley")]])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        found = audit_rows(((int(r.mask), bool(r.good), bool(r.toxic), int(r.n)) for r in rows.itertuples()), letters)
        found.insert(0, "part", rows["part"].iloc[0])
        return found

    return counted.groupBy("part").applyInPandas(add, schema)


def failure_masks(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic) of every document, for the filters A to E.

    Filter E fails texts that a smaller doc_id has as well, whatever other filters do. Null texts
    are empty, null parts the empty string. Rows are documents, also with equal ids; a row without
    id is no copy of another and has no label. Of several labels of an id any that says so counts.
    Equal texts are looked up by digest through pre-aggregated, salted groups, as one text may be a
    large share of all rows.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = stage(docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_masks(text).alias("_mask"),
                             F.unhex(F.sha2(text, 256)).alias("_digest"), F.monotonically_increasing_id().alias("_n")), "filter-masks")
    firsts = attach_group_values(rows, ["_digest"], [F.min("doc_id").alias("_first")], spread=["_n"])
    copy = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))
    marks = labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"),
                                         F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic")).where("_good or _toxic")
    marked = lookup_join(firsts.withColumn("mask", F.col("_mask") + copy.cast("int") * 16), marks, ["doc_id"], spread=["_n"])
    return marked.select("part", "mask", F.coalesce("_good", F.lit(False)).alias("good"), F.coalesce("_toxic", F.lit(False)).alias("toxic"))
