"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Hashable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Words are runs of anything but ASCII white space, the bytes on which bytes.split() splits.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get batches of at most 1000 rows and, but for a single longer row, 16 MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def packed(docs: DataFrame, *keys: str) -> DataFrame:
    """Rows as one column _row, beside the columns that an operator needs, so that no other
    column's name can clash with the operator's own. `select("_row.*")` unpacks them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *keys)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def words_of(text: str | None) -> list[bytes]:
    """A text's words, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Memo(dict):
    """A memo of bounded size: `memo[key]` computes what it does not hold. Entries not used
    while `size` others came in are forgotten, so frequent keys stay."""

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key: Hashable):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def lookup(memo: Memo, words: list[bytes], dtype) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), dtype, len(words))


class Steps:
    """An array of structs to which fields are added step by step, so that a later field refers
    to an earlier one by name instead of repeating how it is made."""

    def __init__(self, array: Column, fields: tuple[str, ...]):
        self.array, self.fields = array, fields

    def add(self, **made) -> Steps:
        kept = self.fields
        array = F.transform(self.array, lambda c: F.struct(
            *[c[f].alias(f) for f in kept], *[make(c).alias(name) for name, make in made.items()]))
        return Steps(array, (*kept, *made))
