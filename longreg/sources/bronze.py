"""Landing zone: untouched text rows per source, wave and file, and a manifest.

The manifest has one line per landed file: what was landed, how many rows, and the header in the
order of the file. A file is read back with its own header from the manifest alone, whatever other
files of its source have, and its columns may have any name but those of the stamps.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.shape import as_date, check_uuid
from .tables import write_table

#: Stamp columns, and what the manifest calls them.
STAMPS = {"_landed_source": "source", "_landed_wave_date": "wave_date", "_landed_file_id": "file_id"}
MANIFEST = ("source string, wave_date date, file_id string, rows long, received_on date, processor string, "
            "header array<string>")


@dataclass(frozen=True)
class Landed:
    """A line of the manifest."""
    source: str
    wave_date: dt.date
    file_id: str
    rows: int
    received_on: dt.date
    processor: str
    header: list[str]


def stamp(df: DataFrame, *, source: str, wave_date, file_id: str) -> DataFrame:
    taken = [c for c in df.columns if c.lower() in STAMPS]
    if taken:
        raise ValueError(f"reserved column names: {', '.join(taken)}")
    values = (F.lit(source), F.lit(as_date(wave_date, "wave_date")), F.lit(check_uuid(file_id)))
    return df.withColumns(dict(zip(STAMPS, values)))


def manifest(stamped: DataFrame) -> DataFrame:
    """Rows per landed file."""
    return stamped.groupBy(*[F.col(s).alias(name) for s, name in STAMPS.items()]).agg(F.count(F.lit(1)).alias("rows"))


def land_bronze(df: DataFrame, path: str, *, source: str, wave_date, file_id: str,
                received_on, processor: str) -> int:
    """Add a file to bronze and a line to the manifest; landing it again replaces both. Rows
    are counted while they are written, so the manifest costs no second scan. The line comes last,
    so what has a line is there as a whole."""
    rows = write_table(stamp(df, source=source, wave_date=wave_date, file_id=file_id), f"{path}/data",
                       list(STAMPS), mode="replace")
    line = (source, as_date(wave_date, "wave_date"), check_uuid(file_id), rows, as_date(received_on, "received_on"), processor, df.columns)
    write_table(df.sparkSession.createDataFrame([line], MANIFEST).coalesce(1), f"{path}/manifest", ["file_id"], mode="replace")
    return rows


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def landed_file(spark: SparkSession, path: str, file_id: str) -> Landed:
    line = read_manifest(spark, path).where(F.col("file_id") == check_uuid(file_id)).first()
    if line is None:
        raise ValueError(f"{file_id} is not landed in {path}")
    return Landed(**line.asDict())


def landed_rows(spark: SparkSession, path: str, landed: Landed) -> DataFrame:
    """The rows of a landed file, with the columns of its own header; only its folder is read."""
    delivered = T.StructType([T.StructField(n, T.StringType()) for n in landed.header])
    if not landed.rows:
        return spark.createDataFrame([], delivered)
    schema = T.StructType([*delivered, *[T.StructField(s, T.DateType() if s.endswith("date") else T.StringType()) for s in STAMPS]])
    own = [F.col(s) == F.lit(v) for s, v in zip(STAMPS, (landed.source, landed.wave_date, landed.file_id))]
    return spark.read.schema(schema).parquet(f"{path}/data").where(own[0] & own[1] & own[2]).select(*landed.header)
