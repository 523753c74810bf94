"""Delimited text scans. Everything is read as text: leading zeros survive, no
inference pass runs over the data, and typing is left to the column spec."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

CORRUPT = "_corrupt_record"


def text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def scan_delimited(spark: SparkSession, path, sep: str = ";", columns=None, file_path: bool = False,
                   keep_corrupt: bool = False) -> DataFrame:
    """Read header-first delimited files with `"` as quote and as its own escape.

    `columns` states the expected header; Spark then checks it against each file. With
    `keep_corrupt`, lines that do not fit it are kept in `_corrupt_record`.
    """
    reader = spark.read.options(sep=sep, header=True, quote='"', escape='"', inferSchema=False,
                                enforceSchema=False, mode="PERMISSIVE")
    if keep_corrupt:  # a line has to be read as a whole to see that it does not fit
        reader = reader.option("columnPruning", False)
    if columns:
        names = [*columns, CORRUPT] if keep_corrupt else list(columns)
        reader = reader.schema(text_schema(names)).option("columnNameOfCorruptRecord", CORRUPT)
    elif keep_corrupt:
        raise ValueError("keep_corrupt needs the expected columns")
    df = reader.csv(path)
    return df.select("*", "_metadata.file_path") if file_path else df


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.options(sep=sep, header=True, quote='"', escape='"').csv(path)
