"""Data dictionaries (JSON) and codebooks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = (
    "study struct<title:string,id:string,producer:string,abstract:string,license_terms:string>, "
    "columns map<string, struct<description:string,values:map<string,string>>>"
)


def load_dictionary(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(study, columns, labels) of a dictionary: the study block, one row per column
    with its description, one row per documented value with its label."""
    return dictionary_tables(spark.read.schema(SCHEMA).json(path, multiLine=True))


def parse_dictionary(texts: DataFrame, column: str = "text"):
    """The same from a column of JSON documents."""
    return dictionary_tables(texts.select(F.from_json(column, SCHEMA).alias("d")).select("d.*"))


def dictionary_tables(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    entries = raw.select(F.explode("columns").alias("column", "entry"))
    columns = entries.select("column", F.col("entry.description").alias("description"))
    labels = entries.select("column", F.explode("entry.values").alias("value", "label"))
    return raw.select("study.*"), columns, labels


def codebook(profile: DataFrame, columns: DataFrame, labels: DataFrame) -> DataFrame:
    """One record per variable: name, label, type, categories and statistics."""
    # Categories come from the dictionary, so a column's list is bounded by its length.
    categories = (labels.groupBy("column")
                  .agg(F.sort_array(F.collect_list(F.struct("value", "label"))).alias("categories")))
    return (profile.join(columns, "column", "left").join(categories, "column", "left")
            .select("position", F.col("column").alias("name"),
                    F.coalesce("description", F.lit("No description provided")).alias("label"),
                    "type", "categories", "mean", "median", "stddev", "skewness",
                    F.col("distinct_count").cast("long").alias("distinct_count"), "null_count"))


def write_records(records: DataFrame, path: str, tag: str, format: str = "xml") -> None:
    """Write records as xml (one element `tag` per record), json or parquet."""
    if format == "xml":
        records.write.format("xml").option("rootTag", "codeBook").option("rowTag", tag).save(path)
    else:
        records.write.format(format).save(path)


def write_codebook(book: DataFrame, path: str, format: str = "xml") -> None:
    """Write a codebook as xml (one <var> per variable), json or parquet."""
    write_records(book.sortWithinPartitions("position"), path, "var", format)
