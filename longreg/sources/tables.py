"""Parquet tables: pruned scans and parallel, versioned writes."""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def scan_table(spark: SparkSession, path: str, flags=()) -> DataFrame:
    """Read a table. `flags` names partition columns that hold booleans, which Spark
    reads back as text; filters on them still prune partitions."""
    df = spark.read.parquet(path)
    return df.withColumns({f: F.col(f).cast("boolean") for f in flags}) if flags else df


def _same(a: str, b: str) -> bool:
    clean = lambda p: os.path.normpath(p.removeprefix("file://").removeprefix("file:"))
    return clean(a) == clean(b)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def releasing_shuffles(spark: SparkSession):
    """Shuffle files of a write are removed when it ends, and not when the driver next collects its garbage, so the
    disk holds those of one step at a time. Nobody reads them again: the result is the table."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def write_table(df: DataFrame, path: str, partition_by=(), mode: str = "errorifexists",
                reads=()) -> int:
    """Write in parallel, partitioned by columns; returns the rows written, counted by
    the writing job itself. A table is never written over one of its own inputs. The
    mode "replace" overwrites the partitions that `df` has rows of, and leaves the others."""
    for used in reads:
        if _same(used, path):
            raise ValueError(f"{path} is also read; write a new version instead")
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by)
    if mode == "replace":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    with releasing_shuffles(df.sparkSession):
        writer.mode(mode).parquet(path)
    return seen.get["rows"]


SHARED = "longreg.shared.folder"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the cluster names in
    `spark.checkpoint.dir`, else the one the caller named with `name_shared_folder`."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED, None)
    if not path:
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return path


def name_shared_folder(spark: SparkSession) -> SparkSession:
    """For sessions in one JVM (tests, benchmarks) that name no folder: use one beside the
    warehouse. A cluster has to name its own, so there nothing is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED, None)
    if not named and spark.sparkContext.master.startswith("local["):
        spark.conf.set(SHARED, os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "stage"))
    return spark


def stage(df: DataFrame, name: str, partition_by=()) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the table.

    Linkage reads its inputs several times; staging evaluates the text cleaning once,
    prunes later scans to their columns, and survives the loss of executors.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4()}")
    with releasing_shuffles(spark):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
