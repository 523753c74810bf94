"""Runtime settings the plans are written for. The session comes from the caller."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Join strategy, partition sizes and skew are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods over 8000 bytes; wide cleaning projections run
    # faster as several smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}

#: Settings of a session that can only be made before it starts. A job's plans have some hundred generated
#: classes; Spark keeps 100 by default, and a class that is made again is compiled and warmed up again.
STATIC_SETTINGS = {"spark.sql.codegen.cache.maxEntries": "2000"}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in STATIC_SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
