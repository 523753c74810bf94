"""Straightforward variants of some operators: a cross-check for the tests and the
other side of the comparison in the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from longreg.operators import link
from longreg.operators.profile import numeric_columns

from . import fixture as fx


def cascade_by_windows(src: DataFrame, backbone: DataFrame, passes) -> DataFrame:
    """Fan-out join and one window per pass over all rows."""
    out = src.withColumn("match_pass", F.lit(None).cast("int"))
    order = [F.col("c_superseded_on").isNotNull(), F.col("c_latest_event_date").desc_nulls_last(),
             F.col("c_wave_date").desc_nulls_last(), F.col("c_row_id")]
    for i, p in enumerate(passes):
        right = backbone.select([F.col(c).alias(f"c_{c}") for c in backbone.columns])
        text = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))
        on = [text(s) == text(f"c_{b}") for s, b in p.keys]
        if not p.allow_blank:
            on += [text(s) != "" for s, _ in p.keys]
        lead = [F.col(f"c_{c}").asc_nulls_first() for c in p.prefer]
        by = W.partitionBy("row_id")
        all_on = on[0]
        for cond in on[1:]:
            all_on = all_on & cond
        joined = (out.join(right, all_on & F.col("entity_id").isNull(), "left")
                  .withColumn("_r", F.row_number().over(by.orderBy(*lead, *order)))
                  .withColumn("_one", F.min("c_entity_id").over(by) == F.max("c_entity_id").over(by))
                  .where("_r = 1"))
        take = F.col("c_entity_id").isNotNull() & (F.col("_one") if p.unique else F.lit(True))
        ids = {c: F.when(take, F.col(f"c_{c}")).otherwise(F.col(c)) for c in link.IDS}
        out = joined.select(*[ids[c].alias(c) if c in ids else F.col(c) for c in src.columns],
                            F.when(take, i + 1).otherwise(F.col("match_pass")).alias("match_pass"))
    return out


def profile_per_column(df: DataFrame) -> DataFrame:
    """One aggregate per column and statistic."""
    out = None
    for c in numeric_columns(df):
        row = df.agg(F.round(F.mean(c), 3).alias("mean")).withColumn("column", F.lit(c))
        for name, stat in (("median", F.median(c)), ("stddev", F.stddev(c)), ("skewness", F.skewness(c))):
            row = row.join(df.agg(F.round(stat, 3).alias(name)).withColumn("column", F.lit(c)), "column")
        out = row if out is None else out.unionByName(row)
    return out


def _cascade(spark, sf):
    return cascade_by_windows(fx.wave(spark, sf, fx.WAVE_2), fx.backbone(spark, sf), fx.PASSES_8).select(
        "row_id", *link.IDS, "match_pass")


def _profile(spark, sf):
    return profile_per_column(fx.table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_linenumber"))


VARIANTS = {"match_cascade_8_one_join_per_pass": _cascade, "profile_numeric_one_job_per_statistic": _profile}
