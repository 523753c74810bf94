"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR is the data (default sf0.1), BENCH_CPUS the cores. Every query runs in full
into a sink that discards its rows, once to warm up and then twice; the best counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from longreg.session import configured, tune

HEADLINE = ("standardise_wave", "match_cascade_8", "match_cascade_2", "exact_match_basic", "threshold_match",
            "backbone_create", "backbone_update", "history_clean", "backbone_changes", "inherit_id_k_of_n", "drop_duplicates",
            "release_subsets", "release_by_backbone", "profile_numeric", "profile_string", "histogram")


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (configured(SparkSession.builder).master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run) -> float:
    start = time.time()
    result: DataFrame = run()
    result.write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    from checks import fixture, naive
    from checks.queries import QUERIES

    spark = tune(session())
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    start = time.time()
    for day in (fixture.WAVE_1, fixture.WAVE_2):
        fixture.wave(spark, sf, day)
    fixture.backbone(spark, sf)
    staging = time.time() - start

    measure = lambda f: round(min([seconds(lambda: f(spark, sf)) for _ in range(3)][1:]), 3)
    times = {name: measure(QUERIES[name]) for name in HEADLINE}
    plain = {name: measure(f) for name, f in naive.VARIANTS.items()}
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "plain_variants": plain, "staging": round(staging, 3),
                      "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
