"""Waves as they arrive: a file stream over a landing folder, one update per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from ..plans.jobs import register_wave
from ..sources import bronze
from ..sources.versions import latest
from ..specs.model import SourceSpec


def follow_waves(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str,
                 handle: Callable[[DataFrame, int], None]):
    """Pass everything that arrived since the last run to `handle(batch, batch_id)`.

    The checkpoint keeps track of the files seen. A batch can come again after a
    failure; ids, deduplication and superseding are deterministic, so that changes
    nothing, provided that `handle` writes to a path named by the batch id.
    """
    stream = spark.readStream.schema(schema).parquet(path)
    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def follow_register(spark: SparkSession, source: str, root: str, spec: SourceSpec, secret: str, checkpoint: str,
                    code_tables: dict | None = None):
    """Bring the backbone under `root` up to date with every wave of a source that was landed since
    the last run, oldest wave first; the first one makes it.

    What arrives are lines of the landing manifest, which are written last, so a wave is never seen
    in part. A line is known by its place in the stream: if a run dies, the next one gets the
    same lines again, goes on with what is not committed, and skips what is. A file that is landed
    again is a new line and is compared with the backbone again.
    """
    def handle(lines: DataFrame, number: int) -> None:
        for line in lines.orderBy("wave_date", "received_on", "file_id").collect():  # one row a landed file
            newest = latest(spark, f"{root}/backbone")
            register_wave(spark, source, line["file_id"], spec, root, secret, newest and str(newest), code_tables,
                          batch=f"{checkpoint}:{number}:{line['file_id']}")

    return follow_waves(spark, f"{root}/bronze/{source}/manifest", T.StructType.fromDDL(bronze.MANIFEST), checkpoint, handle)
