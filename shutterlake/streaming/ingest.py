"""Landing files as a stream, loaded by the same upsert as the batch job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from shutterlake import schemas
from shutterlake.operators.normalize import CORRUPT
from shutterlake.plans.elt import load_photos


def stream_photos(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    recorded_at: dt.datetime | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Loads every new file below ``landing`` and stops when none is left.

    A batch may be delivered again after a failure; photos are read by key, and snapshots and
    quarantine are merged by key, so a repeat with the same ``recorded_at`` changes nothing.
    """

    def load(batch, _):
        load_photos(batch, root, recorded_at or dt.datetime.now(dt.timezone.utc))

    return (
        spark.readStream.schema(f"{schemas.RAW_PHOTO}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
