"""Season files arriving in a landing folder, appended to the partitioned
play-by-play dataset by a Structured Streaming job.

The file source tracks which files were already processed in the query's
checkpoint (on shared storage), so a restarted or re-run job picks up only
new files.  Each micro-batch lands its source files once (``land_files``): a
season may arrive in any number of files, batches and runs, a replayed batch
adds nothing, and neither does a run with a fresh checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from huddle import schemas
from huddle.sinks.landing import land_files
from huddle.sources.files import conform


def season_landing_stream(
    spark: SparkSession,
    source_dir: str,
    target_path: str,
    checkpoint_location: str,
    schema: T.StructType = schemas.PLAYS,
    keys: Sequence[str] = ("season",),
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the landing query.  ``available_now`` processes everything
    present and stops (a scheduled incremental load); otherwise the query
    keeps polling the folder."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir).select("*", F.col("_metadata.file_path").alias("_file"))

    def land_batch(batch: DataFrame, epoch_id: int) -> None:
        declared = T.StructType([*schema.fields, T.StructField("_file", T.StringType())])
        land_files(conform(batch, declared), target_path, keys)

    writer = stream.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
