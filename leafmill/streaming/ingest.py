"""Ingest as a stream of files.

The stream remembers paths; the record of content hashes is still asked for
each batch, so a copy under another name isn't taken up again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import Config, run
from ..sources.files import FILES, with_names


def file_stream(spark: SparkSession, folder: str, files_per_batch: int = 25) -> DataFrame:
    return spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.[pP][dD][fF]").option("maxFilesPerTrigger", files_per_batch).load(folder)


def start(spark: SparkSession, config: Config, checkpoint: str, files_per_batch: int = 25) -> StreamingQuery:
    """Take up what is there, batch by batch, and stop; a batch that is run again upserts the same rows."""
    whole = Config(**{**config.__dict__, "max_documents": None})

    def batch(df: DataFrame, _: int) -> None:
        run(df.sparkSession, whole, with_names(df)).collect()  # one row of counters

    stream = file_stream(spark, config.inbox, files_per_batch)
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
