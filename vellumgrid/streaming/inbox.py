"""A folder as a stream of files: each new one goes once through the batch pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


FILE = "path string, modificationTime timestamp, length long, content binary"


def watch(spark: SparkSession, folder: str, checkpoint: str, each: Callable[[DataFrame, int], None], glob: str = "*.pdf", most: int = 100,
    once: bool = False) -> StreamingQuery:
    """``each`` gets the files that came since the last batch; the checkpoint says which were taken."""
    files = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", glob).option("maxFilesPerTrigger", most).load(folder)
    writer = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
