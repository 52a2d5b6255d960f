"""Landed observation pages as a stream of files: each page is loaded once, also after a restart.

The stream's checkpoint plays the part of the page link: it remembers which pages were taken. Nothing is
aggregated over time, so there is no watermark and no state to bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hydroflow.schemas import OBSERVATIONS_PAGE
from hydroflow.sources.pages import observations_of


def stream_observations(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming observations from page files arriving below ``path``; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(OBSERVATIONS_PAGE).option("mode", "FAILFAST")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return observations_of(reader.json(path))


def load_landed_pages(
    spark: SparkSession, path: str, out: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Append all pages not loaded yet to the parquet table ``out`` and stop; exactly once per page file."""
    query = (
        stream_observations(spark, path, max_files)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
