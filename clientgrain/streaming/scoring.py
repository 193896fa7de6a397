"""The batch scoring plan on a stream of application files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def application_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
                       files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_available(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> DataFrame:
    """Push everything there is through ``transform`` into parquet, then stop.

    ``transform`` must be stateless: projections and joins with stored tables.
    The checkpoint makes a restart continue where the last run ended, and the
    file sink writes each batch once.
    """
    result = transform(stream)
    started = (result.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start(output))
    started.awaitTermination()
    return stream.sparkSession.read.schema(result.schema).parquet(output)
