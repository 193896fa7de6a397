"""Accepted and rejected records of a stream, side by side (G3, and G1 and J4 on streams).

Each micro-batch is a table: it is read once, checked, and its two parts are
written to folders named by the stream and the batch.  A batch that is run again
after a failure, wherever it broke off, replaces just these folders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..plans.scoring import check_records

# Written to folders of no batch, so that they can be read before the first one.
EMPTY = "none"


def write_batch(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").parquet(folder)


def written(like: DataFrame, folder: str) -> DataFrame:
    """All that the batches wrote to ``folder``."""
    return like.sparkSession.read.schema(like.schema).option("recursiveFileLookup", "true").parquet(folder)


def split_stream(stream: DataFrame, accepted: str, rejected: str, checkpoint: str, schema: StructType | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Push everything there is through the request contract; what was accepted so far, and what was rejected.

    ``transform`` is applied to the accepted records of a batch, say to score
    them; as a batch is a table it may aggregate, count frequent keys and join
    with them spread (``lookup.attach``).  Rejected records carry what they lack.

    A restart with the same checkpoint goes on with the batch that broke off; a
    new checkpoint writes beside what is there.  Each record is in one of
    the two folders, once, when this returns.  While a batch is repeated a
    reader may miss its rows.  An empty stream gives two empty tables.
    """
    spark = stream.sparkSession

    def parts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        good, bad = check_records(rows, schema)
        return (transform(good) if transform else good), bad

    def run(rows: DataFrame, batch: int) -> None:
        name = f"{rows.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}/batch-{batch}"
        rows.persist()
        try:
            good, bad = parts(rows)
            write_batch(good, f"{accepted}/{name}")
            write_batch(bad, f"{rejected}/{name}")
        finally:
            rows.unpersist()

    empty = parts(spark.createDataFrame([], stream.schema))
    for rows, folder in zip(empty, (accepted, rejected)):
        rows.limit(0).write.mode("ignore").parquet(f"{folder}/{EMPTY}")
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return written(empty[0], accepted), written(empty[1], rejected)
