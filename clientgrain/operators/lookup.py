"""Left joins onto learned lookup tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS, cut, fits_broadcast

# Keys holding more than one part in HOT_PARTS of the rows, in training or in
# the rows at hand, are joined by broadcast; there are fewer than twice
# HOT_PARTS of them, and a digest stands for the key, whatever its length.
HOT_PARTS = 1_000
SPREAD = 4_096


def _digest(columns: Sequence[Column]) -> Column:
    """One digest for the key's columns (none of them null)."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(columns)])), 256))


def _frequent(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame | None:
    """Digests of keys that many of the rows hold; a stream cannot be counted beforehand."""
    if df.isStreaming:
        return None
    digests = df.select(_digest(list(keys.values())).alias("_digest")).where("_digest IS NOT NULL")
    total = digests.count()
    counts = digests.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    # Only these are stored: there are fewer than HOT_PARTS of them, however many keys the rows have.
    return cut(counts.where(F.col("_n") * HOT_PARTS > F.lit(total)).select("_digest"))


def attach(df: DataFrame, keys: Mapping[str, Column], table: DataFrame, value: str, output: str, rows: int,
           text: int, weight: str = "n", limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Add ``output``: the table's ``value`` for the row's keys, null if there is none.

    ``keys`` maps a column of the (unique-keyed) table to an expression over
    ``df``.  ``rows`` and ``text`` are the table's counted rows and bytes of
    text, ``weight`` its column with the training rows per key.  A table over
    ``limit`` is joined in two parts: frequent keys (in training, or among the
    rows at hand, which are counted first unless they are a stream) by
    broadcast, the rest by a shuffle in which the rows already served are
    spread over keys of their own, so no partition gets them all.
    """
    def on(side: DataFrame, suffix: str, extra: Column | None = None) -> tuple[DataFrame, Column, list[str]]:
        renamed = side.select(*[F.col(k).alias(f"_t_{k}{suffix}") for k in keys], F.col(value).alias(f"_value{suffix}"))
        condition = reduce(and_, [e == F.col(f"_t_{k}{suffix}") for k, e in keys.items()])
        return renamed, condition if extra is None else condition & extra, [f"_t_{k}{suffix}" for k in keys]

    if fits_broadcast(rows, text, limit):
        small, condition, helpers = on(table, "")
        return df.join(F.broadcast(small), condition, "left").drop(*helpers).withColumnRenamed("_value", output)

    total = table.agg(F.sum(weight)).first()[0] or 0
    known = table.withColumn("_digest", _digest([F.col(k) for k in keys]))
    frequent = _frequent(df, keys)
    is_heavy = F.col(weight) * HOT_PARTS > F.lit(total)
    heavy = known.where(is_heavy).select("_digest", F.col(value).alias("_value_h"))
    if frequent is not None:
        # Also the keys that are frequent here, known to the table or not.
        here = frequent.join(known.where(~is_heavy).select("_digest", F.col(value).alias("_value_h")), "_digest", "left")
        heavy = heavy.unionByName(here.join(heavy.select("_digest"), "_digest", "left_anti"))
    heavy = cut(heavy.withColumns({"_served": F.lit(True)}))
    served = (df.withColumn("_key", _digest(list(keys.values())))
              .join(F.broadcast(heavy), F.col("_key") == F.col("_digest"), "left").drop("_digest", "_key"))
    turn = F.when(F.col("_served").isNull(), F.lit(0)).otherwise(
        F.lit(1) + F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SPREAD)))
    served = served.withColumn("_turn", turn.cast("int"))
    light, light_on, light_keys = on(table, "_l", F.col("_turn") == F.col("_zero"))
    # Always 0, but no literal: Spark would fold one into the condition and shuffle by the key alone.
    light = light.withColumn("_zero", F.pmod(F.xxhash64(*light_keys), F.lit(1)).cast("int"))
    return (served.join(light, light_on, "left")
            .withColumn(output, F.coalesce("_value_h", "_value_l"))
            .drop(*light_keys, "_zero", "_turn", "_served", "_value_h", "_value_l"))
