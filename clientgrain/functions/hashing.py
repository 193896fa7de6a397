"""Stable pseudo-random numbers from row ids, for splits and shuffles.

MD5 depends on nothing but the id and the seed, so membership survives
repartitioning, retries and a change of engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import as_column

HEX_DIGITS = 13                      # 52 bits: exact in a double
HASH_SPACE = 16 ** HEX_DIGITS


def row_hash(row_id: Column | str, seed: int) -> Column:
    """Integer in [0, 2^52)."""
    text = F.concat(as_column(row_id).cast("string"), F.lit(f"-{seed}"))
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint")
