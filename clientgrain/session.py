"""Session defaults and the places where plans are cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A side of a join is broadcast only after its rows were counted, and its text
# measured, and found to be at most this much.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
FIXED_ROW_BYTES = 64

# Settings a session can take at run time.  Wide aggregations have a few hundred
# fields; above spark.sql.codegen.maxFields (100) Spark would interpret them.
WIDE_SETTINGS = {"spark.sql.codegen.maxFields": "600"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the wide-table settings to a session built elsewhere."""
    for key, value in WIDE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "clientgrain", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans here rely on.

    On a cluster leave ``master`` and ``shuffle_partitions`` to the submit
    command; adaptive execution then sizes the partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
        **WIDE_SETTINGS,
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary one,
    which goes when the program ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if current and (not named or urlparse(named).path.rstrip("/") in urlparse(current).path):
        return current
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="clientgrain-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder, so later steps read them from there
    and losing an executor does not recompute (or change) them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def null_safe_join(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null matches null; the key columns come from the left side."""
    renamed = right.withColumnsRenamed({c: f"__right_{c}" for c in columns})
    condition = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__right_{c}")) for c in columns])
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__right_{c}" for c in columns])


def text_bytes(df: DataFrame, ignore: Sequence[str] = ()) -> int:
    """Bytes of all text columns; a job over ``df``, which should be small or cut."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in ignore]
    if not text:
        return 0
    row = df.agg(*[F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).alias(f"_{i}") for i, c in enumerate(text)]).first()
    return sum(row)


def fits_broadcast(rows: int, text: int = 0, limit: int = MAX_BROADCAST_ROWS) -> bool:
    return rows <= limit and rows * FIXED_ROW_BYTES + text <= MAX_BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, rows: int, limit: int = MAX_BROADCAST_ROWS,
                       bounded_text: Sequence[str] = ("column",)) -> DataFrame:
    """Broadcast hint when ``df`` (cut, with ``rows`` counted) is small enough.

    ``bounded_text`` are columns of column names, whose length no data can
    stretch.  Beyond the limits the join is left to Spark: a shuffle join,
    with adaptive execution splitting skewed partitions.
    """
    small = fits_broadcast(rows, 0, limit) and fits_broadcast(rows, text_bytes(df, bounded_text), limit)
    return F.broadcast(df) if small else df
