"""Reading texts inside tasks: Arrow batches in, measured columns out."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A word, here and in every contract of the folder, is a run of characters other
# than the six ASCII white-space ones.  ``bytes.split()`` cuts at just these.
WORD = r"[^\x20\x09-\x0D]+"

# Rows that travel to a Python worker at once.  Texts can be long, so few.
BATCH_ROWS = 500


PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds what a worker holds at once, and lets workers on this machine import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, PACKAGE_ROOT])


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; a lone surrogate is kept as it comes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_texts(df: DataFrame, keep: Sequence[str], texts: Sequence[str], schema: T.StructType,
              make: Callable[[], Callable[[list[list]], Iterable[tuple]]]) -> DataFrame:
    """Columns computed from the text columns, row by row, beside the kept columns.

    ``make`` runs once in each task and returns the function that takes the
    batch's texts (a list for each text column) and yields a tuple of the
    columns of ``schema`` for each row.
    """
    keep, texts = list(keep), list(texts)
    kept = df.select(*[F.col(f"`{c}`") for c in keep])
    out = T.StructType([*kept.schema.fields, *schema.fields])
    added = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            columns = [batch.column(len(keep) + i).to_pylist() for i in range(len(texts))]
            rows = list(compute(columns))
            made = [pa.array([r[i] for r in rows], type=added.field(i).type) for i in range(len(added))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], *made],
                                             names=[*keep, *added.names])

    small_batches(df.sparkSession)
    source = df.select(*[F.col(f"`{c}`") for c in keep],
                       *[F.col(f"`{c}`").cast("string").alias(f"__text{i}") for i, c in enumerate(texts)])
    return source.mapInArrow(run, out)
