"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import nan_to_null
from . import schemas

# Table role -> (file, schema) as the loan data set ships them.
LOAN_TABLES = {
    "main": ("application_train.csv", schemas.application_schema),
    "bureau": ("bureau.csv", schemas.bureau_schema),
    "bureau_balance": ("bureau_balance.csv", schemas.bureau_balance_schema),
    "previous_application": ("previous_application.csv", schemas.previous_schema),
}


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header.

    With a schema the columns are matched by name, so order and extra columns
    do not matter and nothing is inferred.  Without one Spark reads the file
    an extra time to infer types; keep that for exploration.
    """
    reader = spark.read.option("header", True).option("nanValue", "NaN")
    if schema is None:
        return nan_to_null(reader.option("inferSchema", True).csv(path))
    text = reader.csv(path)
    wanted = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields if f.name in text.columns]
    return nan_to_null(text.select(*wanted))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One table, CSV or parquet by its file name."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema)
    return nan_to_null(spark.read.parquet(path))


def load_tables(spark: SparkSession, folder: str, files: Mapping[str, str] | None = None,
                with_schemas: bool = True) -> dict[str, DataFrame]:
    """The named tables, lazily.  ``files`` overrides file names per role."""
    tables = {}
    for role, (name, schema) in LOAN_TABLES.items():
        name = (files or {}).get(role, name)
        tables[role] = read_table(spark, f"{folder.rstrip('/')}/{name}", schema() if with_schemas else None)
    return tables


def write_store(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """S3: the feature store as parquet, one row per client."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_store_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """S3 with buckets on the client key: later joins on it need no exchange."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def read_store(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet reads only the columns asked for."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_comparison(df: DataFrame, path: str) -> None:
    """The model comparison (one row per model) as a single CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_selected(df: DataFrame, path: str) -> None:
    """Selected features as JSON lines in rank order."""
    df.select("rank", "feature").orderBy("rank").coalesce(1).write.mode("overwrite").json(path)


def read_selected(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema("rank bigint, feature string").json(path).orderBy("rank").collect()
    return [r.feature for r in rows]
