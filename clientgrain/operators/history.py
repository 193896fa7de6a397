"""History tables reduced to client grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract
from ..functions import stats as ST
from ..session import broadcast_if_small, cut
from .quantiles import SKETCH_ACCURACY, exact_quantiles

# Values (rows times columns) that one task gathers for the quartiles of a client;
# the quartiles of larger clients are found without gathering.  A hash aggregate
# holds up to 128 clients at a time.
GROUP_VALUES = 200_000
# Statuses become columns; more of them are an error, not a table.
MAX_STATUSES = 200


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def known_statuses(df: DataFrame, status: str = "STATUS") -> list[str]:
    """The published statuses, then whatever else is present, sorted.  One narrow job."""
    others = [r[0] for r in df.select(status).where(F.col(status).isNotNull() & ~F.col(status).isin(*contract.STATUSES))
              .distinct().limit(MAX_STATUSES + 1).collect()]
    if len(others) > MAX_STATUSES:
        raise ValueError(f"{status} has more than {MAX_STATUSES} values besides the published ones, e.g. {sorted(others)[:5]}")
    return [*contract.STATUSES, *sorted(others)]


def status_shares(df: DataFrame, key: str = contract.CREDIT_ID, status: str = "STATUS",
                  values: Sequence[str] | None = None, prefix: str = "BB_STATUS_PCT_",
                  length: str = "BB_HISTORY_LENGTH") -> DataFrame:
    """A1 + A2: share of each status among the known ones, and the row count.

    One aggregation: every share is a ratio of two counts, so rows combine
    before the shuffle however many belong to one key.  By default every
    status present gets a column (see :func:`known_statuses`).  A list given
    as ``values`` must name them all: the aggregation fails on any other, as
    shares that do not add up would be wrong in silence.
    """
    given = values is not None
    values = known_statuses(df, status) if values is None else values
    s = F.col(status)
    shares = [ST.share_of(s == F.lit(v), s).alias(f"{prefix}{v}") for v in values]
    rows = df.where(F.col(key).isNotNull())
    if given:
        fault = F.raise_error(F.concat(F.lit(f"{status} has a value without a column: "), s.cast("string")))
        rows = rows.withColumn(status, F.when(s.isNotNull() & ~s.isin(*values), fault).otherwise(s))
    return (
        rows.groupBy(key)
        .agg(*shares, F.count(F.lit(1)).alias(length), F.count(s).alias("_known"))
        .where(F.col("_known") > 0).drop("_known")
    )


def hot_keys(df: DataFrame, key: str, group_rows: int) -> tuple[DataFrame, int]:
    """Keys with more than ``group_rows`` rows, their rows as ``_hot``, and how many such keys there are.

    There can be at most rows / ``group_rows`` of them.
    """
    hot = (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_hot"))
           .where(F.col("_hot") > group_rows))
    if hot.isEmpty():
        return hot, 0
    hot = cut(hot)
    return hot, hot.count()


def wide_aggregate(df: DataFrame, key: str, id_column: str, stats: Sequence[str], prefix: str, count_name: str,
                   columns: Sequence[str] | None = None, key_rows: DataFrame | None = None,
                   group_rows: int | None = None, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """A3 / A4 / A5: every numeric column times every statistic, and the child count.

    Means, extremes, sums and deviations combine before the shuffle, so a hot
    key is no burden.  Quartiles need the values themselves: where a key has
    more than ``group_rows`` rows (by default as many as make GROUP_VALUES
    values) they come from :func:`exact_quantiles`, and
    the aggregation sees nulls in their place.  ``key_rows`` may name a
    narrower table with the same rows per key to find such keys in.

    Where there are such keys the rows are stored once, those of a key side by
    side, so that each later pass combines a key to one record before its
    shuffle; a key of more rows than a task gathers lies in several parts.
    Where there are none the rows themselves are shuffled, once: quartiles need
    all values, so what each task gathered of a key would be larger than its rows.
    """
    columns = numeric_columns(df, (key, id_column)) if columns is None else list(columns)
    quantiles = [s for s in stats if s in ST.QUANTILE_STATS]
    gathered = max(1, GROUP_VALUES // max(1, len(columns)))
    group_rows = gathered if group_rows is None else group_rows
    rows = df.where(F.col(key).isNotNull())

    hot, n_hot = (hot_keys(key_rows if key_rows is not None else df, key, group_rows) if quantiles else (None, 0))
    source = rows
    if n_hot:
        narrow = rows.select(*dict.fromkeys([key, id_column, *columns]))
        flagged = narrow.join(broadcast_if_small(hot, n_hot), key, "left")
        parts = F.ceil(F.coalesce(F.col("_hot"), F.lit(1)) / max(group_rows, gathered))
        source = cut(flagged.repartition(F.col(key), F.pmod(F.xxhash64(*narrow.columns), parts)))
    elif quantiles:
        source = rows.select(*dict.fromkeys([key, id_column, *columns])).repartition(F.col(key))

    probs = [ST.QUANTILE_STATS[s] for s in quantiles]
    aggregates, outputs = [], []
    for i, c in enumerate(columns):
        for s in stats:
            name = ST.stat_name(prefix, c, s)
            if s in ST.QUANTILE_STATS:
                outputs.append(F.col(f"_q{i}")[quantiles.index(s)].alias(name))
            else:
                aggregates.append(ST.ALGEBRAIC_STATS[s](F.col(c)).alias(name))
                outputs.append(F.col(name))
        if quantiles:
            value = F.when(F.col("_hot").isNull(), F.col(c)) if n_hot else F.col(c)
            aggregates.append(F.percentile(value, F.array(*[F.lit(p) for p in probs])).alias(f"_q{i}"))
    aggregates.append(F.count(id_column).alias(count_name))
    result = source.groupBy(key).agg(*aggregates).select(key, *outputs, count_name)
    if not n_hot:
        return result

    long = exact_quantiles(source.where(F.col("_hot").isNotNull()), columns, probs, [key], accuracy=accuracy)
    picks = {
        ST.stat_name(prefix, c, s): F.max(F.when((F.col("column") == c) & (F.col("prob") == ST.QUANTILE_STATS[s]),
                                                 F.col("value")))
        for c in columns for s in quantiles
    }
    wide = cut(long.groupBy(key).agg(*[e.alias(f"_hot_{n}") for n, e in picks.items()]))
    joined = result.join(broadcast_if_small(wide, n_hot), key, "left")
    return joined.select(key, *[
        F.coalesce(F.col(n), F.col(f"_hot_{n}")).alias(n) if n in picks else F.col(n)
        for n in result.columns if n != key
    ])


def bureau_aggregate(bureau: DataFrame, shares: DataFrame | None = None, group_rows: int | None = None,
                     accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """J1 then A3: external credits per client, seven statistics per column."""
    wide = bureau if shares is None else bureau.join(shares, contract.CREDIT_ID, "left")
    return wide_aggregate(wide, contract.ID_COLUMN, contract.CREDIT_ID, ST.SEVEN_STATS, "BUREAU",
                          "BUREAU_CREDIT_COUNT", key_rows=bureau, group_rows=group_rows, accuracy=accuracy)


def previous_aggregate(previous: DataFrame) -> DataFrame:
    """A4: earlier applications per client, four statistics per column."""
    return wide_aggregate(previous, contract.ID_COLUMN, contract.PREVIOUS_ID, ST.FOUR_STATS, "PREV",
                          "PREV_APPLICATION_COUNT")


def aggregate_histories(tables: Mapping[str, DataFrame], statuses: Sequence[str] | None = None,
                        group_rows: int | None = None) -> dict[str, DataFrame]:
    """The client-grain tables for whichever history tables are given."""
    shares = status_shares(tables["bureau_balance"], values=statuses) if "bureau_balance" in tables else None
    result = {}
    if "bureau" in tables:
        result["bureau"] = bureau_aggregate(tables["bureau"], shares, group_rows)
    if "previous_application" in tables:
        result["previous"] = previous_aggregate(tables["previous_application"])
    return result


def join_histories(application: DataFrame, aggregates: Mapping[str, DataFrame]) -> DataFrame:
    """Left joins; the right sides have one row per client, so rows are kept one to one."""
    for name in ("bureau", "previous"):
        if name in aggregates:
            application = application.join(aggregates[name], contract.ID_COLUMN, "left")
    return application


class HistoryAggregator(Estimator):
    """Learns the client-grain tables, its model joins them on.

    With ``path`` the tables are written once, and every later transform reads
    them instead of aggregating the histories again.
    """

    def __init__(self, tables: Mapping[str, DataFrame], path: str | None = None,
                 statuses: Sequence[str] | None = None):
        super().__init__()
        self.tables = dict(tables)
        self.path = path
        self.statuses = statuses

    def _fit(self, dataset: DataFrame) -> "HistoryAggregatorModel":
        aggregates = aggregate_histories(self.tables, self.statuses)
        if self.path:
            for name, table in aggregates.items():
                table.write.mode("overwrite").parquet(f"{self.path}/{name}")
                aggregates[name] = dataset.sparkSession.read.parquet(f"{self.path}/{name}")
        return HistoryAggregatorModel(aggregates)


class HistoryAggregatorModel(Model, MLWritable, MLReadable):
    def __init__(self, aggregates: Mapping[str, DataFrame] | None = None):
        super().__init__()
        self.aggregates = dict(aggregates or {})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return join_histories(dataset, self.aggregates)

    def write(self) -> MLWriter:
        return _AggregateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _AggregateReader(cls)


class _AggregateWriter(MLWriter):
    def __init__(self, model: HistoryAggregatorModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        names = sorted(self.model.aggregates)
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"tables": names})
        for name in names:
            self.model.aggregates[name].write.parquet(f"{path}/tables/{name}")


class _AggregateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> HistoryAggregatorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls({n: self.sparkSession.read.parquet(f"{path}/tables/{n}") for n in metadata["tables"]})
        model._resetUid(metadata["uid"])
        return model
