"""Building the feature store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from .. import contract
from ..operators.history import aggregate_histories, join_histories
from ..operators.row_features import add_row_features
from ..sources.tables import write_store


def build_feature_store(tables: Mapping[str, DataFrame], path: str | None = None,
                        statuses: Sequence[str] | None = None,
                        epsilon: float = contract.STORE_EPSILON, group_rows: int | None = None,
                        aggregates: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per application: raw columns, row features, history aggregates.

    ``tables`` holds ``application`` (or ``main``) and any of the history
    tables.  Histories are reduced before they are joined, so the widest
    shuffle is that of the application table itself, once, by client.
    ``aggregates`` are the reduced histories where they are stored already.
    """
    application = tables["application"] if "application" in tables else tables["main"]
    store = join_histories(add_row_features(application, epsilon=epsilon),
                           aggregate_histories(tables, statuses, group_rows) if aggregates is None else aggregates)
    if path:
        write_store(store, path)
        return store.sparkSession.read.parquet(path)
    return store
