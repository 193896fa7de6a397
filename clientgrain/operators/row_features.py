"""Row-level features of an application."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract
from ..functions import scalars as S

# --- fixed values -----------------------------------------------------------
AGE_EDGES, AGE_LABELS = (0, 25, 35, 45, 55, 100), (1, 2, 3, 4, 5)
BURDEN_EDGES, BURDEN_LABELS = (0, 5, 10, 50), ("low", "medium", "high")
EXTERNAL_SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
DOCUMENT_PREFIX = "FLAG_DOCUMENT_"
SQUARED = ("CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "AGE_YEARS", "EMPLOYMENT_YEARS")
RATIOS = (
    # output, numerator, denominator
    ("CREDIT_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
    ("ANNUITY_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    ("ANNUITY_CREDIT_RATIO", "AMT_ANNUITY", "AMT_CREDIT"),
    ("CREDIT_TERM_EST", "AMT_CREDIT", "AMT_ANNUITY"),
    ("GOODS_PRICE_CREDIT_RATIO", "AMT_GOODS_PRICE", "AMT_CREDIT"),
    ("INCOME_PER_PERSON", "AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
)
# --- end of fixed values ----------------------------------------------------


def feature_layers(columns: Sequence[str], sentinel: float = contract.EMPLOYMENT_SENTINEL,
                   epsilon: float = contract.ROW_EPSILON) -> list[dict[str, Column]]:
    """Expressions per output column, in three layers that read one another.

    Only features whose inputs are present are listed, so the output columns
    follow from the input columns alone.
    """
    have = set(columns)
    base: dict[str, Column] = {}
    if "DAYS_BIRTH" in have:
        base["AGE_YEARS"] = S.days_to_years("DAYS_BIRTH")
    if "DAYS_EMPLOYED" in have:
        kept = S.sentinel_to_null("DAYS_EMPLOYED", sentinel)
        base["DAYS_EMPLOYED_ANOM"] = S.sentinel_flag("DAYS_EMPLOYED", sentinel)
        base["EMPLOYMENT_YEARS"] = S.years_with_floor(kept)
        base["DAYS_EMPLOYED"] = kept
    if "DAYS_REGISTRATION" in have:
        base["REGISTRATION_YEARS"] = S.days_to_years("DAYS_REGISTRATION")
    if "DAYS_ID_PUBLISH" in have:
        base["ID_PUBLISH_YEARS"] = S.days_to_years("DAYS_ID_PUBLISH")
    for name, numerator, denominator in RATIOS:
        if {numerator, denominator} <= have:
            base[name] = S.epsilon_ratio(numerator, denominator, epsilon)
    if {"AMT_CREDIT", "AMT_GOODS_PRICE"} <= have:
        base["DOWN_PAYMENT_PROXY"] = S.non_negative_difference("AMT_CREDIT", "AMT_GOODS_PRICE")
    scores = [c for c in EXTERNAL_SCORES if c in have]
    if len(scores) >= 2:
        base["EXT_SOURCE_MEAN"] = S.row_mean(scores)
        base["EXT_SOURCE_MIN"] = S.row_min(scores)
        base["EXT_SOURCE_MAX"] = S.row_max(scores)
        base["EXT_SOURCE_RANGE"] = S.row_range(scores)
    documents = S.prefix_columns(columns, DOCUMENT_PREFIX)
    if documents:
        base["DOCUMENTS_SUBMITTED"] = S.row_sum(documents)

    derived: dict[str, Column] = {}
    if "AGE_YEARS" in base:
        derived["AGE_GROUP"] = S.fixed_bins(F.col("AGE_YEARS"), AGE_EDGES, AGE_LABELS)
    if "CREDIT_INCOME_RATIO" in base:
        derived["CREDIT_BURDEN_GROUP"] = S.fixed_bins(F.col("CREDIT_INCOME_RATIO"), BURDEN_EDGES, BURDEN_LABELS)
    for name in SQUARED:
        if name in base or name in have:
            derived[f"{name}_SQ"] = S.square(name)
    return [base, derived]


def created_features(columns: Sequence[str]) -> list[str]:
    """Names the transformer adds for these input columns."""
    return [n for layer in feature_layers(columns) for n in layer if n != "DAYS_EMPLOYED"]


def add_row_features(df: DataFrame, sentinel: float = contract.EMPLOYMENT_SENTINEL,
                     epsilon: float = contract.ROW_EPSILON) -> DataFrame:
    for layer in feature_layers(df.columns, sentinel, epsilon):
        if layer:
            df = df.withColumns(layer)
    return df


class RowFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """P12 as a pipeline stage."""

    sentinel = Param(Params._dummy(), "sentinel", "value that stands for 'unknown' in DAYS_EMPLOYED",
                     TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "added to every denominator", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, sentinel: float = contract.EMPLOYMENT_SENTINEL, epsilon: float = contract.ROW_EPSILON):
        super().__init__()
        self._setDefault(sentinel=float(contract.EMPLOYMENT_SENTINEL), epsilon=contract.ROW_EPSILON)
        self._set(**self._input_kwargs)

    def createdFeatures(self, columns: Sequence[str]) -> list[str]:
        return created_features(columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_row_features(dataset, self.getOrDefault(self.sentinel), self.getOrDefault(self.epsilon))
