"""Routing of columns into one feature vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract
from .coercion import TypeCoercer
from .encoders import MISSING_LABEL, TREE_MISSING_LABEL, ConstantImputer, CrossFitEncoder, encode_training
from .packed import PackedAssembler, PackedModes, PackedNumbers, PackedScaling
from .row_features import RowFeatures

FEATURES = "features"
# Encoder folds are drawn with a seed of their own, so they are no splits of the rows elsewhere.
ENCODER_SEED = contract.SEED + 1_000
BELOW_ALL = -3.0e38               # missing numbers sort below the known ones in trees
MAX_ONE_HOT = 10_000              # one-hot labels go through the driver


class ColumnConformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the columns a model was trained on and the input lacks, as nulls."""

    fields = Param(Params._dummy(), "fields", "column name to type")

    @keyword_only
    def __init__(self, *, fields: dict | None = None):
        super().__init__()
        self._setDefault(fields={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        have = set(dataset.columns)
        absent = {c: F.lit(None).cast(t) for c, t in self.getOrDefault(self.fields).items() if c not in have}
        return dataset.withColumns(absent) if absent else dataset


class CategoryLimit(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Refuses columns with more than MAX_ONE_HOT categories; changes nothing."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ColumnConformer:
        many = [c for c in self.getInputCols() if dataset.select(c).distinct().limit(MAX_ONE_HOT + 1).count() > MAX_ONE_HOT]
        if many:
            raise ValueError(f"{many} have more than {MAX_ONE_HOT} categories; encode them by label means or by one_hot.wide_one_hot_stages")
        return ColumnConformer(fields={})


def one_hot_stages(cols: Sequence[str]) -> list:
    """Constant imputing, then one slot per category; unseen categories give all zeros.

    The vector, and the list of labels on the driver, are as long as the
    column has categories; their number is checked first.
    """
    indexed, vectors = [f"{c}_idx" for c in cols], [f"{c}_vec" for c in cols]
    return [
        ConstantImputer(inputCols=list(cols), label=MISSING_LABEL),
        CategoryLimit(inputCols=list(cols)),
        StringIndexer(inputCols=list(cols), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=vectors, dropLast=True),
    ]


@dataclass(frozen=True)
class FeatureLists:
    """Which columns go where; whatever is not listed is dropped."""

    numerical: tuple[str, ...]
    categorical: tuple[str, ...]
    binary: tuple[str, ...]

    @classmethod
    def from_contract(cls, df: DataFrame) -> "FeatureLists":
        have = set(df.columns)

        def present(names):
            return tuple(n for n in names if n in have)

        return cls(present(contract.numerical_features()), present(contract.categorical_features()),
                   present(contract.binary_features()))

    def only(self, names: Sequence[str]) -> "FeatureLists":
        keep = set(names)
        return FeatureLists(*[tuple(n for n in part if n in keep) for part in (self.numerical, self.categorical, self.binary)])

    def all(self) -> list[str]:
        """In list order, each name once."""
        return list(dict.fromkeys([*self.numerical, *self.categorical, *self.binary]))


NUMBERS, FLAGS = "_numbers", "_flags"


def tree_stages(lists: FeatureLists, label: str, row_id: str, indexed: Sequence[str] = (),
                encoder_seed: int = ENCODER_SEED) -> list:
    """No imputing by statistics and no scaling.

    Missing numbers go below every known value, missing text becomes a
    category.  Category columns are replaced by their cross-fitted label means;
    those named in ``indexed`` (with few categories: the labels go through the
    driver) are indexed instead, so that trees split on sets of categories.
    """
    few = [c for c in lists.categorical if c in set(indexed)]
    many = [c for c in lists.categorical if c not in set(indexed)]
    numbers = [*lists.numerical, *lists.binary]
    slots = [f"{c}_idx" for c in few]
    stages: list = [TypeCoercer(), PackedNumbers(inputCols=numbers, outputCol=NUMBERS, number=BELOW_ALL)]
    if lists.categorical:
        stages.append(ConstantImputer(inputCols=list(lists.categorical), label=TREE_MISSING_LABEL))
    if few:
        stages.append(StringIndexer(inputCols=few, outputCols=slots, handleInvalid="keep", stringOrderType="alphabetAsc"))
    if many:
        stages.append(CrossFitEncoder(inputCols=many, labelCol=label, idCol=row_id, seed=encoder_seed))
    return [*stages, PackedAssembler(inputCols=[NUMBERS, *slots, *many], outputCol=FEATURES, packed={NUMBERS: numbers})]


def dense_stages(lists: FeatureLists, label: str, row_id: str, encoder_seed: int = ENCODER_SEED) -> list:
    """Impute, bend and scale numbers, encode categories, fill flags, one vector."""
    numbers, flags, cols = list(lists.numerical), list(lists.binary), list(lists.categorical)
    stages: list = [TypeCoercer(), PackedScaling(inputCols=numbers, outputCol=NUMBERS), PackedModes(inputCols=flags, outputCol=FLAGS)]
    if cols:
        stages += [ConstantImputer(inputCols=cols, label=MISSING_LABEL),
                   CrossFitEncoder(inputCols=cols, labelCol=label, idCol=row_id, seed=encoder_seed)]
    return [*stages, PackedAssembler(inputCols=[NUMBERS, *cols, FLAGS], outputCol=FEATURES, packed={NUMBERS: numbers, FLAGS: flags})]


def preprocessing_kind(model_name: str) -> str:
    return "tree" if model_name.lower() == "catboost" else "dense"


def preprocessing(model_name: str, train: DataFrame, lists: FeatureLists, label: str = contract.TARGET_COLUMN,
                  row_id: str = contract.ID_COLUMN, row_features: bool = False, indexed: Sequence[str] = (),
                  encoder_seed: int = ENCODER_SEED) -> list:
    """The unfitted stages for a model.

    ``row_features`` adds the derived row features for input that does not
    come from the feature store (which has them already).  ``indexed`` names
    the category columns that the tree preparation indexes.
    """
    first: list = [ColumnConformer(fields={c: train.schema[c].dataType.simpleString() for c in lists.all() if c in train.columns})]
    if row_features:
        first.append(RowFeatures())
    if preprocessing_kind(model_name) == "tree":
        return first + tree_stages(lists, label, row_id, indexed, encoder_seed)
    return first + dense_stages(lists, label, row_id, encoder_seed)


def fit_stages(stages: Sequence, train: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit the stages in order; also return the training rows as a model should see them."""
    fitted: list[Model | Transformer] = []
    for stage in stages:
        model = stage.fit(train) if isinstance(stage, Estimator) else stage
        train = encode_training(model, train)
        fitted.append(model)
    return PipelineModel(fitted), train


def raw_inputs(model: PipelineModel) -> list[str]:
    """Input columns a fitted preprocessing was built for, each once, in list order."""
    for stage in model.stages:
        if isinstance(stage, ColumnConformer):
            return list(stage.getOrDefault(stage.fields))
    return []


def feature_names(df: DataFrame, vector: str = FEATURES) -> list[str]:
    """Names of the vector's slots, from the column metadata."""
    groups = df.schema[vector].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a.get("name", str(a["idx"])) for part in groups.values() for a in part}
    return list(dict.fromkeys(slots[i] for i in sorted(slots)))
