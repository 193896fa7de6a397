"""One slot for each label, however many labels there are.

``routing.one_hot_stages`` keeps the labels on the driver and so has a limit.
Here they stay a table of (column, label, slot): slots are running totals over
the distinct labels, rows meet them in a join that is broadcast only if it is
small and in which frequent labels are spread otherwise, and the driver learns
how many there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .encoders import MISSING_LABEL, ConstantImputer
from .lookup import attach
from .running import SINGLE_PASS_ROWS, running_totals

MOST_SLOTS = 2 ** 31 - 1        # the length of a vector is an int


def unit_vector(slot: Column, size: int) -> Column:
    """A sparse vector with a 1 in ``slot``, and of zeros where that is null; made in the JVM."""
    def entries(value: Column) -> Column:
        return F.concat(F.lit("["), F.when(slot.isNull(), F.lit("")).otherwise(value.cast("string")), F.lit("]"))
    text = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size},"indices":'), entries(slot), F.lit(',"values":'), entries(F.lit("1.0")), F.lit("}}"))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]


def slot_of(vector: str) -> tuple[Column, Column]:
    """The slot of a unit vector (null for zeros) and the vector's length."""
    text = F.to_json(F.struct(F.col(vector).alias("v")))
    return F.get_json_object(text, "$.v.indices[0]").cast("long"), F.get_json_object(text, "$.v.size").cast("long")


class _Columns(HasInputCols, HasOutputCols):
    def _given(self, kwargs: dict) -> None:
        self._setDefault(inputCols=[], outputCols=[])
        self._set(**{k: v for k, v in kwargs.items() if v is not None})


class WideOneHot(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Slots by the order of the labels (as UTF-8 bytes); a null is no label."""

    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None,
                 single_pass_rows: int = SINGLE_PASS_ROWS):
        super().__init__()
        self._given({"inputCols": inputCols, "outputCols": outputCols})
        self.single_pass_rows = single_pass_rows

    def _fit(self, dataset: DataFrame) -> "WideOneHotModel":
        cols = self.getInputCols()
        model = WideOneHotModel(inputCols=cols, outputCols=self.getOutputCols())
        if not cols:
            return model
        labels = (dataset.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "label")
                  .where("label IS NOT NULL").groupBy("column", "label").agg(F.count(F.lit(1)).alias("n")))
        counted = running_totals(labels.withColumn("_one", F.lit(1).cast("long")), ["column"], ["label"], ["_one"], self.single_pass_rows)
        model.slots = cut(counted.select("column", "label", "n", F.col("_one_before").alias("slot")))
        measured = model.slots.groupBy("column").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("label")).alias("text")).collect()
        sizes = {r["column"]: [r["rows"], r["text"]] for r in measured}
        most = max((rows for rows, _ in sizes.values()), default=0)
        if most > MOST_SLOTS:
            raise ValueError(f"{most} labels are more than a vector has slots")
        model._set(sizes={c: sizes.get(c, [0, 0]) for c in cols})
        return model


class WideOneHotModel(Model, _Columns, MLWritable, MLReadable):
    sizes = Param(Params._dummy(), "sizes", "labels and bytes of labels per column")

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(sizes={})
        self._given(self._input_kwargs)
        self.slots: DataFrame | None = None      # (column, label, n, slot)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Rows with a label that was not learnt, or none, get zeros."""
        sizes = self.getOrDefault(self.sizes)
        made = list(zip(self.getInputCols(), self.getOutputCols()))
        for i, (c, _) in enumerate(made):
            rows, text = sizes[c]
            table = self.slots.where(F.col("column") == c)
            dataset = attach(dataset, {"label": F.col(c).cast("string")}, table, "slot", f"_slot{i}", rows, text)
        # Vectors are made behind the last join, so that none is shuffled.
        slots = [f"_slot{i}" for i in range(len(made))]
        return dataset.withColumns({output: unit_vector(F.col(slot), sizes[c][0]) for slot, (c, output) in zip(slots, made)}).drop(*slots) if made else dataset

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: WideOneHotModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        if self.model.slots is not None:
            self.model.slots.write.parquet(f"{path}/slots")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        if model.getOrDefault(model.sizes):
            model.slots = self.sparkSession.read.parquet(f"{path}/slots")
        return model


def wide_one_hot_stages(cols: Sequence[str]) -> list:
    """E6 without a limit: constant imputing, then a sparse vector ``{column}_vec`` with a slot per label."""
    return [ConstantImputer(inputCols=list(cols), label=MISSING_LABEL),
            WideOneHot(inputCols=list(cols), outputCols=[f"{c}_vec" for c in cols])]
