"""Column transforms learned on the training rows.

Each is a ``pyspark.ml`` estimator whose model holds a few numbers per column
(the target encoder: one small table) and applies them as column expressions.
Columns are rewritten in place, so names stay those of the feature store.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract
from ..functions import scalars as S
from ..session import cut
from . import columnar
from .lookup import attach
from .quantiles import melt, quantile_table
from .splits import plain_fold

# --- fixed values -----------------------------------------------------------
MISSING_LABEL = "missing"          # categorical imputer
TREE_MISSING_LABEL = "Missing"     # tree preparation
ENCODER_MISSING_LABEL = "__NA__"   # target encoder
# --- end of fixed values ----------------------------------------------------


class _Learned(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A model that rewrites columns from a ``{column: numbers}`` parameter."""

    learned = Param(Params._dummy(), "learned", "learned values per column")

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, learned: dict | None = None):
        super().__init__()
        self._setDefault(inputCols=[], learned={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def expression(self, name: str, values) -> Column:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        learned = self.getOrDefault(self.learned)
        changed = {c: self.expression(c, learned[c]) for c in self.getInputCols() if c in learned}
        return dataset.withColumns(changed) if changed else dataset


class _ColumnEstimator(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})


# --- E1 ---------------------------------------------------------------------

class MedianImputerModel(_Learned):
    def expression(self, name, values):
        return F.coalesce(F.col(name).cast("double"), F.lit(float(values)))


class MedianImputer(_ColumnEstimator):
    """Exact medians; a column without any known value is filled with 0."""

    def _fit(self, dataset):
        cols = self.getInputCols()
        medians = quantile_table(dataset, cols, [0.5]) if cols else {}
        return MedianImputerModel(inputCols=cols, learned={c: v[0] if v[0] is not None else 0.0 for c, v in medians.items()})


# --- E2 ---------------------------------------------------------------------

GRID_STEPS = (0.5, 0.04, 0.003)     # one round of candidates each
GRID_HALF = 6
GRID_ROUNDS = 80                    # steps double at the edge, so this reaches any power a double can hold


def yeo_johnson(x: Column, power: Column | float) -> Column:
    """The transform for one value; ``power`` may be a number or a column."""
    if isinstance(power, (int, float)):
        up = F.log1p(x) if power == 0 else (F.pow(x + 1.0, F.lit(float(power))) - 1.0) / F.lit(float(power))
        low = F.lit(2.0 - power)
        down = -F.log1p(-x) if power == 2 else -(F.pow(1.0 - x, low) - 1.0) / low
        return F.when(x >= 0, up).when(x < 0, down)
    low = F.lit(2.0) - power
    up = F.when(F.abs(power) < 1e-12, F.log1p(x)).otherwise(F.try_divide(F.pow(x + 1.0, power) - 1.0, power))
    down = F.when(F.abs(low) < 1e-12, -F.log1p(-x)).otherwise(-F.try_divide(F.pow(1.0 - x, low) - 1.0, low))
    return F.when(x >= 0, up).when(x < 0, down)


# Cells of the digest of a column; each is a weighted centroid.
DIGEST_CELLS = 1024


def _log_scaled(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def _constants(rows: DataFrame) -> dict:
    """Row count, the part of the likelihood that does not depend on spread, and the range; constant columns left out."""
    x = F.col("value")
    found = rows.groupBy("column").agg(F.count(x).alias("n"), F.sum(_log_scaled(x)).alias("tilt"), F.min(x).alias("low"), F.max(x).alias("high"))
    return {r["column"]: (r["n"], r["tilt"], r["low"], r["high"]) for r in found.collect() if r["low"] < r["high"]}


def _digests(rows: DataFrame, constants: dict) -> dict:
    """Weighted centroids (means, rows) of each column, at most ``DIGEST_CELLS`` and one; they merge by adding up."""
    keyed = rows.sparkSession.createDataFrame([(c, low, high) for c, (_, _, low, high) in constants.items()], f"column {rows.schema['column'].dataType.simpleString()}, low double, high double")
    span = _log_scaled(F.col("high")) - _log_scaled(F.col("low"))
    cell = F.floor((_log_scaled(F.col("value")) - _log_scaled(F.col("low"))) / span * DIGEST_CELLS)
    cells = rows.join(F.broadcast(keyed), "column").groupBy("column", cell.alias("cell")).agg(F.avg("value").alias("mean"), F.count("value").alias("n"))
    found: dict = {}
    for r in cells.collect():
        found.setdefault(r["column"], []).append((r["mean"], r["n"]))
    return {c: tuple(np.array(v, dtype=float).T) for c, v in found.items()}


def _score(variance: float | None, n: int, tilt: float, power: float) -> float:
    usable = variance is not None and variance > 1e-300 and math.isfinite(variance)
    return -n / 2 * math.log(variance) + (power - 1) * tilt if usable else -math.inf


def _digest_likelihoods(digests: dict, grids: dict, constants: dict) -> dict:
    result = {}
    with np.errstate(all="ignore"):
        for c, grid in grids.items():
            x, weight = digests[c]
            n, tilt = constants[c][:2]
            scores = []
            for p in grid:
                up = np.log1p(np.maximum(x, 0)) if p == 0 else (np.power(np.maximum(x, 0) + 1, p) - 1) / p
                down = -np.log1p(np.maximum(-x, 0)) if p == 2 else -(np.power(1 + np.maximum(-x, 0), 2 - p) - 1) / (2 - p)
                t = np.where(x >= 0, up, down)
                mean = np.average(t, weights=weight)
                scores.append(_score(float(np.average((t - mean) ** 2, weights=weight)), n, tilt, p))
            result[c] = scores
    return result


def _likelihoods(rows: DataFrame, grids: dict, constants: dict) -> dict:
    """Log-likelihood per column and candidate power, from one aggregation."""
    key = rows.schema["column"].dataType.simpleString()
    candidates = rows.sparkSession.createDataFrame(list(grids.items()), f"column {key}, powers array<double>")
    x = F.col("value")
    spreads = rows.join(F.broadcast(candidates), "column").groupBy("column").agg(F.array(*[
        F.var_pop(yeo_johnson(x, F.get("powers", F.lit(i)))) for i in range(2 * GRID_HALF + 1)]).alias("v")).collect()
    result = {c: [-math.inf] * len(grid) for c, grid in grids.items()}
    for r in spreads:
        c = r["column"]
        result[c] = [_score(v, *constants[c][:2], p) for v, p in zip(r["v"], grids[c])]
    return result


def _parabola_peak(grid: list[float], scores: list[float], i: int) -> float:
    if i in (0, len(grid) - 1):
        return grid[i]
    left, mid, right = scores[i - 1], scores[i], scores[i + 1]
    bend = left - 2 * mid + right
    if not all(map(math.isfinite, (left, mid, right))) or bend >= 0:
        return grid[i]
    return grid[i] + (grid[1] - grid[0]) * 0.5 * (left - right) / bend


def _climb(likelihoods: Callable[[dict], dict], center: dict, steps: Sequence[float]) -> dict:
    """The peak of each column: a grid, then finer ones around the peak so far.

    While the best point is on the edge the grid moves there and widens, so no
    power is out of reach.  A column whose likelihood has no peak is an error.
    """
    center, powers, step = dict(center), dict(center), dict.fromkeys(center, steps[0])
    for _ in range(GRID_ROUNDS):
        grids = {c: [center[c] + i * s for i in range(-GRID_HALF, GRID_HALF + 1)] for c, s in step.items() if s}
        if not grids:
            return powers
        for c, scores in likelihoods(grids).items():
            grid = grids[c]
            if max(scores) == -math.inf:
                center[c] = 0.0         # beyond what a double can hold: start again, finer
                step[c] = step[c] / 4
                continue
            best = max(range(len(grid)), key=scores.__getitem__)
            if best in (0, len(grid) - 1):
                powers[c] = center[c] = grid[best]
                step[c] *= 2
                continue
            powers[c] = center[c] = _parabola_peak(grid, scores, best)
            step[c] = next((s for s in steps if s < step[c] * 0.5), 0.0) if step[c] <= steps[0] else step[c] / 4
    raise ArithmeticError(f"no power maximises the likelihood of {sorted(c for c, s in step.items() if s)}")


def fit_long_powers(rows: DataFrame) -> dict:
    """Maximum-likelihood power of each key of (column, value) rows without nulls; constant columns left out.

    One scan for counts and ranges, one for a digest of each column, on which
    the driver finds the peak; two exact scans around it refine it (more only
    where the digest was so coarse that the peak lies outside their grid).
    """
    constants = _constants(rows)
    if not constants:
        return {}
    return _peaks(constants, _digests(rows, constants), lambda grids: _likelihoods(rows, grids, constants))


def fit_array_powers(arrays: DataFrame, n: int, prepare: columnar.Prepare | None = None) -> dict:
    """The same for the positions of a column of arrays."""
    constants = columnar.constants(arrays, n, prepare)
    if not constants:
        return {}

    def likelihoods(grids: dict) -> dict:
        found = columnar.power_variances(arrays, n, grids, prepare)
        return {c: [_score(v, *constants[c][:2], p) for v, p in zip(found[c], grid)] for c, grid in grids.items()}
    return _peaks(constants, columnar.digests(arrays, n, constants, DIGEST_CELLS, prepare), likelihoods)


def _peaks(constants: dict, digests: dict, likelihoods: Callable[[dict], dict]) -> dict:
    near = _climb(lambda grids: _digest_likelihoods(digests, grids, constants), dict.fromkeys(constants, 0.0), GRID_STEPS)
    return _climb(likelihoods, near, GRID_STEPS[1:])


def fit_powers(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Maximum-likelihood power per column; 1 for a constant column."""
    return {c: 1.0 for c in cols} | fit_long_powers(melt(df, cols).where(F.col("value").isNotNull()))


class PowerTransformModel(_Learned):
    """Learned values per column: power, mean, standard deviation."""

    def expression(self, name, values):
        power, mean, std = values
        return (yeo_johnson(F.col(name).cast("double"), power) - F.lit(mean)) / F.lit(std)


class PowerTransform(_ColumnEstimator):
    """Yeo-Johnson with maximum-likelihood powers, then zero mean and unit variance."""

    def _fit(self, dataset):
        cols = self.getInputCols()
        if not cols:
            return PowerTransformModel(inputCols=[], learned={})
        # The search scans the columns many times, so they are stored as they are now.
        known = cut(dataset.select(*[F.col(c).cast("double").alias(c) for c in cols]))
        powers = fit_powers(known, cols)
        bent = known.select(*[yeo_johnson(F.col(c).cast("double"), powers[c]).alias(c) for c in cols])
        row = bent.agg(*[e for i, c in enumerate(cols) for e in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]).first()
        learned = {c: [powers[c], row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0] for i, c in enumerate(cols)}
        return PowerTransformModel(inputCols=cols, learned=learned)


# --- E3 ---------------------------------------------------------------------

class RobustScalingModel(_Learned):
    """Learned values per column: median, interquartile range."""

    def expression(self, name, values):
        center, scale = values
        return (F.col(name).cast("double") - F.lit(center)) / F.lit(scale)


class RobustScaling(_ColumnEstimator):
    """Exact quartiles; an interquartile range of 0 counts as 1."""

    def _fit(self, dataset):
        cols = self.getInputCols()
        quartiles = quantile_table(dataset, cols, [0.25, 0.5, 0.75]) if cols else {}
        learned = {}
        for c, (low, middle, high) in quartiles.items():
            learned[c] = [middle or 0.0, ((high - low) or 1.0) if high is not None else 1.0]
        return RobustScalingModel(inputCols=cols, learned=learned)


# --- E4 ---------------------------------------------------------------------

class ConstantImputer(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    label = Param(Params._dummy(), "label", "text in place of null", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, label: str = MISSING_LABEL):
        super().__init__()
        self._setDefault(inputCols=[], label=MISSING_LABEL)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset):
        label = self.getOrDefault(self.label)
        filled = {c: S.fill_label(F.col(c).cast("string"), label) for c in self.getInputCols() if c in dataset.columns}
        return dataset.withColumns(filled) if filled else dataset


# --- E5 ---------------------------------------------------------------------

def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value): the most frequent known value, the smallest on a tie."""
    counts = melt(df, cols).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("order"), F.col("value")))
    return counts.groupBy("column").agg(first.alias("first")).select("column", F.col("first.value").alias("value"))


class ModeImputerModel(_Learned):
    def expression(self, name, values):
        return F.coalesce(F.col(name).cast("double"), F.lit(float(values)))


class ModeImputer(_ColumnEstimator):
    """Most frequent value of 0/1 or other numeric columns; 0 where nothing is known."""

    def _fit(self, dataset):
        cols = self.getInputCols()
        found = {r["column"]: r["value"] for r in most_frequent(dataset, cols).collect()} if cols else {}
        return ModeImputerModel(inputCols=cols, learned={c: found.get(c, 0.0) for c in cols})


# --- E7, A7 -----------------------------------------------------------------

class _EncoderParams(HasInputCols, HasLabelCol):
    idCol = Param(Params._dummy(), "idCol", "row id the folds are drawn from", TypeConverters.toString)
    folds = Param(Params._dummy(), "folds", "number of folds", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "fold seed", TypeConverters.toInt)
    mode = Param(Params._dummy(), "mode", "'oof' or 'full': how training rows are encoded", TypeConverters.toString)

    def _encoder_defaults(self):
        self._setDefault(inputCols=[], labelCol=contract.TARGET_COLUMN, idCol=contract.ID_COLUMN,
                         folds=contract.CV_FOLDS, seed=contract.SEED, mode="oof")


class CrossFitEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Mean label per category.

    Totals per (column, category, fold) are one aggregation; the out-of-fold
    mean of a row is the category's total less that of the row's own fold.
    Categories without other rows get the overall mean.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, labelCol: str | None = None, idCol: str | None = None,
                 folds: int | None = None, seed: int | None = None, mode: str | None = None):
        super().__init__()
        self._encoder_defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "CrossFitEncoderModel":
        label, row_id = self.getLabelCol(), self.getOrDefault(self.idCol)
        cols = [c for c in self.getInputCols() if c in dataset.columns]
        few = dataset.select(label).limit(self.getOrDefault(self.folds)).count()
        if few == 0:
            raise ValueError("no rows to learn an encoding from")
        folds = min(max(2, self.getOrDefault(self.folds)), max(2, few))
        model = CrossFitEncoderModel(inputCols=cols, idCol=row_id, folds=folds, seed=self.getOrDefault(self.seed),
                                     mode=self.getOrDefault(self.mode), labelCol=label,
                                     overall=float(dataset.agg(F.avg(label)).first()[0]))
        if not cols:
            return model
        keyed = dataset.select(
            plain_fold(row_id, folds, self.getOrDefault(self.seed)).alias("fold"), F.col(label).cast("double").alias("y"),
            *[S.fill_label(F.col(c).cast("string"), ENCODER_MISSING_LABEL).alias(c) for c in cols])
        long = keyed.unpivot(["fold", "y"], cols, "column", "category")
        totals = cut(long.groupBy("column", "category", "fold").agg(F.sum("y").alias("s"), F.count("y").alias("n")))
        return model._learn(totals)


class CrossFitEncoderModel(Model, _EncoderParams, MLWritable, MLReadable):
    overall = Param(Params._dummy(), "overall", "mean label over all training rows", TypeConverters.toFloat)
    sizes = Param(Params._dummy(), "sizes", "rows and bytes of text of both tables per column")

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, idCol=None, folds=None, seed=None, mode=None, overall=None):
        super().__init__()
        self._encoder_defaults()
        self._setDefault(overall=0.0, sizes={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.full: DataFrame | None = None      # (column, category, mean, n)
        self.held: DataFrame | None = None      # (column, category, fold, mean, n): without the fold

    def _learn(self, totals: DataFrame) -> "CrossFitEncoderModel":
        whole = totals.groupBy("column", "category").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        self.full = cut(whole.select("column", "category", F.try_divide("s", "n").alias("mean"), "n"))
        both = totals.alias("f").join(whole.alias("w"), ["column", "category"])
        self.held = cut(both.select(
            "column", "category", "fold",
            F.try_divide(F.col("w.s") - F.col("f.s"), F.col("w.n") - F.col("f.n")).alias("mean"), F.col("f.n").alias("n")))
        sizes: dict[str, dict[str, list[int]]] = {}
        for name, table in (("full", self.full), ("held", self.held)):
            measured = table.groupBy("column").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("category")).alias("text"))
            for r in measured.collect():
                sizes.setdefault(r["column"], {})[name] = [r["rows"], r["text"]]
        self._set(sizes=sizes)
        return self

    def _encode(self, dataset: DataFrame, held_out: bool) -> DataFrame:
        overall = F.lit(self.getOrDefault(self.overall))
        sizes = self.getOrDefault(self.sizes)
        order = dataset.columns
        fold = plain_fold(self.getOrDefault(self.idCol), self.getOrDefault(self.folds), self.getOrDefault(self.seed))
        if held_out:
            dataset = dataset.withColumn("_fold", fold)
        for c in self.getInputCols():
            if c not in order or c not in sizes:
                continue
            keys = {"category": S.fill_label(F.col(c).cast("string"), ENCODER_MISSING_LABEL)}
            if held_out:
                keys["fold"] = F.col("_fold")
            table = (self.held if held_out else self.full).where(F.col("column") == c)
            rows, text = sizes[c]["held" if held_out else "full"]
            dataset = attach(dataset, keys, table, "mean", "_encoded", rows, text)
            dataset = dataset.withColumn(c, F.coalesce("_encoded", overall)).drop("_encoded")
        return dataset.select(*order)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """New rows: every category's mean over all training rows."""
        return self._encode(dataset, False)

    def transformTraining(self, dataset: DataFrame) -> DataFrame:
        """The rows the model was fitted on, by the ``mode`` parameter."""
        return self._encode(dataset, self.getOrDefault(self.mode) == "oof")

    def write(self):
        return _EncoderWriter(self)

    @classmethod
    def read(cls):
        return _EncoderReader(cls)


class _EncoderWriter(MLWriter):
    def __init__(self, model: CrossFitEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        if self.model.full is not None:
            self.model.full.write.parquet(f"{path}/full")
            self.model.held.write.parquet(f"{path}/held")


class _EncoderReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        if model.getOrDefault(model.sizes):
            model.full = self.sparkSession.read.parquet(f"{path}/full")
            model.held = self.sparkSession.read.parquet(f"{path}/held")
        return model


def encode_training(model: Model, dataset: DataFrame) -> DataFrame:
    """Apply a fitted stage to its own training rows."""
    apply: Callable = getattr(model, "transformTraining", model.transform)
    return apply(dataset)
