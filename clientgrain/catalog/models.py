"""Modelling as Spark jobs.

The queries take all columns of the contract that the store has, with the
published parameters.  Only ``quick_fit`` asks for fewer, larger steps: ``QUICK``.

The split, the preprocessing and the models are made once per session and
folder and shared; only ``fit_logistic`` does everything itself.  What SQL says
about a fitted model: rows and classes of every split, how decisions follow from
scores, names and ranks.  ``linear_permutation`` has a given scorer, so that SQL
says all of it.  How good the models are is checked by tests on planted signals.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract
from ..functions.hashing import HEX_DIGITS
from ..operators import metrics as MT
from ..operators.history import HistoryAggregator
from ..operators.routing import FeatureLists, feature_names, fit_stages, preprocessing, preprocessing_kind
from ..operators.splits import train_and_test
from ..plans import selection as SE
from ..plans import training as TR
from ..plans.feature_store import build_feature_store
from ..plans.models import MODELS
from ..plans.scoring import score
from ..session import scratch_path
from ..sources import roles
from . import query
from .common import with_roles
from .samples import RANKED

# Growth of quick_fit alone; the model is published with 5,000 trees.
QUICK = {"lightgbm": {"n_estimators": 20, "learning_rate": 0.1}}

# Models that train_and_compare trains at a time.
AT_A_TIME = 4

_stores: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature store, written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        path = scratch_path(spark, "feature-store")
        build_feature_store(roles.loan_tables(spark, sf_dir), path, aggregates=stored_aggregates(spark, sf_dir))
        _stores[key] = path
    return spark.read.parquet(_stores[key])


def _lists(df: DataFrame) -> FeatureLists:
    return FeatureLists.from_contract(df)


_shared: dict[tuple, object] = {}


def _once(spark: SparkSession, what: tuple, make):
    key = (spark.sparkContext.applicationId, *what)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def stored_aggregates(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The histories by client, written once per session and folder: the store and the scoring of new applications join them."""
    def make():
        tables = roles.loan_tables(spark, sf_dir)
        return HistoryAggregator(tables, scratch_path(spark, "aggregates")).fit(tables["application"]).aggregates
    return _once(spark, ("aggregates", sf_dir), make)


def split_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _once(spark, ("split", sf_dir), lambda: train_and_test(stored(spark, sf_dir)))


def prepared_rows(spark: SparkSession, sf_dir: str, name: str) -> TR.Prepared:
    def make():
        train_rows, _ = split_rows(spark, sf_dir)
        return TR.prepare(name, train_rows, _lists(train_rows))
    return _once(spark, ("prepared", sf_dir, preprocessing_kind(name)), make)


def trained_model(spark: SparkSession, sf_dir: str, name: str) -> TR.Trained:
    """Fitted with the published parameters on the training rows and evaluated on both splits."""
    train_rows, test_rows = split_rows(spark, sf_dir)
    return _once(spark, ("trained", sf_dir, name), lambda: TR.train(
        name, train_rows, test_rows, _lists(train_rows), prepared=prepared_rows(spark, sf_dir, name)))


SPLITS = (f"{RANKED}, split AS (SELECT *, CASE WHEN rn <= floor(n * {{test_size}} + 0.5) THEN 'test' ELSE 'train' END AS split FROM r)")


def _counts_sql(model: str, better: str = "true") -> str:
    return (f"{SPLITS.format(test_size=contract.TEST_SIZE)} SELECT '{model}' AS model, split, count(*) AS n_rows, CAST(sum(TARGET) AS BIGINT) AS n_positive, "
            f"true AS rates_follow, {better} AS better_than_chance FROM split GROUP BY split")


def _counts(trained: TR.Trained, better: Column | None = None) -> DataFrame:
    """Rows and positives of each split as the model's evaluation counted them, and whether its rates follow from its cells."""
    cells = MT._summed(trained.counts, ["model", "split"])
    both = cells.join(trained.metrics, ["model", "split"])
    total = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    follow = ((F.abs(F.col("accuracy") * total - F.col("tp") - F.col("tn")) < 1e-6)
              & (F.abs(F.col("recall") * (F.col("tp") + F.col("fn")) - F.col("tp")) < 1e-6)
              & F.col("roc_auc").between(0, 1))
    # On the rows it was fitted on a model must do better than a coin.
    better = (F.col("split") == "test") | (F.col("roc_auc") > 0.5) if better is None else better
    return both.select("model", "split", total.alias("n_rows"), (F.col("tp") + F.col("fn")).alias("n_positive"),
                       follow.alias("rates_follow"), better.alias("better_than_chance"))


@query(_counts_sql("logistic_regression"))
def fit_logistic(spark, sf_dir):
    df = stored(spark, sf_dir)
    return _counts(TR.train("logistic_regression", *train_and_test(df), _lists(df)))


# A node is split only if both parts keep the published number of rows, which takes twice as many training rows;
# with fewer every tree is a leaf, all rows score alike and the area is that of a coin.
LEAF = MODELS["random_forest"].params["min_samples_leaf"]


@query(_counts_sql("random_forest", f"(split = 'test' OR (SELECT count(*) FROM split WHERE split = 'train') >= {2 * LEAF})"))
def fit_forest(spark, sf_dir):
    return _counts(trained_model(spark, sf_dir, "random_forest"))


@query(_counts_sql("xgboost"))
def fit_gbt(spark, sf_dir):
    return _counts(trained_model(spark, sf_dir, "xgboost"))


@query(_counts_sql("catboost"))
def fit_gbt_early_stop(spark, sf_dir):
    return _counts(trained_model(spark, sf_dir, "catboost"))


@query(_counts_sql("sgd_classifier"))
def fit_svc(spark, sf_dir):
    return _counts(trained_model(spark, sf_dir, "sgd_classifier"))


@query("SELECT 'lightgbm' AS model, true AS train_in_range, true AS val_in_range")
def quick_fit(spark, sf_dir):
    df = stored(spark, sf_dir)
    scores = TR.quick_fit(df, lists=_lists(df), **QUICK["lightgbm"])[1]
    return scores.select("model", F.col("train_score").between(0, 1).alias("train_in_range"), F.col("val_score").between(0, 1).alias("val_in_range"))


@query(f"SELECT 'logistic_regression' AS model, CAST({contract.CV_FOLDS} AS INT) AS n_folds, true AS mean_and_deviation_follow")
def cross_validate(spark, sf_dir):
    df = stored(spark, sf_dir)
    row = TR.cross_validate("logistic_regression", df, _lists(df))
    mean = F.aggregate("cv_scores", F.lit(0.0), lambda a, v: a + v) / F.size("cv_scores")
    spread = F.sqrt(F.aggregate("cv_scores", F.lit(0.0), lambda a, v: a + F.pow(v - F.col("cv_mean"), F.lit(2.0))) / F.size("cv_scores"))
    follow = (F.abs(mean - F.col("cv_mean")) < 1e-9) & (F.abs(spread - F.col("cv_std")) < 1e-9) & F.forall("cv_scores", lambda v: v.between(0, 1))
    return row.select("model", F.size("cv_scores").alias("n_folds"), follow.alias("mean_and_deviation_follow"))


@query(f"SELECT model, true AS overfit_follows FROM (VALUES {', '.join(f'({n!r})' for n in MODELS)}) m(model)")
def train_and_compare(spark, sf_dir):
    """All six models; the published columns of the comparison."""
    for kind in {preprocessing_kind(name): name for name in MODELS}.values():
        prepared_rows(spark, sf_dir, kind)
    # Trees grow one after the other and leave cores idle, so a few models are trained at a time, those of most trees first.
    slowest = sorted(MODELS, key=lambda n: -MODELS[n].params.get("n_estimators", 0))
    with ThreadPool(AT_A_TIME) as pool:
        models = dict(zip(slowest, pool.map(inheritable_thread_target(spark)(lambda n: trained_model(spark, sf_dir, n)), slowest, chunksize=1)))
    done = {name: models[name] for name in MODELS}
    follows = F.abs(F.col("overfit") - (F.col("train_roc_auc") - F.col("test_roc_auc"))) < 1e-9
    return TR.compare(done).select("model", follows.alias("overfit_follows"))


def _slots_sql() -> str:
    """Published order within each kind, of the columns the roles give the store."""
    from .histories import store_columns
    have = set(store_columns())
    number, category, flag = ([c for c in part if c in have] for part in
                              (contract.numerical_features(), contract.categorical_features(), contract.binary_features()))
    orders = {"logistic_regression": [*number, *category, *flag], "catboost": [*number, *flag, *category]}
    rows = ", ".join(f"('{m}', {i}, '{c}')" for m, names in orders.items() for i, c in enumerate(names))
    return f"SELECT model, CAST(slot AS INT) AS slot, feature FROM (VALUES {rows}) s(model, slot, feature)"


@query(_slots_sql())
def preprocessed_features(spark, sf_dir):
    """Slots of the dense and of the tree vector, in order."""
    df = stored(spark, sf_dir)
    lists = _lists(df)
    rows = []
    for name in ("logistic_regression", "catboost"):
        _, prepared = fit_stages(preprocessing(name, df, lists), df)
        rows += [(name, i, n) for i, n in enumerate(feature_names(prepared))]
    return spark.createDataFrame(rows, "model string, slot int, feature string")


def _importance(spark, sf_dir) -> DataFrame:
    return SE.importance_of(trained_model(spark, sf_dir, "logistic_regression"), split_rows(spark, sf_dir)[1])


@query()
def permutation_importance(spark, sf_dir):
    return _importance(spark, sf_dir)


@query()
def select_features(spark, sf_dir):
    return SE.select_features(_importance(spark, sf_dir))


SCORER = tuple(c for c in roles.APPLICATION if c.startswith(("AMT_", "DAYS_", "EXT_SOURCE", "CNT_", "REGION_")))
WEIGHTS = tuple((i * 37 % 11 - 5) / 8 * (1e-5 if c.startswith("AMT_") else 1e-3 if c.startswith("DAYS_") else 1.0) for i, c in enumerate(SCORER))


def _ring_sql() -> str:
    """Every feature's donors, margins and areas, from their definitions."""
    def hashed(seed: int) -> str:
        return f"('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || '-{seed}'), 1, {HEX_DIGITS}))::BIGINT"
    x = [f"coalesce(CAST({c} AS DOUBLE), 0)" for c in SCORER]
    margin = " + ".join(f"{v} * ({w!r})" for v, w in zip(x, WEIGHTS))
    listed, weights = f"[{', '.join(x)}]", f"[{', '.join(f'{w!r}::DOUBLE' for w in WEIGHTS)}]"
    rings = " UNION ALL ".join(
        f"SELECT {r} AS repeat, TARGET, x, margin, coalesce(lead(x) OVER o, first_value(x) OVER (PARTITION BY bucket{r} ORDER BY order{r}, SK_ID_CURR)) AS donor "
        f"FROM b WINDOW o AS (PARTITION BY bucket{r} ORDER BY order{r}, SK_ID_CURR)" for r in range(SE.REPEATS))
    keys = ", ".join(f"{hashed(contract.SEED + 2 * r + 2)} % (SELECT greatest(1, ceil(count(*) / {SE.BUCKET_ROWS})) FROM application) AS bucket{r}, "
                     f"{hashed(contract.SEED + 2 * r + 3)} AS order{r}" for r in range(SE.REPEATS))
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(SCORER))

    def area(rows: str, by: str) -> str:
        return (f"SELECT {by} (sum(CASE WHEN TARGET = 1 THEN rank END) - count(*) FILTER (TARGET = 1) * (count(*) FILTER (TARGET = 1) + 1) / 2.0) "
                f"/ (count(*) FILTER (TARGET = 1) * count(*) FILTER (TARGET = 0)) AS auc FROM (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY {by} score) - 1) / 2.0 AS rank "
                f"FROM {rows} WINDOW w AS ({'PARTITION BY ' + by.rstrip(', ') if by else ''} ORDER BY score))" + (f" GROUP BY {by.rstrip(', ')}" if by else ""))
    return (f"{with_roles('application')}, b AS (SELECT SK_ID_CURR, TARGET, {listed} AS x, {margin} AS margin, {keys} FROM application), rings AS ({rings}), "
            f"variants AS (SELECT repeat, slot, feature, TARGET, margin + (donor[slot + 1] - x[slot + 1]) * {weights}[slot + 1] AS score "
            f"FROM rings CROSS JOIN (VALUES {names}) s(slot, feature)), "
            f"base AS ({area('(SELECT TARGET, margin AS score FROM b)', '')}), areas AS ({area('variants', 'repeat, feature, ')}) "
            "SELECT feature, round(avg(base.auc - areas.auc), 6) + 0.0 AS importance, round(stddev_pop(base.auc - areas.auc), 6) + 0.0 AS importance_std FROM areas, base GROUP BY feature")


@query(_ring_sql())
def linear_permutation(spark, sf_dir):
    """Importance of every input of a given linear scorer on all applications."""
    rows = roles.role_table(spark, sf_dir, "application")
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SCORER])
    found = SE.linear_importance(rows.select(contract.ID_COLUMN, F.col(contract.TARGET_COLUMN).cast("int").alias(contract.TARGET_COLUMN), x.alias("x")), WEIGHTS, SCORER)
    return found.select("feature", *[(F.round(c, 6) + 0.0).alias(c) for c in ("importance", "importance_std")])


@query(f"{SPLITS.format(test_size=contract.TEST_SIZE)} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM split WHERE split = 'test'")
def score_saved_model(spark, sf_dir):
    """A model scores the same after it was saved and loaded."""
    trained, test_rows = trained_model(spark, sf_dir, "logistic_regression"), split_rows(spark, sf_dir)[1]
    path = scratch_path(spark, "model")
    TR.save(trained, path)
    loaded = TR.load(spark, "logistic_regression", path)
    keep = [contract.ID_COLUMN]
    again = TR.scored(loaded, test_rows, keep).withColumnRenamed(TR.SCORE, "again").drop(TR.PREDICTION)
    both = TR.scored(trained, test_rows, keep).join(again, keep)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(TR.SCORE) != F.col("again")).alias("n_different"))


SCORED_NAMES = ("logistic_regression", "sgd_classifier")
_models: dict[tuple[str, str, str], str] = {}


def saved_model(spark: SparkSession, sf_dir: str, name: str) -> TR.Trained:
    """A model trained on the train split, written once per session and folder and read back."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _models:
        path = scratch_path(spark, "model")
        TR.save(trained_model(spark, sf_dir, name), path)
        _models[key] = path
    return TR.load(spark, name, _models[key])


SCORE_SQL = (f"{with_roles('application')} SELECT SK_ID_CURR, m.model_name, CAST({contract.DEFAULT_THRESHOLD} AS DOUBLE) AS threshold, true AS in_range, true AS decision_follows "
             "FROM application, (VALUES {names}) m(model_name)")


def checked_scores(decisions: DataFrame) -> DataFrame:
    follows = F.col("prediction") == (F.col("probability") >= F.col("threshold")).cast("int")
    return decisions.select(contract.ID_COLUMN, "model_name", "threshold", F.col("probability").between(0, 1).alias("in_range"), follows.alias("decision_follows"))


@query(SCORE_SQL.format(names=", ".join(f"('{n}')" for n in SCORED_NAMES)))
def score_batch(spark, sf_dir):
    """Every application, by a model with probabilities and by the margin model."""
    tables = roles.loan_tables(spark, sf_dir)
    # Each model's scoring reads the stored histories.
    aggregates = stored_aggregates(spark, sf_dir)
    return reduce(DataFrame.unionByName, [checked_scores(score(tables["application"], saved_model(spark, sf_dir, n), aggregates)) for n in SCORED_NAMES])
