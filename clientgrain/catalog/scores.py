"""Metrics and comparison (A16-A19, M9, T1-T3) on deterministic scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract
from ..functions.hashing import HASH_SPACE
from ..operators import metrics as MT
from ..operators import splits as SP
from . import query
from .common import app, rounded, with_roles
from .samples import HASH

# Three score formulas stand in for models; halves and thousandths keep them exact.
FORMULAS = {
    "alpha": "coalesce(EXT_SOURCE_1, 0.5)",
    "beta": "1.0 - coalesce(EXT_SOURCE_2, 0.5)",
    "gamma": "CASE WHEN CODE_GENDER = 'M' THEN 0.25 ELSE coalesce(EXT_SOURCE_3, 0.5) END",
}
SCORED = (f"{with_roles('application')}, base AS (SELECT *, CASE WHEN {HASH} < {int(contract.TEST_SIZE * HASH_SPACE)} THEN 'test' ELSE 'train' END AS split "
          "FROM application), scored AS ("
          + " UNION ALL ".join(f"SELECT '{m}' AS model, split, TARGET AS y, CAST({f} AS DOUBLE) AS score, "
                               f"CAST({f} >= {contract.DEFAULT_THRESHOLD} AS INT) AS yhat FROM base" for m, f in FORMULAS.items()) + ")")
HITS = "CAST(sum(CASE WHEN y = 1 AND yhat = 1 THEN 1 ELSE 0 END) AS DOUBLE)"
RATE_SQL = {
    "accuracy": "CAST(sum(CASE WHEN y = yhat THEN 1 ELSE 0 END) AS DOUBLE) / count(*)",
    "precision": f"coalesce({HITS} / nullif(sum(yhat), 0), 0)",
    "recall": f"coalesce({HITS} / nullif(sum(y), 0), 0)",
    "f1": f"coalesce(2 * {HITS} / nullif(sum(yhat) + sum(y), 0), 0)",
}
RATES = ", ".join(f"{e} AS {n}" for n, e in RATE_SQL.items())
METRICS = (f"{SCORED}, rates AS (SELECT model, split, {RATES} FROM scored GROUP BY model, split), "
           "freq AS (SELECT model, split, score, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY model, split, score), "
           "ranked AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, split ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM freq), "
           "auc AS (SELECT model, split, CAST(sum(pos * (below + neg / 2)) AS DOUBLE) / (sum(pos) * sum(neg)) AS roc_auc FROM ranked GROUP BY model, split), "
           "metrics AS (SELECT r.*, a.roc_auc FROM rates r JOIN auc a ON r.model = a.model AND r.split = a.split), "
           "comparison AS (SELECT t.model, t.roc_auc AS train_roc_auc, e.roc_auc AS test_roc_auc, e.accuracy AS test_accuracy, "
           "e.precision AS test_precision, e.recall AS test_recall, e.f1 AS test_f1, CAST(NULL AS DOUBLE) AS cv_mean, CAST(NULL AS DOUBLE) AS cv_std, "
           "t.roc_auc - e.roc_auc AS overfit FROM metrics t JOIN metrics e ON t.model = e.model AND t.split = 'train' AND e.split = 'test')")


def scored(spark, sf_dir) -> DataFrame:
    flagged = SP.stratified_holdout(app(spark, sf_dir), exact=False)
    base = flagged.withColumn("split", F.when(F.col("is_test") == 1, "test").otherwise("train"))
    return reduce(DataFrame.unionByName, [
        base.selectExpr(f"'{m}' AS model", "split", "TARGET AS y", f"CAST({f} AS DOUBLE) AS score",
                        f"CAST({f} >= {contract.DEFAULT_THRESHOLD} AS INT) AS yhat") for m, f in FORMULAS.items()])


@query(f"{SCORED}, cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)) "
       "SELECT m.model, m.split, actual, predicted, (SELECT count(*) FROM scored s WHERE s.model = m.model AND s.split = m.split "
       "AND y = actual AND yhat = predicted) AS n FROM cells, (SELECT DISTINCT model, split FROM scored) m")
def confusion_matrix(spark, sf_dir):
    return MT.confusion_matrix(scored(spark, sf_dir), "y", "yhat", ["model", "split"])


@query(f"{SCORED} SELECT model, split, {', '.join(f'round({e}, 6) AS {n}' for n, e in RATE_SQL.items())} "
       "FROM scored GROUP BY model, split")
def class_metrics(spark, sf_dir):
    return rounded(MT.class_metrics(scored(spark, sf_dir), "y", "yhat", ["model", "split"]))


CELLS = ("c AS (SELECT model, split, CAST(count(*) FILTER (WHERE y = 1 AND yhat = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE y = 0 AND yhat = 1) AS DOUBLE) AS fp, "
         "CAST(count(*) FILTER (WHERE y = 0 AND yhat = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE y = 1 AND yhat = 0) AS DOUBLE) AS fn "
         "FROM scored GROUP BY model, split)")
PER_CLASS = ("p AS (SELECT model, split, '0' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS precision, coalesce(tn / nullif(tn + fp, 0), 0) AS recall, "
             "coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1, CAST(tn + fp AS BIGINT) AS support FROM c UNION ALL "
             "SELECT model, split, '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), "
             "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), CAST(tp + fn AS BIGINT) FROM c)")
ALL_LINES = ("l AS (SELECT * FROM p UNION ALL SELECT model, split, 'accuracy', (tp + tn) / (tp + fp + tn + fn), (tp + tn) / (tp + fp + tn + fn), "
             "(tp + tn) / (tp + fp + tn + fn), CAST(tp + fp + tn + fn AS BIGINT) FROM c UNION ALL "
             "SELECT model, split, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM p GROUP BY model, split UNION ALL "
             "SELECT model, split, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
             "sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM p GROUP BY model, split)")


@query(f"{SCORED}, {CELLS}, {PER_CLASS}, {ALL_LINES} SELECT model, split, class, round(precision, 6) AS precision, round(recall, 6) AS recall, "
       "round(f1, 6) AS f1, support FROM l")
def class_report(spark, sf_dir):
    return rounded(MT.class_report(scored(spark, sf_dir), "y", "yhat", ["model", "split"]))


@query(f"{METRICS} SELECT model, split, round(roc_auc, 6) AS roc_auc FROM auc")
def roc_auc(spark, sf_dir):
    return rounded(MT.roc_auc(scored(spark, sf_dir), "y", "score", ["model", "split"]))


LINE_AUC = ("WITH t AS (SELECT l_extendedprice AS score, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem), "
            "freq AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM t GROUP BY score), "
            "ranked AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM freq) "
            "SELECT round(CAST(sum(pos * (below + neg / 2)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS roc_auc FROM ranked")


@query(LINE_AUC)
def roc_auc_sliced(spark, sf_dir):
    """One large group, by range slices instead of one ordered window."""
    from ..sources import roles
    lines = roles.read(spark, sf_dir, "lineitem").selectExpr("l_extendedprice AS score", "CAST(l_returnflag = 'R' AS INT) AS y")
    return rounded(MT.roc_auc(lines, "y", "score", single_pass_rows=1_000))


NULL_GROUP = "CASE WHEN SK_ID_CURR % 3 = 0 THEN NULL ELSE NAME_EDUCATION_TYPE END"
NULL_AUC = (f"{SCORED}, g AS (SELECT {NULL_GROUP} AS grp, TARGET AS y, coalesce(EXT_SOURCE_1, 0.5) AS score FROM application), "
            "freq AS (SELECT grp, score, sum(y) AS pos, count(*) - sum(y) AS neg FROM g GROUP BY grp, score), "
            "ranked AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY grp ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM freq) "
            "SELECT grp, round(CAST(sum(pos * (below + neg / 2)) AS DOUBLE) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0), 6) AS roc_auc FROM ranked GROUP BY grp")


def _null_groups(spark, sf_dir) -> DataFrame:
    return app(spark, sf_dir).selectExpr(f"{NULL_GROUP} AS grp", "TARGET AS y", "CAST(coalesce(EXT_SOURCE_1, 0.5) AS DOUBLE) AS score")


@query(NULL_AUC)
def roc_auc_null_group(spark, sf_dir):
    """Rows without a group are a group of their own."""
    return rounded(MT.roc_auc(_null_groups(spark, sf_dir), "y", "score", ["grp"]))


@query(NULL_AUC)
def roc_auc_null_group_sliced(spark, sf_dir):
    """The same by range slices."""
    return rounded(MT.roc_auc(_null_groups(spark, sf_dir), "y", "score", ["grp"], single_pass_rows=5))


def _rounded_metrics(columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


@query(f"{METRICS} SELECT model, split, {_rounded_metrics(('accuracy', 'precision', 'recall', 'f1', 'roc_auc'))} FROM metrics")
def split_metrics(spark, sf_dir):
    return rounded(MT.evaluate(scored(spark, sf_dir), "y", "yhat", "score", ["model", "split"]))


@query(f"{METRICS} SELECT model, {_rounded_metrics(MT.COMPARISON_COLUMNS)} FROM comparison")
def model_comparison(spark, sf_dir):
    return rounded(MT.comparison_table(MT.evaluate(scored(spark, sf_dir), "y", "yhat", "score", ["model", "split"])))


@query(f"{METRICS} SELECT model, round(test_roc_auc, 6) AS test_roc_auc FROM comparison ORDER BY comparison.test_roc_auc DESC LIMIT 1")
def best_model(spark, sf_dir):
    return rounded(MT.best_model(MT.comparison_table(
        MT.evaluate(scored(spark, sf_dir), "y", "yhat", "score", ["model", "split"]))))


@query(f"{METRICS} SELECT model, CASE WHEN train_roc_auc - test_roc_auc > {MT.SEVERE_OVERFIT} THEN 'severe' "
       f"WHEN train_roc_auc - test_roc_auc > {MT.MILD_OVERFIT} THEN 'overfit' ELSE 'ok' END AS level FROM comparison")
def overfit_gate(spark, sf_dir):
    table = MT.comparison_table(MT.evaluate(scored(spark, sf_dir), "y", "yhat", "score", ["model", "split"]))
    return table.select("model", MT.overfit_level(F.col("train_roc_auc"), F.col("test_roc_auc")).alias("level"))
