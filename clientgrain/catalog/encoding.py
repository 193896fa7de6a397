"""Fitted column transforms."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import contract
from ..functions.hashing import HEX_DIGITS
from ..operators import encoders as E
from ..operators.one_hot import slot_of, wide_one_hot_stages
from ..operators.routing import fit_stages, one_hot_stages
from . import query
from .common import app, rounded, with_roles

APPLICATION = with_roles("application")
AMOUNTS = ["AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "EXT_SOURCE_2"]


@query(f"{APPLICATION}, m AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in AMOUNTS)} FROM application) "
       f"SELECT a.SK_ID_CURR, {', '.join(f'round(coalesce(a.{c}, m.{c}), 6) AS {c}' for c in AMOUNTS)} FROM application a, m")
def median_impute(spark, sf_dir):
    df = app(spark, sf_dir).select("SK_ID_CURR", *AMOUNTS)
    return rounded(E.MedianImputer(inputCols=AMOUNTS).fit(df).transform(df))


FLAGS = {"FLAG_DOCUMENT_2": 5, "FLAG_DOCUMENT_3": 7, "REGION_RATING_CLIENT_W_CITY": 9}
HOLES = [f"CASE WHEN SK_ID_CURR % {k} = 1 THEN NULL ELSE {c} END AS {c}" for c, k in FLAGS.items()]
MODES = ", ".join(f"(SELECT {c} FROM h WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}" for c in FLAGS)


@query(f"{APPLICATION}, h AS (SELECT SK_ID_CURR, {', '.join(HOLES)} FROM application), m AS (SELECT {MODES}) "
       f"SELECT h.SK_ID_CURR, {', '.join(f'CAST(coalesce(h.{c}, m.{c}) AS DOUBLE) AS {c}' for c in FLAGS)} FROM h, m")
def mode_impute(spark, sf_dir):
    df = app(spark, sf_dir).selectExpr("SK_ID_CURR", *HOLES)
    return E.ModeImputer(inputCols=list(FLAGS)).fit(df).transform(df)


@query(f"{APPLICATION}, m AS (SELECT {', '.join(f'quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.5) AS {c}_2, quantile_cont({c}, 0.75) AS {c}_3' for c in AMOUNTS)} FROM application) "
       f"SELECT a.SK_ID_CURR, {', '.join(f'round((a.{c} - m.{c}_2) / CASE WHEN m.{c}_3 = m.{c}_1 THEN 1.0 ELSE m.{c}_3 - m.{c}_1 END, 6) AS {c}' for c in AMOUNTS)} FROM application a, m")
def robust_scale(spark, sf_dir):
    df = app(spark, sf_dir).select("SK_ID_CURR", *AMOUNTS)
    return rounded(E.RobustScaling(inputCols=AMOUNTS).fit(df).transform(df))


POWERS = {"AMT_CREDIT": 0.3, "DAYS_REGISTRATION": 1.4, "EXT_SOURCE_2": 0.0, "DAYS_ID_PUBLISH": 2.0}


def power_sql(c: str, power: float) -> str:
    x = f"CAST({c} AS DOUBLE)"
    up = f"ln({x} + 1)" if power == 0 else f"(pow({x} + 1, {power}) - 1) / {power}"
    down = f"-ln(1 - {x})" if power == 2 else f"-(pow(1 - {x}, {2 - power}) - 1) / {2 - power}"
    return f"round(CASE WHEN {x} >= 0 THEN {up} WHEN {x} < 0 THEN {down} END, 4) AS {c}"


@query(f"{APPLICATION} SELECT SK_ID_CURR, {', '.join(power_sql(c, p) for c, p in POWERS.items())} FROM application")
def yeo_johnson_apply(spark, sf_dir):
    return app(spark, sf_dir).select("SK_ID_CURR", *[
        F.round(E.yeo_johnson(F.col(c).cast("double"), p), 4).alias(c) for c, p in POWERS.items()])


@query()
def yeo_johnson_fit(spark, sf_dir):
    """Learned powers, means and deviations; no closed form in SQL."""
    df = E.MedianImputer(inputCols=AMOUNTS).fit(base := app(spark, sf_dir).select("SK_ID_CURR", *AMOUNTS)).transform(base)
    model = E.PowerTransform(inputCols=AMOUNTS).fit(df)
    rows = [(c, *v) for c, v in model.getOrDefault(model.learned).items()]
    return spark.createDataFrame(rows, "column string, power double, mean double, std double")


CATEGORIES = ["CODE_GENDER", "NAME_EDUCATION_TYPE", "FLAG_OWN_CAR"]
FOLD = f"CAST(('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || '-{contract.SEED}'), 1, {HEX_DIGITS}))::BIGINT % {contract.CV_FOLDS} AS INT)"
KEYED = (f"k AS (SELECT SK_ID_CURR, TARGET, {FOLD} AS fold, "
         f"{', '.join(f"coalesce({c}, '__NA__') AS {c}" for c in CATEGORIES)} FROM application)")


@query(f"{APPLICATION}, {KEYED} SELECT SK_ID_CURR, "
       + ", ".join(f"round((SELECT avg(x.TARGET) FROM k x WHERE x.{c} = k.{c}), 6) AS {c}" for c in CATEGORIES) + " FROM k")
def target_encode_full(spark, sf_dir):
    df = app(spark, sf_dir).select("SK_ID_CURR", "TARGET", *CATEGORIES)
    model = E.CrossFitEncoder(inputCols=CATEGORIES, mode="full").fit(df)
    return rounded(E.encode_training(model, df).drop("TARGET"))


@query(f"{APPLICATION}, {KEYED}, g AS (SELECT avg(TARGET) AS m FROM k), "
       + ", ".join(f"o{i} AS (SELECT {c}, f.fold, "
                   f"(SELECT avg(x.TARGET) FROM k x WHERE x.{c} = c.{c} AND x.fold <> f.fold) AS m "
                   f"FROM (SELECT DISTINCT {c} FROM k) c, (SELECT DISTINCT fold FROM k) f)" for i, c in enumerate(CATEGORIES))
       + " SELECT k.SK_ID_CURR, " + ", ".join(f"round(coalesce(o{i}.m, g.m), 6) AS {c}" for i, c in enumerate(CATEGORIES))
       + " FROM k CROSS JOIN g "
       + " ".join(f"LEFT JOIN o{i} ON k.{c} = o{i}.{c} AND k.fold = o{i}.fold" for i, c in enumerate(CATEGORIES)))
def target_encode_oof(spark, sf_dir):
    df = app(spark, sf_dir).select("SK_ID_CURR", "TARGET", *CATEGORIES)
    model = E.CrossFitEncoder(inputCols=CATEGORIES, mode="oof").fit(df)
    return rounded(E.encode_training(model, df).drop("TARGET"))


BRAND_ENCODING = ("WITH t AS (SELECT l_orderkey * 10 + l_linenumber AS line_id, p_brand, "
                  "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned FROM lineitem JOIN part ON l_partkey = p_partkey) ")


@query(BRAND_ENCODING + "SELECT p_brand, count(*) AS n, round(avg(returned), 6) AS encoded FROM t GROUP BY p_brand")
def category_means(spark, sf_dir):
    from ..sources import roles
    lines = roles.read(spark, sf_dir, "lineitem").join(roles.read(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    df = lines.selectExpr("l_orderkey * 10 + l_linenumber AS line_id", "p_brand",
                          "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned")
    model = E.CrossFitEncoder(inputCols=["p_brand"], labelCol="returned", idCol="line_id").fit(df)
    return rounded(model.full.select(F.col("category").alias("p_brand"), "n", F.col("mean").alias("encoded")))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(f"{APPLICATION}, f AS (SELECT SK_ID_CURR, coalesce(NAME_EDUCATION_TYPE, 'missing') AS v FROM application) SELECT SK_ID_CURR, "
       + ", ".join(f"CAST(v = '{s}' AS INT) AS {s}" for s in [*SEGMENTS, "missing"]) + " FROM f")
def one_hot(spark, sf_dir):
    df = app(spark, sf_dir).select("SK_ID_CURR", "NAME_EDUCATION_TYPE")
    for stage in one_hot_stages(["NAME_EDUCATION_TYPE"]):
        fitted = stage.fit(df) if hasattr(stage, "fit") else stage
        labels = fitted.labelsArray[0] if hasattr(fitted, "labelsArray") else None
        if labels is not None:
            names = list(labels)
        df = fitted.transform(df)
    slots = vector_to_array("NAME_EDUCATION_TYPE_vec")
    return df.select("SK_ID_CURR", *[slots[i].cast("int").alias(n) for i, n in enumerate(names)])


LINE_LABELS = "SELECT l_orderkey * 10 + l_linenumber AS line_id, l_returnflag, CAST(l_orderkey AS VARCHAR(20)) AS in_order, CAST(l_partkey AS VARCHAR(20)) AS part FROM lineitem"
WIDE = ("in_order", "part")


@query(f"WITH t AS ({LINE_LABELS}), "
       + ", ".join(f"s_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS BIGINT) AS slot FROM (SELECT DISTINCT {c} FROM t WHERE l_returnflag = 'R'))" for c in WIDE)
       + " SELECT line_id, " + ", ".join(f"s_{c}.slot AS {c}_slot, (SELECT count(*) FROM s_{c}) AS {c}_size" for c in WIDE)
       + " FROM t " + " ".join(f"LEFT JOIN s_{c} ON t.{c} = s_{c}.{c}" for c in WIDE))
def one_hot_wide(spark, sf_dir):
    """Slots of order and part, learnt from returned lines, for all lines; orders without a returned line have none."""
    from ..sources import roles
    lines = roles.read(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS line_id", "l_returnflag",
                                                             "CAST(l_orderkey AS STRING) AS in_order", "CAST(l_partkey AS STRING) AS part")
    model, _ = fit_stages(wide_one_hot_stages(WIDE), lines.where("l_returnflag = 'R'"))
    out = model.transform(lines)
    return out.select("line_id", *[e.alias(f"{c}_{n}") for c in WIDE for n, e in zip(("slot", "size"), slot_of(f"{c}_vec"))])
