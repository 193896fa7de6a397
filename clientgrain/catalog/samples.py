"""Splits (R1-R3)."""

from __future__ import annotations

from .. import contract
from ..functions.hashing import HASH_SPACE, HEX_DIGITS
from ..operators import splits as SP
from . import query
from .common import app, with_roles

HASH = f"('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || '-{contract.SEED}'), 1, {HEX_DIGITS}))::BIGINT"
HASHED = f"{with_roles('application')}, h AS (SELECT SK_ID_CURR, TARGET, {HASH} AS h FROM application)"
RANKED = (f"{HASHED}, r AS (SELECT *, row_number() OVER (PARTITION BY TARGET ORDER BY h) AS rn, "
          "count(*) OVER (PARTITION BY TARGET) AS n FROM h)")
K = contract.CV_FOLDS


@query(f"{HASHED} SELECT SK_ID_CURR, TARGET, CAST(h < {int(contract.TEST_SIZE * HASH_SPACE)} AS INT) AS is_test FROM h")
def stratified_holdout(spark, sf_dir):
    return SP.stratified_holdout(app(spark, sf_dir).select("SK_ID_CURR", "TARGET"), exact=False)


@query(f"{RANKED} SELECT SK_ID_CURR, TARGET, CAST(rn <= floor(n * {contract.TEST_SIZE} + 0.5) AS INT) AS is_test FROM r")
def stratified_holdout_exact(spark, sf_dir):
    return SP.stratified_holdout(app(spark, sf_dir).select("SK_ID_CURR", "TARGET"))


@query(f"{HASHED} SELECT SK_ID_CURR, TARGET, CAST(h % {K} AS INT) AS fold FROM h")
def stratified_folds(spark, sf_dir):
    return SP.stratified_folds(app(spark, sf_dir).select("SK_ID_CURR", "TARGET"), exact=False)


@query(f"{RANKED} SELECT SK_ID_CURR, TARGET, CAST({' + '.join(f'CAST(rn > n * {i} // {K} AS INT)' for i in range(1, K))} AS INT) AS fold FROM r")
def stratified_folds_exact(spark, sf_dir):
    return SP.stratified_folds(app(spark, sf_dir).select("SK_ID_CURR", "TARGET"))


@query(f"{HASHED} SELECT SK_ID_CURR, CAST(h % {K} AS INT) AS fold FROM h")
def plain_folds(spark, sf_dir):
    return SP.plain_folds(app(spark, sf_dir).select("SK_ID_CURR"))
