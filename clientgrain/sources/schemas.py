"""Explicit schemas, so that no read has to infer one."""

from __future__ import annotations

from pyspark.sql import types as T

from .. import contract


def application_schema() -> T.StructType:
    """The raw application table: ids, label, and every raw contract feature."""
    derived = set(contract.DERIVED_NUMERIC) | {"CREDIT_BURDEN_GROUP"}
    fields = [T.StructField(contract.ID_COLUMN, T.LongType()), T.StructField(contract.TARGET_COLUMN, T.IntegerType())]
    aggregated = set(contract.bureau_features()) | set(contract.previous_features())
    for name in contract.numerical_features():
        if name not in derived and name not in aggregated:
            fields.append(T.StructField(name, T.DoubleType()))
    for name in contract.categorical_features():
        if name not in derived:
            fields.append(T.StructField(name, T.StringType()))
    for name in contract.binary_features():
        if name not in aggregated:
            fields.append(T.StructField(name, T.IntegerType()))
    return T.StructType(fields)


def bureau_schema() -> T.StructType:
    numeric = [T.StructField(c, T.DoubleType()) for c in contract.BUREAU_NUMERIC]
    return T.StructType([
        T.StructField(contract.ID_COLUMN, T.LongType()), T.StructField(contract.CREDIT_ID, T.LongType()),
        *numeric,
        *(T.StructField(c, T.StringType()) for c in ("CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE")),
    ])


def bureau_balance_schema() -> T.StructType:
    return T.StructType([
        T.StructField(contract.CREDIT_ID, T.LongType()),
        T.StructField("MONTHS_BALANCE", T.IntegerType()),
        T.StructField("STATUS", T.StringType()),
    ])


def previous_schema() -> T.StructType:
    return T.StructType([
        T.StructField(contract.PREVIOUS_ID, T.LongType()), T.StructField(contract.ID_COLUMN, T.LongType()),
        *(T.StructField(c, T.DoubleType()) for c in contract.PREVIOUS_NUMERIC),
    ])


def scoring_record_schema() -> T.StructType:
    """The request contract: 17 fields, the last column of each line is 'may be null'."""
    required = [
        ("AMT_CREDIT", T.DoubleType()), ("AMT_ANNUITY", T.DoubleType()),
        ("AMT_GOODS_PRICE", T.DoubleType()), ("AMT_INCOME_TOTAL", T.DoubleType()),
        ("DAYS_BIRTH", T.DoubleType()), ("DAYS_EMPLOYED", T.DoubleType()),
        ("DAYS_ID_PUBLISH", T.DoubleType()), ("CODE_GENDER", T.StringType()),
        ("FLAG_OWN_CAR", T.StringType()), ("NAME_EDUCATION_TYPE", T.StringType()),
        ("NAME_FAMILY_STATUS", T.StringType()), ("NAME_CONTRACT_TYPE", T.StringType()),
        ("REGION_RATING_CLIENT_W_CITY", T.IntegerType()),
    ]
    optional = [(c, T.DoubleType()) for c in
                ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "DEF_30_CNT_SOCIAL_CIRCLE")]
    return T.StructType([T.StructField(n, t, False) for n, t in required]
                        + [T.StructField(n, t, True) for n, t in optional])
