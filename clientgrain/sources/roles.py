"""The star-schema test tables in the roles of the loan tables.

``application_sql`` and friends hold the mapping once, as SELECT lists that
both Spark and the checking engine read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

APPLICATION = {
    "SK_ID_CURR": "c_custkey",
    "TARGET": "CAST(CASE WHEN c_acctbal < 0 OR c_custkey % 13 = 0 THEN 1 ELSE 0 END AS INT)",
    "DAYS_BIRTH": "-(7300 + (c_custkey * 9973) % 18000)",
    "DAYS_EMPLOYED": "CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -((c_custkey * 7919) % 12000) END",
    "DAYS_REGISTRATION": "-((c_custkey * 6151) % 20000)",
    "DAYS_ID_PUBLISH": "-((c_custkey * 4447) % 6000)",
    "AMT_INCOME_TOTAL": "CAST(25650 + (c_custkey * 31) % 300000 AS DOUBLE)",
    "AMT_CREDIT": "CAST(45000 + (c_custkey * 104729) % 1500000 AS DOUBLE)",
    "AMT_ANNUITY": "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(1980 + (c_custkey * 7907) % 60000 AS DOUBLE) END",
    "AMT_GOODS_PRICE": "CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE CAST(40000 + (c_custkey * 99991) % 1400000 AS DOUBLE) END",
    "CNT_FAM_MEMBERS": "CASE WHEN c_custkey % 211 = 0 THEN NULL ELSE CAST(1 + c_custkey % 5 AS DOUBLE) END",
    "EXT_SOURCE_1": "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST((c_custkey * 613) % 1000 AS DOUBLE) / 1000 END",
    "EXT_SOURCE_2": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST((c_custkey * 733) % 1000 AS DOUBLE) / 1000 END",
    "EXT_SOURCE_3": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST((c_custkey * 877) % 1000 AS DOUBLE) / 1000 END",
    "FLAG_DOCUMENT_2": "CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS INT)",
    "FLAG_DOCUMENT_3": "CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS INT)",
    "FLAG_DOCUMENT_6": "CAST(CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS INT)",
    "CODE_GENDER": "CASE WHEN c_custkey % 3 < 2 THEN 'F' ELSE 'M' END",
    "FLAG_OWN_CAR": "CASE WHEN c_custkey % 3 = 1 THEN 'Y' ELSE 'N' END",
    "NAME_EDUCATION_TYPE": "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END",
    "REGION_RATING_CLIENT_W_CITY": "CAST(c_nationkey % 3 + 1 AS INT)",
}

BUREAU = {
    "SK_ID_BUREAU": "o_orderkey",
    "SK_ID_CURR": "o_custkey",
    "AMT_CREDIT_SUM": "o_totalprice",
    "AMT_ANNUITY": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END",
}

BUREAU_BALANCE = {
    "SK_ID_BUREAU": "l_orderkey",
    "STATUS": "CASE WHEN l_partkey % 9 = 8 THEN NULL WHEN l_partkey % 9 = 7 THEN 'X' "
              "WHEN l_partkey % 9 = 6 THEN 'C' ELSE CAST(l_partkey % 9 AS VARCHAR(2)) END",
}

PREVIOUS = {
    "SK_ID_PREV": "event_id",
    "SK_ID_CURR": "user_id",
    "AMT_APPLICATION": "value",
    "DAYS_DECISION": "-(event_id % 2900)",
}

ROLES = {
    "application": ("customer", APPLICATION),
    "bureau": ("orders", BUREAU),
    "bureau_balance": ("lineitem", BUREAU_BALANCE),
    "previous_application": ("events", PREVIOUS),
}


def select_sql(role: str) -> str:
    """The role as a SELECT over its test table."""
    table, columns = ROLES[role]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table}"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def as_role(df: DataFrame, role: str) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in ROLES[role][1].items()])


def role_table(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    return as_role(read(spark, sf_dir, ROLES[role][0]), role)


def loan_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {role: role_table(spark, sf_dir, role) for role in ROLES}
