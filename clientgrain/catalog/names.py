"""Names, coverage and kinds."""

from __future__ import annotations

from .. import contract
from ..operators import coverage as CV
from ..operators.row_features import add_row_features
from ..sources import roles
from . import query
from .common import app, with_roles

APPLICATION = with_roles("application")


LARGE_RETURNS = "l_returnflag = 'R' AND l_quantity > 45"


@query(f"SELECT DISTINCT p_name AS name FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE {LARGE_RETURNS}))")
def name_difference(spark, sf_dir):
    """Names of all parts less those of the parts that came back in large numbers."""
    part = roles.read(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_name AS name")
    lines = roles.read(spark, sf_dir, "lineitem").where(LARGE_RETURNS)
    return CV.difference(part, part.join(lines, "l_partkey", "left_semi"))


@query("SELECT p_brand AS name, min(p_partkey) AS position FROM part GROUP BY p_brand")
def name_dedup(spark, sf_dir):
    return CV.ordered_distinct(roles.read(spark, sf_dir, "part").selectExpr("p_brand AS name", "p_partkey AS position"))


def _kinds_sql(columns, text) -> str:
    parts = []
    for c in columns:
        kind = "'categorical'" if c in text else f"CASE WHEN coalesce(bool_and({c} IN (0, 1)), true) THEN 'binary' ELSE 'numeric' END"
        parts.append(f"SELECT '{c}' AS \"column\", {kind} AS kind FROM application")
    return " UNION ALL ".join(parts)


TEXT = ("CODE_GENDER", "FLAG_OWN_CAR", "NAME_EDUCATION_TYPE")
PROFILED = [c for c in roles.APPLICATION if c not in (contract.ID_COLUMN, contract.TARGET_COLUMN)]


@query(f"{APPLICATION} SELECT DISTINCT * FROM ({_kinds_sql(PROFILED, TEXT)})")
def suggest_kinds(spark, sf_dir):
    return CV.suggest_kinds(app(spark, sf_dir))


# Audited: a store against a model that uses amounts only and a contract without the documents.
USED = [c for c in PROFILED if c.startswith("AMT_")]
CONFIGURED = [c for c in PROFILED if not c.startswith("FLAG_DOCUMENT_")] + ["OWN_CAR_AGE", "OCCUPATION_TYPE"]


@query(f"{APPLICATION}, kinds AS (SELECT DISTINCT * FROM ({_kinds_sql(PROFILED, TEXT)})) "
       "SELECT s.section, k.\"column\" AS name, k.kind FROM kinds k JOIN (VALUES ('missing_in_pipeline'), ('missing_in_config')) s(section) ON "
       f"(s.section = 'missing_in_pipeline' AND k.\"column\" NOT IN ({', '.join(repr(c) for c in USED)})) OR "
       f"(s.section = 'missing_in_config' AND k.\"column\" NOT IN ({', '.join(repr(c) for c in CONFIGURED)})) "
       "UNION ALL SELECT 'extra_in_config', x.name, NULL FROM (VALUES ('OWN_CAR_AGE'), ('OCCUPATION_TYPE')) x(name)")
def coverage_report(spark, sf_dir):
    df = app(spark, sf_dir)
    kinds = CV.suggest_kinds(df).withColumnRenamed("column", "name")
    return CV.coverage(df, USED, CONFIGURED).join(kinds, "name", "left").select("section", "name", "kind")


@query()
def contract_coverage(spark, sf_dir):
    """The row-feature store against the whole published contract, with suggested kinds."""
    df = add_row_features(app(spark, sf_dir))
    kinds = CV.suggest_kinds(df).withColumnRenamed("column", "name")
    return CV.coverage(df, df.columns, contract.contract_names()).join(kinds, "name", "left").select("section", "name", "dtype", "kind")
