"""Sources, names and plans."""

import pytest
from pyspark.sql import functions as F

from clientgrain import contract
from clientgrain.operators import coverage as CV
from clientgrain.operators import history as H
from clientgrain.operators import profile as PR
from clientgrain.sources import roles, tables


def test_loan_files_are_read_by_name(spark, tmp_path):
    (tmp_path / "application_train.csv").write_text("TARGET,SK_ID_CURR,AMT_CREDIT,CODE_GENDER,EXTRA\n1,100,5.5,M,x\n0,101,,F,y\n")
    (tmp_path / "bureau.csv").write_text("SK_ID_CURR,SK_ID_BUREAU,AMT_ANNUITY,CREDIT_ACTIVE\n100,7,1.5,Active\n")
    (tmp_path / "bureau_balance.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n7,-1,C\n7,-2,0\n")
    (tmp_path / "previous_application.csv").write_text("SK_ID_PREV,SK_ID_CURR,AMT_CREDIT\n9,101,3\n")
    loaded = tables.load_tables(spark, str(tmp_path))
    assert set(loaded) == {"main", "bureau", "bureau_balance", "previous_application"}
    assert dict(loaded["main"].dtypes)["SK_ID_CURR"] == "bigint" and "EXTRA" not in loaded["main"].columns
    from clientgrain.plans.feature_store import build_feature_store
    store = build_feature_store(loaded, str(tmp_path / "store"))
    rows = {r.SK_ID_CURR: r for r in store.collect()}
    assert rows[100]["BUREAU_BB_STATUS_PCT_C_MEAN"] == 0.5 and rows[100]["BUREAU_CREDIT_COUNT"] == 1
    assert rows[101]["PREV_AMT_CREDIT_SUM"] == 3.0 and rows[101]["BUREAU_CREDIT_COUNT"] is None
    assert tables.read_store(spark, str(tmp_path / "store"), ["TARGET"]).columns == ["TARGET"]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,\n")
    assert dict(tables.read_table(spark, str(tmp_path / "t.csv")).dtypes) == {"a": "int", "b": "string"}


def test_selected_features_keep_their_order(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (3, "a")], "rank int, feature string")
    tables.write_selected(df, str(tmp_path / "s"))
    assert tables.read_selected(spark, str(tmp_path / "s")) == ["z", "b", "a"]


def test_partitioned_store(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (2, 1)], "SK_ID_CURR long, TARGET int")
    tables.write_store(df, str(tmp_path / "p"), ["TARGET"])
    assert spark.read.parquet(str(tmp_path / "p")).where("TARGET = 1").count() == 1


def test_bucketed_stores_join_without_exchange(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS buckets LOCATION '{tmp_path}/buckets'")
    df = spark.range(100).select(F.col("id").alias("SK_ID_CURR"), F.col("id").alias("v"))
    for name in ("buckets.left_store", "buckets.right_store"):
        tables.write_store_bucketed(df, name, "SK_ID_CURR", 4)
    joined = spark.table("buckets.left_store").hint("merge").join(spark.table("buckets.right_store"), "SK_ID_CURR")
    assert "Exchange" not in plan_of(joined) and joined.count() == 100


def test_checkpoints_go_to_the_named_folder(spark):
    from clientgrain.session import scratch_path, shared_folder
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in shared_folder(spark) and named in scratch_path(spark, "x")


def test_broadcast_depends_on_measured_size(spark):
    from clientgrain.session import broadcast_if_small
    df = spark.createDataFrame([("x" * 1000, 1), ("y", 2)], "k string, v int")
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(df, 2)) and not hinted(broadcast_if_small(df, 2, limit=1))
    assert not hinted(broadcast_if_small(df.withColumn("k", F.repeat("k", 100_000)), 2))


def test_coverage_sections(spark):
    store = spark.createDataFrame([(1, 0, 1.0, "x")], "SK_ID_CURR long, TARGET int, a double, b string")
    report = CV.coverage(store, used=["a"], configured=["a", "zz"])
    assert {tuple(r) for r in report.collect()} == {
        ("missing_in_pipeline", "b", "string"), ("missing_in_config", "b", "string"), ("extra_in_config", "zz", None)}
    assert tuple(CV.coverage_counts(store, report).first()) == (2, 1, 1, 1)


def test_kinds(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 5, "t", None, None), (2, 0, 1.0, 6, "u", None, None)],
                               "SK_ID_CURR long, TARGET int, flag double, n int, s string, empty double, gone string")
    kinds = {r["column"]: r["kind"] for r in CV.suggest_kinds(df).collect()}
    assert kinds == {"flag": "binary", "n": "numeric", "s": "categorical", "empty": "binary", "gone": "categorical"}
    strict = {r["column"]: r["kind"] for r in CV.suggest_kinds(df, numeric_flags=False).collect()}
    assert strict == {"flag": "numeric", "n": "numeric", "s": "categorical", "empty": "numeric", "gone": "binary"}


def test_profile_edges(spark):
    df = spark.createDataFrame([(0.0, None), (-0.0, None), (float("nan"), None), (2.0, None)], "v double, e string")
    counts = {r["column"]: r["n_distinct"] for r in PR.distinct_counts(df).collect()}
    assert counts == {"v": 2, "e": 0}
    assert {r["column"]: r["missing_share"] for r in PR.missing_share(df).collect()} == {"v": 0.25, "e": 1.0}
    approx = {r["column"]: r["n_distinct"] for r in PR.distinct_counts(df.limit(2), approximate=True).collect()}
    assert approx["e"] == 0


def test_equal_width_bins(spark):
    df = spark.createDataFrame([(20.0, 1), (30.0, 0), (70.0, 1), (None, 1)], "v double, y int")
    rows = PR.binned_rate(df, F.col("v"), "y").collect()
    assert [(r.low, r.high) for r in rows[:2]] == [(pytest.approx(19.95), 25.0), (25.0, 30.0)]
    assert [r.n for r in rows] == [1, 1, 1]
    same = spark.createDataFrame([(3.0, 1), (3.0, 0)], "v double, y int")
    assert [(r.n, r.rate) for r in PR.binned_rate(same, F.col("v"), "y").collect()] == [(2, 0.5)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_plan_reads_and_shuffles_no_more_than_needed(spark, tiny):
    """Only mapped columns are read, filters reach the scan, nothing is a cross join."""
    from clientgrain.plans.feature_store import build_feature_store
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(build_feature_store(roles.loan_tables(spark, tiny)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "IsNotNull(l_orderkey)" in plan
    # credit-months by credit, credits by credit, credits by client, earlier applications by client, applications by client
    assert plan.count("Exchange hashpartitioning") == 5


def test_wide_aggregate_combines_before_the_shuffle(spark, tiny):
    plan = plan_of(H.previous_aggregate(roles.role_table(spark, tiny, "previous_application")))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_sum")


def test_contract_constants():
    assert contract.DEFAULT_THRESHOLD == 0.42 and contract.SEED == 42 and contract.TEST_SIZE == 0.25
