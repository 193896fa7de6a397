"""Missing-value rules and edge rows; expected values were observed in pandas."""

import pytest
from pyspark.sql import functions as F

from clientgrain import contract
from clientgrain.functions import scalars as S
from clientgrain.functions import stats as ST
from clientgrain.operators import history as H
from clientgrain.operators.coercion import TypeCoercer
from clientgrain.operators.row_features import (AGE_EDGES, AGE_LABELS, BURDEN_EDGES, BURDEN_LABELS, RowFeatures,
                                                add_row_features, created_features)


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_bins_are_right_closed(spark):
    ages = spark.createDataFrame([(20.0,), (25.0,), (25.1,), (101.0,), (0.0,), (None,)], "v double").coalesce(1)
    assert column(ages, S.fixed_bins(F.col("v"), AGE_EDGES, AGE_LABELS)) == [1, 1, 2, None, None, None]
    burden = spark.createDataFrame([(5.0,), (5.1,), (50.0,), (51.0,), (0.0,), (None,)], "v double").coalesce(1)
    assert column(burden, S.fixed_bins(F.col("v"), BURDEN_EDGES, BURDEN_LABELS)) == ["low", "medium", "high", None, None, None]
    with pytest.raises(ValueError):
        S.fixed_bins(F.col("v"), (0, 1), ("a", "b"))


def test_row_statistics_skip_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0), (2, None, 4.0), (3, None, None)], "id int, a double, b double").coalesce(1)
    cols = ["a", "b"]
    assert column(df, S.row_mean(cols)) == [2.0, 4.0, None]
    assert column(df, S.row_min(cols)) == [1.0, 4.0, None]
    assert column(df, S.row_max(cols)) == [3.0, 4.0, None]
    assert column(df, S.row_sum(cols)) == [4.0, 4.0, 0.0]
    assert column(df, S.row_range(cols)) == [2.0, 0.0, None]


def test_sentinel_and_clip(spark):
    df = spark.createDataFrame([(365243,), (None,), (-5,)], "d int").coalesce(1)
    assert column(df, S.sentinel_flag("d", 365243)) == [1, 0, 0]
    assert column(df, S.sentinel_to_null("d", 365243)) == [None, None, -5]
    clip = spark.createDataFrame([(-5.0,), (None,), (2.0,)], "v double").coalesce(1)
    assert column(clip, S.floor_at(F.col("v"), 0.0)) == [0.0, None, 2.0]


def test_zero_denominator_gives_null(spark):
    df = spark.createDataFrame([(1.0, -0.5), (1.0, 1.0)], "n double, d double").coalesce(1)
    assert column(df, S.epsilon_ratio("n", "d", 0.5)) == [None, 1.0 / 1.5]


def test_numeric_coercion(spark):
    texts = ["1", " 2 ", "x", "1e3", "inf", "", "1d", "5.", ".5", "-3", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    assert column(df, S.to_number("t")) == [1.0, 2.0, None, 1000.0, float("inf"), None, None, 5.0, 0.5, -3.0, None]


def test_coercer_keeps_text_and_reads_flags(spark):
    df = spark.createDataFrame([("Y", "a", 1.0), ("n", "Y", 2.0), (None, "N", None)], "flag string, mixed string, v double")
    model = TypeCoercer().fit(df)
    out = model.transform(df)
    assert dict(out.dtypes) == {"flag": "string", "mixed": "string", "v": "double"}
    assert {tuple(r) for r in out.collect()} == {("1", "a", 1.0), ("0", "1", 2.0), (None, "0", None)}
    # A column that was a number at fit is parsed when it comes as text.
    late = spark.createDataFrame([("Y", "a", "7"), ("XNA", "b", "oops")], "flag string, mixed string, v string")
    assert {tuple(r) for r in model.transform(late).collect()} == {("1", "a", 7.0), ("XNA", "b", None)}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "v double, i int")
    assert [r.v for r in S.nan_to_null(df).orderBy("i").collect()] == [None, 2.0]


def test_shares(spark):
    rows = [(1, "0"), (1, "C"), (1, None), (2, None), (2, None), (3, "X"), (None, "X")]
    df = spark.createDataFrame(rows, "SK_ID_BUREAU long, STATUS string")
    out = {r["SK_ID_BUREAU"]: r for r in H.status_shares(df).collect()}
    assert set(out) == {1, 3}
    assert (out[1]["BB_STATUS_PCT_0"], out[1]["BB_STATUS_PCT_C"], out[1]["BB_STATUS_PCT_X"], out[1]["BB_HISTORY_LENGTH"]) == (.5, .5, 0, 3)
    assert (out[3]["BB_STATUS_PCT_0"], out[3]["BB_STATUS_PCT_X"], out[3]["BB_HISTORY_LENGTH"]) == (0, 1, 1)
    given = H.status_shares(df, values=["0", "C", "X"])
    assert given.columns == ["SK_ID_BUREAU", "BB_STATUS_PCT_0", "BB_STATUS_PCT_C", "BB_STATUS_PCT_X", "BB_HISTORY_LENGTH"]


def test_group_statistics(spark):
    rows = [(1, 10, None), (2, 20, 5.0), (3, 30, 1.0), (3, None, 2.0), (None, 40, 9.0)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, SK_ID_BUREAU long, v double")
    out = {r["SK_ID_CURR"]: r.asDict() for r in H.bureau_aggregate(df).collect()}
    assert set(out) == {1, 2, 3}
    one = out[1]
    assert one["BUREAU_v_SUM"] == 0 and one["BUREAU_v_MEAN"] is None and one["BUREAU_v_STD"] is None and one["BUREAU_v__Q25"] is None
    assert out[2]["BUREAU_v_STD"] is None and out[2]["BUREAU_v__Q25"] == 5.0
    assert out[3]["BUREAU_v__Q25"] == 1.25 and out[3]["BUREAU_v__Q75"] == 1.75 and out[3]["BUREAU_CREDIT_COUNT"] == 1


def test_adjusted_skew(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert df.agg(ST.adjusted_skew(F.col("v"))).first()[0] == pytest.approx(1.763632614803888, rel=1e-14)
    assert df.limit(2).agg(ST.adjusted_skew(F.col("v"))).first()[0] is None
    same = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert same.agg(ST.adjusted_skew(F.col("v"))).first()[0] == 0.0


def test_feature_names_follow_the_contract(spark):
    from clientgrain.sources import schemas
    app = spark.createDataFrame([], schemas.application_schema())
    assert sorted(created_features(app.columns)) == sorted([*contract.DERIVED_NUMERIC, "CREDIT_BURDEN_GROUP"])
    assert len(created_features(app.columns)) == 23
    shares = H.status_shares(spark.createDataFrame([], schemas.bureau_balance_schema()))
    bureau = H.bureau_aggregate(spark.createDataFrame([], schemas.bureau_schema()), shares)
    assert sorted(bureau.columns) == sorted(["SK_ID_CURR", *contract.bureau_features()])
    previous = H.previous_aggregate(spark.createDataFrame([], schemas.previous_schema()))
    assert sorted(previous.columns) == sorted(["SK_ID_CURR", *contract.previous_features()])
    assert (len(contract.numerical_features()), len(contract.categorical_features()), len(contract.binary_features())) == (315, 17, 36)
    assert len(set(contract.contract_names())) == 368


def test_features_only_for_present_inputs(spark):
    df = spark.createDataFrame([(1, -7300)], "SK_ID_CURR int, DAYS_BIRTH int")
    assert add_row_features(df).columns == ["SK_ID_CURR", "DAYS_BIRTH", "AGE_YEARS", "AGE_GROUP", "AGE_YEARS_SQ"]
    one_score = spark.createDataFrame([(0.5,)], "EXT_SOURCE_1 double")
    assert add_row_features(one_score).columns == ["EXT_SOURCE_1"]


def test_row_features_stage_survives_saving(spark, tmp_path):
    stage = RowFeatures(epsilon=0.25)
    stage.write().overwrite().save(str(tmp_path / "stage"))
    loaded = RowFeatures.load(str(tmp_path / "stage"))
    df = spark.createDataFrame([(10.0, 3.75)], "AMT_CREDIT double, AMT_INCOME_TOTAL double")
    assert loaded.transform(df).first()["CREDIT_INCOME_RATIO"] == 2.5


def test_joins_keep_the_clients(spark, tiny):
    from clientgrain.plans.feature_store import build_feature_store
    from clientgrain.sources import roles
    store = build_feature_store(roles.loan_tables(spark, tiny))
    assert store.count() == 150 and store.select("SK_ID_CURR").distinct().count() == 150
    alone = build_feature_store({"application": roles.role_table(spark, tiny, "application")})
    assert not [c for c in alone.columns if c.startswith(("BUREAU_", "PREV_"))]
    total = sum(F.col(f"BB_STATUS_PCT_{s}") for s in contract.STATUSES)
    shares = H.status_shares(roles.role_table(spark, tiny, "bureau_balance"))
    assert shares.where(F.abs(total - 1) > 1e-9).count() == 0


def test_aggregator_model_reads_back(spark, tiny, tmp_path):
    from clientgrain.sources import roles
    tables = roles.loan_tables(spark, tiny)
    model = H.HistoryAggregator(tables, str(tmp_path / "written")).fit(tables["application"])
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = H.HistoryAggregatorModel.load(str(tmp_path / "model"))
    first, second = (m.transform(tables["application"]) for m in (model, loaded))
    assert first.columns == second.columns
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def test_statuses_beyond_the_list(spark):
    rows = [(1, "6"), (1, "6"), (1, "0"), (2, "C"), (3, None)]
    df = spark.createDataFrame(rows, "SK_ID_BUREAU long, STATUS string")
    out = {r.SK_ID_BUREAU: r for r in H.status_shares(df).collect()}
    assert out[1]["BB_STATUS_PCT_6"] == pytest.approx(2 / 3) and out[1]["BB_STATUS_PCT_0"] == pytest.approx(1 / 3)
    assert out[2]["BB_STATUS_PCT_6"] == 0 and set(out) == {1, 2}
    with pytest.raises(Exception, match="STATUS has a value without a column: 6"):
        H.status_shares(df, values=contract.STATUSES).collect()


def test_every_column_gets_a_kind(spark):
    import datetime
    from clientgrain.operators.coverage import suggest_kinds
    rows = [(True, datetime.date(2020, 1, 1), datetime.datetime(2020, 1, 1), 1, 2.5, "x", [1], b"y", None)]
    df = spark.createDataFrame(rows, "b boolean, d date, t timestamp, i int, v double, s string, a array<int>, y binary, e string")
    for flags, want in ((True, "binary"), (False, "numeric")):
        got = {r["column"]: r.kind for r in suggest_kinds(df, numeric_flags=flags).collect()}
        assert got == {"b": "binary", "i": want, "v": "numeric", **dict.fromkeys("dtsay", "categorical"), "e": "categorical" if flags else "binary"}


def test_published_order():
    names = contract.numerical_features()
    assert names[:3] == ["AMT_ANNUITY", "AMT_CREDIT", "AMT_GOODS_PRICE"] and names[229:231] == ["YEARS_BUILD_MODE", "AGE_GROUP"]
    assert names[4:6] == ["AMT_REQ_CREDIT_BUREAU_DAY", "AMT_REQ_CREDIT_BUREAU_HOUR"] and names[-1] == "REGISTRATION_YEARS"
