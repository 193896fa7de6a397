import pytest
from pyspark.sql import functions as F

from clientgrain.operators import splits as SP


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(4000).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") % 9 == 0).cast("int").alias("TARGET"))


@pytest.mark.parametrize("exact", [True, False])
def test_holdout_is_stable_and_proportional(labelled, exact):
    first = SP.stratified_holdout(labelled, exact=exact)
    second = SP.stratified_holdout(labelled.repartition(13), exact=exact)
    assert first.exceptAll(second).isEmpty()
    rates = [r.s for r in first.groupBy("TARGET").agg(F.avg("is_test").alias("s")).collect()]
    assert all(abs(r - 0.25) < 0.05 for r in rates)


@pytest.mark.parametrize("options", [{}, {"group_rows": 50, "single_pass_rows": 20}])
def test_exact_counts(labelled, options):
    out = SP.stratified_holdout(labelled, exact=True, **options)
    sizes = {r.TARGET: (r.n, r.t) for r in out.groupBy("TARGET").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect()}
    assert all(t == int(n * 0.25 + 0.5) for n, t in sizes.values())
    folds = SP.stratified_folds(labelled, exact=True, **options).groupBy("TARGET", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in folds if r.TARGET == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_tiny_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1)], "SK_ID_CURR long, TARGET int")
    out = SP.stratified_holdout(df, exact=True).groupBy("TARGET").agg(F.sum("is_test").alias("t")).collect()
    assert {r.TARGET: r.t for r in out} == {0: 1, 1: 0}
    assert SP.stratified_folds(df, exact=True).where("fold is null").count() == 0


def test_plain_folds_never_exceed_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "SK_ID_CURR long")
    assert {r.fold for r in SP.plain_folds(df, folds=5).collect()} <= {0, 1, 2}


def test_splits_do_not_overlap(labelled):
    train, test = SP.train_and_test(labelled)
    assert train.join(test, "SK_ID_CURR").isEmpty() and train.count() + test.count() == 4000


def test_rows_without_a_label_are_refused(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 1)], "SK_ID_CURR long, TARGET int")
    for split in (SP.stratified_holdout, SP.stratified_folds, SP.train_and_test):
        with pytest.raises(ValueError, match="1 rows have no TARGET"):
            split(df)


def test_encoder_folds_are_no_cv_folds(labelled):
    """About a fifth of the rows fall in folds of the same number, as with unrelated folds."""
    from clientgrain.operators.routing import ENCODER_SEED
    folds = SP.stratified_folds(labelled)
    for seed in range(ENCODER_SEED, ENCODER_SEED + 6):
        same = folds.agg(F.avg((F.col("fold") == SP.plain_fold("SK_ID_CURR", 5, seed)).cast("int"))).first()[0]
        assert 0.15 < same < 0.25
