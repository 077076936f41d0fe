import numpy as np

from huddle.operators import scaling, split


def test_population_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (4.0, 5.0, 3.0)], "a double, c double, n double")
    model = scaling.fit_scaler(df, ["a", "c", "n"])
    assert abs(model.stds[0] - np.std([1.0, 2.0, 4.0])) < 1e-12  # population, not sample
    assert model.scale_of(1) == 1.0  # constant column divides by 1
    assert model.means[2] == 2.0  # missing values ignored
    out = model.transform(df).collect()
    assert [r.c for r in out] == [0.0, 0.0, 0.0]
    assert [r.n for r in out][1] is None
    assert abs(out[0].a - (1.0 - 7 / 3) / np.std([1.0, 2.0, 4.0])) < 1e-12


def test_hash_split_is_repeatable_and_disjoint(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = split.random_split(df, "k", 20)
    a = {r.k for r in test.collect()}
    b = {r.k for r in split.random_split(df, "k", 20)[1].collect()}
    assert a == b and train.join(test, "k").count() == 0 and train.count() + test.count() == 2000
    assert 300 < len(a) < 500
    folds = split.with_folds(df, "k", 5).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2, 3, 4]


def test_md5_bucket_value(spark):
    from pyspark.sql import functions as F

    from huddle.functions.columns import hash_bucket

    # first 32 bits of md5('7') = 0x8f14e45f = 2400511071
    df = spark.createDataFrame([(7,)], "k long")
    raw = F.conv(F.substring(F.md5(F.col("k").cast("string")), 1, 8), 16, 10).cast("bigint")
    r = df.select(raw.alias("raw"), hash_bucket(F.col("k"), 100).alias("b")).first()
    assert r.raw == 2400511071 and r.b == 71


def test_season_split(spark):
    df = spark.createDataFrame([(2021,), (2022,), (2023,), (2024,)], "season int")
    tr, te = split.season_split(df, 2023)
    assert sorted(r.season for r in tr.collect()) == [2021, 2022] and [r.season for r in te.collect()] == [2023]
