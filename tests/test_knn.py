import numpy as np

from huddle.operators import knn


def brute(train, test, k):
    """Nearest by distance, then closeness to the insertion point in the
    (x, key) order, then x, then key."""
    tr = sorted(train, key=lambda r: (r[1], r[0]))
    out = {}
    for key, x in test:
        p = sum(1 for r in tr if r[1] <= x)
        cand = []
        for rank, (tk, tx, ty) in enumerate(tr):
            prox = p - 1 - rank if rank < p else rank - p
            cand.append((abs(tx - x), prox, tx, tk, ty))
        cand.sort()
        out[key] = sum(c[4] for c in cand[:k]) / min(k, len(cand))
    return out


def test_knn_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(7)
    train = [(int(i), float(rng.integers(0, 12)), float(rng.integers(0, 100))) for i in range(300)]
    test = [(int(1000 + i), float(rng.integers(-2, 14))) for i in range(80)]
    tr = spark.createDataFrame(train, "k long, x double, y double")
    te = spark.createDataFrame(test, "k long, x double")
    got = {r.k: r.prediction for r in knn.knn_regress(tr, te, "x", "y", "k", 5).collect()}
    want = brute(train, test, 5)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_knn_fewer_training_rows_than_k(spark):
    tr = spark.createDataFrame([(1, 1.0, 10.0), (2, 5.0, 20.0)], "k long, x double, y double")
    te = spark.createDataFrame([(9, 2.0)], "k long, x double")
    r = knn.knn_regress(tr, te, "x", "y", "k", 5).first()
    assert r.prediction == 15.0 and r.neighbours == 2


def test_global_positions(spark):
    from huddle.operators.ranking import global_positions

    df = spark.createDataFrame([(i, float(i % 7), i % 2) for i in range(500)], "k long, x double, f int")
    out = global_positions(df, ["x", "k"], "f", num_partitions=5).collect()
    order = sorted(out, key=lambda r: (r.x, r.k))
    assert [r.position for r in order] == list(range(500))
    before = 0
    for r in order:
        assert r.flag_before == before
        before += r.f


def test_knn_single_frame_equals_two_frames(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    rows = [(int(i), float(rng.integers(0, 9)), float(rng.integers(0, 50)), bool(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, x double, y double, is_test boolean")
    a = {r.k: r.prediction for r in knn.knn_regress_split(df, "x", "y", "k", "is_test", 5).collect()}
    b = {r.k: r.prediction for r in knn.knn_regress(df.filter(~F.col("is_test")), df.filter("is_test"), "x", "y", "k", 5).collect()}
    assert a == b and len(a) == 50
