from pyspark.sql import functions as F

from huddle.operators import history, player

FEATS = ["v"]


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_rolling_full_window_rule(spark):
    data = (
        [("P3", 2023, w, float(w)) for w in (1, 2, 3)]
        + [("P4", 2023, w, float(w)) for w in (1, 2, 3, 4)]
        + [("P5", 2023, 1, 1.0), ("P5", 2023, 2, None), ("P5", 2023, 3, 3.0), ("P5", 2023, 4, 4.0),
           ("P5", 2023, 5, 5.0), ("P5", 2023, 6, 6.0)]
        + [("P6", 2022, 17, 3.0), ("P6", 2023, 1, 6.0), ("P6", 2023, 2, 9.0), ("P6", 2023, 3, 0.0)]
    )
    df = spark.createDataFrame(data, "player_id string, season int, week int, v double")
    out = history.rolling_mean_before(df, ["v"], ["player_id"], ["season", "week"], 3)
    got = {(r.player_id, r.season, r.week): r.v_last3 for r in out.collect()}
    assert all(got[("P3", 2023, w)] is None for w in (1, 2, 3))
    assert got[("P4", 2023, 4)] == 2.0 and got[("P4", 2023, 3)] is None
    # a missing value inside the window makes the mean missing
    assert got[("P5", 2023, 4)] is None and got[("P5", 2023, 5)] is None
    assert got[("P5", 2023, 6)] == 4.0
    # P5 does not borrow P4's rows even though they are adjacent in sort order
    assert got[("P5", 2023, 1)] is None
    # a window may span two seasons
    assert got[("P6", 2023, 3)] == 6.0


def test_lag(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 5.0)], "k string, t int, v double")
    out = {(r.k, r.t): r.v_lag1 for r in history.lag_columns(df, ["v"], ["k"], ["t"]).collect()}
    assert out == {("a", 1): None, ("a", 2): 1.0, ("b", 1): None}


def test_rolling_player_features_zero_guard_and_drop(spark):
    base = {"rushing_yards": 10.0, "rushing_tds": 0, "rushing_fumbles": 0.0, "receptions": 1, "targets": 1,
            "receiving_yards": 5.0, "receiving_tds": 0, "receiving_fumbles": 0.0, "fantasy_points_ppr": 3.0}
    rows = []
    for w, carries in zip(range(1, 6), [2, 2, 0, 2, 2]):
        rows.append({"player_id": "R1", "position": "RB", "season": 2023, "week": w, "carries": carries, **base})
    for w in range(1, 5):
        rows.append({"player_id": "R2", "position": "RB", "season": 2023, "week": w, "carries": 2, **base})
    rows.append({"player_id": "Q1", "position": "QB", "season": 2023, "week": 1, "carries": 2, **base})
    rows.append({"player_id": "R3", "position": "RB", "season": 2023, "week": 1, "carries": None, **base})
    df = spark.createDataFrame(rows)
    feats = player.rolling_player_features(df, window=3)
    got = rows_of(feats, "player_id", "week")
    # R1: the zero-carry week makes yards_per_carry missing, so weeks 4-5 lack a full window
    assert got == [("R2", 4)]
    r = feats.first()
    assert r["yards_per_carry_last3"] == 5.0 and r["carries_last3"] == 2.0
    ypc = {(x.player_id, x.week): x.yards_per_carry for x in
           df.withColumn("yards_per_carry", F.when(F.col("carries") != 0, F.col("rushing_yards") / F.col("carries"))).collect()}
    assert ypc[("R1", 3)] is None and ypc[("R3", 1)] is None


def weekly(spark):
    data = []
    # X: present 2021, 2022, 2023 -> prior for 2023 is the 2021 mean (lag 2)
    data += [(2021, w, "X", v) for w, v in ((1, 2.0), (2, 4.0))]
    data += [(2022, w, "X", v) for w, v in ((1, 10.0), (2, 20.0))]
    data += [(2023, w, "X", v) for w, v in ((1, 6.0), (2, 9.0), (3, 12.0), (4, 100.0))]
    # Y: present 2021 and 2023, absent 2022 -> no prior for 2023
    data += [(2021, 1, "Y", 50.0), (2023, 1, "Y", 1.0), (2023, 2, "Y", 2.0)]
    # Z: absent 2021 -> no prior for 2023 under lag 2, 2022 mean under lag 1
    data += [(2022, 1, "Z", 7.0), (2023, 1, "Z", 1.0), (2023, 3, "Z", 3.0)]
    return spark.createDataFrame(data, "season int, week int, team string, v double")


def test_prior_season_means(spark):
    w = weekly(spark)
    lag2 = {(r.season, r.team): r.v for r in history.prior_season_means(w, FEATS, lag=2).collect()}
    assert lag2[(2023, "X")] == 3.0
    assert (2023, "Y") not in lag2 and (2023, "Z") not in lag2
    assert lag2[(2024, "X")] == 15.0  # ready for the next season
    lag1 = {(r.season, r.team): r.v for r in history.prior_season_means(w, FEATS, lag=1).collect()}
    assert lag1[(2023, "X")] == 15.0 and lag1[(2023, "Z")] == 7.0 and (2023, "Y") not in lag1


def test_all_missing_season_mean_is_zero(spark):
    w = spark.createDataFrame([(2021, 1, "X", None), (2022, 1, "X", 1.0), (2023, 1, "X", 1.0)],
                              "season int, week int, team string, v double")
    lag2 = {(r.season, r.team): r.v for r in history.prior_season_means(w, FEATS, lag=2).collect()}
    assert lag2[(2023, "X")] == 0.0


def test_expanding_mean_with_bye_week(spark):
    w = spark.createDataFrame([(2023, 1, "T", 2.0), (2023, 2, "T", 4.0), (2023, 4, "T", 9.0)],
                              "season int, week int, team string, v double")
    got = {r.week: r.rolling_v for r in history.expanding_mean_before(w, FEATS).collect()}
    assert got == {1: None, 2: 2.0, 4: 3.0}


def test_blend(spark):
    w = weekly(spark)
    prior = history.prior_season_means(w, FEATS, lag=2)
    got = {(r.team, r.week): r.v for r in history.blend_with_prior(w, prior, FEATS).filter("season = 2023").collect()}
    assert got[("X", 1)] is None  # weight 1 on the prior, times a missing rolling mean
    assert abs(got[("X", 2)] - (2 / 3 * 3.0 + 1 / 3 * 6.0)) < 1e-12
    assert abs(got[("X", 3)] - (1 / 3 * 3.0 + 2 / 3 * 7.5)) < 1e-12
    assert got[("X", 4)] == 9.0  # after week 3 the rolling mean alone
    assert got[("Y", 1)] is None and got[("Y", 2)] == 1.0  # no prior: rolling mean
    assert got[("Z", 3)] == 1.0
    filled = {(r.team, r.week): r.v for r in
              history.blend_with_prior(w, prior, FEATS, prior_only_when_no_history=True).filter("season = 2023").collect()}
    assert filled[("X", 1)] == 3.0 and filled[("X", 2)] == got[("X", 2)]


def test_history_ignores_future_rows(spark):
    w = weekly(spark)
    changed = w.withColumn("v", F.when((F.col("season") == 2023) & (F.col("week") == 4), F.lit(-1e6)).otherwise(F.col("v")))
    prior_a = history.prior_season_means(w, FEATS)
    prior_b = history.prior_season_means(changed, FEATS)
    a = history.blend_with_prior(w, prior_a, FEATS).filter("season = 2023 AND week < 4")
    b = history.blend_with_prior(changed, prior_b, FEATS).filter("season = 2023 AND week < 4")
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_lag_by_time_chunks_equals_plain_lag_on_hot_key(spark):
    import datetime as dt

    import numpy as np

    rng = np.random.default_rng(11)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        hot = i % 3 != 0  # two thirds of the rows on one key
        user = 1 if hot else int(rng.integers(2, 40))
        # seconds spread over ~3 days with gaps and repeated timestamps
        sec = int(rng.integers(0, 3 * 86400)) // 7 * 7
        rows.append((i, start + dt.timedelta(seconds=sec), user, float(i)))
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double")
    chunked = history.lag_by_time_chunks(df, ["value"], "user_id", "ts", "event_id", chunk_seconds=600)
    plain = history.lag_columns(df, ["value"], ["user_id"], ["ts", "event_id"], suffix="_prev")
    a = {r.event_id: r.value_prev for r in chunked.collect()}
    b = {r.event_id: r.value_prev for r in plain.collect()}
    assert a == b and len(a) == 3000


def test_first_per_key_missing_values_last(spark):
    df = spark.createDataFrame([("k", None, "a"), ("k", 2.0, "b"), ("k", 1.0, "c"), ("j", None, "d")],
                               "key string, v double, tag string")
    got = {r.key: r.tag for r in player.first_per_key(df, ["key"], ["v"]).collect()}
    assert got == {"k": "c", "j": "d"}


def test_rolling_by_time_chunks_equals_plain_rolling_on_hot_key(spark):
    import datetime as dt

    import numpy as np

    rng = np.random.default_rng(5)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(2500):
        user = 1 if i % 3 else int(rng.integers(2, 30))
        sec = int(rng.integers(0, 2 * 86400)) // 11 * 11
        value = None if rng.random() < 0.03 else float(rng.integers(0, 1000))
        rows.append((i, start + dt.timedelta(seconds=sec), user, value))
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double")
    for n in (1, 3, 5):
        chunked = history.rolling_mean_by_time_chunks(df, ["value"], "user_id", "ts", "event_id", window=n, chunk_seconds=900)
        plain = history.rolling_mean_before(df, ["value"], ["user_id"], ["ts", "event_id"], n)
        col = f"value_last{n}"
        a = {r.event_id: r[col] for r in chunked.collect()}
        b = {r.event_id: r[col] for r in plain.collect()}
        assert a.keys() == b.keys()
        assert all((a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-9 for k in a), n
        assert sum(v is not None for v in a.values()) > 1000


def test_chunks_follow_wall_clock_across_dst_gap(spark):
    import datetime as dt

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        base = dt.datetime(2024, 3, 10, 1, 0)  # clocks jump from 02:00 to 03:00 that night
        rows = [(i, base + dt.timedelta(minutes=20 * i), 1, float(i)) for i in range(12)]
        df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double")
        got = {r.event_id: r.value_prev for r in
               history.lag_by_time_chunks(df, ["value"], "user_id", "ts", "event_id", chunk_seconds=3600).collect()}
        assert got == {i: (None if i == 0 else float(i - 1)) for i in range(12)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lag_n_by_time_chunks_equals_plain_lag(spark):
    import datetime as dt

    import numpy as np

    rng = np.random.default_rng(9)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=int(rng.integers(0, 86400)) // 13 * 13),
             1 if i % 3 else int(rng.integers(2, 20)), None if i % 29 == 0 else float(i)) for i in range(1500)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double")
    for n in (1, 2, 4):
        a = {r.event_id: r[f"value_lag{n}"] for r in
             history.lag_n_by_time_chunks(df, ["value"], "user_id", "ts", "event_id", n, chunk_seconds=600).collect()}
        b = {r.event_id: r[f"value_lag{n}"] for r in history.lag_columns(df, ["value"], ["user_id"], ["ts", "event_id"], n).collect()}
        assert a == b, n
