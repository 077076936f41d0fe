"""Property tests: random inputs, equalities that must always hold."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from huddle import schemas
from huddle.operators import history, knn, team_stats
from huddle.sources.files import conform

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

teams = st.sampled_from(["A", "B", "C", None])
measure = st.one_of(st.none(), st.floats(min_value=-50, max_value=50, allow_nan=False).map(lambda v: float(round(v))),
                    st.just(float("nan")))
play = st.tuples(st.integers(2021, 2022), st.integers(1, 3), teams, teams, measure, measure, measure)


@SETTINGS
@given(st.lists(play, min_size=1, max_size=40))
def test_one_pass_team_stats_equals_join(spark, rows):
    df = spark.createDataFrame(
        [(s, w, p, d, a, b, c, c, a, b) for s, w, p, d, a, b, c in rows],
        "season int, week int, posteam string, defteam string, passing_yards double, rushing_yards double, "
        "epa double, interception double, fumble_lost double, posteam_score_post double")
    plays = conform(df, schemas.PLAYS, optional=schemas.PLAYS.names)
    one = team_stats.team_week_stats(plays)
    two = team_stats.team_week_stats_joined(plays).select(*one.columns)
    via_pairs = team_stats.team_week_from_pairs(team_stats.pair_week_stats(plays)).select(*one.columns)

    def canon(d):
        return sorted((tuple(None if (isinstance(v, float) and math.isnan(v)) else v for v in r) for r in d.collect()), key=repr)

    assert canon(one) == canon(two) == canon(via_pairs)


event = st.tuples(st.integers(1, 3), st.integers(0, 5 * 3600), st.one_of(st.none(), st.integers(0, 100)))


@SETTINGS
@given(st.lists(event, min_size=1, max_size=60), st.integers(1, 4), st.sampled_from([60, 600, 3600]))
def test_chunked_windows_equal_plain_windows(spark, events, n, chunk):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=sec), u, None if v is None else float(v)) for i, (u, sec, v) in enumerate(events)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double")
    lag_a = {r.event_id: r.value_prev for r in history.lag_by_time_chunks(df, ["value"], "user_id", "ts", "event_id", chunk).collect()}
    lag_b = {r.event_id: r.value_prev for r in history.lag_columns(df, ["value"], ["user_id"], ["ts", "event_id"], suffix="_prev").collect()}
    assert lag_a == lag_b
    col = f"value_last{n}"
    ra = {r.event_id: r[col] for r in history.rolling_mean_by_time_chunks(df, ["value"], "user_id", "ts", "event_id", n, chunk).collect()}
    rb = {r.event_id: r[col] for r in history.rolling_mean_before(df, ["value"], ["user_id"], ["ts", "event_id"], n).collect()}
    assert ra.keys() == rb.keys()
    assert all((ra[k] is None and rb[k] is None) or abs(ra[k] - rb[k]) < 1e-9 for k in ra)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 20)), min_size=1, max_size=30),
       st.lists(st.integers(-2, 8), min_size=1, max_size=10), st.integers(1, 4))
def test_knn_equals_brute_force(spark, train, test, k):
    tr_rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(train)]
    te_rows = [(1000 + i, float(x)) for i, x in enumerate(test)]
    tr = spark.createDataFrame(tr_rows, "k long, x double, y double")
    te = spark.createDataFrame(te_rows, "k long, x double")
    got = {r.k: r.prediction for r in knn.knn_regress(tr, te, "x", "y", "k", k).collect()}
    ordered = sorted(tr_rows, key=lambda r: (r[1], r[0]))
    for key, x in te_rows:
        p = sum(1 for r in ordered if r[1] <= x)
        cand = sorted((abs(r[1] - x), p - 1 - i if i < p else i - p, r[1], r[0], r[2]) for i, r in enumerate(ordered))
        best = cand[:k]
        assert abs(got[key] - sum(c[4] for c in best) / len(best)) < 1e-9
