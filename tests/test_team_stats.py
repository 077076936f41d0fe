import math

from pyspark.sql import functions as F

from huddle import schemas
from huddle.operators import team_stats
from huddle.sources.files import conform

NAN = float("nan")


def plays(spark):
    cols = ["season", "week", "posteam", "defteam", "passing_yards", "rushing_yards", "interception",
            "fumble_lost", "posteam_score_post", "epa", "rush_attempt", "pass_attempt"]
    rows = [
        (2023, 1, "A", "B", 10.0, None, 0.0, 0.0, 7.0, 0.5, 0.0, 1.0),
        (2023, 1, "A", "B", None, 5.0, 1.0, 0.0, 14.0, -0.25, 1.0, 0.0),
        (2023, 1, "B", "A", 20.0, None, 0.0, 1.0, 3.0, 1.0, 0.0, 1.0),
        (2023, 1, None, "A", 99.0, 99.0, 1.0, 1.0, 100.0, 9.0, 0.0, 0.0),   # no offence side: dropped
        (2023, 1, "C", None, 7.0, 0.0, 0.0, 0.0, 7.0, 0.0, 0.0, 1.0),       # no defence side
        (2023, 1, "D", "A", NAN, NAN, NAN, NAN, NAN, NAN, 0.0, 0.0),         # all measures missing
        (2023, 1, "A", "D", 1.0, None, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0),
    ]
    types = {"season": "int", "week": "int", "posteam": "string", "defteam": "string"}
    schema = ", ".join(f"{c} {types.get(c, 'double')}" for c in cols)
    return conform(spark.createDataFrame(rows, schema), schemas.PLAYS, optional=schemas.PLAYS.names)


def by_team(df):
    return {r["team"]: r.asDict() for r in df.collect()}


def test_nan_becomes_null_at_source(spark):
    p = plays(spark)
    assert p.filter(F.isnan("passing_yards")).count() == 0
    assert p.filter(F.col("posteam") == "D").first()["passing_yards"] is None


def test_team_week_stats_semantics(spark):
    t = by_team(team_stats.team_week_stats(plays(spark)))
    assert set(t) == {"A", "B", "D"}  # C has no defence rows: inner join drops it
    a = t["A"]
    assert (a["passing_yards"], a["rushing_yards"], a["interceptions"], a["fumbles"]) == (11.0, 5.0, 1.0, 0.0)
    assert a["points_scored"] == 14.0 and a["epa_total"] == 0.25
    assert a["rush_epa"] == a["pass_epa"] == a["epa_total"]
    # the play without an offence side does not count for A's defence
    assert (a["interceptions_def"], a["fumbles_forced"], a["points_allowed"], a["epa_allowed"]) == (0.0, 1.0, 3.0, 1.0)
    assert a["turnover_margin"] == 0.0
    d = t["D"]
    # all-missing group: sums are 0, max stays NULL
    assert (d["passing_yards"], d["rushing_yards"], d["interceptions"], d["epa_total"]) == (0.0, 0.0, 0.0, 0.0)
    assert d["points_scored"] is None
    assert d["points_allowed"] == 1.0
    b = t["B"]
    assert b["rushing_yards"] == 0.0 and b["points_allowed"] == 14.0 and b["turnover_margin"] == 0.0


def test_one_pass_equals_two_aggregates_and_join(spark):
    p = plays(spark)
    one = team_stats.team_week_stats(p)
    two = team_stats.team_week_stats_joined(p).select(*one.columns)
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


def test_one_pass_equals_join_on_standin(spark):
    from tests.conftest import SF_SMALL
    from huddle.plans import standins

    p = standins.plays(spark, SF_SMALL)
    one = team_stats.team_week_stats(p)
    two = team_stats.team_week_stats_joined(p).select(*one.columns)
    assert one.count() == two.count()
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_offense_keeps_side_without_defence_and_conditional_epa(spark):
    off = by_team(team_stats.offense_stats(plays(spark), conditional_epa=True))
    assert set(off) == {"A", "B", "C", "D"}
    assert off["A"]["rush_epa_cond"] == -0.25 and off["A"]["pass_epa_cond"] == 0.5


def test_defense_drops_missing_defteam(spark):
    dfn = by_team(team_stats.defense_stats(plays(spark)))
    assert set(dfn) == {"A", "B", "D"}


def test_single_team(spark):
    rows = team_stats.single_team_week_stats(plays(spark), "A").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["point_delta"] == 11.0 and r["turnover_margin"] == 0.0
    assert "team" not in r.asDict()


def test_team_filter_reaches_scan(spark, tmp_path):
    p = plays(spark)
    path = str(tmp_path / "plays")
    p.write.partitionBy("season").parquet(path)
    from huddle.sources.files import read_plays

    df = read_plays(spark, path, seasons=[2023])
    plan = team_stats.single_team_week_stats(df, "A")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "posteam" in plan
    assert "PartitionFilters" in plan
    assert math.isclose(team_stats.single_team_week_stats(df, "A").first()["point_delta"], 11.0)


def test_standin_plays_keep_every_lineitem_and_games_have_two_sides(spark):
    from tests.conftest import SF_SMALL
    from huddle.plans import standins

    p = standins.plays(spark, SF_SMALL)
    assert p.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert p.filter("posteam = defteam").count() > 0
    games = standins.games(p)
    assert games.filter("home_team = away_team").count() == 0
    rolled = standins.games_from_pairs(team_stats.pair_week_stats(p)).select(*games.columns)
    assert games.exceptAll(rolled).count() == 0 and rolled.exceptAll(games).count() == 0
