from pyspark.sql import functions as F

from huddle.operators import history, matchup, team_stats
from huddle.plans import standins
from huddle.schemas import FEATURE_COLS
from tests.conftest import SF_SMALL


def test_division_flag(spark):
    sched = spark.createDataFrame(
        [(2023, 1, "g1", "KCAX", "KCAY", 10, 3), (2023, 1, "g2", "KC", "LV", 3, 10)],
        "season int, week int, game_id string, home_team string, away_team string, home_score int, away_score int")
    blended = spark.createDataFrame([(2023, 1, "KCAX", 1.0)], "season int, week int, team string, v double")
    out = {r.game_id: r for r in matchup.matchup_dataset(sched, blended, ["v"]).collect()}
    assert out["g1"].is_division_game is True and out["g2"].is_division_game is False
    assert out["g1"].actual_spread == 7 and out["g2"].actual_spread == -7
    assert out["g1"].v_delta is None  # away side has no features: left join keeps the game
    assert out["g1"].is_early_season == 1 and out["g1"].week_number == 1
    divisions = spark.createDataFrame([("KC", "W"), ("LV", "W")], "team string, division string")
    out2 = {r.game_id: r for r in matchup.matchup_dataset(sched, blended, ["v"], division_of=divisions).collect()}
    assert out2["g2"].is_division_game is True and out2["g1"].is_division_game is False


def _pipeline(spark, swap=False):
    plays = standins.plays(spark, SF_SMALL)
    tws = team_stats.team_week_stats(plays)
    blended = history.blend_with_prior(tws, history.prior_season_means(tws))
    games = standins.games(plays)
    if swap:
        games = games.select("season", "week", "game_id", F.col("away_team").alias("home_team"),
                             F.col("home_team").alias("away_team"), F.col("away_score").alias("home_score"),
                             F.col("home_score").alias("away_score"))
    return games, matchup.matchup_dataset(games, blended)


def test_every_game_survives_once(spark):
    games, m = _pipeline(spark)
    assert m.count() == games.count() == m.select("game_id").distinct().count()


def test_swapping_sides_negates_deltas(spark):
    _, a = _pipeline(spark)
    _, b = _pipeline(spark, swap=True)
    cols = [f"{f}_delta" for f in FEATURE_COLS]
    j = a.alias("a").join(b.alias("b"), "game_id")
    bad = j.filter(" OR ".join(f"NOT (a.{c} <=> -b.{c})" for c in cols) + " OR a.actual_spread <> -b.actual_spread")
    assert bad.count() == 0


def test_a_repeated_name_in_a_map_multiplies_nothing(spark):
    from huddle.operators.player import map_values

    teams = spark.createDataFrame([("Jets",), ("Bears",)], "team string")
    names = spark.createDataFrame([("Jets", "NYJ"), ("Jets", "XXX")], "name string, abbr string")
    assert sorted(r.team for r in map_values(teams, "team", names).collect()) == ["Bears", "NYJ"]


def test_scaling_on_training_seasons_needs_a_season(spark):
    import pytest

    from huddle.operators.models import prepare_features

    with pytest.raises(ValueError, match="test_season"):
        prepare_features(spark.range(1), fit_on="train")


def test_whole_pipeline_scans_the_plays_once(spark, tmp_path):
    """Games and statistics come from one roll-up; a game whose plays name no offence is listed too."""
    from huddle import schemas
    from huddle.sources.files import conform

    rows = [(s, w, f"{s}{w}", "AAA", "BBB", off, dfn, y, 0.5, 21, 14) for s in (2021, 2022, 2023) for w in (1, 2, 3) for off, dfn, y in (("AAA", "BBB", 9.0 + w), ("BBB", "AAA", 4.0), ("AAA", "BBB", 2.0), (None, None, None))]
    rows.append((2023, 4, "late", "BBB", "AAA", None, None, None, None, 0, 3))
    schema = "season int, week int, game_id string, home_team string, away_team string, posteam string, defteam string, passing_yards double, epa double, home_score int, away_score int"
    conform(spark.createDataFrame(rows, schema), schemas.PLAYS, optional=schemas.PLAYS.names).write.parquet(str(tmp_path / "p"))
    plays = spark.read.parquet(str(tmp_path / "p"))
    one = matchup.matchups_from_plays(plays)
    two = matchup.matchups_from_plays(plays, schedule=team_stats.schedule_rows(plays))
    assert one.count() == 10 and one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    assert not any(str(tmp_path) in f for f in one.inputFiles()) and any(str(tmp_path) in f for f in two.inputFiles())
