from pyspark.sql import functions as F

from huddle import schemas
from huddle.operators import evaluate, matchup, player
from huddle.sources import html
from huddle.sources.files import conform

PAGE = """<table><thead><tr><th></th><th>Fantasy per Game</th></tr>
<tr><th>Tm</th><th>FantPt</th><th>FantPt</th></tr></thead>
<tbody>{rows}</tbody></table>"""


def page(rows):
    return PAGE.format(rows="".join(f"<tr><td>{t}</td><td>99</td><td>{v}</td></tr>" for t, v in rows))


def test_defense_points_table(spark):
    pages = spark.createDataFrame([
        (1, "u", page([("Detroit Lions", 23.3), ("New York Jets", 26.3)]), 2021, "RB"),
        (2, "u", page([("Detroit Lions", 8.6)]), 2021, "TE"),
        (3, "u", page([("Detroit Lions", 20.0)]), 2022, "RB"),
        (4, "u", "<table><thead><tr><th>Tm</th><th>FantPt</th></tr></thead><tbody><tr><td>X</td><td>1</td></tr></tbody></table>", 2022, "QB"),
    ], "page_id long, url string, html string, season int, position string")
    out = {(r.Tm, r.Season): r for r in html.defense_points_table(pages).collect()}
    assert out[("Detroit Lions", 2021)]["RB FantPt"] == 23.3 and out[("Detroit Lions", 2021)]["TE FantPt"] == 8.6
    assert out[("New York Jets", 2021)]["TE FantPt"] is None  # missing from the TE page
    assert out[("Detroit Lions", 2022)]["RB FantPt"] == 20.0
    assert ("X", 2022) not in out  # page without a second FantPt column contributes nothing


def test_player_opponent_dataset(spark):
    offense = spark.createDataFrame([
        ("p1", "A Passer", "QB", 2022, "KC", 1, "WAS", 20.0),
        ("p1", "A Passer", "QB", 2022, "KC", 2, "LV", 10.0),
        ("p2", "B Runner", "RB", 2022, "LV", 1, "KC", 5.0),
    ], "player_id string, player_display_name string, position string, season int, recent_team string, "
       "week int, opponent_team string, fantasy_points_ppr double")
    defense = spark.createDataFrame([("Washington Commanders", 2022, 17.1), ("Kansas City Chiefs", 2022, 15.0)],
                                    "Tm string, Season int, `QB FantPt` double")
    names = {"Washington Commanders": "WAS", "Kansas City Chiefs": "KC"}
    out = {(r.player_id, r.week): r.QB_FantPt_Allowed for r in
           player.player_opponent_dataset(offense, defense, names, "QB", players=["A Passer"]).collect()}
    assert out == {("p1", 1): 17.1, ("p1", 2): None}


def test_matchups_from_plays(spark):
    rows = []
    for season in (2021, 2022, 2023):
        for week in (1, 2):
            rows.append((season, week, f"{season}_{week}", "AAA", "BBB", "AAA", "BBB", 10.0, 1.0, 21, 14))
            rows.append((season, week, f"{season}_{week}", "AAA", "BBB", "BBB", "AAA", 5.0, -1.0, 21, 14))
    df = spark.createDataFrame(rows, "season int, week int, game_id string, home_team string, away_team string, "
                                     "posteam string, defteam string, passing_yards double, epa double, "
                                     "home_score int, away_score int")
    plays = conform(df, schemas.PLAYS, optional=schemas.PLAYS.names)
    m = {(r.season, r.week): r for r in matchup.matchups_from_plays(plays).collect()}
    assert len(m) == 6 and m[(2023, 2)].actual_spread == 7
    assert m[(2023, 2)].passing_yards_delta == 5.0  # week-1 means: 10 - 5, blended 1/3 prior + 2/3 rolling
    assert m[(2021, 1)].passing_yards_delta is None


def test_evaluate_files(spark, tmp_path):
    preds = spark.createDataFrame([(1, "WAS", "ARI", 4, 1.2, -2.8), (1, "NYJ", "BUF", 6, -1.0, -7.0)], schemas.PREDICTIONS)
    games = spark.createDataFrame([(2023, 1, "WAS", "ARI", 7.0), (2023, 1, "NYJ", "BUF", -2.5), (2022, 1, "WAS", "ARI", 1.0)],
                                  schemas.GAMES)
    pp, gp, out = (str(tmp_path / n) for n in ("p", "g", "out"))
    preds.write.option("header", True).csv(pp)
    games.write.option("header", True).csv(gp)
    s = evaluate.evaluate_files(spark, pp, gp, out, 2023).first()
    assert s.model_win_accuracy == 0.5 and s.vegas_win_accuracy == 0.5
    written = spark.read.option("header", True).csv(out)
    assert written.count() == 2 and "model_beats_vegas" in written.columns
    assert written.filter(F.col("home_team") == "WAS").first().model_beats_spread == "Beats Vegas"


def test_readme_usage_chain(spark, tmp_path):
    """The usage example in the README, end to end on a small fixture."""
    from huddle.operators import models, team_stats
    from huddle.sources.files import read_plays

    rows = []
    teams = ["AAA", "BBB", "CCC", "DDD"]
    for season in (2021, 2022, 2023):
        for week in range(1, 7):
            for i in range(0, 4, 2):
                home, away = teams[(i + week) % 4], teams[(i + week + 1) % 4]
                gid = f"{season}_{week}_{home}_{away}"
                hs, as_ = 10 + week + i, 7 + (season % 3) * i
                for off, dfn, yards in ((home, away, 10.0 + week), (away, home, 6.0 + i)):
                    rows.append((season, week, gid, home, away, off, dfn, yards, 0.5, hs, as_))
    df = spark.createDataFrame(rows, "season int, week int, game_id string, home_team string, away_team string, "
                                     "posteam string, defteam string, passing_yards double, epa double, "
                                     "home_score int, away_score int")
    path = str(tmp_path / "pbp")
    conform(df, schemas.PLAYS, optional=schemas.PLAYS.names).write.partitionBy("season").parquet(path)
    plays = read_plays(spark, path, seasons=range(2021, 2024))
    assert team_stats.team_week_stats(plays).count() == 3 * 6 * 4
    games = matchup.matchups_from_plays(plays)
    prep = models.prepare_features(games)
    model, scored = models.train_and_score(prep, test_season=2023)
    preds = evaluate.predictions_with_keys(scored, label="label")
    lines = spark.createDataFrame([(2023, r.week, r.home_team, r.away_team, 3.0) for r in preds.collect()], schemas.GAMES)
    summary = evaluate.accuracy_summary(evaluate.evaluate_against_line(preds, lines, season=2023)).first()
    assert preds.count() == 12 and summary.vegas_win_accuracy is not None
