import os

import pytest
from pyspark.sql import functions as F

from huddle.operators import evaluate

PRED = "week int, home_team string, away_team string, actual_spread int, predicted_spread double, prediction_error double"
GAMES = "season int, week int, home_team string, away_team string, spread_line double"

CASES = [
    # name, actual, predicted, line, expected verdicts (vp, vc, mc, beats_spread, beats_vegas)
    ("line0", 7, 3.0, 0.0, ("Push", "Push", "Correct", "Beats Vegas", "No Result")),
    ("result0", 0, 2.0, 3.0, ("Home", "Push", "Push", "Beats Vegas", "No Result")),
    ("pred0", -3, 0.0, -3.0, ("Away", "Correct", "Push", "Loses Vegas", "No Result")),
    ("noline", 5, 4.0, None, ("Away", "Incorrect", "Correct", "Loses Vegas", "Beats Vegas")),
    ("nopred", 5, None, 2.0, ("Home", "Correct", "Incorrect", "Loses Vegas", "Loses to Vegas")),
    ("tie", 10, 7.0, 13.0, ("Home", "Correct", "Correct", "Tie", "Tie")),
    ("wrong", -7, 3.0, -2.0, ("Away", "Correct", "Incorrect", "Loses Vegas", "Loses to Vegas")),
    ("bothwrong", -7, 2.0, 1.0, ("Home", "Incorrect", "Incorrect", "Loses Vegas", "Tie")),
]


def frames(spark):
    preds = [(i + 1, c[0], "AWY", c[1], c[2], None if c[2] is None else c[2] - c[1]) for i, c in enumerate(CASES)]
    # "noline" has no game row at all; the others carry their line
    games = [(2023, i + 1, c[0], "AWY", c[3]) for i, c in enumerate(CASES) if c[0] != "noline"]
    games.append((2022, 1, "line0", "AWY", 99.0))  # other season, filtered out
    return spark.createDataFrame(preds, PRED), spark.createDataFrame(games, GAMES)


def test_verdicts(spark):
    preds, games = frames(spark)
    out = {r.home_team: r for r in evaluate.evaluate_against_line(preds, games, season=2023).collect()}
    assert len(out) == len(CASES)
    for name, *_, expected in CASES:
        r = out[name]
        got = (r.vegas_prediction, r.vegas_correct, r.model_correct, r.model_beats_spread, r.model_beats_vegas)
        assert got == expected, name


def test_accuracy_summary(spark):
    preds, games = frames(spark)
    s = evaluate.accuracy_summary(evaluate.evaluate_against_line(preds, games, season=2023)).first()
    assert s.model_win_accuracy == 3 / 8
    assert s.vegas_win_accuracy == 4 / 8
    assert s.model_over_vegas_spread_accuracy == 2 / 8
    assert s.model_over_vegas_win_accuracy == 3 / 8


def test_accuracy_on_empty_input_is_null(spark):
    preds, games = frames(spark)
    s = evaluate.accuracy_summary(evaluate.evaluate_against_line(preds.limit(0), games, season=2023)).first()
    assert s.model_win_accuracy is None


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (3.0, 1.0, 3.0), (5.0, 5.0, None)], "y double, a double, b double")
    m = {r.predictor: r for r in evaluate.regression_metrics(df, "y", ["a", "b"]).collect()}
    assert m["a"].n == 3 and abs(m["a"].mse - 5 / 3) < 1e-12 and abs(m["a"].mae - 1.0) < 1e-12
    assert abs(m["a"].rmse - (5 / 3) ** 0.5) < 1e-12
    assert m["b"].n == 2 and m["b"].mse == 0.0


GOLDEN = os.environ.get("HUDDLE_GOLDEN_PREDICTIONS", "")


@pytest.mark.skipif(not os.path.isfile(GOLDEN), reason="HUDDLE_GOLDEN_PREDICTIONS names no file of evaluated predictions")
def test_stored_predictions_evaluate_as_stored(spark):
    """Every stored verdict, the four ratios and both errors, from the stored predictions and lines."""
    stored = spark.read.option("header", True).csv(GOLDEN)
    verdicts = ["vegas_prediction", "vegas_correct", "model_correct", "model_beats_spread", "model_beats_vegas"]
    keys = ["home_team", "away_team", "week"]
    typed = stored.select(F.col("week").cast("int").alias("week"), "home_team", "away_team",
                          *[F.col(c).cast("double").alias(c) for c in ("actual_spread", "predicted_spread", "spread_line")])
    lines = typed.select(*keys, "spread_line", F.lit(2023).alias("season"))
    got = evaluate.evaluate_against_line(typed.drop("spread_line"), lines, season=2023)
    want = stored.select(F.col("week").cast("int").alias("week"), "home_team", "away_team", *verdicts)
    got_verdicts = got.select(*want.columns)
    assert got_verdicts.count() == 285
    assert got_verdicts.exceptAll(want).count() == 0 and want.exceptAll(got_verdicts).count() == 0
    ratios = evaluate.accuracy_summary(got).first()
    assert [round(x * 285) for x in ratios] == [167, 192, 115, 237]
    error = evaluate.regression_metrics(typed, "actual_spread", ["predicted_spread"]).first()
    assert (round(error["rmse"], 3), round(error["mae"], 3)) == (13.766, 10.710)
