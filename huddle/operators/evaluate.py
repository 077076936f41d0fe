"""Prediction-versus-line evaluation and regression metrics.

Each verdict is a ``when`` ladder (see :mod:`huddle.functions.columns`), so
the whole evaluation is one projection after one left join; the summary is
one aggregate over the verdict frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddle.functions import columns as C


def predictions_with_keys(
    scored: DataFrame,
    keys: Sequence[str] = ("season", "week", "home_team", "away_team"),
    label: str = "actual_spread",
    prediction: str = "prediction",
) -> DataFrame:
    """Predictions export: keys, actual, predicted and the error
    ``predicted - actual``.  Keys travel with every row (no positional zip)."""
    return scored.select(
        *keys,
        F.col(label).alias("actual_spread"),
        F.col(prediction).cast("double").alias("predicted_spread"),
        (F.col(prediction) - F.col(label)).cast("double").alias("prediction_error"),
    )


def evaluate_against_line(
    predictions: DataFrame,
    games: DataFrame,
    keys: Sequence[str] = ("home_team", "away_team", "week"),
    season: int | None = None,
    season_col: str = "season",
) -> DataFrame:
    """Left-join the line onto each prediction and add the five verdicts.

    With ``season`` the games are first limited to that season and joined on
    ``keys``; without it the season column is part of the join key, which
    evaluates every season in one pass.
    """
    lines = games
    join_keys = list(keys)
    if season is not None:
        lines = lines.filter(F.col(season_col) == season).drop(season_col)
    elif season_col in predictions.columns and season_col not in join_keys:
        join_keys = [season_col, *join_keys]
    lines = lines.select(*join_keys, "spread_line")
    merged = predictions.join(lines, join_keys, "left")
    actual, predicted, line = F.col("actual_spread"), F.col("predicted_spread"), F.col("spread_line")
    line_label = C.sign_label(line)
    result_label = C.sign_label(actual)
    line_verdict = C.line_correct(line_label, result_label)
    model_verdict = C.winner_correct(predicted, actual)
    return merged.select(
        *predictions.columns,
        "spread_line",
        line_label.alias("vegas_prediction"),
        line_verdict.alias("vegas_correct"),
        model_verdict.alias("model_correct"),
        C.closer_than_line(predicted, line, actual).alias("model_beats_spread"),
        C.agree_on_winner(model_verdict, line_verdict).alias("model_beats_vegas"),
    )


def accuracy_summary(evaluated: DataFrame) -> DataFrame:
    """Four ratios, matching rows over non-missing rows; pushes stay in the
    denominator.  One row; NULL ratios on empty input."""
    def ratio(col: str, *values: str):
        return F.try_divide(F.count_if(F.col(col).isin(*values)), F.count(col))

    return evaluated.agg(
        ratio("model_correct", C.CORRECT).alias("model_win_accuracy"),
        ratio("vegas_correct", C.CORRECT).alias("vegas_win_accuracy"),
        ratio("model_beats_spread", C.BEATS).alias("model_over_vegas_spread_accuracy"),
        ratio("model_beats_vegas", C.BEATS, C.TIE).alias("model_over_vegas_win_accuracy"),
    )


def regression_metrics(
    df: DataFrame,
    label: str,
    predictions: Sequence[str],
    group_by: Sequence[str] = (),
    name_col: str = "predictor",
) -> DataFrame:
    """MSE, RMSE and MAE of several prediction columns against one label,
    plus the label's range (the limits of a predicted-vs-actual plot), in a
    single pass: predictions are unpivoted to (predictor, value) and
    aggregated per predictor (and optional groups)."""
    long = df.select(
        *group_by,
        F.col(label).cast("double").alias("_y"),
        F.inline(
            F.array(*[F.struct(F.lit(p).alias(name_col), F.col(p).cast("double").alias("_p")) for p in predictions])
        ),
    )
    err = F.col("_p") - F.col("_y")
    sq = F.avg(err * err)
    return long.groupBy(*group_by, name_col).agg(
        F.count(err).alias("n"),
        sq.alias("mse"),
        F.sqrt(sq).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.min("_y").alias("y_min"),
        F.max("_y").alias("y_max"),
    )


def evaluate_files(
    spark,
    predictions_path: str,
    games_path: str,
    output_path: str,
    season: int,
) -> DataFrame:
    """Read predictions and games CSVs (declared schemas), evaluate one
    season's predictions against its lines, write the evaluated rows as CSV
    to ``output_path`` (never over an input) and return the summary row."""
    from huddle import schemas
    from huddle.sinks.files import write_csv
    from huddle.sources.files import read_csv

    if output_path.rstrip("/") in (predictions_path.rstrip("/"), games_path.rstrip("/")):
        raise ValueError("output_path must differ from the inputs")
    preds = read_csv(spark, predictions_path, schemas.PREDICTIONS)
    games = read_csv(spark, games_path, schemas.GAMES)
    evaluated = evaluate_against_line(preds, games, season=season)
    write_csv(evaluated, output_path)
    return accuracy_summary(spark.read.schema(evaluated.schema).option("header", True).csv(output_path))
