"""Explicit schemas for every source and the main outputs.

CSV columns are parsed to these types; Parquet columns are read as the files
hold them and cast to these types.  Every measure is nullable.
"""

from pyspark.sql import types as T

_S, _I, _D, _L, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# The 17 play-by-play columns the pipelines use (plus two optional ones).
PLAYS = _struct(
    ("season", _I),
    ("week", _I),
    ("game_id", _S),
    ("home_team", _S),
    ("away_team", _S),
    ("posteam", _S),
    ("defteam", _S),
    ("posteam_score_post", _D),
    ("epa", _D),
    ("rush_attempt", _D),
    ("pass_attempt", _D),
    ("passing_yards", _D),
    ("rushing_yards", _D),
    ("interception", _D),
    ("fumble_lost", _D),
    ("home_score", _I),
    ("away_score", _I),
    ("spread_line", _D),
    ("div_game", _I),
)

PLAY_MEASURES = [
    "posteam_score_post", "epa", "rush_attempt", "pass_attempt", "passing_yards",
    "rushing_yards", "interception", "fumble_lost", "spread_line",
]

# Columns that a source may lack; they are then NULL.
OPTIONAL = ["spread_line", "div_game"]

WEEKLY_PLAYER_STATS = _struct(
    ("player_id", _S),
    ("player_display_name", _S),
    ("position", _S),
    ("recent_team", _S),
    ("season", _I),
    ("week", _I),
    ("opponent_team", _S),
    ("carries", _I),
    ("rushing_yards", _D),
    ("rushing_tds", _I),
    ("rushing_fumbles", _D),
    ("receptions", _I),
    ("targets", _I),
    ("receiving_yards", _D),
    ("receiving_tds", _I),
    ("receiving_fumbles", _D),
    ("fantasy_points_ppr", _D),
)

# Weekly snap counts per player, as published with the play-by-play files.
SNAP_COUNTS = _struct(
    ("game_id", _S),
    ("season", _I),
    ("week", _I),
    ("player", _S),
    ("position", _S),
    ("team", _S),
    ("opponent", _S),
    ("offense_snaps", _D),
    ("offense_pct", _D),
    ("defense_snaps", _D),
    ("defense_pct", _D),
    ("st_snaps", _D),
    ("st_pct", _D),
)

GAMES = _struct(
    ("season", _I),
    ("week", _I),
    ("home_team", _S),
    ("away_team", _S),
    ("spread_line", _D),
)

PREDICTIONS = _struct(
    ("week", _I),
    ("home_team", _S),
    ("away_team", _S),
    ("actual_spread", _I),
    ("predicted_spread", _D),
    ("prediction_error", _D),
)

DEFENSE_POINTS = _struct(
    ("Tm", _S),
    ("Season", _I),
    ("RB FantPt", _D),
    ("TE FantPt", _D),
    ("WR FantPt", _D),
    ("QB FantPt", _D),
)

HTML_PAGES = _struct(("page_id", _L), ("url", _S), ("html", _S))

# Feature columns averaged into history features and differenced into
# matchup deltas (fixed names, as in the pipeline being rebuilt).
FEATURE_COLS = [
    "passing_yards", "rushing_yards", "turnover_margin", "points_scored",
    "points_allowed", "epa_total", "rush_epa", "pass_epa",
]

# Columns rolled for the per-player history features (fixed names).
RB_ROLL_COLS = [
    "carries", "rushing_yards", "rushing_tds", "rushing_fumbles",
    "receptions", "targets", "receiving_yards", "receiving_tds",
    "receiving_fumbles", "fantasy_points_ppr", "yards_per_carry", "yards_per_reception",
]
