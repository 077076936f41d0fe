"""One row per scheduled game with home-minus-away feature deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddle.functions.columns import prefix_equal
from huddle.schemas import FEATURE_COLS


def side_features(blended: DataFrame, side: str, features: Sequence[str], entity: str = "team") -> DataFrame:
    """Prefix every feature with ``<side>_`` and name the key ``<side>_team``."""
    return blended.select(
        "season", "week", F.col(entity).alias(f"{side}_team"),
        *[F.col(f).alias(f"{side}_{f}") for f in features],
    )


def matchup_dataset(
    schedule: DataFrame,
    blended: DataFrame,
    features: Sequence[str] = FEATURE_COLS,
    entity: str = "team",
    early_weeks: int = 3,
    division_of: DataFrame | None = None,
    keep_side_features: bool = False,
) -> DataFrame:
    """Left-join each game's home and away history features and difference
    them.  Every schedule row survives exactly once (features are unique
    per (season, week, team)).

    ``is_division_game`` compares the first three characters of the two
    team names unless ``division_of`` (team, division) is given, in which
    case it compares divisions.
    """
    home = side_features(blended, "home", features, entity)
    away = side_features(blended, "away", features, entity)
    m = schedule.join(home, ["season", "week", "home_team"], "left").join(
        away, ["season", "week", "away_team"], "left"
    )
    if division_of is None:
        division = prefix_equal("home_team", "away_team", 3)
    else:
        hd = division_of.select(F.col(entity).alias("home_team"), F.col("division").alias("_hd"))
        ad = division_of.select(F.col(entity).alias("away_team"), F.col("division").alias("_ad"))
        m = m.join(hd, "home_team", "left").join(ad, "away_team", "left")
        division = F.coalesce(F.col("_hd") == F.col("_ad"), F.lit(False))
    out = [
        "season", "week", "game_id", "home_team", "away_team",
        F.col("week").alias("week_number"),
        (F.col("week") <= early_weeks).cast("int").alias("is_early_season"),
        *[(F.col(f"home_{f}") - F.col(f"away_{f}")).alias(f"{f}_delta") for f in features],
        division.alias("is_division_game"),
        (F.col("home_score") - F.col("away_score")).cast("int").alias("actual_spread"),
    ]
    if keep_side_features:
        out += [f"{s}_{f}" for s in ("home", "away") for f in features]
    return m.select(*out)


def matchups_from_plays(
    plays: DataFrame,
    schedule: DataFrame | None = None,
    features: Sequence[str] = FEATURE_COLS,
    prior_lag: int = 2,
    early_weeks: int = 3,
    prior_only_when_no_history: bool = False,
    division_of: DataFrame | None = None,
) -> DataFrame:
    """The whole play-by-play -> matchup pipeline over every season at once.

    The plays are scanned once: rolled up to (game, offence, defence), or to
    (season, week, offence, defence) where a ``schedule`` is given, and written
    to the shared checkpoint folder.  Team-week stats, prior-season means, the
    blend and the distinct schedule rows all read that small table.
    """
    from huddle.operators import history, team_stats
    from huddle.session import materialize

    carry = team_stats.SCHEDULE if schedule is None else ()
    pairs = materialize(team_stats.pair_week_stats(plays, carry=carry), "pairs")
    tws = team_stats.team_week_from_pairs(pairs)
    prior = history.prior_season_means(tws, features, lag=prior_lag)
    blended = history.blend_with_prior(
        tws, prior, features, early_weeks=early_weeks, prior_only_when_no_history=prior_only_when_no_history
    )
    if schedule is None:
        schedule = team_stats.schedule_rows(pairs)
    return matchup_dataset(schedule, blended, features, early_weeks=early_weeks, division_of=division_of)
