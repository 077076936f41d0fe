"""Per-player history features and opponent lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huddle.functions.columns import safe_divide
from huddle.operators.history import rolling_mean_before
from huddle.schemas import RB_ROLL_COLS


def rolling_player_features(
    weekly: DataFrame,
    window: int = 3,
    position: str | None = "RB",
    player: str = "player_id",
    order: Sequence[str] = ("season", "week"),
    roll_cols: Sequence[str] = RB_ROLL_COLS,
) -> DataFrame:
    """Per-player means of the previous ``window`` games for each roll
    column, plus yards per carry / reception (NULL on a zero or missing
    denominator); rows without a full history in every column are dropped.

    Values are aligned to their own player and game (the shift and the
    rolling window both run inside the player's partition).  The position
    filter reaches the scan.
    """
    df = weekly if position is None else weekly.filter(F.col("position") == position)
    df = df.withColumn("yards_per_carry", safe_divide("rushing_yards", "carries")).withColumn(
        "yards_per_reception", safe_divide("receiving_yards", "receptions")
    )
    rolled = rolling_mean_before(df, roll_cols, (player,), order, window, suffix="_last{n}")
    return rolled.na.drop(how="any", subset=[f"{c}_last{window}" for c in roll_cols])


def map_values(
    df: DataFrame,
    column: str,
    mapping: DataFrame | Mapping[str, str],
    spark: SparkSession | None = None,
    key: str = "name",
    value: str = "abbr",
) -> DataFrame:
    """Replace values found in ``mapping`` (unmapped values are kept).

    A Python mapping becomes a literal table of at most its own size, so it
    is broadcast; a DataFrame mapping is joined and left to AQE's
    size-checked broadcast decision.  Of several values of one name the
    smallest counts, so no row is multiplied.
    """
    if isinstance(mapping, Mapping):
        spark = spark or df.sparkSession
        table = spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")
        table = F.broadcast(table)
    else:
        table = first_per_key(mapping.select(key, value), [key], [value])
    table = table.withColumnRenamed(key, "_map_key").withColumnRenamed(value, "_map_value")
    joined = df.join(table, F.col(column) == F.col("_map_key"), "left")
    return joined.select(
        *[F.coalesce(F.col("_map_value"), F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns]
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ascending ``order`` (missing values
    last) -- a stated tie-break, not whatever row happens to come first.

    An aggregate (``min_by`` on the order), not a window: each task keeps
    one row per key before the shuffle, so a key with a third of the rows
    costs no more than any other."""
    rank = F.struct(*[e for c in order for e in (F.col(c).isNull(), F.col(c))])
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in others]), rank).alias("_first"))
    return picked.select(*keys, *[F.col("_first")[c].alias(c) for c in others])


def lookup_first(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    value: str,
    out: str,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """For each left row, ``value`` of the first right row whose keys match
    (NULL when none does).  The right side is reduced to one row per key
    first, so the left side is never multiplied."""
    order = list(order) if order is not None else [value]
    one = first_per_key(right, right_keys, order).select(*right_keys, value)
    renamed = one.select(
        *[F.col(r).alias(f"_lk{i}") for i, r in enumerate(right_keys)], F.col(value).alias(out)
    )
    cond = None
    for i, lk in enumerate(left_keys):
        c = F.col(lk) == F.col(f"_lk{i}")
        cond = c if cond is None else (cond & c)
    joined = left.join(renamed, cond, "left")
    return joined.drop(*[f"_lk{i}" for i in range(len(right_keys))])


def player_opponent_dataset(
    offense: DataFrame,
    defense: DataFrame,
    name_map: DataFrame | Mapping[str, str],
    position: str = "QB",
    players: Sequence[str] | None = None,
    seasons: Sequence[int] | None = None,
    value_template: str = "{p} FantPt",
) -> DataFrame:
    """Each player-week with the points its opponent allowed to
    ``position`` that season: player rows (optionally a few players and
    seasons -- filters that reach the scan), the defence table's full team
    names mapped to abbreviations, and a first-match lookup on (opponent,
    season).  Generalised from one player to all of them."""
    rows = offense
    if players is not None:
        rows = rows.filter(F.col("player_display_name").isin(list(players)))
    if seasons is not None:
        rows = rows.filter(F.col("season").isin(list(seasons)))
    rows = rows.select("player_id", "player_display_name", "position", "season", "recent_team", "week",
                       "opponent_team", "fantasy_points_ppr")
    value = value_template.format(p=position)
    mapped = map_values(defense, "Tm", name_map)
    return lookup_first(rows, mapped, ["opponent_team", "season"], ["Tm", "Season"], value,
                        f"{position}_FantPt_Allowed", order=[value])
