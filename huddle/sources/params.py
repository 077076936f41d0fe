"""Parameter grids: every (season, position) pair with its URL or file name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# URL template of the per-season, per-position tables (fixed value).
DEFENSE_URL = "https://www.pro-football-reference.com/years/{year}/fantasy-points-against-{position}.htm"
POSITIONS = ["RB", "TE", "WR", "QB"]


def season_position_grid(
    spark: SparkSession,
    seasons: Sequence[int],
    positions: Sequence[str] = POSITIONS,
    template: str = DEFENSE_URL,
) -> DataFrame:
    """(season, position, url) for every combination.  The grid is built
    from two literal lists on the driver (its size is the product of the
    two lists, known before anything runs); the URL is a column
    expression."""
    rows = [(int(s), p) for s in seasons for p in positions]
    grid = spark.createDataFrame(rows, "season int, position string")
    fmt = template.replace("{year}", "%d").replace("{position}", "%s")
    return grid.withColumn("url", F.format_string(fmt, "season", "position"))
