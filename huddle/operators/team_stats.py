"""Per-side weekly statistics from play rows (offence, defence, combined).

Semantics kept from the pipeline being rebuilt:

* plays without an offence side are dropped before anything else;
* a side's sums over all-missing values are 0, its max stays NULL;
* plays with a missing side key do not form a group;
* ``rush_epa`` and ``pass_epa`` default to the total epa of the group (the
  original aggregate summed epa over every play of the group); the
  conditional sums are available as ``rush_epa_cond`` / ``pass_epa_cond``.

Plan shape: the combined statistics are computed in **one** scan and **one**
shuffle.  Every play is emitted twice (once keyed by its offence, once by
its defence) by an inline generator that sits inside the same codegen stage
as the partial aggregate, so the doubled rows never hit the shuffle; the
inner join of offence and defence groups becomes a HAVING on both sides
being present.  A hot team or week is absorbed by the map-side partial
aggregate.

Pipelines that need several things from the plays (team weeks, games,
priors) roll them up once with :func:`pair_week_stats` -- one row per
(season, week, offence, defence), independent of the number of plays -- and
derive everything else from that small table (:func:`team_week_from_pairs`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (output name, aggregate, input column) -- fixed names of the weekly table.
OFFENSE_AGGS = [
    ("passing_yards", "sum", "passing_yards"),
    ("rushing_yards", "sum", "rushing_yards"),
    ("interceptions", "sum", "interception"),
    ("fumbles", "sum", "fumble_lost"),
    ("points_scored", "max", "posteam_score_post"),
    ("epa_total", "sum", "epa"),
]
DEFENSE_AGGS = [
    ("interceptions_def", "sum", "interception"),
    ("fumbles_forced", "sum", "fumble_lost"),
    ("points_allowed", "max", "posteam_score_post"),
    ("epa_allowed", "sum", "epa"),
]

_SIDE = "_on_offense"


def _agg(kind: str, value: Column) -> Column:
    if kind == "sum":
        # a group whose values are all missing sums to 0, not NULL
        return F.coalesce(F.sum(value), F.lit(0.0))
    if kind == "max":
        return F.max(value)
    raise ValueError(kind)


def _offense_exprs(cond: Column | None, conditional_epa: bool) -> list[Column]:
    def pick(c: str) -> Column:
        return F.col(c) if cond is None else F.when(cond, F.col(c))

    exprs = [_agg(kind, pick(src)).alias(name) for name, kind, src in OFFENSE_AGGS]
    # original semantics: both equal the total epa of the group
    exprs.append(_agg("sum", pick("epa")).alias("rush_epa"))
    exprs.append(_agg("sum", pick("epa")).alias("pass_epa"))
    if conditional_epa:
        for name, flag in (("rush_epa_cond", "rush_attempt"), ("pass_epa_cond", "pass_attempt")):
            c = F.col(flag) == 1
            c = c if cond is None else (c & cond)
            exprs.append(_agg("sum", F.when(c, F.col("epa"))).alias(name))
    return exprs


def _defense_exprs(cond: Column | None) -> list[Column]:
    def pick(c: str) -> Column:
        return F.col(c) if cond is None else F.when(cond, F.col(c))

    return [_agg(kind, pick(src)).alias(name) for name, kind, src in DEFENSE_AGGS]


def turnover_margin() -> Column:
    return (F.col("interceptions_def") + F.col("fumbles_forced")) - (
        F.col("interceptions") + F.col("fumbles")
    )


def offense_stats(
    plays: DataFrame,
    keys: Sequence[str] = ("season", "week"),
    offense: str = "posteam",
    team_col: str = "team",
    conditional_epa: bool = False,
) -> DataFrame:
    """Offence aggregates per (keys, team) -- one group per side that had the ball."""
    return (
        plays.filter(F.col(offense).isNotNull())
        .groupBy(*keys, F.col(offense).alias(team_col))
        .agg(*_offense_exprs(None, conditional_epa))
    )


def defense_stats(
    plays: DataFrame,
    keys: Sequence[str] = ("season", "week"),
    offense: str = "posteam",
    defense: str = "defteam",
    team_col: str = "team",
) -> DataFrame:
    """Defence aggregates per (keys, team); plays without an offence side are
    dropped first, plays without a defence side form no group."""
    return (
        plays.filter(F.col(offense).isNotNull() & F.col(defense).isNotNull())
        .groupBy(*keys, F.col(defense).alias(team_col))
        .agg(*_defense_exprs(None))
    )


def team_week_stats(
    plays: DataFrame,
    keys: Sequence[str] = ("season", "week"),
    offense: str = "posteam",
    defense: str = "defteam",
    team_col: str = "team",
    conditional_epa: bool = False,
) -> DataFrame:
    """Offence and defence of each team per (keys): the inner join of
    :func:`offense_stats` and :func:`defense_stats`, in one aggregation."""
    sides = F.array(
        F.struct(F.col(offense).alias(team_col), F.lit(True).alias(_SIDE)),
        F.struct(F.col(defense).alias(team_col), F.lit(False).alias(_SIDE)),
    )
    needed = {"posteam_score_post", "epa", "passing_yards", "rushing_yards", "interception", "fumble_lost"}
    if conditional_epa:
        needed |= {"rush_attempt", "pass_attempt"}
    on_offense = F.col(_SIDE)
    stats = (
        plays.filter(F.col(offense).isNotNull())
        .select(*keys, *sorted(needed), F.inline(sides))
        .filter(F.col(team_col).isNotNull())
        .groupBy(*keys, team_col)
        .agg(
            F.count_if(on_offense).alias("_n_off"),
            F.count_if(~on_offense).alias("_n_def"),
            *_offense_exprs(on_offense, conditional_epa),
            *_defense_exprs(~on_offense),
        )
        .filter((F.col("_n_off") > 0) & (F.col("_n_def") > 0))
        .drop("_n_off", "_n_def")
    )
    return stats.withColumn("turnover_margin", turnover_margin())


def team_week_stats_joined(
    plays: DataFrame,
    keys: Sequence[str] = ("season", "week"),
    offense: str = "posteam",
    defense: str = "defteam",
    team_col: str = "team",
) -> DataFrame:
    """The same result as :func:`team_week_stats`, written as two aggregates
    and an inner join (kept for comparison of plans and as a test oracle)."""
    off = offense_stats(plays, keys, offense, team_col)
    dfn = defense_stats(plays, keys, offense, defense, team_col)
    return off.join(dfn, [*keys, team_col], "inner").withColumn("turnover_margin", turnover_margin())


def single_team_week_stats(
    plays: DataFrame,
    team: str,
    keys: Sequence[str] = ("season", "week"),
    offense: str = "posteam",
    defense: str = "defteam",
) -> DataFrame:
    """One team's weekly offence ⋈ defence with turnover margin and point
    delta, ordered by week.  The team filter is pushed to the scan."""
    mine = plays.filter((F.col(offense) == team) | (F.col(defense) == team))
    stats = team_week_stats(mine, keys, offense, defense).filter(F.col("team") == team)
    out = stats.drop("team", "rush_epa", "pass_epa").withColumn(
        "point_delta", F.col("points_scored") - F.col("points_allowed")
    )
    return out.orderBy(*keys)


SCHEDULE = ("season", "week", "game_id", "home_team", "away_team", "home_score", "away_score")


def schedule_rows(plays: DataFrame, columns: Sequence[str] = SCHEDULE) -> DataFrame:
    """Distinct game rows carried on every play."""
    return plays.select(*columns).distinct()


# ------------------------------------------------------- pair-level rollup
# Decomposable per-play measures kept at pair level: (name, aggregate, input).
PAIR_AGGS = [
    ("passing_yards", "sum", "passing_yards"),
    ("rushing_yards", "sum", "rushing_yards"),
    ("interception", "sum", "interception"),
    ("fumble_lost", "sum", "fumble_lost"),
    ("posteam_score_post", "max", "posteam_score_post"),
    ("epa", "sum", "epa"),
]


def pair_week_stats(
    plays: DataFrame,
    keys: Sequence[str] = ("season", "week"),
    offense: str = "posteam",
    defense: str = "defteam",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per (keys, offence, defence): the plays rolled up with
    decomposable aggregates (sums stay NULL when every value is missing,
    so later levels can apply the 0 rule once).

    ``carry`` names further columns to group by, such as those of the
    schedule.  Plays without an offence then stay, in rows of their own: they
    list games, and every reader of the statistics leaves them out.

    This is the only pass over the play rows a whole pipeline needs: team
    statistics, games and every history feature derive from it.  Its size
    is teams^2 x weeks, independent of the number of plays, so it is the
    natural table to checkpoint and share between branches (column pruning
    otherwise gives each branch its own scan of the plays).
    """
    rush, pas = F.col("rush_attempt") == 1, F.col("pass_attempt") == 1
    rows = plays if carry else plays.filter(F.col(offense).isNotNull())
    return rows.groupBy(*keys, *[c for c in carry if c not in keys], offense, defense).agg(
        F.count(F.lit(1)).alias("plays"),
        *[(F.sum(src) if kind == "sum" else F.max(src)).alias(name) for name, kind, src in PAIR_AGGS],
        F.sum(F.when(rush, F.col("epa"))).alias("rush_epa_cond"),
        F.sum(F.when(pas, F.col("epa"))).alias("pass_epa_cond"),
    )


def team_week_from_pairs(
    pairs: DataFrame,
    keys: Sequence[str] = ("season", "week"),
    offense: str = "posteam",
    defense: str = "defteam",
    team_col: str = "team",
) -> DataFrame:
    """:func:`team_week_stats` computed from :func:`pair_week_stats` rows
    (the same values: sums of sums, max of maxes, counts of counts)."""
    sides = F.array(
        F.struct(F.col(offense).alias(team_col), F.lit(True).alias(_SIDE)),
        F.struct(F.col(defense).alias(team_col), F.lit(False).alias(_SIDE)),
    )
    measures = ["plays", *[name for name, _, _ in PAIR_AGGS]]
    on_off = F.col(_SIDE)
    o = lambda c: F.when(on_off, F.col(c))
    d = lambda c: F.when(~on_off, F.col(c))

    def s(c):
        return F.coalesce(F.sum(c), F.lit(0.0))

    stats = (
        pairs.filter(F.col(offense).isNotNull())
        .select(*keys, *measures, F.inline(sides))
        .filter(F.col(team_col).isNotNull())
        .groupBy(*keys, team_col)
        .agg(
            F.sum(o("plays")).alias("_n_off"),
            F.sum(d("plays")).alias("_n_def"),
            s(o("passing_yards")).alias("passing_yards"),
            s(o("rushing_yards")).alias("rushing_yards"),
            s(o("interception")).alias("interceptions"),
            s(o("fumble_lost")).alias("fumbles"),
            F.max(o("posteam_score_post")).alias("points_scored"),
            s(o("epa")).alias("epa_total"),
            s(o("epa")).alias("rush_epa"),
            s(o("epa")).alias("pass_epa"),
            s(d("interception")).alias("interceptions_def"),
            s(d("fumble_lost")).alias("fumbles_forced"),
            F.max(d("posteam_score_post")).alias("points_allowed"),
            s(d("epa")).alias("epa_allowed"),
        )
        .filter((F.col("_n_off") > 0) & (F.col("_n_def") > 0))
        .drop("_n_off", "_n_def")
    )
    return stats.withColumn("turnover_margin", turnover_margin())
