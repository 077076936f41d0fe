"""Leakage-free history features: lag, rolling and expanding means over
earlier rows only, prior-season means, and the early-season blend.

Window discipline: every window has a ``partitionBy`` (never a global
window), and all columns sharing a window spec are added in one ``select``
so the plan has one Window node, one sort and one exchange.  The inputs are
pre-aggregated per (entity, period) -- a team-week, a player-week -- so a
key's window group is bounded by the number of periods, however many raw
events a hot key produced (those were collapsed by the map-side partial
aggregate that built the rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from huddle.schemas import FEATURE_COLS


def _spec(partition: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*partition).orderBy(*order)


def lag_columns(
    df: DataFrame,
    columns: Sequence[str],
    partition: Sequence[str],
    order: Sequence[str],
    offset: int = 1,
    suffix: str = "_lag{n}",
) -> DataFrame:
    """Value ``offset`` rows earlier in the same partition (NULL before the first)."""
    w = _spec(partition, order)
    return df.select(
        "*", *[F.lag(c, offset).over(w).alias(c + suffix.format(n=offset)) for c in columns]
    )


def rolling_mean_before(
    df: DataFrame,
    columns: Sequence[str],
    partition: Sequence[str],
    order: Sequence[str],
    window: int = 3,
    suffix: str = "_last{n}",
) -> DataFrame:
    """Mean of the previous ``window`` rows, NULL unless all of them exist
    and are non-missing (a shift-by-one then fixed-size rolling mean)."""
    w = _spec(partition, order).rowsBetween(-window, -1)

    def roll(c: str) -> Column:
        return F.when(F.count(c).over(w) == window, F.avg(c).over(w))

    return df.select("*", *[roll(c).alias(c + suffix.format(n=window)) for c in columns])


def expanding_mean_before(
    df: DataFrame,
    columns: Sequence[str],
    partition: Sequence[str] = ("season", "team"),
    order: Sequence[str] = ("week",),
    prefix: str = "rolling_",
) -> DataFrame:
    """Mean of all earlier rows in the partition, ignoring missing values;
    NULL on the first row (and while every earlier value is missing)."""
    w = _spec(partition, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.select("*", *[F.avg(c).over(w).alias(prefix + c) for c in columns])


def season_means(
    weekly: DataFrame,
    features: Sequence[str] = FEATURE_COLS,
    season: str = "season",
    entity: str = "team",
) -> DataFrame:
    """Mean of each feature per (season, entity); an all-missing mean is 0."""
    return weekly.groupBy(season, entity).agg(
        *[F.coalesce(F.avg(f), F.lit(0.0)).alias(f) for f in features]
    )


def prior_season_means(
    weekly: DataFrame,
    features: Sequence[str] = FEATURE_COLS,
    lag: int = 2,
    season: str = "season",
    entity: str = "team",
) -> DataFrame:
    """The prior an entity carries into season *s*: its feature means of
    season ``s - lag``, available only if it also has rows in season ``s-1``.

    ``lag=2`` reproduces the original lookup (means stored under the next
    season's key, then read back with ``season - 1``); ``lag=1`` is the
    plain previous season.  The shift is a join on a shifted key, not a
    driver-side dictionary, so it scales with the number of seasons x
    entities.
    """
    if lag < 1:
        raise ValueError("lag must be >= 1")
    means = season_means(weekly, features, season, entity).withColumn(
        season, (F.col(season) + lag).cast("int")
    )
    if lag == 1:
        return means
    present_last_season = (
        weekly.select(season, entity).distinct().withColumn(season, (F.col(season) + 1).cast("int"))
    )
    return means.join(present_last_season, [season, entity], "left_semi")


def blend_with_prior(
    weekly: DataFrame,
    prior: DataFrame,
    features: Sequence[str] = FEATURE_COLS,
    season: str = "season",
    entity: str = "team",
    week: str = "week",
    early_weeks: int = 3,
    prior_only_when_no_history: bool = False,
) -> DataFrame:
    """Expanding mean of earlier weeks, blended with the prior in the first
    ``early_weeks`` weeks: ``w * prior + (1 - w) * rolling`` with
    ``w = (early_weeks + 1 - week) / early_weeks``.

    Week 1 has no earlier week, so the blend is NULL there (a weight times a
    missing value); ``prior_only_when_no_history=True`` uses the prior alone
    in that case instead.  Output: (season, week, entity, *features).
    """
    rolled = expanding_mean_before(weekly, features, (season, entity), (week,))
    pri = prior.select(
        season, entity, F.lit(True).alias("_has_prior"), *[F.col(f).alias("prior_" + f) for f in features]
    )
    j = rolled.join(pri, [season, entity], "left")
    wk = F.col(week)
    w = (F.lit(early_weeks + 1) - wk) / F.lit(float(early_weeks))
    use_prior = F.col("_has_prior").isNotNull() & (wk <= early_weeks)

    def blend(f: str) -> Column:
        prior_v, roll_v = F.col("prior_" + f), F.col("rolling_" + f)
        mixed = w * prior_v + (F.lit(1.0) - w) * roll_v
        if prior_only_when_no_history:
            mixed = F.when(roll_v.isNull(), prior_v).otherwise(mixed)
        return F.when(use_prior, mixed).otherwise(roll_v).alias(f)

    return j.select(season, week, entity, *[blend(f) for f in features])


def blend_trace(
    weekly: DataFrame,
    prior: DataFrame,
    team: str,
    weeks: Sequence[int] = (1, 2, 3),
    features: Sequence[str] = FEATURE_COLS,
    season: str = "season",
    entity: str = "team",
    week: str = "week",
    early_weeks: int = 3,
) -> DataFrame:
    """Diagnostic rows for one team and some weeks where the prior was
    blended in: (season, week, team, feature, prior, rolling, weight_prior,
    weight_current, blended).  The team filter is applied before the window,
    so only that team's rows are read into it."""
    mine = weekly.filter(F.col(entity) == team)
    rolled = expanding_mean_before(mine, features, (season, entity), (week,))
    pri = prior.filter(F.col(entity) == team).select(
        season, entity, *[F.col(f).alias("prior_" + f) for f in features]
    )
    j = rolled.join(pri, [season, entity], "inner").filter(
        F.col(week).isin(list(weeks)) & (F.col(week) <= early_weeks)
    )
    w = (F.lit(early_weeks + 1) - F.col(week)) / F.lit(float(early_weeks))
    rows = F.array(*[
        F.struct(
            F.lit(f).alias("feature"), F.col("prior_" + f).alias("prior"), F.col("rolling_" + f).alias("rolling"),
        )
        for f in features
    ])
    long = j.select(season, week, entity, w.alias("weight_prior"), F.inline(rows))
    return long.select(
        season, week, entity, "feature", "prior", "rolling", "weight_prior",
        (F.lit(1.0) - F.col("weight_prior")).alias("weight_current"),
        (F.col("weight_prior") * F.col("prior") + (F.lit(1.0) - F.col("weight_prior")) * F.col("rolling")).alias("blended"),
    )


def _chunk_of(df: DataFrame, ts: str, chunk_seconds: int) -> Column:
    """Chunk number of each row, non-decreasing in ``ts`` order.

    A wall-clock timestamp (``timestamp_ntz``) is converted without any time
    zone (a session zone would make the mapping jump backwards across a
    daylight-saving gap); an instant (``timestamp``) uses its epoch value.
    """
    from pyspark.sql import types as T

    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.TimestampNTZType):
        c = F.col(ts)
        seconds = (F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600
                   + F.minute(c) * 60 + F.second(c))
        return F.floor(seconds / F.lit(chunk_seconds)).cast("long")
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(chunk_seconds * 1_000_000)).cast("long")


def _join_chunk_summary(rows: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """Left-join a per-(key, chunk) summary onto the rows with null-safe keys.

    Null-safe equality keeps NULL keys as one group (as a window partition
    does) and lets the optimizer add no ``isnotnull`` filter to one side
    only, so both sides keep the same scan and shuffle of the raw rows,
    which Spark then runs once and reuses.
    """
    other = [c for c in summary.columns if c not in (key, "_chunk")]
    s = summary.select(F.col(key).alias("_sk"), F.col("_chunk").alias("_sc"), *other)
    cond = F.col(key).eqNullSafe(F.col("_sk")) & F.col("_chunk").eqNullSafe(F.col("_sc"))
    return rows.join(s, cond, "left").drop("_sk", "_sc")


def lag_by_time_chunks(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    ts: str,
    tie_break: str,
    chunk_seconds: int = 3600,
    suffix: str = "_prev",
) -> DataFrame:
    """Previous row's values per ``key`` in (``ts``, ``tie_break``) order --
    the same result as ``lag(c, 1)`` over ``partitionBy(key)`` -- without
    putting a key's whole history into one task.

    Raw rows are windowed inside (key, time chunk) partitions, so a key
    holding a third of all rows is spread over as many tasks as it has
    chunks.  The first row of each chunk takes its value from the last row
    of the key's previous non-empty chunk: a per-(key, chunk) summary built
    with ``max_by`` (map-side partial aggregation, so a hot key costs one
    row per chunk per task) and a window over the summary, whose size per
    key is the number of chunks -- bounded by time span, not by volume.
    """
    base = df.withColumn("_chunk", _chunk_of(df, ts, chunk_seconds))
    w_in = Window.partitionBy(key, "_chunk").orderBy(ts, tie_break)
    inner = base.select("*", F.row_number().over(w_in).alias("_rn"),
                        *[F.lag(c, 1).over(w_in).alias(c + suffix) for c in columns])
    # the chunk summary reads the windowed rows (already clustered by key and
    # chunk, so no second shuffle and no second scan of the raw rows)
    last = inner.groupBy(key, "_chunk").agg(
        F.max_by(F.struct(*[F.col(c) for c in columns]), F.col("_rn")).alias("_last"))
    w_chunks = Window.partitionBy(key).orderBy("_chunk")
    carried = last.select(key, "_chunk", F.lag("_last", 1).over(w_chunks).alias("_carry"))
    joined = _join_chunk_summary(inner, carried, key)
    first = F.col("_rn") == 1
    return joined.select(
        *df.columns,
        *[F.when(first, F.col("_carry")[c]).otherwise(F.col(c + suffix)).alias(c + suffix) for c in columns],
    )


def _with_previous_rows(
    df: DataFrame, columns: Sequence[str], key: str, ts: str, tie_break: str, n: int, chunk_seconds: int
) -> tuple[DataFrame, Column]:
    """The rows of ``df`` joined with what is needed to see, for each row,
    its key's previous ``n`` rows (oldest first).  Returns the joined frame
    and a column holding that array (shorter near the start of a key).

    Rows are windowed per (key, time chunk), collecting at most ``n``
    predecessors each.  A chunk's first rows complete their list from a
    halo: the last ``n`` rows of the key's previous non-empty chunks, built
    from each chunk's tail (its last row's predecessors plus itself) and a
    window over one row per chunk.  Every task holds one chunk of one key;
    nothing per key grows with the data volume.
    """
    base = df.withColumn("_chunk", _chunk_of(df, ts, chunk_seconds))
    vals = F.struct(*[F.col(c).alias(c) for c in columns])
    w_in = Window.partitionBy(key, "_chunk").orderBy(ts, tie_break)
    inner = base.select("*", F.collect_list(vals).over(w_in.rowsBetween(-n, -1)).alias("_prev"),
                        F.row_number().over(w_in).alias("_rn"))
    # a chunk's tail (its last n rows, in order) is its last row's collected
    # predecessors plus the row itself: derived from the windowed rows, so
    # the raw rows are scanned and shuffled once
    upto = F.concat(F.col("_prev"), F.array(vals))
    tail = F.slice(upto, F.greatest(F.size(upto) - n + 1, F.lit(1)), n)
    tails = inner.groupBy(key, "_chunk").agg(F.max_by(tail, F.col("_rn")).alias("_tail"))
    w_chunks = Window.partitionBy(key).orderBy("_chunk").rowsBetween(-n, -1)
    halo = tails.select(key, "_chunk", F.flatten(F.collect_list("_tail").over(w_chunks)).alias("_halo"))
    joined = _join_chunk_summary(inner, halo, key)
    element = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in columns)
    no_halo = F.array().cast(f"array<struct<{element}>>")
    seq = F.concat(F.coalesce(F.col("_halo"), no_halo), F.col("_prev"))
    return joined, F.slice(seq, F.greatest(F.size(seq) - n + 1, F.lit(1)), n)


def rolling_mean_by_time_chunks(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    ts: str,
    tie_break: str,
    window: int = 3,
    chunk_seconds: int = 3600,
    suffix: str = "_last{n}",
) -> DataFrame:
    """:func:`rolling_mean_before` (mean of the previous ``window`` rows,
    NULL unless all exist and are non-missing) per ``key`` in (``ts``,
    ``tie_break``) order, for raw rows where one key may hold a large share
    of the data (see :func:`_with_previous_rows`)."""
    n = window
    joined, prev = _with_previous_rows(df, columns, key, ts, tie_break, n, chunk_seconds)

    def field(name: str):
        return lambda e: e[name].cast("double")

    outs = []
    for c in columns:
        v = F.transform(prev, field(c))
        total = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)
        ok = (F.size(v) == n) & ~F.exists(v, lambda x: x.isNull())
        outs.append(F.when(ok, total / F.lit(float(n))).alias(c + suffix.format(n=n)))
    return joined.select(*df.columns, *outs)


def lag_n_by_time_chunks(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    ts: str,
    tie_break: str,
    offset: int,
    chunk_seconds: int = 3600,
    suffix: str = "_lag{n}",
) -> DataFrame:
    """``lag(c, offset)`` per ``key`` in (``ts``, ``tie_break``) order for
    any offset, skew-safe like :func:`lag_by_time_chunks` (which is the
    cheaper path for offset 1): the value ``offset`` rows back is the first
    of the row's previous ``offset`` rows."""
    joined, prev = _with_previous_rows(df, columns, key, ts, tie_break, offset, chunk_seconds)
    first = F.when(F.size(prev) == offset, F.element_at(prev, 1))
    return joined.select(*df.columns, *[first[c].alias(c + suffix.format(n=offset)) for c in columns])
