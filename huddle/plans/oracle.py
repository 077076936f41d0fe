"""Independent SQL for each registered query (runs on DuckDB over the same
Parquet tables).  Written from the semantics, not from the Spark code: the
team-week table, for instance, is two aggregates and an inner join here."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

PLAYS_CTE = """
plays_base AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season,
         CAST(month(o.o_orderdate) AS INTEGER) AS week,
         CAST(s.s_nationkey AS VARCHAR) AS posteam,
         CAST(c.c_nationkey AS VARCHAR) AS defteam,
         CAST(round(l.l_quantity) AS BIGINT) AS qty,
         CAST(round(l.l_extendedprice / 100) AS BIGINT) AS score,
         CAST(round(l.l_discount * 100) AS BIGINT) AS disc,
         l.l_linestatus AS st, l.l_returnflag AS fl
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
plays AS (
  SELECT season, week,
         concat_ws('_', CAST(season AS VARCHAR), CAST(week AS VARCHAR),
                   least(posteam, defteam), greatest(posteam, defteam)) AS game_id,
         least(posteam, defteam) AS home_team,
         greatest(posteam, defteam) AS away_team,
         posteam, defteam,
         CAST(score AS DOUBLE) AS posteam_score_post,
         CAST(disc - 5 AS DOUBLE) AS epa,
         CAST(st = 'O' AS DOUBLE) AS rush_attempt,
         CAST(st = 'F' AS DOUBLE) AS pass_attempt,
         CAST(CASE WHEN st = 'F' THEN qty END AS DOUBLE) AS passing_yards,
         CAST(CASE WHEN st = 'O' THEN qty END AS DOUBLE) AS rushing_yards,
         CAST(fl = 'R' AS DOUBLE) AS interception,
         CAST(fl = 'A' AND st = 'F' AS DOUBLE) AS fumble_lost,
         qty AS _qty
  FROM plays_base
)"""

OFFENSE_CTE = """
off AS (
  SELECT season, week, posteam AS team,
         coalesce(sum(passing_yards), 0) AS passing_yards,
         coalesce(sum(rushing_yards), 0) AS rushing_yards,
         coalesce(sum(interception), 0) AS interceptions,
         coalesce(sum(fumble_lost), 0) AS fumbles,
         max(posteam_score_post) AS points_scored,
         coalesce(sum(epa), 0) AS epa_total,
         coalesce(sum(epa), 0) AS rush_epa,
         coalesce(sum(epa), 0) AS pass_epa,
         coalesce(sum(CASE WHEN rush_attempt = 1 THEN epa END), 0) AS rush_epa_cond,
         coalesce(sum(CASE WHEN pass_attempt = 1 THEN epa END), 0) AS pass_epa_cond
  FROM plays WHERE posteam IS NOT NULL
  GROUP BY season, week, posteam
)"""

DEFENSE_CTE = """
def AS (
  SELECT season, week, defteam AS team,
         coalesce(sum(interception), 0) AS interceptions_def,
         coalesce(sum(fumble_lost), 0) AS fumbles_forced,
         max(posteam_score_post) AS points_allowed,
         coalesce(sum(epa), 0) AS epa_allowed
  FROM plays WHERE posteam IS NOT NULL AND defteam IS NOT NULL
  GROUP BY season, week, defteam
)"""

TWS_CTE = """
tws AS (
  SELECT o.season, o.week, o.team, o.passing_yards, o.rushing_yards, o.interceptions,
         o.fumbles, o.points_scored, o.epa_total, o.rush_epa, o.pass_epa,
         d.interceptions_def, d.fumbles_forced, d.points_allowed, d.epa_allowed,
         (d.interceptions_def + d.fumbles_forced) - (o.interceptions + o.fumbles) AS turnover_margin
  FROM off o JOIN def d ON o.season = d.season AND o.week = d.week AND o.team = d.team
)"""

GAMES_CTE = """
games AS (
  SELECT season, week, game_id, home_team, away_team,
         CAST(coalesce(sum(CASE WHEN posteam = home_team THEN _qty END), 0) AS INTEGER) AS home_score,
         CAST(coalesce(sum(CASE WHEN posteam <> home_team THEN _qty END), 0) AS INTEGER) AS away_score
  FROM plays WHERE home_team <> away_team GROUP BY season, week, game_id, home_team, away_team
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


ORACLE["team_week_offense"] = with_ctes(PLAYS_CTE, OFFENSE_CTE) + "SELECT * FROM off"
ORACLE["team_week_defense"] = with_ctes(PLAYS_CTE, DEFENSE_CTE) + "SELECT * FROM def"
ORACLE["team_week_stats"] = with_ctes(PLAYS_CTE, OFFENSE_CTE, DEFENSE_CTE, TWS_CTE) + "SELECT * FROM tws"
ORACLE["single_team_week"] = with_ctes(PLAYS_CTE, OFFENSE_CTE, DEFENSE_CTE, TWS_CTE) + """
SELECT season, week, passing_yards, rushing_yards, interceptions, fumbles, points_scored,
       epa_total, interceptions_def, fumbles_forced, points_allowed, epa_allowed,
       turnover_margin, points_scored - points_allowed AS point_delta
FROM tws WHERE team = '7' ORDER BY season, week"""
ORACLE["schedule_distinct"] = with_ctes(PLAYS_CTE) + """
SELECT DISTINCT season, week, game_id, home_team, away_team FROM plays WHERE home_team <> away_team"""
ORACLE["games"] = with_ctes(PLAYS_CTE, GAMES_CTE) + "SELECT * FROM games"


# ------------------------------------------------------------------ history
FEATURES = [
    "passing_yards", "rushing_yards", "turnover_margin", "points_scored",
    "points_allowed", "epa_total", "rush_epa", "pass_epa",
]


def _cols(template: str, sep: str = ",\n         ") -> str:
    return sep.join(template.format(f=f) for f in FEATURES)


MEANS_CTE = f"""
means AS (
  SELECT season, team, {_cols("coalesce(avg({f}), 0) AS {f}")}
  FROM tws GROUP BY season, team
)"""


def prior_cte(lag: int) -> str:
    exists = "" if lag == 1 else (
        "WHERE EXISTS (SELECT 1 FROM tws t WHERE t.season = m.season + 1 AND t.team = m.team)"
    )
    return f"""
prior AS (
  SELECT CAST(m.season + {lag} AS INTEGER) AS season, m.team, {_cols("m.{f}")}
  FROM means m {exists}
)"""


ROLL_CTE = f"""
roll AS (
  SELECT season, week, team, {_cols("avg({f}) OVER w AS rolling_{f}")}
  FROM tws
  WINDOW w AS (PARTITION BY season, team ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)"""


def blended_cte(prior_fill: bool = False) -> str:
    w = "(CAST(4 - r.week AS DOUBLE) / 3)"
    mix = f"{w} * p.{{f}} + (1 - {w}) * r.rolling_{{f}}"
    if prior_fill:
        mix = f"CASE WHEN r.rolling_{{f}} IS NULL THEN p.{{f}} ELSE {mix} END"
    expr = f"CASE WHEN p.team IS NOT NULL AND r.week <= 3 THEN {mix} ELSE r.rolling_{{f}} END AS {{f}}"
    return f"""
blended AS (
  SELECT r.season, r.week, r.team, {_cols(expr)}
  FROM roll r LEFT JOIN prior p ON r.season = p.season AND r.team = p.team
)"""


MATCHUP_CTE = f"""
matchup AS (
  SELECT g.season, g.week, g.game_id, g.home_team, g.away_team,
         g.week AS week_number,
         CAST(g.week <= 3 AS INTEGER) AS is_early_season,
         {_cols("h.{f} - a.{f} AS {f}_delta")},
         substr(g.home_team, 1, 3) = substr(g.away_team, 1, 3) AS is_division_game,
         CAST(g.home_score - g.away_score AS INTEGER) AS actual_spread
  FROM games g
  LEFT JOIN blended h ON g.season = h.season AND g.week = h.week AND g.home_team = h.team
  LEFT JOIN blended a ON g.season = a.season AND g.week = a.week AND g.away_team = a.team
)"""

_TWS = (PLAYS_CTE, OFFENSE_CTE, DEFENSE_CTE, TWS_CTE)
_ROUND_FEATS = _cols("round({f}, 6) AS {f}")
ORACLE["prior_season_means"] = with_ctes(*_TWS, MEANS_CTE, prior_cte(2)) + f"SELECT season, team, {_ROUND_FEATS} FROM prior"
ORACLE["prior_season_means_lag1"] = (
    with_ctes(*_TWS, MEANS_CTE, prior_cte(1)) + f"SELECT season, team, {_ROUND_FEATS} FROM prior"
)
ORACLE["expanding_prior_mean"] = with_ctes(*_TWS, ROLL_CTE) + (
    f"SELECT season, week, team, {_cols('round(rolling_{f}, 6) AS rolling_{f}')} FROM roll"
)
_BLENDED_OUT = f"SELECT season, week, team, {_ROUND_FEATS} FROM blended"
ORACLE["blended_features"] = with_ctes(*_TWS, MEANS_CTE, prior_cte(2), ROLL_CTE, blended_cte()) + _BLENDED_OUT
ORACLE["blended_features_prior_fill"] = (
    with_ctes(*_TWS, MEANS_CTE, prior_cte(2), ROLL_CTE, blended_cte(True)) + _BLENDED_OUT
)
MATCHUP_CTES = (*_TWS, MEANS_CTE, prior_cte(2), ROLL_CTE, blended_cte(), GAMES_CTE, MATCHUP_CTE)
# "+ 0.0": a small negative difference rounds to -0.0 here and to 0.0 in Spark; the two are the same number
ORACLE["matchup_dataset"] = with_ctes(*MATCHUP_CTES) + f"""
SELECT season, week, game_id, home_team, away_team, week_number, is_early_season,
       {_cols("round({f}_delta, 6) + 0.0 AS {f}_delta")}, is_division_game, actual_spread
FROM matchup"""


# --------------------------------------------------------------- evaluation
LINES_CTE = """
lines AS (
  SELECT season, week, game_id, home_team, away_team,
         home_score - away_score AS actual_spread,
         CAST(((home_score * 7 + away_score * 3) % 15) - 7 AS DOUBLE) AS spread_line,
         CAST(((home_score * 3 + away_score * 5) % 21) - 10 AS DOUBLE) AS predicted_spread
  FROM games
)"""

EVAL_CTE = """
preds AS (
  SELECT season, week, home_team, away_team, actual_spread, predicted_spread,
         predicted_spread - actual_spread AS prediction_error
  FROM lines
),
labelled AS (
  SELECT p.*, g.spread_line,
         CASE WHEN g.spread_line = 0 THEN 'Push' WHEN g.spread_line > 0 THEN 'Home' ELSE 'Away' END AS vp,
         CASE WHEN p.actual_spread = 0 THEN 'Push' WHEN p.actual_spread > 0 THEN 'Home' ELSE 'Away' END AS ar
  FROM preds p LEFT JOIN lines g
    ON p.season = g.season AND p.home_team = g.home_team AND p.away_team = g.away_team AND p.week = g.week
),
verdicts AS (
  SELECT *,
         CASE WHEN vp = 'Push' OR ar = 'Push' THEN 'Push' WHEN vp = ar THEN 'Correct' ELSE 'Incorrect' END AS vc,
         CASE WHEN predicted_spread = 0 OR actual_spread = 0 THEN 'Push'
              WHEN (predicted_spread > 0 AND actual_spread > 0) OR (predicted_spread < 0 AND actual_spread < 0) THEN 'Correct'
              ELSE 'Incorrect' END AS mc
  FROM labelled
),
evaluated AS (
  SELECT season, week, home_team, away_team, actual_spread, predicted_spread, prediction_error, spread_line,
         vp AS vegas_prediction, vc AS vegas_correct, mc AS model_correct,
         CASE WHEN abs(predicted_spread - actual_spread) < abs(spread_line - actual_spread) THEN 'Beats Vegas'
              WHEN abs(predicted_spread - actual_spread) = abs(spread_line - actual_spread) THEN 'Tie'
              ELSE 'Loses Vegas' END AS model_beats_spread,
         CASE WHEN mc = 'Correct' AND vc = 'Incorrect' THEN 'Beats Vegas'
              WHEN mc = 'Incorrect' AND vc = 'Correct' THEN 'Loses to Vegas'
              WHEN mc = vc AND mc IN ('Correct', 'Incorrect') THEN 'Tie'
              ELSE 'No Result' END AS model_beats_vegas
  FROM verdicts
)"""

_GAMES = (PLAYS_CTE, GAMES_CTE, LINES_CTE)
ORACLE["line_evaluation"] = with_ctes(*_GAMES, EVAL_CTE) + "SELECT * FROM evaluated"
ORACLE["line_accuracy"] = with_ctes(*_GAMES, EVAL_CTE) + """
SELECT round(count_if(model_correct = 'Correct') / count(model_correct), 6) AS model_win_accuracy,
       round(count_if(vegas_correct = 'Correct') / count(vegas_correct), 6) AS vegas_win_accuracy,
       round(count_if(model_beats_spread = 'Beats Vegas') / count(model_beats_spread), 6) AS model_over_vegas_spread_accuracy,
       round(count_if(model_beats_vegas IN ('Beats Vegas', 'Tie')) / count(model_beats_vegas), 6) AS model_over_vegas_win_accuracy
FROM evaluated"""
ORACLE["regression_metrics"] = with_ctes(*_GAMES) + """
, long AS (
  SELECT 'predicted_spread' AS predictor, CAST(actual_spread AS DOUBLE) AS y, predicted_spread AS p FROM lines
  UNION ALL
  SELECT 'spread_line', CAST(actual_spread AS DOUBLE), spread_line FROM lines
)
SELECT predictor, count(p - y) AS n, round(avg((p - y) * (p - y)), 6) AS mse,
       round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae,
       min(y) AS y_min, max(y) AS y_max
FROM long GROUP BY predictor"""

# ----------------------------------------------------------- player history
ROLL_COLS = [
    "carries", "rushing_yards", "rushing_tds", "rushing_fumbles",
    "receptions", "targets", "receiving_yards", "receiving_tds",
    "receiving_fumbles", "fantasy_points_ppr", "yards_per_carry", "yards_per_reception",
]
PLAYER_DAYS_CTE = """
pdays AS (
  SELECT CAST(user_id AS VARCHAR) AS player_id, CAST(year(ts) AS INTEGER) AS season,
         CAST(dayofyear(ts) AS INTEGER) AS week,
         CAST(count_if(event_type = 'purchase') AS INTEGER) AS carries,
         CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END), 0) AS DOUBLE) AS rushing_yards,
         CAST(count_if(event_type = 'signup') AS INTEGER) AS rushing_tds,
         CAST(count_if(event_type = 'error') AS DOUBLE) AS rushing_fumbles,
         CAST(count_if(event_type = 'click') AS INTEGER) AS receptions,
         CAST(count_if(event_type = 'view') AS INTEGER) AS targets,
         CAST(coalesce(sum(CASE WHEN event_type = 'click' THEN CAST(round(value * 100) AS BIGINT) END), 0) AS DOUBLE) AS receiving_yards,
         CAST(count_if(event_type = 'click') + count_if(event_type = 'purchase') AS INTEGER) AS receiving_tds,
         CAST(coalesce(sum(CASE WHEN event_type = 'error' THEN CAST(round(value * 100) AS BIGINT) END), 0) AS DOUBLE) AS receiving_fumbles,
         CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)), 0) AS DOUBLE) AS fantasy_points_ppr
  FROM events GROUP BY 1, 2, 3
),
pfeat AS (
  SELECT *, CASE WHEN carries <> 0 THEN rushing_yards / carries END AS yards_per_carry,
            CASE WHEN receptions <> 0 THEN receiving_yards / receptions END AS yards_per_reception
  FROM pdays
)"""
_roll = ",\n         ".join(
    f"round(CASE WHEN count({c}) OVER w = 3 THEN avg({c}) OVER w END, 6) AS {c}_last3" for c in ROLL_COLS
)
_notnull = " AND ".join(f"{c}_last3 IS NOT NULL" for c in ROLL_COLS)
ORACLE["rolling_player_features"] = with_ctes(PLAYER_DAYS_CTE) + f"""
, rolled AS (
  SELECT player_id, season, week, carries, rushing_yards, rushing_tds, rushing_fumbles, receptions, targets,
         receiving_yards, receiving_tds, receiving_fumbles, fantasy_points_ppr,
         round(yards_per_carry, 6) AS yards_per_carry, round(yards_per_reception, 6) AS yards_per_reception,
         {_roll}
  FROM pfeat
  WINDOW w AS (PARTITION BY player_id ORDER BY season, week ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
)
SELECT * FROM rolled WHERE {_notnull}"""
ORACLE["rolling_means_all"] = ORACLE["rolling_player_features"].replace(f"SELECT * FROM rolled WHERE {_notnull}", "SELECT * FROM rolled")
ORACLE["lag_one"] = """
SELECT event_id, user_id, ts, event_type, value,
       lag(value) OVER w AS value_prev, lag(event_type) OVER w AS event_type_prev
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""

# ------------------------------------------------------- scaling and splits
_CONT = ["week_number", *[f"{f}_delta" for f in FEATURES]]
_stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _CONT)
_scaled = ",\n       ".join(
    f"round(({c} - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1 ELSE s_{c} END, 6) + 0.0 AS {c}" for c in _CONT
)
ORACLE["standardised_features"] = with_ctes(*MATCHUP_CTES) + f"""
, st AS (SELECT {_stats} FROM matchup)
SELECT season, game_id, {_scaled}, is_early_season,
       CAST(is_division_game AS INTEGER) AS is_division_game, actual_spread
FROM matchup, st"""

BUCKET = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT)"
ORACLE["split_buckets"] = f"""
SELECT o_orderkey, CAST({BUCKET.format(k='o_orderkey')} % 100 AS INTEGER) AS bucket,
       CASE WHEN {BUCKET.format(k='o_orderkey')} % 100 < 20 THEN 'test' ELSE 'train' END AS split
FROM orders"""
ORACLE["fold_buckets"] = f"""
SELECT CAST({BUCKET.format(k='o_orderkey')} % 5 AS INTEGER) AS fold, count(*) AS n_orders,
       min(o_orderkey) AS min_key, max(o_orderkey) AS max_key, round(sum(o_totalprice), 6) AS total_price
FROM orders GROUP BY 1"""
ORACLE["season_split"] = with_ctes(*MATCHUP_CTES) + """
SELECT season,
       CASE WHEN season < (SELECT max(season) FROM matchup) THEN 'train'
            WHEN season = (SELECT max(season) FROM matchup) THEN 'test' ELSE 'later' END AS split,
       count(*) AS n_games, CAST(sum(actual_spread) AS BIGINT) AS sum_spread
FROM matchup GROUP BY 1, 2"""


# ------------------------------------------------ positions, lookups, pivot
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
POSITION_ROWS_CTE = """
prow AS (
  SELECT n.n_name AS Tm, CAST(year(o.o_orderdate) AS INTEGER) AS Season, c.c_mktsegment AS position,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""
_piv = ", ".join(f"round(avg(CASE WHEN position = '{s}' THEN cents END), 6) AS {s}" for s in SEGMENTS)
PIVOT_CTE = f"""
pivoted AS (SELECT Tm, Season, {_piv} FROM prow GROUP BY Tm, Season)"""
ORACLE["position_pivot"] = with_ctes(POSITION_ROWS_CTE, PIVOT_CTE) + "SELECT * FROM pivoted"
_frames = ",\n".join(
    f"f_{s} AS (SELECT Tm, Season, round(avg(cents), 6) AS {s} FROM prow WHERE position = '{s}' GROUP BY Tm, Season)"
    for s in SEGMENTS
)
_joins = " ".join(f"FULL OUTER JOIN f_{s} USING (Tm, Season)" for s in SEGMENTS[1:])
ORACLE["position_full_outer"] = with_ctes(POSITION_ROWS_CTE, _frames) + (
    f"SELECT Tm, Season, {', '.join(SEGMENTS)} FROM f_{SEGMENTS[0]} {_joins}"
)
ORACLE["opponent_lookup"] = with_ctes(POSITION_ROWS_CTE, PIVOT_CTE) + """
, names AS (SELECT n_name AS name, 'N' || CAST(n_nationkey AS VARCHAR) AS abbr FROM nation WHERE n_regionkey < 4),
defense AS (SELECT coalesce(nm.abbr, p.Tm) AS Tm, p.Season, p.BUILDING FROM pivoted p LEFT JOIN names nm ON p.Tm = nm.name),
first_def AS (
  SELECT Tm, Season, BUILDING FROM (
    SELECT *, row_number() OVER (PARTITION BY Tm, Season ORDER BY BUILDING ASC NULLS LAST) AS rn FROM defense
  ) WHERE rn = 1
),
players AS (
  SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS INTEGER) AS season, 'N' || CAST(c.c_nationkey AS VARCHAR) AS opponent_team
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)
SELECT p.o_orderkey, p.season, p.opponent_team, d.BUILDING AS BUILDING_allowed
FROM players p LEFT JOIN first_def d ON p.opponent_team = d.Tm AND p.season = d.Season"""

# --------------------------------------------------- closed-form regressors
XY_CTE = f"""
xy AS (
  SELECT l_suppkey, CAST(round(l_quantity) AS BIGINT) AS x, CAST(round(l_extendedprice / 1000) AS BIGINT) AS y,
         CASE WHEN {BUCKET.format(k="concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)")} % 100 < 20
              THEN 'test' ELSE 'train' END AS split
  FROM lineitem
)"""


def stats_cte(name: str, source: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
{name} AS (
  SELECT {g}n, sx / n AS mean_x, sy / n AS mean_y,
         CAST(n * sxx - sx * sx AS DOUBLE) / n / n AS var_x,
         CAST(n * sxy - sx * sy AS DOUBLE) / n / n AS cov_xy
  FROM (
    SELECT {g}count(*) AS n, CAST(sum(x) AS HUGEINT) AS sx, CAST(sum(y) AS HUGEINT) AS sy,
           CAST(sum(CAST(x AS HUGEINT) * y) AS HUGEINT) AS sxy, CAST(sum(CAST(x AS HUGEINT) * x) AS HUGEINT) AS sxx
    FROM {source} {gb}
  ) WHERE n > 0
)"""


def soft(c: str, a: float) -> str:
    return f"sign({c}) * greatest(abs({c}) - {a!r}, 0.0)"


SLOPES = {
    "lr": "CASE WHEN var_x <> 0 THEN cov_xy / var_x END",
    "lasso": f"CASE WHEN var_x <> 0 THEN {soft('cov_xy', 1.0)} / var_x ELSE 0.0 END",
    "ridge": "cov_xy / (var_x + 1.0 / CAST(n AS DOUBLE))",
    "en": f"{soft('cov_xy', 0.5)} / (var_x + 0.5)",
}


TRAIN_CTE = "train AS (SELECT * FROM xy WHERE split = 'train')"
for _name, _kind in (("linear_fit", "lr"), ("lasso_fit", "lasso"), ("ridge_fit", "ridge"), ("elastic_net_fit", "en")):
    ORACLE[_name] = (
        "WITH " + XY_CTE.strip() + ",\n" + TRAIN_CTE + ",\n" + stats_cte("st", "train").strip() + "\n"
        f"SELECT '{_kind}' AS model, n, round({SLOPES[_kind]}, 6) AS slope, "
        f"round(mean_y - ({SLOPES[_kind]}) * mean_x, 6) AS intercept FROM st"
    )

_mse_parts = "\nUNION ALL\n".join(
    f"SELECT '{k}' AS regressor, CAST(t.y AS DOUBLE) AS y, (s.mean_y - ({SLOPES[k]}) * s.mean_x) + ({SLOPES[k]}) * t.x AS p "
    f"FROM test t, st s" for k in ("lr", "en", "lasso", "ridge")
)
REGRESSOR_MSE_CTE = f"""
mse AS (
  SELECT regressor, count(p - y) AS n, avg((p - y) * (p - y)) AS mse FROM (
{_mse_parts}
  ) GROUP BY regressor
)"""
_MSE = ("WITH " + XY_CTE.strip() + ",\n" + TRAIN_CTE + ",\ntest AS (SELECT * FROM xy WHERE split = 'test'),\n"
        + stats_cte("st", "train").strip() + ",\n" + REGRESSOR_MSE_CTE.strip() + "\n")
ORACLE["regressor_mse"] = _MSE + "SELECT regressor, n, round(mse, 6) AS mse FROM mse"


def _halved(level: int) -> str:
    """The nodes of the next level: each node's values, cut where the squared error falls most."""
    return f"""sums{level} AS (
  SELECT node, x, n, s, sum(n) OVER left_of AS nl, sum(s) OVER left_of AS sl, sum(n) OVER (PARTITION BY node) AS nt,
         sum(s) OVER (PARTITION BY node) AS st, lead(x) OVER (PARTITION BY node ORDER BY x) AS next_x
  FROM level{level} WINDOW left_of AS (PARTITION BY node ORDER BY x)
),
cuts{level} AS (
  SELECT node, arg_max((x + next_x) / 2, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt) AS cut
  FROM sums{level} WHERE next_x IS NOT NULL GROUP BY node
),
level{level + 1} AS (SELECT 2 * node + CASE WHEN x > cut THEN 1 ELSE 0 END AS node, x, n, s FROM level{level} LEFT JOIN cuts{level} USING (node))"""


ORACLE["exact_tree_fit"] = f"""
WITH {XY_CTE.strip()},
level0 AS (SELECT 0 AS node, CAST(x AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS s FROM xy WHERE split = 'train' GROUP BY x),
{_halved(0)},
{_halved(1)},
points AS (SELECT CAST(x AS DOUBLE) AS x, count(*) AS n FROM xy WHERE split = 'test' GROUP BY x),
leaves AS (SELECT node, sum(s) / sum(n) AS value FROM level2 GROUP BY node),
placed AS (
  SELECT p.x, p.n, 2 * (CASE WHEN p.x > c0.cut THEN 1 ELSE 0 END) + CASE WHEN p.x > c1.cut THEN 1 ELSE 0 END AS node
  FROM points p, cuts0 c0, cuts1 c1 WHERE c1.node = CASE WHEN p.x > c0.cut THEN 1 ELSE 0 END
),
nearest AS (
  SELECT p.x, arg_min(t.s / t.n, (abs(t.x - p.x), t.x)) AS full_tree FROM points p, level0 t GROUP BY p.x
)
SELECT x, n, round(full_tree, 6) AS full_tree, round(value, 6) AS two_levels
FROM placed JOIN leaves USING (node) JOIN nearest USING (x)"""
ORACLE["per_group_fit"] = (
    "WITH " + XY_CTE.strip() + ",\n" + stats_cte("st", "xy", "l_suppkey").strip() + "\n" +
    "\nUNION ALL\n".join(
        f"SELECT l_suppkey, '{k}' AS model, n, round({SLOPES[k]}, 6) AS slope, "
        f"round(mean_y - ({SLOPES[k]}) * mean_x, 6) AS intercept FROM st" for k in ("lr", "ridge")
    )
)
ORACLE["fixed_width_report"] = _MSE + """
SELECT 0 AS line_no, rpad('Regressor', 20, ' ') || ' ' || rpad('MSE', 20, ' ') AS line
UNION ALL SELECT 1, repeat('=', 60)
UNION ALL
SELECT CAST(list_position(['lr', 'en', 'lasso', 'ridge'], regressor) + 2 AS INTEGER),
       CASE WHEN length(regressor) >= 20 THEN regressor ELSE rpad(regressor, 20, ' ') END || ' ' ||
       CASE WHEN length(printf('%.5f', mse)) >= 20 THEN printf('%.5f', mse) ELSE rpad(printf('%.5f', mse), 20, ' ') END
FROM mse"""
ORACLE["top_n_importance"] = """
WITH p AS (SELECT p_brand, CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part),
share AS (SELECT p_brand AS feature, round(CAST(sum(cents) AS DOUBLE) / CAST((SELECT sum(cents) FROM p) AS DOUBLE), 6) AS importance
          FROM p GROUP BY p_brand)
SELECT feature, importance FROM share WHERE importance > 0 ORDER BY importance DESC, feature ASC LIMIT 15"""

# ------------------------------------------------ catalogue, landing, html
LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ORACLE["column_catalog"] = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS ordinal, '{c}' AS name, any_value(typeof({c})) AS type, count({c}) AS non_null, "
    f"count(*) - count({c}) AS nulls FROM lineitem"
    for i, c in enumerate(LINEITEM_COLS)
)
DAY = "CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"
ORACLE["landed_anti_join"] = f"""
SELECT o_orderkey, o_totalprice, {DAY.format(c='o_orderdate')} AS day FROM orders
WHERE {DAY.format(c='o_orderdate')} NOT IN (SELECT {DAY.format(c='l_shipdate')} FROM lineitem)"""
_clean = (
    "trim(replace(replace(replace(replace(replace(replace("
    "regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), "
    "'&nbsp;', ' '), '&amp;', '&'))"
)
ORACLE["html_rows"] = f"""
WITH blocks AS (
  SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul(?:\\s[^>]*)?>(.*?)</ul>', 1),
                                     '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1) AS rs
  FROM pages
),
r AS (SELECT page_id, unnest(rs) AS r, generate_subscripts(rs, 1) - 1 AS row_index FROM blocks),
c AS (
  SELECT page_id, row_index,
         list_transform(regexp_extract_all(r, '(?s)<a(?:\\s[^>]*)?>(.*?)</a>', 1), lambda x: {_clean}) AS cells
  FROM r
),
d AS (SELECT page_id, cells, CAST(min(row_index) AS INTEGER) AS row_index FROM c GROUP BY page_id, cells)
SELECT page_id, row_index, CAST(len(cells) AS INTEGER) AS n_cells, array_to_string(cells, '|') AS text FROM d"""


# ---------------------------------------------------------------------- knn
# evidence maximisation on the centred sums, one row per round
ORACLE["bayesian_ridge_fit"] = f"""
WITH RECURSIVE {XY_CTE.strip()},
{TRAIN_CTE},
raw AS (
  SELECT count(*) AS n, CAST(sum(x) AS HUGEINT) AS sx, CAST(sum(y) AS HUGEINT) AS sy,
         CAST(sum(CAST(x AS HUGEINT) * y) AS HUGEINT) AS sxy, CAST(sum(CAST(x AS HUGEINT) * x) AS HUGEINT) AS sxx,
         CAST(sum(CAST(y AS HUGEINT) * y) AS HUGEINT) AS syy
  FROM train
),
st AS (
  SELECT CAST(n AS DOUBLE) AS n, CAST(sx AS DOUBLE) / n AS mx, CAST(sy AS DOUBLE) / n AS my,
         CAST(n * sxx - sx * sx AS DOUBLE) / n AS cxx, CAST(n * sxy - sx * sy AS DOUBLE) / n AS cxy,
         CAST(n * syy - sy * sy AS DOUBLE) / n AS cyy
  FROM raw WHERE n > 0
),
rounds AS (
  SELECT 0 AS i, 1.0 / (cyy / n + 2.220446049250313e-16) AS alpha, CAST(1.0 AS DOUBLE) AS lam,
         CAST(NULL AS DOUBLE) AS coef, false AS done
  FROM st
  UNION ALL
  SELECT i + 1, (n - gamma + 2e-6) / (cyy - 2 * c * cxy + c * c * cxx + 2e-6), (gamma + 2e-6) / (c * c + 2e-6),
         c, coef IS NOT NULL AND abs(coef - c) < 1e-3
  FROM (
    SELECT r.i, r.coef, st.*, cxy / (cxx + r.lam / r.alpha) AS c, r.alpha * cxx / (r.lam + r.alpha * cxx) AS gamma
    FROM rounds r CROSS JOIN st WHERE NOT r.done AND r.i < 300
  )
),
last AS (SELECT * FROM rounds ORDER BY i DESC LIMIT 1),
fitted AS (SELECT cxy / (cxx + lam / alpha) AS slope, mx, my FROM last CROSS JOIN st)
SELECT 'bayesianridge' AS model, round(slope, 6) AS slope, round(my - slope * mx, 6) AS intercept FROM fitted"""

ORACLE["knn_fit"] = f"""
WITH part_xy AS (
  SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, CAST(round(p_retailprice * 100) AS BIGINT) AS y,
         CASE WHEN {BUCKET.format(k='p_partkey')} % 100 < 20 THEN 'test' ELSE 'train' END AS split
  FROM part
),
train AS (SELECT p_partkey, x, y, row_number() OVER (ORDER BY x, p_partkey) - 1 AS rnk FROM part_xy WHERE split = 'train'),
test AS (SELECT p_partkey, x, y FROM part_xy WHERE split = 'test'),
ins AS (SELECT t.p_partkey, count(tr.p_partkey) AS p FROM test t LEFT JOIN train tr ON tr.x <= t.x GROUP BY t.p_partkey),
pairs AS (
  SELECT t.p_partkey, t.x, tr.y AS n_y,
         row_number() OVER (PARTITION BY t.p_partkey ORDER BY abs(tr.x - t.x),
            CASE WHEN tr.rnk < i.p THEN i.p - 1 - tr.rnk ELSE tr.rnk - i.p END, tr.x, tr.p_partkey) AS nn
  FROM test t JOIN ins i ON t.p_partkey = i.p_partkey, train tr
)
SELECT p.p_partkey, any_value(p.x) AS x, round(avg(p.n_y), 6) AS prediction, count(*) AS neighbours,
       any_value(t.y) AS actual
FROM pairs p JOIN test t ON p.p_partkey = t.p_partkey
WHERE p.nn <= 5 GROUP BY p.p_partkey"""


# ---------------------------------------------------------------- diagnostics
_trace_rows = "\nUNION ALL\n".join(
    f"SELECT r.season, r.week, r.team, '{f}' AS feature, p.{f} AS prior, r.rolling_{f} AS rolling, "
    f"CAST(4 - r.week AS DOUBLE) / 3 AS wp FROM roll r JOIN prior p ON r.season = p.season AND r.team = p.team "
    f"WHERE r.team = '7' AND r.week IN (1, 2, 3)"
    for f in FEATURES
)
ORACLE["blend_trace"] = with_ctes(*_TWS, MEANS_CTE, prior_cte(2), ROLL_CTE) + f"""
SELECT season, week, team, feature, round(prior, 6) AS prior, round(rolling, 6) AS rolling,
       round(wp, 6) AS weight_prior, round(1 - wp, 6) AS weight_current,
       round(wp * prior + (1 - wp) * rolling, 6) AS blended
FROM ({_trace_rows})"""
ORACLE["rolling_event_values"] = """
SELECT event_id, user_id, ts, value,
       round(CASE WHEN count(value) OVER w = 3 THEN avg(value) OVER w END, 6) AS value_last3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""
