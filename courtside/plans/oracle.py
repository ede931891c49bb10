"""SQL (DuckDB dialect) building blocks for the oracle side of every registered query.

These are the same rules as the Spark operators, written independently in SQL so the
driver can check one engine against the other.
"""

from __future__ import annotations

from ..functions import constants as K
from . import fixtures as X


def rnd(expr: str, digits: int) -> str:
    scale = 10 ** digits
    return f"(round_even(({expr}) * {scale}.0, 0) / {scale}.0)"


def safe_ratio(num: str, den: str) -> str:
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 OR ({num}) IS NULL THEN 0.0 "
            f"ELSE CAST({num} AS DOUBLE) / ({den}) END)")


def season_type(seg: str) -> str:
    return (f"(CASE WHEN regexp_matches({seg}, '{K.REGULAR_PATTERN}') THEN 'Regular' "
            f"WHEN regexp_matches({seg}, '{K.PLAYOFFS_PATTERN}') THEN 'Playoffs' END)")


def season_key(seg: str, stype: str) -> str:
    y = f"nullif(regexp_extract({seg}, '(\\d{{4}})', 1), '')"
    return (f"(CASE WHEN {stype} = 'Regular' AND {y} IS NOT NULL "
            f"THEN {y} || '-' || lpad(CAST((CAST({y} AS INTEGER) + 1) % 100 AS VARCHAR), 2, '0') "
            f"WHEN {stype} = 'Playoffs' THEN {y} END)")


def xsum(expr: str) -> str:
    """Exact (DECIMAL) sum returned as double: the twin of ``summary.exact_sum``."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,9))) AS DOUBLE)"


def xavg(expr: str) -> str:
    return f"({xsum(expr)} / count({expr}))"


def averages_ctes(logs: str = "fantasy_logs", as_of: str = X.AS_OF, days: int = 30) -> str:
    """CTEs ending in ``fantasy_averages`` computed from the CTE/view named ``logs``."""
    fppm = safe_ratio("DK_POINTS", "MINUTES")
    outs = []
    for name in K.AVERAGES_COLUMNS:
        src = {"SEASON": "SEASON_KEY", "TEAM": "TEAM_ABBREVIATION"}.get(name, name)
        e = src
        if name in K.AVERAGES_ROUNDING:
            e = rnd(e, K.AVERAGES_ROUNDING[name])
        if name not in ("SEASON_TYPE", "PLAYER", "SEASON", "TEAM"):
            e = f"coalesce({e}, 0)"
            e = f"CAST({e} AS {'BIGINT' if name == 'PLAYER_ID' else 'INTEGER'})" if name in K.AVERAGES_INTEGERS else f"CAST({e} AS DOUBLE)"
        outs.append(f"{e} AS {name}")
    return f"""
avg_j AS (
  SELECT f.* EXCLUDE (PLAYER), d.PLAYER_NAME AS PLAYER, m.TEAM_ABBREVIATION
  FROM {logs} f
  LEFT JOIN dim_players d ON f.PLAYER_ID = d.PLAYER_ID
  LEFT JOIN map_teams m ON f.TEAM = m.RAW_TEAM_NAME
),
avg_t AS (SELECT *, {season_type('SEASON_SEGMENT')} AS SEASON_TYPE FROM avg_j),
avg_k AS (
  SELECT *, {season_key('SEASON_SEGMENT', 'SEASON_TYPE')} AS SEASON_KEY,
         {fppm} AS GAME_FPPM,
         DATE >= DATE '{as_of}' - INTERVAL {days} DAY AS RECENT,
         CASE WHEN STARTED = 'Y' THEN DK_POINTS END AS GS_DK_POINTS,
         CASE WHEN STARTED = 'Y' THEN MINUTES END AS GS_MINUTES,
         CASE WHEN DATE >= DATE '{as_of}' - INTERVAL {days} DAY THEN DK_POINTS END AS L30_DK_POINTS,
         CASE WHEN DATE >= DATE '{as_of}' - INTERVAL {days} DAY THEN MINUTES END AS L30_MINUTES
  FROM avg_t
),
avg_g AS (
  SELECT SEASON_TYPE, PLAYER_ID, PLAYER, SEASON_KEY, TEAM_ABBREVIATION,
    count(DATE) AS GP,
    count(*) FILTER (WHERE STARTED = 'Y') AS GS,
    {xavg('DK_SALARY')} AS SALPG,
    {xavg('DK_POINTS')} AS FPPG,
    stddev_samp(DK_POINTS) AS STDV_FPPG,
    coalesce({xsum('DK_POINTS')}, 0) AS DK_POINTS_sum,
    {xavg('MINUTES')} AS MPG,
    stddev_samp(MINUTES) AS STDV_MPG,
    coalesce({xsum('MINUTES')}, 0) AS MINUTES_sum,
    stddev_samp(GAME_FPPM) AS STDV_FPPM,
    {xavg('USAGE')} AS USG,
    {xavg('GS_DK_POINTS')} AS GSFPPG,
    stddev_samp(DK_POINTS) FILTER (WHERE STARTED = 'Y') AS STDV_GSFPPG,
    coalesce({xsum('GS_DK_POINTS')}, 0) AS GS_DK_POINTS_sum,
    {xavg('GS_MINUTES')} AS GSMPG,
    stddev_samp(MINUTES) FILTER (WHERE STARTED = 'Y') AS STDV_GSMPG,
    coalesce({xsum('GS_MINUTES')}, 0) AS GS_MINUTES_sum,
    stddev_samp(GAME_FPPM) FILTER (WHERE STARTED = 'Y') AS STDV_GSFPPM,
    coalesce({xsum('L30_DK_POINTS')}, 0) AS L30_DK_POINTS_sum,
    coalesce({xsum('L30_MINUTES')}, 0) AS L30_MINUTES_sum
  FROM avg_k
  WHERE SEASON_TYPE IS NOT NULL AND SEASON_KEY IS NOT NULL AND PLAYER_ID IS NOT NULL
    AND PLAYER IS NOT NULL AND TEAM_ABBREVIATION IS NOT NULL
  GROUP BY ALL
),
avg_r AS (
  SELECT *, {safe_ratio('DK_POINTS_sum', 'MINUTES_sum')} AS FPPM,
            {safe_ratio('GS_DK_POINTS_sum', 'GS_MINUTES_sum')} AS GSFPPM,
            {safe_ratio('L30_DK_POINTS_sum', 'L30_MINUTES_sum')} AS L30FPPM
  FROM avg_g
),
fantasy_averages AS (
  SELECT {', '.join(outs)} FROM avg_r
)"""


def averages_with(logs_cte: str = X.FANTASY_LOGS_SQL) -> str:
    return X.with_(logs_cte, X.DIM_PLAYERS_SQL, X.MAP_TEAMS_SQL, averages_ctes())
