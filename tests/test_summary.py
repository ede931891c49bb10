import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtside.functions import constants as K
from courtside.operators import seasons as S
from courtside.operators import summary as M

LOG_COLS = "PLAYER_ID long, PLAYER string, DATE date, SEASON_SEGMENT string, TEAM string, DK_POINTS double, DK_SALARY double, MINUTES double, STARTED string, USAGE double"
D = dt.date(2025, 11, 1)
BASE = (1, "Raw Name", D, "2024-25 NBA Regular Season", "Boston Celtics", 40.0, 8000.0, 34.0, "Y", 28.0)


def dims(spark):
    dim = spark.createDataFrame([(1, "Canonical Name")], "PLAYER_ID long, PLAYER_NAME string")
    teams = spark.createDataFrame([("Boston Celtics", "BOS")], "RAW_TEAM_NAME string, TEAM_ABBREVIATION string")
    return dim, teams


def averages(spark, rows, as_of="2025-11-15"):
    dim, teams = dims(spark)
    return M.season_averages(spark.createDataFrame(rows, LOG_COLS), dim, teams, as_of)


def test_two_games_one_row(spark):
    r2 = (1, "Raw Name", dt.date(2025, 11, 3), "2024-25 NBA Regular Season", "Boston Celtics", 50.0, 8000.0, 36.0, "Y", 28.0)
    out = averages(spark, [BASE, r2]).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.GP, r.FPPG, r.SEASON, r.TEAM, r.PLAYER) == (2, 45.0, "2024-25", "BOS", "Canonical Name")
    assert r.SALPG == 8000 and r.GS == 2
    assert list(averages(spark, [BASE]).columns) == list(K.AVERAGES_COLUMNS)


def test_regular_and_playoffs(spark):
    p = (1, "Raw Name", dt.date(2025, 5, 1), "2025 NBA Playoffs", "Boston Celtics", 30.0, 8000.0, 30.0, "N", 20.0)
    out = {(r.SEASON_TYPE, r.SEASON) for r in averages(spark, [BASE, p]).collect()}
    assert out == {("Regular", "2024-25"), ("Playoffs", "2025")}


def test_last30_rate_vs_season_rate(spark):
    as_of = dt.date(2025, 11, 15)
    recent = (1, "x", as_of - dt.timedelta(days=10), "2025-26 NBA Regular Season", "Boston Celtics", 60.0, 1.0, 30.0, "Y", 1.0)
    old = (1, "x", as_of - dt.timedelta(days=60), "2025-26 NBA Regular Season", "Boston Celtics", 0.0, 1.0, 30.0, "Y", 1.0)
    r = averages(spark, [recent, old], as_of.isoformat()).collect()[0]
    assert r.L30FPPM == 2.0 and r.FPPM == 1.0


def test_views_split_by_type(spark):
    avg = averages(spark, [BASE])
    assert S.season_type_view(avg, "Regular").count() == 1
    assert S.season_type_view(avg, "Playoffs").count() == 0


def test_unclassifiable_null_and_unknown_keys_drop(spark):
    rows = [BASE,
            (1, "x", D, None, "Boston Celtics", 1.0, 1.0, 1.0, "Y", 1.0),          # NULL segment
            (1, "x", D, "Preseason", "Boston Celtics", 1.0, 1.0, 1.0, "Y", 1.0),   # not a season type
            (1, "x", D, "NBA Regular Season", "Boston Celtics", 1.0, 1.0, 1.0, "Y", 1.0),  # no year
            (2, "x", D, "2024-25 NBA Regular Season", "Boston Celtics", 1.0, 1.0, 1.0, "Y", 1.0),  # unknown player
            (1, "x", D, "2024-25 NBA Regular Season", "Nowhere", 1.0, 1.0, 1.0, "Y", 1.0)]  # unmapped team
    out = averages(spark, rows).collect()
    assert len(out) == 1 and out[0].GP == 1
    bad = {r.SEASON_SEGMENT: r.rows_dropped for r in S.unclassified_segments(spark.createDataFrame(rows, LOG_COLS)).collect()}
    assert bad == {None: 1, "Preseason": 1, "NBA Regular Season": 1}


def test_zero_minutes_single_game_and_fill(spark):
    z = (1, "x", D, "2024-25 NBA Regular Season", "Boston Celtics", 10.0, None, 0.0, None, None)
    r = averages(spark, [z]).collect()[0]
    assert r.FPPM == 0.0 and r.STDV_FPPG == 0.0 and r.SALPG == 0 and r.GS == 0 and r.USG == 0.0
    assert r.GSFPPG == 0.0 and r.GS_DK_POINTS_sum == 0.0


def test_half_even_rounding_matches_numpy(spark):
    from courtside.functions.columns import round_half_even
    vals = [2.675, 0.125, 0.375, 1.005, 2.5, 3.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    import numpy as np
    assert got == [float(np.round(v, 2)) for v in vals]
    got0 = [r[0] for r in df.select(round_half_even("x", 0)).collect()]
    assert got0 == [float(np.round(v, 0)) for v in vals]


def test_season_key_century(spark):
    df = spark.createDataFrame([("1999 NBA Regular Season",), ("2023-24 In-Season Tournament",), ("2024 Play-In",)], "SEASON_SEGMENT string")
    got = [(r.SEASON_TYPE, r.SEASON_KEY) for r in S.classify_season(df).collect()]
    assert got == [("Regular", "1999-00"), ("Regular", "2023-24"), ("Playoffs", "2024")]


def test_trailing_features_exclude_same_day(spark):
    rows = [(1, dt.date(2024, 1, 1), 1.0), (1, dt.date(2024, 1, 1), 3.0), (1, dt.date(2024, 1, 10), 5.0),
            (1, dt.date(2024, 2, 20), 7.0), (2, dt.date(2024, 1, 10), 9.0)]
    df = spark.createDataFrame(rows, "PLAYER_ID long, DATE date, VALUE double")
    out = {(r.PLAYER_ID, r.DATE, r.VALUE): (r.VALUE_sum_30d, r.games_30d)
           for r in M.trailing_features(df, ["PLAYER_ID"], "DATE", ["VALUE"], 30).collect()}
    assert out[(1, dt.date(2024, 1, 1), 1.0)] == (None, 0)
    assert out[(1, dt.date(2024, 1, 10), 5.0)] == (4.0, 2)
    assert out[(1, dt.date(2024, 2, 20), 7.0)] == (None, 0)
    assert out[(2, dt.date(2024, 1, 10), 9.0)] == (None, 0)


def test_plan_has_one_exchange_for_the_aggregate(spark):
    avg = averages(spark, [BASE])
    plan = avg._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_team_map_is_broadcast_not_shuffled(spark):
    from tests.conftest import SF_SMALL
    from courtside.plans import fixtures as X
    avg = M.season_averages(X.fantasy_logs(spark, SF_SMALL), X.dim_players(spark, SF_SMALL),
                            X.map_teams(spark, SF_SMALL), X.AS_OF)
    plan = avg._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(TEAM" not in plan      # no shuffle on the ~30-value team key


def test_trailing_window_runs_on_daily_aggregates(spark):
    df = spark.range(0, 3000).selectExpr("1L AS PLAYER_ID", "date_add(DATE '2024-01-01', CAST(id % 40 AS INT)) AS DATE",
                                         "CAST(id AS DOUBLE) AS VALUE")
    out = M.trailing_features(df, ["PLAYER_ID"], "DATE", ["VALUE"], 30)
    plan = out._jdf.queryExecution().executedPlan().toString()
    window_at = plan.index("Window [")
    assert "HashAggregate" in plan[window_at:]     # the window's input is the per-day aggregate
    assert out.count() == 3000
