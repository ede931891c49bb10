"""Per-player season averages (B4: J1, J2, C16-C24, A1-A9) and as-of trailing features.

Plan shape: scan -> (dimension joins, sized by the planner/AQE) -> projection of the
conditional columns -> partial hash aggregate -> one exchange on the group key ->
final aggregate -> projection.  Every per-row expression is a native Spark expression.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from . import seasons as S

GROUP_KEYS = ("SEASON_TYPE", "PLAYER_ID", "PLAYER", "SEASON_KEY", "TEAM_ABBREVIATION")


def _as_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


# Size bound (bytes, as estimated by the optimizer) under which a dimension is broadcast.  A scan's
# estimate is its compressed file size; dictionary-coded text may take some ten times that in
# memory, so the bound is a tenth of what an executor can well spare.
DIM_BROADCAST_BYTES = 4 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate: for a scan the (compressed) file size, above it grown by
    joins (the product of the sides) and never shrunk by filters without statistics."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no JVM handle (e.g. a Connect session): size unknown
        return 1 << 62


def sized_broadcast(dim: DataFrame, max_bytes: int = DIM_BROADCAST_BYTES) -> DataFrame:
    """Broadcast a dimension only when its size is known to be small; otherwise leave the join
    to the planner and AQE (shuffle join, converted at runtime if the side turns out small)."""
    return F.broadcast(dim) if estimated_bytes(dim) <= max_bytes else dim


def canonical_names(logs: DataFrame, dim_players: DataFrame) -> DataFrame:
    """Replace the log's own PLAYER with the dimension's PLAYER_NAME (left join on PLAYER_ID)."""
    dim = sized_broadcast(dim_players.select("PLAYER_ID", F.col("PLAYER_NAME").alias("PLAYER")))
    base = logs.drop("PLAYER") if "PLAYER" in logs.columns else logs
    return base.join(dim, "PLAYER_ID", "left")


def team_abbreviations(logs: DataFrame, map_teams: DataFrame) -> DataFrame:
    """Attach TEAM_ABBREVIATION by raw team text (left join; duplicate map keys fan out, as in the reference)."""
    m = sized_broadcast(map_teams.select(F.col("RAW_TEAM_NAME").alias("TEAM"), "TEAM_ABBREVIATION"))
    return logs.join(m, "TEAM", "left")


def in_window(as_of, window_days: int = 30) -> Column:
    return F.col("DATE") >= F.date_sub(_as_date(as_of), window_days)


def starter_values() -> list[Column]:
    """A game's points per minute, and its values where the player started."""
    started = F.col("STARTED") == F.lit("Y")
    fppm = C.safe_ratio("DK_POINTS", "MINUTES")
    return [fppm.alias("GAME_FPPM"),
            F.when(started, F.col("DK_POINTS")).alias("GS_DK_POINTS"),
            F.when(started, F.col("MINUTES")).alias("GS_MINUTES"),
            F.when(started, fppm).alias("GS_GAME_FPPM")]


def window_values(as_of, window_days: int = 30) -> list[Column]:
    """A game's values where it lies in the trailing window."""
    recent = in_window(as_of, window_days)
    return [F.when(recent, F.col("DK_POINTS")).alias("L30_DK_POINTS"),
            F.when(recent, F.col("MINUTES")).alias("L30_MINUTES")]


def game_columns(df: DataFrame, as_of, window_days: int = 30) -> DataFrame:
    """Per-game conditional columns feeding the aggregate."""
    return df.select(*GROUP_KEYS, "DATE", "STARTED", "DK_SALARY", "DK_POINTS", "MINUTES", "USAGE",
                     *starter_values(), *window_values(as_of, window_days))


# Sums and means accumulate in DECIMAL(38,9): addition is then exact and associative, so the
# result does not depend on how rows were partitioned or in which order partial sums merged
# (a double sum can differ in its last bit between runs and flip a half-way rounding).
EXACT = "decimal(38,9)"


def exact_sum(c: str) -> Column:
    """Order-independent sum as double (NULL when there is no non-null value)."""
    return F.sum(F.col(c).cast(EXACT)).cast("double")


def exact_avg(c: str) -> Column:
    """Mean of the non-null values from the exact sum (NULL when there are none)."""
    return F.try_divide(exact_sum(c), F.count(c).cast("double"))


def _sum0(c: str) -> Column:
    return F.coalesce(exact_sum(c), F.lit(0.0))


def raw_aggregates(games: DataFrame) -> DataFrame:
    """One groupBy, 20 aggregates, then the ratio-of-sums columns."""
    agg = games.groupBy(*GROUP_KEYS).agg(
        F.count("DATE").alias("GP"),
        F.count(F.when(F.col("STARTED") == F.lit("Y"), F.lit(1))).alias("GS"),
        exact_avg("DK_SALARY").alias("SALPG"),
        exact_avg("DK_POINTS").alias("FPPG"),
        F.stddev_samp("DK_POINTS").alias("STDV_FPPG"),
        _sum0("DK_POINTS").alias("DK_POINTS_sum"),
        exact_avg("MINUTES").alias("MPG"),
        F.stddev_samp("MINUTES").alias("STDV_MPG"),
        _sum0("MINUTES").alias("MINUTES_sum"),
        F.stddev_samp("GAME_FPPM").alias("STDV_FPPM"),
        exact_avg("USAGE").alias("USG"),
        exact_avg("GS_DK_POINTS").alias("GSFPPG"),
        F.stddev_samp("GS_DK_POINTS").alias("STDV_GSFPPG"),
        _sum0("GS_DK_POINTS").alias("GS_DK_POINTS_sum"),
        exact_avg("GS_MINUTES").alias("GSMPG"),
        F.stddev_samp("GS_MINUTES").alias("STDV_GSMPG"),
        _sum0("GS_MINUTES").alias("GS_MINUTES_sum"),
        F.stddev_samp("GS_GAME_FPPM").alias("STDV_GSFPPM"),
        _sum0("L30_DK_POINTS").alias("L30_DK_POINTS_sum"),
        _sum0("L30_MINUTES").alias("L30_MINUTES_sum"),
    )
    return (agg.withColumn("FPPM", C.safe_ratio("DK_POINTS_sum", "MINUTES_sum"))
               .withColumn("GSFPPM", C.safe_ratio("GS_DK_POINTS_sum", "GS_MINUTES_sum"))
               .withColumn("L30FPPM", C.safe_ratio("L30_DK_POINTS_sum", "L30_MINUTES_sum")))


def finish(agg: DataFrame, fill: bool = True) -> DataFrame:
    """Rename, round half-to-even, fill NULL with 0, cast, fixed column order."""
    out = []
    for name in K.AVERAGES_COLUMNS:
        src = {"SEASON": "SEASON_KEY", "TEAM": "TEAM_ABBREVIATION"}.get(name, name)
        c = F.col(src)
        if name in K.AVERAGES_ROUNDING:
            c = C.round_half_even(c, K.AVERAGES_ROUNDING[name])
        if fill and name not in ("SEASON_TYPE", "PLAYER", "SEASON", "TEAM"):
            c = F.coalesce(c, F.lit(0))
        c = c.cast("long" if name == "PLAYER_ID" else "int") if name in K.AVERAGES_INTEGERS else (
            c.cast("double") if name not in ("SEASON_TYPE", "PLAYER", "SEASON", "TEAM") else c)
        out.append(c.alias(name))
    return agg.select(*out)


def season_averages(logs: DataFrame, dim_players: DataFrame, map_teams: DataFrame, as_of,
                    window_days: int = 30, by_team: bool = True, fill: bool = True) -> DataFrame:
    """The fantasy_averages table; ``by_team=False`` gives players with several teams one row.

    ``logs`` needs PLAYER_ID, DATE (date), SEASON_SEGMENT, TEAM, DK_POINTS, DK_SALARY,
    MINUTES, USAGE, STARTED.  Rows whose season cannot be classified, or whose player
    or team has no dimension row, drop out (NULL group keys), as in the reference.
    """
    if not by_team:
        map_teams = map_teams.select("RAW_TEAM_NAME", F.lit("ALL").alias("TEAM_ABBREVIATION")).distinct()
    df = S.classify_season(team_abbreviations(canonical_names(logs, dim_players), map_teams))
    # Rows with a NULL key (unclassifiable season, unknown player or team) go before the
    # aggregate: the left joins become inner joins, and nothing of them is shuffled.
    games = game_columns(df, as_of, window_days).dropna(subset=list(GROUP_KEYS))
    return finish(raw_aggregates(games), fill=fill)


def known_players(logs: DataFrame, dim_players: DataFrame, map_teams: DataFrame, season_type: str) -> DataFrame:
    """(PLAYER_ID, PLAYER) with averages of a season type, without computing the averages."""
    df = S.classify_season(team_abbreviations(canonical_names(logs, dim_players), map_teams))
    return (df.dropna(subset=list(GROUP_KEYS)).where(F.col("SEASON_TYPE") == season_type)
              .select("PLAYER_ID", "PLAYER").distinct())


def season_averages_by_player(logs: DataFrame, dim_players: DataFrame, map_teams: DataFrame, as_of,
                              window_days: int = 30) -> DataFrame:
    """``by_team=False`` grain: traded players get one row per season, computed from the logs
    (never by averaging the per-team averages)."""
    return season_averages(logs, dim_players, map_teams, as_of, window_days, by_team=False)


def trailing_features(logs: DataFrame, keys: list[str], date_col: str, value_cols: list[str],
                      days: int = 30) -> DataFrame:
    """Per row, the sum / mean / non-null count of each value over the previous ``days``
    days for the same key, excluding the row's own day (no lookahead).

    Scale: rows are first pre-aggregated to one row per (key, day) -- map-side combined --
    so the RANGE window sorts at most one row per key per calendar day even when one key
    holds a third of the data; the features are then joined back on (key, day).
    """
    day = F.datediff(F.col(date_col).cast("date"), F.lit("1970-01-01").cast("date"))
    base = logs.withColumn("_day", day)
    daily = base.groupBy(*keys, "_day").agg(
        *[F.sum(F.col(v).cast(EXACT)).alias(f"_s_{v}") for v in value_cols],
        *[F.count(v).alias(f"_n_{v}") for v in value_cols],
        F.count(F.lit(1)).alias("_rows"))
    w = Window.partitionBy(*keys).orderBy("_day").rangeBetween(-days, -1)
    feats = []
    for v in value_cols:
        s_, n_ = F.sum(f"_s_{v}").over(w).cast("double"), F.sum(f"_n_{v}").over(w)
        feats += [s_.alias(f"{v}_sum_{days}d"),
                  F.try_divide(s_, n_.cast("double")).alias(f"{v}_avg_{days}d")]
    feats.append(F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias(f"games_{days}d"))
    per_day = daily.select(*keys, "_day", *feats)
    return base.join(per_day, [*keys, "_day"], "left").drop("_day")
