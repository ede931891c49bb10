"""Queries that drive whole jobs (B1-B9, M1-M8, T1) over a store of their own.

Each writes feed files or stored tables that derive from the given tables into a new folder of the
shared checkpoint folder, runs the job as a user would, and returns what the job left in the store.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import constants as K
from ..operators import quality as Q
from ..session import checkpoint_dir, discard, stage
from ..streaming import dropfolder as DF
from . import fixtures as X
from . import jobs as J
from . import oracle as O

QUERIES = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str):
    def deco(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return deco


def _folder(spark: SparkSession, kind: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


# --- B1, T1: two cumulative box-score deliveries (S1, S4, S6, K1, K6, C1-C8, D2, J3, J5) ---------

BOX_SQL = X.with_(X.EVENT_LOGS_SQL, f"""
box AS (
  SELECT PLAYER_ID, DATE, _row_no AS GAME_ID, VALUE AS PTS, EVENT_TYPE || ' ' || CAST(PLAYER_ID AS VARCHAR) AS PLAYER,
         CASE WHEN DATE < DATE '{X.FILE1_CUTOFF}' THEN 1 ELSE 2 END AS load_no
  FROM event_logs WHERE EVENT_TYPE <> 'error'
  QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY _row_no) = 1
)""")


def _deliver_box(events: DataFrame, landing: str) -> None:
    """A delivery in as many files as the sort has ranges: by name and row they are in event order."""
    (events.where("EVENT_TYPE <> 'error'").orderBy("_row_no")
     .select(F.col("_row_no").alias("GAME-ID"), F.col("PLAYER_ID").alias("PLAYER-ID"),
             F.concat_ws(" ", "EVENT_TYPE", F.col("PLAYER_ID").cast("string")).alias("PLAYER  FULL NAME"),
             F.date_format("DATE", "yyyy-MM-dd").alias("DATE"), F.col("VALUE").alias("PTS"))
     .write.mode("append").option("header", True).csv(landing))


def _box_store(spark: SparkSession, sf_dir: str, load) -> str:
    """A store after two deliveries: the first days, then all days again."""
    root, landing = _folder(spark, "store"), _folder(spark, "landing")
    events = X.event_logs(spark, sf_dir)
    _deliver_box(events.where(F.col("DATE") < F.lit(X.FILE1_CUTOFF).cast("date")), landing)
    load(root, landing, "r1")
    _deliver_box(events, landing)
    load(root, landing, "r2")
    return root


def _ingest_box(spark: SparkSession):
    return lambda root, landing, run: J.ingest_box_scores(spark, root, landing, run, duplicate_policy="keep_first")


BOX_LOG = ("PLAYER_ID", "DATE", "GAME_ID", "PTS", "PLAYER")


@register("job_box_ingest", BOX_SQL + "SELECT * FROM box")
def q_job_box_ingest(spark, sf_dir):
    """B1: a second, cumulative delivery adds only what the first didn't hold."""
    root = _box_store(spark, sf_dir, _ingest_box(spark))
    return sinks.read_log(spark, root, "player_logs").select(*BOX_LOG, F.col("_load_no").cast("int").alias("load_no"))


@register("job_learned_players", BOX_SQL + """
SELECT PLAYER_ID, PLAYER AS PLAYER_NAME FROM box
QUALIFY row_number() OVER (PARTITION BY PLAYER_ID ORDER BY load_no, GAME_ID) = 1""")
def q_job_learned_players(spark, sf_dir):
    """J5 within B1: the player dimension as the two loads left it."""
    root = _box_store(spark, sf_dir, _ingest_box(spark))
    return sinks.read_log(spark, root, "dim_players").select("PLAYER_ID", "PLAYER_NAME")


@register("job_box_stream", BOX_SQL + "SELECT * EXCLUDE (load_no) FROM box")
def q_job_box_stream(spark, sf_dir):
    """The same two deliveries through the drop-folder stream, drained after each."""
    checkpoint = _folder(spark, "stream")
    root = _box_store(spark, sf_dir, lambda root, landing, run: DF.run_feed_stream(
        spark, landing, root, J.BOX, checkpoint, duplicate_policy="keep_first"))
    return sinks.read_log(spark, root, "player_logs").select(*BOX_LOG)


# --- B2, B9: two fantasy deliveries, each one file as the feed sends them (S2, S7, S8, C2, C8, K7) ----

DFS_SPLIT = "2000-07-01"
DFS_HEADER = ("FEED DATASET", "GAME_ID", "PLAYER_ID", "PLAYER", "DATE", "OWN TEAM", "STARTER (Y/N)", "MINUTES",
              "USAGE RATE", "DRAFTKINGS", "FOR DRAFTKINGS CLASSIC CONTESTS", "FANDUEL", "DRAFTKINGS")
DFS_SQL = X.with_(X.FANTASY_LOGS_SQL, f"""
feed AS (
  SELECT * REPLACE (CASE WHEN LINE_NO < 7 THEN PLAYER_ID END AS PLAYER_ID),
         CASE WHEN DATE < DATE '{DFS_SPLIT}' THEN 1 ELSE 2 END AS load_no
  FROM fantasy_logs
)""")


def _deliver_dfs(logs: DataFrame, landing: str, name: str) -> None:
    """One file: a blank line, the header, a line to be left out, then the games.  Line 7 of an order
    has no player id."""
    cells = [F.col("SEASON_SEGMENT"), F.col("GAME_ID"), F.when(F.col("LINE_NO") < 7, F.col("PLAYER_ID")), F.col("PLAYER"),
             F.date_format("DATE", "MM/dd/yyyy"), F.col("TEAM"), F.col("STARTED"), F.col("MINUTES"), F.col("USAGE"),
             F.lit("PG"), F.col("DK_SALARY"), F.lit("0"), F.col("DK_POINTS")]
    spark, width = logs.sparkSession, len(DFS_HEADER)
    head = [("," * (width - 1),), (",".join(DFS_HEADER),), (",".join(["-"] * width),)]
    lines = spark.createDataFrame([(i, 0, 0.0, *line) for i, line in enumerate(head, -len(head))],
                                  "a long, b long, c double, value string")
    games = logs.select(F.col("GAME_ID").alias("a"), F.col("LINE_NO").cast("long").alias("b"), F.col("DK_POINTS").alias("c"),
                        F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]).alias("value"))
    sinks.write_single(lines.unionByName(games).orderBy("a", "b", "c").select("value"), "text", landing, name)


def _dfs_landing(spark: SparkSession, logs: DataFrame) -> str:
    landing = _folder(spark, "landing")
    late = F.col("DATE") >= F.lit(DFS_SPLIT).cast("date")
    logs = stage(logs)   # read by both files' sorts, each of which reads twice
    _deliver_dfs(logs.where(~late), landing, "dfs_1.csv")
    _deliver_dfs(logs.where(late), landing, "dfs_2.csv")
    discard(logs)
    return landing


DFS_LOG = ("PLAYER_ID", "DATE", "GAME_ID", "SEASON_SEGMENT", "TEAM", "STARTED", "DK_POINTS", "DK_SALARY")


@register("job_fantasy_ingest", DFS_SQL + f"""
SELECT {', '.join(DFS_LOG)} FROM feed WHERE PLAYER_ID IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY load_no, GAME_ID, LINE_NO, DK_POINTS) = 1""")
def q_job_fantasy_ingest(spark, sf_dir):
    """B2: two files of the fantasy feed, rows without a player id left out."""
    root = _folder(spark, "store")
    J.ingest_fantasy_logs(spark, root, _dfs_landing(spark, X.fantasy_logs(spark, sf_dir)), "r1", duplicate_policy="keep_first")
    return sinks.read_log(spark, root, "fantasy_logs").select(*DFS_LOG)


@register("job_daily_summary", X.with_(X.FANTASY_LOGS_SQL, X.EVENT_LOGS_SQL, """
games AS (SELECT * FROM fantasy_logs QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY GAME_ID, LINE_NO, DK_POINTS) = 1)""", """
box AS (SELECT PLAYER_ID, DATE FROM event_logs WHERE EVENT_TYPE = 'purchase' GROUP BY ALL HAVING count(*) > 1)""") + """
SELECT 'r1' AS run_id, CAST(2 AS BIGINT) AS files_processed, CAST(0 AS BIGINT) AS files_overwritten,
       (SELECT count(*) FROM games WHERE LINE_NO >= 7) AS fantasy_rows_dropped, CAST(0 AS BIGINT) AS absence_rows_inserted,
       'box_scores: box.csv: ' || (SELECT count(*) FROM box) || ' keys occur more than once' AS errors""")
def q_job_daily_summary(spark, sf_dir):
    """A daily run with two good fantasy files, a box file that repeats keys (D3: rejected and
    told, K6), and no entries file (S7)."""
    root, landing = _folder(spark, "store"), _folder(spark, "landing")
    sinks.publish(X.map_teams(spark, sf_dir), root, "map_teams", "r0")
    box = X.event_logs(spark, sf_dir).where("EVENT_TYPE = 'purchase'").orderBy("_row_no").select(
        F.col("_row_no").alias("GAME-ID"), F.col("PLAYER_ID").alias("PLAYER-ID"), F.col("PLAYER_ID").alias("PLAYER  FULL NAME"),
        F.date_format("DATE", "yyyy-MM-dd").alias("DATE"), F.col("VALUE").alias("PTS"))
    sinks.write_single(box, "csv", landing, "box.csv", header=True)
    games = Q.first_by_key(X.fantasy_logs(spark, sf_dir), ["PLAYER_ID", "DATE"], ["GAME_ID", "LINE_NO", "DK_POINTS"])
    J.run_daily(spark, root, landing, _dfs_landing(spark, games), f"{root}/entries.csv", X.AS_OF, "r1",
                now=_dt.datetime(2001, 8, 1))
    return sinks.read_log(spark, root, "run_summary").withColumn("errors", F.concat_ws("; ", "errors")).drop("warnings")


# --- B5: lasting views (K3) -------------------------------------------------------------------

def _averages_store(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    root = _folder(spark, "store")
    sinks.append_log(X.dim_players(spark, sf_dir), root, "dim_players")
    sinks.publish(X.map_teams(spark, sf_dir), root, "map_teams", "r1")
    sinks.append_log(X.fantasy_logs(spark, sf_dir).withColumn("_load_no", F.lit(1).cast("long")), root, "fantasy_logs")
    return root, J.build_fantasy_averages(spark, root, X.AS_OF, "r1")


@register("job_average_views", O.averages_with() + """
SELECT CASE SEASON_TYPE WHEN 'Regular' THEN 'vw_player_averages_regular_season'
            ELSE 'vw_player_averages_playoffs' END AS view_name, * FROM fantasy_averages""")
def q_job_average_views(spark, sf_dir):
    """Averages built in a store, read back through the two views over them."""
    root, averages = _averages_store(spark, sf_dir)
    made = J.publish_average_views(spark, averages, None, _dt.datetime(2001, 8, 1), root)
    first, second = [spark.table(v).withColumn("view_name", F.lit(v)) for v in made]
    return first.unionByName(second)


# --- B6, B7, B8: the slate's views and exports (S5, C28, J6, J7, K3, K4, O1) ------------------------

SLATE_SEASONS = ("2000-01", "2001-02")
L30_SEASON = "2001-02"
PLAYOFF_SEASON = "2001"
SLATE_SQL = O.averages_with() + ", " + X.TYPED_SLATE_SQL.strip() + """,
on_slate AS (SELECT * RENAME (STDV_FPPG AS STDV) FROM fantasy_averages WHERE PLAYER IN (SELECT stored FROM typed_slate))"""


def _slate_store(spark: SparkSession, sf_dir: str) -> tuple[str, J.SlateResult]:
    """A store after the slate job over an entries file as it is downloaded: lines of another table first."""
    root, averages = _averages_store(spark, sf_dir)
    head = spark.createDataFrame([(0, "Entry ID,Contest Name"), (1, "1,Evening"), (2, "Position,Name + ID,Name,ID")], "a int, value string")
    entries = X.typed_slate(spark, sf_dir).select(F.lit(3).alias("a"), F.concat(F.lit("PG,"), "Name", F.lit(" (1),"), "Name", F.lit(",1")).alias("value"))
    path = sinks.write_single(head.unionByName(entries).orderBy("a", "value").select("value"), "text", root, "entries.csv")
    return root, J.build_slates(spark, root, path, averages, "2001-08-01", f"{root}/exports", _dt.datetime(2001, 8, 1),
                                SLATE_SEASONS, L30_SEASON, PLAYOFF_SEASON)


@register("job_slate_views", SLATE_SQL + f"""
SELECT 'vw_daily_slate' AS view_name, {', '.join(K.SLATE_COLUMNS)} FROM on_slate
WHERE SEASON_TYPE = 'Regular' AND SEASON IN {SLATE_SEASONS}
UNION ALL SELECT 'vw_daily_slate_playoffs', {', '.join(K.SLATE_COLUMNS)} FROM on_slate
WHERE SEASON_TYPE = 'Playoffs' AND SEASON = '{PLAYOFF_SEASON}'""")
def q_job_slate_views(spark, sf_dir):
    """The slate's lasting views, through header detection and name matching."""
    _slate_store(spark, sf_dir)
    daily, playoffs = [spark.table(v).withColumn("view_name", F.lit(v)) for v in ("vw_daily_slate", "vw_daily_slate_playoffs")]
    return daily.unionByName(playoffs)


@register("job_slate_exports", SLATE_SQL + f"""
SELECT 'slate_player_averages' AS export, {', '.join(K.SLATE_COLUMNS)}, NULL AS L30FPPM FROM on_slate
WHERE SEASON_TYPE = 'Regular' AND SEASON IN {SLATE_SEASONS}
UNION ALL SELECT 'slate_player_averages_l30', {', '.join(K.SLATE_L30_CSV_COLUMNS)} FROM on_slate
WHERE SEASON_TYPE = 'Regular' AND SEASON = '{L30_SEASON}'""")
def q_job_slate_exports(spark, sf_dir):
    """The two CSV files of the slate, read back."""
    _, made = _slate_store(spark, sf_dir)
    types = {f.name: f.dataType.simpleString() for f in spark.table("vw_daily_slate_l30").schema.fields}
    out = []
    for path, columns in zip(made.exported, (K.SLATE_COLUMNS, K.SLATE_L30_CSV_COLUMNS)):
        schema = ", ".join(f"{c} {types[c]}" for c in columns)
        out.append(spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
                   .withColumn("export", F.lit(path.rpartition("/")[2].removesuffix("_08-01-2001_000000.csv"))))
    return out[0].unionByName(out[1], allowMissingColumns=True)


# --- B3: two cumulative absence sheets against stored box scores (S3, C9, C14, C15, D4, J3, J4) ------

ABSENCE_HEADER = ("GAME DATE", "GAME-ID", "TEAM", "OPPONENT", "PLAYER-ID", "PLAYER NAME", "STATUS", "REASON")


def _absence_sheet(events: DataFrame, name: str) -> DataFrame:
    """The absence sheet of a parsed workbook."""
    n = F.col("_row_no")
    reason = F.when(n % 3 == 0, F.lit("Coach's Decision ")).when(n % 3 == 1, F.lit("Rest"))
    cells = [F.date_format("DATE", "yyyy-MM-dd"), n.cast("string"), F.lit("T"), F.lit("O"), F.col("PLAYER_ID").cast("string"),
             F.concat(F.lit("Player "), F.col("PLAYER_ID").cast("string")), F.lit("DNP"), reason]
    header = events.sparkSession.createDataFrame([(0, list(ABSENCE_HEADER))], "_row_no int, cells array<string>")
    rows = events.where("EVENT_TYPE = 'error'").select((n + 1).cast("int").alias("_row_no"), F.array(*cells).alias("cells"))
    return header.unionByName(rows).select(F.lit(name).alias("_file_name"), F.lit(K.ABSENCE_SHEET).alias("_sheet"),
                                           F.lit(1).alias("_sheet_no"), "_row_no", "cells")


@register("job_absence_ingest", X.with_(X.EVENT_LOGS_SQL, f"""
free AS (
  SELECT * FROM event_logs WHERE EVENT_TYPE = 'error'
  AND (PLAYER_ID, DATE) NOT IN (SELECT (PLAYER_ID, DATE) FROM event_logs WHERE EVENT_TYPE = 'purchase')
  QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY _row_no) = 1
)""") + f"""
SELECT DATE, _row_no AS GAME_ID, 'T' AS TEAM, 'O' AS OPPONENT, PLAYER_ID, 'Player ' || CAST(PLAYER_ID AS VARCHAR) AS PLAYER,
       'DNP' AS STATUS, CASE _row_no % 3 WHEN 0 THEN 'Coach''s Decision ' WHEN 1 THEN 'Rest' END AS REASON,
       CASE _row_no % 3 WHEN 0 THEN 'DNP-CD' ELSE 'INJURY/ILLNESS/OTHER' END AS ABSENCE_TYPE,
       CASE WHEN DATE < DATE '{X.FILE1_CUTOFF}' THEN 1 ELSE 2 END AS load_no
FROM free""")
def q_job_absence_ingest(spark, sf_dir):
    """A second, cumulative sheet adds only what is neither stored nor played."""
    root, events = _folder(spark, "store"), X.event_logs(spark, sf_dir)
    sinks.append_log(events.where("EVENT_TYPE = 'purchase'").select("PLAYER_ID", "DATE"), root, "player_logs")
    first = events.where(F.col("DATE") < F.lit(X.FILE1_CUTOFF).cast("date"))
    for load_no, (part, name) in enumerate(((first, "a.xlsx"), (events, "b.xlsx")), 1):
        J.ingest_absences(spark, root, stage(_absence_sheet(part, name)), [name], load_no)
    return sinks.read_log(spark, root, "player_absences").select(*K.ABSENCE_COLUMNS, F.col("_load_no").cast("int").alias("load_no"))


# --- M8: the team dimension from the logs (A13, C27, U3) ------------------------------------------

@register("job_seed_teams", X.with_(X.FANTASY_LOGS_SQL) + """
SELECT DISTINCT n.n_name AS RAW_TEAM_NAME, r.r_name AS TEAM_ABBREVIATION
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE n.n_name IN (SELECT TEAM FROM fantasy_logs)""")
def q_job_seed_teams(spark, sf_dir):
    """M8 over a store with a fantasy log."""
    root, n, r = _folder(spark, "store"), X.table(spark, sf_dir, "nation"), X.table(spark, sf_dir, "region")
    sinks.append_log(X.fantasy_logs(spark, sf_dir), root, "fantasy_logs")
    spellings = n.join(r, n.n_regionkey == r.r_regionkey).select(F.lower("n_name").alias("SPELLING"), F.col("r_name").alias("TEAM_ABBREVIATION"))
    J.seed_map_teams(spark, root, "r1", spellings=spellings)
    return sinks.read_table(spark, root, "map_teams")


# --- M1, M2: audit and repair of stored logs -----------------------------------------------------

LOG_OF_EVENT = {"purchase": "player_logs", "error": "player_absences", "view": "fantasy_logs"}
COPIES_SQL = X.with_(X.EVENT_LOGS_SQL, f"""
stored AS (
  SELECT CASE EVENT_TYPE {' '.join(f"WHEN '{e}' THEN '{t}'" for e, t in LOG_OF_EVENT.items())} END AS table_name,
         PLAYER_ID, DATE, CAST(round(VALUE) AS BIGINT) AS PTS, 3 - _row_no % 3 AS load_no, _row_no AS row_no
  FROM event_logs
)""")


def _store_with_copies(spark: SparkSession, sf_dir: str) -> str:
    root, events = _folder(spark, "store"), X.event_logs(spark, sf_dir)
    for kind, log in LOG_OF_EVENT.items():
        rows = events.where(F.col("EVENT_TYPE") == kind).select(
            "PLAYER_ID", "DATE", F.round("VALUE").cast("long").alias("PTS"), (3 - F.col("_row_no") % 3).alias("_load_no"),
            F.lit("feed.csv").alias("_file_name"), "_row_no")
        sinks.append_log(rows, root, log)
    return root


@register("job_duplicate_audit", COPIES_SQL + """,
variants AS (SELECT table_name, PLAYER_ID, DATE, PTS, count(*) AS m FROM stored WHERE table_name IS NOT NULL GROUP BY ALL),
keys AS (SELECT table_name, PLAYER_ID, DATE, sum(m) AS copies, count(*) AS variants FROM variants GROUP BY ALL)
SELECT table_name, CAST(sum(copies) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
       CAST(sum(variants) AS BIGINT) AS distinct_full_rows, CAST(sum(copies) - count(*) AS BIGINT) AS extra_rows,
       count(*) FILTER (WHERE copies > 1 AND variants = 1) AS keys_of_exact_copies,
       count(*) FILTER (WHERE copies > 1 AND variants > 1) AS keys_of_differing_copies
FROM keys GROUP BY table_name""")
def q_job_duplicate_audit(spark, sf_dir):
    """M1 over the three logs."""
    return J.duplicate_audit(spark, _store_with_copies(spark, sf_dir))[0]


@register("job_duplicate_repair", COPIES_SQL + """
SELECT table_name, PLAYER_ID, DATE, PTS, load_no, row_no FROM stored WHERE table_name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY table_name, PLAYER_ID, DATE ORDER BY load_no, row_no) = 1""")
def q_job_duplicate_repair(spark, sf_dir):
    """M2 over the three logs: what they hold afterwards."""
    root = _store_with_copies(spark, sf_dir)
    J.duplicate_repair(spark, root, "r1")
    out = None
    for log in LOG_OF_EVENT.values():
        rows = sinks.read_log(spark, root, log).select(
            F.lit(log).alias("table_name"), "PLAYER_ID", "DATE", "PTS", F.col("_load_no").alias("load_no"),
            F.col("_row_no").alias("row_no"))
        out = rows if out is None else out.unionByName(rows)
    return out


# --- M4, M5, A17, A18: name corrections over a store -----------------------------------------------

SUPPLIER_FIXES = {"Supplier#000000002": "Second Supplier", "supplier#000000002": "Second Supplier",
                  "Supplier#000000005": "Fifth Supplier", "supplier#000000007": "Seventh Supplier"}
NAMED_SQL = X.with_(X.FANTASY_LOGS_SQL, X.DIM_PLAYERS_SQL, f"""
fixes AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in SUPPLIER_FIXES.items())}) t(FROM_NAME, TO_NAME))""", """
named AS (
  SELECT 'fantasy_logs' AS table_name, PLAYER AS NAME FROM fantasy_logs
  UNION ALL SELECT 'dim_players', PLAYER_NAME FROM dim_players
)""")


def _named_store(spark: SparkSession, sf_dir: str) -> str:
    root = _folder(spark, "store")
    sinks.append_log(X.dim_players(spark, sf_dir), root, "dim_players")
    sinks.append_log(X.fantasy_logs(spark, sf_dir), root, "fantasy_logs")
    return root


@register("job_correct_names", NAMED_SQL + """
SELECT table_name, NAME, count(*) AS row_count FROM named
WHERE NAME IN (SELECT FROM_NAME FROM fixes) GROUP BY ALL""")
def q_job_correct_names(spark, sf_dir):
    """Rows that the correction changed, by table and name."""
    return J.correct_names_job(spark, _named_store(spark, sf_dir), "r1", SUPPLIER_FIXES)


@register("job_verify_names", NAMED_SQL + """
SELECT n.table_name, f.TO_NAME AS NAME, count(*) AS row_count
FROM named n JOIN fixes f ON n.NAME = f.FROM_NAME GROUP BY ALL""")
def q_job_verify_names(spark, sf_dir):
    """Rows that carry a corrected name after the rewrite."""
    root = _named_store(spark, sf_dir)
    J.correct_names_job(spark, root, "r1", SUPPLIER_FIXES)
    return J.verify_corrections_job(spark, root, SUPPLIER_FIXES)


# --- M6, M7: migrations of stored logs ---------------------------------------------------------------

@register("job_migrate_ids", """
SELECT o_orderkey AS PLAYER_ID, o_custkey AS GAME_ID, CAST(o_orderdate AS DATE) AS DATE, o_totalprice AS DK_POINTS
FROM orders WHERE o_orderpriority <> '5-LOW'""")
def q_job_migrate_ids(spark, sf_dir):
    """M6: a log with real and text ids, rewritten with integer ones; rows without an id go."""
    root = _folder(spark, "store")
    real = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey").cast("double"))
    sinks.append_log(X.table(spark, sf_dir, "orders").select(
        real.alias("PLAYER_ID"), F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("GAME_ID"),
        F.to_date("o_orderdate").alias("DATE"), F.col("o_totalprice").alias("DK_POINTS")), root, "fantasy_logs")
    J.migrate_id_types_job(spark, root, "r1")
    return sinks.read_log(spark, root, "fantasy_logs")


@register("job_rename_absence_columns", """
SELECT CAST(o_orderdate AS DATE) AS DATE, c_name AS PLAYER, o_orderkey AS GAME_ID, o_custkey AS PLAYER_ID
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_job_rename_absence_columns(spark, sf_dir):
    """M7: absences stored under the sheet's own names, brought to DATE and PLAYER."""
    root, o = _folder(spark, "store"), X.table(spark, sf_dir, "orders")
    c = X.table(spark, sf_dir, "customer")
    old = {new: was for was, new in K.ABSENCE_RENAMES.items()}
    sinks.append_log(o.join(c, o.o_custkey == c.c_custkey).select(
        F.to_date("o_orderdate").alias(old["DATE"]), F.col("c_name").alias(old["PLAYER"]),
        F.col("o_orderkey").alias("GAME_ID"), F.col("o_custkey").alias("PLAYER_ID")), root, "player_absences")
    J.rename_absence_columns_job(spark, root, "r1")
    return sinks.read_log(spark, root, "player_absences")
