"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame; each has a SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .. import sinks
from ..functions import columns as C
from ..functions import constants as K
from ..operators import conform as CF
from ..operators import ingest as I
from ..operators import quality as Q
from ..operators import matching as MT
from ..operators import seasons as S
from ..operators import slate as SL
from ..operators import summary as M
from ..session import checkpoint_dir, stage
from . import fixtures as X
from . import job_catalog
from . import jobs as J
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.season_averages(X.fantasy_logs(spark, sf_dir), X.dim_players(spark, sf_dir),
                             X.map_teams(spark, sf_dir), X.AS_OF)


# --- B4 / A1-A9 -------------------------------------------------------------------------

@register("season_averages", O.averages_with() + "SELECT * FROM fantasy_averages")
def q_season_averages(spark, sf_dir):
    return averages(spark, sf_dir)


@register("season_averages_regular",
          O.averages_with() + "SELECT * FROM fantasy_averages WHERE SEASON_TYPE = 'Regular'")
def q_season_averages_regular(spark, sf_dir):
    return S.season_type_view(averages(spark, sf_dir), "Regular")


@register("season_averages_playoffs",
          O.averages_with() + "SELECT * FROM fantasy_averages WHERE SEASON_TYPE = 'Playoffs'")
def q_season_averages_playoffs(spark, sf_dir):
    return S.season_type_view(averages(spark, sf_dir), "Playoffs")


STARTER_COLS = ("SEASON_TYPE", "PLAYER_ID", "PLAYER", "SEASON", "TEAM", "GP", "GS", "GSFPPG",
                "STDV_GSFPPG", "GS_DK_POINTS_sum", "GSMPG", "STDV_GSMPG", "GS_MINUTES_sum",
                "STDV_GSFPPM", "GSFPPM")


@register("starter_splits", O.averages_with() + f"SELECT {', '.join(STARTER_COLS)} FROM fantasy_averages")
def q_starter_splits(spark, sf_dir):
    return averages(spark, sf_dir).select(*STARTER_COLS)


L30_COLS = ("SEASON_TYPE", "PLAYER_ID", "PLAYER", "SEASON", "TEAM", "L30_DK_POINTS_sum",
            "L30_MINUTES_sum", "L30FPPM", "FPPM")


@register("last30_rate", O.averages_with() + f"SELECT {', '.join(L30_COLS)} FROM fantasy_averages")
def q_last30_rate(spark, sf_dir):
    return averages(spark, sf_dir).select(*L30_COLS)


# --- duplicate audit and repair (A10-A12, O2, D1/M2) on events keyed (user, day) ---------

AUDIT_SQL = X.with_(X.EVENT_LOGS_SQL, """
audit AS (SELECT PLAYER_ID, DATE, EVENT_TYPE FROM event_logs)""")


def audit_table(spark, sf_dir):
    return X.event_logs(spark, sf_dir).select("PLAYER_ID", "DATE", "EVENT_TYPE")


@register("dup_stats", AUDIT_SQL + """
SELECT count(*) AS total_rows,
       count(DISTINCT CAST(PLAYER_ID AS VARCHAR) || '_' || CAST(DATE AS VARCHAR)) AS distinct_keys,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM audit)) AS distinct_full_rows,
       count(*) - count(DISTINCT CAST(PLAYER_ID AS VARCHAR) || '_' || CAST(DATE AS VARCHAR)) AS extra_rows
FROM audit""")
def q_dup_stats(spark, sf_dir):
    return Q.duplicate_stats(audit_table(spark, sf_dir))


@register("dup_groups_top20", AUDIT_SQL + """
SELECT PLAYER_ID, DATE, count(*) AS copies FROM audit
GROUP BY PLAYER_ID, DATE HAVING count(*) > 1
ORDER BY copies DESC, DATE DESC, PLAYER_ID ASC LIMIT 20""")
def q_dup_groups_top20(spark, sf_dir):
    return Q.duplicate_groups(audit_table(spark, sf_dir), top=20)


@register("dup_verdict", AUDIT_SQL + """,
rows_ AS (SELECT PLAYER_ID, DATE, EVENT_TYPE, count(*) AS m FROM audit GROUP BY ALL)
SELECT PLAYER_ID, DATE, CAST(sum(m) AS BIGINT) AS copies, count(*) AS variants,
       count(*) = 1 AS exact_copies
FROM rows_ GROUP BY PLAYER_ID, DATE HAVING sum(m) > 1""")
def q_dup_verdict(spark, sf_dir):
    return Q.duplicate_verdict(audit_table(spark, sf_dir))


@register("dup_repair_keep_earliest", X.with_(X.EVENT_LOGS_SQL) + """
SELECT * FROM event_logs
QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY _row_no) = 1""")
def q_dup_repair(spark, sf_dir):
    return Q.remove_duplicates(X.event_logs(spark, sf_dir), order=["_row_no"])


LOADED_SQL = X.with_(X.EVENT_LOGS_SQL, """
loaded AS (
  SELECT * EXCLUDE (_row_no), 3 - _row_no % 3 AS _load_no, 'feed_' || (_row_no % 2) || '.csv' AS _file_name, _row_no
  FROM event_logs
)""")


@register("repair_first_inserted", LOADED_SQL + """
SELECT * FROM loaded
QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY _load_no, _file_name, _row_no) = 1""")
def q_repair_first_inserted(spark, sf_dir):
    """M2 over a stored log: the copy of the earliest load stays, whatever its values are."""
    n = F.col("_row_no")
    loaded = (X.event_logs(spark, sf_dir).withColumn("_load_no", 3 - n % 3)
              .withColumn("_file_name", F.concat(F.lit("feed_"), (n % 2).cast("string"), F.lit(".csv"))))
    return Q.remove_duplicates(loaded, order=list(J.LOAD_COLUMNS))


@register("averages_incremental", O.averages_with() + "SELECT * FROM fantasy_averages")
def q_averages_incremental(spark, sf_dir):
    """B4 in two runs over a store: the first on the games before July 2000, the second carries
    over the seasons that neither new games nor the trailing window touch."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/averages-{uuid.uuid4().hex}"
    sinks.append_log(X.dim_players(spark, sf_dir), root, "dim_players")
    sinks.publish(X.map_teams(spark, sf_dir), root, "map_teams", "r1")
    late = F.col("DATE") >= F.lit("2000-07-01").cast("date")
    logs = X.fantasy_logs(spark, sf_dir).withColumn("_load_no", F.when(late, 2).otherwise(1).cast("long"))
    sinks.append_log(logs.where(~late), root, "fantasy_logs")
    J.build_fantasy_averages(spark, root, "2000-07-01", "r1")
    sinks.append_log(logs.where(late), root, "fantasy_logs")
    return J.build_fantasy_averages(spark, root, X.AS_OF, "r2")


# --- incremental ingest (U1, D2, J3, J5, J4, J9) -------------------------------------------

@register("ingest_two_cumulative_files", X.with_(X.CUMULATIVE_FILES_SQL) + """
SELECT * FROM cumulative_files
QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY _file_name, _row_no) = 1""")
def q_ingest_two_files(spark, sf_dir):
    return I.new_rows(X.cumulative_files(spark, sf_dir), None)


INGEST_SQL = X.with_(X.CUMULATIVE_FILES_SQL, """
stored AS (
  SELECT * FROM cumulative_files WHERE _file_name = 'feed_1.csv'
  QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY _file_name, _row_no) = 1
)""", """
today AS (
  SELECT * FROM cumulative_files WHERE _file_name = 'feed_2.csv'
  QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY _file_name, _row_no) = 1
)""", """
new_rows AS (
  SELECT t.* FROM today t ANTI JOIN stored s ON t.PLAYER_ID = s.PLAYER_ID AND t.DATE = s.DATE
)""")


def _ingest_parts(spark, sf_dir):
    files = X.cumulative_files(spark, sf_dir)
    stored = I.new_rows(files.where(F.col("_file_name") == "feed_1.csv"), None)
    today = files.where(F.col("_file_name") == "feed_2.csv")
    return stored, today


@register("ingest_new_rows_only", INGEST_SQL + "SELECT * FROM new_rows")
def q_ingest_new_rows(spark, sf_dir):
    stored, today = _ingest_parts(spark, sf_dir)
    return I.new_rows(today, stored)


@register("learn_new_players", INGEST_SQL.replace("new_rows AS (", """dim AS (
  SELECT DISTINCT PLAYER_ID FROM stored WHERE EVENT_TYPE = 'purchase'
),
new_rows AS (""", 1) + """
SELECT PLAYER_ID, EVENT_TYPE || '#' || CAST(PLAYER_ID AS VARCHAR) AS PLAYER_NAME FROM new_rows
WHERE PLAYER_ID NOT IN (SELECT PLAYER_ID FROM dim)
QUALIFY row_number() OVER (PARTITION BY PLAYER_ID ORDER BY _file_name, _row_no) = 1""")
def q_learn_new_players(spark, sf_dir):
    stored, today = _ingest_parts(spark, sf_dir)
    new = I.new_rows(today, stored).withColumn(
        "PLAYER", F.concat(F.col("EVENT_TYPE"), F.lit("#"), F.col("PLAYER_ID").cast("string")))
    dim = stored.where(F.col("EVENT_TYPE") == "purchase").select("PLAYER_ID").distinct()
    return I.learn_members(new, dim)


ABSENCE_SQL = X.with_(X.EVENT_LOGS_SQL, """
absences AS (
  SELECT PLAYER_ID, DATE, _row_no, VALUE FROM event_logs WHERE EVENT_TYPE = 'error'
  QUALIFY row_number() OVER (PARTITION BY PLAYER_ID, DATE ORDER BY _row_no) = 1
)""", """
box AS (SELECT PLAYER_ID, DATE FROM event_logs WHERE EVENT_TYPE = 'purchase')""")


def _absence_parts(spark, sf_dir):
    ev = X.event_logs(spark, sf_dir)
    absences = Q.first_by_key(ev.where(F.col("EVENT_TYPE") == "error").select("PLAYER_ID", "DATE", "_row_no", "VALUE"),
                              ["PLAYER_ID", "DATE"], ["_row_no"])
    box = ev.where(F.col("EVENT_TYPE") == "purchase").select("PLAYER_ID", "DATE")
    return absences, box


@register("absences_box_score_wins", ABSENCE_SQL + """
SELECT a.* FROM absences a ANTI JOIN box b ON a.PLAYER_ID = b.PLAYER_ID AND a.DATE = b.DATE""")
def q_absences_box_wins(spark, sf_dir):
    a, b = _absence_parts(spark, sf_dir)
    return I.drop_conflicts(a, b)


@register("absence_overlap", ABSENCE_SQL + """
SELECT count(*) AS overlapping_absences FROM absences a
SEMI JOIN box b ON a.PLAYER_ID = b.PLAYER_ID AND a.DATE = b.DATE""")
def q_absence_overlap(spark, sf_dir):
    a, b = _absence_parts(spark, sf_dir)
    return Q.absence_overlap(a, b)


# --- conformance (C7, C8, C11, C12, C14, C16-C18, C1-C3) ------------------------------------

@register("absence_type", X.with_(X.ABSENCE_REASONS_SQL) + """
SELECT GAME_ID, REASON,
       CASE WHEN upper(regexp_replace(REASON, '^[\\s\\xa0]+|[\\s\\xa0]+$', '', 'g')) = 'COACH''S DECISION'
            THEN 'DNP-CD' ELSE 'INJURY/ILLNESS/OTHER' END AS ABSENCE_TYPE
FROM absence_reasons""")
def q_absence_type(spark, sf_dir):
    return CF.classify_absence(X.absence_reasons(spark, sf_dir))


@register("normalize_ids_report", X.with_(X.RAW_IDS_SQL, """
c AS (
  SELECT ROW_ID, PLAYER_ID AS RAW_ID, try_cast(trim(PLAYER_ID) AS DOUBLE) AS num,
         CASE WHEN PLAYER_ID IS NULL OR trim(PLAYER_ID) = '' THEN 'missing'
              WHEN try_cast(trim(PLAYER_ID) AS DOUBLE) IS NULL OR isnan(try_cast(trim(PLAYER_ID) AS DOUBLE)) THEN 'non_numeric'
              WHEN try_cast(trim(PLAYER_ID) AS DOUBLE) <> floor(try_cast(trim(PLAYER_ID) AS DOUBLE)) THEN 'fractional'
              ELSE 'ok' END AS reason
  FROM raw_ids
)""") + """
SELECT ROW_ID, RAW_ID, reason, CASE WHEN reason = 'ok' THEN CAST(num AS BIGINT) END AS PLAYER_ID FROM c""")
def q_normalize_ids(spark, sf_dir):
    raw = X.raw_ids(spark, sf_dir).withColumnRenamed("PLAYER_ID", "RAW_ID")
    typed = C.once(raw, CF.typed_id("RAW_ID"), "id")
    return typed.select("ROW_ID", "RAW_ID", F.col("id.reason").alias("reason"), F.col("id.value").alias("PLAYER_ID"))


@register("normalize_dates", X.with_(X.RAW_DATES_SQL) + """
SELECT ROW_ID, DATE AS RAW_DATE,
       CAST(coalesce(try_strptime(DATE, '%Y-%m-%d'), try_strptime(DATE, '%Y-%m-%d %H:%M:%S'),
                     try_strptime(DATE, '%m/%d/%Y'), try_strptime(DATE, '%B %d, %Y')) AS DATE) AS DATE
FROM raw_dates""")
def q_normalize_dates(spark, sf_dir):
    raw = X.raw_dates(spark, sf_dir).withColumnRenamed("DATE", "RAW_DATE")
    return CF.with_parsed_date(raw, "RAW_DATE", out="DATE").select("ROW_ID", "RAW_DATE", "DATE")


# A correction map over part names (test parameter): four spellings fixed to title case.
PART_NAME_FIXES = {"small ring": "Small Ring", "red widget": "Red Widget",
                   "blue bolt": "Blue Bolt", "hot gear": "Hot Gear"}


def _map_sql(mapping, alias="fixes"):
    rows = ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())
    return f"{alias} AS (SELECT * FROM (VALUES {rows}) t(FROM_NAME, TO_NAME))"


@register("standardize_names", X.with_(_map_sql(PART_NAME_FIXES)) + """
SELECT p.p_partkey AS PART_ID, p.p_name AS RAW_NAME, coalesce(f.TO_NAME, p.p_name) AS PLAYER
FROM part p LEFT JOIN fixes f ON p.p_name = f.FROM_NAME""")
def q_standardize_names(spark, sf_dir):
    p = X.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("PART_ID"),
                                              F.col("p_name").alias("RAW_NAME"), F.col("p_name").alias("PLAYER"))
    return CF.standardize_names(p, "PLAYER", PART_NAME_FIXES)


@register("names_changed", X.with_(_map_sql(PART_NAME_FIXES)) + """
SELECT p.p_name AS FROM_NAME, count(*) AS row_count, f.TO_NAME
FROM part p JOIN fixes f ON p.p_name = f.FROM_NAME GROUP BY p.p_name, f.TO_NAME""")
def q_names_changed(spark, sf_dir):
    p = X.table(spark, sf_dir, "part").select(F.col("p_name").alias("PLAYER"))
    return CF.names_changed(p, "PLAYER", PART_NAME_FIXES)


def _named_name_tables(spark, sf_dir):
    return {"part": (X.table(spark, sf_dir, "part"), "p_name"),
            "supplier": (X.table(spark, sf_dir, "supplier"), "s_name"),
            "customer": (X.table(spark, sf_dir, "customer"), "c_name")}


NAME_TABLES_SQL = """
named AS (
  SELECT 'part' AS table_name, p_name AS NAME FROM part
  UNION ALL SELECT 'supplier', s_name FROM supplier
  UNION ALL SELECT 'customer', c_name FROM customer
)"""


@register("correction_impact", X.with_(_map_sql(PART_NAME_FIXES), NAME_TABLES_SQL) + """
SELECT table_name, NAME, count(*) AS row_count FROM named
WHERE NAME IN (SELECT FROM_NAME FROM fixes) GROUP BY ALL""")
def q_correction_impact(spark, sf_dir):
    return Q.correction_counts(_named_name_tables(spark, sf_dir), PART_NAME_FIXES, side="source")


@register("correction_verify", X.with_(_map_sql(PART_NAME_FIXES), NAME_TABLES_SQL, """
fixed AS (SELECT n.table_name, coalesce(f.TO_NAME, n.NAME) AS NAME FROM named n LEFT JOIN fixes f ON n.NAME = f.FROM_NAME)""") + """
SELECT table_name, NAME, count(*) AS row_count FROM fixed
WHERE NAME IN (SELECT TO_NAME FROM fixes) GROUP BY ALL""")
def q_correction_verify(spark, sf_dir):
    named = {t: (CF.standardize_names(df, c, PART_NAME_FIXES), c) for t, (df, c) in _named_name_tables(spark, sf_dir).items()}
    return Q.correction_counts(named, PART_NAME_FIXES, side="target")


@register("season_classify", X.with_(X.ORDER_SEGMENTS_SQL, """
t AS (SELECT *, """ + O.season_type("SEASON_SEGMENT") + """ AS SEASON_TYPE FROM order_segments)""") + """
SELECT GAME_ID, SEASON_SEGMENT, SEASON_TYPE, """ + O.season_key("SEASON_SEGMENT", "SEASON_TYPE") + """ AS SEASON_KEY FROM t""")
def q_season_classify(spark, sf_dir):
    return S.classify_season(X.order_segments(spark, sf_dir))


@register("unclassified_segments", X.with_(X.ORDER_SEGMENTS_SQL, """
t AS (SELECT *, """ + O.season_type("SEASON_SEGMENT") + """ AS SEASON_TYPE FROM order_segments)""", """
k AS (SELECT *, """ + O.season_key("SEASON_SEGMENT", "SEASON_TYPE") + """ AS SEASON_KEY FROM t)""") + """
SELECT SEASON_SEGMENT, count(*) AS rows_dropped FROM k
WHERE SEASON_TYPE IS NULL OR SEASON_KEY IS NULL GROUP BY SEASON_SEGMENT""")
def q_unclassified_segments(spark, sf_dir):
    return S.unclassified_segments(X.order_segments(spark, sf_dir))


@register("header_map", X.with_(X.HEADER_CELLS_SQL, """
m AS (
  SELECT _file_name, pos, raw,
         row_number() OVER (PARTITION BY _file_name, raw ORDER BY pos) - 1 AS k
  FROM header_cells
)""") + """
SELECT _file_name, pos, raw,
       upper(regexp_replace(replace(replace(replace(
           CASE WHEN k > 0 THEN raw || '.' || CAST(k AS VARCHAR) ELSE raw END,
           chr(10), '_'), '-', '_'), ' ', '_'), '[^a-zA-Z0-9_]', '', 'g')) AS name
FROM m""")
def q_header_map(spark, sf_dir):
    return CF.header_map(X.header_cells(spark, sf_dir), hyphen_to_underscore=True)


@register("header_map_dfs", X.with_(X.HEADER_CELLS_SQL, """
m AS (
  SELECT _file_name, pos, raw,
         row_number() OVER (PARTITION BY _file_name, raw ORDER BY pos) - 1 AS k
  FROM header_cells
)""") + """
SELECT _file_name, pos, raw,
       upper(regexp_replace(replace(replace(
           CASE WHEN k > 0 THEN raw || '.' || CAST(k AS VARCHAR) ELSE raw END,
           chr(10), '_'), ' ', '_'), '[^a-zA-Z0-9_]', '', 'g')) AS name
FROM m""")
def q_header_map_dfs(spark, sf_dir):
    """The daily-fantasy variant strips hyphens."""
    return CF.header_map(X.header_cells(spark, sf_dir), hyphen_to_underscore=False)


@register("rename_and_drop", """
SELECT l_orderkey AS GAME_ID, l_suppkey AS PLAYER_ID, l_linestatus AS TEAM, l_returnflag AS STARTED,
       l_tax AS USAGE, l_extendedprice AS DK_SALARY, l_discount AS DK_POINTS, l_linenumber AS SEASON_SEGMENT
FROM lineitem""")
def q_rename_and_drop(spark, sf_dir):
    """Feed headers to stored names, other sites' columns dropped."""
    cols = {"l_orderkey": "GAME_ID", "l_suppkey": "PLAYER_ID", "l_linestatus": "OWN_TEAM",
            "l_returnflag": "STARTER_YN", "l_tax": "USAGE_RATE", "l_extendedprice": "FOR_DRAFTKINGS_CLASSIC_CONTESTS",
            "l_discount": "DRAFTKINGS1", "l_linenumber": "FEED_DATASET", "l_quantity": "FANDUEL1", "l_partkey": "YAHOO"}
    raw = X.table(spark, sf_dir, "lineitem").select(*[F.col(c).alias(n) for c, n in cols.items()])
    return CF.rename_and_drop(raw, K.DFS_RENAMES, K.DFS_DROP)


@register("drop_empty_rows", """
WITH cells AS (
  SELECT event_id AS _row_no, CASE WHEN user_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS A,
         CASE WHEN event_type = 'click' THEN event_type WHEN event_type = 'view' THEN ' ' || chr(9) END AS B
  FROM events)
SELECT * FROM cells WHERE A IS NOT NULL OR trim(B, ' ' || chr(9)) <> ''""")
def q_drop_empty_rows(spark, sf_dir):
    """Rows whose cells are all NULL or blank."""
    e, kind = X.table(spark, sf_dir, "events"), F.col("event_type")
    return CF.drop_empty_rows(e.select(
        F.col("event_id").alias("_row_no"),
        F.when(F.col("user_id") % 3 == 0, F.col("user_id").cast("string")).alias("A"),
        F.when(kind == "click", kind).when(kind == "view", F.lit(" \t")).alias("B")))


@register("absence_columns", X.with_(X.ABSENCE_REASONS_SQL) + """
SELECT CAST(o.o_orderdate AS DATE) AS DATE, o.o_orderkey AS GAME_ID, n.n_name AS TEAM, r.r_name AS OPPONENT,
       o.o_custkey AS PLAYER_ID, c.c_name AS PLAYER, o.o_orderstatus AS STATUS, a.REASON,
       CASE WHEN upper(regexp_replace(a.REASON, '^[\\s\\xa0]+|[\\s\\xa0]+$', '', 'g')) = 'COACH''S DECISION'
            THEN 'DNP-CD' ELSE 'INJURY/ILLNESS/OTHER' END AS ABSENCE_TYPE
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey JOIN absence_reasons a ON a.GAME_ID = o.o_orderkey""")
def q_absence_columns(spark, sf_dir):
    """An absence sheet's rows typed, classified and in the stored column order."""
    o, c = X.table(spark, sf_dir, "orders"), X.table(spark, sf_dir, "customer")
    n, r = X.table(spark, sf_dir, "nation"), X.table(spark, sf_dir, "region")
    sheet = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("GAME_DATE"), F.col("o_orderkey").cast("string").alias("GAME_ID"),
                     F.col("n_name").alias("TEAM"), F.col("r_name").alias("OPPONENT"),
                     F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("PLAYER_ID"),
                     F.col("c_name").alias("PLAYER_NAME"), F.col("o_orderstatus").alias("STATUS")))
    ids = CF.normalize_ids(CF.rename_and_drop(sheet, K.ABSENCE_RENAMES), ["PLAYER_ID", "GAME_ID"])[0]
    dated = CF.normalize_dates(ids, "DATE")[0].join(X.absence_reasons(spark, sf_dir), "GAME_ID")
    return CF.absence_columns(CF.classify_absence(dated))


# --- teams, coverage and audits (M8/U3/C27, J8, A14-A16, J10-J12) --------------------------

SPELLINGS_SQL = """
spellings AS (
  SELECT lower(n.n_name) AS SPELLING, r.r_name AS TEAM_ABBREVIATION
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_name <> 'NATION_24'
)"""


def _spellings(spark, sf_dir):
    m = X.map_teams(spark, sf_dir)
    return m.select(F.lower("RAW_TEAM_NAME").alias("SPELLING"), "TEAM_ABBREVIATION")


@register("seed_teams", X.with_(X.FANTASY_LOGS_SQL, SPELLINGS_SQL, """
raw AS (SELECT DISTINCT TEAM AS RAW FROM fantasy_logs WHERE TEAM IS NOT NULL)""") + """
SELECT r.RAW AS RAW_TEAM_NAME, s.TEAM_ABBREVIATION FROM raw r
LEFT JOIN spellings s ON lower(trim(regexp_replace(r.RAW, '\\s+', ' ', 'g'))) = s.SPELLING""")
def q_seed_teams(spark, sf_dir):
    sources = [X.fantasy_logs(spark, sf_dir), X.played_rows(spark, sf_dir)]
    mapped, _ = CF.seed_team_map(sources, _spellings(spark, sf_dir))
    return mapped


@register("unmapped_teams", X.with_(X.FANTASY_LOGS_SQL, X.MAP_TEAMS_SQL) + """
SELECT DISTINCT f.TEAM FROM fantasy_logs f
WHERE f.TEAM IS NOT NULL AND f.TEAM NOT IN (SELECT RAW_TEAM_NAME FROM map_teams)""")
def q_unmapped_teams(spark, sf_dir):
    return Q.unmapped_teams(X.fantasy_logs(spark, sf_dir), X.map_teams(spark, sf_dir))


@register("coverage", """
SELECT 'orders' AS table_name, min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date, count(*) AS row_count FROM orders
UNION ALL SELECT 'events', min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), count(*) FROM events
UNION ALL SELECT 'lineitem', min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), count(*) FROM lineitem""")
def q_coverage(spark, sf_dir):
    return Q.coverage({"orders": (X.table(spark, sf_dir, "orders"), "o_orderdate"),
                       "events": (X.table(spark, sf_dir, "events"), "ts"),
                       "lineitem": (X.table(spark, sf_dir, "lineitem"), "l_shipdate")})


@register("segment_counts", X.with_(X.FANTASY_LOGS_SQL) + """
SELECT SEASON_SEGMENT, count(*) AS row_count FROM fantasy_logs GROUP BY SEASON_SEGMENT""")
def q_segment_counts(spark, sf_dir):
    return Q.segment_counts(X.fantasy_logs(spark, sf_dir))


def _class_sql(c):
    s = f"trim(CAST({c} AS VARCHAR))"
    return (f"CASE WHEN {c} IS NULL THEN 'null' WHEN regexp_matches({s}, '^[+-]?[0-9]+$') THEN 'integer' "
            f"WHEN try_cast({s} AS DOUBLE) IS NOT NULL THEN 'real' ELSE 'text' END")


@register("type_audit", X.with_(X.RAW_IDS_SQL, """
cells AS (
  SELECT 'PLAYER_ID' AS column_name, r.PLAYER_ID AS v FROM raw_ids r
  UNION ALL SELECT 'USER_ID', CAST(user_id AS VARCHAR) FROM events
  UNION ALL SELECT 'VALUE', CAST(value AS VARCHAR) FROM events
  UNION ALL SELECT 'EVENT_TYPE', event_type FROM events
)""") + f"""
SELECT column_name, {_class_sql('v')} AS storage_class, count(*) AS cells FROM cells GROUP BY ALL""")
def q_type_audit(spark, sf_dir):
    ids = X.raw_ids(spark, sf_dir).select("PLAYER_ID")
    ev = X.table(spark, sf_dir, "events").select(F.col("user_id").alias("USER_ID"),
                                                  F.col("value").alias("VALUE"),
                                                  F.col("event_type").alias("EVENT_TYPE"))
    return Q.type_audit(ids, ["PLAYER_ID"]).unionByName(Q.type_audit(ev, ["USER_ID", "VALUE", "EVENT_TYPE"]))


@register("name_mismatch", X.with_(X.FANTASY_LOGS_SQL, X.DIM_PLAYERS_SQL) + """
SELECT f.PLAYER_ID, f.PLAYER, d.PLAYER_NAME, count(*) AS log_rows
FROM fantasy_logs f JOIN dim_players d ON f.PLAYER_ID = d.PLAYER_ID
WHERE f.PLAYER <> d.PLAYER_NAME GROUP BY ALL""")
def q_name_mismatch(spark, sf_dir):
    return Q.name_mismatches(X.fantasy_logs(spark, sf_dir), X.dim_players(spark, sf_dir))


DNP_SQL = X.with_(X.FANTASY_LOGS_SQL, """
dnp AS (SELECT PLAYER_ID, GAME_ID, DATE, LINE_NO FROM fantasy_logs WHERE MINUTES = 0)""", """
played AS (SELECT * FROM fantasy_logs WHERE MINUTES > 0)""")


@register("same_game_pairs", DNP_SQL + """
SELECT a.*, CAST(coalesce(c.n, 0) AS BIGINT) AS box_rows_same_game FROM dnp a
LEFT JOIN (SELECT GAME_ID, count(*) AS n FROM played GROUP BY GAME_ID) c ON a.GAME_ID = c.GAME_ID""")
def q_same_game_pairs(spark, sf_dir):
    return Q.same_game_counts(X.dnp_rows(spark, sf_dir), X.played_rows(spark, sf_dir))


@register("season_of_absence", DNP_SQL + """,
seg AS (SELECT DISTINCT GAME_ID, SEASON_SEGMENT FROM played WHERE SEASON_SEGMENT IS NOT NULL),
nseg AS (SELECT GAME_ID, count(*) AS segments_for_game FROM seg GROUP BY GAME_ID)
SELECT a.*, s.SEASON_SEGMENT, n.segments_for_game FROM dnp a
LEFT JOIN seg s ON a.GAME_ID = s.GAME_ID LEFT JOIN nseg n ON s.GAME_ID = n.GAME_ID""")
def q_season_of_absence(spark, sf_dir):
    return Q.season_of_absence(X.dnp_rows(spark, sf_dir), X.played_rows(spark, sf_dir))


# --- slates (J6, C26, O1) and name resolution (J7, M11) ------------------------------------

# Season configuration for the test data (1995-2001); the library defaults are the live seasons.
TEST_SLATE_SEASONS = ("2000-01", "2001-02")
TEST_L30_SEASON = "2001-02"
TEST_PLAYOFF_SEASON = "2001"


def _matched_slate(spark, sf_dir) -> DataFrame:
    """The slate's matched names.  Here the slate file already carries stored spellings, so the
    list is used as matched; ``slate_through_matching`` takes it through the matching."""
    return X.slate_entries(spark, sf_dir).select(F.col("Name").alias("PLAYER"))


def _slate_averages(spark, sf_dir, matched: DataFrame) -> DataFrame:
    """Averages of the slate's players only: the restriction goes through the player dimension,
    so other players' games are left out before the aggregate."""
    dims = X.dim_players(spark, sf_dir).join(matched.select(F.col("PLAYER").alias("PLAYER_NAME")).distinct(),
                                             "PLAYER_NAME", "left_semi").select("PLAYER_ID", "PLAYER_NAME")
    return M.season_averages(X.fantasy_logs(spark, sf_dir), dims, X.map_teams(spark, sf_dir), X.AS_OF)


SLATE_SQL_BASE = O.averages_with() + ", " + X.SLATE_ENTRIES_SQL.strip() + "\n"


def _slate_sql(cols, season_type, seasons):
    sel = ", ".join("STDV_FPPG AS STDV" if c == "STDV" else c for c in cols)
    season_list = ", ".join(f"'{x}'" for x in seasons)
    return (SLATE_SQL_BASE + f"SELECT {sel} FROM fantasy_averages WHERE SEASON_TYPE = '{season_type}' "
            f"AND SEASON IN ({season_list}) AND PLAYER IN (SELECT Name FROM slate_entries)")


@register("daily_slate", _slate_sql(K.SLATE_COLUMNS, "Regular", TEST_SLATE_SEASONS))
def q_daily_slate(spark, sf_dir):
    names = _matched_slate(spark, sf_dir)
    return SL.daily_slate(_slate_averages(spark, sf_dir, names), names, TEST_SLATE_SEASONS)


@register("daily_slate_l30", _slate_sql(K.SLATE_L30_VIEW_COLUMNS, "Regular", (TEST_L30_SEASON,)))
def q_daily_slate_l30(spark, sf_dir):
    names = _matched_slate(spark, sf_dir)
    return SL.daily_slate_l30(_slate_averages(spark, sf_dir, names), names, TEST_L30_SEASON)


@register("playoff_slate", _slate_sql(K.SLATE_COLUMNS, "Playoffs", (TEST_PLAYOFF_SEASON,)))
def q_playoff_slate(spark, sf_dir):
    names = _matched_slate(spark, sf_dir)
    return SL.playoff_slate(_slate_averages(spark, sf_dir, names), names, TEST_PLAYOFF_SEASON)


@register("slate_through_matching", O.averages_with() + ", " + X.TYPED_SLATE_SQL.strip() + """
SELECT """ + ", ".join("STDV_FPPG AS STDV" if c == "STDV" else c for c in K.SLATE_COLUMNS) + """
FROM fantasy_averages WHERE SEASON_TYPE = 'Regular' AND SEASON IN ('2000-01', '2001-02')
AND PLAYER IN (SELECT stored FROM typed_slate)""")
def q_slate_through_matching(spark, sf_dir):
    """B6 as a whole: typed names to known players, then their averages in the slate's columns."""
    known = M.known_players(X.fantasy_logs(spark, sf_dir), X.dim_players(spark, sf_dir),
                            X.map_teams(spark, sf_dir), "Regular")
    names = stage(MT.matched_names(MT.match_names(X.typed_slate(spark, sf_dir), known, name_col="Name")))
    return SL.daily_slate(_slate_averages(spark, sf_dir, names), names, TEST_SLATE_SEASONS)


@register("fuzzy_match_lev", X.with_(X.PART_NAME_QUERIES_SQL, """
cands AS (SELECT DISTINCT p_name AS name FROM part)""", """
pairs AS (
  SELECT q.name AS q_name, c.name AS c_name,
         levenshtein(lower(trim(q.name)), lower(trim(c.name))) AS distance,
         greatest(length(lower(trim(q.name))), length(lower(trim(c.name)))) AS m
  FROM part_name_queries q, cands c
)""") + """
SELECT q_name, c_name, distance, CAST((m - distance) * 100 AS DOUBLE) / m AS score FROM pairs
WHERE distance * 100 <= m * 10
QUALIFY row_number() OVER (PARTITION BY q_name ORDER BY distance, c_name) = 1""")
def q_fuzzy_match_lev(spark, sf_dir):
    q = X.part_name_queries(spark, sf_dir).select(F.concat(F.lit("q"), F.xxhash64("name").cast("string")).alias("sid"), "name")
    c = X.table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct() \
         .select(F.concat(F.lit("c"), F.xxhash64("name").cast("string")).alias("sid"), "name")
    return MT.best_matches_levenshtein(q, c, 90)


@register("resolve_names_cascade")
def q_resolve_names_cascade(spark, sf_dir):
    """Rows-only check: the weighted-ratio scorer has no SQL twin (brute-force test instead)."""
    cands = M.known_players(X.fantasy_logs(spark, sf_dir), X.dim_players(spark, sf_dir),
                            X.map_teams(spark, sf_dir), "Regular")
    return MT.match_names(X.noisy_slate_entries(spark, sf_dir), cands, name_col="Name")


# --- as-of trailing features (D5) ----------------------------------------------------------

@register("asof_trailing_features", X.with_(X.EVENT_LOGS_SQL, """
d AS (
  SELECT PLAYER_ID, CAST(DATE - DATE '1970-01-01' AS BIGINT) AS day,
         sum(CAST(VALUE AS DECIMAL(38,9))) AS s, count(VALUE) AS n, count(*) AS r
  FROM event_logs GROUP BY ALL
)""", """
w AS (
  SELECT PLAYER_ID, day,
         CAST(sum(s) OVER win AS DOUBLE) AS VALUE_sum_30d,
         sum(n) OVER win AS n30,
         sum(r) OVER win AS r30
  FROM d
  WINDOW win AS (PARTITION BY PLAYER_ID ORDER BY day RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)
)""") + """
SELECT e.PLAYER_ID, e.DATE, e._row_no, e.VALUE, w.VALUE_sum_30d,
       CASE WHEN w.n30 > 0 THEN w.VALUE_sum_30d / w.n30 END AS VALUE_avg_30d,
       CAST(coalesce(w.r30, 0) AS BIGINT) AS games_30d
FROM event_logs e JOIN w ON e.PLAYER_ID = w.PLAYER_ID
 AND CAST(e.DATE - DATE '1970-01-01' AS BIGINT) = w.day""")
def q_asof_trailing_features(spark, sf_dir):
    ev = X.event_logs(spark, sf_dir).select("PLAYER_ID", "DATE", "_row_no", "VALUE")
    return M.trailing_features(ev, ["PLAYER_ID"], "DATE", ["VALUE"], days=30)


# --- within-file duplicates (D3) and the per-player grain (by_team=False) --------------------

@register("within_file_duplicates", X.with_(X.CUMULATIVE_FILES_SQL) + """
SELECT _file_name, PLAYER_ID, DATE, count(*) AS copies FROM cumulative_files
GROUP BY _file_name, PLAYER_ID, DATE HAVING count(*) > 1""")
def q_within_file_duplicates(spark, sf_dir):
    return Q.within_file_duplicates(X.cumulative_files(spark, sf_dir))


@register("season_averages_by_player", X.with_(X.FANTASY_LOGS_SQL, X.DIM_PLAYERS_SQL, """
map_teams AS (
  SELECT DISTINCT n.n_name AS RAW_TEAM_NAME, 'ALL' AS TEAM_ABBREVIATION
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_name <> 'NATION_24'
)""", O.averages_ctes()) + "SELECT * FROM fantasy_averages")
def q_season_averages_by_player(spark, sf_dir):
    return M.season_averages_by_player(X.fantasy_logs(spark, sf_dir), X.dim_players(spark, sf_dir),
                                       X.map_teams(spark, sf_dir), X.AS_OF)


def all_queries() -> dict[str, Query]:
    return QUERIES | job_catalog.QUERIES


def all_oracle() -> dict[str, str]:
    return ORACLE | job_catalog.ORACLE
