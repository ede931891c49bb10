"""Adapters from the driver's test tables to the pipeline's logical tables.

The test data is TPC-H-like; the pipeline's domain is player-game logs.  Each adapter
is a projection/join of the given tables, so its work grows with them.  Every adapter
has a SQL twin (``*_SQL``) used by the DuckDB oracle, written to the same rules.

Mapping (logical <- test table):

* fantasy_logs: one row per lineitem; PLAYER_ID=l_suppkey, GAME_ID=l_orderkey,
  DATE=order date, SEASON_SEGMENT from order status (O regular season, F playoffs,
  P preseason), TEAM=customer's nation name, DK_POINTS=l_extendedprice,
  DK_SALARY=o_totalprice, MINUTES=l_discount*100, USAGE=l_tax*100, STARTED='Y' for
  return flag A.  The log's own PLAYER spelling is lower-cased for return flag R
  (so canonical-name mismatches exist).
* dim_players: suppliers with a non-negative balance (the others are unknown players).
* map_teams: nation name -> region name, except NATION_24 (an unmapped team).
* player_logs: events of type 'purchase', key (user_id, day of ts), order event_id.
* player_absences: events of type 'error', same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01"
FILE1_CUTOFF = "2024-01-16"   # events before this day form the first cumulative file


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fantasy_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    year = F.year("o_orderdate").cast("string")
    segment = (F.when(F.col("o_orderstatus") == "O", F.concat(year, F.lit(" NBA Regular Season")))
                .when(F.col("o_orderstatus") == "F", F.concat(year, F.lit(" NBA Playoffs")))
                .when(F.col("o_orderstatus") == "P", F.lit("Preseason")))
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    # Orders get their customer's team first: lineitems, the most rows, are shuffled once, not for every join.
    teams = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return (li.join(teams, li.l_orderkey == F.col("o_orderkey"))
              .select(F.col("l_suppkey").alias("PLAYER_ID"),
                      F.col("l_orderkey").alias("GAME_ID"),
                      F.when(F.col("l_returnflag") == "R", F.lower(name)).otherwise(name).alias("PLAYER"),
                      F.to_date("o_orderdate").alias("DATE"),
                      segment.alias("SEASON_SEGMENT"),
                      F.col("n_name").alias("TEAM"),
                      F.col("l_extendedprice").alias("DK_POINTS"),
                      F.col("o_totalprice").alias("DK_SALARY"),
                      (F.col("l_discount") * 100).alias("MINUTES"),
                      (F.col("l_tax") * 100).alias("USAGE"),
                      F.when(F.col("l_returnflag") == "A", F.lit("Y")).otherwise(F.lit("N")).alias("STARTED"),
                      F.col("l_linenumber").alias("LINE_NO")))


def dim_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.where(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("PLAYER_ID"),
                                                   F.col("s_name").alias("PLAYER_NAME"))


def map_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .where(F.col("n_name") != "NATION_24")
             .select(F.col("n_name").alias("RAW_TEAM_NAME"), F.col("r_name").alias("TEAM_ABBREVIATION")))


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a keyed log: PLAYER_ID=user_id, DATE=day of ts; file 1 = days before the cutoff,
    file 2 = everything (cumulative feed); _row_no = event_id orders rows within a file."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("PLAYER_ID"),
                    F.to_date("ts").alias("DATE"),
                    F.col("event_id").alias("_row_no"),
                    F.col("event_type").alias("EVENT_TYPE"),
                    F.col("value").alias("VALUE"),
                    F.col("props").alias("PROPS"),
                    F.col("ts").alias("TS"))


def cumulative_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cumulative feed files from events: file 1 holds the early days, file 2 all days."""
    ev = event_logs(spark, sf_dir)
    f1 = ev.where(F.col("DATE") < F.lit(FILE1_CUTOFF).cast("date")).withColumn("_file_name", F.lit("feed_1.csv"))
    f2 = ev.withColumn("_file_name", F.lit("feed_2.csv"))
    return f1.unionByName(f2)


# ---------------------------------------------------------------------------------------
# SQL twins (DuckDB dialect, also valid Spark SQL where noted) of the adapters above.
# ---------------------------------------------------------------------------------------

FANTASY_LOGS_SQL = """
fantasy_logs AS (
  SELECT l.l_suppkey AS PLAYER_ID,
         l.l_orderkey AS GAME_ID,
         CASE WHEN l.l_returnflag = 'R' THEN lower(printf('Supplier#%09d', l.l_suppkey))
              ELSE printf('Supplier#%09d', l.l_suppkey) END AS PLAYER,
         CAST(o.o_orderdate AS DATE) AS DATE,
         CASE o.o_orderstatus
              WHEN 'O' THEN CAST(year(o.o_orderdate) AS VARCHAR) || ' NBA Regular Season'
              WHEN 'F' THEN CAST(year(o.o_orderdate) AS VARCHAR) || ' NBA Playoffs'
              WHEN 'P' THEN 'Preseason' END AS SEASON_SEGMENT,
         n.n_name AS TEAM,
         l.l_extendedprice AS DK_POINTS,
         o.o_totalprice AS DK_SALARY,
         l.l_discount * 100 AS MINUTES,
         l.l_tax * 100 AS USAGE,
         CASE WHEN l.l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS STARTED,
         l.l_linenumber AS LINE_NO
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

DIM_PLAYERS_SQL = """
dim_players AS (
  SELECT s_suppkey AS PLAYER_ID, s_name AS PLAYER_NAME FROM supplier WHERE s_acctbal >= 0
)"""

MAP_TEAMS_SQL = """
map_teams AS (
  SELECT n.n_name AS RAW_TEAM_NAME, r.r_name AS TEAM_ABBREVIATION
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_name <> 'NATION_24'
)"""

EVENT_LOGS_SQL = """
event_logs AS (
  SELECT user_id AS PLAYER_ID, CAST(ts AS DATE) AS DATE, event_id AS _row_no,
         event_type AS EVENT_TYPE, value AS VALUE, props AS PROPS, ts AS TS
  FROM events
)"""

CUMULATIVE_FILES_SQL = EVENT_LOGS_SQL + """,
cumulative_files AS (
  SELECT *, 'feed_1.csv' AS _file_name FROM event_logs WHERE DATE < DATE '""" + FILE1_CUTOFF + """'
  UNION ALL
  SELECT *, 'feed_2.csv' AS _file_name FROM event_logs
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# ---------------------------------------------------------------------------------------
# Further adapters: text renderings of the tables that exercise conformance rules.
# ---------------------------------------------------------------------------------------

def order_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season-segment text per order, covering every classification branch:
    tournament and play-in names, a segment without a year, NULL, preseason."""
    o = table(spark, sf_dir, "orders")
    y = F.year("o_orderdate").cast("string")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    seg = (F.when(st == "P", F.lit("Preseason"))
            .when((st == "O") & (pr == "1-URGENT"), F.concat(y, F.lit(" NBA In-Season Tournament")))
            .when((st == "F") & (pr == "2-HIGH"), F.concat(y, F.lit(" NBA Play-In")))
            .when((st == "O") & (pr == "5-LOW"), F.lit("NBA Regular Season"))
            .when((st == "F") & (pr == "4-NOT SPECIFIED"), F.lit(None).cast("string"))
            .when(st == "O", F.concat(y, F.lit(" NBA Regular Season")))
            .when(st == "F", F.concat(y, F.lit(" NBA Playoffs"))))
    return o.select(F.col("o_orderkey").alias("GAME_ID"), seg.alias("SEASON_SEGMENT"))


ORDER_SEGMENTS_SQL = """
order_segments AS (
  SELECT o_orderkey AS GAME_ID,
         CASE WHEN o_orderstatus = 'P' THEN 'Preseason'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN CAST(year(o_orderdate) AS VARCHAR) || ' NBA In-Season Tournament'
              WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN CAST(year(o_orderdate) AS VARCHAR) || ' NBA Play-In'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'NBA Regular Season'
              WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              WHEN o_orderstatus = 'O' THEN CAST(year(o_orderdate) AS VARCHAR) || ' NBA Regular Season'
              WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS VARCHAR) || ' NBA Playoffs' END AS SEASON_SEGMENT
  FROM orders
)"""


def absence_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absence REASON text per order, with case/whitespace variants and NULL."""
    o = table(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    reason = (F.when(pr == "1-URGENT", F.lit("COACH'S DECISION"))
               .when(pr == "2-HIGH", F.lit(" Coach's Decision \t"))
               .when(pr == "3-MEDIUM", F.lit("Injury/Illness - Left Ankle; Sprain"))
               .when(pr == "4-NOT SPECIFIED", F.lit(None).cast("string"))
               .otherwise(F.lit("REST")))
    return o.select(F.col("o_orderkey").alias("GAME_ID"), reason.alias("REASON"))


ABSENCE_REASONS_SQL = """
absence_reasons AS (
  SELECT o_orderkey AS GAME_ID,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'COACH''S DECISION'
                              WHEN '2-HIGH' THEN ' Coach''s Decision ' || chr(9)
                              WHEN '3-MEDIUM' THEN 'Injury/Illness - Left Ankle; Sprain'
                              WHEN '4-NOT SPECIFIED' THEN NULL
                              ELSE 'REST' END AS REASON
  FROM orders
)"""


def raw_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id cells as a feed would deliver them: missing, fractional, integral-real, non-numeric, clean."""
    e = table(spark, sf_dir, "events")
    u = F.col("user_id").cast("string")
    t = F.col("event_type")
    raw = (F.when(t == "error", F.lit(None).cast("string"))
            .when(t == "view", F.concat(u, F.lit(".5")))
            .when(t == "click", F.concat(u, F.lit(".0")))
            .when(t == "signup", F.concat(F.lit("U"), u))
            .otherwise(u))
    return e.select(F.col("event_id").alias("ROW_ID"), raw.alias("PLAYER_ID"))


RAW_IDS_SQL = """
raw_ids AS (
  SELECT event_id AS ROW_ID,
         CASE event_type WHEN 'error' THEN NULL
                         WHEN 'view' THEN CAST(user_id AS VARCHAR) || '.5'
                         WHEN 'click' THEN CAST(user_id AS VARCHAR) || '.0'
                         WHEN 'signup' THEN 'U' || CAST(user_id AS VARCHAR)
                         ELSE CAST(user_id AS VARCHAR) END AS PLAYER_ID
  FROM events
)"""


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates rendered in the layouts feeds use, plus an unparseable cell."""
    o = table(spark, sf_dir, "orders")
    d, pr = F.col("o_orderdate"), F.col("o_orderpriority")
    raw = (F.when(pr == "1-URGENT", F.date_format(d, "yyyy-MM-dd"))
            .when(pr == "2-HIGH", F.date_format(d, "M/d/yyyy"))
            .when(pr == "3-MEDIUM", F.date_format(d, "MMMM d, yyyy"))
            .when(pr == "4-NOT SPECIFIED", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.lit("n/a")))
    return o.select(F.col("o_orderkey").alias("ROW_ID"), raw.alias("DATE"))


RAW_DATES_SQL = """
raw_dates AS (
  SELECT o_orderkey AS ROW_ID,
         CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
                              WHEN '2-HIGH' THEN strftime(o_orderdate, '%-m/%-d/%Y')
                              WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%B %-d, %Y')
                              WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                              ELSE 'n/a' END AS DATE
  FROM orders
)"""


def header_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header cells of many feed files: one file per brand, one cell per part (position =
    part key), text = part name -- repeated names exercise duplicate-header handling."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_brand").alias("_file_name"), F.col("p_partkey").alias("pos"),
                    F.concat(F.col("p_type"), F.lit("-"), F.col("p_name")).alias("raw"))


HEADER_CELLS_SQL = """
header_cells AS (
  SELECT p_brand AS _file_name, p_partkey AS pos, p_type || '-' || p_name AS raw FROM part
)"""


def dnp_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absence-sheet rows from the fantasy logs: zero minutes means the player did not play."""
    f = fantasy_logs(spark, sf_dir)
    return f.where(F.col("MINUTES") == 0).select("PLAYER_ID", "GAME_ID", "DATE", "LINE_NO")


def played_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fantasy_logs(spark, sf_dir)
    return f.where(F.col("MINUTES") > 0)


def slate_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's slate: the names of suppliers in region 1 as a slate file would list them."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return (s.join(n, s.s_nationkey == n.n_nationkey).where(F.col("n_regionkey") == 1)
             .select(F.col("s_name").alias("Name")))


SLATE_ENTRIES_SQL = """
slate_entries AS (
  SELECT s.s_name AS Name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE n.n_regionkey = 1
)"""


def typed_slate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slate as typed: known players of region 1, every other name in capitals and spread out."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    known = s.join(n, s.s_nationkey == n.n_nationkey).where((F.col("n_regionkey") == 1) & (F.col("s_acctbal") >= 0))
    name = F.col("s_name")
    return known.select(F.when(F.col("s_suppkey") % 2 == 0, name)
                        .otherwise(F.concat(F.lit("  "), F.upper(name), F.lit(" "))).alias("Name"))


TYPED_SLATE_SQL = """
typed_slate AS (
  SELECT s.s_name AS stored FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE n.n_regionkey = 1 AND s.s_acctbal >= 0
)"""


def noisy_slate_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slate names as people type them: exact in region 1, upper-cased in region 2, spaced out
    in region 3, shortened in region 4, plus names from the correction map in region 0."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = F.col("n_regionkey")
    nm = F.col("s_name")
    noisy = (F.when(r == 1, nm)
              .when(r == 2, F.upper(nm))
              .when(r == 3, F.regexp_replace(nm, "#", " # "))
              .when(r == 4, F.concat(F.lit("Supp "), F.substring(nm, 11, 9)))
              .otherwise(F.concat(nm, F.lit(" Jr."))))
    return s.join(n, s.s_nationkey == n.n_nationkey).select(noisy.alias("Name"))


def part_name_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misspelled part names: plural, vowel swap, upper case, spaces removed."""
    p = table(spark, sf_dir, "part")
    nm = F.col("p_name")
    return (p.select(F.concat(nm, F.lit("s")).alias("name"))
             .union(p.select(F.regexp_replace(nm, "e", "a").alias("name")))
             .union(p.select(F.upper(nm).alias("name")))
             .union(p.select(F.regexp_replace(nm, " ", "").alias("name")))
             .distinct())


PART_NAME_QUERIES_SQL = """
part_name_queries AS (
  SELECT DISTINCT name FROM (
    SELECT p_name || 's' AS name FROM part
    UNION ALL SELECT replace(p_name, 'e', 'a') FROM part
    UNION ALL SELECT upper(p_name) FROM part
    UNION ALL SELECT replace(p_name, ' ', '') FROM part)
)"""
