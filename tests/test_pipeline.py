"""End-to-end: feed workbooks in a landing folder -> stored logs -> averages -> slate, over two days."""

import datetime as dt
import os

from pyspark.sql import functions as F

from courtside import sinks
from courtside.plans import jobs as J
from courtside.sources import feeds as FD
from tests.helpers import box_workbook, dfs_workbook, write_csv

DFS_HEADER = ["FEEDCO\nDATASET", "GAME_ID", "PLAYER_ID", "PLAYER", "DATE", "OWN\nTEAM", "STARTER\n(Y/N)",
              "MINUTES", "USAGE\nRATE", "DRAFTKINGS", "FOR DRAFTKINGS CLASSIC CONTESTS", "FANDUEL", "DRAFTKINGS"]


def dfs_row(pid, name, date, pts, team="Boston", started="Y", minutes=30):
    return ["2025-26 NBA Regular Season", 22500000 + (pid or 0), pid, name, date, team, started, minutes, 25.0,
            "PG", 8000, 40.0, pts]


def test_xlsx_and_csv_rows_and_headers(spark, tmp_dir):
    box_workbook(os.path.join(tmp_dir, "b", "feed1.xlsx"), [[22500001, 1, "Alpha Player", "2025-11-01", 30]],
                 [["2025-11-01", 22500001, "Houston", "Dallas", 99, "Beta Bench", "DNP", "COACH'S DECISION"]])
    write_csv(os.path.join(tmp_dir, "b", "feed0.csv"), [["GAME-ID", "PLAYER-ID", "DATE"], [1, 2, "2025-11-01"], [None, None, None]])
    rows = FD.read_feed_rows(spark, os.path.join(tmp_dir, "b"))
    sheets = {(r._file_name, r._sheet, r._sheet_no) for r in rows.collect()}
    assert ("feed1.xlsx", "DNP-DND-NWT", 1) in sheets and ("feed0.csv", None, 0) in sheets
    box = FD.sheet_frame(rows, 0, header_row=0).where(F.col("_file_name") == "feed1.xlsx").collect()
    assert box[0]["PLAYER__FULL_NAME"] == "Alpha Player" and box[0]["GAME_ID"] == "22500001"
    csv_rows = FD.sheet_frame(rows, 0).where(F.col("_file_name") == "feed0.csv").collect()
    assert len(csv_rows) == 1    # the all-empty row is dropped
    ab = FD.sheet_frame(rows, "DNP-DND-NWT").collect()
    assert ab[0]["GAME_DATE"] == "2025-11-01" and ab[0]["PLAYER_NAME"] == "Beta Bench"


def test_slate_entries_header_detection(spark, tmp_dir):
    p = os.path.join(tmp_dir, "DKEntries.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("Entry ID,Contest Name\n1,Main\n\nPosition,Name + ID,Name,ID\nPG,LeBron James (1),LeBron James,1\n"
                "SG,GG Jackson (2),GG Jackson,2\nSG,GG Jackson (2),GG Jackson,2\nC,,,\n")
    names = sorted(r.Name for r in FD.read_slate_entries(spark, p).collect())
    assert names == ["GG Jackson", "LeBron James"]
    assert FD.read_slate_entries(spark, os.path.join(tmp_dir, "missing.csv")) is None


def test_two_day_run(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    box_dir, dfs_dir, exports = (os.path.join(tmp_dir, d) for d in ("box", "dfs", "exports"))
    # day 1
    box_workbook(os.path.join(box_dir, "feed1.xlsx"),
                 [[22500001, 1, "Alpha Player", "2025-11-01", 30], [22500001, 50, "GG Jackson", "2025-11-01", 12]],
                 [["2025-11-01", 22500001, "Houston", "Dallas", 50, "Conflict", "DNP", "REST"],
                  ["2025-11-01", 22500001, "Houston", "Dallas", 60, "Beta Bench", "DNP", "Coach's Decision "]])
    dfs_workbook(os.path.join(dfs_dir, "dfs1.xlsx"), DFS_HEADER,
                 [dfs_row(1, "Alpha Player", "November 1, 2025", 45.2), dfs_row(50, "GG Jackson", "2025-11-01", 20.0),
                  dfs_row(None, "No Id", "2025-11-01", 1.0)])
    entries = os.path.join(tmp_dir, "DKEntries.csv")
    with open(entries, "w") as f:
        f.write("Position,Name + ID,Name\nPG,x,Alpha Player\nSF,y,GG Jackson\nC,z,Zzqx Nobody\n")
    b1 = J.ingest_box_scores(spark, root, box_dir, "r1")
    assert (b1.rows_added, b1.absences_inserted) == (2, 1)
    d1 = J.ingest_fantasy_logs(spark, root, dfs_dir, "r1")
    assert (d1.rows_added, d1.dropped_missing_ids) == (2, 1)
    fl = {r.PLAYER_ID: r for r in sinks.read_log(spark, root, "fantasy_logs").collect()}
    assert fl[1].DATE == dt.date(2025, 11, 1) and fl[1].DK_POINTS == 45.2 and "FANDUEL" not in fl[1].asDict()
    assert fl[50].PLAYER == "Gregory Jackson"
    ab = sinks.read_log(spark, root, "player_absences").collect()
    assert [(r.PLAYER_ID, r.ABSENCE_TYPE) for r in ab] == [(60, "DNP-CD")]
    J.seed_map_teams(spark, root, "r1")
    summary = J.run_daily(spark, root, box_dir, dfs_dir, entries, "2025-11-15", "r1b", exports,
                          now=dt.datetime(2025, 11, 15, 9, 30, 0))
    assert summary["errors"] == [], summary
    avg = {r.PLAYER_ID: r for r in sinks.read_table(spark, root, "fantasy_averages").collect()}
    assert avg[1].FPPG == 45.2 and avg[1].TEAM == "BOS" and avg[1].SEASON == "2025-26"
    slate = spark.table("vw_daily_slate").collect()
    assert sorted(r.PLAYER for r in slate) == ["Alpha Player", "Gregory Jackson"]
    work = sinks.read_log(spark, root, "unmatched_names").collect()
    assert [r.name for r in work] == ["Zzqx Nobody"]
    assert any(p.endswith("slate_player_averages_11-15-2025_093000.csv") for p in os.listdir(exports))
    # day 2: cumulative file (superset) + one new game; the processed file is not re-read
    box_workbook(os.path.join(box_dir, "feed2.xlsx"),
                 [[22500001, 1, "Alpha Player", "2025-11-01", 30], [22500001, 50, "GG Jackson", "2025-11-01", 12],
                  [22500002, 1, "Alpha Player", "2025-11-03", 25]], None)
    b2 = J.ingest_box_scores(spark, root, box_dir, "r2")
    assert b2.files == ["feed2.xlsx"] and b2.rows_added == 1 and b2.absence_files_without_sheet == ["feed2.xlsx"]
    assert sinks.read_log(spark, root, "player_logs").count() == 3
    assert J.ingest_box_scores(spark, root, box_dir, "r3").rows_added == 0
    runs = sinks.read_log(spark, root, "run_summary").collect()
    assert len(runs) == 1


def test_incremental_averages_equal_full_recompute(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    dfs_dir = os.path.join(tmp_dir, "dfs")
    seg_reg, seg_po = "2024-25 NBA Regular Season", "2025 NBA Playoffs"

    def row(pid, date, seg, pts):
        r = dfs_row(pid, f"P{pid}", date, pts)
        r[0] = seg
        return r

    dfs_workbook(os.path.join(dfs_dir, "d1.xlsx"), DFS_HEADER,
                 [row(1, "2024-11-01", seg_reg, 40.0), row(2, "2024-11-01", seg_reg, 30.0),
                  row(1, "2025-04-20", seg_po, 50.0)])
    J.ingest_fantasy_logs(spark, root, dfs_dir, "r1")
    J.seed_map_teams(spark, root, "r1")
    J.build_fantasy_averages(spark, root, "2025-05-01", "r1")
    dfs_workbook(os.path.join(dfs_dir, "d2.xlsx"), DFS_HEADER,
                 [row(1, "2024-11-01", seg_reg, 40.0), row(2, "2024-11-01", seg_reg, 30.0),
                  row(1, "2025-04-20", seg_po, 50.0), row(1, "2025-04-25", seg_po, 20.0)])
    d2 = J.ingest_fantasy_logs(spark, root, dfs_dir, "r2")
    assert d2.touched_segments == [seg_po]
    previous = sinks.read_table(spark, root, "fantasy_averages")
    segs = J.affected_segments(J.segment_dates(sinks.read_log(spark, root, "fantasy_logs")), d2.touched_segments, "2025-05-01",
                               previous=previous)
    assert segs == [seg_po]
    same_as_full(spark, root, "2025-05-01", "r2")
    full = sinks.read_table(spark, root, "fantasy_averages")
    po = [r for r in full.collect() if r.SEASON_TYPE == "Playoffs"][0]
    assert (po.GP, po.FPPG) == (2, 35.0)
    # sixty days later the trailing values must have fallen to zero, without a new row
    assert [r.L30FPPM for r in same_as_full(spark, root, "2025-07-01", "r3") if r.SEASON_TYPE == "Playoffs"] == [0.0]
    # a changed dimension reaches the seasons that would be carried over
    dims = sinks.read_log(spark, root, "dim_players")
    sinks.replace_log(dims.withColumn("PLAYER_NAME", F.concat("PLAYER_NAME", F.lit(" X"))), root, "dim_players", "r4")
    assert {r.PLAYER for r in same_as_full(spark, root, "2025-07-01", "r4")} == {"P1 X", "P2 X"}


def same_as_full(spark, root, as_of, run_id):
    inc = J.build_fantasy_averages(spark, root, as_of, run_id).collect()
    full = J.build_fantasy_averages(spark, root, as_of, run_id, incremental=False).collect()
    assert sorted(map(tuple, inc)) == sorted(map(tuple, full))
    return full
