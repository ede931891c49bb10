import os

import pytest
from pyspark.sql import types as T

from courtside import sinks
from courtside.operators.quality import DuplicateKeyError
from courtside.streaming import dropfolder as DF
from tests.helpers import write_csv

SCHEMA = T.StructType([T.StructField("PLAYER_ID", T.LongType()), T.StructField("PLAYER", T.StringType()),
                       T.StructField("DATE", T.StringType()), T.StructField("PTS", T.LongType())])


def test_drop_folder_ingest_is_incremental_and_idempotent(spark, tmp_dir):
    landing, root, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "store", "ckpt"))
    write_csv(os.path.join(landing, "f1.csv"), [["PLAYER_ID", "PLAYER", "DATE", "PTS"], [1, "A", "2025-11-01", 30], [2, "B", "2025-11-01", 10]])
    DF.run_drop_folder_ingest(spark, landing, root, "player_logs", SCHEMA, ckpt)
    assert sinks.read_log(spark, root, "player_logs").count() == 2
    write_csv(os.path.join(landing, "f2.csv"), [["PLAYER_ID", "PLAYER", "DATE", "PTS"], [1, "A", "2025-11-01", 30], [2, "B", "2025-11-01", 10], [1, "A", "2025-11-03", 20]])
    DF.run_drop_folder_ingest(spark, landing, root, "player_logs", SCHEMA, ckpt)
    assert sinks.read_log(spark, root, "player_logs").count() == 3
    # a fresh checkpoint replays every file: nothing is added twice
    DF.run_drop_folder_ingest(spark, landing, root, "player_logs", SCHEMA, os.path.join(tmp_dir, "ckpt2"))
    assert sinks.read_log(spark, root, "player_logs").count() == 3


def test_publish_refuses_duplicates_and_keeps_previous_version(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    good = spark.createDataFrame([(1, "2025-11-01")], "PLAYER_ID long, DATE string")
    sinks.publish(good, root, "t", "r1", keys=("PLAYER_ID", "DATE"))
    bad = good.unionByName(good)
    with pytest.raises(DuplicateKeyError):
        sinks.publish(bad, root, "t", "r2", keys=("PLAYER_ID", "DATE"))
    assert sinks.read_table(spark, root, "t").count() == 1
    assert sinks.require_tables(spark, root, ["t", "nope"]) == ["nope"]


def test_audit_and_repair_jobs(spark, tmp_dir):
    from courtside.plans import jobs as J
    root = os.path.join(tmp_dir, "store")
    df = spark.createDataFrame([(1, "A", "2025-11-01", 30, "f1", 0), (1, "A", "2025-11-01", 35, "f2", 0),
                                (2, "B", "2025-11-01", 10, "f1", 1)],
                               "PLAYER_ID long, PLAYER string, DATE string, PTS long, _file_name string, _row_no long")
    sinks.append_log(df, root, "player_logs")
    stats, groups, extra = J.duplicate_audit(spark, root)
    assert extra == 1 and groups.count() == 1
    assert J.duplicate_repair(spark, root, "r1") == {"player_logs": 1}
    kept = sorted((r.PLAYER_ID, r.PTS) for r in sinks.read_log(spark, root, "player_logs").collect())
    assert kept == [(1, 30), (2, 10)]
    assert J.duplicate_repair(spark, root, "r2") == {}


def test_name_correction_and_id_migration_jobs(spark, tmp_dir):
    from courtside.plans import jobs as J
    root = os.path.join(tmp_dir, "store")
    sinks.append_log(spark.createDataFrame([(12345.0, 1.0, "2025-11-01", "GG Jackson"), (None, 2.0, "2025-11-02", "X")],
                                           "PLAYER_ID double, GAME_ID double, DATE string, PLAYER string"),
                     root, "fantasy_logs")
    impact = {(r.table_name, r.NAME): r.row_count for r in J.correct_names_job(spark, root, "r1").collect()}
    assert impact == {("fantasy_logs", "GG Jackson"): 1}
    verify = {(r.table_name, r.NAME) for r in J.verify_corrections_job(spark, root).collect()}
    assert ("fantasy_logs", "Gregory Jackson") in verify
    assert J.migrate_id_types_job(spark, root, "r2") == 1
    r = sinks.read_log(spark, root, "fantasy_logs").collect()
    assert [(x.PLAYER_ID, x.GAME_ID) for x in r] == [(12345, 1)]
    assert J.migrate_id_types_job(spark, root, "r3") == 0


def test_read_table_falls_back_to_log(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    sinks.append_log(spark.createDataFrame([(1,)], "x long"), root, "only_log")
    assert sinks.read_table(spark, root, "only_log").count() == 1
    assert sinks.read_table(spark, root, "missing") is None


BOX_HEADER = ["PLAYER_ID", "PLAYER", "DATE", "PTS"]


def _names(folder):
    return sorted(f for f in os.listdir(folder) if not f.startswith(".")) if os.path.isdir(folder) else []


def test_rejected_file_stays_is_reported_and_loads_once_corrected(spark, tmp_dir):
    from courtside.plans import jobs as J
    landing, root, ckpt, archive = (os.path.join(tmp_dir, d) for d in ("landing", "store", "ckpt", "archive"))
    write_csv(os.path.join(landing, "good.csv"), [BOX_HEADER, [1, "A", "2025-11-01", 30]])
    write_csv(os.path.join(landing, "bad.csv"), [BOX_HEADER, ["2.5", "B", "2025-11-01", 10]])
    for _ in range(2):  # a second trigger without news changes nothing
        DF.run_feed_stream(spark, landing, root, J.BOX, ckpt, archive_dir=archive)
        assert _names(landing) == ["bad.csv"] and _names(archive) == ["good.csv"]
        told = sinks.rejected_files(spark, root, J.BOX.name).collect()
        assert [(r["_file_name"], "fractional" in r["reason"]) for r in told] == [("bad.csv", True)]
        assert sinks.read_log(spark, root, "player_logs").count() == 1
    write_csv(os.path.join(landing, "bad.csv"), [BOX_HEADER, [2, "B", "2025-11-01", 10], [3, "C", "2025-11-01", 5]])
    DF.run_feed_stream(spark, landing, root, J.BOX, ckpt, archive_dir=archive)
    assert _names(landing) == [] and _names(archive) == ["bad.csv", "good.csv"]
    assert sorted(r.PLAYER_ID for r in sinks.read_log(spark, root, "player_logs").collect()) == [1, 2, 3]
    write_csv(os.path.join(landing, "new.csv"), [BOX_HEADER, [4, "D", "2025-11-02", 1]])
    DF.run_feed_stream(spark, landing, root, J.BOX, ckpt, archive_dir=archive)
    assert sinks.read_log(spark, root, "player_logs").count() == 4 and _names(landing) == []


def test_table_stream_counts_unfit_cells_and_rejects_unreadable_files(spark, tmp_dir):
    landing, root, archive = (os.path.join(tmp_dir, d) for d in ("landing", "store", "archive"))
    write_csv(os.path.join(landing, "f1.csv"), [BOX_HEADER, [1, "A", "2025-11-01", "many"], [2, "B", "2025-11-01", ""]])
    write_csv(os.path.join(landing, "f2.csv"), [["PLAYER", "DATE"], ["A", "2025-11-01"]])
    with open(os.path.join(landing, "f3.csv"), "wb") as f:
        f.write("PLAYER_ID,PLAYER,DATE,PTS\n7,Don\u010di\u0107,2025-11-01,1\n".encode("cp1250"))
    DF.run_drop_folder_ingest(spark, landing, root, "player_logs", SCHEMA, os.path.join(tmp_dir, "c"), archive_dir=archive)
    assert sinks.read_log(spark, root, "player_logs").count() == 2
    manifest = {r["_file_name"]: (r["status"], r["reason"]) for r in sinks.read_log(spark, root, "ingest_manifest").collect()}
    assert manifest["f1.csv"] == ("ok", "1 cells of PTS don't fit")
    assert manifest["f2.csv"] == ("rejected", "columns ['PLAYER_ID'] are missing") and manifest["f3.csv"][0] == "rejected"
    assert _names(landing) == ["f2.csv", "f3.csv"] and _names(archive) == ["f1.csv"]


def test_export_is_one_plain_file(spark, tmp_dir):
    import datetime as dt
    out = os.path.join(tmp_dir, "out")
    df = spark.createDataFrame([("B", 2), ("A", 1)], "PLAYER string, GP int").orderBy("PLAYER")
    for _ in range(2):  # the same second again: the file is replaced
        path = sinks.export_csv(df, out, "slate_player_averages", dt.datetime(2025, 11, 2, 3, 4, 5))
        assert os.path.basename(path) == "slate_player_averages_11-02-2025_030405.csv" and os.path.isfile(path)
        assert open(path).read() == "PLAYER,GP\nA,1\nB,2\n" and _names(out) == [os.path.basename(path)]


def test_worklist_is_keyed_by_run_date_and_name(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    cols = "mapped string, match string, score int, matched boolean, worklist string"
    first = spark.createDataFrame([("X", "A", 40, False, "x"), ("Y", "B", 99, True, None), ("Z", None, 0, False, "z")], cols)
    sinks.append_worklist(spark, root, "2025-11-01", first)
    sinks.append_worklist(spark, root, "2025-11-02", first)
    again = spark.createDataFrame([("X", "C", 50, False, "x2")], cols)
    for _ in range(2):
        sinks.append_worklist(spark, root, "2025-11-02", again)
    got = sorted((r.run_date, r.name, r.best_match, r.score) for r in sinks.read_log(spark, root, "unmatched_names").collect())
    assert got == [("2025-11-01", "X", "A", 40), ("2025-11-01", "Z", None, 0), ("2025-11-02", "X", "C", 50)]


def test_views_last_and_are_independent(spark, tmp_dir):
    import datetime as dt

    from courtside.plans import jobs as J
    root = os.path.join(tmp_dir, "store")
    rows = spark.createDataFrame([(1, "A", "Regular"), (2, "B", "Playoffs")], "PLAYER_ID long, PLAYER string, SEASON_TYPE string")
    for n in range(2):  # a new version: the views follow
        sinks.publish(rows.limit(2 - n) if n else rows, root, "fantasy_averages", f"r{n}")
        avg = sinks.read_table(spark, root, "fantasy_averages")
        done = J.publish_average_views(spark, avg, None, dt.datetime(2025, 11, 1), root)
    assert done == [v for v, _, _ in J.AVERAGE_VIEWS]
    other = spark.newSession()
    assert [r.PLAYER for r in other.table("vw_player_averages_regular_season").collect()] == ["A"]
    assert other.table("vw_player_averages_playoffs").count() == 0
    failed = {}
    stamp = dt.datetime(2025, 11, 1)
    blocked = os.path.join(tmp_dir, "blocked")
    open(blocked, "w").close()  # exports below a file fail, view by view
    J.publish_average_views(spark, avg, os.path.join(blocked, "x"), stamp, root, failed)
    assert set(failed) == set(done) and other.table("vw_player_averages_regular_season").count() == 1


def test_stream_never_takes_a_file_whole(spark, tmp_dir, monkeypatch):
    """A delimited file comes by its path, in splits: its content is neither in the stream nor in a Python worker."""
    from courtside.plans import jobs as J
    landing, root = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "store")
    os.makedirs(landing)
    with open(os.path.join(landing, "day 1.csv"), "w") as f:
        f.write("GAME-ID,PLAYER-ID,PLAYER  FULL NAME,DATE,PTS\n1,7,Ann,2025-01-01,3\n2,8,Bo,2025-01-02,4\n")
    assert "content" not in DF.landing_stream(spark, landing).columns
    monkeypatch.setattr(DF.FD, "parsed", lambda *_: pytest.fail("parsed whole"))
    DF.run_feed_stream(spark, landing, root, J.BOX, os.path.join(tmp_dir, "c"))
    assert sorted(r[0] for r in sinks.read_log(spark, root, "player_logs").select("PLAYER_ID").collect()) == [7, 8]
    assert [r["_file_name"] for r in sinks.processed_files(spark, root, "box").collect()] == ["day 1.csv"]
