"""Loading, repairing and rewriting logs: nothing may get lost or change on the way."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from courtside import sinks
from courtside.functions import columns as C
from courtside.operators import conform as CF
from courtside.operators import ingest as I
from courtside.operators import repair as R
from courtside.plans import jobs as J
from courtside.session import checkpoint_dir, discard, stage, stage_observed
from courtside.streaming import dropfolder as DF
from tests.helpers import BOX_HEADER, box_workbook, dfs_workbook, write_csv, write_xlsx
from tests.test_pipeline import DFS_HEADER, dfs_row


def log(spark, root, name, *cols):
    return sorted(tuple(r) for r in sinks.read_log(spark, root, name).select(*cols).collect())


def test_rows_loaded_after_a_rewrite_join_the_history(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "dfs")
    dfs_workbook(os.path.join(landing, "d1.xlsx"), DFS_HEADER, [dfs_row(1, "GG Jackson II", "2025-11-01", 10.0),
                                                                dfs_row(2, "B", "2025-11-01", 20.0)])
    J.ingest_fantasy_logs(spark, root, landing, "r1")
    fixed = sinks.read_log(spark, root, "fantasy_logs").withColumn("PLAYER", F.upper("PLAYER"))
    backup = sinks.replace_log(fixed, root, "fantasy_logs", "fix")
    assert spark.read.parquet(backup).count() == 2
    dfs_workbook(os.path.join(landing, "d2.xlsx"), DFS_HEADER, [dfs_row(3, "C", "2025-12-05", 30.0)])
    assert J.ingest_fantasy_logs(spark, root, landing, "r2").rows_added == 1
    assert log(spark, root, "fantasy_logs", "PLAYER_ID", "PLAYER") == [(1, "GREGORY JACKSON"), (2, "B"), (3, "C")]
    folder = f"{root}/fantasy_logs/{sinks.log_folder(spark, root, 'fantasy_logs')}"
    assert any(x.startswith("SEASON_SEGMENT=") for x in os.listdir(folder))


def test_a_file_delivered_again_under_its_name_is_loaded(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "box")
    path = os.path.join(landing, "season.xlsx")
    first = [[22500001, 1, "A", "2025-11-01", 30]]
    box_workbook(path, first)
    assert J.ingest_box_scores(spark, root, landing, "r1").overwritten == []
    assert J.ingest_box_scores(spark, root, landing, "r1b").files == []
    time.sleep(0.05)
    box_workbook(path, [*first, [22500002, 1, "A", "2025-11-03", 25]])
    again = J.ingest_box_scores(spark, root, landing, "r2")
    assert (again.files, again.overwritten, again.rows_added) == (["season.xlsx"], ["season.xlsx"], 1)
    assert log(spark, root, "player_logs", "PLAYER_ID", "PTS", "_load_no") == [(1, 25.0, 2), (1, 30.0, 1)]


def test_a_bad_file_does_not_hold_up_the_others(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "box")
    box_workbook(os.path.join(landing, "a.xlsx"), [[1, 1, "A", "2025-11-01", 30]])
    box_workbook(os.path.join(landing, "b.xlsx"), [[1, 2, "B", "someday", 30], [1, 5, "E", "2025-11-01", 1]])
    box_workbook(os.path.join(landing, "c.xlsx"), [[1, 3, "C", "2025-11-01", "30*"], [1, None, "N", "2025-11-01", 1]])
    box_workbook(os.path.join(landing, "d.xlsx"), [[1, 4, "D", "2025-11-01", 1], [1, 4, "D", "2025-11-01", 2]])
    write_xlsx(os.path.join(landing, "e.xlsx"), [("S", [["GAME-ID", "PLAYER-ID", "PLAYER \nFULL NAME", "DATE", "x y", "x_y"],
                                                        [1, 6, "F", "2025-11-01", 1, 2]])])
    with open(os.path.join(landing, "f.xlsx"), "w") as f:
        f.write("no workbook")
    got = J.ingest_box_scores(spark, root, landing, "r1")
    assert got.files == ["a.xlsx", "c.xlsx"] and got.rows_added == 2 and got.dropped_missing_ids == 1
    assert got.bad_cells == {"PTS": 1} and sorted(got.rejected) == ["b.xlsx", "d.xlsx", "e.xlsx", "f.xlsx"]
    assert "unparseable_date" in got.rejected["b.xlsx"] and "X_Y" in got.rejected["e.xlsx"]
    box_workbook(os.path.join(landing, "b.xlsx"), [[1, 2, "B", "2025-11-02", 30]])   # mended: loaded with the next run
    assert J.ingest_box_scores(spark, root, landing, "r2").files == ["b.xlsx"]
    assert log(spark, root, "player_logs", "PLAYER_ID") == [(1,), (2,), (3,)]


def test_a_sheet_without_season_loads(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "dfs")
    dfs_workbook(os.path.join(landing, "d.xlsx"), ["PLAYER_ID", "PLAYER", "DATE"], [[1, "A", "2025-11-01"]])
    assert J.ingest_fantasy_logs(spark, root, landing, "r1").rows_added == 1
    assert log(spark, root, "fantasy_logs", "PLAYER_ID", "SEASON_SEGMENT") == [(1, None)]
    dfs_workbook(os.path.join(landing, "e.xlsx"), DFS_HEADER, [dfs_row(2, "B", "2025-11-01", 5.0)])
    J.ingest_fantasy_logs(spark, root, landing, "r2")   # new columns: older rows read NULL
    assert log(spark, root, "fantasy_logs", "PLAYER_ID", "DK_POINTS") == [(1, None), (2, 5.0)]


def test_schema_drift(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    sinks.append_log(spark.createDataFrame([(1, "a")], "x long, y string"), root, "t")
    sinks.append_log(spark.createDataFrame([(2, 0.5)], "x long, z double"), root, "t")
    assert log(spark, root, "t", "x", "y", "z") == [(1, "a", None), (2, None, 0.5)]
    with pytest.raises(sinks.SchemaDriftError):
        sinks.append_log(spark.createDataFrame([("3",)], "x string"), root, "t")
    assert log(spark, root, "t", "x") == [(1,), (2,)]


def test_the_same_run_id_twice_reads_and_writes_a_table(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    sinks.publish(spark.createDataFrame([(1,)], "x long"), root, "t", "r")
    sinks.publish(sinks.read_table(spark, root, "t").withColumn("x", F.col("x") + 1), root, "t", "r")
    assert [r.x for r in sinks.read_table(spark, root, "t").collect()] == [2]


def test_repair_keeps_the_first_inserted_copy(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    copies = [(1, "2025-11-01", 35, 1, "z.xlsx", 5), (1, "2025-11-01", 30, 2, "a.xlsx", 0), (2, "2025-11-01", 1, 2, "a.xlsx", 1)]
    sinks.append_log(spark.createDataFrame(copies, "PLAYER_ID long, DATE string, PTS long, _load_no long, "
                                                   "_file_name string, _row_no int"), root, "player_logs")
    stats, _, extra = J.duplicate_audit(spark, root)
    r = stats.first()
    assert (extra, r.keys_of_exact_copies, r.keys_of_differing_copies) == (1, 0, 1)
    J.duplicate_repair(spark, root, "r1")
    assert log(spark, root, "player_logs", "PLAYER_ID", "PTS") == [(1, 35), (2, 1)]


def test_corrected_names_reach_the_averages(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "dfs")
    dfs_workbook(os.path.join(landing, "d.xlsx"), DFS_HEADER, [dfs_row(1, "Alpha", "2025-11-01", 10.0)])
    J.ingest_fantasy_logs(spark, root, landing, "r1")
    J.seed_map_teams(spark, root, "r1")
    J.build_fantasy_averages(spark, root, "2025-11-02", "r1")
    J.correct_names_job(spark, root, "r2", {"Alpha": "Alpha X"})
    assert [r.PLAYER for r in sinks.read_table(spark, root, "fantasy_averages").collect()] == ["Alpha X"]
    assert {r.table_name for r in J.verify_corrections_job(spark, root, {"Alpha": "Alpha X"}).collect()} == \
        {"fantasy_logs", "dim_players", "fantasy_averages"}
    assert [r.PLAYER for r in J.build_fantasy_averages(spark, root, "2025-11-02", "r3").collect()] == ["Alpha X"]


def test_stored_keys_are_read_by_month(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "box")
    box_workbook(os.path.join(landing, "a.xlsx"), [[1, 1, "A", f"2025-{m:02d}-01", 30] for m in (9, 10, 11)])
    J.ingest_box_scores(spark, root, landing, "r1")
    part = sinks.read_log(spark, root, "player_logs", months=["2025-10"])
    assert part.count() == 1 and "_month" in part._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert part.select(F.input_file_name()).distinct().count() == 1


def test_stream_and_batch_load_the_same(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "box")
    box_workbook(os.path.join(landing, "a.xlsx"), [[1, 1, "A", "2025-11-01", 30], [1, 2, "GG Jackson", "2025-11-01", 3]],
                 [["2025-11-01", 1, "X", "Y", 9, "Z", "DNP", "REST"], ["2025-11-01", 1, "X", "Y", 1, "A", "DNP", "REST"]])
    box_workbook(os.path.join(landing, "b.xlsx"), [[1, 1, "A", "2025-11-01", 31], [2, 1, "A", "2025-11-05", 7]])
    batch, stream = os.path.join(tmp_dir, "s1"), os.path.join(tmp_dir, "s2")
    J.ingest_box_scores(spark, batch, landing, "r1")
    DF.run_feed_stream(spark, landing, stream, J.BOX, os.path.join(tmp_dir, "ckpt"))
    for t in ("player_logs", "player_absences", "dim_players"):
        cols = sinks.read_log(spark, batch, t).columns
        assert log(spark, batch, t, *cols) == log(spark, stream, t, *cols)
    DF.run_feed_stream(spark, landing, stream, J.BOX, os.path.join(tmp_dir, "ckpt2"))   # replayed: nothing twice
    assert sinks.read_log(spark, stream, "player_logs").count() == 3


@pytest.mark.parametrize("text,day", [
    ("1 Nov 2025", 1), ("Sept 5, 2025", None), ("2025-11-01 19:30", 1), ("01-Nov-2025", 1), ("Nov 1 2025", 1),
    ("November 1, 2025 00:00:00", 1), ("Nov. 2nd, 2025", 2), ("november 3 2025", 3), ("2025-11-04", 4),
    ("11/5/2025", 5), ("45962", 1), ("Foo 1 2025", "bad"), ("2025-13-01", "bad")])
def test_date_layouts(spark, text, day):
    got = spark.createDataFrame([(text,)], "d string").select(C.parse_date("d")).first()[0]
    want = None if day == "bad" else dt.date(2025, 9, 5) if day is None else dt.date(2025, 11, day)
    assert got == want


def test_ids_keep_64_bits(spark):
    texts = ["9007199254740993", "9007199254740993.0", "1.2E3", "12.5", "abc", "", None, "NaN", "9223372036854775808"]
    df = spark.createDataFrame([(t,) for t in texts], "PLAYER_ID string")
    out = df.select(CF.normalized_id("PLAYER_ID"), CF.id_reason("PLAYER_ID")).collect()
    assert [tuple(r) for r in out] == [
        (9007199254740993, "ok"), (9007199254740993, "ok"), (1200, "ok"), (None, "fractional"), (None, "non_numeric"),
        (None, "missing"), (None, "missing"), (None, "non_numeric"), (None, "non_numeric")]


def test_team_seed_without_logs_and_with_unknown_teams(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "dfs")
    seeded = J.seed_map_teams(spark, root, "r1").collect()
    assert len(seeded) == 30 == len({r.TEAM_ABBREVIATION for r in seeded})
    with pytest.raises(R.SeedRefused):
        J.seed_map_teams(spark, root, "r2")
    dfs_workbook(os.path.join(landing, "d.xlsx"), DFS_HEADER, [dfs_row(1, "A", "2025-11-01", 1.0, team="Unknown Squad")])
    J.ingest_fantasy_logs(spark, root, landing, "r1")
    with pytest.raises(R.SeedRefused):
        J.seed_map_teams(spark, root, "r3", force=True)
    assert sinks.read_table(spark, root, "map_teams").count() == 30
    assert J.dropped_rows(spark, root) == ["unmapped teams: ['Unknown Squad']"]


def test_two_segment_columns_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "A_DATASET int, B_DATASET int")
    with pytest.raises(ValueError):
        CF.rename_and_drop(df, {})


def test_no_checkpoint_folder_on_a_cluster(spark, monkeypatch):
    from courtside import session

    class Conf:
        def get(self, *a):
            return None

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Fake())


def test_id_policies(spark):
    df = spark.createDataFrame([("1",), (None,), ("2.0",)], "PLAYER_ID string")
    ok, bad = CF.normalize_ids(df, ["PLAYER_ID"], policy="drop_missing")
    assert sorted(r[0] for r in ok.collect()) == [1, 2] and bad.count() == 1
    with pytest.raises(CF.IdError):
        CF.normalize_ids(df, ["PLAYER_ID"], policy="strict")
    with pytest.raises(CF.IdError):
        CF.normalize_ids(spark.createDataFrame([("x",)], "PLAYER_ID string"), ["PLAYER_ID"], policy="drop_missing")


def test_measures_are_observed_on_the_staging_write(spark):
    df = spark.range(10).withColumn("s", F.when(F.col("id") < 4, F.concat(F.lit("s"), (F.col("id") % 2).cast("string"))))
    out, seen = stage_observed(df, rows=F.count(F.lit(1)), kinds=F.collect_set("s"), none=F.count(F.when(F.col("s").isNull(), 1)))
    assert out.count() == 10 and (seen["rows"], sorted(seen["kinds"]), seen["none"]) == (10, ["s0", "s1"], 6)
    out, seen = stage_observed(df.where("id < 0"), rows=F.count(F.lit(1)), kinds=F.collect_set("s"))
    assert out.count() == 0 and (seen["rows"], list(seen["kinds"])) == (0, [])


def test_stored_keys_are_met_where_they_are_scanned(spark, tmp_dir):
    day = F.lit("2025-11-01").cast("date")
    spark.range(1000).select(F.col("id").alias("PLAYER_ID"), day.alias("DATE"), F.lit("x").alias("v")).write.parquet(f"{tmp_dir}/stored")
    stored = spark.read.parquet(f"{tmp_dir}/stored")
    batch, _ = stage_observed(spark.range(990, 1010).union(spark.createDataFrame([(None,), (995,)], "id long"))
                              .select(F.col("id").alias("PLAYER_ID"), day.alias("DATE")), n=F.count(F.lit(1)))
    among = I.stored_among(batch, stored)
    assert sorted(r.PLAYER_ID for r in among.collect()) == list(range(990, 1000))
    plan = among._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan parquet")   # the streamed side comes first: the stored rows
    assert "BroadcastHashJoin" in plan[:scan] and "Exchange" not in plan[:scan]
    marked = {r.PLAYER_ID: r.m for r in I.mark_stored(batch.distinct(), among, "m").collect()}
    assert marked == {None: False, **{i: i < 1000 for i in range(990, 1010)}}
    assert I.stored_among(batch, None) is None and not I.mark_stored(batch, None, "m").where("m").count()


def test_a_large_batch_leaves_the_stored_side_to_the_planner(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(I, "DIM_BROADCAST_BYTES", 0)
    keys = spark.createDataFrame([(1, "a"), (2, "b")], "PLAYER_ID long, DATE string")
    assert sorted(r.PLAYER_ID for r in I.stored_among(keys.limit(1), keys).collect()) == [1, 2]


def test_counts_leave_out_files_that_are_rejected(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "box")
    box_workbook(os.path.join(landing, "a.xlsx"), [[1, 1, "A", "2025-11-01", "n/a"], [1, None, "N", "2025-11-01", 1]],
                 [["2025-11-01", 1, "T", "O", 1, "A", "DNP", "rest"], ["2025-11-01", 1, "T", "O", 8, "H", "DNP", "rest"]])
    box_workbook(os.path.join(landing, "b.xlsx"), [[1, 4, "D", "2025-11-01", "x"], [1, 4, "D", "2025-11-01", "y"]])
    box_workbook(os.path.join(landing, "c.xlsx"), [[1, 5, "E", "someday", "x"], [1, None, "N", "2025-11-01", 1]])
    got = J.ingest_box_scores(spark, root, landing, "r1")
    assert (got.rows_added, got.members_added, got.dropped_missing_ids, got.bad_cells) == (1, 1, 1, {"PTS": 1})
    assert (got.absences_inserted, got.absence_conflicts) == (1, 1) and sorted(got.rejected) == ["b.xlsx", "c.xlsx"]


def test_the_newest_delivery_of_a_feed_is_taken(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "box")
    box_workbook(os.path.join(landing, "box-z.xlsx"), [[1, 1, "A", "2025-11-01", 1]])
    time.sleep(0.05)
    box_workbook(os.path.join(landing, "box-a.xlsx"), [[1, 1, "A", "2025-11-01", 1], [2, 1, "A", "2025-11-02", 2]])
    time.sleep(0.05)
    box_workbook(os.path.join(landing, "other.xlsx"), [[3, 9, "Z", "2025-11-03", 3]])
    assert J.ingest_box_scores(spark, root, landing, "r1", latest="box").files == ["box-a.xlsx"]
    assert J.ingest_box_scores(spark, root, landing, "r2", latest="box").files == []
    assert log(spark, root, "player_logs", "PLAYER_ID", "PTS") == [(1, 1.0), (1, 2.0)]


def _staged(spark):
    return {f for f in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if f.startswith("stage-")}


def _new_shuffles(spark, before):
    """Shuffle files that weren't there before and don't go (they are removed in the background)."""
    for _ in range(50):
        left = _shuffles(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def _shuffles(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for i in range(blocks.size()) if (name := blocks.apply(i).name()).startswith("shuffle_")}


def test_staged_files_and_shuffles_go_when_nothing_reads_them(spark, tmp_dir):
    before, shuffles = _staged(spark), _shuffles(spark)
    a, b = stage(spark.range(100).repartition(3)), stage(spark.range(5).withColumnRenamed("id", "n"))
    assert not _new_shuffles(spark, shuffles)
    spark.range(3).write.parquet(os.path.join(tmp_dir, "stage-" + "0" * 32))
    own = spark.read.parquet(os.path.join(tmp_dir, "stage-" + "0" * 32))
    assert a.count() == 100 and len(_staged(spark) - before) == 2
    discard(a.join(b, a.id == b.n).join(own, "id"))   # all that the frame reads, but only what was staged
    assert _staged(spark) == before and own.count() == 3
    discard(a, own)
    assert own.count() == 3


def test_loads_leave_nothing_staged(spark, tmp_dir):
    """What a load staged goes with it, whether it adds rows, rejects files or adds nothing."""
    root, before = os.path.join(tmp_dir, "store"), _staged(spark)
    dfs, box = os.path.join(tmp_dir, "dfs"), os.path.join(tmp_dir, "box")
    dfs_workbook(os.path.join(dfs, "d1.xlsx"), DFS_HEADER, [dfs_row(1, "A", "2025-11-01", 10.0), dfs_row(2, "B", "2025-11-01", 20.0)])
    write_csv(os.path.join(box, "a.csv"), [["GAME-ID", "PLAYER-ID", "PLAYER FULL NAME", "DATE", "PTS"], [22500001, 1, "A", "2025-11-01", 30]])
    box_workbook(os.path.join(box, "b.xlsx"), [[22500001, 2, "B", "2025-11-01", 30], [22500001, 2, "B", "2025-11-01", 3]])
    assert J.ingest_fantasy_logs(spark, root, dfs, "r1").rows_added == 2
    done = J.ingest_box_scores(spark, root, box, "r1")
    assert (done.rows_added, list(done.rejected)) == (1, ["b.xlsx"])
    assert J.ingest_box_scores(spark, root, box, "r2").rows_added == 0
    assert _staged(spark) == before
    assert log(spark, root, "player_logs", "PLAYER_ID") == [(1,)]
