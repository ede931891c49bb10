import os
import time

from pyspark.sql import functions as F

from courtside.operators import conform as CF
from courtside.sources import feeds as FD
from courtside.sources.feeds import UNREADABLE
from tests.helpers import box_workbook, write_csv


def test_latest_file_per_feed_skips_processed(spark, tmp_dir):
    d = os.path.join(tmp_dir, "drop")
    write_csv(os.path.join(d, "dfs_logs_old.csv"), [["a"], [1]])
    time.sleep(1.1)
    write_csv(os.path.join(d, "dfs_logs_new.csv"), [["a"], [2]])
    write_csv(os.path.join(d, "box_scores_1.csv"), [["a"], [3]])
    listing = FD.file_listing(spark, d)
    latest = {r.feed: r._file_name for r in FD.latest_per_feed(listing, {"dfs": "dfs_logs", "box": "box_scores"}).collect()}
    assert latest == {"dfs": "dfs_logs_new.csv", "box": "box_scores_1.csv"}
    manifest = spark.createDataFrame([("box_scores_1.csv",)], "_file_name string")
    left = [r.feed for r in FD.latest_per_feed(listing, {"dfs": "dfs_logs", "box": "box_scores"}, manifest).collect()]
    assert left == ["dfs"]


def test_sheet_presence(spark, tmp_dir):
    d = os.path.join(tmp_dir, "wb")
    box_workbook(os.path.join(d, "with.xlsx"), [[1, 1, "A", "2025-11-01", 3]], [["2025-11-01", 1, "H", "D", 9, "B", "DNP", "REST"]])
    box_workbook(os.path.join(d, "without.xlsx"), [[1, 1, "A", "2025-11-01", 3]], None)
    rows = FD.read_feed_rows(spark, d)
    files = rows.select("_file_name").distinct()
    found = {r._file_name: r.found for r in FD.sheet_presence(rows, files, "DNP-DND-NWT").collect()}
    assert found == {"with.xlsx": True, "without.xlsx": False}


def test_header_collisions_reported(spark):
    cells = spark.createDataFrame([("f", 0, "USAGE RATE"), ("f", 1, "USAGE-RATE")], "_file_name string, pos long, raw string")
    hm = CF.header_map(cells, hyphen_to_underscore=True)
    bad = CF.header_collisions(hm).collect()
    assert len(bad) == 1 and bad[0].name == "USAGE_RATE"


def test_segment_column_found_by_suffix(spark):
    df = spark.createDataFrame([("2024-25 NBA Regular Season", "x")], "ACME_DATASET string, OWN_TEAM string")
    out = CF.rename_and_drop(df, {"OWN_TEAM": "TEAM"})
    assert out.columns == ["SEASON_SEGMENT", "TEAM"]


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _rows(df):
    return sorted((r._file_name, r._row_no, tuple(r.cells)) for r in df.collect() if r._sheet != UNREADABLE)


def test_large_csv_is_read_in_several_tasks_with_the_same_row_numbers(spark, tmp_dir):
    d = os.path.join(tmp_dir, "big")
    lines = [f'{i},"name, {i}",{"x" * (i % 40)}' for i in range(20_000)]
    lines[5] = ""
    lines[77] = 'a "stray" quote,b""c,'
    _write(os.path.join(d, "a.csv"), ("\ufeff" + "\r\n".join(lines)).encode())
    _write(os.path.join(d, "b.csv"), "\n".join(lines[:50]).encode() + b"\n")
    _write(os.path.join(d, "c.csv"), b"")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert FD.numbered_lines(spark, [os.path.join(d, "a.csv")]).count() == 20_000
        assert spark.read.text(os.path.join(d, "a.csv")).rdd.getNumPartitions() > 4
        got = _rows(FD.read_feed_rows(spark, d))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = _rows(FD.parsed(spark.read.format("binaryFile").load(d)))
    assert got == whole and len(got) == 20_050
    assert got[6][2] == ("6", "name, 6", "xxxxxx")


def test_quoted_cells_over_several_lines_are_kept(spark, tmp_dir):
    d = os.path.join(tmp_dir, "q")
    _write(os.path.join(d, "span.csv"), b'a,b\n1,"two\nlines"\n5" pipe,"x\ny"\n2,z\n')
    _write(os.path.join(d, "plain.csv"), b'a,b\n1,2\n')
    got = _rows(FD.read_feed_rows(spark, d))
    assert got == [("plain.csv", 0, ("a", "b")), ("plain.csv", 1, ("1", "2")), ("span.csv", 0, ("a", "b")),
                   ("span.csv", 1, ("1", "two\nlines")), ("span.csv", 2, ('5" pipe', "x\ny")), ("span.csv", 3, ("2", "z"))]


def test_bytes_of_another_charset_reject_the_file_or_are_decoded(spark, tmp_dir):
    d = os.path.join(tmp_dir, "cs")
    text = "PLAYER_ID,PLAYER\n1,Luka Don\u010di\u0107\n"
    _write(os.path.join(d, "cp.csv"), text.encode("cp1250"))
    _write(os.path.join(d, "ok.csv"), text.encode())
    _write(os.path.join(d, "broken.xlsx"), b"PK\x03\x04 no zip")
    rows = FD.read_feed_rows(spark, d)
    bad = {r._file_name: r.cells[0] for r in rows.where(F.col("_sheet") == UNREADABLE).collect()}
    assert set(bad) == {"cp.csv", "broken.xlsx"} and bad["cp.csv"] == "line 2 is not UTF-8"
    assert _rows(rows.where("_file_name = 'ok.csv'"))[1][2] == ("1", "Luka Don\u010di\u0107")
    decoded = FD.read_feed_rows(spark, os.path.join(d, "cp.csv"), charset="cp1250")
    assert _rows(decoded)[1][2] == ("1", "Luka Don\u010di\u0107")
    whole = FD.parsed(spark.read.format("binaryFile").load(os.path.join(d, "cp.csv"))).collect()
    assert [r._sheet for r in whole] == [UNREADABLE] and "decode" in whole[0].cells[0]


def test_delimited_rows_need_no_python_and_no_shuffle_of_a_file(spark, tmp_dir):
    """Plain lines are split by Spark, quoted ones by the parser; headers are broadcast to the rows, so that
    no file becomes a single task; names of files are read as they are."""
    from courtside.session import stage
    d = os.path.join(tmp_dir, "d")
    os.makedirs(d)
    for name, text in (("a 1+%.csv", '\ufeffA,B\n1,2\n\n"x,y",\n,,\n'), ("b[1].csv", "B,C\r\n5,6\r\n")):
        with open(os.path.join(d, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    paths = [r[0] for r in spark.read.format("binaryFile").load(d).select("path").collect()]
    rows = FD.read_feed_rows(spark, [FD.literal_path(p) for p in paths])
    assert _rows(rows) == _rows(FD.parsed(spark.read.format("binaryFile").load(d)))
    assert "MapInPandas" not in rows._jdf.queryExecution().executedPlan().toString()
    frame = FD.sheet_frame(stage(rows))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(map(tuple, frame.collect()), key=str) == [
        ("a 1+%.csv", 1, "1", "2", None), ("a 1+%.csv", 3, "x,y", None, None), ("b[1].csv", 1, None, "5", "6")]
