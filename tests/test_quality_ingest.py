import datetime as dt

import pytest

from courtside.operators import ingest as I
from courtside.operators import quality as Q
from tests.conftest import rows

D1, D2, D3 = dt.date(2025, 11, 1), dt.date(2025, 11, 2), dt.date(2025, 11, 3)
PL = "PLAYER_ID long, PLAYER string, DATE date, PTS long"


def player_logs(spark):
    # 6 rows, 4 keys, 4 distinct full rows (two exact duplicates)
    data = [(1, "A", D1, 30), (1, "A", D1, 30), (2, "B", D1, 10), (2, "B", D1, 10), (3, "C", D2, 5), (4, "D", D3, 7)]
    return spark.createDataFrame(data, PL)


def test_duplicate_stats(spark):
    r = Q.duplicate_stats(player_logs(spark)).collect()[0]
    assert (r.total_rows, r.distinct_keys, r.distinct_full_rows, r.extra_rows) == (6, 4, 4, 2)


def test_duplicate_stats_null_keys_not_counted(spark):
    df = spark.createDataFrame([(None, "A", D1, 1), (None, "A", D1, 1), (1, "A", None, 2)], PL)
    r = Q.duplicate_stats(df).collect()[0]
    assert (r.total_rows, r.distinct_keys, r.distinct_full_rows) == (3, 0, 2)


def test_duplicate_groups_and_verdict(spark):
    df = player_logs(spark).unionByName(spark.createDataFrame([(1, "A", D1, 35)], PL))
    g = rows(Q.duplicate_groups(df, top=20), "PLAYER_ID", "copies")
    assert g == [(1, 3), (2, 2)]
    v = {r.PLAYER_ID: (r.copies, r.variants, r.exact_copies) for r in Q.duplicate_verdict(df).collect()}
    assert v == {1: (3, 2, False), 2: (2, 1, True)}


def test_keep_earliest_copy(spark):
    df = spark.createDataFrame([(1, "A", D1, 30, 0), (1, "A", D1, 35, 1), (2, "B", D1, 10, 2)],
                               PL + ", _ingest_seq long")
    out = rows(Q.remove_duplicates(df), "PLAYER_ID", "PTS")
    assert out == [(1, 30), (2, 10)]
    Q.assert_unique(Q.remove_duplicates(df))
    with pytest.raises(Q.DuplicateKeyError):
        Q.assert_unique(df)


def feed(spark, data):
    return spark.createDataFrame(data, PL + ", _file_name string, _row_no long")


def test_cumulative_files_one_run(spark):
    f1 = [(1, "A", D1, 30, "f1.csv", 0), (2, "B", D1, 10, "f1.csv", 1)]
    f2 = [(1, "A", D1, 30, "f2.csv", 0), (2, "B", D1, 10, "f2.csv", 1), (1, "A", D2, 20, "f2.csv", 2)]
    out = I.new_rows(feed(spark, f1 + f2), None)
    assert out.count() == 3
    assert rows(out, "PLAYER_ID", "DATE", "_file_name") == [(1, D1, "f1.csv"), (1, D2, "f2.csv"), (2, D1, "f1.csv")]


def test_rerun_adds_nothing(spark):
    b = feed(spark, [(1, "A", D1, 30, "f1.csv", 0)])
    stored = I.new_rows(b, None)
    assert I.new_rows(b, stored).count() == 0


def test_within_file_duplicate_rejected(spark):
    b = feed(spark, [(1, "A", D1, 30, "f1.csv", 0), (1, "A", D1, 31, "f1.csv", 1)])
    with pytest.raises(Q.DuplicateKeyError):
        I.check_within_file(b)
    assert I.check_within_file(b, policy="keep_first") is b


def test_learn_members_first_seen_name_and_known_ids(spark):
    b = feed(spark, [(7, "Later Name", D2, 1, "f2.csv", 0), (7, "First Name", D1, 1, "f1.csv", 5),
                     (8, "Known", D1, 1, "f1.csv", 1)])
    dim = spark.createDataFrame([(8, "Stored")], "PLAYER_ID long, PLAYER_NAME string")
    assert rows(I.learn_members(b, dim)) == [(7, "First Name")]


def test_box_score_wins(spark):
    box = spark.createDataFrame([(50, D1)], "PLAYER_ID long, DATE date")
    ab = spark.createDataFrame([(50, D1, "DNP"), (60, D1, "DNP")], "PLAYER_ID long, DATE date, STATUS string")
    assert rows(I.drop_conflicts(ab, box), "PLAYER_ID") == [(60,)]
    assert Q.absence_overlap(ab, box).collect()[0][0] == 1


def test_same_game_counts_and_season_attribution(spark):
    ab = spark.createDataFrame([(99, 22500001)], "PLAYER_ID long, GAME_ID long")
    logs = spark.createDataFrame([(1, 22500001, "2025-26 NBA Regular Season"), (2, 22500001, "2025-26 NBA Regular Season")],
                                 "PLAYER_ID long, GAME_ID long, SEASON_SEGMENT string")
    assert Q.same_game_counts(ab, logs).collect()[0].box_rows_same_game == 2
    r = Q.season_of_absence(ab, logs).collect()[0]
    assert (r.SEASON_SEGMENT, r.segments_for_game) == ("2025-26 NBA Regular Season", 1)


def test_first_by_key_hot_key_is_aggregated_not_windowed(spark):
    df = spark.range(0, 5000).selectExpr("1L AS PLAYER_ID", "DATE '2025-11-01' AS DATE", "id AS _row_no",
                                         "CAST(id AS STRING) AS X")
    out = Q.first_by_key(df, ["PLAYER_ID", "DATE"], ["_row_no"])
    assert out.collect()[0]._row_no == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_season_of_absence_gives_one_row_each(spark):
    logs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c"), (3, None)], "GAME_ID long, SEASON_SEGMENT string")
    ab = spark.createDataFrame([(9, 1), (8, 2), (7, 3)], "PLAYER_ID long, GAME_ID long")
    got = sorted((r.PLAYER_ID, r.SEASON_SEGMENT, r.segments_for_game) for r in Q.season_of_absence(ab, logs).collect())
    assert got == [(7, None, None), (8, "c", 1), (9, "a", 2)]
    with pytest.raises(Q.AmbiguousSegmentError):
        Q.season_of_absence(ab, logs, strict=True)
