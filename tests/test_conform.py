import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtside.functions import columns as C
from courtside.operators import conform as CF
from courtside.operators import repair as R
from tests.conftest import rows


def test_header_sanitise_variants(spark):
    cells = spark.createDataFrame(
        [("f", 0, "OWN\nTEAM"), ("f", 1, "GAME-ID"), ("f", 2, "DRAFTKINGS"), ("f", 3, "DRAFTKINGS"),
         ("f", 4, "USAGE (RATE)"), ("g", 0, "DRAFTKINGS")], "_file_name string, pos long, raw string")
    dfs = {(r._file_name, r.pos): r.name for r in CF.header_map(cells, hyphen_to_underscore=False).collect()}
    assert dfs[("f", 0)] == "OWN_TEAM" and dfs[("f", 1)] == "GAMEID"
    assert dfs[("f", 2)] == "DRAFTKINGS" and dfs[("f", 3)] == "DRAFTKINGS1" and dfs[("g", 0)] == "DRAFTKINGS"
    assert dfs[("f", 4)] == "USAGE_RATE"
    box = {(r._file_name, r.pos): r.name for r in CF.header_map(cells, hyphen_to_underscore=True).collect()}
    assert box[("f", 1)] == "GAME_ID"


def test_dates_free_text_and_rejects(spark):
    df = spark.createDataFrame([("November 1, 2025",), ("2025-11-01",), ("11/1/2025",), ("45962",), ("junk",), (None,)], "DATE string")
    ok, bad = CF.normalize_dates(df)
    assert sorted(r.DATE for r in ok.collect() if r.DATE) == [dt.date(2025, 11, 1)] * 4
    assert [r.DATE for r in bad.collect()] == ["junk"]


def test_ids_missing_fractional_non_numeric(spark):
    df = spark.createDataFrame([("12345.0",), ("12345.7",), (None,), ("abc",), (" 7 ",)], "PLAYER_ID string")
    ok, bad = CF.normalize_ids(df, ["PLAYER_ID"])
    assert sorted(r.PLAYER_ID for r in ok.collect()) == [7, 12345]
    assert sorted(r.reject_reason for r in bad.collect()) == ["PLAYER_ID:fractional", "PLAYER_ID:missing", "PLAYER_ID:non_numeric"]


def test_ids_keep_64_bits_and_odd_text(spark):
    cells = ["9223372036854775807", "-9223372036854775808", "9223372036854775808", "1e5", "\u00a0 7\t", "1.0000", "1" * 40, "",
             " ", "0x1", "NaN", "7.000000001", "+8", "1_0", "9007199254740993.0"]
    df = C.once(spark.createDataFrame([(c,) for c in cells], "c string"), CF.typed_id("c"), "t").select("c", "t.*")
    got = {r.c: (r.reason, r.value) for r in df.collect()}
    assert got["9223372036854775807"] == ("ok", 2 ** 63 - 1) and got["-9223372036854775808"] == ("ok", -2 ** 63)
    assert got["9007199254740993.0"] == ("ok", 2 ** 53 + 1) and got["1e5"] == ("ok", 100_000) and got["+8"] == ("ok", 8)
    assert got["\u00a0 7\t"] == ("ok", 7) and got["1.0000"] == ("ok", 1) and got["7.000000001"] == ("fractional", None)
    assert {k for k, v in got.items() if v[0] == "missing"} == {"", " "}
    assert {k for k, v in got.items() if v[0] == "non_numeric"} == {"9223372036854775808", "1" * 40, "0x1", "NaN", "1_0"}


def test_cells_are_typed_once(spark):
    """Reason, value and filter come from one evaluation of every cell."""
    df = spark.createDataFrame([("1", "2", "2025-11-01")], "PLAYER_ID string, GAME_ID string, DATE string")
    dated = CF.normalize_dates(CF.normalize_ids(df)[0])[0]
    plan = dated._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(lambda x") <= 8 and plan.count("yyyy/M/d") == 1 and plan.count("regexp_replace") == 0
    assert rows(dated) == [(1, 2, dt.date(2025, 11, 1))]


def test_migrate_id_types(spark):
    df = spark.createDataFrame([(12345.0, 22500001.0), (None, 1.0)], "PLAYER_ID double, GAME_ID double")
    out, dropped = R.migrate_id_types(df)
    assert rows(out) == [(12345, 22500001)] and dropped == 1
    again, n = R.migrate_id_types(out)
    assert again is out and n == 0
    with pytest.raises(R.MigrationError):
        R.migrate_id_types(spark.createDataFrame([(12345.7, 1.0)], "PLAYER_ID double, GAME_ID double"))


def test_rename_migration_idempotent(spark):
    df = spark.createDataFrame([("2025-11-01", "x")], "GAME_DATE string, PLAYER_NAME string")
    once = R.rename_columns(df, {"GAME_DATE": "DATE", "PLAYER_NAME": "PLAYER"})
    assert once.columns == ["DATE", "PLAYER"]
    assert R.rename_columns(once, {"GAME_DATE": "DATE", "PLAYER_NAME": "PLAYER"}).columns == ["DATE", "PLAYER"]
    with pytest.raises(R.MigrationError):
        R.rename_columns(df.withColumn("DATE", F.lit(1)), {"GAME_DATE": "DATE"})


def test_names_standardised_and_reported(spark):
    df = spark.createDataFrame([("GG Jackson",), ("LeBron James",), ("GG Jackson",)], "PLAYER string")
    assert sorted(r.PLAYER for r in CF.standardize_names(df).collect()) == ["Gregory Jackson", "Gregory Jackson", "LeBron James"]
    rep = CF.names_changed(df).collect()
    assert [(r.FROM_NAME, r.TO_NAME, r.row_count) for r in rep] == [("GG Jackson", "Gregory Jackson", 2)]
    m = CF.name_map_frame(spark, {"GG Jackson": "Gregory Jackson"})
    assert sorted(r.PLAYER for r in CF.standardize_names(df, name_map_df=m).collect())[0] == "Gregory Jackson"


def test_absence_type_variants(spark):
    df = spark.createDataFrame([("COACH'S DECISION",), ("Coach's Decision ",), ("\tcoach's decision\n",), ("REST",), ("INJURY/ILLNESS",), (None,)], "REASON string")
    got = [r.ABSENCE_TYPE for r in CF.classify_absence(df).collect()]
    assert got == ["DNP-CD", "DNP-CD", "DNP-CD", "INJURY/ILLNESS/OTHER", "INJURY/ILLNESS/OTHER", "INJURY/ILLNESS/OTHER"]


def test_team_seed_prefers_first_source_and_fails_on_unknown(spark):
    fl = spark.createDataFrame([("  Golden   State ",), (None,), ("Boston",)], "TEAM string")
    pl = spark.createDataFrame([("Unknown Squad",)], "TEAM string")
    mapped, unmapped = CF.seed_team_map([fl, pl], CF.team_spellings(spark))
    assert rows(mapped) == [("  Golden   State ", "GSW"), ("Boston", "BOS")]
    assert unmapped.count() == 0
    empty = spark.createDataFrame([], "TEAM string")
    mapped2, unmapped2 = CF.seed_team_map([empty, pl], CF.team_spellings(spark))
    assert [r[0] for r in unmapped2.collect()] == ["Unknown Squad"]
    with pytest.raises(R.SeedRefused):
        R.check_seed(0, ["Unknown Squad"])
    with pytest.raises(R.SeedRefused):
        R.check_seed(30, [])
    R.check_seed(30, [], force=True)


def test_canonical_team_list_size():
    from courtside.functions.constants import TEAM_ABBREVIATIONS
    assert len(TEAM_ABBREVIATIONS) == 62 and len(set(TEAM_ABBREVIATIONS.values())) == 30


def test_strip_ws_covers_all_whitespace(spark):
    df = spark.createDataFrame([("\t a b \n",)], "s string")
    assert df.select(C.strip_ws("s")).collect()[0][0] == "a b"
