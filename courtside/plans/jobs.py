"""Composite jobs (B1-B9): the daily pipeline as a sequence of Spark jobs over a store folder.

Every job is a handful of DataFrame actions; all keyed state lives in the stored tables
(anti joins against them), so re-running a job over the same files adds nothing.
Validation happens before anything is written (within-file duplicates, id problems).
"""

from __future__ import annotations

import datetime as _dt
import traceback
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..session import cut_lineage, discard, stage_observed
from ..functions import columns as C
from ..functions import constants as K
from ..operators import conform as CF
from ..operators import ingest as I
from ..operators import matching as MT
from ..operators import quality as Q
from ..operators import season_state as SS
from ..operators import seasons as S
from ..operators import slate as SL
from ..operators import summary as M
from ..sources import feeds as FD

KEYS = ("PLAYER_ID", "DATE")
BOX_NUMERIC = ("MINUTES", "FG", "FGA", "3P", "3PA", "FT", "FTA", "OREB", "DREB", "TREB", "AST", "PF",
               "STL", "TOV", "BLK", "PTS", "USAGE", "DAYS_REST")
DFS_NUMERIC = ("MINUTES", "USAGE", "DK_SALARY", "DK_POINTS", "DAYS_REST")


class FeedError(RuntimeError):
    pass


@dataclass
class IngestResult:
    files: list[str] = field(default_factory=list)
    overwritten: list[str] = field(default_factory=list)   # names delivered before, with other content
    rejected: dict[str, str] = field(default_factory=dict)  # file -> why none of it was loaded
    rows_added: int = 0
    members_added: int = 0
    dropped_missing_ids: int = 0
    bad_cells: dict[str, int] = field(default_factory=dict)  # numeric column -> cells stored as NULL
    absences_inserted: int = 0
    absence_conflicts: int = 0                               # absences that had a box score
    absence_files_without_sheet: list[str] = field(default_factory=list)
    touched_segments: list[str | None] = field(default_factory=list)


@dataclass(frozen=True)
class Feed:
    """A feed: its main sheet's form, the log that takes its rows, and its numeric columns."""
    name: str
    log: str
    spec: FD.FeedSpec
    numeric: Sequence[str]


BOX = Feed("box", "player_logs", FD.FeedSpec(0, 0, True, K.BOX_RENAMES), BOX_NUMERIC)
DFS = Feed("dfs", "fantasy_logs", FD.FeedSpec(1, 1, False, K.DFS_RENAMES, K.DFS_DROP), DFS_NUMERIC)
ABSENCES = FD.FeedSpec(renames=K.ABSENCE_RENAMES, required=K.ABSENCE_REQUIRED)
LOAD_COLUMNS = ("_load_no", "_file_name", "_row_no")   # insertion order, kept in every log
FATAL = ("non_numeric", "fractional", "unparseable_date")


def _no_numbers(df: DataFrame, cols: Sequence[str], where=None) -> dict:
    """Aggregates by column: cells that are text where a number is due (stored as NULL, reported)."""
    ok = F.lit(True) if where is None else where
    return {c: F.count(F.when(ok & C.blank_to_null(F.col(c)).isNotNull() & F.col(c).try_cast("double").isNull(), 1))
            for c in cols if c in df.columns}


def _numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric columns as double."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols if c in df.columns})


def _pending_files(spark: SparkSession, root: str, feed: str, landing: str, glob: str | None,
                   latest: str | None = None) -> list:
    """Deliveries not loaded yet, by name: (path, name, length, modified); with ``latest``, of the files
    whose name has that text the newest one only (S10).  The listing is metadata."""
    listing = FD.file_listing(spark, landing)
    if glob:
        listing = listing.where(F.col("_file_name").rlike(glob))
    if latest is not None:
        listing = listing.join(FD.latest_per_feed(listing, {feed: latest}).select("path"), "path", "left_semi")
    listing = listing.select("path", "_file_name", "length", F.col("modificationTime").alias("modified"))
    pending = listing.join(sinks.processed_files(spark, root, feed), ["_file_name", "length", "modified"], "left_anti")
    return sorted(pending.collect(), key=lambda r: (r["_file_name"], r["path"]))


def _why_rejected(df: DataFrame, fatal: Sequence[str]) -> dict[str, str]:
    """file -> fatal reasons with their row counts (a row per file and reason)."""
    counts = (df.where(F.col("reject_reason").isNotNull()).groupBy("_file_name", "reject_reason")
                .agg(F.count(F.lit(1)).alias("n")).orderBy("_file_name", "reject_reason").collect())
    why: dict[str, list[str]] = {}
    for r in counts:
        if r["reject_reason"].endswith(tuple(fatal)):
            why.setdefault(r["_file_name"], []).append(f"{r['reject_reason']} ({r['n']} rows)")
    return {f: ", ".join(x) for f, x in why.items()}


def _without(df: DataFrame, rejected: dict[str, str]) -> DataFrame:
    return df.where(~F.col("_file_name").isin(list(rejected))) if rejected else df


def _header_faults(rows: DataFrame, feed: Feed) -> dict[str, str]:
    """Files that cannot be parsed or whose headers collide once sanitised."""
    why = {r["_file_name"]: r["cells"][0] for r in rows.where(F.col("_sheet") == FD.UNREADABLE).collect()}
    hmap = FD.sheet_header(rows, 0, feed.spec.header_row, feed.spec.hyphen_to_underscore)
    for r in CF.header_collisions(hmap).collect():
        why[r["_file_name"]] = f"headers {sorted(r['raws'])} are both {r['name']}"
    return why


@dataclass
class Checked:
    """Rows with typed dates and ids, and what their staging observed."""
    rows: DataFrame
    rejected: dict[str, str]      # file -> why
    missing: int                  # rows dropped for a missing id
    bad_cells: dict[str, int]
    months: list[str | None]      # months of the rows' dates: the only ones whose stored keys are read


def _checked(df: DataFrame, id_cols: Sequence[str], fatal: Sequence[str], numeric: Sequence[str] = ()) -> Checked:
    """C7 + C8 with per-file isolation.  Everything is counted by the write that stages the rows; only
    where files have to be left out are the others' rows counted again."""
    tagged = CF.with_parsed_date(df, "DATE", out="_parsed")
    dates = F.col("reject_reason")
    tagged = tagged.withColumn("_date_reason", F.when(dates.isNotNull(), F.concat(F.lit("DATE:"), dates)))
    tagged = CF.with_typed_ids(tagged.drop("reject_reason"), id_cols)
    tagged = tagged.withColumn("reject_reason", F.coalesce("_date_reason", "reject_reason"))
    reason, good = F.col("reject_reason"), F.col("reject_reason").isNull()
    is_fatal = F.lit(False)
    for f in fatal:
        is_fatal = is_fatal | reason.endswith(f)
    cells = {f"cells:{c}": n for c, n in _no_numbers(tagged, numeric, good).items()}
    tagged, seen = stage_observed(tagged, fatal=F.count(F.when(is_fatal, 1)),
                                  missing=F.count(F.when(reason.endswith("missing"), 1)),
                                  months=F.collect_set(F.when(good, sinks.month(F.col("_parsed")))),
                                  undated=F.count(F.when(good & F.col("_parsed").isNull(), 1)), **cells)
    rejected = _why_rejected(tagged, fatal) if seen["fatal"] else {}
    kept = _without(tagged, rejected)
    missing = kept.where(reason.endswith("missing")).count() if rejected else seen["missing"]
    out = kept.where(good).withColumn("DATE", F.col("_parsed"))
    bad = _bad_cells(out, numeric) if rejected else {c.removeprefix("cells:"): seen[c] for c in cells if seen[c]}
    for c in id_cols:
        if c in out.columns:
            out = out.withColumn(c, F.col(f"_ids.{c}.value"))
    return Checked(out.drop("_parsed", "_date_reason", "reject_reason", "_ids"), rejected, missing, bad,
                   [*seen["months"], *([None] if seen["undated"] else [])])


def _bad_cells(df: DataFrame, numeric: Sequence[str]) -> dict[str, int]:
    counts = [n.alias(c) for c, n in _no_numbers(df, numeric).items()]
    return {c: n for c, n in df.agg(*counts).first().asDict().items() if n} if counts else {}


def _repeated_within(df: DataFrame, policy: str) -> dict[str, str]:
    """D3 per file: files that repeat a key (policy 'error'); none under 'keep_first'."""
    if policy not in ("error", "keep_first"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "keep_first":
        return {}
    bad = (Q.within_file_duplicates(df, KEYS).groupBy("_file_name")
           .agg(F.count(F.lit(1)).alias("n")).collect())
    return {r["_file_name"]: f"{r['n']} keys occur more than once" for r in bad}


def _load(spark: SparkSession, root: str, rows: DataFrame, feed: Feed, load_no: int, policy: str,
          res: IngestResult) -> None:
    """The main sheet of parsed files into the feed's log and the player dimension.  Everything is
    derived and checked before the first write; a file that fails is left out whole."""
    res.rejected |= _header_faults(rows, feed)
    df = FD.apply_feed_spec(_without(rows, res.rejected), feed.spec)
    if feed is DFS and "SEASON_SEGMENT" not in df.columns:
        df = df.withColumn("SEASON_SEGMENT", F.lit(None).cast("string"))
    if not {*KEYS, "PLAYER"} <= set(df.columns):   # no file has the columns
        for f in _files_of(rows):
            res.rejected.setdefault(f, f"columns {[c for c in (*KEYS, 'PLAYER') if c not in df.columns]} are missing")
        return
    df = CF.standardize_names(df, "PLAYER")
    checked = _checked(df, ["PLAYER_ID", "GAME_ID"], FATAL, feed.numeric)
    if feed is not BOX:   # a box workbook's absence sheet is read later
        discard(rows)
    df, res.dropped_missing_ids, months = checked.rows, checked.missing, checked.months
    res.rejected |= checked.rejected
    why = _repeated_within(df, policy)
    res.rejected |= why
    df = _without(df, why)
    res.bad_cells = _bad_cells(df, feed.numeric) if why else checked.bad_cells
    df = _numeric(df, feed.numeric)
    stored = sinks.read_log(spark, root, feed.log, months=months)
    fresh = I.new_rows(df, I.stored_among(df, stored)).withColumn("_load_no", F.lit(load_no).cast("long"))
    # staged: both writes below see the same rows even if executors are lost, and the plan of the
    # writes starts from stored data
    segment = F.col("SEASON_SEGMENT") if "SEASON_SEGMENT" in fresh.columns else F.lit(None).cast("string")
    fresh, added = stage_observed(fresh, rows=F.count(F.lit(1)), segments=F.collect_set(segment),
                                  without=F.count(F.when(segment.isNull(), 1)))
    discard(df)
    members, learned = stage_observed(I.learn_members(fresh, sinks.read_log(spark, root, "dim_players")),
                                      rows=F.count(F.lit(1)))
    res.members_added, res.rows_added = learned["rows"], added["rows"]
    if res.members_added:
        sinks.append_log(members, root, "dim_players")
    if res.rows_added:
        sinks.append_log(fresh, root, feed.log)
    discard(fresh, members)
    if res.rows_added:
        Q.assert_unique(sinks.read_log(spark, root, feed.log, months=months), KEYS)   # M3
        if "SEASON_SEGMENT" in fresh.columns:
            res.touched_segments = [*added["segments"], *([None] if added["without"] else [])]


def _files_of(rows: DataFrame) -> list[str]:
    return sorted(r[0] for r in rows.select("_file_name").distinct().collect())


def load_rows(spark: SparkSession, root: str, rows: DataFrame, feed: Feed, files: Sequence, run_id: str,
              duplicate_policy: str = "error") -> IngestResult:
    """Parsed rows of deliveries ``files`` (name, length, modified) into the logs (B1/B2, B3); staged
    rows go once they are loaded."""
    res = IngestResult()
    load_no = sinks.next_load(spark, root)
    before = {r["_file_name"] for r in sinks.processed_files(spark, root, feed.name).select("_file_name").distinct()
              .join(F.broadcast(spark.createDataFrame([(f["_file_name"],) for f in files], "_file_name string")),
                    "_file_name", "left_semi").collect()}
    _load(spark, root, rows, feed, load_no, duplicate_policy, res)
    res.files = [f["_file_name"] for f in files if f["_file_name"] not in res.rejected]
    if feed is BOX and res.files:
        absences = ingest_absences(spark, root, _without(rows, res.rejected), res.files, load_no)
        res.absences_inserted, res.absence_files_without_sheet = absences.inserted, absences.without_sheet
        res.absence_conflicts = absences.conflicts
        res.rejected |= absences.rejected
        res.files = [f for f in res.files if f not in absences.rejected]
    discard(rows)
    res.overwritten = [f for f in res.files if f in before]
    sinks.record_files(spark, root, [(f["_file_name"], feed.name, run_id, "ok", None, f["length"], f["modified"], load_no)
                                     for f in files if f["_file_name"] in res.files])
    sinks.record_rejected(spark, root, feed.name, run_id, files, res.rejected)
    return res


def _ingest(spark: SparkSession, root: str, landing: str, run_id: str, feed: Feed, glob: str | None,
            policy: str, latest: str | None = None) -> IngestResult:
    files = _pending_files(spark, root, feed.name, landing, glob, latest)
    if not files:
        return IngestResult()
    # every file is parsed once: all checks and both sheets read the staged rows
    rows = FD.staged_feed_rows(spark, [FD.literal_path(f["path"]) for f in files])
    return load_rows(spark, root, rows, feed, files, run_id, policy)


def ingest_box_scores(spark: SparkSession, root: str, landing: str, run_id: str,
                      glob: str | None = r"\.(xlsx|csv)$", duplicate_policy: str = "error",
                      latest: str | None = None) -> IngestResult:
    """B1 (+B3 for the absence sheet of the same workbooks)."""
    return _ingest(spark, root, landing, run_id, BOX, glob, duplicate_policy, latest)


@dataclass
class AbsenceResult:
    inserted: int = 0
    conflicts: int = 0
    without_sheet: list[str] = field(default_factory=list)
    rejected: dict[str, str] = field(default_factory=dict)


def ingest_absences(spark: SparkSession, root: str, rows: DataFrame, files: Sequence[str],
                    load_no: int | None = None) -> AbsenceResult:
    """Absence sheet -> player_absences (box score wins, first copy per key, new keys only)."""
    res = AbsenceResult()
    if load_no is None:
        load_no = sinks.next_load(spark, root)
    present = {r["_file_name"] for r in rows.where(F.col("_sheet") == K.ABSENCE_SHEET)
               .select("_file_name").distinct().collect()}
    res.without_sheet = [f for f in files if f not in present]
    if not present:
        return res
    ab = CF.standardize_names(FD.apply_feed_spec(rows, ABSENCES, K.ABSENCE_SHEET), "PLAYER")
    checked = _checked(ab, ["PLAYER_ID", "GAME_ID"], (*FATAL, "missing"))
    res.rejected, months = checked.rejected, checked.months
    ab = CF.classify_absence(checked.rows)
    marked = Q.first_by_key(ab, list(KEYS), ["_file_name", "_row_no"])      # D4 within this run
    for log, mark in (("player_logs", "_played"), ("player_absences", "_known")):   # J4, J3
        marked = I.mark_stored(marked, I.stored_among(ab, sinks.read_log(spark, root, log, months=months)), mark)
    free = ~F.col("_played") & ~F.col("_known")
    marked, seen = stage_observed(marked, conflicts=F.count(F.when(F.col("_played"), 1)), inserted=F.count(F.when(free, 1)))
    res.conflicts, res.inserted = seen["conflicts"], seen["inserted"]
    out = (marked.where(free).withColumn("_load_no", F.lit(load_no).cast("long"))
           .select(*K.ABSENCE_COLUMNS, *LOAD_COLUMNS))
    if res.inserted:
        members = cut_lineage(I.learn_members(out.select("PLAYER_ID", "PLAYER", "_file_name", "_row_no"),
                                              sinks.read_log(spark, root, "dim_players")))
        sinks.append_log(members, root, "dim_players")
        sinks.append_log(out, root, "player_absences")
        Q.assert_unique(sinks.read_log(spark, root, "player_absences", months=months), KEYS)
    discard(ab, marked)
    return res


def ingest_fantasy_logs(spark: SparkSession, root: str, landing: str, run_id: str,
                        glob: str | None = r"\.(xlsx|csv)$", duplicate_policy: str = "error",
                        latest: str | None = None) -> IngestResult:
    """B2: DFS feed (header on the second row, the row after it discarded, hyphens stripped)."""
    return _ingest(spark, root, landing, run_id, DFS, glob, duplicate_policy, latest)


def seed_map_teams(spark: SparkSession, root: str, run_id: str, force: bool = False,
                   spellings: DataFrame | None = None) -> DataFrame:
    """M8: team dimension from the data (fantasy logs first, then box scores); the canonical teams
    while no log holds a team name.  ``spellings`` (SPELLING, TEAM_ABBREVIATION) default to the known ones."""
    from ..operators.repair import check_seed
    sources = [t for t in (sinks.read_log(spark, root, "fantasy_logs"), sinks.read_log(spark, root, "player_logs"))
               if t is not None and "TEAM" in t.columns]
    canonical = spark.createDataFrame([(t,) for t in K.CANONICAL_TEAMS], "TEAM string")
    mapped, unmapped = CF.seed_team_map([*sources, canonical], CF.team_spellings(spark) if spellings is None else spellings)
    mapped = cut_lineage(mapped)   # a row per distinct raw name
    existing = sinks.read_table(spark, root, "map_teams")
    check_seed(existing.count() if existing is not None else 0,
               [r[0] for r in mapped.where(F.col("TEAM_ABBREVIATION").isNull()).collect()], force)
    sinks.publish(mapped, root, "map_teams", run_id, keys=("RAW_TEAM_NAME",))
    return mapped


AVERAGES_KEYS = ("SEASON_TYPE", "PLAYER_ID", "SEASON", "TEAM")


def segment_dates(logs: DataFrame) -> DataFrame:
    """(SEASON_SEGMENT, last_game, last_load, unnumbered): a row per segment (tens of values);
    ``unnumbered`` counts rows that were stored without a load number."""
    load = F.col("_load_no") if "_load_no" in logs.columns else F.lit(None).cast("long")
    return logs.groupBy("SEASON_SEGMENT").agg(F.max("DATE").alias("last_game"), F.max(load).alias("last_load"),
                                              F.count(F.when(load.isNull(), 1)).alias("unnumbered"))


def affected_segments(segments: DataFrame, touched: Sequence[str | None], as_of, window_days: int = 30,
                      previous: DataFrame | None = None) -> list[str | None]:
    """Segments (of ``segment_dates``) whose (season type, season) group must be recomputed: those
    of touched segments, those with games inside the trailing window, and those whose previous
    trailing values are not zero (they have to fall).  Returns segment strings (metadata)."""
    lookup = S.classify_season(segments)
    horizon = F.date_sub(F.lit(str(as_of)[:10]).cast("date"), window_days)
    touched_set = [t for t in touched if t is not None]
    hit = lookup.where(F.col("SEASON_SEGMENT").isin(touched_set) | (F.col("last_game") >= horizon))
    keys = hit.where(F.col("SEASON_KEY").isNotNull()).select("SEASON_TYPE", "SEASON_KEY")
    if previous is not None:
        moving = F.lit(False)
        for c in ("L30_DK_POINTS_sum", "L30_MINUTES_sum", "L30FPPM"):
            moving = moving | (F.col(c) != 0)
        keys = keys.unionByName(previous.where(moving).select("SEASON_TYPE", F.col("SEASON").alias("SEASON_KEY")))
    rows = lookup.join(keys.distinct(), ["SEASON_TYPE", "SEASON_KEY"], "left_semi").select("SEASON_SEGMENT").collect()
    return [r[0] for r in rows]


def season_state(spark: SparkSession, root: str, run_id: str, incremental: bool = True) -> DataFrame | None:
    """The moments of the log's numbered rows, brought up to date and published.

    Only rows of later loads than the state's are read (the files' statistics leave out the others)
    and merged into it.  Which load it reaches becomes current together with it, so a run that broke
    off anywhere neither loses nor doubles rows.  A rewritten log, which has another folder, and
    ``incremental=False`` start it anew.  None for a log without load numbers."""
    logs = sinks.read_log(spark, root, "fantasy_logs")
    if "_load_no" not in logs.columns:
        return None
    folder = sinks.log_folder(spark, root, "fantasy_logs")
    note = sinks.published_note(spark, root, "season_state")
    if incremental and note.get("folder") == folder:
        fresh = logs.where(F.col("_load_no") > note["load_no"]) if note["load_no"] is not None else logs.where("_load_no is not null")
        segments = [r[0] for r in fresh.select("SEASON_SEGMENT").distinct().collect() if r[0] is not None]   # tens of values
        state = SS.added(sinks.read_table(spark, root, "season_state"), fresh, segments)
    else:
        state = SS.moments(logs.where("_load_no is not null"))
    sinks.publish(state, root, "season_state", run_id,
                  note=lambda df: {"folder": folder, "load_no": df.agg(F.max("LAST_LOAD")).first()[0]})
    return sinks.read_table(spark, root, "season_state")


def build_fantasy_averages(spark: SparkSession, root: str, as_of, run_id: str, incremental: bool = True,
                           window_days: int = 30) -> DataFrame:
    """B4 + K2: compute and publish ``fantasy_averages``.

    The averages are finished from the season state (exact moments, into which the new loads' rows
    are merged) and the log's rows inside the trailing window: of the log, a run reads new and recent
    rows.  What was loaded since is taken from the log's own load numbers, so a run that failed
    between loading and averaging leaves nothing stale; rows stored without one are read every time.
    With ``incremental=False`` the state is made anew.  Either way the result is the same.
    """
    missing = [t for t in ("fantasy_logs", "dim_players") if sinks.read_log(spark, root, t) is None]
    if sinks.read_table(spark, root, "map_teams") is None:
        missing.append("map_teams")
    if missing:
        raise FeedError(f"missing required tables: {missing}")
    logs = sinks.read_log(spark, root, "fantasy_logs")
    state = season_state(spark, root, run_id, incremental)
    loose = logs if state is None else logs.where("_load_no is null")
    if state is None or not loose.isEmpty():
        state = SS.moments(loose) if state is None else state.unionByName(SS.moments(loose))
    avg = SS.averages(state, SS.windowed(logs, as_of, window_days), sinks.read_log(spark, root, "dim_players"),
                      sinks.read_table(spark, root, "map_teams"))
    sinks.publish(avg, root, "fantasy_averages", run_id, keys=AVERAGES_KEYS)
    return sinks.read_table(spark, root, "fantasy_averages")


AVERAGE_VIEWS = (("vw_player_averages_regular_season", "Regular", "player_averages_regular_season"),
                 ("vw_player_averages_playoffs", "Playoffs", "player_averages_playoffs"))


def publish_average_views(spark: SparkSession, averages: DataFrame, export_dir: str | None,
                          stamp: _dt.datetime, root: str | None = None, failed: dict[str, str] | None = None) -> list[str]:
    """The two season-type views and their CSV exports; returns the views made.

    With ``root`` they are lasting views over the published table (``averages`` is its content),
    else temporary ones.  Each is made on its own: one that fails is told in ``failed`` (or raises,
    where that isn't given) and doesn't keep the other from being made."""
    done = []
    for view, stype, base in AVERAGE_VIEWS:
        try:
            v = S.season_type_view(averages, stype)
            if root:
                sinks.lasting_view(spark, view, sinks.published_path(spark, root, "fantasy_averages"), v.columns,
                                   f"SEASON_TYPE = '{stype}'")
            else:
                v.createOrReplaceTempView(view)
            done.append(view)
            if export_dir:
                sinks.export_csv(v, export_dir, base, stamp, single_file=False)
        except Exception as e:  # noqa: BLE001 - the views are independent of each other
            if failed is None:
                raise
            failed[view] = str(e)
    return done


def _publish_slate_view(spark: SparkSession, root: str, view: str, slate: DataFrame, run_id: str, with_season: bool = True) -> None:
    """The slate as a published table and a lasting view over it, in export order."""
    sinks.publish(slate, root, view.removeprefix("vw_"), run_id)
    sinks.lasting_view(spark, view, sinks.published_path(spark, root, view.removeprefix("vw_")), slate.columns,
                       order_by=SL.export_columns(with_season))


@dataclass
class SlateResult:
    unmatched: list[str] = field(default_factory=list)
    exported: list[str] = field(default_factory=list)


def build_slates(spark: SparkSession, root: str, entries_path: str, averages: DataFrame, run_date: str,
                 export_dir: str | None, stamp: _dt.datetime, slate_seasons=K.SLATE_SEASONS,
                 l30_season=K.L30_SEASON, playoff_season=K.PLAYOFFS_SEASON) -> SlateResult | None:
    """Resolve today's names, build the slate views, export the CSVs, append the worklist.
    A missing entries file returns None and leaves yesterday's outputs in place."""
    entries = FD.read_slate_entries(spark, entries_path)
    if entries is None:
        return None
    out = SlateResult()
    regular = S.season_type_view(averages, "Regular")
    resolved = cut_lineage(MT.match_names(entries, regular.select("PLAYER", "PLAYER_ID"), name_col="Name"))
    matched = MT.matched_names(resolved)
    daily = SL.daily_slate(averages, matched, slate_seasons)
    l30 = SL.daily_slate_l30(averages, matched, l30_season)
    _publish_slate_view(spark, root, "vw_daily_slate", daily, run_date)
    _publish_slate_view(spark, root, "vw_daily_slate_l30", l30, run_date, with_season=False)
    playoffs = S.season_type_view(averages, "Playoffs")
    resolved_p = cut_lineage(MT.match_names(entries, playoffs.select("PLAYER", "PLAYER_ID"), name_col="Name"))
    _publish_slate_view(spark, root, "vw_daily_slate_playoffs",
                        SL.playoff_slate(averages, MT.matched_names(resolved_p), playoff_season), run_date)
    if export_dir:
        out.exported.append(sinks.export_csv(SL.export_order(daily), export_dir, "slate_player_averages", stamp))
        l30_csv = SL.daily_slate_l30(averages, matched, l30_season, K.SLATE_L30_CSV_COLUMNS)
        out.exported.append(sinks.export_csv(SL.export_order(l30_csv, with_season=False), export_dir,
                                             "slate_player_averages_l30", stamp))
    sinks.append_worklist(spark, root, run_date, resolved)               # regular slate only
    # the unmatched names are a slate-sized list (hundreds), returned for the run summary
    out.unmatched = [r["worklist"] for r in resolved.where(~F.col("matched")).select("worklist").collect()]
    return out


def run_daily(spark: SparkSession, root: str, box_landing: str, dfs_landing: str, entries_path: str,
              as_of, run_id: str, export_dir: str | None = None, now: _dt.datetime | None = None,
              latest: Mapping[str, str] | None = None) -> dict:
    """Every stage in order, each isolated; errors and warnings end up in ``run_summary``.

    ``latest`` (feed name -> text in its file names) takes, of a folder where cumulative deliveries
    gather, the newest one of that feed instead of all pending ones (S10)."""
    latest = latest or {}
    now = now or _dt.datetime.now()
    summary = {"run_id": run_id, "files_processed": 0, "files_overwritten": 0, "fantasy_rows_dropped": 0,
               "absence_rows_inserted": 0, "errors": [], "warnings": []}

    def run(name, fn):
        try:
            return fn()
        except Exception as e:  # noqa: BLE001 - isolate stages, surface the error in the summary
            summary["errors"].append(f"{name}: {e}")
            summary["warnings"].append(traceback.format_exc(limit=1).strip().splitlines()[-1])
            return None

    def told(feed, res: IngestResult) -> None:
        summary["files_processed"] += len(res.files)
        summary["files_overwritten"] += len(res.overwritten)
        summary["errors"] += [f"{feed}: {f}: {why}" for f, why in sorted(res.rejected.items())]
        summary["warnings"] += [f"{feed}: {n} cells of {c} are no numbers" for c, n in sorted(res.bad_cells.items())]

    box = run("box_scores", lambda: ingest_box_scores(spark, root, box_landing, run_id, latest=latest.get(BOX.name)))
    if box:
        told("box_scores", box)
        summary["absence_rows_inserted"] = box.absences_inserted
        if box.absence_conflicts:
            summary["warnings"].append(f"{box.absence_conflicts} absences have a box score and were left out")
        for f in box.absence_files_without_sheet:
            summary["warnings"].append(f"{f}: no {K.ABSENCE_SHEET} sheet")
    dfs = run("fantasy_logs", lambda: ingest_fantasy_logs(spark, root, dfs_landing, run_id, latest=latest.get(DFS.name)))
    if dfs:
        told("fantasy_logs", dfs)
        summary["fantasy_rows_dropped"] = dfs.dropped_missing_ids
        if dfs.dropped_missing_ids:
            summary["warnings"].append(f"dropped {dfs.dropped_missing_ids} fantasy rows with a missing id")
    avg = run("summary", lambda: build_fantasy_averages(spark, root, as_of, run_id))
    if avg is not None:
        run("drops", lambda: summary["warnings"].extend(dropped_rows(spark, root)))
        run("schema", lambda: sinks.record_schema(spark, root, run_id, "fantasy_averages", avg))
        failed: dict[str, str] = {}
        run("views", lambda: publish_average_views(spark, avg, export_dir, now, root, failed))
        summary["errors"] += [f"view {v}: {why}" for v, why in failed.items()]
        slate = run("slate", lambda: build_slates(spark, root, entries_path, avg, now.date().isoformat(),
                                                    export_dir, now))
        if slate is None:
            summary["warnings"].append("slate not rebuilt (entries file missing or stage failed)")
        elif slate.unmatched:
            summary["warnings"].append(f"{len(slate.unmatched)} slate names unmatched")
    sinks.record_run(spark, root, summary)
    return summary


def dropped_rows(spark: SparkSession, root: str) -> list[str]:
    """What the averages leave out: rows by unclassifiable segment, unknown player, unmapped team."""
    logs = sinks.read_log(spark, root, "fantasy_logs")
    out = [f"{r['rows_dropped']} rows of segment {r['SEASON_SEGMENT']!r} are in no season"
           for r in S.unclassified_segments(logs).orderBy("SEASON_SEGMENT").collect()]
    unknown = logs.join(sinks.read_log(spark, root, "dim_players"), "PLAYER_ID", "left_anti").count()
    if unknown:
        out.append(f"{unknown} rows have no known player")
    if "TEAM" in logs.columns:
        teams = Q.unmapped_teams(logs, sinks.read_table(spark, root, "map_teams"))
        names = sorted(r[0] for r in teams.collect())   # distinct raw team names
        if names:
            out.append(f"unmapped teams: {names}")
    return out


# --------------------------------------------------------------------------- maintenance jobs

LOG_TABLES = ("player_logs", "fantasy_logs", "player_absences")


def duplicate_audit(spark: SparkSession, root: str, tables: Sequence[str] = LOG_TABLES, top: int = 20
                    ) -> tuple[DataFrame, DataFrame, int]:
    """M1: (per-table stats, worst duplicate groups, total extra rows).  A missing table counts 0;
    a non-zero total is the CLI's failing exit status."""
    stats, groups = [], []
    for t in tables:
        df = sinks.read_log(spark, root, t)
        if df is None:
            continue
        Q.require_columns(df, KEYS, t)
        df = df.drop(*LOAD_COLUMNS)   # copies are compared by what the feeds say
        verdict = Q.duplicate_verdict(df, KEYS).agg(
            F.count(F.when(F.col("exact_copies"), 1)).alias("keys_of_exact_copies"),
            F.count(F.when(~F.col("exact_copies"), 1)).alias("keys_of_differing_copies"))
        # both sides are one row
        stats.append(Q.duplicate_stats(df).withColumn("table_name", F.lit(t))
                     .join(verdict.withColumn("table_name", F.lit(t)), "table_name"))
        groups.append(Q.duplicate_groups(df, top=top).withColumn("table_name", F.lit(t)))
    if not stats:
        empty = spark.createDataFrame([], "table_name string")
        return empty, empty, 0
    st = stats[0]
    for s in stats[1:]:
        st = st.unionByName(s)
    gr = groups[0]
    for g in groups[1:]:
        gr = gr.unionByName(g)
    extra = st.agg(F.coalesce(F.sum("extra_rows"), F.lit(0))).first()[0]
    return st, gr, int(extra)


def duplicate_repair(spark: SparkSession, root: str, run_id: str, tables: Sequence[str] = LOG_TABLES) -> dict:
    """M2: keep the first inserted copy per key (load, file, row), only for tables that have
    duplicates; the previous content is kept as a backup; re-audited after."""
    removed = {}
    for t in tables:
        df = sinks.read_log(spark, root, t)
        if df is None:
            continue
        extra = Q.duplicate_stats(df).first()["extra_rows"]
        if not extra:
            continue
        order = [c for c in LOAD_COLUMNS if c in df.columns] or [c for c in df.columns if c not in KEYS]
        fixed = cut_lineage(Q.remove_duplicates(df, KEYS, order))
        sinks.replace_log(fixed, root, t, run_id)
        removed[t] = int(extra)
    _, _, left = duplicate_audit(spark, root, list(removed))
    if left:
        raise FeedError(f"duplicates remain after repair: {left}")
    return removed


NAME_COLUMNS = {"fantasy_logs": "PLAYER", "player_logs": "PLAYER", "player_absences": "PLAYER",
                "dim_players": "PLAYER_NAME", "fantasy_averages": "PLAYER"}


def correct_names_job(spark: SparkSession, root: str, run_id: str, mapping=K.PLAYER_NAME_MAP) -> DataFrame | None:
    """M4 + A18: retroactive name correction over the name-bearing tables, the published averages
    among them; returns the per-table/per-name change counts (computed before the rewrite)."""
    from ..operators.repair import correct_names
    tables = {t: (sinks.read_table(spark, root, t), c) for t, c in NAME_COLUMNS.items()}
    fixed, impact = correct_names(tables, mapping)
    if impact is None:
        return None
    # materialised before the tables are rewritten (a lazy plan would re-read the new tables)
    impact = cut_lineage(impact)
    for t in sorted(r["table_name"] for r in impact.select("table_name").distinct().collect()):
        if sinks.current_version(spark, sinks.table_path(root, t)):
            sinks.publish(fixed[t], root, t, run_id)
        else:
            sinks.replace_log(fixed[t], root, t, run_id)
    return impact


def verify_corrections_job(spark: SparkSession, root: str, mapping=K.PLAYER_NAME_MAP) -> DataFrame | None:
    """Rows now carrying each corrected name, per table (counts > 0 only)."""
    present = {t: (df, c) for t, c in NAME_COLUMNS.items()
               if (df := sinks.read_table(spark, root, t)) is not None and c in df.columns}
    return Q.correction_counts(present, mapping, side="target") if present else None


def migrate_id_types_job(spark: SparkSession, root: str, run_id: str, table: str = "fantasy_logs") -> int:
    """M6: rewrite a log with integer ids (missing ids dropped and counted; fractions refused),
    re-asserting key uniqueness on the staged content before the swap."""
    from ..operators.repair import migrate_id_types
    df = sinks.read_log(spark, root, table)
    if df is None:
        return 0
    out, dropped = migrate_id_types(df)
    if out is df:
        return 0
    out = cut_lineage(out)
    Q.assert_unique(out, KEYS)
    sinks.replace_log(out, root, table, run_id)
    return dropped


def rename_absence_columns_job(spark: SparkSession, root: str, run_id: str) -> list[str]:
    """M7: bring a stored absence table to the DATE/PLAYER naming; idempotent."""
    from ..operators.repair import rename_columns
    df = sinks.read_log(spark, root, "player_absences")
    if df is None:
        return []
    out = rename_columns(df, K.ABSENCE_RENAMES)
    if out is df:
        return []
    sinks.replace_log(out, root, "player_absences", run_id)
    return [c for c in K.ABSENCE_RENAMES if c in df.columns]


def backfill_absences(spark: SparkSession, root: str, files: Sequence[str]) -> int:
    """M9: absence ingest over historical workbooks, in the caller's order, without recording them
    as processed; stops at the first file that is rejected or lacks the absence sheet (error)."""
    total = 0
    for f in files:
        rows = FD.staged_feed_rows(spark, [f])
        name = f.rsplit("/", 1)[-1]
        res = ingest_absences(spark, root, rows, [name])
        if res.without_sheet:
            raise FeedError(f"{name}: no {K.ABSENCE_SHEET} sheet")
        if res.rejected:
            raise FeedError(f"{name}: {res.rejected[name]}")
        total += res.inserted
    return total
