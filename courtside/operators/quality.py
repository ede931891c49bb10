"""Data-quality operators: duplicate audit and repair (A10-A12, D1, M1-M3), coverage and
type audits (A14-A16), correction counts (A17, A18) and cross-table checks (J8-J12).

Skew: every per-key operator aggregates (map-side combined) instead of windowing, so a key
holding a third of all rows costs one partial aggregate per input partition, not one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


class DuplicateKeyError(RuntimeError):
    """Raised by ``assert_unique`` when a key occurs more than once."""


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "table") -> None:
    """Raise if a column is absent, naming it."""
    absent = sorted(set(cols) - set(df.columns))
    if absent:
        raise ValueError(f"{what}: no column {', '.join(absent)} among {', '.join(df.columns)}")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: copies and distinct full-row variants (NULL keys form their own groups).

    Two chained aggregates, no join: distinct rows with their multiplicity (shuffled on the
    whole row, so a hot key spreads over its variants), then per key.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_mult"))
    return rows.groupBy(*keys).agg(F.sum("_mult").alias("copies"),
                                   F.count(F.lit(1)).alias("variants"))


def duplicate_stats(df: DataFrame, keys: Sequence[str] = ("PLAYER_ID", "DATE")) -> DataFrame:
    """A10: one row -- total_rows, distinct_keys (NULL-containing keys not counted),
    distinct_full_rows, extra_rows = total_rows - distinct_keys."""
    require_columns(df, keys)
    per_key = key_counts(df, keys)
    all_keys = F.lit(True)
    for k in keys:
        all_keys = all_keys & F.col(k).isNotNull()
    out = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.when(all_keys, F.lit(1))).cast("long").alias("distinct_keys"),
        F.coalesce(F.sum("variants"), F.lit(0)).cast("long").alias("distinct_full_rows"))
    return out.withColumn("extra_rows", F.col("total_rows") - F.col("distinct_keys"))


def duplicate_groups(df: DataFrame, keys: Sequence[str] = ("PLAYER_ID", "DATE"), top: int | None = 20,
                     order_desc: str = "DATE") -> DataFrame:
    """Keys with more than one copy, worst first (copies desc, date desc, then keys)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    order = [F.col("copies").desc(), F.col(order_desc).desc()] + [F.col(k).asc() for k in keys if k != order_desc]
    g = g.orderBy(*order)
    return g.limit(top) if top else g


def duplicate_verdict(df: DataFrame, keys: Sequence[str] = ("PLAYER_ID", "DATE")) -> DataFrame:
    """A12, refined per key: for every duplicated key, copies, distinct variants and whether all
    copies are exact (then keeping one loses nothing)."""
    per_key = key_counts(df, keys).where(F.col("copies") > 1)
    return per_key.withColumn("exact_copies", F.col("variants") == 1)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (ties broken by the remaining columns).

    Expressed as ``min(struct(order..., rest...))`` per key: a partial aggregate runs before
    the shuffle, so a hot key is reduced to one row per input partition first.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*[F.col(k) for k in keys], *[F.col(f"_first.{c}").alias(c) for c in (*order, *rest)]) \
              .select(*df.columns)


def remove_duplicates(df: DataFrame, keys: Sequence[str] = ("PLAYER_ID", "DATE"),
                      order: Sequence[str] = ("_ingest_seq",)) -> DataFrame:
    """M2: the repaired table (earliest copy per key kept).  Rows with a NULL key component are
    kept as they are, as a DELETE ... NOT IN (SELECT MIN(rowid) ... GROUP BY key) keeps one per
    NULL group too -- here one per distinct NULL-containing key."""
    return first_by_key(df, keys, order)


def assert_unique(df: DataFrame, keys: Sequence[str] = ("PLAYER_ID", "DATE")) -> None:
    """M3: refuse when any key occurs twice.  Cost: one aggregate and a LIMIT 1 probe."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).collect()
    if dup:
        row = dup[0].asDict()
        raise DuplicateKeyError(f"duplicate key {[row[k] for k in keys]} occurs {row['n']} times")


def within_file_duplicates(df: DataFrame, keys: Sequence[str] = ("PLAYER_ID", "DATE"),
                           file_col: str = "_file_name") -> DataFrame:
    """D3: (file, key) groups with more than one row -- these fail the file under policy 'error'."""
    return (df.groupBy(file_col, *keys).agg(F.count(F.lit(1)).alias("copies"))
              .where(F.col("copies") > 1))


def coverage(named: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table, min/max date and row count.  ``named`` maps table -> (df, date column)."""
    parts = []
    for name, (df, date_col) in named.items():
        parts.append(df.agg(F.lit(name).alias("table_name"),
                            F.min(F.col(date_col).cast("date")).alias("min_date"),
                            F.max(F.col(date_col).cast("date")).alias("max_date"),
                            F.count(F.lit(1)).alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segment_counts(df: DataFrame, segment: str = "SEASON_SEGMENT") -> DataFrame:
    """A15."""
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("row_count"))


def value_class(c) -> object:
    """A16 storage class of a text cell: integer / real / text / null."""
    s = C.strip_ws(F.col(c) if isinstance(c, str) else c)
    return (F.when(s.isNull(), F.lit("null"))
             .when(s.rlike(r"^[+-]?\d+$"), F.lit("integer"))
             .when(s.try_cast("double").isNotNull(), F.lit("real"))
             .otherwise(F.lit("text")))


def type_audit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, how many cells fall in each storage class (on text landing data)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols
    ])).alias("cell"))
    return (stacked.select("cell.column_name", value_class(F.col("cell.v")).alias("storage_class"))
                   .groupBy("column_name", "storage_class").agg(F.count(F.lit(1)).alias("cells")))


def unmapped_teams(logs: DataFrame, map_teams: DataFrame, team: str = "TEAM") -> DataFrame:
    """Distinct raw team strings with no map row."""
    teams = logs.select(F.col(team).alias("TEAM")).where(F.col("TEAM").isNotNull()).distinct()
    return teams.join(map_teams.select(F.col("RAW_TEAM_NAME").alias("TEAM")), "TEAM", "left_anti")


def absence_overlap(absences: DataFrame, box: DataFrame, keys: Sequence[str] = ("PLAYER_ID", "DATE")) -> DataFrame:
    """How many absence rows share their key with a box score (one-row report)."""
    hit = absences.join(box.select(*keys).distinct(), list(keys), "left_semi")
    return hit.agg(F.count(F.lit(1)).alias("overlapping_absences"))


def same_game_counts(absences: DataFrame, box: DataFrame, game: str = "GAME_ID") -> DataFrame:
    """J10 without emitting pairs: per absence row, how many box-score rows share its game
    (the size of the many-to-many join, computed from per-game counts)."""
    per_game = box.groupBy(game).agg(F.count(F.lit(1)).alias("box_rows_same_game"))
    return absences.join(per_game, game, "left").fillna(0, subset=["box_rows_same_game"])


def name_mismatches(logs: DataFrame, dim_players: DataFrame) -> DataFrame:
    """(PLAYER_ID, log spelling, canonical name, rows) where the log's PLAYER differs from
    the dimension name.  Pre-aggregated per (id, spelling) before the join."""
    spellings = logs.groupBy("PLAYER_ID", "PLAYER").agg(F.count(F.lit(1)).alias("log_rows"))
    return (spellings.join(dim_players, "PLAYER_ID")
                     .where(F.col("PLAYER") != F.col("PLAYER_NAME"))
                     .select("PLAYER_ID", "PLAYER", "PLAYER_NAME", "log_rows"))


class AmbiguousSegmentError(RuntimeError):
    """A game's rows name more than one season segment."""


def game_segments(logs: DataFrame, game: str = "GAME_ID", segment: str = "SEASON_SEGMENT") -> DataFrame:
    """One segment per game (the smallest that its rows name) and how many its rows name."""
    named = logs.where(F.col(segment).isNotNull()).groupBy(game, segment).agg(F.lit(1).alias("_one"))
    return named.groupBy(game).agg(F.min(segment).alias(segment), F.count("_one").alias("segments_for_game"))


def season_of_absence(absences: DataFrame, logs: DataFrame, game: str = "GAME_ID",
                      segment: str = "SEASON_SEGMENT", strict: bool = False) -> DataFrame:
    """Absence rows get SEASON_SEGMENT from another row of the same game (one row per
    absence).  ``segments_for_game`` > 1 flags an ambiguous game; ``strict`` refuses them."""
    segments = game_segments(logs, game, segment)
    if strict:
        bad = segments.where(F.col("segments_for_game") > 1).orderBy(game).limit(5).collect()
        if bad:
            raise AmbiguousSegmentError(f"games with several season segments, e.g. {[r[game] for r in bad]}")
    return absences.join(segments, game, "left")


def correction_counts(named: Mapping[str, tuple[DataFrame, str]], name_map: Mapping[str, str],
                      side: str = "source") -> DataFrame:
    """A17 (side='target': rows now carrying each corrected name) and A18 (side='source': rows a
    correction would change), per name and table; only counts > 0."""
    targets = sorted(set(name_map.keys() if side == "source" else name_map.values()))
    parts = []
    for table, (df, c) in named.items():
        # the map is a literal list: the filter reaches the scan, only its rows are shuffled
        counts = (df.where(F.col(c).isin(targets)).groupBy(F.col(c).alias("NAME"))
                    .agg(F.count(F.lit(1)).alias("row_count")))
        parts.append(counts.withColumn("table_name", F.lit(table)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("row_count") > 0).select("table_name", "NAME", "row_count")
