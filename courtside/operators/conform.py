"""Conformance operators (C1-C15, C27, C28, M8/U3): headers, renames, dates, ids, names,
absence types and the team dimension.  All are DataFrame -> DataFrame with native expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import constants as K


# --------------------------------------------------------------------------- headers

def header_map(cells: DataFrame, hyphen_to_underscore: bool = True, file_col: str = "_file_name",
               pos_col: str = "pos", raw_col: str = "raw") -> DataFrame:
    """C1-C3 for every file at once: (file, pos, raw) -> (file, pos, raw, name).

    The k-th repeat (k >= 1) of a raw header within a file is read as ``raw.k`` before
    sanitising, as a spreadsheet reader de-duplicates headers, so ``DRAFTKINGS`` repeated
    becomes ``DRAFTKINGS`` and ``DRAFTKINGS1`` in the hyphen-stripping variant.
    Windows partition by (file, raw): a group is one header's repeats within one file.
    """
    w = Window.partitionBy(file_col, raw_col).orderBy(pos_col)
    k = F.row_number().over(w) - 1
    mangled = F.when(k > 0, F.concat(F.col(raw_col), F.lit("."), k.cast("string"))).otherwise(F.col(raw_col))
    return cells.select(file_col, pos_col, raw_col,
                        C.sanitize_header(mangled, hyphen_to_underscore).alias("name"))


def header_collisions(hmap: DataFrame, file_col: str = "_file_name") -> DataFrame:
    """Different raw headers that sanitise to the same name in one file (an error for the file)."""
    return (hmap.groupBy(file_col, "name").agg(F.count(F.lit(1)).alias("n"),
                                              F.collect_set("raw").alias("raws"))
                .where(F.col("n") > 1))


def apply_header(rows: DataFrame, hmap: DataFrame, file_col: str = "_file_name",
                 cells_col: str = "cells", keep: Sequence[str] = ("_file_name", "_row_no")) -> DataFrame:
    """Turn ``cells array<string>`` rows into named columns using each file's header map.

    The per-file header (a few dozen names) is gathered per file, as the position of every name, and
    broadcast to the rows (joined by a shuffle, all rows of a file would meet in one task); the union of
    names across files becomes the column set (a file lacking a column yields NULL there).  The name
    list is collected to the driver: it is the schema (bounded by the number of distinct header names),
    not data.
    """
    names = [r["name"] for r in hmap.select("name").distinct().orderBy("name").collect()]
    header = F.sort_array(F.collect_list(F.struct("name", (F.col("pos") + 1).cast("int").alias("pos"))))
    places = F.map_from_entries("_hdr")   # a name that a file has twice raises
    per_file = (hmap.groupBy(file_col).agg(header.alias("_hdr"))
                .select(file_col, F.transform(F.array(*map(F.lit, names)).cast("array<string>"),
                                              lambda n: F.try_element_at(places, n)).alias("_at")))
    joined = rows.join(F.broadcast(per_file), file_col, "left")
    return joined.select(*[F.col(c) for c in keep if c in rows.columns],
                         *[F.try_element_at(F.col(cells_col), F.get("_at", F.lit(i))).alias(n) for i, n in enumerate(names)])


def rename_and_drop(df: DataFrame, renames: Mapping[str, str], drops: Sequence[str] = (),
                    segment_suffix: str | None = K.SEGMENT_HEADER_SUFFIX) -> DataFrame:
    """Rename the columns present, drop those listed (missing ones ignored).  The
    column whose name ends in ``segment_suffix`` becomes SEASON_SEGMENT (two such: an error)."""
    present = {k: v for k, v in renames.items() if k in df.columns and k != v}
    if segment_suffix and "SEASON_SEGMENT" not in df.columns:
        seg = [c for c in df.columns if c.endswith(segment_suffix)]
        if len(seg) > 1:
            raise ValueError(f"several columns could be the season segment: {sorted(seg)}")
        if seg:
            present[seg[0]] = "SEASON_SEGMENT"
    out = df.withColumnsRenamed(present) if present else df
    return out.drop(*[c for c in drops if c in out.columns])


def drop_empty_rows(df: DataFrame, data_cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose data cells are all NULL or blank."""
    cols = list(data_cols or [c for c in df.columns if not c.startswith("_")])
    any_value = F.lit(False)
    for c in cols:
        any_value = any_value | C.blank_to_null(F.col(c).cast("string")).isNotNull()
    return df.where(any_value)


# --------------------------------------------------------------------------- dates, ids

def normalize_dates(df: DataFrame, col: str = "DATE", formats: Sequence[str] = C.DATE_FORMATS,
                    out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """text/timestamp -> DateType.  Returns (accepted, rejected) where rejected holds the
    non-null values no accepted layout could parse (with ``reject_reason='unparseable_date'``)."""
    tagged = with_parsed_date(df, col, formats, out="_parsed")
    bad = F.col("reject_reason").isNotNull()
    rejected = tagged.where(bad).drop("_parsed")
    accepted = tagged.where(~bad).withColumn(out or col, F.col("_parsed")).drop("_parsed", "reject_reason")
    return accepted, rejected


def with_parsed_date(df: DataFrame, col: str = "DATE", formats: Sequence = C.DATE_FORMATS,
                     out: str = "DATE_PARSED") -> DataFrame:
    """Single pass: adds the parsed date and ``reject_reason`` ('unparseable_date' or NULL)."""
    tagged = C.once(df, F.struct(C.parse_date(F.col(col), formats).alias("date")), "_date")
    return (tagged.withColumn("reject_reason", F.when(F.col(col).isNotNull() & F.col("_date.date").isNull(),
                                                      F.lit("unparseable_date")))
                  .withColumn(out, F.col("_date.date")).drop("_date"))


def typed_id(c: str | Column) -> Column:
    """C8 of one id cell, as a struct of reason (missing / non_numeric / fractional / ok) and value:
    the id as bigint when it is a whole number, else NULL.  All 64 bits are kept: text goes through
    DECIMAL, never through double (a failed cast to bigint would cost an exception per cell)."""
    def typed(reason: str, value: Column | None = None) -> Column:
        return F.struct(F.lit(reason).alias("reason"),
                        (F.lit(None) if value is None else value).cast("bigint").alias("value"))

    def of_number(num: Column) -> Column:
        whole = num.try_cast("bigint")
        return (F.when(num.isNull(), typed("non_numeric")).when(num != F.floor(num).try_cast("decimal(38,9)"), typed("fractional"))
                 .when(whole.isNull(), typed("non_numeric")).otherwise(typed("ok", whole)))

    def of_text(s: Column) -> Column:
        return (F.when(s.isNull() | (s == ""), typed("missing"))
                 .otherwise(C.let(s.try_cast("decimal(38,9)"), of_number)))

    return C.let(C.strip_ws(c), of_text)


def id_reason(c: str | Column) -> Column:
    """The reason of ``typed_id`` alone."""
    return typed_id(c)["reason"]


def normalized_id(c: str | Column) -> Column:
    """The value of ``typed_id`` alone."""
    return typed_id(c)["value"]


class IdError(ValueError):
    """An id that the policy doesn't allow."""


# policy -> reasons that raise instead of being handed back as rejected rows
ID_POLICIES = {"report": (), "drop_missing": ("non_numeric", "fractional"),
               "strict": ("missing", "non_numeric", "fractional")}


def normalize_ids(df: DataFrame, cols: Sequence[str] = ("PLAYER_ID", "GAME_ID"),
                  policy: str = "report") -> tuple[DataFrame, DataFrame]:
    """Ids -> bigint.  Returns (accepted, rejected); rejected carries ``reject_reason`` (the first
    failing column's reason: missing, non_numeric or fractional).  Policy 'drop_missing' (box
    scores and daily fantasy) raises on the other two, 'strict' (absences) on any."""
    tagged = with_typed_ids(df, cols)
    if ID_POLICIES[policy]:
        bad = tagged.where(F.substring_index("reject_reason", ":", -1).isin(*ID_POLICIES[policy])).limit(1).collect()
        if bad:
            raise IdError(f"{bad[0]['reject_reason']} in {bad[0].asDict()}")
    accepted = tagged.where(F.col("reject_reason").isNull())
    accepted = accepted.withColumns({c: F.col(f"_ids.{c}.value") for c in cols if c in df.columns})
    return accepted.drop("reject_reason", "_ids"), tagged.where(F.col("reject_reason").isNotNull()).drop("_ids")


def with_typed_ids(df: DataFrame, cols: Sequence[str] = ("PLAYER_ID", "GAME_ID")) -> DataFrame:
    """Single pass: adds ``_ids``, a struct of every id column's ``typed_id``, and ``reject_reason``
    ('<col>:missing|non_numeric|fractional' for the first failing id column, NULL when every id is
    a whole number)."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df.withColumn("_ids", F.struct()).withColumn("reject_reason", F.lit(None).cast("string"))
    tagged = C.once(df, F.struct(*[typed_id(F.col(c)).alias(c) for c in present]), "_ids")
    reason = F.lit(None).cast("string")
    for c in reversed(present):
        r = F.col(f"_ids.{c}.reason")
        reason = F.when(r != "ok", F.concat(F.lit(f"{c}:"), r)).otherwise(reason)
    return tagged.withColumn("reject_reason", reason)


def with_id_reasons(df: DataFrame, cols: Sequence[str] = ("PLAYER_ID", "GAME_ID")) -> DataFrame:
    """``with_typed_ids`` without the typed ids."""
    return with_typed_ids(df, cols).drop("_ids")


# --------------------------------------------------------------------------- names

def name_map_frame(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    schema = T.StructType([T.StructField("FROM_NAME", T.StringType(), False),
                           T.StructField("TO_NAME", T.StringType(), False)])
    return spark.createDataFrame(list(mapping.items()), schema)


def standardize_names(df: DataFrame, col: str = "PLAYER", mapping: Mapping[str, str] = K.PLAYER_NAME_MAP,
                      name_map_df: DataFrame | None = None) -> DataFrame:
    """C11: exact-match replacement.  A literal map compiles into the projection; a map held as
    a table (``name_map_df(FROM_NAME, TO_NAME)``) is joined instead (planner/AQE size the join)."""
    if name_map_df is None:
        return df.withColumn(col, C.replace_from_map(col, mapping))
    m = name_map_df.select(F.col("FROM_NAME").alias("_from"), F.col("TO_NAME").alias("_to"))
    return (df.join(m, F.col(col) == F.col("_from"), "left")
              .withColumn(col, F.coalesce(F.col("_to"), F.col(col))).drop("_from", "_to"))


def names_changed(df: DataFrame, col: str = "PLAYER", mapping: Mapping[str, str] = K.PLAYER_NAME_MAP) -> DataFrame:
    """Distinct names the map would change, with their replacement and row count."""
    hit = df.where(C.map_lookup(col, mapping).isNotNull())
    return (hit.groupBy(F.col(col).alias("FROM_NAME"))
               .agg(F.count(F.lit(1)).alias("row_count"))
               .withColumn("TO_NAME", C.map_lookup("FROM_NAME", mapping)))


# --------------------------------------------------------------------------- absences

def classify_absence(df: DataFrame, reason: str = "REASON") -> DataFrame:
    """C14."""
    return df.withColumn("ABSENCE_TYPE", C.absence_type(reason))


def absence_columns(df: DataFrame) -> DataFrame:
    """The stored absence column set, in order."""
    return df.select(*K.ABSENCE_COLUMNS)


# --------------------------------------------------------------------------- teams

def team_spellings(spark: SparkSession, mapping: Mapping[str, str] = K.TEAM_ABBREVIATIONS) -> DataFrame:
    schema = T.StructType([T.StructField("SPELLING", T.StringType(), False),
                           T.StructField("TEAM_ABBREVIATION", T.StringType(), False)])
    return spark.createDataFrame(list(mapping.items()), schema)


def first_nonempty_source(sources: Sequence[DataFrame], col: str) -> DataFrame:
    """Distinct non-null values of ``col`` from the first source that has any.

    Tagged union + the minimum priority present (a one-row aggregate) + semi join on it:
    one pass, no driver-side branching on data."""
    tagged = None
    for prio, s in enumerate(sources):
        # distinct first (partial aggregates): all that follows runs on a handful of names
        t = s.select(F.col(col).alias("RAW")).where(F.col("RAW").isNotNull()).distinct().withColumn("_prio", F.lit(prio))
        tagged = t if tagged is None else tagged.unionByName(t)
    best = tagged.agg(F.min("_prio").alias("_prio"))       # a global aggregate: exactly one row
    # broadcast the one-row side: a shuffle join on a key with a handful of values would put
    # each source into a single task
    return tagged.join(F.broadcast(best), "_prio", "left_semi").select("RAW")


def seed_team_map(sources: Sequence[DataFrame], spellings: DataFrame, col: str = "TEAM") -> tuple[DataFrame, DataFrame]:
    """(map_teams rows, unmapped raw names).  Raw names come from the first source that
    has any; each is normalised (whitespace collapsed, lower-cased) and looked up."""
    raw = first_nonempty_source(sources, col)
    sp = spellings.select(F.col("SPELLING").alias("_key"), "TEAM_ABBREVIATION")
    mapped = (raw.withColumn("_key", C.team_spelling_key("RAW"))
                 .join(sp, "_key", "left")
                 .select(F.col("RAW").alias("RAW_TEAM_NAME"), "TEAM_ABBREVIATION"))
    return mapped, mapped.where(F.col("TEAM_ABBREVIATION").isNull()).select("RAW_TEAM_NAME")
