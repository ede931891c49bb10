"""Table maintenance transformations (M4, M6-M9).  Each returns new DataFrames (and counts
as DataFrames); publishing them as a new table version is the caller's job (``sinks.publish``),
so every migration has the previous version as its backup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import conform as CF
from .quality import correction_counts


class MigrationError(RuntimeError):
    pass


def correct_names(tables: Mapping[str, tuple[DataFrame | None, str]], mapping: Mapping[str, str]
                  ) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """M4: apply the name map to each (table, column); absent tables or columns are skipped.
    Returns (corrected tables, per-table/per-name change counts (A18) before correction)."""
    present = {t: (df, c) for t, (df, c) in tables.items() if df is not None and c in df.columns}
    if not present:
        return {}, None
    impact = correction_counts(present, mapping, side="source")
    fixed = {t: CF.standardize_names(df, c, mapping) for t, (df, c) in present.items()}
    return fixed, impact


def migrate_id_types(df: DataFrame, cols: Sequence[str] = ("PLAYER_ID", "GAME_ID")) -> tuple[DataFrame, int]:
    """M6: ids stored as REAL/text -> bigint.  Already-integral columns short-circuit; rows with
    a missing id are dropped and counted; a fractional or non-numeric id aborts the migration."""
    present = [c for c in cols if c in df.columns]
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if all(isinstance(df.schema[c].dataType, integral) for c in present):
        return df, 0
    tagged = CF.with_id_reasons(df, present)
    counts = {r["r"]: r["n"] for r in
              tagged.groupBy(F.regexp_replace("reject_reason", "^[^:]*:", "").alias("r"))
                    .agg(F.count(F.lit(1)).alias("n")).collect() if r["r"] is not None}
    bad = {k: v for k, v in counts.items() if k in ("fractional", "non_numeric")}
    if bad:
        raise MigrationError(f"ids that are no whole numbers, by kind: {bad}")
    accepted, _ = CF.normalize_ids(df, present)
    return accepted, int(counts.get("missing", 0))


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """M7: rename columns; a second run changes nothing.  Of each pair exactly one name must be
    there, or the table is not the one that the migration is for."""
    for old, new in renames.items():
        if len({old, new} & set(df.columns)) != 1:
            raise MigrationError(f"one of {old} and {new} was expected in {df.columns}")
    todo = {old: new for old, new in renames.items() if old in df.columns}
    return df.withColumnsRenamed(todo) if todo else df


class SeedRefused(RuntimeError):
    pass


def check_seed(existing_rows: int, unmapped: list[str], force: bool = False) -> None:
    """M8 guards: any unmapped raw team fails the seed (nothing written); a populated map is
    only replaced when forced."""
    if unmapped:
        raise SeedRefused(f"unmapped team names: {sorted(unmapped)}")
    if existing_rows > 0 and not force:
        raise SeedRefused(f"{existing_rows} team rows would be replaced; force=True does so")
