"""Season classification (C16-C18) and season filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def classify_season(df: DataFrame, segment: str = "SEASON_SEGMENT") -> DataFrame:
    """Add SEASON_TYPE ('Regular'/'Playoffs'/NULL) and SEASON_KEY ('YYYY-YY'/'YYYY'/NULL)."""
    # Type and year are separate projections so each regex runs once per row (the optimizer
    # does not inline a non-trivial expression into a projection that uses it twice).
    return (df.withColumn("SEASON_TYPE", C.season_type(segment))
              .withColumn("_season_year", C.season_year(segment))
              .withColumn("SEASON_KEY", C.season_key(segment, "SEASON_TYPE", F.col("_season_year")))
              .drop("_season_year"))


def unclassified_segments(df: DataFrame, segment: str = "SEASON_SEGMENT") -> DataFrame:
    """Distinct segments that cannot be classified, with how many rows each one drops.

    NULL segments are reported too (the reference aborts the whole stage on them; we drop and count).
    """
    # counted per segment first: the patterns run on the distinct segments, not on every row
    per = df.groupBy(F.col(segment).alias("SEASON_SEGMENT")).agg(F.count(F.lit(1)).alias("rows_dropped"))
    return (classify_season(per).where(F.col("SEASON_TYPE").isNull() | F.col("SEASON_KEY").isNull())
            .select("SEASON_SEGMENT", "rows_dropped"))


def season_type_view(averages: DataFrame, season_type: str) -> DataFrame:
    """The per-season-type view over the averages table."""
    return averages.where(F.col("SEASON_TYPE") == F.lit(season_type))


def in_seasons(df: DataFrame, seasons: Iterable[str], column: str = "SEASON") -> DataFrame:
    """SEASON IN (list); the list is configuration, passed as an argument."""
    return df.where(F.col(column).isin(list(seasons)))
