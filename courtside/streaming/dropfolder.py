"""Incremental drop-folder ingest with Structured Streaming.

New landing files are picked up once (the file source's checkpoint is the record of what
was read) and read by path through the feed reader, which splits delimited files and keeps every
row's position in its file; each
micro-batch keeps the first copy of every key (file order, then position) and appends only keys
the table does not hold yet.  ``run_feed_stream`` runs the batch jobs' own load on every
micro-batch.  Because the batch body is idempotent
(an anti join against the stored keys), a replayed batch after a failure adds nothing, so
the sink is effectively exactly-once.

Every delivery ends up in the manifest as loaded or as rejected with the reason, once, however
often a batch is repeated.  With ``archive_dir`` loaded files are moved there when their batch can't
be repeated any more: before the next one's load, and when the stream has ended.  A rejected file
stays where it is, and is loaded once it has been replaced by a corrected one (the file source
itself never looks at a known path again).
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sinks
from ..functions import columns as C
from ..operators.ingest import new_rows, stored_among
from ..session import cut_lineage, stage
from ..sources import feeds as FD


FILES = "path string, modificationTime timestamp, length long, content binary"


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landing files as a stream of (path, modificationTime, length); content is read by path, in splits."""
    r = spark.readStream.format("binaryFile").schema(FILES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing_dir).drop("content")


def _deliveries(files: DataFrame) -> list:
    """(path, _file_name, length, modified) of a batch's files, by name: file names of one batch."""
    names = F.element_at(F.split("path", "/"), -1).alias("_file_name")
    listed = files.select("path", names, "length", F.col("modificationTime").alias("modified")).collect()
    return sorted(listed, key=lambda r: (r["_file_name"], r["path"]))


def _rows_of(spark: SparkSession, listed: Sequence) -> DataFrame:
    """The staged rows of a batch's files, read as the batch jobs do: delimited files as lines, in splits."""
    return FD.staged_feed_rows(spark, [FD.literal_path(f["path"]) for f in listed])


def unfit_cells(named: DataFrame, schema: T.StructType, date_col: str | None) -> dict[str, str]:
    """file -> columns whose non-empty cells don't fit ``schema``, with their counts."""
    counts = []
    for f in schema.fields:
        if f.name in named.columns:
            fits = C.parse_date(f.name) if f.name == date_col else F.col(f.name).try_cast(f.dataType)
            counts.append(F.count(F.when(C.blank_to_null(f.name).isNotNull() & fits.isNull(), 1)).alias(f.name))
    if not counts:
        return {}
    told = {}
    for r in named.groupBy("_file_name").agg(*counts).collect():
        bad = {c: n for c, n in r.asDict().items() if c != "_file_name" and n}
        if bad:
            told[r["_file_name"]] = ", ".join(f"{n} cells of {c} don't fit" for c, n in sorted(bad.items()))
    return told


def ingest_batch(files: DataFrame, root: str, table: str, schema: T.StructType, keys: Sequence[str],
                 date_col: str | None = "DATE", run_id: str = "batch") -> None:
    """One micro-batch of CSV files with a header: first copy per key across the batch's files,
    minus stored keys of the batch's months, appended.  Cells that don't fit ``schema`` are NULL and
    counted in the manifest; a file that can't be read, or lacks a key column, is rejected."""
    spark = files.sparkSession
    listed = _deliveries(files)
    rows = _rows_of(spark, listed)
    rejected = {r["_file_name"]: r["cells"][0] for r in rows.where(F.col("_sheet") == FD.UNREADABLE).collect()}
    header = FD.sheet_header(rows, 0, 0).groupBy("_file_name").agg(F.collect_set("name").alias("names")).collect()
    names = {r["_file_name"]: set(r["names"]) for r in header}
    for f in listed:
        lacking = sorted(set(keys) - names.get(f["_file_name"], set()))
        if lacking:
            rejected.setdefault(f["_file_name"], f"columns {lacking} are missing")
    named = FD.sheet_frame(rows, 0, header_row=0)
    if rejected:
        named = named.where(~F.col("_file_name").isin(list(rejected)))
    unfit = unfit_cells(named, schema, date_col)
    batch = named.select("_file_name", "_row_no", *[
        (F.col(f.name).try_cast(f.dataType) if f.name in named.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
    months = None
    if date_col and date_col in batch.columns:
        batch = stage(batch.withColumn(date_col, C.parse_date(date_col)))
        months = [r[0] for r in batch.select(sinks.month(F.col(date_col))).distinct().collect()]
    stored = sinks.read_log(spark, root, table, months=months)
    fresh = new_rows(batch, stored_among(batch, stored, keys), keys, ("_file_name", "_row_no"))
    sinks.append_log(cut_lineage(fresh), root, table)
    known = {(r["_file_name"], r["length"], r["modified"]) for r in sinks.processed_files(spark, root, table).collect()}
    load_no = sinks.next_load(spark, root)
    sinks.record_files(spark, root, [(f["_file_name"], table, run_id, "ok", None, f["length"], f["modified"], load_no, unfit.get(f["_file_name"]))
                                     for f in listed if f["_file_name"] not in rejected
                                     and (f["_file_name"], f["length"], f["modified"]) not in known])
    sinks.record_rejected(spark, root, table, run_id, listed, rejected)


def _landed(spark: SparkSession, landing_dir: str, deliveries: DataFrame) -> DataFrame:
    """Files in the landing folder that are one of ``deliveries`` (_file_name, length, modified)."""
    listing = FD.file_listing(spark, landing_dir).withColumnRenamed("modificationTime", "modified")
    return listing.join(deliveries, ["_file_name", "length", "modified"], "left_semi")


def archive_loaded(spark: SparkSession, landing_dir: str, root: str, feed: str, archive_dir: str | None,
                   still_read: Collection[str] = ()) -> list[str]:
    """Move the landing files that the manifest says are loaded, except those of a batch that may be
    a repeated one; returns their paths."""
    if not archive_dir:
        return []
    loaded = _landed(spark, landing_dir, sinks.processed_files(spark, root, feed)).select("path").collect()
    return sinks.archive_files(spark, [r["path"] for r in loaded if r["path"] not in still_read], archive_dir)


def corrected_files(spark: SparkSession, landing_dir: str, root: str, feed: str) -> list[str]:
    """Paths of landing files of a rejected name that are another delivery, not seen yet."""
    rejected = sinks.rejected_files(spark, root, feed)
    listing = FD.file_listing(spark, landing_dir).withColumnRenamed("modificationTime", "modified")
    fresh = (listing.join(rejected.select("_file_name").distinct(), "_file_name", "left_semi")
             .join(rejected, ["_file_name", "length", "modified"], "left_anti")
             .join(sinks.processed_files(spark, root, feed), ["_file_name", "length", "modified"], "left_anti"))
    return sorted(r["path"] for r in fresh.select("path").collect())


def _drain(spark: SparkSession, landing_dir: str, root: str, feed: str, load, checkpoint: str,
           archive_dir: str | None, available_now: bool):
    """The stream of a landing folder through ``load(files, run_id)``, with retries and archiving."""
    def retry(run_id: str) -> None:
        paths = corrected_files(spark, landing_dir, root, feed)
        if paths:
            load(spark.read.format("binaryFile").load([FD.literal_path(p) for p in paths]), run_id)

    def batch(files: DataFrame, epoch: int) -> None:
        if not files.isEmpty():
            # a new batch starts when the one before it is committed: its files aren't read again
            reading = {f["path"] for f in _deliveries(files)}
            archive_loaded(files.sparkSession, landing_dir, root, feed, archive_dir, reading)
            load(files, f"stream-{epoch}")
        retry(f"stream-{epoch}-corrected")

    retry("stream-corrected")
    q = _started(landing_stream(spark, landing_dir), batch, checkpoint, available_now)
    if available_now:
        archive_loaded(spark, landing_dir, root, feed, archive_dir)
    return q


def run_drop_folder_ingest(spark: SparkSession, landing_dir: str, root: str, table: str,
                           schema: T.StructType, checkpoint: str, keys: Sequence[str] = ("PLAYER_ID", "DATE"),
                           archive_dir: str | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, drain) the ingest stream; returns the query."""
    return _drain(spark, landing_dir, root, table,
                  lambda files, run_id: ingest_batch(files, root, table, schema, keys, run_id=run_id),
                  checkpoint, archive_dir, available_now)


def run_feed_stream(spark: SparkSession, landing_dir: str, root: str, feed, checkpoint: str,
                    archive_dir: str | None = None, available_now: bool = True, duplicate_policy: str = "error"):
    """A feed's landing folder as a stream: every micro-batch goes through the same load as the
    batch job (``jobs.load_rows``), so the logs, dimension, absences and manifest are the same."""
    from ..plans import jobs as J

    def load(files: DataFrame, run_id: str) -> None:
        listed = _deliveries(files)
        J.load_rows(files.sparkSession, root, _rows_of(files.sparkSession, listed), feed, listed, run_id, duplicate_policy)

    return _drain(spark, landing_dir, root, feed.name, load, checkpoint, archive_dir, available_now)


def _started(stream: DataFrame, batch, checkpoint: str, available_now: bool):
    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
