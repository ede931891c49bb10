"""Sinks (K1-K7): versioned publish, log append, CSV export, ingest manifest, run summary.

Tables are plain Parquet folders under a store root.

*Derived tables* are published: new content goes to a folder of its own, is validated
(uniqueness, counts), and only then becomes current.  *Log tables* are append-only; rewrites
(repairs, migrations) write a new folder beside the old one, which stays as the backup.

What is current is recorded in numbered state files (``<table>/_state/<n>``; the largest number
counts).  A state file is written under another name and renamed to a number that doesn't exist
yet, so a crash at any point leaves either the old or the new state, on every file system.  There
is one writer per table.

A log's state also holds its schema: columns may be added (older rows read NULL), while a
changed type is refused, so reads never depend on which file Spark looks at first.  Logs are laid
out by ``LOG_SPECS`` in every write, so that a batch looks up stored keys only around the months
that it touches.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.quality import assert_unique
from .session import shuffles_freed

MONTH = "_month"


@dataclass(frozen=True)
class LogSpec:
    """Layout of a log: its date column, partition columns, and whether the date's month
    partitions it too (else lookups by month rely on the date statistics of the files)."""
    date: str | None = None
    partition_by: tuple[str, ...] = ()
    by_month: bool = False


LOG_SPECS = {
    "fantasy_logs": LogSpec("DATE", ("SEASON_SEGMENT",)),
    "player_logs": LogSpec("DATE", by_month=True),
    "player_absences": LogSpec("DATE", by_month=True),
}


class SchemaDriftError(RuntimeError):
    """A column arrived with another type than the log holds."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    """(number, content) of a table's current state; (0, {}) when there is none."""
    fs, folder = _fs(spark, f"{path}/_state")
    if not fs.exists(folder):
        return 0, {}
    numbers = [int(n) for st in fs.listStatus(folder) if (n := st.getPath().getName()).isdigit()]
    if not numbers:
        return 0, {}
    jvm = spark.sparkContext._jvm
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{path}/_state/{max(numbers)}"))
    try:
        return max(numbers), json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _set_state(spark: SparkSession, path: str, content: dict) -> None:
    number, _ = _state(spark, path)
    fs, draft = _fs(spark, f"{path}/_state/draft-{uuid.uuid4().hex}")
    stream = fs.create(draft)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_state/{number + 1}")
    if not fs.rename(draft, target):
        raise RuntimeError(f"another writer changed {path}")


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def current_version(spark: SparkSession, path: str) -> str | None:
    return _state(spark, path)[1].get("version")


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Current content of a table; None (or an empty frame of ``schema``) when it does not exist."""
    path = table_path(root, name)
    version = current_version(spark, path)
    return spark.read.parquet(f"{path}/{version}") if version else read_log(spark, root, name, schema)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return bool(_state(spark, table_path(root, name))[0])


def require_tables(spark: SparkSession, root: str, names: Sequence[str]) -> list[str]:
    """The missing ones (empty list = all present)."""
    return [n for n in names if not table_exists(spark, root, n)]


def published_note(spark: SparkSession, root: str, name: str) -> dict:
    """What was noted when the table's current version was published."""
    return _state(spark, table_path(root, name))[1].get("note", {})


def publish(df: DataFrame, root: str, name: str, run_id: str, keys: Sequence[str] | None = None,
            partition_by: Sequence[str] = (), note: Callable[[DataFrame], dict] | None = None) -> str:
    """K2/K3 staged replace: write a version of its own, validate, then make it current.  A run
    id may come twice: an existing version is never written to.  ``note`` makes, from the written
    rows, a few values that become current together with them."""
    spark = df.sparkSession
    path = table_path(root, name)
    version = f"version={run_id}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_freed(spark):
        w.parquet(f"{path}/{version}")
        if keys:
            assert_unique(spark.read.parquet(f"{path}/{version}"), keys)   # M3 before it becomes current
    _set_state(spark, path, {"version": version, **({"note": note(spark.read.parquet(f"{path}/{version}"))} if note else {})})
    return version


def _merged_schema(old: T.StructType | None, new: T.StructType, name: str) -> T.StructType:
    """The old columns, then new ones; all nullable.  A type that differs is refused."""
    fields = {f.name: f.dataType for f in (old.fields if old else [])}
    for f in new.fields:
        if fields.setdefault(f.name, f.dataType) != f.dataType:
            raise SchemaDriftError(f"{name}.{f.name} is {fields[f.name].simpleString()}, "
                                   f"not {f.dataType.simpleString()}")
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def _laid_out(df: DataFrame, name: str, schema: T.StructType):
    """A writer of ``df`` in the log's schema and layout."""
    spec = LOG_SPECS.get(name, LogSpec())
    have = set(df.columns)
    df = df.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                     for f in schema.fields])
    by = [c for c in spec.partition_by if c in schema.fieldNames()]
    if spec.by_month and spec.date in schema.fieldNames():
        df = df.withColumn(MONTH, month(F.col(spec.date)))
        by.append(MONTH)
    if not by:
        return df.write
    # rows of a partition are brought together (large ones split again) so that a load writes few files
    return df.hint("rebalance", *by).write.partitionBy(*by)


def month(date) -> object:
    return F.date_format(date.try_cast("date"), "yyyy-MM")


def append_log(df: DataFrame, root: str, name: str) -> None:
    """K1: append rows to a log table."""
    spark, path = df.sparkSession, table_path(root, name)
    _, state = _state(spark, path)
    old = T.StructType.fromJson(state["schema"]) if "schema" in state else None
    schema = _merged_schema(old, df.schema, name)
    if schema != old:   # before the rows: columns without values do no harm
        state = {"folder": state.get("folder", "_log"), "schema": json.loads(schema.json())}
        _set_state(spark, path, state)
    with shuffles_freed(spark):
        _laid_out(df, name, schema).mode("append").parquet(f"{path}/{state['folder']}")


def log_folder(spark: SparkSession, root: str, name: str) -> str | None:
    """The folder that holds a log's rows now; it changes with every rewrite."""
    return _state(spark, table_path(root, name))[1].get("folder")


def read_log(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None,
             months: Sequence[str | None] | None = None) -> DataFrame | None:
    """Rows of a log; with ``months``, at least those of the given months ('yyyy-MM', None for
    rows without a date): a partition filter, or a date range that files are skipped by."""
    path = table_path(root, name)
    _, state = _state(spark, path)
    if "schema" not in state:
        return spark.createDataFrame([], schema) if schema is not None else None
    own = T.StructType.fromJson(state["schema"])
    if not _exists(spark, f"{path}/{state['folder']}"):
        return spark.createDataFrame([], own)
    spec = LOG_SPECS.get(name, LogSpec())
    by_month = spec.by_month and spec.date in own.fieldNames()
    df = spark.read.schema(T.StructType([*own.fields, T.StructField(MONTH, T.StringType())]) if by_month else own) \
        .parquet(f"{path}/{state['folder']}")
    if months is not None and by_month:
        hit = F.col(MONTH).isin([m for m in months if m is not None])
        df = df.where(hit | F.col(MONTH).isNull() if None in months else hit)
    elif months is not None and spec.date in own.fieldNames() and isinstance(own[spec.date].dataType, T.DateType):
        some = [m for m in months if m is not None]
        date, first = F.col(spec.date), F.lit(f"{min(some)}-01" if some else None).cast("date")
        last = F.last_day(F.lit(f"{max(some)}-01" if some else None).cast("date"))
        hit = date.between(first, last)
        df = df.where(hit | date.isNull() if None in months else hit)
    return df.select(*own.fieldNames())


def export_csv(df: DataFrame, out_dir: str, base_name: str, stamp: _dt.datetime, single_file: bool = True) -> str:
    """K4: ``<out_dir>/<base>_<MM-DD-YYYY_HHMMSS>.csv`` with a header.  ``single_file`` makes that a
    plain file: the (slate-sized) output goes to a draft folder as one part, which is then renamed,
    so a file of that name is always whole.  Large outputs are a folder of that name."""
    spark = df.sparkSession
    target = f"{out_dir.rstrip('/')}/{base_name}_{stamp.strftime('%m-%d-%Y_%H%M%S')}.csv"
    if not single_file:
        with shuffles_freed(spark):
            df.write.mode("overwrite").option("header", True).csv(target)
        return target
    return write_single(df, "csv", out_dir, target.rpartition("/")[2], header=True)


def write_single(df: DataFrame, form: str, out_dir: str, name: str, **options) -> str:
    """``df`` as the plain file ``<out_dir>/<name>``: one part of a draft folder, which is then renamed;
    an older file of that name gives way."""
    spark, target = df.sparkSession, f"{out_dir.rstrip('/')}/{name}"
    draft = f"{out_dir.rstrip('/')}/_draft-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.coalesce(1).write.format(form).options(**options).save(draft)
    fs, folder = _fs(spark, draft)
    parts = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
    _, final = _fs(spark, target)
    if fs.exists(final):  # the same export again: the new one takes its place
        fs.delete(final, True)
    if len(parts) != 1 or not fs.rename(parts[0], final):
        raise RuntimeError(f"could not write {target}")
    fs.delete(folder, True)
    return target


def published_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder of a published table's current version."""
    path = table_path(root, name)
    return f"{path}/{current_version(spark, path)}"


def lasting_view(spark: SparkSession, view: str, folder: str, columns: Sequence[str], where: str | None = None,
                 order_by: Sequence[str] = ()) -> str:
    """K3: a view in the session's catalog over a published folder, created or replaced in one step;
    it outlives the session that made it (in a metastore, the application too)."""
    quoted = ", ".join(f"`{c}`" for c in columns)
    spark.catalog.dropTempView(view)  # a temporary view of that name would hide it
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {quoted} FROM parquet.`{folder}`"
              + (f" WHERE {where}" if where else "") + (f" ORDER BY {', '.join(order_by)}" if order_by else ""))
    return view


def archive_files(spark: SparkSession, paths: Sequence[str], archive_dir: str) -> list[str]:
    """K6: move landing files to a folder; one that is gone already (a repeated call) is left out."""
    moved = []
    jvm = spark.sparkContext._jvm
    for path in paths:
        fs, source = _fs(spark, path)
        _, folder = _fs(spark, archive_dir)
        fs.mkdirs(folder)
        target = jvm.org.apache.hadoop.fs.Path(folder, source.getName())
        if not fs.exists(source):
            continue
        if fs.exists(target):  # an earlier delivery of that name stays beside the new one
            target = jvm.org.apache.hadoop.fs.Path(folder, f"{uuid.uuid4().hex[:8]}-{source.getName()}")
        if fs.rename(source, target):
            moved.append(path)
    return moved


MANIFEST_SCHEMA = T.StructType([
    T.StructField("_file_name", T.StringType(), False),
    T.StructField("feed", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("rows_added", T.LongType(), True),
    T.StructField("length", T.LongType(), True),
    T.StructField("modified", T.TimestampType(), True),
    T.StructField("load_no", T.LongType(), True),
    T.StructField("reason", T.StringType(), True),
])


def record_files(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """K6: one manifest row per processed file (the archive record; replaces moving files)."""
    if rows:
        width = len(MANIFEST_SCHEMA.fields)
        append_log(spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], MANIFEST_SCHEMA), root, "ingest_manifest")


def record_rejected(spark: SparkSession, root: str, feed: str, run_id: str, files: Sequence, reasons: dict[str, str]) -> None:
    """One manifest row for each rejected delivery (``files``: name, length, modified) with its
    reason; a delivery that is recorded already, by an earlier run or a repeated batch, isn't again."""
    known = {(r["_file_name"], r["length"], r["modified"]) for r in rejected_files(spark, root, feed).collect()} if reasons else set()
    record_files(spark, root, [(f["_file_name"], feed, run_id, "rejected", None, f["length"], f["modified"], None, reasons[f["_file_name"]])
                               for f in files if f["_file_name"] in reasons
                               and (f["_file_name"], f["length"], f["modified"]) not in known])


def rejected_files(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Deliveries that were rejected: (_file_name, length, modified, reason)."""
    m = read_log(spark, root, "ingest_manifest", MANIFEST_SCHEMA)
    if "reason" not in m.columns:  # a manifest written before rejections were recorded
        m = m.withColumn("reason", F.lit(None).cast("string"))
    return (m.where((F.col("feed") == feed) & (F.col("status") == "rejected"))
             .select("_file_name", "length", "modified", "reason").distinct())


def processed_files(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Deliveries already loaded: a file is the same delivery if name, length and time agree."""
    m = read_log(spark, root, "ingest_manifest", MANIFEST_SCHEMA)
    return (m.where((F.col("feed") == feed) & (F.col("status") == "ok"))
             .select("_file_name", "length", "modified").distinct())


def next_load(spark: SparkSession, root: str) -> int:
    """Number of the next load: orders rows by when they were inserted.  A load whose rows the season
    state holds but that broke off before its manifest row isn't numbered again."""
    m = read_log(spark, root, "ingest_manifest", MANIFEST_SCHEMA)
    held = published_note(spark, root, "season_state").get("load_no") or 0
    return max(int(m.agg(F.coalesce(F.max("load_no"), F.lit(0))).first()[0]), held) + 1


RUN_SUMMARY_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("files_processed", T.LongType(), True),
    T.StructField("files_overwritten", T.LongType(), True),
    T.StructField("fantasy_rows_dropped", T.LongType(), True),
    T.StructField("absence_rows_inserted", T.LongType(), True),
    T.StructField("errors", T.ArrayType(T.StringType()), True),
    T.StructField("warnings", T.ArrayType(T.StringType()), True),
])


def record_run(spark: SparkSession, root: str, summary: dict) -> None:
    """K7: one row per run."""
    row = tuple(summary.get(f.name) for f in RUN_SUMMARY_SCHEMA.fields)
    append_log(spark.createDataFrame([row], RUN_SUMMARY_SCHEMA), root, "run_summary")


def append_worklist(spark: SparkSession, root: str, run_date: str, resolved: DataFrame) -> None:
    """K5: unresolved slate names with their best candidate and score, one row for each run date and
    name: a repeated run puts its rows in the place of the earlier one's."""
    rows = resolved.where(~F.col("matched")).select(F.lit(run_date).alias("run_date"),
                                                     F.col("mapped").alias("name"),
                                                     F.col("match").alias("best_match"), "score",
                                                     F.col("worklist").alias("text"))
    rows = rows.groupBy("run_date", "name").agg(*[F.min(c).alias(c) for c in ("best_match", "score", "text")])
    stored = read_log(spark, root, "unmatched_names", rows.schema)
    if stored.where(F.col("run_date") == run_date).isEmpty():
        append_log(rows, root, "unmatched_names")
    else:
        replace_log(stored.where(F.col("run_date") != run_date).unionByName(rows), root, "unmatched_names", f"worklist-{run_date}")


def replace_log(df: DataFrame, root: str, name: str, run_id: str) -> str:
    """Rewrite of a log table (repairs, migrations): the new content goes, in the log's layout, to
    a folder of its own, which then becomes current; the old folder stays as the backup."""
    spark, path = df.sparkSession, table_path(root, name)
    _, state = _state(spark, path)
    folder = f"_log-{run_id}-{uuid.uuid4().hex[:8]}"
    schema = _merged_schema(None, df.schema, name)
    with shuffles_freed(spark):
        _laid_out(df, name, schema).mode("errorifexists").parquet(f"{path}/{folder}")
    _set_state(spark, path, {"folder": folder, "schema": json.loads(schema.json())})
    return f"{path}/{state.get('folder', '_log')}"


def schema_fingerprint(df: DataFrame) -> str:
    """A stable hash of the column list and types."""
    import hashlib
    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def record_schema(spark: SparkSession, root: str, run_id: str, table: str, df: DataFrame) -> None:
    row = [(run_id, table, schema_fingerprint(df), ",".join(df.columns))]
    append_log(spark.createDataFrame(row, "run_id string, table_name string, schema_hash string, columns string"),
               root, "schema_snapshots")
