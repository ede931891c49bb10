"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Observation, SparkSession

# Settings the library's semantics depend on (not tuning): UTC dates and ANSI arithmetic.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Scale settings: AQE re-plans joins/partition counts from runtime sizes and splits skewed partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Broadcast only genuinely small sides (dimension lookups, maps); everything else is
    # shuffle-joined unless AQE measures it small at runtime.
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "courtside",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's session and call ``configure``."""
    b = SparkSession.builder.master(master).appName(app)
    conf = {**REQUIRED_CONF, **SCALE_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="courtside-wh-"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="courtside-ckpt-"),
            **(extra or {})}
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``courtside`` importable in Python workers wherever the driver was started from:
    the package's modules are zipped once per application and added with ``addPyFile`` (Spark
    distributes the file to every executor).  Needed by the pandas UDF and mapInPandas steps."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (Connect): ship with the session's artifacts instead
        return
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="courtside-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library's semantics depend on to an existing session, and ship
    the package to the Python workers."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session names none (tests, local runs) is a local folder chosen.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="courtside-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within it, the shuffle files of a write go when it has ended, instead of when the driver happens to
    collect its garbage.  For writes (and frames made for one action): their plan isn't run again."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if was is None else spark.conf.set(SHUFFLE_CLEANUP, was)


_STAGED: set[str] = set()   # names of the folders that this process staged frames in


def stage(df):
    """Write a frame as Parquet into the shared checkpoint folder and read it back: it is computed
    once, columns are pruned on later reads, and lost executors cost nothing."""
    name = f"stage-{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}"
    _STAGED.add(name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames) -> None:
    """Delete what ``stage`` wrote for frames that nothing reads any more (a frame that is derived from
    staged ones frees all of them; other files stay)."""
    for df in frames:
        spark, folders = df.sparkSession, set()
        for file in df.inputFiles():
            found = re.match(r"(.*/(stage-[0-9a-f]{32}))/", file)
            if found and found[2] in _STAGED:
                folders.add(found.groups())
        for folder, name in folders:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
            _STAGED.discard(name)


def stage_observed(df, **measures):
    """``stage``, and ``measures`` (aggregates by name) observed on its write, so that counting takes no
    pass of its own: (staged frame, values).  They sit in the stage that writes, whose tasks count
    once however often they are run again."""
    seen = Observation()
    out = stage(df.observe(seen, *[m.alias(n) for n, m in measures.items()]))
    return out, seen.get


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
