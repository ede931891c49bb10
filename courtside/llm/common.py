"""Shared helpers of the corpus operators: table access, folds, annotated passes, staging."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.session import checkpoint_dir

BATCH_ROWS = 1000  # rows per Arrow batch: bounds a worker's memory when texts are long


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name (names may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def remainder(doc_id: Column, k: int) -> Column:
    """crc32 of the id's decimal text, mod k (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors, and later jobs don't repeat the work."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def release_memory() -> None:
    """Hand what a worker has freed back to the system (workers serve many tasks in turn)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, with ``release_memory`` after a task's last batch."""
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        release_memory()
    return whole


SHARE = 1000  # a key with more than 1/SHARE of all rows is frequent: there are fewer than SHARE of them


def join_facts(rows: DataFrame, facts: DataFrame, key: str, count: str, how: str = "left") -> DataFrame:
    """``rows`` joined with ``facts``, one row per ``key``, of which ``count`` rows of ``rows`` are.

    Frequent keys, fewer than ``SHARE`` whatever the size, are broadcast; none of the others holds
    enough rows to fill a task of the shuffled join.  Rows with a null key never match.  ``rows`` is
    read twice, so it should be a written table; ``count`` is not returned."""
    total = facts.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    frequent = F.col(count) * SHARE > F.lit(total)
    heavy, light = facts.where(frequent).drop(count), facts.where(~frequent).drop(count)
    joined = rows.join(F.broadcast(heavy), key)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, how)
    return joined.unionByName(rest)


def annotate(docs: DataFrame, keep: Sequence[str], need: Sequence[Column],
             make: Callable[[], Callable[..., list]], out: str) -> DataFrame:
    """One narrow pass over ``docs``: returns (doc struct of ``keep``, the columns of ``out``).

    ``make()`` runs once per task and returns a function from the Arrow arrays of ``need`` to the
    arrays of ``out``.  The kept columns travel inside one struct, so their names can't clash.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    frame = docs.select(F.struct(*[col(c) for c in keep]).alias("doc"),
                        F.struct(*[c.alias(f"c{i}") for i, c in enumerate(need)]).alias("need"))
    added = T.StructType.fromDDL(out)
    schema = T.StructType([frame.schema["doc"], *added.fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *fn(*b.column(1).flatten())], names=names)

    return frame.mapInArrow(releasing(run), schema)


def texts_of(arr: pa.Array) -> list[str]:
    """Strings of an Arrow column; null is the empty text."""
    return [t or "" for t in arr.to_pylist()]


def bounded_sample(labels: DataFrame, label: str, keep: Column, limit: int, seed: int) -> DataFrame:
    """At most ``limit`` labelled ids (doc_id, y) in a seeded hash order; an id labelled more
    than once takes its largest label."""
    return (labels.select(F.col("doc_id"), col(label).cast("int").alias("y"))
            .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & keep)
            .groupBy("doc_id").agg(F.max("y").alias("y"))
            .orderBy(F.xxhash64(F.col("doc_id"), F.lit(seed)), "doc_id").limit(limit))


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (bijective), so that all bits of a hash depend on all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes to floats in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (2.0 ** -53)
