"""Operator 3: mixing sources to target weights by subset-sum budget fitting.

Sizes are word counts.  Each source's target is its share of all words by weight, at most
``most`` times its own size (the excess goes to the others by weight).  A source's documents are
taken whole: ``floor(target / size)`` full passes, and for the remaining budget a seeded subset
whose sizes add up to it:

1. Documents are counted by (source, exact size, hash bucket): the only shuffle of all rows, and
   a pre-aggregated one, so a source or size holding a third of the rows is no hot task.
2. Per source, on the histogram of sizes alone: every size class gives its proportional share of
   documents; what rounding leaves over is filled by whole documents down to a few lengths of the
   largest document, and the rest by bounded-knapsack dynamic programming (reachable sums over
   the spare counts, split into powers of two).
3. Of each (source, size) class the documents with the smallest seeded hashes of id and text are
   taken: whole hash buckets by their counts, and in the one bucket that is cut, by rank, ties by a
   hash of all columns kept (but maps), so that reruns agree on rows without or with repeated ids too.

Null text: size 0.  Null source: a source of its own, last in order.  Documents of size 0 hold no
words and are taken by full passes only.  Repeated rows count one by one.  Empty table: no rows.  The
dynamic program's arrays have about twice as many entries as the longest text has words.
Extra columns are ignored by ``plan_mix`` and kept by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from courtside.llm.common import col, staged, table

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
SEED = 20260
BUCKETS = 256
DP_SPAN = 16_384  # words left to the dynamic program, at least

WORD_AND_SPACE = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def size_of(text: Column) -> Column:
    """Number of words (runs of anything but the six ASCII white-space characters)."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\u000b\f\r"))
    return F.length(F.regexp_replace(inner, WORD_AND_SPACE, "x")).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, most: float = MOST) -> list[float]:
    """Target words of sources in order: shares by (repeating) weight, none above ``most`` times
    its size, what is cut off shared again by weight."""
    n = len(sizes)
    w = np.array([weights[i % len(weights)] for i in range(n)], dtype=np.float64)
    cap = most * np.array(sizes, dtype=np.float64)
    out, free = np.zeros(n), np.ones(n, dtype=bool)
    total = float(sum(sizes))
    while free.any():
        share = max(0.0, total - cap[~free].sum()) / w[free].sum()
        out = np.where(free, w * share, cap)
        above = free & (out > cap)
        if not above.any():
            break
        free &= ~above
    return [float(x) for x in np.minimum(out, cap)]


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each size (distinct, positive) to take, so that the sizes add up to
    ``budget`` as nearly as can be: proportional shares, whole documents, then dynamic program."""
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(sizes), dtype=np.int64)
    if budget >= total:
        return counts.astype(np.int64).copy()
    span = max(DP_SPAN, 2 * int(sizes.max()))
    spread = max(0, budget - span)
    take = np.array([int(c) * spread // total for c in counts], dtype=np.int64)
    spare = counts - take
    left = budget - int((sizes * take).sum())
    order = np.random.default_rng(seed).permutation(len(sizes))
    for i in order:  # whole documents, one size after the other, down to the program's span
        k = min(int(spare[i]), max(0, (left - span) // int(sizes[i])))
        take[i] += k
        spare[i] -= k
        left -= k * int(sizes[i])
    # Reachable sums: items are sizes times powers of two of the spare counts.
    top = left + int(sizes.max())  # the sum just above the budget may be nearer
    first = np.full(top + 1, -1, dtype=np.int64)
    reach = np.zeros(top + 1, dtype=bool)
    reach[0] = True
    items: list[tuple[int, int]] = []
    for i in order:
        rest, step, s = int(spare[i]), 1, int(sizes[i])
        while rest > 0 and not reach[left]:
            k = min(step, rest)
            if k * s > top:
                k = top // s
                rest = min(rest, k)
                if not k:
                    break
            new = np.flatnonzero(reach[:top + 1 - k * s] & ~reach[k * s:]) + k * s
            reach[new] = True
            first[new] = len(items)
            items.append((i, k))
            rest -= k
            step *= 2
        if reach[left]:
            break
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - left) * 2 + (sums > left))])
    while at > 0:
        i, k = items[first[at]]
        take[i] += k
        at -= k * int(sizes[i])
    return take


def _has_map(dtype: T.DataType) -> bool:
    """Whether values of the type can't be hashed: maps, also within other types."""
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return _has_map(dtype.elementType) if isinstance(dtype, T.ArrayType) else isinstance(dtype, (T.MapType, T.VariantType))


def plan_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST,
             seed: int = SEED, keep: Sequence[str] | None = None) -> DataFrame:
    """Struct ``doc`` (columns ``keep``, all by default) and struct ``mix`` (size, source_size,
    target, passes): how often the mix takes each document."""
    spark = docs.sparkSession
    kept = [docs.schema[c] for c in (keep or docs.columns)]
    rows = docs.select(F.struct(*[col(c) for c in (keep or docs.columns)]).alias("doc"),
                       col("source").cast("string").alias("source"),
                       size_of(col("text").cast("string")).alias("size"),
                       F.xxhash64(col("doc_id"), col("text"), F.lit(seed)).alias("h"),
                       F.xxhash64(*[col(f.name) for f in kept if not _has_map(f.dataType)]).alias("tie"))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    # written once: totals, classes and cuts read the counts, the texts are read for them only here
    hist = staged(rows.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")))
    classes = hist.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # One row per source (metadata): ordered by code point, null last.
    per = sorted(totals.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    aim = targets([int(r["source_size"]) for r in per], weights, most)
    plan = spark.createDataFrame(
        [(r["source"], int(r["source_size"]), t) for r, t in zip(per, aim)],
        "source string, source_size long, target double")

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        total, target = int(pdf["source_size"][0]), float(pdf["target"][0])
        full = min(int(target // total), int(most)) if total else int(most)
        sizes, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        pos = sizes > 0
        extra = np.zeros(len(pdf), dtype=np.int64)
        budget = int(round(target)) - full * total
        if full < most:
            extra[pos] = fit(sizes[pos], counts[pos], budget, seed)
        return pd.DataFrame({"source": pdf["source"], "size": sizes, "source_size": total,
                             "target": target, "full": full, "extra": extra})

    same_source = classes["source"].eqNullSafe(plan["source"])
    chosen = (classes.join(F.broadcast(plan), same_source)
              .select(classes["source"], "size", "n", "source_size", "target")
              .groupBy("source").applyInPandas(
                  fitted, "source string, size long, source_size long, target double, full int, extra long"))
    # Hash buckets in order: those wholly within ``extra`` are taken whole, one bucket is cut.
    up_to = Window.partitionBy("source", "size").orderBy("bucket")
    h, c = hist.alias("h"), chosen.alias("c")
    cuts = (h.withColumn("before", F.sum("n").over(up_to) - F.col("n")).alias("h")
            .join(c, F.col("h.source").eqNullSafe(F.col("c.source")) & (F.col("h.size") == F.col("c.size")))
            .select(F.col("h.source").alias("source"), F.col("h.size").alias("size"), "bucket",
                    F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.col("before"))).alias("quota"),
                    "n", "source_size", "target", "full"))
    r, k = rows.alias("r"), cuts.alias("k")
    joined = r.join(k, F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r.size") == F.col("k.size"))
                    & (F.col("r.bucket") == F.col("k.bucket")))
    joined = joined.select("r.doc", "r.source", "r.size", "r.h", "r.tie", "r.bucket", "k.quota", "k.n",
                           "k.source_size", "k.target", "k.full")
    whole = joined.where((F.col("quota") == 0) | (F.col("quota") == F.col("n"))) \
        .withColumn("extra", (F.col("quota") > 0).cast("int"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "tie"))
    cut = joined.where((F.col("quota") > 0) & (F.col("quota") < F.col("n"))) \
        .withColumn("extra", (rank <= F.col("quota")).cast("int"))
    return whole.unionByName(cut).select(
        "doc", F.struct("size", "source_size", "target", (F.col("full") + F.col("extra")).alias("passes")).alias("mix"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, with its own columns."""
    taken = plan_mix(docs, weights, most, seed).where("mix.passes > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("mix.passes")))).select("doc.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return plan_mix(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), F.col("mix.size").alias("size"),
        F.col("mix.source_size").alias("source_size"), F.col("mix.target").alias("target"),
        (F.col("mix.size") * F.col("mix.passes")).alias("taken"))
