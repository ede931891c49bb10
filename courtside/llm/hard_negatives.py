"""Operator 11: hard-negative mining with segment summaries.

Scores are integer inner products of scaled, rounded-down vectors.  Every vector is cut into 1, 4 and
16 segments; stored are each segment's mean and deviation (the root of the summed squared distances
from the mean).  Over a segment of n components the inner product is n times the means' product plus
a rest that the deviations' product bounds (Cauchy and Schwarz), so the segments' sums bound a score
from both sides.  The rows that a level can't decide are refined by the next, finer one, and only what
is left after the last is scored exactly.

1. Positives: an anchor's ``positives`` best rows of its own label.  A row whose upper bound is under
   the ``positives``-th best lower bound can't be among them.
2. Negatives: for each positive, the best ``negatives`` rows of other labels with a score from
   ``low`` to ``high`` hundredths of the positive's.  A row is dropped when its bounds lie outside the
   window, or under the ``negatives``-th best lower bound of the rows that are surely inside.

Anchors, a stated set, meet all rows in blocks of bounded size; each block pair gives a bounded
number of rows for each anchor and positive, and the best of all blocks are merged.  No label, id or
copy is a key of a shuffle.  Bounds carry a margin for rounding, so results are exact.  How much the
bounds prune depends on the vectors: near-uniform noise of 64 dimensions has hardly anything between
its segments' means, clustered vectors have much.

Rows with a null label or vec_id, a null or empty vector, or a null or non-finite component take no
part; vectors of different lengths are never compared.  Rows that repeat a vec_id (or everything)
count each: an anchor's own row alone is left out.  Ties go to the smaller vec_id.  An anchor without
positives, or a positive without negatives, gives no rows; an empty table gives none.  Extra columns
are ignored.  Scores must fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.llm.common import staged, table

EVERY, SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 50, 256, 5, 3, 50, 95
LEVELS = (1, 4, 16)  # segments of a vector, coarse to fine
ANCHOR_BLOCK, ROW_BLOCK = 2048, 8192


def segment_cuts(dim: int, level: int) -> np.ndarray:
    return np.linspace(0, dim, min(level, dim) + 1).astype(int)


def summarise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) of the segments of all levels, side by side, of rows of one length."""
    means, deviations = [], []
    for level in LEVELS:
        cuts = segment_cuts(x.shape[1], level)
        for a, b in zip(cuts[:-1], cuts[1:]):
            mean = x[:, a:b].mean(axis=1)
            means.append(mean)
            deviations.append(np.sqrt(((x[:, a:b] - mean[:, None]) ** 2).sum(axis=1)))
    return np.stack(means, axis=1), np.stack(deviations, axis=1)


def summarised_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, label, e array<long>, dim, means, deviations) of the vectors that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("e") > 0) & finite)
    v = v.select("vec_id", "label", F.transform("e", lambda x: F.floor(x * scale).cast("long")).alias("e"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "label", "e", "dim", "means", "deviations"]
        for b in batches:
            rows = [np.asarray(x, dtype=np.int64) for x in b.column(2).to_pylist()]
            dims = np.array([len(x) for x in rows], dtype=np.int32)
            means, deviations = [None] * len(rows), [None] * len(rows)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                m, d = summarise(np.stack([rows[i] for i in at]).astype(np.float64))
                for i, mi, di in zip(at, m, d):
                    means[i], deviations[i] = mi, di
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims), pa.array(means, kind), pa.array(deviations, kind)],
                                             names=names)

    made = v.mapInArrow(run, "vec_id long, label long, e array<long>, dim int, means array<double>, deviations array<double>")
    return staged(made.withColumn("row", F.monotonically_increasing_id()))


class Block:
    """A block's vectors with their summaries."""

    def __init__(self, rows: pd.DataFrame):
        self.row, self.vec_id = rows["row"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64)
        self.label = rows["label"].to_numpy(np.int64)
        self.e = np.stack([np.asarray(x, dtype=np.int64) for x in rows["e"]])
        dim = self.e.shape[1]
        most = float(np.abs(self.e).max())
        self.exact_in_floats = most * most * dim < 2.0 ** 52
        if self.exact_in_floats:
            self.e = self.e.astype(np.float64)
        means = np.stack([np.asarray(x, dtype=np.float64) for x in rows["means"]])
        deviations = np.stack([np.asarray(x, dtype=np.float64) for x in rows["deviations"]])
        self.levels, start = [], 0
        for level in LEVELS:
            cuts = segment_cuts(dim, level)
            end = start + len(cuts) - 1
            self.levels.append((means[:, start:end], deviations[:, start:end], np.diff(cuts).astype(np.float64)))
            start = end
        self.norm = np.sqrt(dim * means[:, 0] ** 2 + deviations[:, 0] ** 2)

    def bounds(self, level: int, at: np.ndarray, anchors: Block, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Whole-number bounds of the scores of the rows ``at`` with anchor ``j``."""
        means, deviations, lengths = self.levels[level]
        a_means, a_deviations, _ = anchors.levels[level]
        middle = means[at] @ (lengths * a_means[j])
        spread = deviations[at] @ a_deviations[j] + 1e-10 * self.norm[at] * anchors.norm[j] + 1e-6
        return np.ceil(middle - spread), np.floor(middle + spread)

    def scores(self, at: np.ndarray, anchors: Block, j: int) -> np.ndarray:
        rows, anchor = self.e[at], anchors.e[j]
        if rows.dtype != anchor.dtype:
            rows, anchor = rows.astype(np.int64), anchor.astype(np.int64)
        return (rows @ anchor).astype(np.int64)


def refine(block: Block, at: np.ndarray, anchors: Block, j: int,
           needed: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of the rows that ``needed`` (of the lower and upper bounds) keeps at every level."""
    for level in range(len(LEVELS)):
        if not len(at):
            break
        at = at[needed(*block.bounds(level, at, anchors, j))]
    return at, block.scores(at, anchors, j)


def among_best(k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be among the ``k`` best."""
    def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) <= k:
            return np.ones(len(low), dtype=bool)
        return high >= np.partition(low, len(low) - k)[len(low) - k]
    return needed


def among_best_inside(windows: list[tuple[int, int]], k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be among the ``k`` best of any window's (first and last score)."""
    def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), dtype=bool)
        for first, last in windows:
            inside = low[(low >= first) & (high <= last)]
            floor = first if len(inside) < k else np.partition(inside, len(inside) - k)[len(inside) - k]
            keep |= (high >= floor) & (low <= last)
        return keep
    return needed


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _frame(columns: str, parts: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in columns.split(", ")]
    return pd.DataFrame({n: np.concatenate([np.atleast_1d(p[i]) for p in parts]) if parts else np.zeros(0, np.int64)
                         for i, n in enumerate(names)})


FOUND = "anchor long, vec_id long, score long"
OWN = {f"a_{c}": c for c in ("row", "vec_id", "label", "e", "means", "deviations")}  # the anchors' side
MINED = "anchor long, place int, vec_id long, score long"


def find_positives(k: int):
    def run(a: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(a) and len(v):
            anchors, block = Block(a.rename(columns=OWN)), Block(v.sort_values("label", kind="stable"))
            for j in range(len(anchors.row)):
                first, last = np.searchsorted(block.label, anchors.label[j], "left"), np.searchsorted(block.label, anchors.label[j], "right")
                at = np.arange(first, last)
                at, score = refine(block, at[block.row[at] != anchors.row[j]], anchors, j, among_best(k))
                at, score = at[top := best(score, block.vec_id[at], k)], score[top]
                parts.append((np.full(len(at), anchors.row[j]), block.vec_id[at], score))
        return _frame(FOUND, parts)
    return run


def windows_of(scores: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """First and last whole score from ``low`` to ``high`` hundredths of each score."""
    return [(-(-low * s // 100), high * s // 100) for s in map(int, scores)]


def find_negatives(k: int, low: int, high: int):
    """Anchors carry their positives' scores, best first; ``place`` counts them from 0."""
    def run(a: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(a) and len(v):
            anchors, block = Block(a.rename(columns=OWN)), Block(v)
            for j, positive in enumerate(a["positive_scores"]):
                windows = windows_of(positive, low, high)
                at = np.flatnonzero(block.label != anchors.label[j])
                at, score = refine(block, at, anchors, j, among_best_inside(windows, k))
                for place, (first, last) in enumerate(windows):
                    inside = np.flatnonzero((score >= first) & (score <= last))
                    inside = inside[best(score[inside], block.vec_id[at[inside]], k)]
                    parts.append((np.full(len(inside), anchors.row[j]), np.full(len(inside), place),
                                  block.vec_id[at[inside]], score[inside]))
        return _frame(MINED, parts)
    return run


def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = EVERY, scale: int = SCALE, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors``
    (vec_id, embedding, label); anchors are the rows with ``vec_id % every = 0``."""
    rows = summarised_vectors(vectors, scale)
    anchors = rows.where(F.col("vec_id") % every == 0)
    n, q = rows.count(), anchors.count()
    row_blocks, anchor_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-q // ANCHOR_BLOCK))
    place = F.xxhash64("row")
    dealt = (rows.withColumn("rb", F.pmod(place, F.lit(row_blocks)))
             .withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)).cast("array<long>"))))
    asking = (anchors.withColumn("ab", F.pmod(place, F.lit(anchor_blocks)))
              .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)).cast("array<long>"))))
    asking = asking.select(*[F.col(c).alias(f"a_{c}") for c in asking.columns])

    def meet(some: DataFrame, run, schema: str) -> DataFrame:
        return (some.groupBy("a_dim", "a_ab", "a_rb").cogroup(dealt.groupBy("dim", "ab", "rb")).applyInPandas(run, schema))

    found = ranked(meet(asking, find_positives(positives), FOUND), ["anchor"], positives)
    found = staged(found.select("anchor", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"),
                                F.col("score").alias("positive_score")))
    lists = found.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    lists = lists.select(F.col("anchor").alias("a_row"), F.col("p.positive_score").alias("positive_scores"))
    mined = ranked(meet(asking.join(lists, "a_row"), find_negatives(negatives, low, high), MINED), ["anchor", "place"], negatives)
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (mined.join(found, ["anchor", "place"]).join(named, "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of ``embeddings``, with every seventh label moved by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT a.n AS a, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS vec_id,
         CAST(list_sum([a.e[i] * c.e[i] FOR i IN generate_series(1, len(a.e))]) AS BIGINT) AS score
  FROM v a JOIN v c ON a.n <> c.n AND len(a.e) = len(c.e)
  WHERE a.vec_id % 50 = 0),
p AS (
  SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same),
r AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.a, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
  WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3
"""
