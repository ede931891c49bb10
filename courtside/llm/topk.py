"""Operator 4: exact top-k by integer inner product, with a three-phase uniform threshold.

A score is the sum of ``lists`` local scores, each over one group of components (Cao and Wang's
TPUT).  Per block pair (see ``blocks``):

1. Every local list gives its ``k`` best rows per query; their whole scores are summed, and a
   query's k-th best over all blocks is its cutoff: at least ``k`` rows reach it, so it is safe.
2. The cutoffs go to all blocks.  A row whose sum reaches the cutoff has a local score of at
   least ``cutoff / lists`` in some list (also where scores are negative), so each list gives its
   entries from there on; a row's unseen lists are bounded by that threshold from above, and rows
   whose bound stays under the cutoff are dropped.
3. The remaining rows' missing local scores are looked up and summed exactly.

A query that has fewer than ``k`` candidates has no cutoff and keeps them all.  Components are
``floor(scale * x)``; sums that float64 can't hold exactly are computed in 64-bit integers, so
scores must fit a long.  For nulls, repeated rows and other lengths see ``blocks``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.llm.blocks import block_pairs, clean_vectors, first_k, matrix, search, top
from courtside.llm.common import table

K, EVERY, SCALE, LISTS = 5, 50, 256, 4
STEP = 128  # queries at a time within a block: bounds the score matrices


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """Scaled components rounded down; int64 where float64 sums may be inexact."""
    out = np.floor(scale * x)
    most = float(np.abs(out).max(initial=0.0))
    return out if most * most * out.shape[1] < 2.0 ** 52 else out.astype(np.int64)


def local_scores(q: np.ndarray, v: np.ndarray, lists: int) -> np.ndarray:
    """Array (lists, queries, rows) of partial inner products over groups of components."""
    cuts = np.linspace(0, q.shape[1], min(lists, q.shape[1]) + 1).astype(int)
    return np.stack([q[:, a:b] @ v[:, a:b].T for a, b in zip(cuts[:-1], cuts[1:])])


def _blocks(q: pd.DataFrame, v: pd.DataFrame, scale: int, lists: int):
    """Yields (query ids, query rows, local scores) a few queries at a time; a query's own row
    has no local score anywhere (it is masked by the caller)."""
    a, b = whole(matrix(q["qe"]), scale), whole(matrix(v["e"]), scale)
    if a.dtype != b.dtype:
        a, b = a.astype(np.int64), b.astype(np.int64)
    for i in range(0, len(q), STEP):
        yield q.iloc[i:i + STEP], local_scores(a[i:i + STEP], b, lists)


def _frame(parts: list[tuple]) -> pd.DataFrame:
    q = np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts])
    return pd.DataFrame({
        "query": q,
        "vec_id": np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64),
        "score": np.concatenate([p[2] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)})


def local_lists(k: int, scale: int, lists: int):
    """Phase 1 within a block pair: whole scores of the rows leading any local list."""
    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        ids, number, parts = v["vec_id"].to_numpy(np.int64), v["row"].to_numpy(np.int64), []
        for some, local in _blocks(q, v, scale, lists):
            lead = min(k + 1, len(ids))  # one more, as the query's own row may lead
            at = np.argpartition(local, len(ids) - lead, axis=2)[:, :, len(ids) - lead:]
            for j, query in enumerate(some["query"].to_numpy(np.int64)):
                rows = np.unique(at[:, j, :])
                rows = rows[number[rows] != query]
                score = local[:, j, rows].sum(axis=0)
                best = rows[first_k(score, ids[rows], k)]
                parts.append((query, ids[best], local[:, j, best].sum(axis=0)))
        return _frame(parts)
    return run


def sufficient(k: int, scale: int, lists: int):
    """Phases 2 and 3 within a block pair; queries carry their cutoff (null: none)."""
    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        ids, number, parts = v["vec_id"].to_numpy(np.int64), v["row"].to_numpy(np.int64), []
        for some, local in _blocks(q, v, scale, lists):
            m = local.shape[0]
            cutoffs = some["cutoff"].to_numpy(dtype=object)
            for j, query in enumerate(some["query"].to_numpy(np.int64)):
                if pd.isna(cutoffs[j]):
                    rows = np.arange(len(ids))
                else:
                    cutoff = int(cutoffs[j])
                    seen = local[:, j, :] * m >= cutoff
                    rows = np.flatnonzero(seen.any(axis=0))
                    bound = np.where(seen[:, rows], local[:, j, rows] * m, cutoff).sum(axis=0)
                    rows = rows[bound >= m * cutoff]
                rows = rows[number[rows] != query]
                score = local[:, j, rows].sum(axis=0)
                if len(rows) and not pd.isna(cutoffs[j]):
                    rows, score = rows[score >= cutoff], score[score >= cutoff]
                best = first_k(score, ids[rows], k) if len(rows) else np.zeros(0, np.int64)
                parts.append((query, ids[rows[best]], score[best]))
        return _frame(parts)
    return run


def exact_top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE,
                lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries ``vec_id % every = 0`` against all other rows."""
    vectors = clean_vectors(vectors)
    queries, rows = block_pairs(vectors, every)
    leaders = search(queries, rows, local_lists(k, scale, lists), "long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    cutoffs = (leaders.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
               .where(F.col("r") == k).select(F.col("query").alias("of"), F.col("score").alias("cutoff")))
    queries = queries.join(cutoffs, F.col("query") == F.col("of"), "left").drop("of")
    return top(search(queries, rows, sufficient(k, scale, lists), "long"), k, vectors)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact five best rows of every query of ``embeddings``."""
    return exact_top_k(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN generate_series(1, len(q.e))]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.n <> c.n AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
