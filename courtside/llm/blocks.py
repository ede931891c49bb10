"""A stated query set against all vectors, in blocks.

Queries and vectors are hashed into blocks of a bounded number of rows; each pair of a query
block and a vector block is one group, so the work is spread evenly whatever the data hold and
no task grows with the table.  Per group a function returns each query's best rows; the best of
all groups are the best of all.

Vectors that are null, empty or hold null or non-finite components take no part.  Vectors of
different lengths are never compared.  Rows that repeat a vec_id (or everything) count each: as a
query of their own, and as a candidate of every query but themselves.  Empty table: no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.llm.common import staged

QUERY_BLOCK, VECTOR_BLOCK = 512, 4096
FOUND = "query long, vec_id long, score {score}"  # query: the row number of the query's row


def clean_vectors(df: DataFrame) -> DataFrame:
    """(row, vec_id, e array<double>, dim) of the vectors that take part, numbered and written."""
    v = df.select(F.col("vec_id").cast("long").alias("vec_id"),
                  F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    v = v.where(F.col("vec_id").isNotNull() & (F.size("e") > 0) & finite)
    return staged(v.withColumn("dim", F.size("e")).withColumn("row", F.monotonically_increasing_id()))


def block_pairs(vectors: DataFrame, every: int) -> tuple[DataFrame, DataFrame]:
    """(queries, vectors), keyed by length, query block and vector block (on the queries' side
    with the prefix ``q_``): every query meets every vector once."""
    n, q = vectors.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    nv, nq = max(1, -(-n // VECTOR_BLOCK)), max(1, -(-q // QUERY_BLOCK))
    block = F.xxhash64("row")
    queries = (vectors.where(F.col("vec_id") % every == 0)
               .select(F.col("row").alias("query"), F.col("e").alias("qe"), F.col("dim").alias("q_dim"),
                       F.pmod(block, F.lit(nq)).cast("int").alias("q_qb"),
                       F.explode(F.sequence(F.lit(0), F.lit(nv - 1))).alias("q_vb")))
    rows = (vectors.withColumn("vb", F.pmod(block, F.lit(nv)).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))
    return queries, rows


def search(queries: DataFrame, rows: DataFrame, best: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
           score: str) -> DataFrame:
    """Cogroup each block pair and apply ``best``; rows (query, vec_id, score)."""
    schema = FOUND.format(score=score)
    empty = pd.DataFrame({"query": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64),
                          "score": np.zeros(0, np.int64 if score == "long" else np.float64)})

    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        return best(q, v) if len(q) and len(v) else empty

    left, right = queries.groupBy("q_dim", "q_qb", "q_vb"), rows.groupBy("dim", "qb", "vb")
    return left.cogroup(right).applyInPandas(run, schema)


def top(found: DataFrame, k: int, vectors: DataFrame) -> DataFrame:
    """Each query's ``k`` highest scores, ties to the smaller vec_id, with their ranks: (query_id,
    rank, vec_id, score)."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = vectors.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return best.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column])


def first_k(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]
