"""Operator 9: approximate nearest neighbours by a hash-prefix forest (LSH forest).

Each tree gives a vector a long string of hash bits (signs of seeded random projections); a
block's tree is the sorted array of its rows' strings.  A query descends every tree to its longest
prefix match and then ascends all trees together, one bit at a time, until the trees' matching
ranges hold ``effort`` times the block's rows, counted with repeats; the rows met are candidates,
scored exactly by cosine.

Every row is indexed, in blocks (see ``blocks``), and the best of all blocks are merged.  The
hashes need no fitting.  Equal vectors are one leaf that carries its smallest ids: as only the
``k`` best are asked for and ties go to the smaller id, ``k + 1`` ids (a query's own may be among
them) are exact, and thousands of copies can't crowd out other candidates.

The vectors may be without structure (neighbours hardly nearer than others), where no hash
prunes much: the defaults are set for a recall of at least 0.95 there (measured in the tests).

Zero vectors take no part; for nulls, repeated rows and other lengths see ``blocks``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.blocks import block_pairs, clean_vectors, first_k, matrix, search, top
from courtside.llm.common import table

K, EVERY, TREES, BITS, EFFORT, SEED = 5, 50, 96, 32, 1.2, 7


def hash_strings(x: np.ndarray, trees: int, bits: int, seed: int) -> np.ndarray:
    """Array (rows, trees): each string's bits packed into an integer, first bit highest."""
    planes = np.random.default_rng(seed).standard_normal((x.shape[1], trees * bits))
    place = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    out = [((x[i:i + 512] @ planes > 0).reshape(-1, trees, bits) * place).sum(axis=2)
           for i in range(0, len(x), 512)]
    return np.concatenate(out)


def prefix_ranges(tree: np.ndarray, strings: np.ndarray, depth: np.ndarray, bits: int) -> tuple:
    """Ranges of a sorted array that share each string's first ``depth`` bits."""
    low = (strings >> (bits - depth)) << (bits - depth)
    return np.searchsorted(tree, low), np.searchsorted(tree, low + (np.int64(1) << (bits - depth)))


def candidates(rows: np.ndarray, queries: np.ndarray, bits: int, effort: float, least: int = 0):
    """Yields each query's candidate positions.  rows, queries: hash strings (n, trees).

    The ascent of all trees at once ends at the deepest level whose ranges hold the wanted number;
    as a shorter prefix never holds less, that level is found by bisection.  Where its ranges hold
    fewer than ``least`` different rows, the ascent goes on."""
    n, trees = rows.shape
    order = np.argsort(rows, axis=0, kind="stable")
    trees_sorted = np.ascontiguousarray(np.take_along_axis(rows, order, axis=0).T)
    strings = np.ascontiguousarray(queries.T)
    wanted = effort * n + trees  # a query's own leaf is met by all trees and doesn't count

    def ranges(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [prefix_ranges(trees_sorted[t], strings[t], depth, bits) for t in range(trees)]
        return np.stack([f[0] for f in found]), np.stack([f[1] for f in found])

    enough, short = np.zeros(len(queries), dtype=np.int64), np.full(len(queries), bits + 1, dtype=np.int64)
    while (short - enough > 1).any():
        depth = np.minimum((enough + short) // 2, bits)
        lo, hi = ranges(depth)
        ok = (hi - lo).sum(axis=0) >= wanted
        enough, short = np.where(ok, depth, enough), np.where(ok, short, depth)
    lo, hi = ranges(enough)
    for j in range(len(queries)):
        depth = int(enough[j])
        while True:
            met = np.zeros(n, dtype=bool)
            for t in range(trees):
                met[order[lo[t, j]:hi[t, j], t]] = True
            if not depth or met.sum() >= least:
                break
            depth -= 1
            for t in range(trees):
                lo[t, j], hi[t, j] = prefix_ranges(trees_sorted[t], strings[t, j], np.int64(depth), bits)
        yield np.flatnonzero(met)


def nearest(k: int, trees: int, bits: int, effort: float, seed: int):
    """The k nearest found of each query within a block pair."""
    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        a, b, ids, number = matrix(q["qe"]), matrix(v["e"]), v["vec_id"].to_numpy(np.int64), v["row"].to_numpy(np.int64)
        order = np.argsort(ids, kind="stable")
        leaf, member = np.unique(b, axis=0, return_inverse=True)
        member = member.reshape(-1)
        own_ids = [[] for _ in range(len(leaf))]
        for i in order:  # smallest ids first
            if len(own_ids[member[i]]) <= k:
                own_ids[member[i]].append((ids[i], number[i]))
        length = np.sqrt((leaf * leaf).sum(axis=1))
        unit_leaf, a_length = leaf / length[:, None], np.sqrt((a * a).sum(axis=1))
        unit_a = a / a_length[:, None]
        out_q, out_v, out_s = [], [], []
        found = candidates(hash_strings(unit_leaf, trees, bits, seed),
                           hash_strings(unit_a, trees, bits, seed), bits, effort, k + 1)
        for j, at in enumerate(found):
            query = int(q["query"].iloc[j])
            # The k + 1 best leaves (one may hold the query alone) with ties, then their ids.
            if len(at) > k + 1:
                rough = unit_leaf[at] @ unit_a[j]  # of the candidates alone
                at = at[rough >= np.partition(rough, len(at) - k - 1)[len(at) - k - 1] - 1e-9]
            score = (leaf[at] * a[j]).sum(axis=1) / (length[at] * a_length[j])
            pairs = [(i, s) for at_i, s in zip(at, score) for i, n in own_ids[at_i] if n != query]
            vec = np.array([p[0] for p in pairs], dtype=np.int64)
            value = np.array([p[1] for p in pairs], dtype=np.float64)
            best = first_k(value, vec, k) if len(pairs) else np.zeros(0, np.int64)
            out_q.append(np.full(len(best), query, dtype=np.int64))
            out_v.append(vec[best])
            out_s.append(value[best])
        return pd.DataFrame({"query": np.concatenate(out_q), "vec_id": np.concatenate(out_v),
                             "score": np.concatenate(out_s)})
    return run


def nearest_neighbours(vectors: DataFrame, k: int = K, every: int = EVERY, trees: int = TREES,
                       bits: int = BITS, effort: float = EFFORT, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries ``vec_id % every = 0`` against all other rows."""
    valid = clean_vectors(vectors).where(F.exists("e", lambda x: x != 0))
    queries, rows = block_pairs(valid, every)
    return top(search(queries, rows, nearest(k, trees, bits, effort, seed), "double"), k, valid)


def op9_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest found of every query of ``embeddings``."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
