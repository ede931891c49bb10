"""Operator 13: conversation prefix trie, rolled up by centroid decomposition.

Conversations that begin with the same turns share nodes of a trie; per node its members, children,
leaves, the tokens that sharing saves and a digest of the conversations that end there.

**Paths.**  Turns are numbered per conversation: a range shuffle sorts them, every partition counts
its own, and the few conversations that cross a partition border get an offset.  A node is known by
its depth and the sum, over its turns, of digests of (depth, role, text): four sums of 30-bit parts,
kept modulo 2^30.  A running sum gives every prefix's node, and subtracting the last turn gives its
parent, without a join.  Conversations of any length are dealt in chunks of ``CHUNK`` turns.

**Rollup.**  Sums over subtrees come from a centroid decomposition of the parent-edge forest.  Every
component has a top and subtree sizes; the nodes whose subtree holds at least half of it form the
path from the top to the centroid, the deepest of them.  Removing the centroid splits the component
into its children's subtrees and the rest above; the component's total below and at the centroid is
added to the nodes of the path, and the parts are split in turn.  All components are split together,
a round each; components of at most ``LIMIT`` nodes are decomposed within a task, in buckets of a
bounded number of nodes, so there are some log2(nodes / LIMIT) rounds.  The frequent node that a
third of all conversations pass is joined by broadcast (``common.join_facts``); a round's centroids,
at most ``CENTROIDS``, are broadcast too, larger components first, the others wait.

**Digests.**  The ids that end at a node are sorted by a range shuffle and joined into pieces of
``PIECE`` ids, so a node's task streams few rows however many conversations end there.

Turns are ordered by turn (null first), equal turns by the digest of role and text; null role or text
is empty.  Rows without a conv_id take no part.  Repeated rows are turns of their own.  Texts are
counted in code points.  Empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtside.llm.common import join_facts, staged, table

CHUNK = 256  # turns of one conversation that are dealt together
LIMIT = 20_000  # nodes of a component that is decomposed within a task
CENTROIDS = 50_000  # components split in one round
PIECE = 4096  # conversation ids in a piece of a digest's input
PART = 30  # bits of a node's identity in each of its four parts
FAMILY, HEADS = 100, 6  # conversations of a family begin with up to HEADS - 1 turns of its first


def _chunk(position: Column) -> Column:
    return F.floor(position / CHUNK).cast("long")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, size): what is needed of every turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    digest.alias("digest"), F.length(text).cast("long").alias("size")))


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position from 1, digest, size) in the order of turn (null first) and digest."""
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("digest")]
    # Equal rows are dealt over several partitions too: which is which doesn't matter.
    dealt = (turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order, "tie")
             .sortWithinPartitions(*order).select("conv_id", "digest", "size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            start = np.repeat(first, np.diff(np.append(first, len(ids))))
            local = np.arange(len(ids)) - start + 1
            if ids[0] == last:
                local[start == 0] += seen
            last, seen = ids[-1], int(local[-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(ids), part, np.int32)), pa.array(local.astype(np.int64))],
                names=["conv_id", "digest", "size", "part", "local"])

    rows = staged(dealt.mapInArrow(run, "conv_id long, digest string, size long, part int, local long"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one conversation of a partition began in an earlier one: no more rows than partitions.
    offsets = (rows.groupBy("conv_id", "part").agg(F.max("local").alias("n"))
               .withColumn("offset", F.sum("n").over(earlier)).where("offset > 0").drop("n"))
    return (rows.join(F.broadcast(offsets), ["conv_id", "part"], "left")
            .select("conv_id", (F.col("local") + F.coalesce("offset", F.lit(0))).alias("position"), "digest", "size"))


def by_chunk(convs: DataFrame, length: str) -> DataFrame:
    """One row for each chunk of every conversation, to be joined on (conv_id, chunk)."""
    return convs.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), _chunk(F.col(length)))))


def share_heads(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, size): every conversation rebuilt with the first turns of its family's
    first conversation, crc32(conv_id) mod ``HEADS`` of them, in place of its own."""
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("head")
    first = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.col("turns").alias("there"))
    members = (convs.select("conv_id", "turns", family.alias("family"), head).join(first, "family", "left")
               .withColumn("shared", F.least("head", F.coalesce("there", F.lit(0)))))
    own = (turns.withColumn("chunk", _chunk(F.col("position")))
           .join(by_chunk(members.drop("family"), "turns"), ["conv_id", "chunk"])
           .where(F.col("position") > F.col("head"))
           .select("conv_id", (F.col("position") - F.col("head") + F.col("shared")).alias("depth"), "digest", "size"))
    shared = (turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("position") < HEADS))
              .select(F.col("conv_id").alias("family"), F.col("position").alias("depth"), "digest", "size")
              .join(members.select("conv_id", "family", "head"), "family").where(F.col("depth") <= F.col("head"))
              .select("conv_id", "depth", "digest", "size"))
    return own.unionByName(shared)


def _node(depth: Column, parts: list[Column]) -> Column:
    inside = [F.hex(F.pmod(p, F.lit(1 << PART))) for p in parts]
    return F.concat_ws(".", depth.cast("string"), *inside)


ROOT = "0.0.0.0.0"


def trie_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, size) of (conv_id, depth from 1 without gaps, digest, size)."""
    mark = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "digest").cast("binary"), 256)
    width = 1 << PART
    rows = staged(turns.withColumn("chunk", _chunk(F.col("depth"))).withColumn("mark", mark).select(
        "conv_id", "depth", "size", "chunk",
        *[F.pmod(F.conv(F.substring("mark", 1 + 8 * i, 8), 16, 10).cast("long"), F.lit(width)).alias(f"k{i}")
          for i in range(4)]))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("conv_id", "chunk").agg(*[F.sum(f"k{i}").alias(f"s{i}") for i in range(4)])
    offsets = chunks.select("conv_id", "chunk", *[F.sum(f"s{i}").over(before).alias(f"o{i}") for i in range(4)])
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("*", *[F.sum(f"k{i}").over(inside).alias(f"r{i}") for i in range(4)])
    whole = summed.join(offsets.where("chunk > 0"), ["conv_id", "chunk"], "left")
    sums = [F.col(f"r{i}") + F.coalesce(f"o{i}", F.lit(0)) for i in range(4)]
    return whole.select("conv_id", "depth", _node(F.col("depth"), sums).alias("node"),
                        _node(F.col("depth") - 1, [s - F.col(f"k{i}") for i, s in enumerate(sums)]).alias("parent"), "size")


def trie_nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(node, parent, depth, size, conv_id, n_convs, n_children), the root with them: its members are
    all of ``convs``."""
    below = paths.groupBy("node").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("size").alias("size"),
                                      F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = (convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
            .select(F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
                    F.lit(0).cast("long").alias("size"), "conv_id", "n_convs"))
    nodes = staged(below.unionByName(root))
    children = nodes.where("depth > 0").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    return staged(nodes.join(children.withColumnRenamed("parent", "node"), "node", "left")
                  .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))


# --- subtree sums by centroid decomposition -------------------------------------------------------

SUMMED = "node string, {}"


def decompose(parents: list[int], depths: list[int], values: np.ndarray) -> np.ndarray:
    """Subtree sums of a forest (``parents``: positions, -1 for a top) by centroid decomposition."""
    n = len(parents)
    order = sorted(range(n), key=depths.__getitem__)
    size, top = [1] * n, list(range(n))
    for u in reversed(order):
        if parents[u] >= 0:
            size[parents[u]] += size[u]
    trees: dict[int, list[int]] = {}
    for u in order:  # tops come before what is below them
        if parents[u] >= 0:
            top[u] = top[parents[u]]
        trees.setdefault(top[u], []).append(u)
    added = np.zeros_like(values)
    out = values.copy()
    parts, side = list(trees.values()), [0] * n
    while parts:
        part = parts.pop()  # a component's nodes, its top first
        whole = len(part)
        if whole == 1:
            out[part[0]] = values[part[0]] + added[part[0]]
            continue
        centroid = next(u for u in reversed(part) if 2 * size[u] >= whole)
        split: dict[int, list[int]] = {-1: []}
        for u in part:
            side[u] = -2 if u == centroid else u if parents[u] == centroid else side[parents[u]] if u != part[0] else -1
            if u != centroid:
                split.setdefault(side[u], []).append(u)
        above = split.pop(-1)
        total = values[[centroid, *(u for s in split.values() for u in s)]].sum(axis=0)
        out[centroid] = total + added[centroid]
        u = centroid
        while u != part[0]:
            u = parents[u]
            size[u] -= size[centroid]
            added[u] += total
        parts.extend(split.values())
        if above:
            parts.append(above)
    return out


def _decompose_components(values: list[str]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        at = {node: i for i, node in enumerate(rows["node"])}
        parents = [-1 if node == comp else at[parent]
                   for node, parent, comp in zip(rows["node"], rows["parent"], rows["comp"])]
        sums = decompose(parents, rows["depth"].tolist(), rows[values].to_numpy(np.int64))
        sums += rows[[f"added_{v}" for v in values]].to_numpy(np.int64)
        # What was added to a node stays its own: it was added to all of its path up to the old top.
        return pd.DataFrame({"node": rows["node"], **{v: sums[:, i] for i, v in enumerate(values)}})
    return run


def owned_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Path rows of the conversations that own a node (are its smallest member), with the sizes of the
    subtrees: (conv_id, length, depth, node, parent, own, nodes_below)."""
    owners = nodes.select("node", F.col("conv_id").alias("owner"), "n_convs")
    rows = staged(join_facts(paths.select("conv_id", "depth", "node", "parent"), owners, "node", "n_convs", "inner")
                  .withColumn("own", F.col("owner") == F.col("conv_id")).drop("owner"))
    # A conversation owns its path from some depth to its end.
    owned = rows.where("own").groupBy("conv_id").agg(F.count(F.lit(1)).alias("owned"), F.max("depth").alias("length"))
    kept = staged(rows.withColumn("chunk", _chunk(F.col("depth")))
                  .join(by_chunk(owned, "length"), ["conv_id", "chunk"]).drop("chunk"))
    elsewhere = F.when(F.col("own"), F.col("owned") - (F.col("length") - F.col("depth") + 1)).otherwise(0)
    sizes = kept.groupBy("node").agg((F.sum("owned") - F.sum(elsewhere)).alias("nodes_below"), F.count(F.lit(1)).alias("n"))
    return join_facts(kept.drop("owned"), sizes, "node", "n")


def split_components(state: DataFrame, values: list[str], centroids: int = CENTROIDS) -> tuple[DataFrame, DataFrame]:
    """One round over components: (rows of the parts, finished centroids with their sums)."""
    heavy = state.where(F.col("own") & (2 * F.col("nodes_below") >= F.col("comp_size")))
    found = (heavy.groupBy("comp", "comp_size")
             .agg(F.min_by(F.struct("node", "depth", "nodes_below"), "nodes_below").alias("c"))
             .orderBy(F.desc("comp_size"), "comp").limit(centroids))
    found = staged(found.select("comp", F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"),
                                F.col("c.nodes_below").alias("c_below")))
    rows = state.join(F.broadcast(found), "comp", "left")
    marks = (rows.where(F.col("parent") == F.col("c_node"))
             .select("conv_id", "comp", F.col("node").alias("to"), F.col("nodes_below").alias("to_size"),
                     F.explode(F.sequence(_chunk(F.col("depth")), _chunk(F.col("length")))).alias("chunk")))
    placed = (rows.withColumn("chunk", _chunk(F.col("depth"))).join(marks, ["conv_id", "comp", "chunk"], "left")
              .withColumn("below", F.col("to").isNotNull() & (F.col("depth") > F.col("c_depth")))
              .withColumn("at", F.coalesce(F.col("node") == F.col("c_node"), F.lit(False))).drop("chunk"))
    placed = staged(placed)
    totals = (placed.where(F.col("own") & (F.col("below") | F.col("at"))).groupBy("comp")
              .agg(*[F.sum(v).alias(f"total_{v}") for v in values]))
    placed = placed.join(F.broadcast(totals), "comp", "left")
    finished = placed.where(F.col("own") & F.col("at")).select(
        "node", *[(F.col(f"total_{v}") + F.col(f"added_{v}")).alias(v) for v in values])
    above = F.col("c_node").isNotNull() & ~F.col("below")
    path = above & (2 * F.col("nodes_below") >= F.col("comp_size"))
    parts = placed.where(~F.col("at")).select(
        F.when(F.col("below"), F.col("to")).otherwise(F.col("comp")).alias("comp"),
        F.when(F.col("below"), F.col("to_size")).when(above, F.col("comp_size") - F.col("c_below"))
         .otherwise(F.col("comp_size")).alias("comp_size"),
        F.when(path, F.col("nodes_below") - F.col("c_below")).otherwise(F.col("nodes_below")).alias("nodes_below"),
        "conv_id", "length", "depth", "node", "parent", "own", *values,
        *[F.when(path, F.col(f"added_{v}") + F.col(f"total_{v}")).otherwise(F.col(f"added_{v}")).alias(f"added_{v}") for v in values])
    return parts, finished


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], limit: int = LIMIT,
           centroids: int = CENTROIDS) -> DataFrame:
    """(node, sums of ``values`` over the node's subtree).  ``nodes``: as of ``trie_nodes`` with long
    columns ``values``; ``paths``: as of ``trie_paths``."""
    total = nodes.count()
    added = [F.lit(0).cast("long").alias(f"added_{v}") for v in values]
    start = [F.lit(ROOT).alias("comp"), F.lit(total).cast("long").alias("comp_size")]
    own = nodes.select("node", "parent", "depth", *values, *added, *start)
    parts, finished = [], []
    if total <= limit:
        parts.append(own)
    else:
        rows = owned_paths(nodes, paths)
        mine = rows.where("own").join(nodes.select("node", *values), "node").select("*", *added)
        other = rows.where("not own").select("*", *[F.lit(None).cast("long").alias(c) for v in values for c in (v, f"added_{v}")])
        root = nodes.where("depth = 0").select(
            "conv_id", F.lit(0).cast("long").alias("length"), "depth", "node", "parent", F.lit(True).alias("own"),
            F.lit(total).cast("long").alias("nodes_below"), *values, *added)
        state = staged(mine.unionByName(other).unionByName(root).select("*", *start))
        while True:
            split, done = split_components(state, values, centroids)
            finished.append(done)
            split = staged(split)
            parts.append(split.where(F.col("own") & (F.col("comp_size") <= limit)))
            state = split.where(F.col("comp_size") > limit)
            if state.isEmpty():
                break
    small = parts[0].select(own.columns)
    for part in parts[1:]:
        small = small.unionByName(part.select(own.columns))
    buckets = max(1, -(-total // (4 * limit)))
    sums = (small.withColumn("bucket", F.pmod(F.xxhash64("comp"), F.lit(buckets))).groupBy("bucket")
            .applyInPandas(_decompose_components(values), SUMMED.format(", ".join(f"{v} long" for v in values))))
    for done in finished:
        sums = sums.unionByName(done)
    return sums


# --- digests of the conversations that end at a node ----------------------------------------------

def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): SHA-256 of the ids, ascending, joined by commas."""
    dealt = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").select("node", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "first", "ids"]
        for b in batches:
            node, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            out, i = ([], [], []), 0
            while i < len(node):
                j = i + 1
                while j < len(node) and j - i < PIECE and node[j] == node[i]:
                    j += 1
                for column, v in zip(out, (node[i], ids[i], ",".join(map(str, ids[i:j])))):
                    column.append(v)
                i = j
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.string())], names=names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, current, state = ["node", "ends_sha256"], None, None

        def batch(rows: list[tuple[str, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=names)

        for b in batches:
            out = []
            for node, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if node == current:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out.append((current, state.hexdigest()))
                current, state = node, hashlib.sha256(ids.encode())
            yield batch(out)
        if state:
            yield batch([(current, state.hexdigest())])

    cut = dealt.mapInArrow(pieces, "node string, first long, ids string")
    return (cut.repartition("node").sortWithinPartitions("node", "first")
            .mapInArrow(digests, "node string, ends_sha256 string"))


def conversation_trie(conversations: DataFrame, limit: int = LIMIT, centroids: int = CENTROIDS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of
    every node of the trie of the rebuilt conversations (``share_heads``)."""
    turns = staged(number_turns(turn_rows(conversations)))
    convs = staged(turns.groupBy("conv_id").agg(F.max("position").alias("turns")))
    paths = staged(trie_paths(share_heads(turns, convs)))
    nodes = trie_nodes(paths, convs)
    saved = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("size")).otherwise(0)
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    valued = nodes.withColumn("n_leaves", leaf.cast("long")).withColumn("saved_tokens", saved.cast("long"))
    sums = rollup(valued, paths, ["n_leaves", "saved_tokens"], limit, centroids)
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "node")).alias("last"))
    ends = convs.select("conv_id").join(last, "conv_id", "left").select(
        F.coalesce("last.node", F.lit(ROOT)).alias("node"), "conv_id")
    above = (nodes.where("n_children > 0")
             .select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
             .withColumnRenamed("n_children", "of"))
    with_parent = join_facts(nodes.drop("size"), above, "parent", "of")
    nothing = hashlib.sha256(b"").hexdigest()
    return (with_parent.join(sums, "node").join(end_digests(ends), "node", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all of ``conversations``, with the first turns shared within families."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


_BYTE = ("list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]), "
         "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))")
ORACLE_SQL = f"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(text, '') AS text,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS turns,
         list(length(text) ORDER BY turn NULLS FIRST, digest) AS sizes
  FROM t GROUP BY conv_id),
heads AS (
  SELECT *, CAST(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                              lambda c: CAST(ascii(c) AS BIGINT))),
                                 lambda crc, b: {_BYTE}), 4294967295) % 6 AS BIGINT) AS h
  FROM own),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(f.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns,
         list_concat(coalesce(f.sizes[1:o.h], []), o.sizes[o.h + 1:]) AS sizes
  FROM heads o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 100),
path AS (
  SELECT conv_id, d AS depth, turns[1:d] AS node, CASE WHEN d > 0 THEN turns[1:d - 1] END AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(turns) AS ends
  FROM (SELECT *, unnest(generate_series(0, len(turns))) AS d FROM rebuilt)),
nodes AS (
  SELECT node, depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM path GROUP BY node, depth),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
known AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.node = n.node),
sums AS (
  SELECT above AS node, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens
  FROM (SELECT *, node[1:unnest(generate_series(0, depth))] AS above FROM known) GROUP BY above)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM known n JOIN sums s ON s.node = n.node LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.parent
"""
