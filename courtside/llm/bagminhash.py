"""Operator 2: near-duplicates by BagMinHash signatures over multisets of word shingles.

A text is the multiset of its five-word shingles (lower-cased words; a shorter text is one
shingle).  Weighted Jaccard similarity (sum of minima over sum of maxima of the counts) of
``THRESHOLD`` or more makes a link; a class is a connected component of links.

Signatures (after Ertl's BagMinHash).  Counts are discretised into the blocks [0,1), [1,2),
[2,4), [4,8), ...  Every shingle and block has a seeded Poisson process of points; a block of
more than one unit is split in halves: the half that holds the block's first point keeps it, the
other's first point is drawn anew from there, so a shingle counted w times reaches the points of
exactly the units below w.  A unit's points fall on random signature components, and a component
is the smallest point of all shingles.  Blocks whose first point exceeds the largest component
are dropped with all that they hold, which makes high counts cost their logarithm.  Two texts
agree in a component with a probability of their weighted Jaccard similarity.

Search.  ``BANDS`` bands of ``ROWS`` components are bucketed (a pair at the threshold shares a
bucket with probability 1 - 3e-6).  Equal texts are one node, so copies cost nothing further.  Of
every bucket the node that meets most others (in all its buckets) and the smallest are pivots, and
all its nodes are verified against them (linear in the bucket); the links' components are found.  The nodes of buckets that still
hold several components are searched exactly: those of different components that share a rare
enough shingle (``prefix_pairs``) are verified.  So no bucket is capped, and a class is never
expanded into pairs of its members.  All links are verified on whole multisets.

Null texts and texts without words: a class of their own, each row by itself.  A null doc_id has a
null class.  Repeated rows and equal texts: one class.  Empty table: no rows.  Extra columns are
ignored (``classes``) or passed on (``keep_one``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import BATCH_ROWS, annotate, col, mix64, staged, table, texts_of, unit
from courtside.llm.components import components
from courtside.llm.words import Words, chunks

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 32, 5
DIGEST = "digest of the text"  # name of the column added within the operator
SALT = 256  # members of a pivot verified by one task group
POINTS = 32  # points drawn at once where few processes are left

_A, _B, _C, _D = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                                         0x8EBC6AF09C88C6E3))


def multisets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash, count), ascending by text and hash."""
    docs, hashes, counts = [], [], []
    for first, some in chunks(texts):
        doc, h = Words(some).shingles(SHINGLE)
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        if not len(doc):
            continue
        head = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))))
        docs.append(doc[head] + first)
        hashes.append(h[head])
        counts.append(np.diff(np.append(head, len(doc))))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(docs), np.concatenate(hashes), np.concatenate(counts)


def _key(h: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix64(h ^ mix64(low.astype(np.uint64) * _A + size.astype(np.uint64) * _B))


def _step(seed: np.ndarray, rate: np.ndarray | float) -> np.ndarray:
    """Exponential waiting times."""
    return -np.log(unit(seed)) / rate


def signatures(doc: np.ndarray, h: np.ndarray, count: np.ndarray, texts: int, m: int) -> np.ndarray:
    """Array (texts, m) of the smallest points; infinite for a text without shingles."""
    out = np.full(texts * m, np.inf)
    limit = np.full(texts, np.inf)
    low = [np.zeros(len(doc), np.int64)]
    size = [np.ones(len(doc), np.int64)]
    of = [np.arange(len(doc))]
    block = 1
    while len(doc) and (count > block).any():
        at = np.flatnonzero(count > block)
        of.append(at)
        low.append(np.full(len(at), block))
        size.append(np.full(len(at), block))
        block *= 2
    of, low, size = np.concatenate(of), np.concatenate(low), np.concatenate(size)
    key = _key(h[of], low, size)
    x = _step(mix64(key ^ _C), float(m) * size)
    drawn = np.zeros(len(of), np.int64)
    while len(of):
        live = x < limit[doc[of]]
        of, low, size, key, x, drawn = of[live], low[live], size[live], key[live], x[live], drawn[live]
        if not len(of):
            break
        leaf = size == 1
        # Units: their points fall on components; a few points at once when few processes are left.
        e, k, at, n = of[leaf], key[leaf], x[leaf], drawn[leaf]
        ahead = POINTS if len(e) < 20_000 else 1
        turn = n[:, None] + np.arange(ahead)
        seed = mix64(k[:, None] + turn.astype(np.uint64) * _D)
        wait = _step(mix64(seed ^ _A), float(m))
        points = np.cumsum(np.concatenate([at[:, None], wait], axis=1), axis=1)
        np.minimum.at(out, (doc[e][:, None] * m + (seed % np.uint64(m)).astype(np.int64)).reshape(-1),
                      points[:, :ahead].reshape(-1))
        touched = np.unique(doc[e])
        limit[touched] = out.reshape(texts, m)[touched].max(axis=1)
        # Larger blocks are split in halves.
        b = ~leaf
        e2, half, low2, at2 = of[b], size[b] // 2, low[b], x[b]
        right = (mix64(key[b] ^ _B) >> np.uint64(63)).astype(bool)  # the half with the first point
        parts = [(e, low[leaf], size[leaf], k, points[:, ahead], n + ahead)]
        for is_right in (False, True):
            edge = low2 + half * is_right
            own = _key(h[e2], edge, half)
            first = np.where(right == is_right, at2, at2 + _step(mix64(own ^ _C), float(m) * half))
            inside = edge < count[e2]
            parts.append((e2[inside], edge[inside], half[inside], own[inside], first[inside],
                          np.zeros(int(inside.sum()), np.int64)))
        of, low, size, key, x, drawn = (np.concatenate(c) for c in zip(*parts))
    return out.reshape(texts, m)


def band_values(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Array (texts, bands) of bucket values; the band's number is part of the value."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, rows)
    acc = mix64(np.arange(1, bands + 1, dtype=np.uint64) * _A)[None, :].repeat(len(signature), axis=0)
    for r in range(rows):
        acc = mix64(acc * _B + bits[:, :, r])
    return acc.view(np.int64)


def signed(docs: DataFrame, keep: Sequence[str], bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc struct, rid, digest, bands): a number per row, the text's digest, and its bucket
    values (none for a text without words)."""
    def make():
        first, done = TaskContext.get().partitionId() << 36, [0]

        def fn(text: pa.Array) -> list:
            texts = [t.lower().encode() for t in texts_of(text)]
            values = np.zeros((len(texts), bands), np.int64)
            has = np.zeros(len(texts), bool)
            for start, some in chunks(texts):
                doc, h, n = multisets(some)
                part = signatures(doc, h, n, len(some), bands * rows)
                values[start:start + len(some)] = band_values(part, bands, rows)
                has[start:start + len(some)] = np.isfinite(part[:, 0])
            rid = np.arange(done[0], done[0] + len(texts)) + first
            done[0] += len(texts)
            return [pa.array(rid), pa.array([v.tolist() if ok else [] for v, ok in zip(values, has)],
                                            pa.list_(pa.int64()))]
        return fn

    return annotate(docs.withColumn(DIGEST, digest_of(col("text"))), [*keep, DIGEST],
                    [col("text").cast("string")], make, "rid long, bands array<bigint>")


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def verified(pairs: DataFrame, texts: DataFrame, partitions: int) -> DataFrame:
    """(a, b, distance): one minus the weighted Jaccard similarity of every pair.
    pairs: (a, b), a few or very many per b; texts: (node, text)."""
    groups = pairs.groupBy("b").count().select("b", F.ceil(F.col("count") / SALT).cast("int").alias("salts"))
    groups = staged(groups)
    members = (pairs.join(groups, "b")
               .select("b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"), "a")
               .join(texts, F.col("a") == F.col("node")).select("b", "salt", "a", "text"))
    pivots = (groups.join(texts, F.col("b") == F.col("node"))
              .select("b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                      F.lit(None).cast("long").alias("a"), "text"))
    rows = (pivots.unionByName(members).repartition(partitions, "b", "salt")
            .sortWithinPartitions("b", "salt", F.asc_nulls_first("a")).select("b", "a", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for batch in batches:
            texts = [t.lower().encode() for t in texts_of(batch.column(2))]
            doc, h, n = multisets(texts)
            edge = np.searchsorted(doc, np.arange(len(texts) + 1))
            a_out, b_out, d_out = [], [], []
            for i, (b, a) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                own = h[edge[i]:edge[i + 1]], n[edge[i]:edge[i + 1]]
                if a is None:
                    pivot = own
                    continue
                a_out.append(a)
                b_out.append(b)
                d_out.append(distance(own, pivot))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64()), pa.array(d_out, pa.float64())],
                names=["a", "b", "distance"])

    return rows.mapInArrow(run, "a long, b long, distance double")


def distance(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """One minus the weighted Jaccard similarity of two multisets (sorted hashes, counts)."""
    total = int(x[1].sum() + y[1].sum())
    if not len(x[0]) or not len(y[0]):
        return 1.0
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    common = y[0][at] == x[0]
    shared = int(np.minimum(x[1][common], y[1][at[common]]).sum())
    return 1.0 - shared / (total - shared)


def prefix_pairs(nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): candidate pairs of different components; no pair at the threshold is missed.
    nodes: (node, component).

    A multiset is the set of its shingles numbered by occurrence.  Two multisets of at least the
    threshold share one of each other's first ``n - ceil(threshold * n) + 1`` elements in any
    common order, and after the first one that they share both must have enough left.  The rarest
    come first, so what a text has for itself fills its prefix and few texts meet in vain.
    """
    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, h, n = multisets([t.lower().encode() for t in texts_of(b.column(2))])
            turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own = mix64(np.repeat(h, n) + turn.astype(np.uint64) * _D).view(np.int64)
            edge = np.searchsorted(np.repeat(doc, n), np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(own))],
                names=["node", "component", "e"])

    sets = staged(nodes.join(texts, "node").select("node", "component", "text")
                  .mapInArrow(elements, "node long, component long, e array<bigint>"))
    each = sets.select("node", F.explode("e").alias("x"))
    seen = each.groupBy("x").agg(F.count(F.lit(1)).alias("df"))
    prefix = (each.join(seen, "x").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("e"))  # one text's shingles
              .withColumn("n", F.size("e"))
              .withColumn("e", F.slice("e", 1, (F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1).cast("int")))
              .select("node", "n", F.posexplode("e").alias("i", "p")).where(F.col("p.df") > 1)
              .select("node", "n", "i", F.col("p.x").alias("x")))
    rows = staged(prefix.join(sets.select("node", "component"), "node"))
    sizes = rows.groupBy("x", "component").agg(F.count(F.lit(1)).alias("k"))
    mixed = (sizes.groupBy("x").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("k", "component")).alias("most"))
             .where(F.col("parts") > 1).select("x", F.col("most.component").alias("main")))
    met = staged(rows.join(mixed, "x"))
    # Nodes outside an element's largest component meet all of its nodes of other components.
    few, all_of = met.where(F.col("component") != F.col("main")).alias("f"), met.alias("m")
    # From the first element that two sets share, both must hold enough for the threshold.
    near = (F.least(F.col("f.n") - F.col("f.i"), F.col("m.n") - F.col("m.i"))
            >= F.lit(threshold / (1 + threshold)) * (F.col("f.n") + F.col("m.n")) - 1e-9)
    return (few.join(all_of, (F.col("f.x") == F.col("m.x")) & (F.col("f.component") != F.col("m.component")) & near)
            .select(F.least("f.node", "m.node").alias("a"), F.greatest("f.node", "m.node").alias("b")).distinct())


def classed(docs: DataFrame, keep: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """(doc struct of ``keep``, rid, class_id) of every row."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    partitions = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    far = 1.0 - threshold + 1e-9
    rows = staged(signed(docs, [*dict.fromkeys([*keep, "doc_id"])]))
    flat = rows.select("rid", F.col("doc.doc_id").cast("long").alias("doc_id"),
                       F.col("doc")[DIGEST].alias("digest"), "bands")
    # Texts without words and rows without id take no part.
    part = flat.where((F.size("bands") > 0) & F.col("doc_id").isNotNull())
    nodes = staged(part.groupBy("digest").agg(F.min("rid").alias("node")))
    values = (part.join(nodes.select("node"), F.col("rid") == F.col("node"), "left_semi")
              .select(F.col("rid").alias("node"), F.explode("bands").alias("v")))
    buckets = values.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    members = staged(values.join(buckets, "v"))
    # Whole texts of the nodes that share a bucket with another.
    sought = nodes.join(members.select("node").distinct(), "node")
    texts = staged(docs.select(digest_of(col("text")).alias("digest"), col("text").cast("string").alias("text"))
                   .join(sought, "digest").groupBy("node").agg(F.first("text").alias("text")))
    met = members.groupBy("node").agg(F.sum(F.col("n") - 1).alias("met"))
    pivots = (members.join(met, "node").groupBy("v")
              .agg(F.max(F.struct("met", "node")).alias("hub"), F.min("node").alias("low"))
              .select("v", F.array("hub.node", "low").alias("pivots")))
    pivoted = (members.join(pivots, "v").select(F.col("node").alias("a"), F.explode("pivots").alias("b"))
               .where(F.col("a") != F.col("b")).distinct())
    first = staged(verified(pivoted, texts, partitions))
    links = first.where(F.col("distance") <= far)
    found = components(links)
    # Buckets that still hold several components: their nodes are joined exactly.
    placed = (members.join(found, "node", "left")
              .select("v", "node", F.coalesce("component", "node").alias("component")))
    several = (placed.groupBy("v").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
               .where(F.col("lo") < F.col("hi")).select("v"))
    unsettled = staged(placed.join(several, "v").select("node", "component").distinct())
    rest = prefix_pairs(unsettled, texts, threshold)
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = verified(staged(rest.join(tried, ["a", "b"], "left_anti")), texts, partitions)
    found = components(links.select("a", "b").unionByName(
        second.where(F.col("distance") <= far).select("a", "b")))
    # Rows to classes; a class is named by its smallest doc_id.
    of_row = (part.select("rid", "doc_id", "digest").join(nodes, "digest").join(found, "node", "left")
              .select("rid", "doc_id", F.coalesce("component", "node").alias("component")))
    of_row = staged(of_row)
    names = of_row.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    named = of_row.join(names, "component").select("rid", "class_id")
    own = F.struct(*[F.col("doc")[c].alias(c) for c in keep])
    return (rows.select(own.alias("doc"), F.col("doc.doc_id").cast("long").alias("own_id"), "rid")
            .join(named, "rid", "left")
            .select("doc", "rid", F.coalesce("class_id", "own_id").alias("class_id"), F.col("class_id").isNull().alias("apart")))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) of every row."""
    return classed(docs, ["doc_id"], threshold).select(F.col("doc.doc_id").alias("doc_id"), "class_id")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Docs with one row of each class: the first row of its smallest doc_id.  Rows that take no
    part (no words, no id) all stay."""
    rows = classed(docs, docs.columns, threshold)
    first = (rows.where(~F.col("apart") & (F.col("doc.doc_id") == F.col("class_id")))
             .groupBy("class_id").agg(F.min("rid").alias("rid")).select("rid"))
    stay = first.unionByName(rows.where("apart").select("rid"))
    return rows.join(stay, "rid", "left_semi").select("doc.*")


def op2_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return classes(table(spark, sf_dir, "documents"))
