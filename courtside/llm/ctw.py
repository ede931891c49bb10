"""Operator 5: language-model scoring by context-tree weighting over bytes.

A text is coded as its UTF-8 bytes and one end symbol; every byte is eight binary decisions, each
with its own context tree over the preceding ``DEPTH`` bytes (contexts before the text's start are
start symbols).  Each context node has a Krichevsky-Trofimov estimate from the corpus counts, and
a node's weighted probability mixes its own estimate with its children's, half and half; the
resulting weights mix the estimates of all depths into one probability per bit.

Counting.  One pass over all texts counts runs of ``DEPTH + 1`` bytes (in the training texts, and
in all) and the training texts' words; tasks pack their counts by bucket, Spark shuffles the packed
counts, and buckets merge them.  Nothing is sampled and every context seen is a node of the tree.

The tree.  Runs are dealt to buckets by their last three context bytes, so a bucket holds whole
subtrees from depth three down.  A first pass over the buckets sums the weighted probabilities of
the nodes of depth three for their parents; the tree above (contexts of two bytes and less, at most
65,793 whatever the corpus) is weighted from these sums and broadcast; a second pass over the buckets gives
every run's log probability, as a table of runs.

Scores.  The ``FREQUENT_RUNS`` most frequent runs' log probabilities are broadcast, and the other
distinct runs of every text are joined with the table of all runs: the score is the same whatever
is broadcast.

Base score.  Word counts are exact: the ``FREQUENT`` most frequent words are broadcast, and the
other words of every text are joined with the table of all counts.

Null text: empty (the end symbol alone).  No training text: every bit has probability 1/2.  Empty
table: no rows.  Repeated rows each get a row.  Extra columns are ignored or passed on (``keep``).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import BATCH_ROWS, annotate, col, mix64, remainder, staged, table, texts_of
from courtside.llm.words import chunks

DEPTH, FREQUENT, FREQUENT_RUNS = 5, 1 << 19, 1 << 21
SHALLOW = 2  # depth of the longest contexts of the broadcast part of the tree
NODES = 1 << 15  # contexts of the tests' tree in memory
END = 0xFF  # never a byte of UTF-8: the end of a text, and what stands before its start
HOLD, HOLD_WORDS = 3_000_000, 600_000  # distinct runs and words a counting task holds before it sends them on
END_WORD = b""

_PACKED = "kind int, bucket int, keys binary, counts binary"


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts with start and end symbols, positions to predict, each text's first)."""
    pad = bytes([END]) * DEPTH
    end = bytes([END])
    buf = np.frombuffer(b"".join([pad + t + end for t in texts]), dtype=np.uint8)
    size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(texts)), size)
    at = np.arange(size.sum()) + (owner + 1) * DEPTH
    return buf, at, first


def runs(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Codes of the DEPTH context bytes (oldest highest) and the byte at each position."""
    out = np.zeros(len(at), dtype=np.int64)
    for back in range(DEPTH, -1, -1):
        out = (out << 8) | buf[at - back]
    return out


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    head = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
    return k[head], np.add.reduceat(c, head) if len(k) else c


def bucket_of(run_codes: np.ndarray, buckets: int) -> np.ndarray:
    """By the last three context bytes, so contexts of three bytes and more lie in one bucket."""
    return (mix64((run_codes >> 8) & 0xFFFFFF) % np.uint64(buckets)).astype(np.int64)


def count_corpus(texts: DataFrame, buckets: int) -> DataFrame:
    """Packed counts of runs (kind 0: in training texts and in all) and of the training texts'
    words (kind 1); one row per kind and bucket.  texts: (text, train)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held, vocabulary = 0, Counter()

        def send() -> pa.RecordBatch:
            rows = []
            if keys:
                k, c = _merge(keys, counts)
                b = bucket_of(k, buckets)
                order = np.argsort(b, kind="stable")
                k, c, b = k[order], c[order], b[order]
                edge = np.searchsorted(b, np.arange(buckets + 1))
                rows += [(0, i, k[lo:hi].tobytes(), c[lo:hi].tobytes())
                         for i, (lo, hi) in enumerate(zip(edge[:-1], edge[1:])) if lo < hi]
                keys.clear()
                counts.clear()
            if vocabulary:
                by: dict[int, list[bytes]] = {}
                for w in vocabulary:
                    by.setdefault(zlib.crc32(w) % buckets, []).append(w)
                rows += [(1, i, b" ".join(ws), np.array([vocabulary[w] for w in ws], np.int64).tobytes())
                         for i, ws in by.items()]
                vocabulary.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())],
                names=["kind", "bucket", "keys", "counts"])

        for batch in batches:
            texts, train = [t.encode() for t in texts_of(batch.column(0))], batch.column(1).to_pylist()
            for learned in (True, False):
                for _, some in chunks([t for t, x in zip(texts, train) if bool(x) == learned]):
                    if learned:
                        for t in some:
                            vocabulary.update(t.lower().split())
                        vocabulary[END_WORD] += len(some)
                    k, c = np.unique(runs(*coded(some)[:2]), return_counts=True)
                    keys.append(k)
                    counts.append(np.column_stack([c * learned, c]).astype(np.int64))
                    held += len(k)
                    if held > HOLD:
                        k, c = _merge(keys, counts)
                        keys, counts, held = [k], [c], len(k)
                    if held > HOLD // 2 or len(vocabulary) > HOLD_WORDS:
                        yield send()
                        held = 0
        yield send()

    packed = texts.mapInArrow(run, _PACKED)

    def merge(key: tuple, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind, bucket = int(key[0]), int(key[1])
        if kind == 0:
            keys, counts, held = [], [], 0
            for pdf in rows:
                for k, c in zip(pdf["keys"], pdf["counts"]):
                    keys.append(np.frombuffer(k, np.int64))
                    counts.append(np.frombuffer(c, np.int64).reshape(-1, 2))
                    held += len(counts[-1])
                    if held > HOLD and len(keys) > 1:
                        k1, c1 = _merge(keys, counts)
                        keys, counts, held = [k1], [c1], 0
            k, c = _merge(keys, counts)
            yield pd.DataFrame({"kind": [0], "bucket": [bucket], "keys": [k.tobytes()], "counts": [c.tobytes()]})
        else:
            total: Counter = Counter()
            for pdf in rows:
                for k, c in zip(pdf["keys"], pdf["counts"]):
                    total.update(dict(zip(k.split(b" "), np.frombuffer(c, np.int64).tolist())))
            words = sorted(total)
            yield pd.DataFrame({"kind": [1], "bucket": [bucket], "keys": [b" ".join(words)],
                                "counts": [np.array([total[w] for w in words], np.int64).tobytes()]})

    return packed.groupBy("kind", "bucket").applyInPandas(merge, _PACKED)


def word_counts(merged: DataFrame) -> DataFrame:
    """(word binary, c long) of all training words; the end is the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.split(b" "), pa.binary()), pa.array(np.frombuffer(c, np.int64))], names=["word", "c"])

    return merged.where("kind = 1").select("keys", "counts").mapInArrow(run, "word binary, c long")


def least_count(counts: DataFrame, column: str, limit: int) -> int:
    """The least count such that at most ``limit`` rows have that count or more (to within a step
    of a fine logarithmic scale, so the histogram that is collected stays small)."""
    step = F.floor(F.log2(column) * 256).cast("long")
    rows = (counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k"), F.min(column).alias("least"))
            .orderBy(F.desc("step")).collect())
    total, least = 0, 1 << 62
    for r in rows:
        total += r["k"]
        if total > limit:
            break
        least = r["least"]
    return least


def frequent_words(merged: DataFrame, least: int) -> list[tuple[bytes, np.ndarray]]:
    """Words (joined by blanks) and counts of those seen ``least`` times or more, by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = np.frombuffer(c, np.int64)
                at = np.flatnonzero(c >= least)
                if len(at):
                    words = k.split(b" ")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b" ".join([words[i] for i in at])], pa.binary()),
                         pa.array([c[at].tobytes()], pa.binary())], names=["keys", "counts"])

    rows = merged.where("kind = 1").select("keys", "counts").mapInArrow(run, "keys binary, counts binary")
    return [(bytes(r["keys"]), np.frombuffer(r["counts"], np.int64)) for r in rows.collect()]


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma for x > 0 (Stirling's series after a shift by eight)."""
    product = np.ones_like(x)
    for i in range(8):
        product *= x + i
    y = x + 8
    return ((y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi)
            + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - np.log(product))


def _block(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Log Krichevsky-Trofimov probability of that many zeros and ones."""
    out = np.zeros(zero.shape)
    seen = (zero > 0) | (one > 0)
    a, b = zero[seen].astype(np.float64), one[seen].astype(np.float64)
    out[seen] = _lgamma(a + 0.5) + _lgamma(b + 0.5) - np.log(np.pi) - _lgamma(a + b + 1)
    return out


def _bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(zeros, ones) at the 255 binary decisions of counts by byte (rows, 256); decision i has
    the successors 2i and 2i+1, and 256 + byte is a byte's leaf."""
    tree = np.zeros((len(counts), 512), dtype=np.float64)
    tree[:, 256:] = counts
    for i in range(255, 0, -1):
        tree[:, i] = tree[:, 2 * i] + tree[:, 2 * i + 1]
    return tree[:, 2::2][:, :255], tree[:, 3::2][:, :255]


def levels(codes: np.ndarray, counts: np.ndarray, depths: Sequence[int]) -> list[tuple]:
    """(distinct codes of a context and its next byte, ascending; counts; each longer code's place)
    by depth.  codes: distinct and ascending, of the first (longest) depth.  Runs that no training
    text holds have count 0, which leaves all weights and estimates as if they weren't there."""
    out = [(codes, counts.astype(np.float64), None)]
    for depth in depths[1:]:
        short, place = np.unique(out[-1][0] & ((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        place = place.reshape(-1)
        out.append((short, np.bincount(place, weights=out[-1][1], minlength=len(short)), place))
    return out


def weighted(level: list[tuple], bit: int, below: np.ndarray | None = None) -> tuple[list[tuple], np.ndarray]:
    """One binary decision of the nodes of all ``levels``, bottom-up: by level (each code's
    decision, its weight against its children's, its probability of a one), and the log weighted
    probabilities of the last level's.  below: the first level's children's (none: leaves)."""
    found: list[tuple] = []
    first = mixed = None
    for codes, counts, place in level:
        prefix = codes >> (8 - bit)  # context, and the byte's bits before the decision
        new = np.concatenate(([True], prefix[1:] != prefix[:-1]))
        node = np.cumsum(new) - 1
        total = np.bincount(node, weights=counts)
        one = np.bincount(node, weights=counts * ((codes >> (7 - bit)) & 1))
        own = _block(total - one, one)
        if mixed is not None:
            below = np.bincount(node[place[first]], weights=mixed, minlength=len(own))
        if below is None:
            weight, mixed = np.ones(len(own)), own
        else:
            weight = 1 / (1 + np.exp(np.clip(below - own, -80, 80)))
            mixed = np.logaddexp(own, below) - np.log(2.0)
        first = np.flatnonzero(new)
        found.append((node, weight, (one + 0.5) / (total + 1.0)))
    return found, mixed


def _trained(column: bytes) -> np.ndarray:
    return np.frombuffer(column, np.int64).reshape(-1, 2)[:, 0]


class ShallowTree:
    """The tree's contexts of at most ``SHALLOW`` bytes.  By code of such a context and a byte:
    the probability of a one at each decision is ``base + slope * p``, p that of the longer contexts."""

    def __init__(self, rows: pd.DataFrame):
        """rows: bit, prefix, n, log (bit 8: the codes and their counts; else the sums of the
        children's log weighted probabilities)."""
        rows = rows.sort_values(["bit", "prefix"])
        bit = rows["bit"].to_numpy()
        self.codes = rows["prefix"].to_numpy(np.int64)[bit == 8]
        level = levels(self.codes, rows["n"].to_numpy()[bit == 8], range(SHALLOW, -1, -1))
        self.base, self.slope = np.zeros((len(self.codes), 8)), np.ones((len(self.codes), 8))
        for b in range(8 if len(self.codes) else 0):
            at = np.arange(len(self.codes))
            for (node, weight, p), (_, _, place) in zip(
                    weighted(level, b, rows["log"].to_numpy(np.float64)[bit == b])[0], level):
                at = at if place is None else place[at]
                w = weight[node[at]]
                self.base[:, b] = w * p[node[at]] + (1 - w) * self.base[:, b]
                self.slope[:, b] *= 1 - w


def shallow_tree(merged: DataFrame) -> ShallowTree:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                level = levels(np.frombuffer(k, np.int64), _trained(c), range(DEPTH, SHALLOW, -1))
                codes, counts, _ = level[-1]
                short, n = _merge([codes & ((1 << 8 * (SHALLOW + 1)) - 1)], [counts])
                parts = [(8, short, n, np.zeros(len(short)))]
                for bit in range(8):
                    found, mixed = weighted(level, bit)
                    node = found[-1][0]
                    first = np.flatnonzero(np.diff(node, prepend=-1))
                    prefix, log = _merge([(codes[first] & ((1 << 8 * (SHALLOW + 1)) - 1)) >> (8 - bit)], [mixed])
                    parts.append((bit, prefix, np.zeros(len(prefix)), log))
                for bit, prefix, n, log in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(prefix), bit, np.int32)), pa.array(prefix), pa.array(n), pa.array(log)],
                        names=["bit", "prefix", "n", "log"])

    parts = merged.where("kind = 0").select("keys", "counts").mapInArrow(
        run, "bit int, prefix long, n double, log double")
    return ShallowTree(parts.groupBy("bit", "prefix").agg(  # at most 2**24 codes of three bytes
        F.sum("n").alias("n"), F.sum("log").alias("log")).toArrow().to_pandas())


def run_probabilities(merged: DataFrame, shared) -> DataFrame:
    """(run, n, logp) of all runs: how often all texts hold it, log10 probability of its last byte.
    shared: broadcast ShallowTree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                codes = np.frombuffer(k, np.int64)
                level = levels(codes, _trained(c), range(DEPTH, SHALLOW, -1))
                short = np.searchsorted(top.codes, codes & ((1 << 8 * (SHALLOW + 1)) - 1))
                logp = np.zeros(len(codes))
                for bit in range(8):
                    at, one = np.arange(len(codes)), np.zeros(len(codes))
                    for (node, weight, p), (_, _, place) in zip(weighted(level, bit)[0], level):
                        at = at if place is None else place[at]
                        w = weight[node[at]]
                        one = w * p[node[at]] + (1 - w) * one
                    one = top.base[short, bit] + top.slope[short, bit] * one
                    logp += np.log10(np.where((codes >> (7 - bit)) & 1, one, 1 - one))
                n = np.frombuffer(c, np.int64).reshape(-1, 2)[:, 1]
                for lo in range(0, len(codes), 1 << 16):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[lo:lo + (1 << 16)]) for x in (codes, n, logp.astype(np.float32))],
                        names=["run", "n", "logp"])

    return merged.where("kind = 0").select("keys", "counts").mapInArrow(run, "run long, n long, logp float")


class RunTable:
    """Log10 probabilities of the most frequent runs, hashed with linear probing."""

    def __init__(self, codes: np.ndarray, logp: np.ndarray):
        self.shift = 64 - max(4, (2 * len(codes)).bit_length())
        home = self._home(codes)
        order = np.argsort(home, kind="stable")
        rank = np.arange(len(codes))
        at = np.maximum.accumulate(home[order] - rank) + rank if len(codes) else rank
        size = max((1 << (64 - self.shift)) + 1, int(at[-1]) + 2 if len(codes) else 0)
        self.codes, self.logp = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.float32)
        self.codes[at], self.logp[at] = codes[order], logp[order]

    def _home(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple]]:
        """(sum of the known runs' log10 probabilities by text; for each chunk of texts the other
        runs by text: runs per text, runs, their numbers)."""
        out, rest = np.zeros(len(texts)), []
        for start, some in chunks(texts):
            buf, at, first = coded(some)
            codes = runs(buf, at)
            slot = self._home(codes)
            seen = self.codes[slot]
            value = self.logp[slot].astype(np.float64)
            open_ = np.flatnonzero(seen != codes)
            value[open_] = 0.0
            missing = []
            while len(open_):
                empty = seen[open_] < 0
                missing.append(open_[empty])
                open_ = open_[~empty]
                slot[open_] += 1
                seen[open_] = self.codes[slot[open_]]
                hit = open_[seen[open_] == codes[open_]]
                value[hit] = self.logp[slot[hit]]
                open_ = open_[seen[open_] != codes[open_]]
            out[start:start + len(some)] = np.add.reduceat(value, first)
            lost = np.sort(np.concatenate(missing)) if missing else np.zeros(0, np.int64)
            owner = np.searchsorted(first, lost, side="right") - 1
            pair, n = np.unique((owner << 48) | codes[lost], return_counts=True)
            rest.append((np.bincount(pair >> 48, minlength=len(some)), pair & ((1 << 48) - 1), n))
        return out, rest


def frequent_runs(table_of_runs: DataFrame, least: int) -> RunTable:
    rows = table_of_runs.where(F.col("n") >= least).select("run", "logp").toArrow()
    return RunTable(rows.column("run").to_numpy(), rows.column("logp").to_numpy())


class ContextTree:
    """The same model with chosen contexts in memory, for tests: what follows a context that isn't
    kept counts at its longest kept form.  Probabilities of the next byte, by the longest kept context: ``child`` (node, byte) leads
    to the context one byte longer (0: not kept), ``table`` (node, byte) holds log10 p."""

    def __init__(self, rows: pd.DataFrame):
        """rows: depth, context, byte, n of the empty and all kept contexts."""
        rows = rows.sort_values(["depth", "context", "byte"])
        depth, context = rows["depth"].to_numpy(np.int64), rows["context"].to_numpy(np.int64)
        new = np.concatenate(([True], (depth[1:] != depth[:-1]) | (context[1:] != context[:-1]))) \
            if len(rows) else np.zeros(0, bool)
        node = np.cumsum(new) - 1
        depth, context = depth[new], context[new]
        if not len(depth):
            depth, context = np.zeros(1, np.int64), np.zeros(1, np.int64)
        size = len(depth)
        counts = np.zeros((size, 256))
        counts[node, rows["byte"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
        self.child = np.zeros((size, 256), dtype=np.uint16 if size < 1 << 16 else np.int32)
        parent = np.full(size, -1, dtype=np.int64)
        start = np.searchsorted(depth, np.arange(DEPTH + 2))
        for d in range(1, DEPTH + 1):
            own, up = slice(start[d], start[d + 1]), slice(start[d - 1], start[d])
            short = context[own] & ((1 << 8 * (d - 1)) - 1)
            parent[own] = np.searchsorted(context[up], short) + start[d - 1]
            self.child[parent[own], context[own] >> (8 * (d - 1))] = np.arange(start[d], start[d + 1])
        other = counts.copy()  # what follows a node's contexts that aren't kept
        np.subtract.at(other, parent[1:], counts[1:])
        np.maximum(other, 0, out=other)
        weight = np.ones((size, 255))  # of a node's own estimate against its children's
        below = np.zeros((size, 255))  # children's log weighted probabilities
        for d in range(DEPTH, -1, -1):
            for lo in range(start[d], start[d + 1], 2048):
                part = slice(lo, min(lo + 2048, start[d + 1]))
                own = _block(*_bits(counts[part]))
                parts = below[part] + _block(*_bits(other[part]))
                inner = (self.child[part] > 0).any(axis=1)[:, None]
                weight[part] = np.where(inner, 1 / (1 + np.exp(np.clip(parts - own, -80, 80))), 1.0)
                mixed = np.where(inner, np.logaddexp(own, parts) - np.log(2.0), own)
                if d:
                    np.add.at(below, parent[part], mixed)
        self.table = np.empty((size, 256), dtype=np.float32)
        byte = np.arange(256)
        for lo in range(0, size, 2048):
            ids = np.arange(lo, min(lo + 2048, size))
            zero, one = _bits(other[ids])
            p = (one + 0.5) / (zero + one + 1.0)  # probability of a one
            at = ids.copy()
            while True:
                live = at >= 0
                if not live.any():
                    break
                zero, one = _bits(counts[at[live]])
                w = weight[at[live]].astype(np.float64)
                p[live] = w * (one + 0.5) / (zero + one + 1.0) + (1 - w) * p[live]
                at[live] = parent[at[live]]
            yes, no = np.log10(p), np.log10(1 - p)
            logp = np.zeros((len(ids), 256))
            for bit in range(8):
                decision = ((256 | byte) >> (8 - bit)) - 1
                logp += np.where((byte >> (7 - bit)) & 1, yes[:, decision], no[:, decision])
            self.table[ids] = logp

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text with its end."""
        out = np.zeros(len(texts))
        child, table = self.child.reshape(-1), self.table.reshape(-1)
        for start, some in chunks(texts):
            buf, at, first = coded(some)
            node = np.zeros(len(at), dtype=np.int32)
            live = np.arange(len(at))
            where = at
            for back in range(1, DEPTH + 1):
                next_node = child[(node[live] << 8) | buf[where - back]]
                on = next_node > 0
                live, where = live[on], where[on]
                node[live] = next_node[on]
            out[start:start + len(some)] = np.add.reduceat(
                table[(node << 8) | buf[at]].astype(np.float64), first)
        return out


class WordTable:
    """The most frequent words' counts; its dictionary is built once per worker."""

    def __init__(self, parts: list[tuple[bytes, np.ndarray]]):
        self.parts, self.known = parts, None

    def lookup(self) -> dict[bytes, float]:
        """log10 of a word's count and a half."""
        if self.known is None:
            self.known = {}
            for words, counts in self.parts:
                self.known.update(zip(words.split(b" "), np.log10(counts + 0.5).tolist()))
        return self.known

    def __getstate__(self):
        return {"parts": self.parts, "known": None}


_SCORED = ("rid long, n_bytes long, n_tokens long, frequent long, base double, score double, "
           "rare array<struct<word:binary,n:int>>, rare_runs array<struct<run:long,n:long>>")


def score_documents(docs: DataFrame, train: Column, keep: Sequence[str], frequent: int = FREQUENT,
                    most_runs: int = FREQUENT_RUNS) -> DataFrame:
    """(doc struct, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row
    of ``docs``; the last is the code length per byte (the end counted as a byte)."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    merged = staged(count_corpus(docs.select(col("text").cast("string"), train), buckets))

    shallow = spark.sparkContext.broadcast(shallow_tree(merged))  # at most 2**24 codes
    all_runs = staged(run_probabilities(merged, shallow))
    likely = spark.sparkContext.broadcast(  # at most FREQUENT_RUNS
        frequent_runs(all_runs, least_count(all_runs, "n", most_runs)))
    words = staged(word_counts(merged))
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    common = spark.sparkContext.broadcast(  # at most FREQUENT words
        WordTable(frequent_words(merged, least_count(words, "c", frequent))))

    def make():
        model, known = likely.value, common.value.lookup()
        first = TaskContext.get().partitionId() << 36
        done = [0]

        def fn(text: pa.Array) -> list:
            raw = [t.encode() for t in texts_of(text)]
            n_tokens, n_known, base, rare = [], [], [], []
            for t in raw:
                words = t.lower().split()
                words.append(END_WORD)
                values = [known.get(w) for w in words]
                rest = Counter([w for w, v in zip(words, values) if v is None])
                n = sum(rest.values())
                n_tokens.append(len(words))
                n_known.append(len(words) - n)
                base.append(sum([v for v in values if v is not None]))
                rare.append([{"word": w, "n": c} for w, c in rest.items()])
            score, rest = model.score(raw)
            edge = np.concatenate(([0], np.cumsum(np.concatenate([x[0] for x in rest]))))
            rare_runs = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([x[i] for x in rest]), pa.int64()) for i in (1, 2)], ["run", "n"])
            rid = np.arange(done[0], done[0] + len(raw)) + first
            done[0] += len(raw)
            return [pa.array(rid), pa.array([len(t) + 1 for t in raw], pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                    pa.array(base, pa.float64()), pa.array(score),
                    pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))),
                    pa.ListArray.from_arrays(pa.array(edge, pa.int32()), rare_runs)]
        return fn

    scored = staged(annotate(docs, keep, [col("text").cast("string")], make, _SCORED))
    others = scored.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", "r.n")
    found = (others.join(words, "word", "left")
             .groupBy("rid").agg(
                 F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
                 F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("part")))
    run_parts = (scored.select("rid", F.explode("rare_runs").alias("r")).select("rid", "r.run", F.col("r.n").alias("times"))
                 .join(all_runs.select("run", "logp"), "run")
                 .groupBy("rid").agg(F.sum(F.col("times") * F.col("logp").cast("double")).alias("run_part")))
    divisor = float(np.log10(float(total) + 0.5 * (float(distinct) + 1.0)))
    size = F.col("n_tokens").cast("double")
    score = F.col("score") + F.coalesce("run_part", F.lit(0.0))
    return (scored.drop("rare", "rare_runs").join(found, "rid", "left").join(run_parts, "rid", "left")
            .select("doc", "n_tokens", (F.col("frequent") + F.coalesce("known", F.lit(0))).alias("n_known"),
                    F.lit(int(total)).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("part", F.lit(0.0)) - size * F.lit(divisor)).alias("base_score"),
                    score.alias("score"), (-score * F.lit(float(np.log2(10.0))) / F.col("n_bytes")).alias("bits_per_byte")))


def op5_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and context-tree log10 probability of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, remainder(F.col("doc_id"), 5) != 1, ["doc_id"])
    return scored.select(F.col("doc.doc_id").alias("doc_id"),
                         (remainder(F.col("doc.doc_id"), 5) == 1).alias("held_out"),
                         "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
