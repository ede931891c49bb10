"""Operator 1: quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage of every whole text is
encoded by its shape (shares of character classes, word lengths, repetition), then by a hidden
layer.  Gated attention (Ilse et al. 2018) weighs the passages, and the weighted sum of their
hidden vectors is scored by a logistic unit.  All parts are learned together from document labels
alone, on a bounded seeded sample (``SAMPLE`` labelled documents): ``MEMBERS`` networks of
different seeds, one Spark task each, averaged.

Output beside the score: the passage with most attention and its weight.

Texts without words (also null): one passage of zeros.  No labels: score 0.5; labels of one
class: learned as they are.  Empty table: no rows.  Repeated rows each get a row; an id labelled
twice takes its larger label.  Extra columns are ignored or passed on (``keep``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import (
    BATCH_ROWS, annotate, bounded_sample, col, remainder, staged, table, texts_of)
from courtside.llm.words import Words, chunks

PASSAGE, SAMPLE, MEMBERS, SEED = 64, 8000, 3, 5
HIDDEN, ATTENTION, EPOCHS, BAGS, RATE, DECAY = 16, 8, 40, 256, 0.01, 1e-4

_CLASSES = ("lower", "upper", "digit", "stop", "call", "pipe", "sign", "quote", "wide", "line", "blank")


def _class_table() -> np.ndarray:
    out = np.full(256, _CLASSES.index("sign"), dtype=np.uint8)
    for name, chars in (("lower", bytes(range(97, 123))), ("upper", bytes(range(65, 91))),
                        ("digit", b"0123456789"), ("stop", b".,;:"), ("call", b"!?"), ("pipe", b"|"),
                        ("quote", b"\"'()[]{}`"), ("wide", bytes(range(128, 256))), ("line", b"\n"),
                        ("blank", b" \t\v\f\r")):
        out[list(chars)] = _CLASSES.index(name)
    return out


_CLASS = _class_table()
FEATURES = len(_CLASSES) + 7


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features (passages, FEATURES), index of each passage's text), in text order; every text
    has at least one passage."""
    parts, owners = [], []
    for first, some in chunks([t.encode() for t in texts]):
        x, doc = _encode(some)
        parts.append(x)
        owners.append(doc + first)
    if not parts:
        return np.zeros((0, FEATURES), dtype=np.float32), np.zeros(0, dtype=np.int64)
    return np.concatenate(parts), np.concatenate(owners)


def _distinct(group: np.ndarray, h: np.ndarray, groups: int) -> np.ndarray:
    """Distinct hashes per group (40 bits of them)."""
    key = np.unique((group.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    return np.bincount((key >> np.uint64(40)).astype(np.int64), minlength=groups)


def _encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    w = Words(texts)
    bare = np.flatnonzero(w.count == 0)
    if not len(w.start):
        return np.zeros((len(bare), FEATURES), dtype=np.float32), bare
    head = np.flatnonzero(w.rank % PASSAGE == 0)  # each passage's first word
    n = len(head)
    of = np.cumsum(w.rank % PASSAGE == 0) - 1      # passage of each word
    # Bytes of each passage, from its first word to the end of its last.
    at = np.column_stack([w.start[head], w.end[np.append(head[1:], len(w.start)) - 1]]).reshape(-1)
    kind = _CLASS[w.buf]
    share = np.stack([np.add.reduceat(kind == c, at, dtype=np.int32)[::2] for c in range(len(_CLASSES))],
                     axis=1).astype(np.float64)
    count = np.bincount(of, minlength=n).astype(np.float64)
    length = (w.end - w.start).astype(np.float64)
    total = np.bincount(of, weights=length, minlength=n)
    square = np.bincount(of, weights=length * length, minlength=n)
    mean = total / count
    last = kind[w.end - 1]
    signed = np.isin(last, [_CLASSES.index(c) for c in ("call", "pipe", "sign")])
    doc_words, doc_runs = w.shingles(3)
    runs = np.bincount(doc_words, minlength=len(texts))
    fresh = _distinct(doc_words, doc_runs, len(texts)) / np.maximum(runs, 1)
    h = w.hashes()
    doc = w.doc[head]
    x = np.column_stack([
        share / total[:, None], mean / 10, np.sqrt(np.maximum(square / count - mean * mean, 0)) / 10,
        np.bincount(of, weights=signed, minlength=n) / count,
        _distinct(of, h, n) / count, 1 - fresh[doc], np.log1p(count) / 5, np.log1p(w.count[doc]) / 10])
    x = np.concatenate([x, np.zeros((len(bare), FEATURES))]).astype(np.float32)
    doc = np.concatenate([doc, bare])
    order = np.argsort(doc, kind="stable")
    return x[order], doc[order]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class GatedAttention:
    """The network; bags are runs of rows (``first``: each bag's first row, ``bag``: row's bag)."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, seed: int) -> "GatedAttention":
        r = np.random.default_rng(seed)
        def normal(*shape):
            return r.standard_normal(shape) / np.sqrt(shape[0])
        return cls({"in": normal(FEATURES, HIDDEN), "in0": np.zeros(HIDDEN),
                    "value": normal(HIDDEN, ATTENTION), "gate": normal(HIDDEN, ATTENTION),
                    "pick": normal(ATTENTION, 1)[:, 0], "out": normal(HIDDEN, 1)[:, 0], "out0": np.zeros(1)})

    def forward(self, x: np.ndarray, first: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        h = np.tanh(x @ w["in"] + w["in0"])
        value, gate = np.tanh(h @ w["value"]), _sigmoid(h @ w["gate"])
        e = (value * gate) @ w["pick"]
        a = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "value": value, "gate": gate, "a": a, "z": z,
                "p": _sigmoid(z @ w["out"] + w["out0"][0])}

    def gradients(self, x, first, bag, y) -> dict[str, np.ndarray]:
        w, f = self.w, self.forward(x, first, bag)
        d = (f["p"] - y) / len(y)
        dz = (d[:, None] * w["out"])[bag]
        da = (f["h"] * dz).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, first)[bag])
        dpre = de[:, None] * w["pick"]
        dvalue = dpre * f["gate"] * (1 - f["value"] ** 2)
        dgate = dpre * f["value"] * f["gate"] * (1 - f["gate"])
        dh = f["a"][:, None] * dz + dvalue @ w["value"].T + dgate @ w["gate"].T
        din = dh * (1 - f["h"] ** 2)
        return {"in": x.T @ din, "in0": din.sum(axis=0), "value": f["h"].T @ dvalue,
                "gate": f["h"].T @ dgate, "pick": (f["value"] * f["gate"]).T @ de,
                "out": f["z"].T @ d, "out0": np.array([d.sum()])}


def learn(x: np.ndarray, doc: np.ndarray, y: np.ndarray, seed: int) -> GatedAttention:
    """Adam on mini-batches of bags.  doc: each row's bag (0..len(y)-1, ascending)."""
    net, r = GatedAttention.fresh(seed), np.random.default_rng(seed)
    edge = np.searchsorted(doc, np.arange(len(y) + 1))
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    s = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = r.permutation(len(y))
        for i in range(0, len(order), BAGS):
            bags = order[i:i + BAGS]
            size = edge[bags + 1] - edge[bags]
            first = np.cumsum(size) - size
            bag = np.repeat(np.arange(len(bags)), size)
            rows = np.arange(size.sum()) - first[bag] + edge[bags][bag]
            step += 1
            for k, g in net.gradients(x[rows], first, bag, y[bags]).items():
                g = g + DECAY * net.w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                net.w[k] = net.w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


def train(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality",
          sample: int = SAMPLE, members: int = MEMBERS, seed: int = SEED) -> dict | None:
    """Feature scales and the members' weights, or None without labels."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    chosen = bounded_sample(labels, label, keep, sample, seed)
    texts = docs.select(col("doc_id").alias("doc_id"), col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")  # chosen: bounded by its limit

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, doc = passages(texts_of(b.column(2)))
            edge = np.searchsorted(doc, np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([x[edge[i]:edge[i + 1]].tobytes() for i in range(b.num_rows)], pa.binary())],
                names=["doc_id", "y", "x"])

    bags = staged(texts.mapInArrow(encode, "doc_id long, y int, x binary"))

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "x"], ignore_index=True)
        rows = [np.frombuffer(b, dtype=np.float32).reshape(-1, FEATURES) for b in pdf["x"]]
        x = np.concatenate(rows).astype(np.float64)
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        net = learn((x - mean) / scale, doc, pdf["y"].to_numpy(np.float64), seed + int(key[0]))
        names = sorted(net.w)
        flat = np.concatenate([mean, scale, *[net.w[k].reshape(-1) for k in names]])
        return pd.DataFrame({"member": [int(key[0])], "w": [flat.tolist()]})

    found = (bags.withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(members - 1))))
             .groupBy("member").applyInPandas(fit, "member int, w array<double>").orderBy("member").collect())
    if not found:
        return None
    shapes = {k: v.shape for k, v in GatedAttention.fresh(0).w.items()}
    nets = []
    for r in found:
        flat = np.array(r["w"])
        mean, scale, at, weights = flat[:FEATURES], flat[FEATURES:2 * FEATURES], 2 * FEATURES, {}
        for k in sorted(shapes):
            n = int(np.prod(shapes[k]))
            weights[k] = flat[at:at + n].reshape(shapes[k])
            at += n
        nets.append(weights)
    return {"mean": mean, "scale": scale, "nets": nets}


def score_documents(docs: DataFrame, model: dict | None, keep: Sequence[str]) -> DataFrame:
    """(doc struct, score, predicted, passage, attention) of every row of ``docs``."""
    def make():
        nets = [GatedAttention(w) for w in model["nets"]] if model else []

        def fn(text: pa.Array) -> list:
            n = len(text)
            x, bag = passages(texts_of(text))
            first = np.searchsorted(bag, np.arange(n))
            score, attention = np.full(n, 0.5), np.zeros(len(x))
            if nets:
                scaled = (x - model["mean"]) / model["scale"]
                runs = [net.forward(scaled, first, bag) for net in nets]
                score = np.mean([r["p"] for r in runs], axis=0)
                attention = np.mean([r["a"] for r in runs], axis=0)
            edge = np.append(first, len(x))
            top = [int(np.argmax(attention[a:b])) for a, b in zip(edge[:-1], edge[1:])]
            return [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32)),
                    pa.array(top, pa.int32()), pa.array(attention[first + np.array(top)], pa.float64())]
        return fn

    return annotate(docs, keep, [col("text").cast("string")], make,
                    "score double, predicted int, passage int, attention double")


def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, remainder(F.col("doc_id"), 3) != 1)
    return score_documents(docs, model, ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), (remainder(F.col("doc.doc_id"), 3) == 1).alias("held_out"),
        "score", "predicted", "passage", "attention")
