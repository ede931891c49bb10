"""Operator 8: language identification by hyperdimensional profiles.

Every letter has a seeded random vector of +1 and -1.  A trigram of letters (words are bounded by
a blank) binds its letters: the product of the first's vector rotated twice, the second's rotated
once, and the third's.  A text bundles (adds) its trigrams' vectors; a language's prototype
bundles all its training texts.  A text gets the language whose prototype has the largest cosine.

Prototypes are sums over the whole training corpus: each task adds up its texts, and Spark adds
the tasks' sums per (language, component).  They hold whole numbers, so the order doesn't matter.

Null texts and texts without letters: ``und``, score 0.  Score: the cosine, at least 0.  Ties
go to the language first by code point.  No training language: ``und`` throughout.  Empty table:
no rows.  Repeated rows each get a row.  Extra columns are ignored or passed on (``keep``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import BATCH_ROWS, annotate, col, remainder, table, texts_of

DIM, SEED = 1024, 11
GROUP = 256        # texts bundled by one matrix product
REMEMBER = 60_000  # trigram vectors a task remembers (DIM bytes each); emptied when full

_BITS = 21  # a code point needs 21 bits


class Hyper:
    """Trigram counts and vectors of texts."""

    def __init__(self, dim: int, seed: int):
        self.dim, self.seed = dim, seed
        self.letter: dict[int, np.ndarray] = {0: self._random(0)}
        self.is_letter = np.array([chr(c).isalpha() for c in range(0x110000)])
        self.keys = np.zeros(0, dtype=np.int64)
        self.vectors = np.zeros((0, dim), dtype=np.int8)

    def _random(self, code: int) -> np.ndarray:
        return np.random.default_rng([self.seed, code]).integers(0, 2, self.dim).astype(np.int8) * 2 - 1

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigram keys and their counts."""
        codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4").astype(np.int64)
        codes = np.concatenate(([0], np.where(self.is_letter[codes], codes, 0), [0]))
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        inner = b != 0
        keys = (a[inner] << (2 * _BITS)) | (b[inner] << _BITS) | c[inner]
        return np.unique(keys, return_counts=True)

    def bound(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct trigram keys."""
        mask = (1 << _BITS) - 1
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        if not known.all():
            new = keys[~known]
            parts = []
            for shift, turn in ((2 * _BITS, 2), (_BITS, 1), (0, 0)):
                codes = (new >> shift) & mask
                letters, inverse = np.unique(codes, return_inverse=True)
                for x in letters.tolist():
                    if x not in self.letter:
                        self.letter[x] = self._random(x)
                parts.append(np.roll(np.stack([self.letter[x] for x in letters.tolist()]), turn, axis=1)[inverse])
            if len(self.keys) + len(new) > REMEMBER:
                self.keys, self.vectors = self.keys[:0], self.vectors[:0]
                known[:] = False
                if len(new) < len(keys):
                    return self.bound(keys)
            all_keys = np.concatenate([self.keys, new])
            order = np.argsort(all_keys)
            self.keys = all_keys[order]
            self.vectors = np.concatenate([self.vectors, parts[0] * parts[1] * parts[2]])[order]
            at = np.searchsorted(self.keys, keys)
        return self.vectors[at]

    def bundle(self, texts: list[str], group: np.ndarray | None = None, groups: int = 0) -> np.ndarray:
        """Bundled vector of every text, or of every group of texts."""
        found = [self.trigrams(t) for t in texts]
        n = [len(k) for k, _ in found]
        rows = groups if group is not None else len(texts)
        if not sum(n):
            return np.zeros((rows, self.dim))
        keys, inverse = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        of = np.repeat(np.arange(len(texts)) if group is None else group, n)
        counts = np.zeros((rows, len(keys)), dtype=np.float32)
        np.add.at(counts, (of, inverse.reshape(-1)), np.concatenate([c for _, c in found]).astype(np.float32))
        out = np.zeros((rows, self.dim))
        for i in range(0, len(keys), 8192):  # bounds the vectors' copy as floats
            out += counts[:, i:i + 8192] @ self.bound(keys[i:i + 8192]).astype(np.float32)
        return out


def prototypes(docs: DataFrame, train, dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototype of every language of the training rows (one vector per language)."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows = docs.where(train & col("lang").isNotNull() & col("text").isNotNull()).select(
        col("lang").cast("string").alias("lang"), col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hyper, sums = Hyper(dim, seed), {}
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i in range(0, len(texts), GROUP):
                seen = sorted(set(names[i:i + GROUP]))
                group = np.array([seen.index(x) for x in names[i:i + GROUP]])
                for lang, v in zip(seen, hyper.bundle(texts[i:i + GROUP], group, len(seen))):
                    sums[lang] = sums.get(lang, 0) + v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["lang", "v"])

    partial = rows.mapInArrow(run, "lang string, v array<double>")
    summed = (partial.select("lang", F.posexplode("v").alias("i", "x"))
              .groupBy("lang", "i").agg(F.sum("x").alias("x")))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():  # one number per (language, component)
        out.setdefault(r["lang"], np.zeros(dim))[r["i"]] = r["x"]
    return out


def identify(docs: DataFrame, model: dict[str, np.ndarray], keep: Sequence[str],
             dim: int = DIM, seed: int = SEED) -> DataFrame:
    """(doc struct, lang_pred, score)."""
    langs = sorted(model)
    matrix = np.stack([model[x] / max(float(np.linalg.norm(model[x])), 1e-300) for x in langs]) if langs else None

    def make():
        hyper = Hyper(dim, seed)

        def fn(text: pa.Array) -> list:
            texts, pred, score = texts_of(text), [], []
            for i in range(0, len(texts), GROUP):
                v = hyper.bundle(texts[i:i + GROUP])
                length = np.sqrt((v * v).sum(axis=1))
                if matrix is None:
                    pred += ["und"] * len(v)
                    score += [0.0] * len(v)
                    continue
                cos = v @ matrix.T / np.maximum(length, 1e-300)[:, None]
                best = cos.argmax(axis=1)
                has = [any(map(str.isalpha, t)) for t in texts[i:i + GROUP]]
                pred += [langs[k] if h else "und" for k, h in zip(best, has)]
                score += [float(min(1.0, max(0.0, c[k]))) if h else 0.0 for c, k, h in zip(cos, best, has)]
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
        return fn

    return annotate(docs, keep, [col("text").cast("string")], make, "lang_pred string, score double")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    fold = remainder(F.col("doc_id"), 3)
    model = prototypes(docs, fold != 1)
    return identify(docs, model, ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), (remainder(F.col("doc.doc_id"), 3) == 1).alias("held_out"),
        "lang_pred", "score")
