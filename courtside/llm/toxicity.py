"""Operator 10: toxicity by nearest labelled examples under exact TF-IDF cosine.

Vocabulary: terms are words, and stems of longer words, with a term of its own for a stem's second
and third occurrence.  On a bounded seeded sample of labelled texts (``EXAMPLES``; equal texts count
once), those whose presence goes with the label by a chi-squared test are chosen, at most ``TERMS``.  One pass
over all documents then gives every text's counts of these terms, and their document
frequencies over the whole corpus give the weights ``(1 + log tf) * idf``.

The sample's texts are the examples, held in a block-max inverted index: examples lie in blocks,
every word has its largest weight in each block, and a query visits blocks by falling bound
until none can beat the k-th best cosine, so the neighbours are exact.  Votes are weighted by
cosine; they are calibrated by isotonic regression on the examples themselves, each scored
without itself.  A text without vocabulary words has no neighbour; it gets the rate of such
examples.  Evidence: the ids of the nearest examples and the words matched.

Null and empty texts: as texts without vocabulary words.  No labels at all: score 0.  Ties
between examples go to the smaller id.  Empty table: no rows.  Repeated rows each get a row; an
id labelled twice takes its larger label.  Extra columns are ignored or passed on (``keep``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import BATCH_ROWS, annotate, bounded_sample, col, remainder, staged, table, texts_of

EXAMPLES, TERMS, CHI_SQUARED, MIN_TEXTS = 20_000, 2000, 25.0, 3
NEIGHBOURS, BLOCK, EVIDENCE, SEED = 25, 512, 5, 3
STEM, REPEATS = 5, 3  # letters of a stem; occurrences of a stem that are terms of their own

# Words are parted by white space, ASCII digits and punctuation, and these signs beyond ASCII.
_SIGNS = re.compile("[\\u0080-\\u00a9\\u00ab-\\u00b4\\u00b6-\\u00b9\\u00bb-\\u00bf"
                    "\\u2000-\\u206f\\u3000-\\u303f\\uff00-\\uff0f]")
_BLANKED = bytes(32 if i < 128 and not chr(i).isalpha() else i for i in range(256))


def words(text: str) -> list[str]:
    """Lower-cased words."""
    low = text.lower()
    if not low.isascii():
        low = _SIGNS.sub(" ", low)
    return low.encode().translate(_BLANKED).decode().split()


def _stemmed(stems: Counter) -> list[tuple[str, int]]:
    """Terms of stems by their counts: the stem itself, and one for each further occurrence, as
    cosines don't tell one occurrence from many."""
    return [(f"{s}*{k}" if k > 1 else f"{s}*", n) for s, n in stems.items() for k in range(1, min(n, REPEATS) + 1)]


def all_terms(found: list[str]) -> set[str]:
    """Terms of a text's words: the words, and the stems (first letters) of the longer ones."""
    stems = Counter([w[:STEM] for w in found if len(w) > STEM])
    return set(found).union(t for t, _ in _stemmed(stems))


def term_statistics(texts: DataFrame) -> DataFrame:
    """(term, pos, neg): labelled texts holding each word.  texts: (y, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {0: Counter(), 1: Counter()}
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                counts[int(y > 0)].update(all_terms(words(t)))
            if len(counts[0]) + len(counts[1]) > 2_000_000:
                yield _frame(counts)
        yield _frame(counts)

    def _frame(counts) -> pa.RecordBatch:
        terms = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()),
             pa.array([counts[1][t] for t in terms], pa.int64()),
             pa.array([counts[0][t] for t in terms], pa.int64())], names=["term", "pos", "neg"])
        for c in counts.values():
            c.clear()
        return out

    return (texts.mapInArrow(run, "term string, pos long, neg long")
            .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def vocabulary(texts: DataFrame, limit: int = TERMS, least: float = CHI_SQUARED) -> list[str]:
    """Words whose presence goes with the label, strongest first."""
    totals = texts.agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)), F.count(F.lit(1))).first()
    p = float(totals[0] or 0)
    n = float(totals[1]) - p
    if not p or not n:
        return []
    a, b = F.col("pos").cast("double"), F.col("neg").cast("double")
    chi = (F.lit(p + n) * F.pow(a * (n - b) - b * (p - a), 2)
           / ((a + b) * F.greatest(F.lit(p + n) - a - b, F.lit(1.0)) * p * n))
    rows = (term_statistics(texts).where(F.col("pos") + F.col("neg") >= MIN_TEXTS)
            .withColumn("chi", chi).where(F.col("chi") >= least)
            .orderBy(F.desc("chi"), "term").limit(limit).collect())
    return [r["term"] for r in rows]


class Vocabulary:
    """The chosen terms, and what is needed to find them among a text's words."""

    def __init__(self, terms: Sequence[str]):
        self.index = {t: i for i, t in enumerate(terms)}
        self.words = frozenset(t for t in terms if "*" not in t)
        self.stems = frozenset(t.partition("*")[0] for t in terms if "*" in t)

    def find(self, text: str) -> tuple[tuple, tuple]:
        """Numbers (ascending) and counts of the terms of a text."""
        low = words(text)
        found = list(Counter([w for w in low if w in self.words]).items())
        if self.stems:
            found += _stemmed(Counter([w[:STEM] for w in low if w[:STEM] in self.stems and len(w) > STEM]))
        pairs = sorted((self.index[t], n) for t, n in found if t in self.index)
        return tuple(i for i, _ in pairs), tuple(n for _, n in pairs)


def term_counts(docs: DataFrame, terms: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(doc struct, t array<int>, n array<int>): vocabulary words of every text and their counts."""
    vocabulary = Vocabulary(terms)

    def make():
        def fn(text: pa.Array) -> list:
            pairs = [vocabulary.find(x) for x in texts_of(text)]
            return [pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                    pa.array([p[1] for p in pairs], pa.list_(pa.int32()))]
        return fn

    return annotate(docs, keep, [col("text").cast("string")], make, "t array<int>, n array<int>")


class BlockMaxIndex:
    """Examples' unit TF-IDF vectors, blocked; exact k nearest by cosine."""

    def __init__(self, examples: list[tuple], idf: np.ndarray, block: int = BLOCK):
        """examples: (doc_id, label, terms, counts); those without terms are not indexed."""
        self.idf = idf
        ordered = sorted((e for e in examples if e[2]), key=lambda e: (list(e[2]), e[0]))
        self.ids = np.array([e[0] for e in ordered], dtype=np.int64)
        self.label = np.array([e[1] for e in ordered], dtype=np.float64)
        self.block, self.blocks = block, -(-len(ordered) // block)
        postings: dict[int, list] = {}
        for i, e in enumerate(ordered):
            for t, w in zip(e[2], self.weights(e[2], e[3])):
                postings.setdefault(int(t), []).append((i, w))
        # word -> (example positions, weights, start of each block's postings, block maxima)
        self.postings = {}
        for t, p in postings.items():
            at = np.array([x[0] for x in p], dtype=np.int64)
            w = np.array([x[1] for x in p])
            most = np.zeros(self.blocks)
            np.maximum.at(most, at // block, w)
            edge = np.searchsorted(at, np.arange(self.blocks + 1) * block)
            self.postings[t] = (at, w, edge, most)

    def weights(self, terms: Sequence[int], counts: Sequence[int]) -> np.ndarray:
        w = (1.0 + np.log(np.asarray(counts, dtype=np.float64))) * self.idf[np.asarray(terms, dtype=np.int64)]
        return w / np.sqrt((w * w).sum())

    def nearest(self, terms: Sequence[int], counts: Sequence[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, cosines) of the k nearest with a positive cosine; ties to the smaller id."""
        query = [(self.postings[int(t)], w) for t, w in zip(terms, self.weights(terms, counts))
                 if int(t) in self.postings]
        best_at, best = np.zeros(0, dtype=np.int64), np.zeros(0)
        if not query:
            return best_at, best
        bound = np.sum([w * p[3] for p, w in query], axis=0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(best) == k and bound[b] < best[-1] - 1e-12):
                break
            score = np.zeros(self.block)
            for (at, w, edge, _), q in query:
                lo, hi = edge[b], edge[b + 1]
                score[at[lo:hi] - b * self.block] += w[lo:hi] * q
            hit = np.flatnonzero(score > 0)
            best_at = np.concatenate([best_at, hit + b * self.block])
            best = np.concatenate([best, np.round(score[hit], 12)])
            order = np.lexsort((self.ids[best_at], -best))[:k]
            best_at, best = best_at[order], best[order]
        return best_at, best


def vote(index: BlockMaxIndex, at: np.ndarray, cos: np.ndarray, prior: float) -> float:
    """Share of label 1 among the neighbours, weighted by squared cosine, drawn to the prior."""
    w = cos * cos
    return float(((w * index.label[at]).sum() + prior) / (w.sum() + 1.0))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of y on x: knots for linear interpolation.  Each pool's mean is
    drawn to the overall rate by one observation, so no score is exactly 0 or 1."""
    order = np.argsort(x, kind="stable")
    rate = float(y.mean())
    pools: list[list[float]] = []  # sum of y, weight, sum of x
    for v, (xi, yi) in zip(x[order], zip(x[order], y[order])):
        pools.append([yi, 1.0, xi])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            s, w, sx = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += w
            pools[-1][2] += sx
    return (np.array([p[2] / p[1] for p in pools]),
            np.array([(p[0] + rate) / (p[1] + 1.0) for p in pools]))


class Model:
    """Everything a task needs to score texts; its size is bounded by EXAMPLES and TERMS."""

    def __init__(self, terms: list[str], examples: list[tuple], idf: np.ndarray, k: int = NEIGHBOURS):
        self.terms, self.k = terms, k
        self.index = BlockMaxIndex(examples, idf)
        labels = np.array([e[1] for e in examples], dtype=np.float64)
        self.prior = float((labels.sum() + 0.5) / (len(labels) + 1.0)) if len(labels) else 0.0
        bare = np.array([e[1] for e in examples if not e[2]], dtype=np.float64)
        self.bare = float((bare.sum() + self.prior) / (len(bare) + 1.0)) if len(labels) else 0.0
        votes, truth, memo = [], [], {}
        for doc_id, y, t, n in examples:
            if not t:
                continue
            key = (tuple(t), tuple(n))
            if key not in memo:
                memo[key] = self.index.nearest(t, n, k + 1)
            at, cos = memo[key]
            others = self.index.ids[at] != doc_id
            votes.append(vote(self.index, at[others][:k], cos[others][:k], self.prior))
            truth.append(y)
        self.knots = isotonic(np.array(votes), np.array(truth, dtype=np.float64)) if votes else None

    def score(self, t: tuple, n: tuple) -> tuple[float, list[int]]:
        if not t or self.knots is None:
            return self.bare, []
        at, cos = self.index.nearest(t, n, self.k)
        if not len(at):
            return self.bare, []
        raw = vote(self.index, at, cos, self.prior)
        return float(np.interp(raw, *self.knots)), self.index.ids[at[:EVIDENCE]].tolist()


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, y, text) of the sampled ids; equal texts and repeated ids count once."""
    joined = docs.select(col("doc_id").alias("doc_id"), col("text").cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id")  # sample: bounded by its limit
    one = joined.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")).agg(
        F.min("doc_id").alias("doc_id"), F.max("y").alias("y"), F.first("text").alias("text"))
    return one.groupBy("doc_id").agg(F.max("y").alias("y"), F.max("text").alias("text"))


def score_documents(docs: DataFrame, labels: DataFrame, keep: Sequence[str], train: Column,
                    label: str = "toxic", examples: int = EXAMPLES) -> DataFrame:
    """(doc struct, score, predicted, evidence, evidence_terms) of every row of ``docs``."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sample = bounded_sample(labels, label, train, examples, SEED)
    chosen = staged(labelled_texts(docs, sample))
    terms = vocabulary(chosen.select("y", "text"))
    # Whole rows are kept: count in one pass and score in another.  Else stage the small counts.
    counted = term_counts(docs, terms, [c for c in keep if c != "text"] or ["doc_id"])
    whole_rows = "text" in keep
    rows = counted if whole_rows else staged(counted)
    df = dict.fromkeys(range(len(terms)), 0)
    total = 0
    for r in (rows.select(F.explode(F.concat(F.array(F.lit(-1)), F.col("t"))).alias("t"))
              .groupBy("t").count().collect()):  # at most one row per vocabulary word
        if r["t"] < 0:
            total = r["count"]
        else:
            df[r["t"]] = r["count"]
    idf = np.array([np.log((total + 1.0) / (df[i] + 1.0)) + 1.0 for i in range(len(terms))])
    pairs = term_counts(chosen, terms, ["doc_id", "y"]).select("doc.doc_id", "doc.y", "t", "n").collect()
    model = Model(terms, sorted((r["doc_id"], r["y"], list(r["t"]), list(r["n"])) for r in pairs), idf)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: EXAMPLES x TERMS

    out = "score double, predicted int, evidence array<bigint>, evidence_terms array<string>"
    if whole_rows:
        return annotate(docs, keep, [col("text").cast("string")], lambda: _scorer(shared.value, True), out)
    return (annotate(rows, ["doc"], [F.col("t"), F.col("n")], lambda: _scorer(shared.value, False), out)
            .withColumn("doc", F.col("doc.doc")))


def _scorer(model: Model, from_text: bool):
    """Function from texts, or from their words' numbers and counts, to the output columns."""
    memo: dict[tuple, tuple[float, list[int]]] = {}
    vocabulary = Vocabulary(model.terms)

    def fn(*columns: pa.Array) -> list:
        if from_text:
            pairs = [vocabulary.find(t) for t in texts_of(columns[0])]
        else:
            pairs = list(zip(map(tuple, columns[0].to_pylist()), map(tuple, columns[1].to_pylist())))
        found = []
        for key in pairs:
            if key not in memo:
                if len(memo) > 100_000:
                    memo.clear()
                memo[key] = model.score(*key)
            found.append(memo[key])
        return [pa.array([s for s, _ in found], pa.float64()),
                pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                pa.array([ids for _, ids in found], pa.list_(pa.int64())),
                pa.array([[model.terms[i] for i in t] for t, _ in pairs], pa.list_(pa.string()))]
    return fn


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_documents(docs, labels, ["doc_id"], remainder(F.col("doc_id"), 5) != 0)
    return scored.select(F.col("doc.doc_id").alias("doc_id"),
                         (remainder(F.col("doc.doc_id"), 5) == 0).alias("held_out"),
                         "score", "predicted", "evidence", "evidence_terms")
