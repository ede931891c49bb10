"""Toxicity, quality, language and language-model operators."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from courtside.llm import ctw, langid, quality_mil, toxicity
from courtside.llm.common import remainder


def fold(i, k):
    return zlib.crc32(str("" if i is None else i).encode()) % k


# --- toxicity -------------------------------------------------------------------------------

def test_toxicity_held_out(docs_of, labels_of, corpus):
    docs, labels = corpus
    got = toxicity.score_documents(docs_of(docs), labels_of(labels), ["doc_id"], remainder(F.col("doc_id"), 5) != 0)
    out = {r["doc"]["doc_id"]: r for r in got.collect()}
    held = [i for i in out if fold(i, 5) == 0]
    assert len(out) == 300 and np.mean([out[i]["predicted"] == (i % 5 == 0) for i in held]) > 0.95
    ids = {l[0] for l in labels}
    for r in out.values():
        assert 0 <= r["score"] <= 1 and set(r["evidence"]) <= {i for i in ids if fold(i, 5)}


def test_toxicity_keeps_rows(docs_of, labels_of, corpus, odd_rows):
    docs, labels = corpus
    df = docs_of(docs + [(1000 + (d[0] or 0), *d[1:]) for d in odd_rows])
    a = toxicity.score_documents(df, labels_of(labels), df.columns, remainder(F.col("doc_id"), 5) != 0)
    b = toxicity.score_documents(df, labels_of(labels), ["doc_id"], remainder(F.col("doc_id"), 5) != 0)
    assert a.select("doc.*").columns == df.columns
    x = sorted((r["doc"]["doc_id"], round(r["score"], 9)) for r in a.collect())
    assert x == sorted((r["doc"]["doc_id"], round(r["score"], 9)) for r in b.collect()) and len(x) == df.count()


def test_toxicity_without_labels_or_rows(docs_of, labels_of, odd_rows):
    keep = remainder(F.col("doc_id"), 5) != 0
    got = toxicity.score_documents(docs_of(odd_rows), labels_of([]), ["doc_id"], keep).collect()
    assert len(got) == len(odd_rows) and {r["score"] for r in got} == {0.0}
    assert toxicity.score_documents(docs_of([]), labels_of([(None, None, None)]), ["doc_id"], keep).count() == 0


def test_block_max_search_is_exact():
    r = random.Random(4)
    examples = []
    for i in range(700):
        terms = sorted(r.sample(range(12), r.randint(0, 4)))
        examples.append((i, i % 2, terms, [r.randint(1, 3) for _ in terms]))
    idf = np.linspace(1, 3, 12)
    index = toxicity.BlockMaxIndex(examples, idf, block=16)

    def dense(t, n):
        v = np.zeros(12)
        if t:
            v[list(t)] = (1 + np.log(np.array(n, float))) * idf[list(t)]
            v /= np.sqrt((v * v).sum())
        return v
    table = [(e[0], dense(e[2], e[3])) for e in examples if e[2]]
    for _ in range(60):
        t = sorted(r.sample(range(12), r.randint(1, 4)))
        n = [r.randint(1, 3) for _ in t]
        at, cos = index.nearest(t, n, 9)
        q = dense(t, n)
        best = sorted((-round(float(q @ v), 9), i) for i, v in table if q @ v > 0)[:9]
        assert [(-round(float(c), 9), int(index.ids[a])) for a, c in zip(at, cos)] == best


def test_isotonic_rises():
    x, y = np.array([0.1, 0.2, 0.3, 0.4, 0.9]), np.array([0.0, 1, 0, 0, 1])
    kx, ky = toxicity.isotonic(x, y)
    assert (np.diff(ky) >= 0).all() and (np.diff(kx) > 0).all() and 0 < ky.min() and ky.max() < 1


# --- quality --------------------------------------------------------------------------------

def test_quality_held_out(docs_of, labels_of, corpus):
    docs, labels = corpus
    model = quality_mil.train(docs_of(docs), labels_of(labels), remainder(F.col("doc_id"), 3) != 1)
    out = {r["doc"]["doc_id"]: r for r in quality_mil.score_documents(docs_of(docs), model, ["doc_id"]).collect()}
    held = [i for i in out if fold(i, 3) == 1]
    assert np.mean([out[i]["predicted"] == (i % 4 != 1) for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and 0 < r["attention"] <= 1 for r in out.values())


def test_quality_odd_rows(docs_of, labels_of, corpus, odd_rows):
    docs, labels = corpus
    model = quality_mil.train(docs_of(docs), labels_of(labels + labels[:5]), F.lit(True))
    df = docs_of(odd_rows)
    got = quality_mil.score_documents(df, model, df.columns)
    assert got.count() == len(odd_rows) and got.select("doc.*").columns == df.columns
    by = {r["doc"]["doc_id"]: r["score"] for r in got.collect()}
    assert by[1] == by[2] == by[3] == by[10] and by[5] == by[6] == by[9]
    none = quality_mil.train(df, labels_of([]), F.lit(True))
    assert none is None
    assert {r["score"] for r in quality_mil.score_documents(df, none, ["doc_id"]).collect()} == {0.5}
    assert quality_mil.score_documents(docs_of([]), model, ["doc_id"]).count() == 0


def test_gradients_against_differences():
    r = np.random.default_rng(0)
    x, first, bag = r.standard_normal((9, quality_mil.FEATURES)), np.array([0, 2, 6]), np.array([0, 0, 1, 1, 1, 1, 2, 2, 2])
    y = np.array([1.0, 0, 1])
    net = quality_mil.GatedAttention.fresh(1)

    def loss():
        p = net.forward(x, first, bag)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    g = net.gradients(x, first, bag, y)
    for k, w in net.w.items():
        flat = w.reshape(-1)
        for j in range(0, flat.size, max(1, flat.size // 5)):
            old = flat[j]
            flat[j] = old + 1e-6
            up = loss()
            flat[j] = old - 1e-6
            down = loss()
            flat[j] = old
            assert abs((up - down) / 2e-6 - g[k].reshape(-1)[j]) < 1e-6


def test_passages_cover_every_word():
    texts = ["", "a " * 200, "x\n", "  ", "b c! D"]
    x, doc = quality_mil.passages(texts)
    assert doc.tolist() == [0, 1, 1, 1, 1, 2, 3, 4]
    sizes = np.round(np.expm1(x[:, -2] * 5)).astype(int)
    assert sizes.tolist() == [0, 64, 64, 64, 8, 1, 0, 3]


# --- language -------------------------------------------------------------------------------

def test_language_held_out(docs_of, odd_rows):
    r = random.Random(2)
    parts = {"aa": ["tha", "ing", "ere"], "bb": ["sch", "ung", "ich"], "cc": ["que", "eau", "oi"]}
    rows = [(i, " ".join("".join(r.choices(parts[g], k=3)) for _ in range(12)), g, "s", 1, *[None] * 5)
            for i in range(240) for g in [list(parts)[i % 3]]]
    model = langid.prototypes(docs_of(rows), remainder(F.col("doc_id"), 3) != 1)
    got = langid.identify(docs_of(rows), model, ["doc_id", "lang"]).collect()
    assert all(x["lang_pred"] == x["doc"]["lang"] and 0 <= x["score"] <= 1 for x in got) and sorted(model) == list(parts)
    odd = docs_of(odd_rows)
    out = langid.identify(odd, model, odd.columns)
    assert out.count() == len(odd_rows) and out.select("doc.*").columns == odd.columns
    by = {x["doc"]["doc_id"]: x for x in out.collect()}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3, 10))
    assert langid.prototypes(docs_of([]), F.lit(True)) == {}
    assert {x["lang_pred"] for x in langid.identify(odd, {}, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(docs_of([]), model, ["doc_id"]).count() == 0


def test_bundles_are_sums_of_bound_trigrams(monkeypatch):
    monkeypatch.setattr(langid, "REMEMBER", 20)
    hyper = langid.Hyper(64, 3)
    text = "Straße, ab c" * 3

    def letter(c):
        return hyper._random(ord(c) if c != " " else 0).astype(int)
    padded = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    want = sum(np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
               for a, b, c in zip(padded, padded[1:], padded[2:]) if b != " ")
    for _ in range(2):
        assert (hyper.bundle([text, "", "12"]) == np.stack([want, want * 0, want * 0])).all()


# --- context-tree weighting -------------------------------------------------------------------

def tree_of(texts, nodes=1 << 20):
    k, c = ctw._merge([np.unique(ctw.runs(*ctw.coded(texts)[:2]))],
                      [np.unique(ctw.runs(*ctw.coded(texts)[:2]), return_counts=True)[1]])
    frames = []
    for d in range(1, ctw.DEPTH + 1):
        x, n = ctw._merge([(k >> 8) & ((1 << 8 * d) - 1)], [c])
        frames.append(pd.DataFrame({"depth": d, "context": x, "n": n}))
    kept = pd.concat(frames).sort_values(["n", "depth", "context"], ascending=[False, True, True]).head(nodes)
    rows = []
    for d in range(ctw.DEPTH + 1):
        x, n = ctw._merge([k & ((1 << 8 * (d + 1)) - 1)], [c])
        f = pd.DataFrame({"depth": d, "context": x >> 8, "byte": x & 255, "n": n})
        rows.append(f[f["context"].isin(set(kept["context"][kept["depth"] == d]))] if d else f)
    return ctw.ContextTree(pd.concat(rows))


def brute_ctw(texts, text):
    """All contexts kept: the textbook recursion, bit by bit."""
    D, bits = ctw.DEPTH, {}
    for t in texts:
        s = bytes([ctw.END]) * D + t + bytes([ctw.END])
        for i in range(D, len(s)):
            for d in range(D + 1):
                for j in range(8):
                    key = (s[i - d:i], j, s[i] >> (8 - j))
                    bits.setdefault(key, [0, 0])[(s[i] >> (7 - j)) & 1] += 1

    def pe(key):
        a, b = bits.get(key, (0, 0))
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)
    children = {}
    for c, j, v in bits:
        if len(c):
            children.setdefault((c[1:], j, v), []).append((c, j, v))
    memo = {}

    def pw(key):
        if key not in memo:
            memo[key] = pe(key) if len(key[0]) == D else \
                np.logaddexp(pe(key), sum(pw(x) for x in children[key])) - math.log(2)
        return memo[key]
    contexts = {c for c, _, _ in bits}
    s, total = bytes([ctw.END]) * D + text + bytes([ctw.END]), 0.0
    for i in range(D, len(s)):
        d = max(k for k in range(D + 1) if s[i - k:i] in contexts)
        for j in range(8):
            v, bit = s[i] >> (8 - j), (s[i] >> (7 - j)) & 1
            a, b = bits.get((s[i - d:i], j, v), (0, 0))
            p = (b + .5) / (a + b + 1)
            if d < D:
                p = .5  # a longer context that was never seen
            for k in range(d if d < D else D - 1, -1, -1):
                key = (s[i - k:i], j, v)
                a, b = bits.get(key, (0, 0))
                rest = sum(pw(x) for x in children.get(key, []))
                w = 1 / (1 + math.exp(rest - pe(key)))
                p = w * (b + .5) / (a + b + 1) + (1 - w) * p
            total += math.log10(p if bit else 1 - p)
    return total


def test_context_tree_against_the_recursion():
    texts = [b"abracadabra", b"abra", b"", b"banana bandana", "héé".encode()]
    tree = tree_of(texts)
    for t in [b"abra", b"banana", b"xyz", b"", b"band abracada", "é".encode()]:
        assert abs(tree.score([t])[0] - brute_ctw(texts, t)) < 1e-4


@pytest.mark.parametrize("nodes", [0, 3, 40])
def test_probabilities_add_up_to_one(nodes):
    r = random.Random(1)
    tree = tree_of([bytes(r.choices(b"abc d", k=300)) for _ in range(5)], nodes)
    assert np.allclose((10 ** tree.table.astype(float)).sum(axis=1), 1, atol=1e-5)
    assert len(tree.table) <= nodes + 1


def test_scores_and_base(docs_of, corpus, odd_rows):
    rows = corpus[0][:80] + [((d[0] or 0) + 1000, *d[1:]) for d in odd_rows]
    got = ctw.score_documents(docs_of(rows), remainder(F.col("doc_id"), 5) != 1, ["doc_id"], frequent=8).collect()
    tokens = {d[0]: (d[1] or "").encode().lower().split() + [b""] for d in rows}
    train = Counter(w for d in rows if fold(d[0], 5) != 1 for w in (d[1] or "").encode().lower().split() + [b""])
    n, v = sum(train.values()), len(train)
    assert len(got) == len(rows)
    for r in got:
        t = tokens[r["doc"]["doc_id"]]
        base = sum(math.log10((train[w] + .5) / (n + .5 * (v + 1))) for w in t)
        assert r["n_tokens"] == len(t) and r["n_known"] == sum(train[w] > 0 for w in t) and r["train_tokens"] == n
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] < 0
    want = tree_of([(d[1] or "").encode() for d in rows if fold(d[0], 5) != 1], ctw.NODES)
    for r in got:
        text = next(d[1] for d in rows if d[0] == r["doc"]["doc_id"]) or ""
        assert abs(r["score"] - want.score([text.encode()])[0]) < 1e-6 * abs(r["score"])
        assert abs(r["bits_per_byte"] * (len(text.encode()) + 1) + r["score"] * math.log2(10)) < 1e-6 * abs(r["score"]) * 4


def test_scores_without_training_or_rows(docs_of):
    got = ctw.score_documents(docs_of([(1, "ab", *[None] * 8)]), F.lit(False), ["doc_id"]).first()
    assert abs(got["score"] - 24 * math.log10(.5)) < 1e-6 and got["n_known"] == 0 and got["train_tokens"] == 0
    assert ctw.score_documents(docs_of([]), F.lit(True), ["doc_id"]).count() == 0


@pytest.mark.parametrize("most_runs", [ctw.FREQUENT_RUNS, 500, 0])
def test_every_context_is_a_node(docs_of, most_runs):
    """More contexts than a tree of NODES holds: scores are those of the whole tree."""
    r = random.Random(11)
    letters = [chr(97 + i) for i in range(26)] + list("0123456789 ,.é")
    texts = ["".join(r.choices(letters, k=1100)) for _ in range(20)] + ["the same words over and over " * 9] * 2
    train = [t.encode() for i, t in enumerate(texts) if fold(i, 5) != 1]
    seen = {s[i - d:i] for t in train for s in [b"\xff" * ctw.DEPTH + t + b"\xff"]
            for i in range(ctw.DEPTH, len(s)) for d in range(1, ctw.DEPTH + 1)}
    assert len(seen) > ctw.NODES
    got = ctw.score_documents(docs_of([(i, t, *[None] * 8) for i, t in enumerate(texts)]),
                              remainder(F.col("doc_id"), 5) != 1, ["doc_id"], most_runs=most_runs).collect()
    scores = {x["doc"]["doc_id"]: x["score"] for x in got}
    whole = tree_of(train)
    for i, t in enumerate(texts):
        want = whole.score([t.encode()])[0]
        assert abs(scores[i] - want) < 1e-6 * abs(want)
