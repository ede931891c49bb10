import random
from collections import Counter

import numpy as np
import pytest

from courtside.llm import bagminhash as B
from courtside.llm.components import components

THRESHOLD = 0.8


def multiset(text):
    w = text.lower().encode().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute_classes(rows):
    """doc_id -> smallest doc_id of its class, by all pairs."""
    texts = {}
    for d in rows:
        texts[d[0]] = multiset(d[1] or "")
    up = {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if texts[a] and texts[b] and similarity(texts[a], texts[b]) >= THRESHOLD:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def make(seed, groups=12, copies=9, edits=4):
    """Groups of texts that differ from their base by a few words: links, chains and near misses."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefgh", k=5)) for _ in range(400)]
    rows, i = [], 0
    for _ in range(groups):
        base = r.choices(vocabulary, k=r.choice([4, 12, 60, 150]))
        for _ in range(r.randint(1, copies)):
            words = list(base)
            for _ in range(r.randint(0, edits)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            text = " ".join(words)
            rows += [(i, text.upper() if r.random() < 0.1 else text, None, "s", 1, *[None] * 5)]
            i += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_classes_equal_brute_force(docs_of, seed):
    rows = make(seed)
    got = B.classes(docs_of(rows)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(rows) and len(got) == len(rows)


def test_large_groups_and_common_passages(docs_of):
    """Hundreds of near copies of one text, and texts that share half their words."""
    r = random.Random(9)
    vocabulary = ["".join(r.choices("abcdefgh", k=5)) for _ in range(3000)]
    base, shared = r.choices(vocabulary, k=100), r.choices(vocabulary, k=40)
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(100)] = r.choice(vocabulary)
        rows.append((i, " ".join(words), None, "s", 1, *[None] * 5))
    for i in range(300, 400):
        rows.append((i, " ".join(shared + r.choices(vocabulary, k=r.randint(2, 25))), None, "s", 1, *[None] * 5))
    rows += [(i, rows[0][1], None, "s", 1, *[None] * 5) for i in range(400, 500)]
    assert {x["doc_id"]: x["class_id"] for x in B.classes(docs_of(rows)).collect()} == brute_classes(rows)


def test_odd_rows(docs_of, odd_rows):
    got = Counter((r["doc_id"], r["class_id"]) for r in B.classes(docs_of(odd_rows)).collect())
    assert got[(5, 5)] == 2 and got[(6, 5)] == got[(9, 5)] == 1
    assert all(got[(i, i)] == 1 for i in (1, 2, 3, 4, 7, 8, 10)) and got[(None, None)] == 1
    kept = B.keep_one(docs_of(odd_rows))
    assert kept.columns == docs_of([]).columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 10]
    assert B.classes(docs_of([])).count() == 0 and B.keep_one(docs_of([])).count() == 0


def test_signatures_are_unbiased_for_counts():
    r = np.random.default_rng(0)
    errors = []
    for _ in range(40):
        h = np.sort(r.integers(0, 2 ** 63, 50).astype(np.uint64))
        a, b = r.integers(0, 40, 50), r.integers(0, 40, 50)
        b = np.where(r.random(50) < 0.6, a, b)
        doc = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
        s = B.signatures(doc, np.r_[h[a > 0], h[b > 0]], np.r_[a[a > 0], b[b > 0]], 2, 512)
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        errors.append((s[0] == s[1]).mean() - true)
        assert abs(B.distance((h[a > 0], a[a > 0]), (h[b > 0], b[b > 0])) - (1 - true)) < 1e-12
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.04


def test_signature_of_a_text_is_the_same_in_any_company():
    texts = [b"one two three", b"a b c d e f g " * 40, b"", b"x"]
    doc, h, n = B.multisets(texts)
    whole = B.signatures(doc, h, n, 4, 160)
    for i in range(4):
        d1, h1, n1 = B.multisets([texts[i]])
        assert (B.signatures(d1, h1, n1, 1, 160)[0] == whole[i]).all()
    assert np.isinf(whole[2]).all() and np.isfinite(whole[[0, 1, 3]]).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (9, 7), (50, 50), (1, 2)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 100 for i in range(100, 141)}, 3: 3, 7: 3, 9: 3, 1: 1, 2: 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_pairs_miss_no_link(spark):
    """With every text a component of its own, all pairs at the threshold are candidates."""
    rows = [(d[0], d[1]) for d in make(5, groups=15, copies=8, edits=6)]
    texts = spark.createDataFrame(rows, "node long, text string")
    nodes = texts.selectExpr("node", "node AS component")
    found = {tuple(r) for r in B.prefix_pairs(nodes, texts, THRESHOLD).collect()}
    sets = {i: multiset(t) for i, t in rows}
    links = {(a, b) for a in sets for b in sets if a < b and similarity(sets[a], sets[b]) >= THRESHOLD}
    assert links and links <= found and len(found) < len(rows) * (len(rows) - 1) / 4


def test_distances_of_given_pairs(spark):
    rows = [(i, d[1]) for i, d in enumerate(make(6, groups=4))]
    texts = spark.createDataFrame(rows, "node long, text string")
    pairs = [(a, b) for a in range(len(rows)) for b in (0, 1) if a > 1]
    got = {(r.a, r.b): r.distance for r in
           B.verified(spark.createDataFrame(pairs, "a long, b long"), texts, 5).collect()}
    assert set(got) == set(pairs)
    for (a, b), x in got.items():
        assert abs(1 - x - similarity(multiset(rows[a][1]), multiset(rows[b][1]))) < 1e-12
