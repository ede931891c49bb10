import numpy as np
import pytest

from courtside.llm import blocks, hash_forest, topk

SCHEMA = "vec_id long, embedding array<float>, label int, query_id long, score string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in vectors], SCHEMA)


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(1)
    x = r.standard_normal((700, 16)).astype(np.float32) / 4
    x[100:300] = x[100]  # a large group of equal vectors
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def odd(vectors):
    nan, inf = float("nan"), float("inf")
    return [*vectors, (900, None), (901, []), (902, [nan] * 16), (903, [inf] * 16), (950, [0.5] * 15 + [None]),
            (None, [1.0] * 16), (1000, [0.0] * 16), (1050, [1.0, 2.0]), (1051, [2.0, 1.0]), (0, vectors[0][1])]


def brute_integer(vectors, k=5):
    """Every row is a candidate of every query row but itself, whatever its id."""
    x = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in vectors]
    out = []
    for a, (q, e) in enumerate(x):
        if q % 50 == 0:
            best = sorted((-int(e @ f), c) for b, (c, f) in enumerate(x) if b != a and len(e) == len(f))[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


REPEATED = [(1, [0.9, 0.1]), (1, [0.2, 0.1]), (0, [1.0, 0.0]), (2, [0.5, 0.5]), (0, [0.4, -1.0]), (50, [0.4, -1.0])]


def test_rows_of_one_id_with_different_vectors_count_each(spark):
    """Also as queries: each row of an id asks for itself."""
    assert sorted(map(tuple, topk.exact_top_k(frame(spark, REPEATED)).collect())) == brute_integer(REPEATED)
    x = [(i, np.array(v)) for i, v in REPEATED]
    want = []
    for a, (q, e) in enumerate(x):
        if q % 50 == 0:
            best = sorted((-round(float(e @ f / np.sqrt(e @ e) / np.sqrt(f @ f)), 6), c) for b, (c, f) in enumerate(x) if b != a)[:5]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    got = hash_forest.nearest_neighbours(frame(spark, REPEATED)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in got) == sorted(want)


@pytest.mark.parametrize("block", [64, 4096])
def test_top_k_is_exact(spark, vectors, block, monkeypatch):
    monkeypatch.setattr(blocks, "VECTOR_BLOCK", block)
    monkeypatch.setattr(blocks, "QUERY_BLOCK", 4)
    got = sorted(map(tuple, topk.exact_top_k(frame(spark, odd(vectors))).collect()))
    assert got == brute_integer([*vectors, (1000, [0.0] * 16), (1050, [1.0, 2.0]), (1051, [2.0, 1.0]), (0, vectors[0][1])])


def test_top_k_of_large_components_and_few_rows(spark):
    rows = [(0, [3e6, -2e6]), (1, [1e6, 1e6]), (2, [-1e6, 5e5])]
    assert sorted(map(tuple, topk.exact_top_k(frame(spark, rows)).collect())) == brute_integer(rows)
    assert topk.exact_top_k(frame(spark, [])).count() == 0
    assert hash_forest.nearest_neighbours(frame(spark, [])).count() == 0


def test_forest_recall_and_scores(spark, vectors):
    x = {i: np.array(v, dtype=np.float64) for i, v in vectors}
    got = {}
    for q, rank, c, s in hash_forest.nearest_neighbours(frame(spark, odd(vectors)[:-1])).collect():  # the repeated row: see above
        got.setdefault(q, []).append((rank, c, s))
    assert 1000 not in got and [c for _, c, _ in got[1050]] == [1051]
    hits = total = 0
    for q in (i for i in x if i % 50 == 0):
        cos = {c: float((x[q] * x[c]).sum() / np.sqrt((x[q] * x[q]).sum()) / np.sqrt((x[c] * x[c]).sum()))
               for c in x if c != q}
        best = sorted((-round(s, 12), c) for c, s in cos.items())[:5]
        found = sorted(got[q])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(cos[c] - s) < 1e-12 for _, c, s in found)
        assert [(-s, c) for _, c, s in found] == sorted((-s, c) for _, c, s in found)
        hits += len({c for _, c in best} & {c for _, c, _ in found})
        total += 5
    assert hits / total >= 0.95


def test_forest_recall_without_structure():
    """Random vectors, the worst case: recall of the candidates within a block."""
    r = np.random.default_rng(3)
    x = r.standard_normal((4000, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    strings = hash_forest.hash_strings(x, hash_forest.TREES, hash_forest.BITS, hash_forest.SEED)
    cos = x[:60] @ x.T
    hits = 0
    for q, at in enumerate(hash_forest.candidates(strings, strings[:60], hash_forest.BITS, hash_forest.EFFORT)):
        hits += len(set(np.argsort(-cos[q])[1:6]) & set(at))
    assert hits / 300 >= 0.95


def test_ascent_reaches_longest_prefixes_first():
    rows = np.array([[0b1010], [0b1011], [0b0000], [0b1111]])
    found = [set(a) for a in hash_forest.candidates(rows, np.array([[0b1010]]), 4, 0.5)]
    assert found == [{0, 1, 3}]  # the own row and half the rows are met at one bit
