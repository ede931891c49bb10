import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, row long, e string, rank int, `a.b` int"


def brute(rows, k=5, m=3, every=50):
    ok = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64), lab) for i, v, lab in rows
          if i is not None and lab is not None and v and None not in v and np.isfinite(np.array(v, dtype=np.float64)).all()]
    out = []
    for a, (i, x, lab) in enumerate(ok):
        if i % every:
            continue
        scored = [(-int(x @ y), j, lb) for c, (j, y, lb) in enumerate(ok) if c != a and len(y) == len(x)]
        for p, pid, _ in sorted(s for s in scored if s[2] == lab)[:k]:
            fits = sorted((s, j) for s, j, lb in scored if lb != lab and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(i, pid, r + 1, j, -p, -s) for r, (s, j) in enumerate(fits[:m])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "x", 1, 1) for i, v, lab in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(2)
    x = r.standard_normal((600, 20)).astype(np.float32)
    x[100:220] = x[100]  # a large group of copies over all labels
    nan, inf = float("nan"), float("inf")
    odd = [(50, None, 1), (150, [], 1), (250, [nan] * 20, 1), (350, [inf] * 20, 1), (450, [0.5] * 19 + [None], 1),
           (None, [1.0] * 20, 1), (550, [1.0] * 20, None), (700, [0.0] * 20, 3), (750, [1.0, 2.0], 1), (751, [2.0, 1.0], 1),
           (752, [1.0, 1.5], 2), (0, [9.0] * 20, 0), (3, [-1.0] * 20, 2), (3, [3.0] * 20, 2)]  # ids that differ in vector
    return [(i, [float(c) for c in v], i % 4) for i, v in enumerate(x)] + odd + [(0, [float(c) for c in x[0]], 0)]


@pytest.mark.parametrize("row_block, anchor_block", [(8192, 2048), (64, 4)])
def test_mined_rows_equal_brute_force(spark, rows, row_block, anchor_block, monkeypatch):
    monkeypatch.setattr(hn, "ROW_BLOCK", row_block)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", anchor_block)
    got = sorted(map(tuple, hn.mine(frame(spark, rows)).collect()))
    assert got == brute(rows) and len(got) > 100


def test_large_components_and_empty_tables(spark):
    assert hn.mine(frame(spark, [])).count() == 0
    big = [(0, [3e6, 2e6], 0), (1, [2e6, 1e6], 0), (2, [1e6, 1e6], 1), (3, [1.5e6, 1e6], 1), (4, [1e6, 2.9e6], 1)]
    assert sorted(map(tuple, hn.mine(frame(spark, big)).collect())) == brute(big)


def block_of(x, labels):
    means, deviations = hn.summarise(x.astype(np.float64))
    return hn.Block(pd.DataFrame({"row": np.arange(len(x)), "vec_id": np.arange(len(x)), "label": labels, "e": list(x),
                                  "means": list(means), "deviations": list(deviations)}))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.sampled_from([3, 300, 2 ** 26]), st.integers(0, 10 ** 6))
def test_bounds_hold_and_tighten(dim, scale, seed):
    r = np.random.default_rng(seed)
    block = block_of(r.integers(-scale, scale, (30, dim)), np.zeros(30, np.int64))
    at = np.arange(30)
    score = block.scores(at, block, 0)
    widths = []
    for level in range(len(hn.LEVELS)):
        low, high = block.bounds(level, at, block, 0)
        assert (low <= score).all() and (score <= high).all()
        widths.append((high - low).max())
    assert widths[-1] <= widths[0] + 4


def test_clustered_vectors_are_pruned_before_exact_scoring(monkeypatch):
    """Of smooth vectors in clusters the segments' bounds leave few rows to be scored."""
    r = np.random.default_rng(4)
    centres = np.repeat(r.standard_normal((40, 8)) * 100, 8, axis=1)
    x = np.floor(centres[np.arange(4000) % 40] + r.standard_normal((4000, 64)) * 8).astype(np.int64)
    block = block_of(x, np.arange(4000) % 40 // 2)
    scored = []
    exact = hn.Block.scores
    monkeypatch.setattr(hn.Block, "scores", lambda self, at, *rest: (scored.append(len(at)), exact(self, at, *rest))[1])
    at, score = hn.refine(block, np.arange(1, 4000), block, 0, hn.among_best(5))
    whole = x[1:] @ x[0]
    assert sorted(score[hn.best(score, at, 5)]) == sorted(np.sort(whole)[-5:])
    first, last = hn.windows_of([int(np.sort(whole)[-5])], 50, 95)[0]
    at, score = hn.refine(block, np.arange(1, 4000), block, 0, hn.among_best_inside([(first, last)], 3))
    inside = np.sort(whole[(whole >= first) & (whole <= last)])[-3:]
    assert sorted(score[(score >= first) & (score <= last)])[-3:] == list(inside)
    assert max(scored) < 0.35 * 4000


def test_windows_are_whole_and_inclusive():
    assert hn.windows_of([100, 101, 0, -10], 50, 95) == [(50, 95), (51, 95), (0, 0), (-5, -10)]
