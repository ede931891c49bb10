import random
from collections import Counter

import numpy as np

from courtside.llm import mixing
from pyspark.sql import functions as F


def mixed(df):
    return mixing.plan_mix(df, keep=["doc_id"]).select(
        "doc.doc_id", "mix.size", "mix.source_size", "mix.target", "mix.passes").collect()


def test_targets_share_by_weight_and_stop_at_three_times():
    assert mixing.targets([10, 10, 10]) == [30 * 5 / 8, 30 * 2 / 8, 30 / 8]
    t = mixing.targets([1, 100, 100, 100])
    assert t[0] == 3 and abs(sum(t) - 301) < 1e-9 and abs(t[1] / t[2] - 2) < 1e-9
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


def brute(sizes, counts, budget):
    reach = {0}
    for s, c in zip(sizes, counts):
        reach = {r + s * k for r in reach for k in range(c + 1)}
    return min(abs(r - budget) for r in reach)


def test_fit_against_brute_force():
    r = random.Random(2)
    for t in range(60):
        sizes = np.array(sorted(r.sample(range(3, 60), r.randint(1, 6))))
        counts = np.array([r.randint(1, 5) for _ in sizes])
        budget = r.randint(0, int((sizes * counts).sum()) + 5)
        take = mixing.fit(sizes, counts, budget, t)
        assert (take >= 0).all() and (take <= counts).all()
        assert abs(int((take * sizes).sum()) - budget) == brute(sizes, counts, budget)


def test_fit_of_a_large_budget(monkeypatch):
    monkeypatch.setattr(mixing, "DP_SPAN", 50)
    sizes, counts = np.array([3, 7, 11, 20]), np.array([900, 800, 700, 600])
    take = mixing.fit(sizes, counts, 9999, 1)
    assert int((take * sizes).sum()) == 9999 and (take <= counts).all()
    share = take / counts
    assert share.max() - share.min() < 0.05  # proportional but for the rest


def test_mix_meets_targets_and_agrees_with_a_rerun(docs_of, corpus):
    df = docs_of(corpus[0])
    a, b = mixed(df), mixed(df.repartition(7))
    assert Counter(map(tuple, a)) == Counter(map(tuple, b)) and len(a) == 300
    words = {d[0]: len(d[1].split()) for d in corpus[0]}
    sources = {d[0]: d[3] for d in corpus[0]}
    taken, target = Counter(), {}
    for r in a:
        assert r["size"] == words[r["doc_id"]] and 0 <= r["passes"] <= 3
        taken[sources[r["doc_id"]]] += r["size"] * r["passes"]
        target[sources[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_odd_rows(docs_of, odd_rows):
    got = mixed(docs_of(odd_rows))
    assert len(got) == len(odd_rows)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3, 10)} == {0}
    assert mixed(docs_of([])) == [] and mixing.mix(docs_of([])).count() == 0
    out = mixing.mix(docs_of(odd_rows))
    assert out.columns == docs_of([]).columns
    assert out.count() == sum(r["passes"] for r in got)


def test_reruns_agree_on_rows_without_ids(docs_of):
    """Null and repeated ids, sizes alike: the same texts are taken however the rows are dealt to tasks."""
    rows = [(None if i % 2 else 7, f"w{i} b c", None, "x", 1, *[None] * 5) for i in range(60)] + \
           [(None, "a b c", None, "y", n, *[None] * 5) for n in range(60)]
    df = docs_of(rows)
    runs = [sorted(map(repr, mixing.mix(df.repartition(n, F.rand(n))).collect())) for n in (1, 3, 7)]
    assert runs[0] == runs[1] == runs[2] and 0 < len(set(runs[0])) < len(rows)


def test_columns_of_maps_are_kept(docs_of):
    df = docs_of([(i, "a b", None, "x", 1, *[None] * 5) for i in range(9)]).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    assert {r["m"]["k"] for r in mixing.mix(df).collect()} == {1}


def test_copies_share_a_size(docs_of):
    """One size and source for all rows: a part of them is taken, by rank within one class."""
    rows = [(i, "a b c", None, "x", 1, *[None] * 5) for i in range(500)] + \
           [(1000 + i, "a b c d", None, "y", 1, *[None] * 5) for i in range(500)]
    got = mixed(docs_of(rows))
    for ids, size in ((range(500), 3), (range(1000, 1500), 4)):
        part = [r for r in got if r["doc_id"] in ids]
        assert abs(sum(r["passes"] * size for r in part) - part[0]["target"]) <= size


def test_size_counts_words(spark):
    texts = ["", " ", "a", " a b\tc\x0bd\x1ce ", None, " x"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.size_of(F.col("t"))).collect()
    assert [r[0] for r in got] == [0, 0, 1, 3, 0, 1]
