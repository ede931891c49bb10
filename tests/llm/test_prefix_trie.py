import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, size long, `a.b` int"


def turn(conv, n, role, text):
    return (conv, n, role, text, "own", 9, 9, 1)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = []
    for c in [*range(0, 130), *range(300, 330), *range(1001, 1040), -7, -200]:
        n = r.choice([1, 2, 2, 3, 5, 9])
        out += [turn(c, t, r.choice(["user", "bot"]), r.choice(["a", "b", "Ünï😀", "long text " * 9])) for t in range(n)]
    out += [turn(500, t, "user", f"w{t % 3}") for t in range(700)]  # one long conversation and a long family
    out += [turn(c, t, "user", "same") for c in range(600, 640) for t in range(4)]
    out += [turn(2001, None, None, None), turn(2001, None, "user", None), turn(2001, 3, None, "x"), turn(2001, 3, "b", "y"),
            turn(2002, 1, "user", "x"), turn(2002, 1, "user", "x"), turn(2003, 0, "us", "er"), turn(2004, 0, "use", "r"),
            turn(None, 0, "user", "x"), turn(None, None, None, None)]
    r.shuffle(out)
    return out


def brute(rows):
    convs = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((t is not None, t or 0, digest, role, text))
    own = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - int(np.fmod(c, 100))
        path = tuple(own.get(family, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, d == len(path)))
    kids, leaves, saved = {}, {}, {}
    for path in nodes:
        if path:
            kids[path[:-1]] = kids.get(path[:-1], 0) + 1
    for path, members in nodes.items():
        gain = (len(members) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] = leaves.get(path[:d], 0) + (path not in kids)
            saved[path[:d]] = saved.get(path[:d], 0) + gain
    first = {path: min(c for c, _ in m) for path, m in nodes.items()}
    return sorted(((first[p], len(p), first[p[:-1]] if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c, e in m if e))).encode()).hexdigest())
                   for p, m in nodes.items()), key=repr)


@pytest.mark.parametrize("limit, centroids, chunk, piece", [(20_000, 50_000, 256, 4096), (7, 2, 5, 3), (60, 50_000, 256, 2)])
def test_trie_equals_brute_force(spark, rows, limit, centroids, chunk, piece, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    some = rows if limit > 7 else [x for x in rows if x[0] in (500, 2001, 2002, None) or (x[0] or 0) % 3 == 0]
    if limit == 7:  # a long path takes a round for every halving
        some = [x for x in some if x[0] != 500 or (x[1] or 0) < 60]
    table = spark.createDataFrame(some, SCHEMA).repartition(5)
    got = prefix_trie.conversation_trie(table, limit, centroids)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(some)


def test_empty_and_turnless(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [turn(c, 0, "user", "x") for c in range(1, 60)]  # the family's first is absent: heads are cut off
    got = prefix_trie.conversation_trie(spark.createDataFrame(one, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(one)
    assert max(r.depth for r in got) == 1 and any(r.depth == 0 and r.ends_sha256 != hashlib.sha256(b"").hexdigest() for r in got)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 6), st.integers(0, 9)), min_size=1, max_size=60))
def test_decomposition_sums_subtrees(drawn):
    parents = [-1 if i == 0 or p % 7 == 0 else p % i for i, (p, _) in enumerate(drawn)]
    depths = []
    for p in parents:
        depths.append(0 if p < 0 else depths[p] + 1)
    values = np.array([[v, 1] for _, v in drawn], dtype=np.int64)
    want = values.copy()
    for u in reversed(range(len(parents))):
        if parents[u] >= 0:
            want[parents[u]] += want[u]
    assert (prefix_trie.decompose(parents, depths, values) == want).all()
