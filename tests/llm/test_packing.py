import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from courtside.llm import packing

PATH = packing.default_tokenizer()


def whole_ids(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, packing.END_ID], dtype="<u4").tobytes()


@pytest.mark.parametrize("text", [
    "", "  \n ", "Hello, World!! don't I'LL 3rd ½", "ΟΔΟΣ Σ İstanbul", "a\x1cb x\x85y", "ä́Σ Ångström, 東京 タワー.",
    "<|endoftext|> '''s ...x. ﬁ ǅ", "word, word. WORD; word: 'word' w-o-r-d 12word34"])
def test_word_ids_equal_whole_text(text):
    assert next(iter(packing.WordIds(PATH)([text]))) + np.array([2], "<u4").tobytes() == whole_ids(text)


def test_word_ids_when_the_memory_overflows(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_UNITS", 50)
    r = random.Random(3)
    texts = [" ".join("".join(r.choices("abcdef", k=r.randint(1, 6))) + r.choice(["", ",", "!?"]) for _ in range(80))
             for _ in range(60)]
    encode = packing.WordIds(PATH)
    for _ in range(2):
        assert [x + np.array([2], "<u4").tobytes() for x in encode(texts)] == [whole_ids(t) for t in texts]


def check(pieces, texts, window):
    """Every id in one piece; sequences gapless, no longer than the window, without padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for doc_id, ps in by_doc.items():
        ids = whole_ids(texts[doc_id])
        ps.sort(key=lambda p: p["start"])
        assert b"".join(bytes(p["ids"]) for p in ps) == ids
        assert {p["doc_tokens"] for p in ps} == {len(ids) // 4}
        at = 0
        for p in ps:
            assert p["start"] == at and p["length"] > 0
            at += p["length"]
    for ps in by_seq.values():
        ps.sort(key=lambda p: p["offset"])
        at = 0
        for p in ps:
            assert p["offset"] == at
            at += p["length"]
        assert at <= window and (at == window or at & (at - 1) == 0)


def test_pack_round_trip(docs_of, corpus):
    rows = corpus[0]
    check(packing.pack(docs_of(rows), PATH, window=128).collect(), {d[0]: d[1] for d in rows}, 128)


def test_odd_rows(docs_of, odd_rows):
    rows = [d for i, d in enumerate(odd_rows) if i != 5]  # the repeated row, see below
    check(packing.pack(docs_of(rows), PATH).collect(), {d[0]: d[1] for d in rows}, packing.WINDOW)
    twice = packing.with_digest(packing.pack(docs_of(odd_rows), PATH)).where("doc_id = 5").collect()
    assert sum(p["length"] for p in twice) == 2 * twice[0]["doc_tokens"]
    assert packing.pack(docs_of([]), PATH).count() == 0


def test_digest_is_the_ids_crc32(docs_of):
    p = packing.with_digest(packing.pack(docs_of([(1, "some", *[None] * 8)]), PATH)).first()
    assert p["ids_crc32"] == zlib.crc32(whole_ids("some")) and p["length"] == p["doc_tokens"]


def test_level_minimises_the_sum_of_squares():
    r = random.Random(5)
    packer = packing.SumOfSquares(32, lambda *a: None)
    for _ in range(400):
        size = r.randint(1, 31)
        level = packer._level(size)

        def squares(at):
            c = packer.count.copy()
            c[at] -= at > 0
            c[at + size] += at + size < 32
            return int((c * c).sum())
        options = [0, *[x for x in range(1, 33 - size) if packer.count[x]]]
        assert squares(level) == min(map(squares, options))
        packer.place((0, size, 0, bytes(4 * size)))


def test_special_tokens_as_the_tokenizer_loads_them(docs_of):
    texts = ["a <|endoftext|> b", "<|startoftext|>Word<|endoftext|>,", "<|ENDOFTEXT|> <|end oftext|>", "plain words"]
    loaded = Tokenizer.from_file(PATH)
    want = [loaded.encode(t, add_special_tokens=False).ids for t in texts]
    assert 49407 in want[0]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.WordIds(PATH, special=True)(texts)] == want
    for p in packing.pack(docs_of([(0, texts[0], *[None] * 8)]), PATH, window=16).collect():
        assert np.frombuffer(p["ids"], "<u4").tolist() == [*want[0], packing.END_ID][p["start"]:p["start"] + p["length"]]
