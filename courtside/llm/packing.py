"""Operator 7: sum-of-squares online packing of tokenised documents into fixed windows.

Documents are tokenised and packed in the order in which a task reads them.  A document longer
than a window first fills whole windows; its remainder goes, as one piece, to the fill level that
minimises the sum of squared counts of partially filled windows (Csirik et al.), kept in a level
array.  A full window leaves the task at once, so a task holds at most ``window`` open levels.

Closing.  Windows still open when the input ends would be padded.  Those whose fill is a power of
two need no padding and stay.  The others are laid end to end and cut at window ends; the last
one's ids are cut into sequences whose lengths are powers of two.  Every id lies in exactly one
piece and no sequence needs padding.

Packing is a narrow pass: no shuffle, memory bounded by ``window * window`` ids in the worst case,
and a lost task is simply run again.  ``sequence_id`` holds the task's number in its upper bits.

Null text: empty (the end id alone).  Empty table: no rows.  Repeated rows: each row is packed.
Extra columns are ignored.  A null doc_id stays null.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import BATCH_ROWS, releasing, table, texts_of
from courtside.llm.words import Words, chunks

WINDOW, END_ID = 4096, 2
CACHE_UNITS = 500_000  # units whose ids a task remembers (some 25 bytes each); emptied when full
FLUSH_IDS = 1_000_000
SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")

_MARK = np.zeros(256, dtype=bool)
_MARK[[i for i in range(33, 127) if not chr(i).isalnum()]] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[i for i in range(128) if chr(i).isalnum()]] = True
_LATIN = np.zeros(256, dtype=bool)  # second bytes of the letters from U+00C0 to U+00FF
_LATIN[[i for i in range(0x80, 0xC0) if chr(i + 0x40).isalpha()]] = True


def folded(text: str) -> str:
    """The text in lower case where that is what the tokenizer itself makes of every character
    (it normalises to NFC, then lowers character by character), else the text as it is."""
    if text.isascii():
        return text.lower()
    if "\u03a3" in text or not unicodedata.is_normalized("NFC", text):
        return text
    low = text.lower()
    return low if unicodedata.is_normalized("NFC", low) else text


class WordIds:
    """Token ids of texts as little-endian uint32 bytes.

    The vocabulary's splitting pattern never crosses white space, so a text's ids are its words'
    ids in a row.  It also parts a letter or digit from marks after it, so a word that ends in
    ASCII marks is taken as two units.  Every distinct unit (by its 64-bit hash) is encoded once
    and remembered in flat arrays; a chunk's ids are gathered at once (tested against whole texts).

    special: the vocabulary's added tokens (such as ``<|endoftext|>``) keep their own ids, as the
    tokenizer does by itself; texts that hold one literally are encoded whole.
    """

    def __init__(self, path: str, special: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.literal = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # tokens that end a unit
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered of units."""
        self.keys = np.zeros(0, dtype=np.uint64)     # hashes, ascending
        self.first = np.zeros(0, dtype=np.int64)     # each unit's ids in the pool
        self.size = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(1 << 16, dtype="<u4")
        self.used = 0

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4")
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_letters(self, units: list[str]) -> list[np.ndarray]:
        """Units of letters alone: encoded in one text and parted at the tokens that end them."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(units)], add_special_tokens=False)[0].ids, dtype="<u4")
        end = np.flatnonzero(self.ends[ids]) + 1
        return np.split(ids, end[:-1]) if len(end) == len(units) else self._encode(units)

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        """Remember new units.  hashes: ascending."""
        ids: list = [None] * len(units)
        for letters, encode in ((True, self._encode_letters), (False, self._encode)):
            at = [i for i, u in enumerate(units) if u.isalpha() == letters]
            for i, x in zip(at, encode([units[i] for i in at]) if at else []):
                ids[i] = x
        size = np.array([len(x) for x in ids], dtype=np.int64)
        need = self.used + int(size.sum())
        if need > len(self.pool):
            grown = np.zeros(max(need, 2 * len(self.pool)), dtype="<u4")
            grown[:self.used] = self.pool[:self.used]
            self.pool = grown
        self.pool[self.used:need] = np.concatenate(ids)
        at = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, at, hashes)
        self.first = np.insert(self.first, at, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.used = need

    def _units(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text index) of the units, in order."""
        buf = w.buf
        plain = np.where(_MARK[buf], -1, np.arange(len(buf)))
        edges = np.column_stack([w.start, w.end]).reshape(-1)
        last = np.maximum.reduceat(plain, edges)[::2]            # last byte that is no mark, or -1
        core = np.where(last >= w.start, last + 1, w.end)
        byte, before = buf[core - 1], buf[np.maximum(core - 2, 0)]
        parted = (core < w.end) & (_ALNUM[byte] | ((before == 0xC3) & _LATIN[byte] & (core - 2 >= w.start)))
        core = np.where(parted, core, w.end)
        count = 1 + parted
        at = np.cumsum(count) - count
        start, end = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64)
        start[at], end[at] = w.start, core
        start[at[parted] + 1], end[at[parted] + 1] = core[parted], w.end[parted]
        return start, end, np.repeat(w.doc, count)

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        whole = [any(x in t for x in self.literal) for t in texts]
        for t, special, ids in zip(texts, whole, self._by_units(["" if x else t for t, x in zip(texts, whole)])):
            yield self._encode_whole(t) if special else ids

    def _encode_whole(self, text: str) -> bytes:
        """The tokenizer's own ids of a text, literal added tokens as such."""
        self.tokenizer.encode_special_tokens = False
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        self.tokenizer.encode_special_tokens = True
        return np.array(ids, dtype="<u4").tobytes()

    def _by_units(self, texts: list[str]) -> Iterator[bytes]:
        for _, some in chunks([folded(t).encode() for t in texts]):
            w = Words(some)
            if not len(w.start):
                yield from (b"" for _ in some)
                continue
            start, end, doc = self._units(w)
            h, index, inverse = np.unique(w.hashes_of(start, end), return_index=True, return_inverse=True)
            if len(self.keys) + len(h) > CACHE_UNITS:
                self.forget()
            at = np.searchsorted(self.keys, h)
            new = np.ones(len(h), dtype=bool)
            if len(self.keys):
                new = self.keys[np.minimum(at, len(self.keys) - 1)] != h
            if new.any():
                raw = w.buf.tobytes()
                self._learn(h[new], [raw[start[i]:end[i]].decode() for i in index[new]])
                at = np.searchsorted(self.keys, h)
            at = at[inverse.reshape(-1)]
            size = self.size[at]
            total = np.cumsum(size)
            ids = self.pool[np.repeat(self.first[at] - (total - size), size) + np.arange(total[-1])]
            of_text = np.bincount(doc, weights=size, minlength=len(some)).astype(np.int64)
            edge = np.concatenate(([0], np.cumsum(of_text)))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                yield ids[a:b].tobytes()


_encoders: dict[str, WordIds] = {}  # one per vocabulary in each worker


def encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path, special=True)
    return _encoders[path]


class SumOfSquares:
    """The level array and the open windows of one task."""

    def __init__(self, window: int, emit):
        self.window, self.emit = window, emit
        self.count = np.zeros(window + 1, dtype=np.int64)  # open windows by fill level
        self.open: dict[int, list[list]] = {}              # fill level -> open windows
        self.sequences = 0

    def _level(self, size: int) -> int:
        """The fill level (0: a new window) that adds least to the sum of squares; ties go to
        the fullest window."""
        top = self.window - size
        best, best_cost = 0, 2 * self.count[size] + 1 if size < self.window else 0
        if top < 1:
            return 0
        here, there = self.count[1:top + 1], self.count[1 + size:self.window + 1]
        cost = np.where(here > 0, 2 - 2 * here + 2 * there, np.iinfo(np.int64).max)
        cost[-1] -= 1  # a filled window no longer counts
        at = len(cost) - 1 - int(np.argmin(cost[::-1]))
        return at + 1 if cost[at] <= best_cost else best

    def place(self, piece: tuple) -> None:
        """piece: (doc_id, doc_tokens, start, ids bytes)."""
        size = len(piece[3]) // 4
        level = self._level(size)
        window = []
        if level:
            windows = self.open[level]
            window = windows.pop()
            self.count[level] -= 1
        window.append(piece)
        level += size
        if level == self.window:
            self.finish(window)
        else:
            self.open.setdefault(level, []).append(window)
            self.count[level] += 1

    def finish(self, window: list) -> None:
        offset = 0
        for doc_id, tokens, start, ids in window:
            n = len(ids) // 4
            self.emit(doc_id, start, n, ids, tokens, self.sequences, offset)
            offset += n
        self.sequences += 1

    def close(self) -> None:
        rest: list[tuple] = []
        for level in sorted(self.open):
            for window in self.open[level]:
                if level & (level - 1):
                    rest.extend(window)
                else:
                    self.finish(window)
        left = sum(len(p[3]) for p in rest) // 4
        window, room = [], _next_length(left, self.window)
        for doc_id, tokens, start, ids in rest:
            while ids:
                cut = ids[:4 * room]
                window.append((doc_id, tokens, start, cut))
                n = len(cut) // 4
                start, ids, room, left = start + n, ids[4 * room:], room - n, left - n
                if not room:
                    self.finish(window)
                    window, room = [], _next_length(left, self.window)
        self.open.clear()
        self.count[:] = 0


def _next_length(left: int, window: int) -> int:
    """Length of the next closing sequence: a whole window, then falling powers of two."""
    return window if left >= window else 1 << (max(left, 1).bit_length() - 1)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with their token ids; see the module's docstring."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, rows, held = encoder(tokenizer_path), [], [0]
        first = TaskContext.get().partitionId() << 36
        end = np.array([end_id], dtype="<u4").tobytes()

        def emit(doc_id, start, n, ids, tokens, sequence, offset):
            rows.append((doc_id, start, n, ids, tokens, first + sequence, offset))
            held[0] += n

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            rows.clear()
            held[0] = 0
            return pa.RecordBatch.from_arrays(arrays, names=names)

        packer = SumOfSquares(window, emit)
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), encode(texts_of(b.column(1)))):
                ids += end
                tokens = len(ids) // 4
                whole = tokens // window * window
                for start in range(0, whole, window):
                    packer.finish([(doc_id, tokens, start, ids[4 * start:4 * (start + window)])])
                    if held[0] >= FLUSH_IDS:
                        yield flush()
                if whole < tokens:
                    packer.place((doc_id, tokens, whole, ids[4 * whole:]))
                if held[0] >= FLUSH_IDS:
                    yield flush()
        packer.close()
        if rows:
            yield flush()
        encode.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(releasing(run), SCHEMA)


def with_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the ids' crc32 in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids."""
    return with_digest(pack(table(spark, sf_dir, "documents"), default_tokenizer()))
