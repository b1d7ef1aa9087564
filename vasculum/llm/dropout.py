"""Encoding with seeded merge-dropout, and decoding, for byte-pair models of SentencePiece files.

Merges are taken best first from the agenda of adjacent pairs, as in plain byte-pair encoding, but each candidate merge is skipped
if the keyed hash of its place falls below the dropout rate. The same seed gives the same segmentation on any cluster.

Every occurrence of a word has a key of its own. All words of a part are worked on at once, one merge a word and round; words longer than
LONG_CHARS, such as text in scripts without spaces, each have an agenda of their own.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vasculum.llm.storage import in_parts

PART_CHARS = 60_000
LONG_CHARS = 60
SPACE = "▁"
#: Stands for a SPACE that is in the text itself; a lone surrogate, which no text holds.
LITERAL = "\ud800"
UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _MIX
    return x ^ x >> np.uint64(29)


def _mixed_one(x: int) -> int:
    x = (x ^ x >> 31) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return x ^ x >> 29


def _place(start: int, middle: int, end: int) -> int:
    """Number that keys a candidate merge of the characters from start to middle with those from middle to end."""
    if end < 1 << 21:
        return start << 42 | middle << 21 | end
    return _mixed_one(_mixed_one(_mixed_one(start) ^ middle) ^ end)


class Model:
    """Pieces, merges and their order, read from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes, self.table, normal = {}, [b""] * size, {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[value], self.table[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                normal[piece], self.table[i] = i, piece.replace(SPACE, " ").encode()
        if len(self.bytes) < 256 or any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError("the model needs pieces for all bytes, and none that goes on behind a space")
        order = {p: k for k, p in enumerate(sorted((p for p in normal if len(p) > 1), key=lambda p: (model.get_score(normal[p]), -normal[p])))}
        self.chars = {ord(p): i for p, i in normal.items() if len(p) == 1}
        self.rank = np.zeros(size, np.int64)
        keys, merged = [], []
        self.merges: dict[int, tuple[int, int]] = {}  # the same as the table below, for words that are long
        for piece in order:
            self.rank[normal[piece]] = order[piece] + 1
            for cut in range(1, len(piece)):
                if piece[:cut] in normal and piece[cut:] in normal:
                    keys.append(normal[piece[:cut]] << 32 | normal[piece[cut:]])
                    merged.append(normal[piece])
                    self.merges[keys[-1]] = (order[piece] + 1, normal[piece])
        self.bits = max(10, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, -1, np.int64)
        for key, to in zip(keys, merged, strict=True):
            slot = self._slots(np.array([key], np.int64))[0]
            while self.keys[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.keys[slot], self.merged[slot] = key, to
        self.lookup = np.array([-1 - i for i in range(0x110000)], np.int64)  # code points without a piece are negative
        for c, i in self.chars.items():
            self.lookup[c] = i

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1."""
        keys = np.where((left >= 0) & (right >= 0), left << 32 | right, -2)
        slots = self._slots(keys)
        at = self.keys[slots]
        out = np.where(at == keys, self.merged[slots], -1)
        open_ = np.flatnonzero((at != keys) & (at >= 0))  # few: most are found, or not, at once
        slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
        while len(open_):
            at = self.keys[slots[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.merged[slots[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def symbols(self, word: str) -> list[int]:
        """Pieces of the single characters; code points without a piece are negative."""
        return [self.chars.get(c, -1 - c) for c in map(ord, word)]

    def spelled(self, symbols: list[int]) -> list[int]:
        """Ids of symbols, characters without a piece as the pieces of their bytes."""
        if min(symbols) >= 0:
            return symbols
        out: list[int] = []
        for s in symbols:
            if s >= 0:
                out.append(s)
            else:
                c = chr(-1 - s)
                out += [self.bytes[b] for b in (SPACE if c == LITERAL else c).encode("utf-8", "surrogatepass")]
        return out

    def segment_alone(self, word: str, seed: int, limit: int) -> list[int]:
        """Ids of one word, by an agenda of its own: a heap of candidates over a linked list of symbols."""
        symbols, n = self.symbols(word), len(word)
        before, after = list(range(-1, n - 1)), [*range(1, n), n]
        ends = list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(at: int) -> None:
            other = after[at]
            if at < 0 or other >= n or symbols[at] < 0 or symbols[other] < 0:
                return
            found = self.merges.get(symbols[at] << 32 | symbols[other])
            if found and (not limit or _mixed_one(_mixed_one(seed ^ _place(at, other, ends[other]))) >= limit):
                heapq.heappush(agenda, (-found[0], at, other, ends[other], found[1]))

        for at in range(n - 1):
            offer(at)
        gone = bytearray(n)
        while agenda:
            _, at, other, end, merged = heapq.heappop(agenda)
            if gone[at] or after[at] != other or gone[other] or ends[other] != end:
                continue  # one of both has been merged since
            symbols[at], ends[at], gone[other] = merged, end, 1
            after[at] = after[other]
            if after[at] < n:
                before[after[at]] = at
            if before[at] >= 0:
                offer(before[at])
            offer(at)
        return self.spelled([s for s, g in zip(symbols, gone, strict=True) if not g])

    def segment(self, words: list[str], seeds: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and their number for each; seeds: a 64-bit number a word, which keys its skipped merges."""
        limit = min(int(rate * 2**64), 2**64 - 1)
        sizes = np.array([len(w) for w in words], np.int64)
        long_ = np.flatnonzero(sizes > LONG_CHARS)
        if not len(long_):
            return self._segment_short(words, seeds, rate)
        flat, counts = self._segment_short([w if len(w) <= LONG_CHARS else "" for w in words], seeds, rate)
        firsts = np.cumsum(counts) - counts
        alone = [np.array(self.segment_alone(words[k], int(seeds[k]), limit), np.int64) for k in long_.tolist()]
        return np.insert(flat, np.repeat(firsts[long_], [len(x) for x in alone]), np.concatenate(alone)), self._with(counts, long_, alone)

    @staticmethod
    def _with(counts: np.ndarray, places: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
        counts = counts.copy()
        counts[places] = [len(x) for x in parts]
        return counts

    def _segment_short(self, words: list[str], seeds: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        limit = np.uint64(min(int(rate * 2**64), 2**64 - 1))
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.lookup[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        word = np.repeat(np.arange(len(words)), sizes)
        start = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def candidates(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Merged piece, and priority (0: none), of the pairs that begin at the positions."""
            to, priority = np.full(len(at), -1, np.int64), np.zeros(len(at), np.int64)
            last = len(symbols) - 1
            inner = np.flatnonzero((at < last) & (word[at] == word[np.minimum(at + 1, last)]))
            x = at[inner]
            found = self.pair(symbols[x], symbols[x + 1])
            some = np.flatnonzero(found >= 0)
            inner, x, found = inner[some], x[some], found[some]
            if rate > 0:
                own, after = word[x], np.minimum(x + 2, last)
                end = np.where((x + 2 <= last) & (word[after] == own), start[after], sizes[own])
                place = (start[x] << 42 | start[x + 1] << 21 | end).astype(np.uint64)
                some = np.flatnonzero(_mixed(_mixed(seeds[own] ^ place)) >= limit)
                inner, x, found = inner[some], x[some], found[some]
            to[inner] = found
            priority[inner] = self.rank[found] << 24 | (1 << 24) - 1 - np.minimum(start[x], (1 << 24) - 1)
            return to, priority

        to, priority = candidates(np.arange(len(symbols)))
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.maximum.reduceat(priority, heads)
            counts = np.diff(np.append(heads, len(symbols)))
            if (best == 0).any():  # words without candidates are done
                going = np.repeat(best > 0, counts)
                gone, going = np.flatnonzero(~going), np.flatnonzero(going)
                done.append((word[gone], symbols[gone]))
                symbols, word, start, to, priority = (x[going] for x in (symbols, word, start, to, priority))
                best, counts = best[best > 0], counts[best > 0]
                if not len(symbols):
                    break
            here = np.flatnonzero(priority == np.repeat(best, counts))
            symbols[here] = to[here]
            stay = np.ones(len(symbols), bool)
            stay[here + 1] = False
            stay = np.flatnonzero(stay)
            moved = here - np.arange(len(here))  # each merge before has taken one symbol away
            symbols, word, start, to, priority = (x[stay] for x in (symbols, word, start, to, priority))
            at = np.concatenate([moved, moved[moved > 0] - 1])
            to[at], priority[at] = candidates(at)
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        return self._with_bytes(np.concatenate([w for w, _ in done]), np.concatenate([x for _, x in done]), len(words))

    def encode(self, texts: list[str], keys: np.ndarray, rate: float) -> list[np.ndarray]:
        """Ids of each whole text; keys: a 64-bit number for each text. An empty text has none."""
        words = [UNITS.findall(SPACE + t.replace(SPACE, LITERAL).replace(" ", SPACE)) if t else [] for t in texts]
        number = np.array([len(x) for x in words], np.int64)
        if not number.sum():
            return [np.zeros(0, np.int32) for _ in texts]
        place = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        seeds = _mixed(np.repeat(keys, number) ^ place.astype(np.uint64) * _MIX)
        flat, counts = self.segment([w for x in words for w in x], seeds, rate)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(number)])]
        ids = flat.astype(np.int32)
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _with_bytes(self, word: np.ndarray, symbols: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols in the order of their words, characters without a piece as the pieces of their bytes."""
        order = np.argsort(word, kind="stable")
        word, symbols = word[order], symbols[order]
        sizes = np.ones(len(symbols), np.int64)
        spelled = {}
        for s in set(symbols[symbols < 0].tolist()):
            c = chr(-1 - s)
            spelled[s] = [self.bytes[b] for b in (SPACE if c == LITERAL else c).encode("utf-8", "surrogatepass")]
            sizes[symbols == s] = len(spelled[s])
        ends = np.cumsum(sizes)
        flat = np.repeat(symbols, sizes)
        for s, ids in spelled.items():
            at = ends[symbols == s]
            for k, i in enumerate(ids):
                flat[at - len(ids) + k] = i
        return flat, np.bincount(word, sizes, words).astype(np.int64)

    def decode(self, ids: list[int]) -> str:
        """The text that was encoded, whatever merges were skipped."""
        return b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")[1:]


@cache
def _model(path: str) -> Model:
    return Model(path)


def encode(docs: DataFrame, model: str, rate: float = 0.1, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids), one for each document; ids: array<int> of the whole text.

    A null text counts as empty and has no ids. Equal texts of different documents are segmented differently if `rate` > 0, those of one id
    alike; a null id is keyed as -1. With rate 0 this is plain byte-pair encoding. Other columns are ignored; no rows give no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _model(model)
        base = _mixed(np.array([seed], np.int64).astype(np.uint64))[0]
        for batch in batches:
            for rows in in_parts(batch, 1, PART_CHARS):
                ids = np.array([-1 if x is None else x for x in rows.column(0).to_pylist()], np.int64).astype(np.uint64)
                encoded = found.encode(rows.column(1).to_pylist(), _mixed(_mixed(ids) ^ base), rate)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(encoded, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return source.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """The rows with `text`, decoded; null ids give a null text, no ids an empty one. A column text that is there already is replaced."""
    encoded = encoded.drop("text")
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _model(model)
        for batch in batches:
            for part in range(0, batch.num_rows, 1_000):
                rows = batch.slice(part, 1_000)
                texts = [None if x is None else found.decode(x) for x in rows.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*rows.schema.names, "text"])

    return encoded.mapInArrow(run, encoded.withColumn("text", F.lit(None).cast("string")).schema)
