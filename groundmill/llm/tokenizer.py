"""Encoding with a public byte-level BPE vocabulary.

Pre-tokenisation uses no regular expression: code points become classes by a table, classes become
symbols by looking one or two characters ahead, and a finite automaton over the symbols tells where a
piece begins. Its transition functions compose associatively, so a batch is scanned in columns: the
composed function of each row of 64 symbols, a doubling scan over the rows, and a replay inside the rows.
Pieces are merged pair by pair once and kept in a cache; their offsets stay for decoding.

Defined cases: null and empty texts give no ids; text that looks like a special token is ordinary text;
a text of any length is encoded whole (long pieces merge through a heap).
"""

from __future__ import annotations

import base64
import heapq
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public vocabularies; a parameter everywhere.
VOCABULARY = os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
#: Pieces a worker keeps; the cache starts anew beyond that, results are the same.
CACHE_PIECES = 300_000
#: Characters scanned at once, to bound a worker's memory.
BATCH_CHARS = 1_000_000

L, N, O, APOS, SP, WS, END = range(7)  # noqa: E741
S_L, S_N, S_O, S_A1, S_A2, S_SPL, S_WL, S_WI, S_END = range(9)
Q_NEW, Q_L, Q_N, Q_O, Q_W, Q_PRE, Q_C1, Q_C2 = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, piece begins before) by symbol and state."""
    to, cut = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for sym, state in ((S_L, Q_L), (S_N, Q_N), (S_O, Q_O)):
        to[sym] = state
        cut[sym, [state, Q_PRE]] = False
    to[S_L, [Q_C1, Q_C2]], cut[S_L, [Q_C1, Q_C2]] = [Q_NEW, Q_C1], False
    for sym, state in ((S_A1, Q_C1), (S_A2, Q_C2)):
        to[sym], to[sym, [Q_O, Q_PRE]] = state, Q_O
        cut[sym, [Q_O, Q_PRE]] = False
    to[S_SPL], to[S_WL], to[S_WI], to[S_END] = Q_PRE, Q_NEW, Q_W, Q_NEW
    cut[S_WI, Q_W] = False
    return to, cut


TO, CUT = _automaton()
_tables: dict[str, np.ndarray] = {}


def class_table() -> np.ndarray:
    """Class of every code point: letters, numbers, white space, the rest."""
    if "class" not in _tables:
        of = {"L": L, "N": N}
        table = np.fromiter((of.get(unicodedata.category(chr(i))[0], O) for i in range(0x110000)), np.uint8, 0x110000)
        # the White_Space property of Unicode
        table[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WS
        table[0x20], table[0x27] = SP, APOS
        _tables["class"] = table
    return _tables["class"]


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of concatenated texts; ``ends`` are the places of the sentinels, one after each text."""
    cls = class_table()[points]
    cls[ends] = END
    nxt = np.append(cls[1:], END)
    p1, p2 = np.append(points[1:], 0), np.append(points[2:], [0, 0])[: len(points)]
    after_is_text = nxt != END
    sym = np.array([S_L, S_N, S_O, S_O, S_WI, S_WI, S_END], np.uint8)[cls]
    last = (cls >= SP) & (cls <= WS) & ~((nxt >= SP) & (nxt <= WS)) & after_is_text
    sym[last] = np.where(cls[last] == SP, S_SPL, S_WL)
    apos = (cls == APOS) & after_is_text
    sym[apos & np.isin(p1, [ord(c) for c in "stmd"])] = S_A1
    two = ((p1 == ord("r")) | (p1 == ord("v"))) & (p2 == ord("e")) | (p1 == ord("l")) & (p2 == ord("l"))
    two &= np.append(nxt[1:], END) != END
    sym[apos & two] = S_A2
    return sym


def boundaries(sym: np.ndarray, width: int = 64) -> np.ndarray:
    """True where a piece begins, by an associative scan of transition functions."""
    n = len(sym)
    rows = -(-n // width)
    grid = np.full(rows * width, S_END, np.uint8)
    grid[:n] = sym
    grid = grid.reshape(rows, width)
    f = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for j in range(width):
        f = TO[grid[:, j, None], f]
    shift = 1  # f[i] becomes the composition of rows 0 to i
    while shift < rows:
        f[shift:] = np.take_along_axis(f[shift:], f[:-shift].copy(), axis=1)
        shift *= 2
    state = np.append(np.uint8(Q_NEW), f[:-1, Q_NEW])
    cut = np.empty((rows, width), bool)
    for j in range(width):
        cut[:, j] = CUT[grid[:, j], state]
        state = TO[grid[:, j], state]
    return cut.reshape(-1)[:n] & (sym != S_END)


class Encoder:
    def __init__(self, path: str = VOCABULARY):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Merges the lowest-ranked pair, leftmost first, until none is left."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        right, left = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, piece[i : i + 2]) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            if part[i] is None or (j := right[i]) < 0 or part[i] + part[j] != both:
                continue
            part[i], part[j], right[i] = both, None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
                if (r := ranks.get(x := both + part[right[j]])) is not None:
                    heapq.heappush(heap, (r, i, x))
            if (k := left[i]) >= 0 and (r := ranks.get(x := part[k] + both)) is not None:
                heapq.heappush(heap, (r, k, x))
        return tuple(ranks[p] for p in part if p is not None)

    def pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(pieces, code point offset of each in its text, first piece of each text and the total)."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 1) - 1
        whole = "\n".join(texts) + "\n"
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = symbols(points, ends)
        cut = boundaries(sym)
        starts = np.flatnonzero(cut)
        stops = np.flatnonzero(np.append(cut[1:], False) | np.append(sym[1:] == S_END, True))
        stops = stops[sym[stops] != S_END] + 1
        firsts = np.searchsorted(starts, np.append(0, ends + 1))
        offsets = starts - np.repeat(np.append(0, ends[:-1] + 1), np.diff(firsts))
        return [whole[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], offsets, firsts

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        out: list[list[int]] = []
        chunk: list[str] = []
        size = 0
        for t in texts:
            chunk.append(t or "")
            size += len(chunk[-1])
            if size >= BATCH_CHARS:
                out += self._encode(chunk)
                chunk, size = [], 0
        return out + self._encode(chunk) if chunk else out

    def _encode(self, texts: list[str]) -> list[list[int]]:
        pieces, _, firsts = self.pieces(texts)
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        cache = self.cache
        for p in set(pieces):
            if p not in cache:
                cache[p] = self.merge(p.encode())
        return [[i for p in pieces[a:b] for i in cache[p]] for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]

    def decode(self, ids: list[int]) -> str:
        if not hasattr(self, "bytes_of"):
            self.bytes_of = {v: k for k, v in self.ranks.items()}
        return b"".join(self.bytes_of[i] for i in ids).decode()


_encoders: dict[str, Encoder] = {}


def encoder(path: str = VOCABULARY) -> Encoder:
    """One encoder for each vocabulary and worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_ids(docs: DataFrame, text: str = "text", ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """``docs`` with the column ``ids`` (ARRAY<INT>). No shuffle: one pass over the scan."""

    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for s in texts:
            yield pd.Series([np.asarray(x, np.int32) for x in e.encode(s.tolist())], dtype=object)

    return docs.withColumn(ids, F.pandas_udf(encode, "array<int>")(F.col(text)))


def token_counts(docs: DataFrame, text: str = "text", count: str = "n_tokens", path: str = VOCABULARY) -> DataFrame:
    """``docs`` with the number of tokens of ``text``; only the numbers leave the workers."""

    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for s in texts:
            yield pd.Series([len(x) for x in e.encode(s.tolist())], dtype="int64")

    return docs.withColumn(count, F.pandas_udf(measure, "bigint")(F.col(text)))
