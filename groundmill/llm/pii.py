"""Personal information in free text: a character-level bidirectional LSTM with CRF transitions.

The model (weights in pii_weights.npz, trained by pii_training.py in numpy from labelled spans) scores every
character in overlapping windows. Scores of characters that lie in two windows are blended by their distance
from the windows' edges, and one Viterbi pass decodes each whole text, so an item across windows stays whole.
Spans come from begin and inside tags of the decode; only their edges are trimmed, to whole words and without the
blanks and marks around them.

Defined cases: null and empty texts have no items; texts of any length are read whole; equal texts of a batch
are read once; repeated rows are kept as they come.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "phone", "id_number", "address", "name")
#: Outside, the first character of an item of each kind, the others of it.
TAGS = ["O", *(f"B-{k}" for k in KINDS), *(f"I-{k}" for k in KINDS)]


def begin(kind: int) -> int:
    return 1 + kind


def inside(kind: int) -> int:
    return 1 + len(KINDS) + kind


#: An item opens after none or after one of its own kind and goes on only in its own kind.
ALLOWED = np.zeros((len(TAGS), len(TAGS)), bool)
ALLOWED[:, 0] = True
for _k in range(len(KINDS)):
    ALLOWED[0, begin(_k)] = ALLOWED[inside(_k), begin(_k)] = True
    ALLOWED[begin(_k), inside(_k)] = ALLOWED[inside(_k), inside(_k)] = True
STARTS = np.array([not t.startswith("I-") for t in TAGS])
WINDOW, OVERLAP = 256, 48
BATCH_WINDOWS = 512
WEIGHTS = os.path.join(os.path.dirname(__file__), "pii_weights.npz")
PAD, SYMBOLS = 0, 136


def _classes() -> np.ndarray:
    """Class of a code point: ASCII for itself, others by kind."""
    table = np.full(0x10000, 133, np.uint8)
    table[:128] = np.arange(128)
    for i in range(128, 0x3000):
        c = chr(i)
        table[i] = 129 if c.isspace() else 130 if c.isupper() else 131 if c.isalpha() else 132 if c.isdigit() else 133
    table[0] = 134
    return table


_CLASS = _classes()


def char_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(points, 0xFFFF)]


class Tagger:
    """Parameters: table (2, SYMBOLS, 4H), recur (2, H, 4H), out (2H, K), bias (K), trans (K, K), start (K).

    Gates are clip(z / 4 + 1 / 2, 0, 1), the rest is z / (1 + |z|): cheap in numpy, and all in place."""

    def __init__(self, weights: dict[str, np.ndarray]):
        w = {k: np.asarray(v, np.float32) for k, v in weights.items()}
        self.h = h = w["recur"].shape[1]
        scale, shift = np.ones(4 * h, np.float32), np.zeros(4 * h, np.float32)
        scale[: 3 * h], shift[: 3 * h] = 0.25, 0.5
        self.table, self.recur = w["table"] * scale + shift, w["recur"] * scale
        self.out, self.bias, self.trans, self.start = w["out"], w["bias"], w["trans"], w["start"]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """(T, B, K) scores of windows x (T, B), padded at the end by PAD."""
        t_len, b = x.shape
        h = self.h
        index = x.astype(np.intp)
        ragged = (x == PAD).any(1)
        live = (x != PAD).astype(np.float32)[:, :, None]
        total = np.empty((t_len, b, len(self.bias)), np.float32)
        total[:] = self.bias
        z, y = np.empty((b, 4 * h), np.float32), np.empty((b, 4 * h), np.float32)
        hid, cell, new, size = (np.empty((b, h), np.float32) for _ in range(4))
        gates, i, f, o, g = z[:, : 3 * h], z[:, :h], z[:, h : 2 * h], z[:, 2 * h : 3 * h], z[:, 3 * h :]
        out_t = np.empty((b, len(self.bias)), np.float32)
        for d in (0, 1):
            table, recur, out = self.table[d], self.recur[d], self.out[d * h : (d + 1) * h]
            hid[:], cell[:] = 0, 0
            for t in range(t_len) if d == 0 else range(t_len - 1, -1, -1):
                np.take(table, index[t], axis=0, out=z, mode="clip")
                np.matmul(hid, recur, out=y)
                z += y
                np.clip(gates, 0, 1, out=gates)
                np.abs(g, out=size)
                size += 1
                np.divide(g, size, out=new)
                new *= i
                cell *= f
                cell += new
                np.abs(cell, out=size)
                size += 1
                np.divide(cell, size, out=hid)
                hid *= o
                if d and ragged[t]:
                    cell *= live[t]
                    hid *= live[t]
                np.matmul(hid, out, out=out_t)
                total[t] += out_t
        return total

    def viterbi(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(T, B) best tags of scores (T, K, B); texts sorted by falling length. Only allowed transitions are looked at:
        any tag to none, none or an item's end to its kind's begin, begin and inside to inside."""
        t_len, k, b = scores.shape
        n_kinds = (k - 1) // 2
        beg, ins = slice(1, 1 + n_kinds), slice(1 + n_kinds, k)
        at = np.arange(n_kinds)
        out_w = self.trans[:, 0][:, None]
        open_w, again_w = self.trans[0, beg][:, None], self.trans[1 + n_kinds + at, 1 + at][:, None]
        on_w, stay_w = self.trans[1 + at, 1 + n_kinds + at][:, None], self.trans[1 + n_kinds + at, 1 + n_kinds + at][:, None]
        back = np.zeros((t_len, k, b), np.int8)
        best = np.where(STARTS, self.start, -1e4).astype(np.float32)[:, None] + scores[0]
        live = np.searchsorted(-lengths, -np.arange(t_len), side="left")  # texts longer than t
        opened, inner = (1 + n_kinds + at).astype(np.int8)[:, None], (1 + at).astype(np.int8)[:, None]
        for t in range(1, t_len):
            n = live[t]
            now, was = best[:, :n], back[t, :, :n]
            leave = now + out_w
            from_ = leave.argmax(0)
            first, again = now[0] + open_w, now[ins] + again_w
            on, stay = now[beg] + on_w, now[ins] + stay_w
            was[0], was[beg], was[ins] = from_, np.where(again > first, opened, 0), np.where(stay > on, opened, inner)
            new = scores[t, :, :n].copy()
            new[0] += np.take_along_axis(leave, from_[None], 0)[0]
            new[beg] += np.maximum(first, again)
            new[ins] += np.maximum(on, stay)
            best[:, :n] = new
        tags = np.zeros((t_len, b), np.int8)
        last, rows = best.argmax(0), np.arange(b)
        for t in range(t_len - 1, -1, -1):
            n = live[t]
            tags[t, :n] = last[:n]
            if t:
                last[:n] = back[t, last[:n], rows[:n]]
        return tags

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """Tags of every character of every text."""
        classes = [char_classes(t) for t in texts]
        windows = [(i, s) for i, c in enumerate(classes) for s in range(0, max(1, len(c) - OVERLAP), WINDOW - OVERLAP)]
        windows.sort(key=lambda w: -min(WINDOW, len(classes[w[0]]) - w[1]))
        total = [np.zeros((len(c) if len(c) > WINDOW else 0, len(TAGS)), np.float32) for c in classes]
        ramp = np.minimum(np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)), OVERLAP).astype(np.float32)
        mass: list[np.ndarray | None] = [np.zeros(len(c), np.float32) for c in classes]
        for at in range(0, len(windows), BATCH_WINDOWS):
            part = windows[at : at + BATCH_WINDOWS]
            pieces = [classes[i][s : s + WINDOW] for i, s in part]
            x = np.zeros((max(map(len, pieces)), len(part)), np.uint8)
            for j, p in enumerate(pieces):
                x[: len(p), j] = p
            scored = np.ascontiguousarray(self.scores(x).transpose(1, 0, 2))
            for j, ((i, s), p) in enumerate(zip(part, pieces, strict=True)):
                n = len(p)
                if len(classes[i]) <= WINDOW:
                    total[i], mass[i] = scored[j, :n], None
                else:
                    total[i][s : s + n] += scored[j, :n] * ramp[:n, None]
                    mass[i][s : s + n] += ramp[:n]
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(texts)
        order = sorted((i for i in range(len(texts)) if len(classes[i])), key=lambda i: -len(classes[i]))
        at = 0
        while at < len(order):
            longest = len(classes[order[at]])
            group = order[at : at + max(1, min(1024, 800_000 // longest))]
            lengths = np.array([len(classes[i]) for i in group])
            s = np.zeros((len(group), longest, len(TAGS)), np.float32)
            for j, i in enumerate(group):
                s[j, : lengths[j]] = total[i] if mass[i] is None else total[i] / mass[i][:, None]
            tags = self.viterbi(np.ascontiguousarray(s.transpose(1, 2, 0)), lengths)
            for j, i in enumerate(group):
                out[i] = tags[: lengths[j], j]
            at += len(group)
        return out


def spans_of(tags: np.ndarray) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the items of a decoded text: each opens with its begin tag."""
    if not tags.any():
        return []
    n = len(KINDS)
    kind = np.where(tags == 0, -1, (tags - 1) % n)
    cut = (np.flatnonzero((kind[1:] != kind[:-1]) | ((tags[1:] > 0) & (tags[1:] <= n))) + 1).tolist()
    starts = [0, *cut]
    return [(KINDS[k], a, b) for k, a, b in zip(kind[starts].tolist(), starts, [*cut, len(tags)], strict=True) if k >= 0]


def trimmed(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans at whole words: a word cut by an edge belongs to the span if the greater part of it lies inside; blanks and marks
    around are cut off, but for the bracket or plus of a phone and the dot of an initial. No span is added."""
    out: list[tuple[str, int, int]] = []
    for kind, s, e in spans:
        a, b = s, e
        while 0 < a < len(text) and text[a].isalnum() and text[a - 1].isalnum():
            a -= 1
        if a < s:
            end = s
            while end < e and text[end].isalnum():
                end += 1
            s = a if end - s >= s - a else end
        while 0 < b < len(text) and text[b].isalnum() and text[b - 1].isalnum():
            b += 1
        if b > e:
            first = e
            while first > s and text[first - 1].isalnum():
                first -= 1
            e = b if e - first >= b - e else first
        while s < e and not (text[s].isalnum() or kind == "phone" and text[s] in "+("):
            s += 1
        while e > s and not (text[e - 1].isalnum() or kind == "name" and text[e - 1] == "." and text[e - 2 : e - 1] != "." and (e - s < 4 or not all(map(str.isalnum, text[e - 4 : e - 1])))):
            e -= 1
        if e - s > 1 and (not out or s >= out[-1][2]):
            out.append((kind, s, e))
    return out


_loaded: dict[str, Tagger] = {}


def tagger(path: str = WEIGHTS) -> Tagger:
    if path not in _loaded:
        with np.load(path) as z:
            _loaded[path] = Tagger(dict(z))
    return _loaded[path]


def find_items(texts: list[str | None], path: str = WEIGHTS, exact: bool = True) -> list[list[tuple[str, int, int]]]:
    """Items of each text; equal texts are read once. Without ``exact`` the spans are as decoded."""
    own = list(dict.fromkeys(t for t in texts if t and not t.isspace()))
    found = {}
    model = tagger(path)
    at = 0
    while at < len(own):
        n, size = 0, 0
        while at + n < len(own) and (n == 0 or size + len(own[at + n]) < 300_000):
            size += len(own[at + n])
            n += 1
        part = own[at : at + n]
        for t, tags in zip(part, model.tag(part), strict=True):
            found[t] = trimmed(t, spans_of(tags)) if exact else spans_of(tags)
        at += n
    return [found.get(t, []) for t in texts]


ITEMS = "array<struct<pii_type:string,char_start:int,char_end:int>>"


def personal_items(rows: DataFrame, text: str, items: str = "items", path: str = WEIGHTS) -> DataFrame:
    """``rows`` with the items of ``text`` as an array, in order of place; one pass over the scan."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            yield pd.Series([[{"pii_type": k, "char_start": a, "char_end": b} for k, a, b in sorted(x, key=lambda y: y[1])] for x in find_items(s.tolist(), path)], dtype=object)

    return rows.withColumn(items, F.pandas_udf(run, ITEMS).asNondeterministic()(F.col(text)))


def redact(rows: DataFrame, text: str, items: str = "items", into: str = "redacted") -> DataFrame:
    """``rows`` with every item of ``text`` replaced by its kind in brackets; JVM-side."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    step = lambda acc, x: F.struct(F.concat(acc["done"], F.substring(F.col(text), acc["at"] + 1, x["char_start"] - acc["at"]), F.lit("["), F.upper(x["pii_type"]), F.lit("]")).alias("done"), x["char_end"].alias("at"))
    end = lambda acc: F.concat(acc["done"], F.substring(F.col(text), acc["at"] + 1, F.length(text)))
    return rows.withColumn(into, F.when(F.col(text).isNotNull(), F.aggregate(items, start, step, end)))
