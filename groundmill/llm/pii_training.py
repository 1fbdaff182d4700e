"""Trains the tagger of pii.py: python -m groundmill.llm.pii_training SF_DIR [OUT [FROM]]; it goes on from the weights
FROM if given, in half the steps; with "--score" it only measures.

Labels are made by hand: FRAMES are sentences as a reader marked them up, an item's place named by its kind. Where a
fragment of the bounded sample (SAMPLE rows, a parameter) has such a sentence, its slots are labelled spans; what the reader
called a label, a title, a degree or a town stays outside. No pattern of an item's inner form takes part in this. Items
are then replaced by others of their kind and altered at random, so the model learns shapes and contexts rather than
the sample's items. Fragments beyond the sample are held out for the score. Everything is numpy.
"""

from __future__ import annotations

import random
import re
import sys
import zlib
from collections import Counter
from multiprocessing import Pool

import numpy as np

from groundmill.llm import pii

SAMPLE = 6000
HIDDEN = 24
STEPS = 1100
WORKERS, BATCH = 8, 32
#: Sentences marked up by hand. n name, e email, p phone, i identity number, a address; o organisation, d date, m amount and
#: c code, reference or number hold nothing personal.
FRAMES = """
Email from {e} received on {d}: attachment could not be opened.
Fax header shows {p} as the sending machine and {d} as the day of receipt.
Spouse {n} may be reached under {p} or {e} after five in the evening.
Mailing address on record is {a}; the previous one is no longer valid.
Appeal rights were explained and the caller, {n}, repeated them correctly.
Home visit at {a} found the claimant walking without a cane.
Please send all further requests to {e} and copy {n}.
Contact sheet: {n} / {p} / {a}.
{n}{s} statement of {d} contradicts the intake form.
Attending physician {n} limits lifting to ten pounds and standing to one hour.
Per {n}, the waiting period ended on {d} and payments of {m} were due.
{n} reversed the earlier approval on {d} after a second reading of the file.
Mme {n} joint son relevé et demande une réponse avant le {d}.
Voicemail for {n} at {p}; no answer, second attempt planned.
The insured, {n}, moved to {a} in the spring and gave {e} for correspondence.
Benefits were placed back under the shorter limitation as of {d} at the request of {n}.
On {d} {n} called to ask why the benefit had stopped and left {p} as a call-back number.
La señora {n} confirma el domicilio {a} y el correo {e}.
Deposition of {n} was moved to {d} at the request of both sides.
Herr {n} bittet um Rückruf unter {p}; Unterlagen an {a}.
{n} told {n} that the decision would stand unless new records arrived by {d}.
{n} disputes the surveillance summary and asks that {o} correct it.
{n} of {o} states that the claimant cannot sit for more than twenty minutes.
Claim notes by {n} were exported to reviewer {n} at {o}.
Peer review by {n} finds the limitation consistent with code {c}.
cc: {e}; {e}
Identity was verified on the call against {i}.
Case manager {n} (direct line {p}) requested records for {i}.
The authorization was signed by {n}, {i}, and returned by fax under {c}.
Form {c} was received blank on page two and was sent back to {a}.
The file contains no objective findings after {d}.
Wage statement shows {m} for the quarter and an offset of {m}.
The supervisor's comment was removed from version {c} of the note on {d}.
The second page repeats the first and carries no signature.
The vocational report of {o} lists three sedentary occupations at {m} a year.
Neuropsychological testing at {o} was completed over two days with adequate effort.
Reviewer wrote: see attached, nothing further needed from {o}.
Nothing in the chart of {o} addresses cognition.
Portal upload failed at step {c} of {c}, see log line {c}.
Employer confirms hire date {d}, base pay {m}, and job code {c}.
Check no. {c} for {m} was voided because the payee line was wrong.
Note to file: provision {c} was applied twice and the overpayment of {m} remains open.
Queue moved the task to second review; ticket {c} stays open.
The limitation period under section {c} runs for twenty-four months from {d}.
{o} forwarded the imaging report under reference {c} without a cover letter.
CLAIM NOTES
CONFIDENTIAL / do not re-file
-- page break --
☎ call log ✆
"""
# Around an item, never part of it: titles and roles, degrees, names of identity numbers.
LEAD = re.compile(
    r"(?:(?:dr|mr|mrs|ms|miss|prof|professor|herr|frau|mme|mlle|atty|attorney|nurse|examiner|reviewer|case manager|manager|adjuster|supervisor|appeals specialist|specialist|physician|counsel|claims rep|representative|judge|director|analyst|doctor"
    r"|investigator|consultant|nurse reviewer|vocational consultant)\b\.?\s+)+", re.I
)
TRAIL = re.compile(r"(?:[\s,]+(?:RN|M\.?D|Ph\.?D|Esq|D\.?O|DDS|J\.?D|MBA|CPA|LPN|MSW|PsyD|LCSW|NP|PA)\b\.?|\s*\([^)]*\)|['’]s|\s+)+$", re.I)
ID_LABEL = re.compile(
    r"(?:social security (?:number|no\.?)|ssn|ss|soc\.? sec\.?|tax ?(?:payer)? id|steuer-id|n\.i\. no\.?|nino|ni number|national insurance|passport(?: no\.?| number)?|driver'?s? licen[cs]e|driving licen[cs]e|dl)(?: \(\w+\))?[ #:]*\s*", re.I
)
POSTAL = re.compile(r".*(?:\b\d{5}(?:-\d{4})?|\b[A-Z]{1,2}\d{1,2}[A-Z]? \d[A-Z]{2})\b", re.S)
_SLOT = re.compile(r"\{(\w)\}")
_KIND = {"n": "name", "e": "email", "p": "phone", "i": "id_number", "a": "address", "o": "org", "c": "code"}


def frame_patterns() -> list[tuple[re.Pattern, str]]:
    """Each frame as a pattern with its slots as groups; any run of blanks stands for a blank. A slot does not run over the
    end of a sentence, a frame that opens with a slot opens a sentence, and one that ends with it ends there."""
    inner = r"(?:(?!(?<=[a-z0-9)]{4}[.!?])\s)[^;\n\t])"
    first = r"(?:\A|(?<=[\n\t])|(?<=[.!?]\s)|(?<=\s\s))"
    ends = {"a": r"(?:\d{4}|\d[A-Z]{2}|\d{5} [A-Z]\w+)", "i": r"\d(?: ?[A-Z])?", "n": r"\s[\w'’-]*(?:\w{3}|[JjSs][Rr]\.?)"}
    out = []
    for frame in FRAMES.strip().split("\n"):
        bits, n = [first] if frame[0] == "{" else [], 0
        for bit in re.split(r"(\{\w\})", frame):
            if not _SLOT.fullmatch(bit):
                bits.append(r"\s+".join(map(re.escape, bit.split(" "))))
                continue
            k = bit[1]
            end = ends.get(k, "") if frame.endswith(f"{bit}.") else ""
            bits.append(r"(?:\s?['’]s)" if k == "s" else rf"(?P<{k}{n}>" + (r"[^;]{5,120}?" if k == "a" else inner + "{1,60}?") + end + ")")
            n += 1
        last = r"(?=\s*(?:\Z|\n)|\s+[A-ZÀ-Þ])" if frame[-1] == "}" else r"(?=\s|\Z)" if frame.endswith("}.") else ""
        out.append((re.compile("".join(bits) + last), frame))
    return out


def item_of(kind: str, text: str) -> tuple[int, int] | None:
    """Where in the text of a slot the item is; None where the slot holds no such item."""
    s, e = len(text) - len(text.lstrip()), len(text.rstrip())
    if kind == "name":
        s = m.end() if (m := LEAD.match(text, s)) else s
        e = m.start() if (m := TRAIL.search(text, s, e)) else e
        words = re.findall(r"[^\W\d_]{3,}", text[s:e])
        if not words or not re.search(r"[\s,]", text[s:e]) and text[s:e].istitle() and len(text[s:e]) < 6 or len(words) > 5 or re.search(r"\d{2}|@|[:!?]| (?:The|Nothing|Check|Note|Form|Queue|Portal|Wage|Home|Claim|Peer|Per|On|told|of)\b|\b(?:provider|claimant|insured)\b", text[s:e]):
            return None
    elif kind == "id_number":
        s = m.end() if (m := ID_LABEL.match(text, s)) else s
        if sum(c.isdigit() for c in text[s:e]) < 6 or re.search(r"[a-z]{2}|,", text[s:e]):
            return None
    elif kind == "address":
        m = POSTAL.match(text, s, e)
        if not m or not text[s].isalnum():
            return None
        e = m.end()
    elif kind == "phone" and sum(c.isdigit() for c in text) < 9 or kind == "email" and not re.search(r"@|\bat\b", text):
        return None
    return (s, e) if e > s else None


def marked(text: str, frames: list[tuple[re.Pattern, str]]) -> list[tuple[int, int, list[tuple[str, int, int]]]]:
    """(start, end, labelled spans) of each framed sentence of a text; sentences whose slots can't be read are left out."""
    out = []
    for pattern, frame in frames:
        # the longest piece without a slot stands in the text, else no use in the pattern
        probe = max(_SLOT.split(frame)[::2], key=len).split(" ")[1:-1]
        if probe and max(probe, key=len) not in text:
            continue
        for m in pattern.finditer(text):
            spans, good = [], True
            for group, value in m.groupdict().items():
                kind = _KIND.get(group[0])
                if kind in pii.KINDS:
                    got = item_of(kind, value)
                    good &= got is not None
                    if got:
                        spans.append((kind, m.start(group) + got[0], m.start(group) + got[1]))
                elif kind:
                    spans.append((kind, *m.span(group)))
            if good and (m.start() == 0 or not text[m.start() - 1].isalnum()):
                out.append((*m.span(), sorted(spans, key=lambda x: x[1])))
    out.sort()
    return [x for i, x in enumerate(out) if i == 0 or x[0] >= max(y[1] for y in out[:i])]


def labelled_sentences(texts: list[str]) -> tuple[list[list], dict[str, list[str]]]:
    """Sentences as lists of text and (kind, item), and the items by kind (org and code included)."""
    frames = frame_patterns()
    good, pools = [], {k: [] for k in (*pii.KINDS, "org", "code")}
    for text in texts:
        for a, b, spans in marked(text, frames):
            parts, at = [], a
            for kind, s, e in spans:
                parts += [text[at:s], (kind, text[s:e])]
                pools[kind].append(text[s:e])
                at = e
            good.append([*parts, text[at:b]])
    return good, pools


def alter(item: str, kind: str, rng: random.Random) -> str:
    """The item with its digits drawn anew and, in names, firms and addresses, some letters changed, lost or doubled."""
    out = []
    for c in item:
        if c.isdigit() and kind != "code":
            c = rng.choice("0123456789")
        elif c.isalpha() and kind in ("name", "org", "email", "address") and c.isascii() and (x := rng.random()) < 0.1:
            v = "aeiou"
            c2 = rng.choice(v if c.lower() in v else "bcdfghklmnprstvwz")
            c = "" if x < 0.01 and c.islower() else c * 2 if x < 0.02 else c2.upper() if c.isupper() else c2
        out.append(c)
    return "".join(out)


def example(good: list[list], pools: dict[str, list[str]], rng: random.Random) -> tuple[np.ndarray, np.ndarray]:
    text, tags = "", []
    for _ in range(rng.choice((1, 2, 2, 3, 4))):
        if text:
            gap = rng.choice((" ", " ", " ", "  ", "\n", "\n\n", "\xa0"))
            text += gap
            tags += [0] * len(gap)
        for p in rng.choice(good):
            if isinstance(p, str):
                text += p
                tags += [0] * len(p)
                continue
            kind, item = p
            if rng.random() < 0.75:
                item = rng.choice(pools[kind])
            if rng.random() < 0.6:
                item = alter(item, kind, rng)
            if rng.random() < 0.1:
                item = item.upper() if rng.random() < 0.5 or kind not in ("name", "org", "email") else item.lower()
            text += item
            k = pii.KINDS.index(kind) if kind in pii.KINDS else -1
            tags += [pii.begin(k), *[pii.inside(k)] * (len(item) - 1)] if k >= 0 and item else [0] * len(item)
    at = rng.randrange(max(1, len(text) - 60)) if rng.random() < 0.35 else 0
    x, y = pii.char_classes(text)[at : at + pii.WINDOW], np.array(tags[at : at + pii.WINDOW], np.int64)
    if y[0] > len(pii.KINDS):  # a window that opens within an item opens it
        y[0] -= len(pii.KINDS)
    return x, y


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def loss_and_gradient(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Negative log likelihood for each character of a batch x, y (T, B), and its gradient."""
    t_len, b = x.shape
    h, k = w["recur"].shape[1], len(w["bias"])
    live = (np.arange(t_len)[:, None] < lengths).astype(np.float32)
    g = {n: np.zeros_like(v) for n, v in w.items()}
    kept, hidden = [], np.zeros((t_len, b, 2 * h), np.float32)
    for d in (0, 1):
        hid, cell = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
        steps = range(t_len) if d == 0 else range(t_len - 1, -1, -1)
        saved = [None] * t_len
        for t in steps:
            z = w["table"][d][x[t]] + hid @ w["recur"][d]
            a = np.empty_like(z)
            a[:, : 3 * h] = np.clip(0.25 * z[:, : 3 * h] + 0.5, 0, 1)
            a[:, 3 * h :] = z[:, 3 * h :] / (1 + np.abs(z[:, 3 * h :]))
            new = a[:, h : 2 * h] * cell + a[:, :h] * a[:, 3 * h :]
            tc = new / (1 + np.abs(new))
            out = a[:, 2 * h : 3 * h] * tc
            m = live[t][:, None]
            saved[t] = (a, cell, tc, hid)
            cell, hid = new * m, out * m
            hidden[t, :, d * h : (d + 1) * h] = hid
        kept.append((list(steps), saved))
    scores = hidden @ w["out"] + w["bias"]
    # CRF: forward, backward, marginals
    alpha, beta = np.zeros((t_len, b, k), np.float64), np.zeros((t_len, b, k), np.float64)
    trans = np.where(pii.ALLOWED, w["trans"].astype(np.float64), -1e4)
    start = np.where(pii.STARTS, w["start"].astype(np.float64), -1e4)
    alpha[0] = start + scores[0]
    for t in range(1, t_len):
        new = logsumexp(alpha[t - 1][:, :, None] + trans, 1) + scores[t]
        alpha[t] = np.where(live[t][:, None] > 0, new, alpha[t - 1])
    log_z = logsumexp(alpha[-1], 1)
    dtrans = np.zeros_like(trans)
    for t in range(t_len - 2, -1, -1):
        ahead = scores[t + 1] + beta[t + 1]
        new = logsumexp(trans + ahead[:, None, :], 2)
        on = live[t + 1][:, None]
        beta[t] = np.where(on > 0, new, beta[t + 1])
        pair = np.exp(alpha[t][:, :, None] + trans + ahead[:, None, :] - log_z[:, None, None]) * on[:, :, None]
        dtrans += pair.sum(0)
    marg = np.exp(alpha + beta - log_z[:, None]) * live[:, :, None]
    cols = np.arange(b)
    gold = start[y[0]] + scores[0, cols, y[0]]
    for t in range(1, t_len):
        gold = gold + (trans[y[t - 1], y[t]] + scores[t, cols, y[t]]) * live[t]
        np.add.at(dtrans, (y[t - 1], y[t]), -live[t])
    n = float(live.sum())
    ds = marg.astype(np.float32)
    np.add.at(ds, (np.arange(t_len)[:, None], cols[None], y), -live)
    ds /= n
    g["trans"] = (dtrans / n).astype(np.float32)
    np.add.at(g["start"], np.arange(k), (marg[0].sum(0) / n).astype(np.float32))
    np.add.at(g["start"], y[0], np.full(b, -1 / n, np.float32))
    g["bias"] = ds.sum((0, 1))
    g["out"] = hidden.reshape(-1, 2 * h).T @ ds.reshape(-1, k)
    dh_all = ds @ w["out"].T
    for d in (0, 1):
        steps, saved = kept[d]
        dh, dc = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
        dzs = np.zeros((t_len, b, 4 * h), np.float32)
        hs = np.zeros((t_len, b, h), np.float32)
        for t in reversed(steps):
            a, cell, tc, hid = saved[t]
            m = live[t][:, None]
            dht, dct = (dh + dh_all[t, :, d * h : (d + 1) * h]) * m, dc * m
            i, f, o, c = a[:, :h], a[:, h : 2 * h], a[:, 2 * h : 3 * h], a[:, 3 * h :]
            slope = lambda gate: 0.25 * ((gate > 0) & (gate < 1))
            dct = dct + dht * o * (1 - np.abs(tc)) ** 2
            dz = dzs[t]
            dz[:, :h], dz[:, h : 2 * h] = dct * c * slope(i), dct * cell * slope(f)
            dz[:, 2 * h : 3 * h], dz[:, 3 * h :] = dht * tc * slope(o), dct * i * (1 - np.abs(c)) ** 2
            dh, dc = dz @ w["recur"][d].T, dct * f
            hs[t] = hid
        g["recur"][d] = hs.reshape(-1, h).T @ dzs.reshape(-1, 4 * h)
        np.add.at(g["table"][d], x.reshape(-1), dzs.reshape(-1, 4 * h))
    return float((log_z - gold).sum() / n), g


_data: list = []


def _start(good: list[list], pools: dict[str, list[str]]) -> None:
    _data[:] = [good, pools]


def _step(job: tuple[int, int, dict[str, np.ndarray]]) -> tuple[float, dict[str, np.ndarray]]:
    """Loss and gradient of one worker's batch; sentences of alike length are drawn together."""
    seed, batch, w = job
    rng = random.Random(seed)
    some = sorted((example(*_data, rng) for _ in range(batch * 3)), key=lambda e: len(e[0]))
    at = rng.randrange(3)
    group = some[at * batch : (at + 1) * batch]
    lengths = np.array([len(x) for x, _ in group])
    x, y = np.zeros((lengths.max(), batch), np.int64), np.zeros((lengths.max(), batch), np.int64)
    for j, (a, c) in enumerate(group):
        x[: len(a), j], y[: len(a), j] = a, c
    return loss_and_gradient(w, x, y, lengths)


def train(good: list[list], pools: dict[str, list[str]], begun: dict[str, np.ndarray] | None = None, steps: int = STEPS, batch: int = BATCH, workers: int = WORKERS, seed: int = 5, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    nrng = np.random.default_rng(seed)
    k = len(pii.TAGS)
    init = lambda *s: (nrng.standard_normal(s) * 0.15).astype(np.float32)
    w = {"table": init(2, pii.SYMBOLS, 4 * hidden), "recur": init(2, hidden, 4 * hidden), "out": init(2 * hidden, k), "bias": np.zeros(k, np.float32), "trans": np.zeros((k, k), np.float32), "start": np.zeros(k, np.float32)}
    w["table"][:, :, hidden : 2 * hidden] += 1.0
    w |= {n: v.astype(np.float32) for n, v in (begun or {}).items()}
    m1, m2 = ({n: np.zeros_like(v) for n, v in w.items()} for _ in "ab")
    total = 0.0
    with Pool(workers, _start, (good, pools)) as pool:
        for step in range(1, steps + 1):
            got = pool.map(_step, [(seed * 1_000_003 + step * workers + i, batch, w) for i in range(workers)], chunksize=1)
            total += sum(x for x, _ in got) / workers
            g = {n: sum(x[n] for _, x in got) / workers for n in w}
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            rate = 0.012 * min(1, step / 60) * (0.5 + 0.5 * np.cos(np.pi * step / steps) + 0.005)
            for n in w:
                v = g[n] * min(1.0, 1.0 / (norm + 1e-9))
                m1[n] = 0.9 * m1[n] + 0.1 * v
                m2[n] = 0.99 * m2[n] + 0.01 * v * v
                w[n] -= rate * (m1[n] / (1 - 0.9**step)) / (np.sqrt(m2[n] / (1 - 0.99**step)) + 1e-8)
            if step % 100 == 0:
                print(f"step {step}: {total / 100:.5f}", flush=True)
                total = 0.0
    return w


def fragments(sf_dir: str) -> list[str]:
    """Distinct texts in a fixed order that does not follow the file's; read with pyarrow, as training is no Spark job."""
    import pyarrow.parquet as pq

    texts = {t for t in pq.read_table(f"{sf_dir}/fragments.parquet", columns=["text"])["text"].to_pylist() if t}
    return sorted(texts, key=lambda t: (zlib.crc32(t.encode()), t))


def score(texts: list[str], path: str = pii.WEIGHTS, exact: bool = True) -> dict[str, tuple[float, float, int]]:
    """(recall, precision, items) by kind within the framed sentences of held-out texts."""
    frames = frame_patterns()
    found = pii.find_items(texts, path, exact)
    n: dict[str, Counter] = {"true": Counter(), "found": Counter(), "both": Counter()}
    for text, items in zip(texts, found, strict=True):
        got = set(items)
        for a, b, spans in marked(text, frames):
            want = {x for x in spans if x[0] in pii.KINDS}
            inside = {x for x in got if a <= x[1] and x[2] <= b}
            for name, some in (("true", want), ("found", inside), ("both", want & inside)):
                n[name].update(x[0] for x in some)
    return {k: (round(n["both"][k] / max(n["true"][k], 1), 4), round(n["both"][k] / max(n["found"][k], 1), 4), n["true"][k]) for k in pii.KINDS}


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "--score"]
    texts, out = fragments(args[0]), args[1] if len(args) > 1 else pii.WEIGHTS
    if "--score" not in sys.argv:
        good, pools = labelled_sentences(texts[:SAMPLE])
        print(len(good), {k: len(v) for k, v in pools.items()}, flush=True)
        begun = dict(np.load(args[2])) if len(args) > 2 else None
        np.savez_compressed(out, **{k: v.astype(np.float16) for k, v in train(good, pools, begun, STEPS // 2 if begun else STEPS).items()})
    for exact in (True, False):
        print("trimmed" if exact else "decoded", score(texts[SAMPLE : SAMPLE + 2000], out, exact))
