"""Subject areas of documents by interpolated n-gram language models.

Each subject has a word model of orders 1 and 2, interpolated with a background model of the whole corpus. It is trained
by expectation-maximisation on hand-labelled documents: a sentence of a document belongs to one of the document's
labels or to the background. A sentence is about the subject whose model lowers its per-token cross-entropy most against
the background, if by more than a margin that is calibrated on the labelled documents; a document has every
subject that a quarter of its sentences are about.

Models are arrays over a fixed number of hash buckets, so what is broadcast does not grow with the corpus; the
background counts are of all documents. Defined cases: null, empty and wordless texts have no subject; labels in odd
case, repeated or unknown are read or dropped; with no usable label there are no subjects; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of each order; labelled documents the models are fitted on at most.
BUCKETS = 1 << 17
LABELLED_MOST = 20_000
EM_ROUNDS = 6
#: Log odds of the background that a labelled sentence must overcome to teach its subject.
BACK_ODDS = 1.0
SHARE = 0.25
#: Weights of the subject's bigrams and unigrams, the rest being the background's; of the background's bigrams,
#: unigrams and the uniform; words at which a subject's own counts weigh half.
LAMBDA = (0.25, 0.6)
TRUST = 60.0
#: Languages with counts of their own, the most frequent first; texts of the others are found their nearest by their words.
LANGUAGES_MOST = 64
LAMBDA_BACK = (0.3, 0.6, 0.1)
MARGINS = np.round(np.arange(0.02, 1.22, 0.03), 2)
#: Multipliers of the characters of a word by place, and the id that all numbers share.
_POWER = np.random.default_rng(3).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NUMBER = np.uint64(0x9E3779B1)


def _letter_table() -> np.ndarray:
    """1 letters, 2 decimal digits, 4 blanks, 0 anything else, for code points up to 0xFFFF."""
    return np.array([1 if (c := chr(i)).isalnum() and not c.isdecimal() else 2 if c.isdecimal() else 4 if c.isspace() else 0 for i in range(0x10000)], np.uint8)


_TABLE = _letter_table()


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unigram bucket, bigram bucket, sentence, document of each sentence) of the words of a batch.

    Sentences end at line breaks and at blanks behind a full stop, question or exclamation mark, but for the answer of a
    question ("A: "). Words are runs of letters or of digits; all numbers are one word, and a sentence of numbers alone is none.
    All is done on the code points of the whole batch at once."""
    low = [t.lower() if t else "" for t in texts]
    data = np.frombuffer("\n".join([*low, "", "", ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _TABLE[np.minimum(data, 0xFFFF)]
    for c in np.unique(data[data > 0xFFFF]).tolist():
        kind[data == c] = 1 if chr(c).isalnum() and not chr(c).isdecimal() else 2 if chr(c).isdecimal() else 0
    word = (kind == 1) | (kind == 2)
    start = word.copy()
    start[1:] &= kind[1:] != kind[:-1]
    cut = data == 10
    stop = (data == 46) | (data == 33) | (data == 63)
    gap = np.flatnonzero((kind[1:-3] == 4) & stop[:-4]) + 1
    cut[gap[~((data[gap + 1] == 97) & (data[gap + 2] == 58) & (data[gap + 3] == 32))]] = True
    at = np.flatnonzero(start)
    empty = np.zeros(0, np.int64)
    if not len(at):
        return empty, empty, empty, empty
    place = np.arange(len(data)) - np.maximum.accumulate(np.where(start, np.arange(len(data)), 0))
    w = np.add.reduceat(np.where(word, data, 0).astype(np.uint64) * _POWER[np.minimum(place, 63)], at)
    w ^= w >> np.uint64(31)
    w = (w * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    letters = kind[at] == 1
    w = np.where(letters, w, _NUMBER)
    sent = np.cumsum(cut)[at]
    ends = np.cumsum([len(t) + 1 for t in low])
    own = np.searchsorted(ends, at, side="right")
    has = np.bincount(sent, letters) > 0
    keep = has[sent]
    w, sent, own = w[keep], sent[keep], own[keep]
    if not len(w):
        return empty, empty, empty, empty
    new = np.append(True, sent[1:] != sent[:-1])
    s, doc = np.cumsum(new) - 1, own[new]
    before = np.append(np.uint64(0), w[:-1])
    before[new] = 1
    pair = (before * np.uint64(0x9E3779B97F4A7C15)) ^ w
    pair ^= pair >> np.uint64(29)
    return (w % np.uint64(BUCKETS)).astype(np.int64), (pair % np.uint64(BUCKETS)).astype(np.int64), s.astype(np.int64), doc.astype(np.int64)


class Models:
    """Counts by subject and the background's by language; probabilities are taken within the language of a
    sentence, else a subject labelled in one language more than in another would claim all its sentences."""

    def __init__(self, subjects: list[str], back: np.ndarray, margin: float = 0.1):
        #: back: (languages, 2 * BUCKETS), unigrams before bigrams; the first language holds untagged texts
        self.subjects, self.margin = subjects, margin
        back = back.astype(np.float32)
        self.tongue = np.log((back[1:, :BUCKETS] + 0.05) / (back[1:, :BUCKETS].sum(1, keepdims=True) + 0.05 * BUCKETS)) if len(back) > 1 else np.zeros((1, BUCKETS), np.float32)
        self.back = back.sum(0)
        tagged = back[1:] if len(back) > 1 else back
        share = tagged.sum(1) / max(tagged.sum(), 1.0)  # untagged texts are taken to be of the languages in proportion
        self.back_size = np.maximum(share * self.back.sum() / 2, 1.0)[:, None].repeat(2, 1)
        self.counts = np.zeros((len(subjects), 2 * BUCKETS), np.float32)
        self.size = np.zeros((len(subjects), len(self.tongue), 2))

    def language(self, u: np.ndarray, s: np.ndarray, n: int) -> np.ndarray:
        """Most likely language of each sentence."""
        return np.stack([np.bincount(s, x[u], n) for x in self.tongue]).argmax(0)

    def add(self, u: np.ndarray, v: np.ndarray, s: np.ndarray, n: int, weight: np.ndarray) -> None:
        """Adds sentences with a weight for each subject."""
        lang = self.language(u, s, n)
        words = np.bincount(s, minlength=n)
        for k in range(len(self.subjects)):
            w = weight[s, k]
            self.counts[k] += np.bincount(u, w, 2 * BUCKETS) + np.bincount(v + BUCKETS, w, 2 * BUCKETS)
            self.size[k] += np.bincount(lang, weight[:, k] * words, len(self.tongue))[:, None]

    def gains(self, u: np.ndarray, v: np.ndarray, s: np.ndarray, n: int) -> np.ndarray:
        """(sentences, subjects): background minus subject cross-entropy for each token. A bigram's share of all
        bigrams stands for its conditional share times its unigram's, which needs no table of histories; the
        more words a subject has in the language, the more its own counts weigh."""
        lang = self.language(u, s, n)[s] if n else np.zeros(0, int)
        a2, a1, a0 = LAMBDA_BACK
        size = self.back_size[lang]
        b1, b2 = self.back[u] / size[:, 0], self.back[v + BUCKETS] / size[:, 1]
        back = a2 * b2 + a1 * b1 + a0 / BUCKETS
        l2, l1 = LAMBDA
        words = np.maximum(np.bincount(s, minlength=n), 1)
        out = np.empty((n, len(self.subjects)))
        if not n:
            return out
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))  # words stand in order of their sentences
        trust = self.size[:, :, 0] / (self.size[:, :, 0] + TRUST)
        f2, f1, keep = trust * l2 / np.maximum(self.size[:, :, 1], 1), trust * l1 / np.maximum(self.size[:, :, 0], 1), 1 - trust * (l1 + l2)
        for k in range(len(self.subjects)):
            p = f2[k][lang] * self.counts[k, BUCKETS:][v] + f1[k][lang] * self.counts[k, :BUCKETS][u]
            out[:, k] = np.add.reduceat(np.log(p / back + keep[k][lang]), first) / words
        return out

    def about(self, gain: np.ndarray, margin: float | None = None) -> np.ndarray:
        """Subject of each sentence, -1 for none."""
        if not len(gain):
            return np.zeros(0, np.int64)
        top = gain.argmax(1)
        return np.where(gain.max(1) > (self.margin if margin is None else margin), top, -1)

    def shares(self, about: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        k = len(self.subjects)
        hit = about >= 0
        count = np.bincount(doc[hit] * k + about[hit], minlength=docs * k).reshape(docs, k)
        return count / np.maximum(np.bincount(doc, minlength=docs), 1)[:, None]

    def subjects_of(self, texts: list[str | None]) -> list[list[str]]:
        u, v, s, doc = grams(texts)
        share = self.shares(self.about(self.gains(u, v, s, len(doc))), doc, len(texts))
        return [[self.subjects[k] for k in np.flatnonzero(row >= SHARE - 1e-9)] for row in share]


def estimate(models: Models, batch: tuple, own: np.ndarray, use: np.ndarray, rounds: int) -> np.ndarray:
    """EM over the sentences ``use``: a sentence is of one of its document's labels (``own``) or of the background.
    Returns the gains of all sentences."""
    u, v, s, doc = batch
    n, k = own.shape
    weight = own / np.maximum(own.sum(1, keepdims=True), 1) * use[:, None]
    size = np.bincount(s, minlength=n)
    gain = np.zeros((n, k))
    for r in range(rounds):
        models.counts[:], models.size[:] = 0, 0
        models.add(u, v, s, n, weight)
        gain = models.gains(u, v, s, n)
        if r < rounds - 1:
            score = np.concatenate([np.where(own, gain * size[:, None], -np.inf), np.full((n, 1), BACK_ODDS)], 1)
            score -= score.max(1, keepdims=True)
            post = np.exp(score)
            weight = (post / post.sum(1, keepdims=True))[:, :-1] * use[:, None]
    return gain


def fit(models: Models, texts: list[str], labels: list[set[str]], rounds: int = EM_ROUNDS) -> Models:
    """The margin is calibrated on documents left out in turn (two folds); then all are used."""
    batch = grams(texts)
    doc = batch[3]
    allowed = np.array([[x in ls for x in models.subjects] for ls in labels], bool).reshape(len(labels), len(models.subjects))
    own = allowed[doc]
    fold = doc % 2
    held = np.zeros(own.shape)
    for f in (0, 1):
        held[fold == f] = estimate(models, batch, own, fold != f, rounds)[fold == f]
    calibrate(models, held, doc, allowed)
    estimate(models, batch, own, np.ones(len(doc), bool), rounds)
    return models


def calibrate(models: Models, gain: np.ndarray, doc: np.ndarray, allowed: np.ndarray) -> None:
    best = (-1.0, models.margin)
    for m in MARGINS:
        got = models.shares(models.about(gain, m), doc, len(allowed)) >= SHARE - 1e-9
        f1 = 2 * (got & allowed).sum() / max(got.sum() + allowed.sum(), 1)
        if f1 > best[0] + 1e-4:
            best = (f1, float(m))
    models.margin = best[1]


def tongue(lang):
    """Language of a tag: its first two letters, with the three-letter codes of the common ones."""
    base = F.regexp_extract(F.lower(F.trim(lang)), r"^([a-z]{2,3})(?:$|[^a-z])", 1)
    # ISO 639-2 codes of languages whose two-letter code is not their beginning
    known = {"deu": "de", "ger": "de", "spa": "es", "und": "", "mul": "", "zxx": "", "mis": ""}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), base), F.substring(base, 1, 2))


def background(docs: DataFrame, text: str, lang: str) -> np.ndarray:
    """Counts of all words and pairs of the corpus by language and bucket: at most
    (LANGUAGES_MOST + 1) * 2 * BUCKETS numbers; row 0 is of texts without a language of the largest ones."""
    tagged = docs.select(F.col(text).alias("t"), F.coalesce(tongue(F.col(lang)), F.lit("")).alias("g"))
    top = [r["g"] for r in tagged.filter("g <> '' AND t IS NOT NULL").groupBy("g").count().orderBy(F.desc("count"), "g").limit(LANGUAGES_MOST).collect()]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(top) + 1, 2 * BUCKETS), np.int64)
        for b in batches:
            for g, part in b.groupby("g"):
                u, v, _, _ = grams(part["t"].tolist())
                total[top.index(g) + 1 if g in top else 0] += np.bincount(u, minlength=2 * BUCKETS) + np.bincount(v + BUCKETS, minlength=2 * BUCKETS)
        g, at = np.nonzero(total)
        yield pd.DataFrame({"g": g.astype(np.int32), "bucket": at, "n": total[g, at]})

    rows = tagged.mapInPandas(count, "g int, bucket bigint, n bigint").groupBy("g", "bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((len(top) + 1, 2 * BUCKETS), np.float32)
    out[rows["g"].to_numpy(np.int64), rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return out


def train(docs: DataFrame, labels: DataFrame, areas: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Models:
    subjects = sorted({r[0].strip().lower() for r in areas.select("subject").dropna().distinct().collect()})
    clean = labels.select(F.col(doc_id).alias("id"), F.lower(F.trim("subject")).alias("s")).dropna().filter(F.col("s").isin([*subjects, "none"]))
    clean = clean.groupBy("id").agg(F.collect_set("s").alias("s")).orderBy(F.xxhash64("id")).limit(LABELLED_MOST)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(clean), "id").filter("t IS NOT NULL").toPandas()  # LABELLED_MOST texts at most
    models = Models(subjects, background(docs, text, lang))
    return fit(models, rows["t"].tolist(), [set(x) - {"none"} for x in rows["s"]])


def subject_areas(docs: DataFrame, models: Models, text: str = "text", into: str = "subjects") -> DataFrame:
    """``docs`` with the array of subjects of ``text``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            yield pd.Series(shared.value.subjects_of(s.tolist()), dtype=object)

    return docs.withColumn(into, F.pandas_udf(run, "array<string>").asNondeterministic()(F.col(text)))
