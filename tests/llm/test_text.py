import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from groundmill.llm import pii, pii_training, subjects, tokenizer

# --- tokenizer ---

VOCABULARY = tokenizer.VOCABULARY.replace(".tiktoken", ".json")
ODD = ["", "I'll we've 'sam ''s \n'll  'd", "a  b\n\n c   ", " \t\n", "<|endoftext|> x", "é漢字😀 é‍", "12½²34", " x　 y\x85z\x1c", "x" * 20000, "ab " * 9000, "'" * 50, "it's 'round O'Neill'RE've"]


@pytest.fixture(scope="module")
def library():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_library(library):
    rng = random.Random(0)
    texts = ODD + ["".join(rng.choice("ab'strevelmd  \n\t .,!1é漢😀") for _ in range(rng.randrange(40))) for _ in range(3000)]
    got = tokenizer.encoder().encode(texts)
    assert got == library(texts)
    assert all(tokenizer.encoder().decode(i) == t for i, t in zip(got, texts, strict=True))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs", "Cn")), max_size=40), min_size=1, max_size=4))
def test_round_trip(texts):
    e = tokenizer.encoder()
    assert [e.decode(i) for i in e.encode(texts)] == texts
    pieces, offsets, firsts = e.pieces(texts)
    for k, t in enumerate(texts):
        own = slice(firsts[k], firsts[k + 1])
        assert "".join(pieces[own]) == t and all(t.startswith(p, o) for p, o in zip(pieces[own], offsets[own], strict=True))


def test_scan_widths_agree():
    rng = np.random.default_rng(1)
    sym = rng.integers(0, 9, 5000).astype(np.uint8)
    state, want = tokenizer.Q_NEW, []
    for s in sym:
        want.append(bool(tokenizer.CUT[s, state]) and s != tokenizer.S_END)
        state = tokenizer.TO[s, state]
    for width in (1, 7, 64, 9000):
        assert tokenizer.boundaries(sym, width).tolist() == want


def test_token_columns(spark, library):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "a b")], "ids int, text string")
    assert {r["ids"]: r["t"] for r in tokenizer.token_ids(df, ids="t").collect()} == {1: library(["a b"])[0], 2: [], 3: [], 4: library(["a b"])[0]}
    assert [r["n_tokens"] for r in tokenizer.token_counts(df).orderBy("ids").collect()] == [2, 0, 0, 2]
    assert tokenizer.token_ids(df.limit(0), ids="t").count() == 0


# --- personal information ---

SENTENCES = [
    ("Voicemail for ", ("name", "Marla Quenbury"), " at ", ("phone", "415 555 0117 x730"), "; no answer, second attempt planned."),
    ("Mailing address on record is ", ("address", "8325 Wickham Avenue, Norvale, Arizona 99511"), "; the previous one is no longer valid."),
    ("The authorization was signed by ", ("name", "Tolland, Greta W."), ", SSN ", ("id_number", "990-36-8969"), ", and returned by fax under DOC-9740-74."),
    ("Please send all further requests to ", ("email", "quenbury.m+claims@inbox.test"), " and copy adjuster ", ("name", "Fabian Tolland Jr."), "."),
    ("Deposition of Dr. ", ("name", "A.J. Quenbury"), ", RN was moved to 2025-01-05 at the request of both sides."),
    ("The second page repeats the first and carries no signature.",),
]


def spans(parts):
    text, out = "", []
    for p in parts:
        if isinstance(p, tuple):
            out.append((p[0], len(text), len(text) + len(p[1])))
            text += p[1]
        else:
            text += p
    return text, out


@pytest.mark.parametrize("parts", SENTENCES)
def test_items(parts):
    text, want = spans(parts)
    assert sorted(pii.find_items([text])[0]) == sorted(want)


def test_items_in_a_long_text_are_those_of_its_parts():
    text, want = "", []
    for k in range(60):
        t, s = spans(SENTENCES[k % len(SENTENCES)])
        want += [(kind, a + len(text), b + len(text)) for kind, a, b in s]
        text += t + "\n\n"
    got = set(pii.find_items([text])[0])
    assert len(got & set(want)) >= 0.95 * len(want) and len(got) <= 1.05 * len(want)


def test_odd_texts_and_columns(spark):
    t, s = spans(SENTENCES[0])
    df = spark.createDataFrame([(1, t), (2, None), (3, ""), (4, " \n"), (5, "😀" + t)], "items int, text string")
    got = {r["items"]: r for r in pii.redact(pii.personal_items(df, "text", "found"), "text", "found").collect()}
    assert got[1]["redacted"] == "Voicemail for [NAME] at [PHONE]; no answer, second attempt planned." and got[5]["redacted"].startswith("😀Voicemail for [NAME]")
    assert got[2]["redacted"] is None and got[3]["redacted"] == "" and got[4]["found"] == []
    assert pii.personal_items(df.limit(0), "text", "found").count() == 0


def test_gradient():
    rng = np.random.default_rng(0)
    k, h = len(pii.TAGS), 3
    w = {"table": rng.standard_normal((2, pii.SYMBOLS, 4 * h)), "recur": rng.standard_normal((2, h, 4 * h)), "out": rng.standard_normal((2 * h, k)), "bias": rng.standard_normal(k), "trans": rng.standard_normal((k, k)), "start": rng.standard_normal(k)}
    w = {n: 0.5 * v for n, v in w.items()}
    x, lengths = rng.integers(1, 90, (7, 3)), np.array([7, 5, 2])
    y = np.array([[0, 2, 5], [0, 7, 10], [3, 0, 10], [8, 1, 0], [8, 6, 0], [0, 6, 0], [4, 1, 0]])  # allowed ways only
    _, g = pii_training.loss_and_gradient(w, x, y, lengths)
    for name, at in (("out", (1, 2)), ("trans", (0, 3)), ("trans", (7, 0)), ("start", (2,)), ("recur", (0, 1, 4)), ("recur", (1, 2, 10)), ("table", (0, int(x[1, 0]), 5)), ("bias", (4,))):
        e = 1e-3
        w[name][at] += e
        up, _ = pii_training.loss_and_gradient(w, x, y, lengths)
        w[name][at] -= 2 * e
        down, _ = pii_training.loss_and_gradient(w, x, y, lengths)
        w[name][at] += e
        assert abs((up - down) / (2 * e) - g[name][at]) < 2e-3


def test_viterbi_against_brute_force():
    import itertools

    rng = np.random.default_rng(2)
    k, h = len(pii.TAGS), 2
    model = pii.Tagger({"table": np.zeros((2, pii.SYMBOLS, 4 * h)), "recur": np.zeros((2, h, 4 * h)), "out": np.zeros((2 * h, k)), "bias": np.zeros(k), "trans": rng.standard_normal((k, k)), "start": rng.standard_normal(k)})
    s = 2 * rng.standard_normal((4, k, 2)).astype(np.float32)
    lengths = np.array([4, 3])
    got = model.viterbi(s, lengths)
    for j, n in enumerate(lengths):
        ways = (p for p in itertools.product(range(k), repeat=int(n)) if pii.STARTS[p[0]] and all(pii.ALLOWED[a, b] for a, b in itertools.pairwise(p)))
        best = max(ways, key=lambda p: model.start[p[0]] + s[0, p[0], j] + sum(model.trans[p[t - 1], p[t]] + s[t, p[t], j] for t in range(1, n)))
        assert got[:n, j].tolist() == list(best)


def test_touching_items_and_edges():
    k = {n: i for i, n in enumerate(pii.TAGS)}
    tags = np.array([k["B-phone"], k["I-phone"], k["B-phone"], k["I-phone"], 0, k["B-name"], k["I-name"]], np.int8)
    assert pii.spans_of(tags) == [("phone", 0, 2), ("phone", 2, 4), ("name", 5, 7)]
    text = "by Marla Quenbury, J. (415) 555-0117) on"
    at = text.index
    cut = [("name", at("arla"), at("ury,")), ("name", at("J."), at(" (415")), ("phone", at("(415"), at(" on"))]
    assert [text[a:b] for _, a, b in pii.trimmed(text, cut)] == ["Marla Quenbury", "J.", "(415) 555-0117"]


def test_hand_labels():
    text = "Deposition of Dr. Ann B. Quenbury, RN was moved to 2025-01-05 at the request of both sides.\nIdentity was verified on the call against passport no. X1234567. Home visit at Steinweg 4a, 12345 Nordheim found the claimant walking without a cane."
    got = [(kind, text[a:b]) for *_, spans in pii_training.marked(text, pii_training.frame_patterns()) for kind, a, b in spans]
    assert got == [("name", "Ann B. Quenbury"), ("id_number", "X1234567"), ("address", "Steinweg 4a, 12345")]


def test_training_learns():
    good = [list(s) for s in SENTENCES]
    pools = {kind: [p[1] for s in SENTENCES for p in s if isinstance(p, tuple) and p[0] == kind] for kind in (*pii.KINDS, "org", "code")}
    w = pii_training.train(good, pools, steps=130, batch=12, workers=2, hidden=16)
    rng = random.Random(9)
    right = total = 0
    model = pii.Tagger(w)
    for _ in range(30):
        x, y = pii_training.example(good, pools, rng)
        got = model.viterbi(model.scores(x[:, None]).transpose(0, 2, 1), np.array([len(x)]))[:, 0]
        right, total = right + (got == y).sum(), total + len(y)
    assert right > 0.9 * total


# --- subjects ---

TOPICS = {"sport": "goalkeeper relay scoreboard league penalty", "law": "subpoena affidavit docket statute witness", "software": "server password patch compiler database"}
DE = {"sport": "torwart staffel tabelle liga strafstoß", "law": "klage urteil vollmacht zeuge frist", "software": "rechner passwort fehler schnittstelle datenbank"}
FILLERS = ["Received and indexed.", "Page 2 of 9.", "Copy to file."]


def make(rng, topics, lang):
    out = []
    for t in topics:
        words = (TOPICS if lang == "en" else DE)[t].split()
        a, b = rng.sample(words, 2)
        out.append(f"The note mentions the {a} and then the {b}." if lang == "en" else f"Die Notiz nennt {a} und dann {b}.")
    return " ".join(out)


def test_words_and_sentences():
    plain = lambda t: [[w for w in re.findall(r"[^\W\d_]+|\d+", s)] for s in re.split(r"\n+|(?<=[.!?])\s(?!a: )", t.lower()) if re.search(r"[^\W\d_]", s)]
    texts = ["One two. Three 4 five!\nSix", None, "", "12 34. 5", "q: Why? A: Because it is so. End", "élan über_x 😀b 中文 a²", "x" * 200 + " y"]
    u, v, s, doc = subjects.grams(texts)
    want = [(d, sent) for d, t in enumerate(texts) if t for sent in plain(t)]
    assert doc.tolist() == [d for d, _ in want] and np.bincount(s).tolist() == [len(x) for _, x in want]
    ids: dict = {}
    for word, i in zip((w for _, x in want for w in x), u.tolist(), strict=True):
        assert ids.setdefault("0" if word.isdecimal() else word, i) == i
    assert len(set(ids.values())) == len(ids)
    assert subjects.grams(["b c"])[1].tolist()[1] == subjects.grams(["a\nb c"])[1].tolist()[2]  # pairs do not cross sentences


def test_subjects(spark):
    rng = random.Random(4)
    docs, labels, truth = [], [], {}
    for i in range(400):
        lang, own = rng.choice(["en", "en", "de"]), rng.sample(sorted(TOPICS), rng.choice([1, 1, 2]))
        sents = [make(rng, [rng.choice(own)], lang) for _ in range(6)] + rng.sample(FILLERS, 2)
        docs.append((i, " ".join(sents), {"en": "en-US", "de": "deu"}[lang] if rng.random() < 0.9 else None))
        counts = {t: sum(any(w in s for w in (TOPICS if lang == "en" else DE)[t].split()) for s in sents) for t in TOPICS}
        truth[i] = {t for t, c in counts.items() if c >= 2}
        if i % 3 == 0:
            labels += [(i, t.upper() if i % 2 else f" {t} ", "x") for t in truth[i]]
    docs += [(1000, None, "en"), (1001, "", None), (1002, "123 456", None)]
    labels += [(0, "nonsense", "x"), (5000, "law", "x"), (3, None, "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumn("subject", F.lit(0))
    areas = spark.createDataFrame([(t, "T", "d") for t in TOPICS], "subject string, title string, description string")
    models = subjects.train(df, spark.createDataFrame(labels, "doc_id bigint, subject string, coder string"), areas)
    got = {r["doc_id"]: set(r["subjects"]) for r in subjects.subject_areas(df, models).collect()}
    assert got[1000] == got[1001] == got[1002] == set()
    held = [i for i in truth if i % 3]
    assert sum(got[i] == truth[i] for i in held) >= 0.93 * len(held)
    none = subjects.train(df.limit(0), spark.createDataFrame([], "doc_id bigint, subject string, coder string"), areas)
    assert none.subjects_of(["The goalkeeper."]) == [[]]
