import random
import string
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from groundmill.llm import groups, mixing, names, vectors

# --- groups ---


def brute_groups(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in parent}


@pytest.mark.parametrize(("n", "edges", "cell"), [(200, 150, 10), (60, 400, 20), (300, 299, 5)])
def test_groups_against_union_find(spark, n, edges, cell):
    rng = random.Random(n)
    rows = [(f"v{rng.randrange(n):03}", f"v{rng.randrange(n):03}") for _ in range(edges)] + [("v000", None), ("v001", "v001")] * 3
    df = spark.createDataFrame(rows + rows[:20], "a string, b string").withColumn("vertex", F.lit(1))
    got = {r["vertex"]: r["group"] for r in groups.connected_groups(df, "a", "b", edges_per_cell=cell).collect()}
    assert got == brute_groups(rows)


def test_groups_chain_hub_and_empty(spark):
    chain = spark.range(400).selectExpr("lpad(id, 4, '0') AS a", "lpad(id + 1, 4, '0') AS b")
    assert {r["group"] for r in groups.connected_groups(chain, "a", "b", edges_per_cell=20).collect()} == {"0000"}
    hub = spark.range(500).selectExpr("'zz' AS a", "lpad(id, 4, '0') AS b")
    got = groups.connected_groups(hub, "a", "b", edges_per_cell=30)
    assert got.count() == 501 and got.select("group").distinct().count() == 1
    assert groups.connected_groups(chain.limit(0), "a", "b").count() == 0


# --- vectors ---


def brute_neighbours(rows, k, least):
    ids = [i for i, v in rows]
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cos = np.round(x @ x.T, 6)
    out = set()
    for i, a in enumerate(ids):
        order = sorted((-cos[i, j], b) for j, b in enumerate(ids) if j != i)
        out |= {(a, b) for c, b in order[:k] if -c >= least}
    return out


def clustered(n, d, seed, copies=0):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((max(1, n // 12), d))
    x = centre[rng.integers(0, len(centre), n)] + 0.35 * rng.standard_normal((n, d))
    x *= rng.uniform(0.1, 5, (n, 1))
    if copies:
        x[:copies] = x[0]
    return [(f"id{i:05}", [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]


@pytest.mark.parametrize(("n", "copies"), [(300, 0), (1500, 500)])
def test_neighbours_recall(spark, n, copies):
    rows = clustered(n, 32, n, copies)
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows + rows[:5], "id string, v array<float>").withColumn("cos", F.lit("x"))
    got = {(r["id"], r["other"]) for r in vectors.similar_vectors(df, "id", "v").collect()}
    want = brute_neighbours(rows, 5, 0.8)
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.01 * len(want)


def test_odd_vectors_take_no_part(spark):
    rows = [("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("c", [0.0, 0.0]), ("d", []), ("e", None), ("f", [1.0, None]), ("g", [1.0, 0.0, 0.0]), ("h", [float("nan"), 1.0]), (None, [1.0, 0.0]), ("i", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id string, v array<float>")
    assert {(r["id"], r["other"], r["cos"]) for r in vectors.similar_vectors(df, "id", "v").collect()} == {("a", "b", 1.0), ("b", "a", 1.0)}
    assert vectors.similar_vectors(df.limit(0), "id", "v").count() == 0
    same = spark.createDataFrame([(f"{i:02}", [1.0, 2.0]) for i in range(20)], "id string, v array<float>")
    got = vectors.similar_vectors(same, "id", "v").groupBy("id").agg(F.collect_set("other").alias("o")).collect()
    assert len(got) == 20 and all(set(r["o"]) == set([f"{i:02}" for i in range(7) if f"{i:02}" != r["id"]][:5]) for r in got)


def test_scan_abandons_nothing_near():
    rng = np.random.default_rng(3)
    x = vectors.unit(np.repeat(rng.standard_normal((40, 64)), 20, 0) + 0.3 * rng.standard_normal((800, 64)))
    a, b, cos = vectors.scan(x, x, 0.8, vectors.rotation(64))
    want = np.argwhere(np.round(x @ x.T, 6) >= 0.8)
    assert len(a) >= 0.98 * len(want) and set(zip(a, b, strict=True)) <= set(map(tuple, want))


def test_bound_of_its_own_for_each_query():
    rng = np.random.default_rng(5)
    x = vectors.unit(rng.standard_normal((600, 64)))
    want = np.argsort(-(x @ x.T), axis=1)[:, 1:6]
    for eps, least in ((vectors.EPS, 0.95), (None, 1.0)):
        a, b, cos = vectors.scan(x, x, -1.0, vectors.rotation(64), 5, eps=eps)
        got = {i: set() for i in range(600)}
        for i, j, c in sorted(zip(a.tolist(), b.tolist(), cos.tolist(), strict=True), key=lambda t: -t[2]):
            if i != j and len(got[i]) < 5:
                got[i].add(j)
        assert sum(len(got[i] & set(w.tolist())) for i, w in enumerate(want)) >= least * want.size
        assert len(a) < 0.9 * 600 * 600  # most pairs are abandoned though no cosine is too small


def test_lists_grow_with_the_root():
    assert vectors.lists_for(100, 8) == 1 and vectors.lists_for(100_000, 8) == 400 and vectors.lists_for(10**9, 8) < 90_000
    rng = np.random.default_rng(2)
    x = vectors.unit(np.repeat(rng.standard_normal((60, 16)), 30, 0) + 0.2 * rng.standard_normal((1800, 16)))
    c = vectors.fit_centres(x, 60, flat=10)
    assert 40 <= len(c) <= 60 and (x @ c.T).max(1).mean() > 0.9


def test_exact_mode(spark):
    rng = np.random.default_rng(3)
    x = vectors.unit(rng.standard_normal((700, 24)))
    df = spark.createDataFrame([(f"{i:04}", [float(v) for v in r]) for i, r in enumerate(x)], "id string, v array<float>")
    y = vectors.unit(x.astype(np.float32))
    cos = np.round(y @ y.T, 6)
    want = {(f"{i:04}", f"{j:04}") for i in range(700) for j in sorted((j for j in range(700) if j != i), key=lambda j: (-cos[i, j], j))[:3]}
    got = {(r["id"], r["other"]) for r in vectors.similar_vectors(df, "id", "v", 3, -1.0, probes=None, eps=None).collect()}
    assert got == want


# --- mixing ---


def plain_sainte_lague(w, caps, seats):
    got = [0] * len(w)
    for _ in range(seats):
        live = [(-w[i] / (2 * got[i] + 1), i) for i in range(len(w)) if w[i] > 0 and got[i] < caps[i]]
        if not live:
            break
        got[min(live)[1]] += 1
    return got


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 60)), min_size=1, max_size=8), st.integers(0, 400))
def test_apportionment(parties, seats):
    w, caps = zip(*parties, strict=True)
    got = mixing.sainte_lague(np.array(w, float), np.array(caps), seats)
    assert got.sum() == min(seats, sum(c for x, c in parties if x > 0))
    assert got.tolist() == plain_sainte_lague(w, caps, seats)


def test_a_million_shards():
    w = np.random.default_rng(0).integers(1, 1_000_000, 1_000_000)
    began = time.process_time()
    got = mixing.sainte_lague(w, w * 3 // 256 + 1, 200_000_000)
    assert got.sum() == 200_000_000 and time.process_time() - began < 20


def test_quotas_are_blocks(spark):
    # one source of equal documents: every shard gives its whole quota, in whole rounds first
    sized = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 5 = 0, 'b', 'a') AS source", "CAST(32 AS BIGINT) AS n_tokens")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(sized, targets, total_tokens=160_000, block_tokens=64)
    got = {r["source"]: r for r in report.collect()}
    assert got["a"]["mixed_tokens"] == got["b"]["mixed_tokens"] == 80_000
    assert {r["copies"] for r in mixed.filter("source = 'b'").collect()} == {2, 3} and got["a"]["most_copies"] == 1


def test_mix(spark):
    rng = random.Random(1)
    rows = [(i, s, rng.randrange(20, 60)) for i, s in enumerate(["a"] * 900 + ["b"] * 300 + ["small"] * 40 + ["untargeted"] * 50 + [None] * 5)] + [(9999, "a", 0)]
    sized = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("small", 0.1, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(sized, targets, block_tokens=128)
    got = {r["source"]: r for r in report.collect()}
    share = {s: got[s]["actual_share"] for s in got}
    assert abs(share["a"] - 0.5 / 0.9) < 0.02 and abs(share["b"] - 0.3 / 0.9) < 0.02 and abs(share["small"] - 0.1 / 0.9) < 0.02
    assert share["none"] == share["untargeted"] == 0 and got[None]["documents"] == 5 and got["small"]["most_copies"] <= 3 and got["a"]["most_copies"] == 1
    assert mixed.select("doc_id").distinct().count() == mixed.count()
    again = mixing.mix(sized.repartition(7), targets, block_tokens=128)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))
    big, _ = mixing.mix(sized, targets, total_tokens=10**9, block_tokens=128)
    assert {r["source"]: r["c"] for r in big.groupBy("source").agg(F.min("copies").alias("c")).collect()} == {"a": 1, "b": 2, "small": 3}
    empty, report = mixing.mix(sized.limit(0), targets)
    assert empty.count() == 0 and report.count() == 4


# --- names ---


def osa(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abc", max_size=9), st.text("abc", max_size=9)), min_size=1, max_size=12))
def test_banded_distance(pairs):
    a, b = zip(*pairs, strict=True)
    want = [min(osa(x, y), 3) for x, y in pairs]
    assert names.edit_distance(list(a), list(b), 2).tolist() == want
    assert [names.near_words(x, y, 2) for x, y in pairs] == [w <= 2 for w in want]


@settings(max_examples=400, deadline=None)
@given(st.text(string.ascii_lowercase[:6], min_size=2, max_size=16), st.lists(st.tuples(st.sampled_from("idst"), st.integers(0, 15), st.sampled_from("abcdef")), max_size=2))
def test_pigeonhole_finds_every_pair_within_tolerance(key, edits):
    other = key
    for kind, at, c in edits:
        at %= max(1, len(other))
        other = other[:at] + {"i": c + other[at:], "d": other[at + 1 :], "s": c + other[at + 1 :], "t": other[at + 1 : at + 2] + other[at : at + 1] + other[at + 2 :]}[kind]
    short, long = sorted((key, other), key=len)
    if osa(short, long) <= names.tolerance(len(long)) and short:
        assert set(names.index_terms(short)) & set(names.probe_terms(long))


@pytest.mark.parametrize("size", range(3, 17))
def test_every_slip_at_every_place_is_found(size):
    key = string.ascii_lowercase[:size]
    swap = lambda w, i: w[:i] + w[i + 1] + w[i] + w[i + 2 :]
    one = {swap(key, i) for i in range(size - 1)} | {key[:i] + key[i + 1 :] for i in range(size)} | {key[:i] + "z" + key[i:] for i in range(size + 1)} | {key[:i] + "z" + key[i + 1 :] for i in range(size)}
    two = {swap(w, i) for w in one for i in range(len(w) - 1)} | {w[:i] + w[i + 1 :] for w in one for i in range(len(w))}
    for other in one | two:
        short, long = sorted((key, other), key=lambda w: (len(w), w))
        if osa(short, long) <= names.tolerance(len(long)):
            assert set(names.index_terms(short)) & set(names.probe_terms(long)), (short, long)


def test_shortened_forms_cover_two_edits():
    rng = random.Random(8)
    for _ in range(400):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(2, 9)))
        b = "".join(rng.choice("abcd") for _ in range(rng.randrange(2, 9)))
        if osa(a, b) <= 2:
            assert names.deletions(a) & names.deletions(b)


PEOPLE = [
    ("e:1", "Elizabeth Zellerbrook", "A"), ("e:2", "ZELLERBROOK, Elizabeth", "A"), ("e:3", "Betty Zelerbrook", "B"), ("r:4", "E. Zellerbrook", "A"), ("r:5", "Dr. Elizabeth Zellerbrook, PhD", "C"),
    ("e:6", "Fabian Corvamnden Jr.", "D"), ("e:7", "Fabian Corvamnden Sr.", "D"), ("r:8", "Fabian T. Corvamnden Jr.", "D"), ("r:9", "F. Corvamnden", "D"),
    ("e:10", "Otterbury Vocational Consulting LLC", "A"), ("e:11", "The Otterbury Voc. Consulting", "B"), ("r:12", "Vocational Consulting of Otterbury", "A"), ("e:13", "Otterbury Neurology Group", "A"),
    ("e:14", "Theodore Quimblestone", "A"), ("e:15", "Theodora Quimblestone", "A"), ("r:16", "T. Quimblestone", "A"), ("r:17", "the claimant", "A"), ("r:18", None, "A"), ("r:19", "  ", "A"), ("r:20", "x" * 5000, "A"),
]
FIRST = [("a:%d" % i, f"{g} Surname{string.ascii_lowercase[i % 26]}{string.ascii_lowercase[i // 26]}foo", "Z") for i, g in enumerate(["Theodore", "Theodora", "Elizabeth", "Fabian"] * 8)]


def test_names(spark):
    rows = [(r, n, [c]) for r, n, c in PEOPLE + FIRST]
    df = spark.createDataFrame(rows + rows[:3], "ref string, name string, contexts array<string>")
    person = {r["ref"]: r["person"] for r in names.link_names(df).collect() if r["ref"][0] != "a"}
    same = lambda *refs: len({person[r] for r in refs}) == 1
    assert same("e:1", "e:2", "e:3", "r:4", "r:5")
    assert same("e:6", "r:8") and person["e:6"] != person["e:7"] and "r:9" not in person
    assert same("e:10", "e:11", "r:12") and person["e:10"] != person["e:13"]
    assert person["e:14"] != person["e:15"] and "r:16" not in person
    assert not {"r:17", "r:18", "r:19"} & set(person)
    assert names.link_names(df.limit(0)).count() == 0


def test_short_name_by_context(spark):
    rows = [("e:1", "Patricia Hollowmere", ["A"]), ("e:2", "Philippa Hollowmere", ["B"]), ("r:3", "P. Hollowmere", ["B"]), ("r:4", "P. Hollowmere", ["C"])]
    got = {r["ref"]: r["person"] for r in names.link_names(spark.createDataFrame(rows, "ref string, name string, contexts array<string>")).collect()}
    assert got["r:3"] == got["e:2"] and "r:4" not in got


def test_one_slip_in_each_part(spark):
    first = [(f"a:{i}", f"{g} Filler{string.ascii_lowercase[i]}wood", ["Z"], None) for i, g in enumerate(["Dorothy", "Richard", "Theodore", "Theodora"] * 6)]
    rows = [("e:1", "Doroothy Cravibovale", ["A"]), ("r:2", "Craviboivale, Dorothy", ["B"]), ("e:3", "Theodore Quimblestone", ["A"]), ("e:4", "Theodora Quimblestome", ["A"]), ("e:5", "Richhard Tarnennthwaite", ["A"])]
    rows += [("e:6", "Richard Tarmebnthwaiteu", ["A"]), ("e:6", "Rich. Tarnennthwaite", ["A"]), ("e:7", "Theodora Tarmebnthwaiteux", ["A"]), ("e:7", "R. Tarnennthwaite", ["A"])]
    got = {r["ref"]: r["person"] for r in names.link_names(spark.createDataFrame(rows + [r[:3] for r in first], "ref string, name string, contexts array<string>")).collect()}
    assert got["e:1"] == got["r:2"] and got["e:3"] != got["e:4"]  # one slip in each part; two known given names
    assert got["e:5"] == got["e:6"] and got["e:5"] != got["e:7"]  # the short name vouches for the surname, not for the given name
